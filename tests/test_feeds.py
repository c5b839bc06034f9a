"""The feed source: types, stamps, images, failures, streams that go on where they stopped."""

import json
import xml.etree.ElementTree as ET

from newsloom.sources import feeds as S

ITEM = '<item><title>{0}</title><link>http://n/{0}</link><pubDate>{1}</pubDate><description>&lt;b&gt;text&lt;/b&gt; of {0}&lt;img src="http://i/{0}.png"&gt;</description></item>'


def rss(*items):
    return f"<rss><channel><title>c</title>{''.join(ITEM.format(n, d) for n, d in items)}</channel></rss>"


def options(sources):
    return {"sources": json.dumps(sources), "fetch": "tests.feed_fixture:fetch", "parsers": "tests.feed_fixture"}


def test_batch(spark, tmp_path):
    at = tmp_path
    open(f"{at}/a.xml", "w").write(rss(("one", "Fri, 05 Jan 2024 10:00:00 +0800"), ("two", "nonsense")))
    open(f"{at}/b.xml", "w").write('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title> E </title><link rel="self" href="http://s"/><link href="http://n/e"/><id>i</id><updated>2024-01-06T00:00:00Z</updated><content>c</content></entry></feed>')
    open(f"{at}/c.html", "w").write("<a href='/x'>Road works</a><a href=/y>Other news</a><a href='/x'>Road again</a>")
    open(f"{at}/d.txt", "w").write("p\nq\n")
    open(f"{at}/bad.xml", "w").write("<rss>")
    sources = [
        {"name": "A", "type": "rss", "url": f"http://h{at}/a.xml", "weight": 2, "lookback_days": 3, "relevance_exempt": True, "content_type": "traffic"}, {"name": "B", "type": "atom", "url": f"http://h{at}/b.xml"},
        {"name": "C", "type": "web", "url": f"http://h{at}/c.html", "keywords": ["ROAD"]}, {"name": "D", "type": "lines", "url": f"http://h{at}/d.txt"}, {"name": "E", "type": "rss", "url": f"http://h{at}/none"}, {"name": "F", "type": "rss", "url": f"http://h{at}/bad.xml"},
        {"name": "G", "type": "unknown", "url": f"http://h{at}/a.xml"}, {"name": "H", "type": "rss", "url": f"http://h{at}/a.xml", "enabled": False},
    ]
    spark.dataSource.register(S.FeedSource)
    df = spark.read.format("newsloom_feeds").options(**options(sources)).load()
    rows = {}
    for r in df.collect():
        rows.setdefault(r.source, []).append(r)
    assert {k: [x.title for x in v] for k, v in rows.items()} == {"A": ["one", "two"], "B": ["E"], "C": ["Road works"], "D": ["p", "q"], "E": [None], "F": [None]}
    a = rows["A"][0]
    assert (str(a.published), a.summary, a.image_url, a.source_weight, a.lookback_days, a.relevance_exempt, a.content_type) == ("2024-01-05 02:00:00", "text of one", "http://i/one.png", 2.0, 3, True, "traffic")
    assert rows["A"][1].published is None and rows["B"][0].link == "http://n/e" and rows["C"][0].link == "/x"
    assert "404" in rows["E"][0].error and "ParseError" in rows["F"][0].error
    assert spark.read.format("newsloom_feeds").options(**options([])).load().count() == 0


def test_images_by_media_fields():
    media = 'xmlns:m="http://search.yahoo.com/mrss/"'
    cases = [
        (f'<item {media}><m:content url="http://2"/><m:thumbnail url="http://1"/><enclosure url="http://3" type="image/png"/></item>', "", "http://1"),
        (f'<item {media}><m:group><m:content url="http://2"/></m:group></item>', "", "http://2"), ('<item><enclosure url="http://3" type="audio/mp3"/><enclosure url="http://4" type="image/png"/></item>', "", "http://4"),
        ("<item/>", "<p><img src='http://5'><img src='http://6'>", "http://5"), ("<item/>", "<img src='data:x'>", ""), (f'<item {media}><m:thumbnail url="/rel"/></item>', "", ""),
    ]
    for xml, html, want in cases:
        assert S.image_of(ET.fromstring(xml), html) == want


def test_stream_goes_on_after_the_last_item(spark, tmp_path):
    at = tmp_path
    spark.dataSource.register(S.FeedSource)
    sources = [{"name": "A", "type": "rss", "url": f"http://h{at}/s.xml"}, {"name": "B", "type": "rss", "url": f"http://h{at}/late.xml"}]

    def run():
        df = spark.readStream.format("newsloom_feeds").options(**options(sources)).load()
        q = df.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").option("path", f"{tmp_path}/out").trigger(once=True).start()
        q.awaitTermination()
        return sorted(r.title for r in spark.read.parquet(f"{tmp_path}/out").collect())

    days = lambda *ds: [(f"d{d}", f"0{d} Jan 2024 10:00:00 GMT") for d in ds]
    open(f"{at}/s.xml", "w").write(rss(*days(2, 1)))
    assert run() == ["d1", "d2"]
    open(f"{at}/s.xml", "w").write(rss(*days(4, 3, 2)))
    assert run() == ["d1", "d2", "d3", "d4"]
    assert run() == ["d1", "d2", "d3", "d4"]
    open(f"{at}/late.xml", "w").write(rss(*days(1)))
    assert run() == ["d1", "d1", "d2", "d3", "d4"]
