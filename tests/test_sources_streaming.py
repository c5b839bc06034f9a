"""Sources read from files; streaming jobs run on what is there."""

import json

from pyspark.sql import functions as F

from helpers import DATA
from newsloom.sources import readers as R
from newsloom.streaming import flows


def test_rss(spark, tmp_path):
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>Bus &amp; tram</title><link>http://a/1</link><description>&lt;p&gt;New &lt;img src=\"i.png\"/&gt; line&lt;/p&gt;</description><pubDate>Fri, 05 Jan 2024 10:00:00 +0000</pubDate></item><item><title>Old bus</title><link>http://a/2</link><description>x</description><pubDate>Fri, 05 Jan 2020 10:00:00 +0000</pubDate></item></channel></rss>")
    rows = R.read_rss(spark, str(tmp_path / "f.xml"), "s", "2024-01-06 00:00:00", keywords=["TRAM"]).collect()
    assert [(r.title, r.link, r.summary, r.image_url) for r in rows] == [("Bus & tram", "http://a/1", "New line", "i.png")]


def test_pages(spark):
    html = '<a class="x" href="/threads/12?p=2">One thread</a><a href="/threads/12#z">again</a><a href="/n?t=1704400000">Patch notes</a><a href="/b">abc</a>'
    pages = spark.createDataFrame([(1, html), (2, None)], "page_id bigint, html string")
    assert [(r.link, r.label) for r in R.forum_threads(pages).collect()] == [("/threads/12", "One thread")]
    assert [r.title for r in R.notices(pages, "board", ["patch"]).collect()] == ["Patch notes"]
    assert [r.title for r in R.patch_notes(pages, "2024-01-06 00:00:00").collect()] == ["Patch notes"]
    posts = spark.createDataFrame([(1, '<li id="post_7"><span class="date">Today, 1:00</span><div id="post_message_7">Hi <b>all</b></div></li>')], "page_id bigint, html string")
    assert [(r.post_id, r.raw_time, r.text) for r in R.forum_posts(posts).collect()] == [(7, "Today, 1:00", "Hi all")]


def test_files(spark, tmp_path):
    (tmp_path / "kb.md").write_text("# x\n| jp | tw | en |\n|---|:-:|---|\n| あ | 阿 | a |\n| short |\n")
    assert [tuple(r) for r in R.read_markdown_table(spark, str(tmp_path / "kb.md"), ["jp", "tw", "en"]).collect()] == [("あ", "阿", "a")]
    lines = [{"title": "t", "label": "on"}, {"title": "t", "label": "off"}, {"title": "u", "label": " "}]
    (tmp_path / "l.jsonl").write_text("\n".join(map(json.dumps, lines)))
    rows, conflicts = R.read_labels(spark, str(tmp_path / "l.jsonl"))
    assert rows.where("label is null").count() == 1 and [r.title for r in conflicts.collect()] == ["t"]
    (tmp_path / "log").write_text('GET x?link=in.(%22a%22,%22b%22)&y\nGET x?link=in.(%22b%22)')
    assert sorted(r.link for r in R.links_from_log(spark, str(tmp_path / "log")).collect()) == ["a", "b"]


def test_fetch_and_enrich(spark):
    urls = spark.createDataFrame([("a",), ("b",)], "url string")

    def fetch(url):
        if url == "b":
            raise OSError("down")
        return 200, "<p>ok</p>"

    got = {r.url: (r.status, r.error) for r in R.fetch_pages(urls, fetch).collect()}
    assert got == {"a": (200, None), "b": (None, "OSError: down")}
    a = spark.createDataFrame([("l", "T", "short", "", None)], "link string, title string, summary string, image_url string, published timestamp")
    r = spark.createDataFrame([("l", "u", "x" * 40, "i", None)], "link string, url string, og_summary string, og_image string, page_published timestamp")
    assert R.enrich(a, r).select("link", "summary", "image_url").first() == ("u", "x" * 40, "i")
    v = spark.createDataFrame([("t", "d", None, "PT2M", "2024-01-05 00:00:00"), ("t", "d", "s", "PT30S", "2024-01-05 00:00:00")], "title string, description string, transcript string, duration string, p string").withColumn("published", F.to_timestamp("p"))
    assert [r.summary for r in R.videos(v, "2024-01-06 00:00:00").collect()] == ["t\nd"]


def test_streaming_weeks_match_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    events = spark.read.parquet(f"{DATA}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.write.mode("overwrite").parquet(str(tmp_path / "in"))
    s = flows.weekly_counts(flows.read_events(spark, str(tmp_path / "in")))
    flows.run_available(s, str(tmp_path / "out"), str(tmp_path / "cp"), "append")
    closed = spark.read.parquet(str(tmp_path / "out"))
    w = F.window("ts", "7 days", "7 days", "4 days")
    batch = {(r.week, r.event_type): r.n for r in events.groupBy(w.start.alias("week"), "event_type").agg(F.count(F.lit(1)).alias("n")).collect()}
    got = {(r.week, r.event_type): r.n for r in closed.collect()}
    assert got and all(batch[k] == n for k, n in got.items())


def test_streaming_insert_ignore_is_idempotent(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k bigint, v string").write.parquet(str(tmp_path / "in"))
    for run in ("1", "2"):
        df = spark.readStream.schema("k bigint, v string").parquet(str(tmp_path / "in"))
        flows.insert_ignore_batches(df, str(tmp_path / "out"), str(tmp_path / f"cp{run}"), ["k"])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_sinks(spark, tmp_path):
    from newsloom.sources import sinks

    a = spark.createDataFrame([("2024-W01", "高", ["x", ""]), ("2024-W01", "低", ["x", "y"]), ("2024-W02", "高", [])], "week_id string, importance string, tags array<string>")
    old = spark.createDataFrame([("2024-W01", 9, 9), ("2023-W52", 1, 0)], "week_id string, article_count bigint, high_count bigint")
    assert [tuple(r) for r in sinks.week_index(a, old).collect()] == [("2024-W02", 1, 1), ("2024-W01", 2, 1), ("2023-W52", 1, 0)]
    assert {r.tag: r.n for r in sinks.tag_totals(a, spark.createDataFrame([("x", 5)], "tag string, n bigint")).collect()} == {"x": 7, "y": 1}
    sinks.write_weeks(a, str(tmp_path / "w"))
    sinks.write_weeks(a.where("week_id = '2024-W02'"), str(tmp_path / "w"))
    assert spark.read.json(str(tmp_path / "w")).count() == 3
    items = spark.createDataFrame([("<item>1</item>", "2024-01-01"), ("<item>2</item>", "2024-01-02")], "item string, published string")
    sinks.feed(items, "t", "l", str(tmp_path / "f"), limit=1)
    assert "<item>2</item></channel>" in spark.read.text(str(tmp_path / "f")).first()[0]


def test_term_base(spark):
    from newsloom.operators import knowledge as K

    rows = spark.createDataFrame([(1, "a [[x]] b [[y]]"), (2, "none"), (3, None), (4, "[[x]][[x]]")], "id bigint, text string")
    values = K.precedence(spark.createDataFrame([("x", "1")], "term string, value string"), spark.createDataFrame([("x", "2")], "term string, value string"))
    assert {r.id: r.text for r in K.rewrite_markers(rows, values).collect()} == {1: "a 2 b y", 2: "none", 3: None, 4: "22"}
    repeated = spark.createDataFrame([(1, "a [[x]] b"), (1, "c [[y]] d"), (1, "a [[x]] b"), (None, "[[x]]"), (2, "")], "id long, text string")
    twice = spark.createDataFrame([("x", "X"), ("x", "W")], "term string, value string")
    assert sorted((str(r.id), r.text) for r in K.rewrite_markers(repeated, twice).collect()) == [("1", "a X b"), ("1", "a X b"), ("1", "c y d"), ("2", ""), ("None", "X")]
    none = spark.createDataFrame([], "term string")
    assert sorted((r.id, r.term) for r in K.unknown_terms(rows, values, none).collect()) == [(1, "y")]


def test_atom_lists_details_and_ledes(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<feed><entry><title>Tram news</title><link href="http://a/1" rel="alternate"/><summary>&lt;b&gt;line&lt;/b&gt; two</summary><updated>2024-01-05T10:00:00Z</updated><id>x</id></entry><entry><title>Old</title><link href="http://a/2"/><updated>2020-01-05T10:00:00Z</updated><id>y</id></entry></feed>')
    assert [(r.title, r.link, r.summary) for r in R.read_atom(spark, str(tmp_path / "a.xml"), "s", "2024-01-06 00:00:00").collect()] == [("Tram news", "http://a/1", "line two")]
    html = '<ul><li><a href="/d1">Patch <b>one</b></a><script>t(1704400000)</script></li><li><a href="/d2">[Ad] x</a><script>t(1704400000)</script></li><li><a href="/d3">Undated</a></li></ul><div class="body">  First\n part </div>'
    pages = spark.createDataFrame([(1, html)], "page_id bigint, html string")
    items = R.listed_items(pages, r'(?s)<li><a href="([^"]*)">(.*?)</a>.*?</li>', "2024-01-06 00:00:00", r"t\((\d+)\)", ("[Ad]",))
    assert [(r.title, r.link) for r in items.collect()] == [("Patch one", "/d1")]
    assert R.detail_text(pages, r'(?s)<div class="body">(.*?)</div>').first().detail == "First part"
    body = "<div><p>short</p></div><article><p>" + "a" * 200 + "</p><p>tiny</p><p>" + "b" * 100 + "</p><p>" + "c" * 100 + "</p></article>"
    got = {r.page_id: r.lede for r in R.lede(spark.createDataFrame([(1, body), (2, None), (3, "<p>x</p>")], "page_id bigint, html string")).collect()}
    assert got == {1: "a" * 200 + " " + "b" * 100, 2: "", 3: ""}


def test_thread_walk_and_fallbacks(spark):
    post = lambda i, t, x: f'<li id="post_{i}"><span class="date">{t}</span><div id="post_message_{i}">{x}</div></li>'
    pages = {
        "http://f/threads/1/page2": "Page 2 of 2 " + post(12, "01-03-2024 10:00 AM", "third"),
        "http://f/threads/1/page1": "Page 1 of 2 " + post(10, "12-20-2023 10:00 AM", "too old") + post(11, "01-02-2024 10:00 AM", "second"),
        "http://f/threads/2": post(20, "someday", "?"),
    }

    def fetch(url):
        return 200, pages[url]

    rows = [("http://f/threads/1", "http://f/threads/1/page2", "One"), ("http://f/threads/2", "http://f/threads/2", "Two"), ("http://f/threads/3", "http://f/threads/3", "Gone")]
    t = spark.createDataFrame(rows, "thread_url string, link string, title string").select("*", F.lit("board").alias("source"), F.to_timestamp(F.lit("2024-01-04 00:00:00")).alias("last"), F.lit("<p>last  one</p>").alias("last_html"))
    got = {r.title: r for r in R.collect_threads(spark, t, fetch, "2024-01-08 00:00:00", "2024-01-01 00:00:00", "2024-01-08 00:00:00").collect()}
    assert got["One"].summary == "[01/02 10:00] second\n[01/03 10:00] third" and got["One"].dedup_key == "forum:1:12" and got["One"].link == "http://f/threads/1?p=12"
    assert got["Two"].summary == got["Gone"].summary == "[01/04 09:00] last one" and got["Two"].dedup_key.startswith("forum:2:t")


def test_logs_labels_sources_and_policies(spark, tmp_path):
    import pytest

    (tmp_path / "run.log").write_text('link=in.("a")\nSTART\nlink=in.("b","c")\nnoise\nlink=in.("b")\nEND\nlink=in.("d")\n')
    assert sorted(r.link for r in R.links_from_log(spark, str(tmp_path / "run.log"), start="START", end="END").collect()) == ["b", "c"]
    rows = spark.createDataFrame([("t", "on", 1), ("t", "off", 2), ("u", None, 3)], "title string, label string, seq int")
    assert [tuple(r) for r in R.last_labels(rows).collect()] == [("t", "off")]
    s = R.load_sources(spark, [{"name": "a", "type": "rss"}, {"name": "b", "type": "web", "enabled": False}])
    assert [r.source for r in s.collect()] == ["a"] and R.load_sources(spark, None, required=False).count() == 0
    with pytest.raises(ValueError):
        R.load_sources(spark, None)
    feeds = spark.createDataFrame([(f"f{i % 2}", f"l{i // 2 * 2 + i % 2}") for i in range(40)], "source string, link string")
    one, two = (sorted(map(tuple, R.sample_per_feed(feeds, 3, seed).collect())) for seed in (1, 1))
    assert one == two and len(one) == 6 and len({x[1] for x in one}) == 6
    empty = spark.createDataFrame([], "x int")
    (tmp_path / "broken.json").write_text('[{"x": 1}, {"x": ')
    for bad in (lambda: spark.read.parquet(str(tmp_path / "nothing")), lambda: R.read_articles(spark, str(tmp_path / "broken.json"), "x int")):
        assert R.or_fallback(bad, empty, "open").count() == 0
        with pytest.raises(Exception):
            R.or_fallback(bad, empty, "fail").collect()
    R.validate_proposal({"sources": [{"name": "a", "type": "rss"}]})
    for wrong in ([], {"sources": {}}, {"sources": [{"name": "a"}]}, {"sources": [], "source_defaults": []}):
        with pytest.raises(ValueError):
            R.validate_proposal(wrong)
    assert R.failed_sources(spark.createDataFrame([("a", True, 0), ("b", True, 3), ("c", False, None)], "source string, ok boolean, parsed int"))


def test_sinks_and_run_modes(spark, tmp_path):
    import pytest

    from newsloom.sources import sinks

    a = spark.createDataFrame([("2024-W01", "高", "x"), ("2024-W01", "中", "y")], "week_id string, importance string, title string")
    sinks.write_weeks(a, str(tmp_path / "w"), "dry-full")
    assert not (tmp_path / "w").exists()
    sinks.write_weeks(a, str(tmp_path / "w"))
    assert spark.read.json(str(tmp_path / "w")).count() == 2
    with pytest.raises(ValueError):
        sinks.write_weeks(a, str(tmp_path / "w"), "other")
    sinks.write_artifact(a, str(tmp_path / "artifact"))
    got = R.read_articles(spark, str(tmp_path / "artifact"), "week_id string, importance string, title string")
    assert got.count() == 2
    assert [tuple(r) for r in sinks.week_index(a).collect()] == [("2024-W01", 2, 1)]
    reports = spark.createDataFrame([("2024-01-01", "a", 1.0), ("2024-01-08", "b", 2.0)], "week_start_date string, topic_label string, cumulative_score double")
    assert [r.topic_label for r in sinks.report_projection(reports).collect()] == ["b", "a"]


def test_parts_are_collected_with_their_sources_stamps(spark):
    x = spark.createDataFrame([("a", "t1")], "source string, title string")
    y = spark.createDataFrame([("b", "t2", "s")], "source string, title string, summary string")
    stamps = spark.createDataFrame([("a", 0.9), ("c", 0.1)], "source string, source_weight double")
    got = {r.source: (r.summary, r.source_weight) for r in R.collect([x, y], stamps).collect()}
    assert got == {"a": (None, 0.9), "b": ("s", None)}
