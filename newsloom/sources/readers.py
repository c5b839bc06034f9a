"""Sources: feeds, pages, forum threads, JSON artifacts, markdown tables, logs, labels.

Everything is read with Spark's readers and parsed by built-in expressions; network
input enters through ``HttpSource`` alone, with an injected ``fetch``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions import markup
from newsloom.functions.text import duration_seconds, forum_time, parse_published, strip_tags

ITEM = "title STRING, link STRING, description STRING, pubDate STRING, guid STRING"


def read_rss(spark: SparkSession, path: str, source: str, as_of: str, lookback_days: int = 7, keywords: list[str] | None = None) -> DataFrame:
    """Items of RSS files that are recent and, with keywords, name one of them."""
    raw = spark.read.format("xml").option("rowTag", "item").schema(ITEM).load(path)
    a = raw.select(
        F.trim("title").alias("title"), F.coalesce("link", "guid").alias("link"), F.lit(source).alias("source"),
        parse_published(F.col("pubDate")).alias("published"), F.substring(strip_tags(F.coalesce("description", F.lit(""))), 1, 500).alias("summary"),
        F.regexp_extract("description", r'<img[^>]*src="([^"]*)"', 1).alias("image_url"),
    )
    return recent(a, as_of, lookback_days, keywords)


ENTRY = "title STRING, link ARRAY<STRUCT<_href: STRING, _rel: STRING>>, summary STRING, content STRING, updated STRING, published STRING, id STRING"


def read_atom(spark: SparkSession, path: str, source: str, as_of: str, lookback_days: int = 7, keywords: list[str] | None = None) -> DataFrame:
    """Entries of Atom files, as ``read_rss`` gives items."""
    raw = spark.read.format("xml").option("rowTag", "entry").schema(ENTRY).load(path)
    link = F.coalesce(F.get(F.filter("link", lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate"), F.lit(0))["_href"], F.col("id"))
    body = F.coalesce("summary", "content", F.lit(""))
    a = raw.select(
        F.trim("title").alias("title"), link.alias("link"), F.lit(source).alias("source"), parse_published(F.coalesce("published", "updated")).alias("published"),
        F.substring(strip_tags(body), 1, 500).alias("summary"), F.regexp_extract(body, r'<img[^>]*src="([^"]*)"', 1).alias("image_url"),
    )
    return recent(a, as_of, lookback_days, keywords)


def recent(a: DataFrame, as_of: str, lookback_days: int, keywords: list[str] | None) -> DataFrame:
    """Rows of the last days that name a keyword; without keywords (always relevant feeds) all of the last days."""
    a = a.where(F.col("published") >= F.to_timestamp(F.lit(as_of)) - F.expr(f"interval {lookback_days} days"))
    if keywords:
        text = F.lower(F.concat_ws(" ", "title", "summary"))
        a = a.where(F.exists(F.array(*map(F.lit, keywords)), lambda k: F.contains(text, F.lower(k))))
    return a


def page_anchors(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages with href, label and seq of each anchor, however its address is quoted."""
    return markup.links(pages, html)


def notices(pages: DataFrame, name: str, keywords: list[str], max_items: int = 10, key: str = "page_id") -> DataFrame:
    """Anchors of at least five characters that name a keyword, the first of each page."""
    a = page_anchors(pages).where(F.length("label") >= 5)
    if keywords:
        a = a.where(F.exists(F.array(*map(F.lit, keywords)), lambda k: F.contains(F.lower("label"), F.lower(k))))
    nth = F.row_number().over(Window.partitionBy(key).orderBy("seq"))
    return a.withColumn("nth", nth).where(F.col("nth") <= max_items).select(key, F.col("label").alias("title"), F.col("href").alias("link"), F.lit(f"{name} 官方公告").alias("summary"), F.lit(None).cast("timestamp").alias("published"))


def patch_notes(pages: DataFrame, as_of: str, excluded: tuple[str, ...] = (), days: int = 7, max_items: int = 15, key: str = "page_id") -> DataFrame:
    """Anchors with an epoch in their address (ldst_strftime style ``?t=``), inside the window."""
    a = page_anchors(pages).where(F.length("label") >= 3)
    for prefix in excluded:
        a = a.where(~F.startswith("label", F.lit(prefix)))
    epoch = F.regexp_extract("href", r"[?&]t=(\d{9,10})", 1).try_cast("bigint")
    a = a.withColumn("published", F.timestamp_seconds(epoch)).where(F.col("published") >= F.to_timestamp(F.lit(as_of)) - F.expr(f"interval {days} days"))
    nth = F.row_number().over(Window.partitionBy(key).orderBy("seq"))
    return a.withColumn("nth", nth).where(F.col("nth") <= max_items).select(key, F.col("label").alias("title"), F.col("href").alias("link"), "published")


def listed_items(pages: DataFrame, item: str, as_of: str, date: str | None = None, excluded: tuple[str, ...] = (), days: int = 7, max_items: int = 15, key: str = "page_id") -> DataFrame:
    """Items of list pages: ``item`` is a pattern whose groups are the address and the title, ``date`` one whose group is
    an epoch. With a date pattern, items without a date are outside the window."""
    found = pages.select(key, F.posexplode(F.regexp_extract_all("html", F.lit(item), F.lit(0))).alias("seq", "_i"))
    a = found.select(key, "seq", "_i", F.regexp_extract("_i", item, 1).alias("link"), strip_tags(F.regexp_extract("_i", item, 2)).alias("title")).where(F.length("title") >= 3)
    for prefix in excluded:
        a = a.where(~F.startswith("title", F.lit(prefix)))
    a = a.withColumn("published", F.timestamp_seconds(F.regexp_extract("_i", date, 1).try_cast("bigint")) if date else F.lit(None).cast("timestamp"))
    if date:
        a = a.where(F.col("published") >= F.to_timestamp(F.lit(as_of)) - F.expr(f"interval {days} days"))
    nth = F.row_number().over(Window.partitionBy(key).orderBy("seq"))
    return a.withColumn("nth", nth).where(F.col("nth") <= max_items).select(key, "title", "link", "published")


def detail_text(pages: DataFrame, node: str, max_chars: int = 2000, html: str = "html") -> DataFrame:
    """pages with ``detail``: the text of the first node that the pattern's group finds, blanks collapsed, cut; "" without one."""
    return pages.withColumn("detail", F.substring(strip_tags(F.coalesce(F.regexp_extract(html, node, 1), F.lit(""))), 1, max_chars))


def lede(pages: DataFrame, least: int = 20, enough: int = 260, most: int = 400, key: str = "page_id") -> DataFrame:
    """The opening of each page: paragraphs of at least ``least`` characters of the container with most paragraph
    text, until ``enough`` characters are there, cut at ``most``. Containers are articles, sections and divs without
    another inside, and the whole page."""
    containers = F.concat(F.regexp_extract_all("html", F.lit(r"(?s)<(?:article|section|div)[^>]*>((?:(?!<(?:article|section|div)\b).)*?)</(?:article|section|div)>"), F.lit(1)), F.array("html"))
    c = pages.where("html is not null").select(key, F.posexplode(containers).alias("c", "part"))
    p = c.select(key, "c", F.posexplode(F.transform(F.regexp_extract_all("part", F.lit(r"(?s)<p[^>]*>(.*?)</p>"), F.lit(1)), strip_tags)).alias("i", "t")).where(F.length("t") >= least)
    size = p.groupBy(key, "c").agg(F.sum(F.length("t")).alias("size"), F.sort_array(F.collect_list(F.struct("i", "t"))).alias("ps"))
    best = size.groupBy(key).agg(F.max_by("ps", F.struct("size", (-F.col("c")).alias("c"))).alias("ps"))
    text = F.aggregate("ps", F.lit(""), lambda s, x: F.when(F.length(s) > enough, s).otherwise(F.trim(F.concat(s, F.lit(" "), x["t"]))))
    return pages.select(key).join(best, key, "left").select(key, F.coalesce(F.substring(text, 1, most), F.lit("")).alias("lede"))


def forum_threads(pages: DataFrame, max_items: int = 15, key: str = "page_id") -> DataFrame:
    """Thread links of forum pages, one a thread (query and fragment aside)."""
    a = page_anchors(pages).where(F.col("href").rlike(r"threads/\d+")).withColumn("base", F.regexp_replace("href", r"[?#].*$", ""))
    first = a.groupBy(key, "base").agg(F.min_by(F.struct("label", "href"), "seq").alias("f"), F.min("seq").alias("seq"))
    nth = F.row_number().over(Window.partitionBy(key).orderBy("seq"))
    return first.withColumn("nth", nth).where(F.col("nth") <= max_items).select(key, "f.label", F.col("base").alias("link"), F.concat(F.lit("[JP Forum] "), F.col("f.label")).alias("summary"))


def forum_posts(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Posts of thread pages: id, raw time and text of every ``post_`` list item."""
    items = F.regexp_extract_all("html", F.lit(r'(?s)<li[^>]*id="post_\d+".*?</li>'), F.lit(0))
    p = pages.select(key, F.posexplode(items).alias("seq", "post"))
    body = F.regexp_extract("post", r'(?s)id="post_message_\d+"[^>]*>(.*?)</(?:div|blockquote)>', 1)
    return p.select(key, "seq", F.regexp_extract("post", r'id="post_(\d+)"', 1).cast("bigint").alias("post_id"), strip_tags(F.regexp_extract("post", r'(?s)class="date"[^>]*>(.*?)</span>', 1)).alias("raw_time"), strip_tags(body).alias("text"))


def previous_page(html: Column, thread_url: Column) -> Column:
    """The address of the page before, by ``Page n of m``; null on the first."""
    n = F.regexp_extract(html, r"Page (\d+) of \d+", 1).try_cast("int")
    return F.when(n > 1, F.concat(thread_url, F.lit("/page"), (n - 1).cast("string")))


def collect_threads(spark: SparkSession, threads: DataFrame, fetch: Callable[[str], tuple[int, str]], now: str, start: str, end: str, max_pages: int = 3, max_replies: int = 20, max_chars: int = 6000) -> DataFrame:
    """threads: thread_url, link, title, source, last (UTC time of the feed's last reply), last_html. One article a thread.

    Pages are fetched backwards, all threads at once, round by round (``max_pages`` at most),
    until a page is older than the window [start, end), the replies suffice or there is no
    page before. A thread whose page fails, has no posts or a time that cannot be read falls
    back to the feed's last reply, if that is in the window; threads without replies give none.
    """
    from newsloom.operators.store import stored
    from newsloom.operators.topics import merge_replies

    at = lambda t: F.to_timestamp(F.lit(t))
    thread_id = F.regexp_extract("thread_url", r"threads/(\d+)", 1)
    base = stored(threads.withColumn("thread", thread_id), "threads")
    todo, posts, failed = base.select("thread", "thread_url", F.col("link").alias("url"), F.lit(0).cast("bigint").alias("have")), None, None
    for _ in range(max_pages):
        got = stored(todo.join(fetch_pages(todo, fetch), "url", "left"), "thread-pages")
        p = forum_posts(got, "thread").withColumn("time", forum_time(F.col("raw_time"), at(now)))
        p = stored(p.select("thread", F.col("post_id").alias("id"), "time", "text"), "thread-posts")
        seen = p.groupBy("thread").agg(F.count_if(F.col("time").isNull()).alias("bad"), F.min("time").alias("oldest"), F.count_if((F.col("time") >= at(start)) & (F.col("time") < at(end))).alias("n"))
        state = stored(got.join(seen, "thread", "left").select("thread", "thread_url", "html", "oldest", (F.col("have") + F.coalesce("n", F.lit(0))).alias("have"), (F.col("bad").isNull() | (F.col("bad") > 0)).alias("broken")), "thread-state")
        wrong = state.where("broken").select("thread")
        posts, failed = (p, wrong) if posts is None else (posts.union(p), failed.union(wrong))
        more = state.where(~F.col("broken") & (F.col("oldest") >= at(start)) & (F.col("have") < max_replies)).withColumn("url", previous_page(F.col("html"), F.col("thread_url")))
        todo = stored(more.where("url is not null").select("thread", "thread_url", "url", "have"), "thread-todo")
        if todo.isEmpty():
            break
    inside = (F.col("time") >= at(start)) & (F.col("time") < at(end))
    good = posts.join(failed, "thread", "left_anti").where(inside)
    back = base.join(failed.distinct(), "thread", "left_semi").select("thread", F.lit(0).cast("bigint").alias("id"), F.col("last").alias("time"), strip_tags(F.col("last_html")).alias("text")).where(inside)
    merged = merge_replies(good.unionByName(back), max_replies, max_chars)
    newest = good.unionByName(back).groupBy("thread").agg(F.max(F.struct("time", "id")).alias("top"))
    j = base.join(merged, "thread").join(newest, "thread")
    own, epoch = F.col("top.id") > 0, F.unix_timestamp("top.time").cast("string")
    return j.select(
        "title", F.when(own, F.concat("thread_url", F.lit("?p="), F.col("top.id").cast("string"))).otherwise(F.concat("thread_url", F.lit("?lastpost="), epoch)).alias("link"), F.col("merged").alias("summary"), "source", F.col("top.time").alias("published"),
        F.when(own, F.concat(F.lit("forum:"), "thread", F.lit(":"), F.col("top.id").cast("string"))).otherwise(F.concat(F.lit("forum:"), "thread", F.lit(":t"), epoch)).alias("dedup_key"), "replies",
    )


def videos(rows: DataFrame, as_of: str, days: int = 2, least_seconds: int = 60) -> DataFrame:
    """Recent videos that are no shorts; the transcript, or title and description."""
    recent = F.col("published") >= F.to_timestamp(F.lit(as_of)) - F.expr(f"interval {days} days")
    text = F.coalesce("transcript", F.concat_ws("\n", "title", F.substring("description", 1, 500)))
    return rows.where(recent & (duration_seconds(F.col("duration")) > least_seconds)).withColumn("summary", text)


def collect(parts: list[DataFrame], sources: DataFrame) -> DataFrame:
    """All parts in order, with what the source list stamps on them (weights, look-back, exemptions)."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    return rows.join(sources, "source", "left")


def read_articles(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A JSON artifact of the declared shape; anything else fails."""
    return spark.read.option("multiLine", True).option("mode", "FAILFAST").schema(schema).json(path)


def read_markdown_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Rows of markdown tables with at least as many cells as columns; heads and rules are skipped."""
    cells = F.transform(F.split(F.regexp_replace(F.trim("value"), r"^\||\|$", ""), r"\|"), lambda c: F.trim(c))
    rows = spark.read.text(path).where(F.startswith(F.trim("value"), F.lit("|"))).select(cells.alias("c"))
    rows = rows.where((F.size("c") >= len(columns)) & ~F.forall("c", lambda x: x.rlike(r"^:?-+:?$")))
    return rows.where(F.lower(F.col("c")[0]) != columns[0].lower()).select(*[F.col("c")[i].alias(n) for i, n in enumerate(columns)])


def read_labels(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Labels of a JSONL file (blank is untouched) and the titles labelled in two ways."""
    rows = spark.read.schema("week_id string, major_category string, title string, source string, label string, note string").json(path)
    rows = rows.withColumn("label", F.nullif(F.trim(F.coalesce("label", F.lit(""))), F.lit("")))
    conflicts = rows.where("label is not null").groupBy("title").agg(F.count_distinct("label").alias("n")).where("n > 1").select("title")
    return rows, conflicts


def last_labels(rows: DataFrame) -> DataFrame:
    """One label a title: of several labelled rows the last (rows: title, label, seq)."""
    return rows.where("label is not null").groupBy("title").agg(F.max_by("label", "seq").alias("label"))


def load_sources(spark: SparkSession, sources: list[dict] | None, required: bool = True) -> DataFrame:
    """The enabled sources of a parsed settings list, in order; without a list none, or an error where it is required."""
    if sources is None and required:
        raise ValueError("no source list")
    rows = [(i, s["name"], s["type"], s.get("url"), s.get("weight"), s.get("lookback_days"), bool(s.get("relevance_exempt", False))) for i, s in enumerate(sources or []) if s.get("enabled", True)]
    return spark.createDataFrame(rows, "place int, source string, type string, url string, source_weight double, lookback_days int, relevance_exempt boolean")


def sample_per_feed(rows: DataFrame, n: int, seed: int = 0, feed: str = "source", link: str = "link") -> DataFrame:
    """n random rows of each feed with different links; the same rows for the same seed."""
    one = rows.dropDuplicates([link])
    nth = F.row_number().over(Window.partitionBy(feed).orderBy(F.xxhash64(link, F.lit(seed)), link))
    return one.withColumn("_nth", nth).where(F.col("_nth") <= n).drop("_nth")


def log_window(lines: DataFrame, start: str, end: str) -> DataFrame:
    """lines: file, seq, value. The lines of each file from the first that holds ``start`` up to the next that holds ``end``."""
    first = lines.where(F.contains("value", F.lit(start))).groupBy("file").agg(F.min("seq").alias("from"))
    inside = lines.join(first, "file").where(F.col("seq") >= F.col("from"))
    last = inside.where(F.contains("value", F.lit(end))).groupBy("file").agg(F.min("seq").alias("to"))
    return inside.join(last, "file").where(F.col("seq") <= F.col("to")).select("file", "seq", "value")


def links_from_log(spark: SparkSession, path: str, pattern: str = r"link=in\.\(([^)]*)\)", start: str | None = None, end: str | None = None) -> DataFrame:
    """Distinct links in the query strings of a log; with anchors only between them (a log file is one row then)."""
    if start and end:
        whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split("value", "\n")).alias("seq", "value"))
        lines = log_window(whole, start, end).select("value")
    else:
        lines = spark.read.text(path)
    found = lines.select(F.explode(F.regexp_extract_all("value", F.lit(pattern), F.lit(1))).alias("q"))
    return found.select(F.explode(F.split(F.try_url_decode("q"), ",")).alias("link")).select(F.trim(F.translate("link", '"', "")).alias("link")).where("link <> ''").distinct()


def enrich(articles: DataFrame, resolved: DataFrame) -> DataFrame:
    """Summaries, images and dates of resolved pages (link, url, og_summary, og_image, page_published).

    A summary is replaced by one of at least 40 characters that is not the title, an
    image only where none is, the published time by the page's.
    """
    a = articles.join(resolved, "link", "left")
    better = (F.length("og_summary") >= 40) & (F.col("og_summary") != F.col("title"))
    return a.select(*[c for c in articles.columns if c not in ("link", "summary", "image_url", "published")], F.coalesce("url", "link").alias("link"), F.when(better, F.col("og_summary")).otherwise(F.col("summary")).alias("summary"), F.coalesce(F.nullif("image_url", F.lit("")), "og_image").alias("image_url"), F.coalesce("page_published", "published").alias("published"))


def fetch_pages(urls: DataFrame, fetch: Callable[[str], tuple[int, str]]) -> DataFrame:
    """url -> status, html, error through ``fetch``, which runs in the tasks. Materialise the result once."""

    def run(batches):
        import pandas as pd

        for b in batches:
            rows = []
            for url in b["url"]:
                try:
                    rows.append((url, *fetch(url), None))
                except Exception as e:  # the row says what went wrong
                    rows.append((url, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["url", "status", "html", "error"])

    return urls.select("url").mapInPandas(run, "url string, status int, html string, error string")


def or_fallback(read: Callable[[], DataFrame], fallback: DataFrame | None, policy: str = "fail") -> DataFrame:
    """What ``read`` gives. If it fails: the error (policy fail), or the fallback (policy open: history without rows,
    prior reports without rows, candidates as they are). The policy is always named by the caller.

    Under policy open the rows are read and stored at once, so that a file which breaks while it is read counts too.
    """
    if policy not in ("fail", "open"):
        raise ValueError(f"unknown policy: {policy}")
    if policy == "fail" or fallback is None:
        return read()
    try:
        return stored(read(), "or-fallback")
    except Exception:
        return fallback


def validate_proposal(data) -> None:
    """A proposed source list: sources with name and type, and optional defaults by source name; else ValueError."""
    if not isinstance(data, dict) or not isinstance(data.get("sources"), list):
        raise ValueError("a proposal is a mapping with a list of sources")
    for i, s in enumerate(data["sources"]):
        if not isinstance(s, dict) or not all(str(s.get(k) or "").strip() for k in ("name", "type")):
            raise ValueError(f"source {i} needs a name and a type")
    if not isinstance(data.get("source_defaults", {}), dict):
        raise ValueError("source_defaults is a mapping of name parts to categories")


def failed_sources(attempts: DataFrame, most: float = 0.5) -> bool:
    """More than the share of sources failed or parsed to nothing (attempts: source, ok, parsed)."""
    bad, n = attempts.select(F.count_if(~F.col("ok") | (F.coalesce("parsed", F.lit(0)) == 0)), F.count_distinct("source")).first()
    return n > 0 and bad / n > most
