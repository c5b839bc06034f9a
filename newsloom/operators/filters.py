"""Filters of an article stream: relevance, blocks, age, history, first-of-key and caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.text import fingerprint, first_hit, strip_tags, url_date


def relevant(text: Column, include: list[str], exclude: list[str]) -> Column:
    """No excluded substring, and some included pattern (case matters)."""
    out = F.lit(False)
    for pattern in include:
        out = out | text.rlike(pattern)
    for needle in exclude:
        out = out & ~F.contains(text, F.lit(needle))
    return F.coalesce(out, F.lit(False))


def blocked(text: Column, needles: list[str]) -> Column:
    return F.coalesce(first_hit(text, needles).isNotNull(), F.lit(False))


def first_year(text: Column, low: int, high: int) -> Column:
    years = F.transform(F.regexp_extract_all(text, F.lit(r"(20\d\d)"), F.lit(1)), lambda y: y.cast("int"))
    return F.get(F.filter(years, lambda y: y.between(low, high)), F.lit(0))


def stale(text: Column, published: Column, as_of: str, days: int = 14, lookback: Column | None = None) -> Column:
    """A year before last year is named first, or else the article is older than ``days``; its age does not
    count where its source has a look-back of its own (``lookback`` not null)."""
    year = int(as_of[:4])
    named = first_year(text, 2020, year + 1)
    old = published < F.lit(as_of).cast("timestamp_ntz") - F.expr(f"interval {days} days")
    if lookback is not None:
        old = old & lookback.isNull()
    return F.when(named.isNotNull() & (named < year - 1), True).otherwise(F.coalesce(old, F.lit(False)))


def too_old(url: Column, published: Column, as_of: str, days: int = 30) -> Column:
    """Aggregator links count by the day in their address only; others by the published day."""
    limit = F.date_sub(F.lit(as_of).cast("date"), days)
    day = F.when(F.contains(url, F.lit("news.google.com")), url_date(url)).otherwise(published.cast("date"))
    return F.coalesce(day < limit, F.lit(False))


def keep_first(df: DataFrame, key: Column | str, order: str) -> DataFrame:
    """The first row of each key, exactly one; aggregates before the shuffle, so hot keys stay small.

    Rows that tie in key and order are told apart by their whole content, as far as it differs.
    """
    rows = df.withColumn("_key", key if isinstance(key, Column) else F.col(key))
    first = rows.groupBy("_key").agg(F.min_by(F.struct(*df.columns), F.struct(order, F.xxhash64(*df.columns))).alias("_first"))
    return first.select("_first.*")


def filter_chain(rows: DataFrame, as_of: str, include: list[str], exclude: list[str], topic: Column, limit: int, kinds: tuple[str, ...] = (), throttle: bool = True) -> DataFrame:
    """Collected articles in their order (``seq``) through all filters: a title, not stale, relevant (or of a kind or source
    that is exempt), the first of its title, and of each topic the first ``limit``.

    rows: seq, title, summary, published, content_type, lookback_days, relevance_exempt and more. Tags are no text.
    """
    text = strip_tags(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("summary", F.lit(""))))
    exempt = F.coalesce(F.col("content_type").isin(*kinds), F.lit(False)) | F.coalesce("relevance_exempt", F.lit(False))
    kept = rows.where((F.trim(F.coalesce("title", F.lit(""))) != "") & ~stale(text, F.col("published"), as_of, lookback=F.col("lookback_days")) & (exempt | relevant(text, include, exclude)))
    one = keep_first(kept, fingerprint(F.col("title")), "seq")
    return cap_per_key(one.withColumn("_topic", topic), "_topic", ["seq"], limit).drop("_topic") if throttle else one


def cap_per_key(df: DataFrame, key: str, order: list, limit: int) -> DataFrame:
    """At most ``limit`` rows a key; rows with a null key all pass. Spark's group limit
    drops what cannot be among them before the shuffle."""
    nth = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    capped = df.where(F.col(key).isNotNull()).withColumn("_nth", nth).where(F.col("_nth") <= limit).drop("_nth")
    return capped.unionByName(df.where(F.col(key).isNull()))


def fresh(df: DataFrame, history: DataFrame, url: Column, as_of: str, days: int) -> DataFrame:
    """Titles that history does not hold (rows with a dedup_key are exempt), young enough."""
    known = history.select("fingerprint").distinct()
    marked = df.withColumn("fingerprint", fingerprint(F.col("title")))
    new = marked.where("dedup_key is null").join(known, "fingerprint", "left_anti").unionByName(marked.where("dedup_key is not null").select("fingerprint", *[c for c in marked.columns if c != "fingerprint"]))
    return new.where(~too_old(url, F.col("published"), as_of, days)).drop("fingerprint")
