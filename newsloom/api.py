"""The read API as functions that return DataFrames; the caller renders them.

articles: id, title, source, week_id, importance (null: 中), tags, analysis, published, ...
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

IMPORTANCE = ("高", "中", "低")
MOST = 100


def page(limit, offset) -> tuple[int, int]:
    """A limit of 1 to MOST (else MOST) and an offset of 0 or more (else 0), whatever came in."""

    def number(value, low: int, default: int) -> int:
        try:
            n = int(value)
        except (TypeError, ValueError):
            return default
        return n if n >= low else default

    return min(number(limit, 1, MOST), MOST), number(offset, 0, 0)


def _importance():
    return F.coalesce("importance", F.lit("中"))


def weeks(articles: DataFrame) -> DataFrame:
    """week_id, article_count, high_count; newest first."""
    a = articles.where("week_id is not null").groupBy("week_id")
    return a.agg(F.count(F.lit(1)).alias("article_count"), F.count_if(_importance() == "高").alias("high_count")).orderBy(F.col("week_id").desc())


def week(articles: DataFrame, week_id: str, content_type: str | None = None, importance: str | None = None, tag: str | None = None, q: str | None = None, limit=MOST, offset=0) -> DataFrame:
    """A page of a week by importance and time, with the total. Unknown values of importance are ignored."""
    a = articles.where(F.col("week_id") == week_id).withColumn("importance", _importance())
    if content_type:
        a = a.where(F.col("content_type") == content_type)
    if importance in IMPORTANCE:
        a = a.where(F.col("importance") == importance)
    if tag:
        a = a.where(F.array_contains("tags", tag))
    if q:
        text = F.lower(F.concat_ws(" ", *[c for c in ("title", "source", "summary", "analysis") if c in a.columns], F.array_join("tags", " ")))
        a = a.where(F.contains(text, F.lit(q.lower())))
    rank = F.when(F.col("importance") == "高", 0).when(F.col("importance") == "低", 2).otherwise(1)
    time = F.coalesce("published", "created_at") if "created_at" in a.columns else F.col("published")
    n, start = page(limit, offset)
    total = a.agg(F.count(F.lit(1)).alias("total"))  # one row
    return a.orderBy(rank, time.desc(), "id").offset(start).limit(n).join(F.broadcast(total))


def tags(articles: DataFrame) -> DataFrame:
    """tag, n; most frequent first."""
    each = articles.select(F.explode("tags").alias("tag")).where("tag <> ''")
    return each.groupBy("tag").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "tag")


def hot_topics(reports: DataFrame) -> DataFrame:
    """Reports, newest week and best score first."""
    return reports.orderBy(F.col("week_start_date").desc(), F.col("cumulative_score").desc())


def feed(articles: DataFrame, limit: int = 60) -> DataFrame:
    """The newest articles for a feed."""
    return articles.orderBy(F.col("created_at").desc(), "id").limit(limit)
