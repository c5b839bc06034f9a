"""Sinks: week snapshots, their index, cumulative tags, feeds and JSON artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators.store import Store


def writes(mode: str) -> bool:
    """Whether a run of this mode may write; unknown modes are errors."""
    if mode not in Store.MODES:
        raise ValueError(f"unknown run mode: {mode}")
    return mode == "formal"


def write_weeks(articles: DataFrame, path: str, mode: str = "formal") -> None:
    """One folder a week; a week that is written again replaces its own folder only."""
    if not writes(mode):
        return
    articles.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("week_id").json(path)


def week_index(articles: DataFrame, old: DataFrame | None = None) -> DataFrame:
    """week_id, article_count, high_count, newest week first; new weeks replace their old entry."""
    new = articles.groupBy("week_id").agg(F.count(F.lit(1)).alias("article_count"), F.count_if(F.col("importance") == "高").alias("high_count"))
    if old is not None:
        new = old.join(new.select("week_id"), "week_id", "left_anti").unionByName(new)
    return new.orderBy(F.col("week_id").desc())


def tag_totals(articles: DataFrame, old: DataFrame | None = None) -> DataFrame:
    """tag, n: the counts so far and those of these articles; empty tags do not count."""
    new = articles.select(F.explode("tags").alias("tag")).where("tag <> ''").groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
    both = new if old is None else old.unionByName(new)
    return both.groupBy("tag").agg(F.sum("n").alias("n"))


def feed(items: DataFrame, title: str, link: str, path: str, limit: int = 60, mode: str = "formal") -> None:
    """An RSS file of the newest items (item: a rendered element; published)."""
    if not writes(mode):
        return
    newest = items.orderBy(F.col("published").desc(), "item").limit(limit)
    body = newest.agg(F.array_join(F.transform(F.reverse(F.array_sort(F.collect_list(F.struct("published", "item")))), lambda x: x["item"]), "").alias("b"))
    xml = F.concat(F.lit(f'<?xml version="1.0" encoding="UTF-8"?><rss version="2.0"><channel><title>{title}</title><link>{link}</link>'), F.coalesce("b", F.lit("")), F.lit("</channel></rss>"))
    body.select(xml.alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_artifact(df: DataFrame, path: str) -> None:
    """A dry run's table as JSON lines; an artifact is no publication, so every mode writes it."""
    df.write.mode("overwrite").json(path)


def report_projection(reports: DataFrame) -> DataFrame:
    """What is published of a report, newest week and best score first."""
    cols = [c for c in ("week_start_date", "topic_label", "report_text", "source_article_count", "cumulative_score", "distinct_sources") if c in reports.columns]
    return reports.select(*cols).orderBy(F.col("week_start_date").desc(), F.col("cumulative_score").desc())
