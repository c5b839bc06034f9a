"""Keyed tables as Parquet: insert-ignore, upsert, expiry, flags, and stored stages."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which all executors see; a new folder on a single machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="newsloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: the lineage ends here."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def stored_once(df: DataFrame, name: str) -> DataFrame:
    """As ``stored``; the shuffle files of the write go with its end."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        return stored(df, name)
    finally:
        conf.set(key, before)


def discard(*tables: DataFrame) -> None:
    """Delete the files of stored tables whose readers have been written; others are left alone."""
    for t in tables:
        at = getattr(t, "stored_at", None)
        if at:
            context = t.sparkSession.sparkContext
            path = context._jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def last_per_key(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(order.desc()))
    return rows.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def insert_ignore(table: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of new whose key the table lacks (to append)."""
    return new.join(table.select(*keys).distinct(), keys, "left_anti").select(*new.columns)


def upsert(table: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The table after new rows replaced those of their keys."""
    return table.join(new.select(*keys).distinct(), keys, "left_anti").select(*table.columns).unionByName(new.select(*table.columns))


def expire(table: DataFrame, expired: Column, done: Column) -> DataFrame:
    """What is left after unfinished expired rows went; a null expiry stays."""
    return table.where(~(F.coalesce(expired, F.lit(False)) & ~F.coalesce(done, F.lit(False))))


def mark(table: DataFrame, keys: DataFrame, key: str, flag: str) -> DataFrame:
    """Set the flag on the rows whose key is listed."""
    hit = keys.select(F.col(key).alias("_k")).distinct()
    joined = table.join(hit, table[key] == hit["_k"], "left")
    return joined.withColumn(flag, F.when(F.col("_k").isNotNull(), True).otherwise(F.col(flag))).drop("_k")


def overlay(held: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The table and the new rows whose key it lacks, as a run that wrote them would see it."""
    return held.unionByName(new.join(held.select(key), key, "left_anti").select(*held.columns))


def buffer_rows(rows: DataFrame, link: str, order: str, now: Column, weeks: int) -> DataFrame:
    """The first row of each link, with its expiry and an open flag."""
    first = rows.groupBy(link).agg(F.min_by(F.struct(*[c for c in rows.columns if c != link]), order).alias("first")).select(link, "first.*")
    return first.withColumn("buffer_expires_at", now + F.expr(f"interval {7 * weeks} days")).withColumn("analysed", F.lit(False))


def upsert_reports(reports: DataFrame, new: DataFrame, rows: DataFrame, keys: list[str], links: str, link: str, flag: str) -> tuple[DataFrame, DataFrame]:
    """Reports after the new ones replaced those of their keys, and rows with the new reports' links marked."""
    return upsert(reports, new, keys), mark(rows, new.select(F.explode(links).alias(link)), link, flag)


def backfill(stale: DataFrame, now: DataFrame, made: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Vectors that were missing (stale: id, vector) filled from ``made`` where they are missing still.

    Returns the table (of ``now``) and one row of counts: missing, written, failed (no vector
    of ``size``), skipped (filled meanwhile).
    """
    todo = stale.where("vector is null").select("id").join(made.withColumnRenamed("vector", "new"), "id", "left")
    j = now.join(todo.withColumn("asked", F.lit(True)), "id", "left")
    good = F.col("asked") & F.coalesce(F.size("new") == size, F.lit(False))
    write = good & F.col("vector").isNull()
    counts = j.agg(F.count_if("asked").alias("missing"), F.count_if(write).alias("written"), F.count_if(F.col("asked") & ~good).alias("failed"), F.count_if(good & F.col("vector").isNotNull()).alias("skipped"))
    return j.select("id", F.when(write, F.col("new")).otherwise(F.col("vector")).alias("vector")), counts


class Store:
    """A Parquet table that is replaced as a whole: a version folder and a pointer.

    Dry modes read and never write (``commit`` returns 0).
    """

    MODES = ("formal", "dry-input", "dry-full")

    def __init__(self, spark: SparkSession, path: str, mode: str = "formal") -> None:
        if mode not in self.MODES:
            raise ValueError(f"unknown run mode: {mode}")
        self.spark, self.path, self.mode = spark, path, mode

    def read(self) -> DataFrame:
        version = self.spark.read.text(f"{self.path}/current").first()[0]
        return self.spark.read.parquet(f"{self.path}/{version}")

    def commit(self, table: DataFrame, partition_by: tuple[str, ...] = ()) -> int:
        if self.mode != "formal":
            return 0
        version = f"v-{uuid.uuid4().hex}"
        table.write.partitionBy(*partition_by).parquet(f"{self.path}/{version}")
        self.spark.createDataFrame([(version,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/current")
        return self.spark.read.parquet(f"{self.path}/{version}").count()


def consumed(pool: DataFrame, selected: DataFrame, answers: DataFrame, written: DataFrame, marked: DataFrame, label: str = "label", link: str = "link") -> DataFrame:
    """label, link of the pool's rows that digests used up.

    answers: label, text (generated); written: label, ok (the report's upsert); marked: label, ok (the flags of the
    residual). Without a text or a written report nothing of a pool is consumed; if marking the residual failed, only what was
    selected is, and the rest comes again (the report of the same key is then replaced). A missing outcome is a failure.
    """
    ok = lambda df: df.where("ok").select(label).distinct()
    done = answers.where(F.trim(F.coalesce("text", F.lit(""))) != "").select(label).distinct().join(ok(written), label, "left_semi")
    used = selected.select(label, link).distinct().join(done, label, "left_semi")
    rest = pool.select(label, link).distinct().join(selected.select(label, link).distinct(), [label, link], "left_anti").join(done.join(ok(marked), label, "left_semi"), label, "left_semi")
    return used.unionByName(rest)
