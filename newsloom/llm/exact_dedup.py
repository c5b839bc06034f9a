"""Exact dedup: group by a 128-bit content hash, compare bytes inside the groups.

Texts are equal when identical after each run of white space became one space
(null counts as empty). Of equal texts the row with the smallest doc_id stays
(null ids come last).

Plan: one scan writes the narrow digests (id, hash, SHA-256). They are counted by
(hash, id) and then by hash, so a hot hash is spread before it meets. Only rows of
groups with two or more members are read again with their text: the other rows are
left in the scan by a broadcast of the groups' hashes (if these are few enough, else by
a join). Members are compared, byte by byte, with the text of their group's keeper: a
join on the hash whose hot keys Spark splits. Rows that differ from it are a collision
and are grouped again by hash and whole text.

Edge cases: rows that share text and doc_id are copies of each other, exactly one
of them is kept; null ids group like any other and stay only when all ids of the
group are null; empty texts are equal to each other; very long texts are hashed and
compared whole; an empty table gives none; ``deduplicate`` passes extra columns of any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.operators.store import discard

from .common import WHITE, bounded, fresh, stored, table, text_of

HashOf = Callable[[Column], Column]


def normalised(text: str | Column = "text") -> Column:
    return F.regexp_replace(text_of(text), WHITE, " ")


def md5_of(norm: Column) -> Column:
    return F.md5(norm.cast("binary"))  # hex: never null, so joins need no filter that computes it twice


def duplicate_groups(docs: DataFrame, hash_of: HashOf = md5_of) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, one row per document.

    ``hash_of`` maps the normalised text to the grouping hash; tests pass a weak
    one to see collisions told apart.
    """
    norm = docs.select("doc_id", normalised().alias("norm"))
    digests = stored(norm.select("doc_id", hash_of(F.col("norm")).alias("h"), F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256")), "digests")
    per_id = digests.groupBy("h", "doc_id").agg(F.count(F.lit(1)).alias("rows"))
    groups = per_id.groupBy("h").agg(F.min("doc_id").alias("keep_id"), F.sum("rows").alias("group_size"), F.coalesce(F.min_by("rows", "doc_id"), F.sum("rows")).alias("keep_rows"))
    groups = stored(groups, "groups")
    several = stored(groups.where("group_size > 1").select("h", "keep_id"), "several")
    members = norm.select("doc_id", "norm", hash_of(F.col("norm")).alias("h")).join(bounded(several), "h")
    members = stored(members, "members")
    keeper = members.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("h").agg(F.min("norm").alias("keeper"))
    other = stored(members.select("doc_id", "h", "norm").join(keeper, "h").where(F.col("norm") != F.col("keeper")).select("doc_id", "h", "norm"), "collisions")
    discard(members, several)
    repeated = not groups.where("group_size > 1 and keep_rows > 1").isEmpty()
    if other.isEmpty():
        out = digests.join(groups.select("h", "keep_id", "group_size"), "h")
    else:
        repeated = True  # not known of the regrouped rows
        sha = F.sha2(F.col("norm").cast("binary"), 256)
        again = other.groupBy("h", "norm").agg(F.min("doc_id").alias("keep2"), F.count(F.lit(1)).alias("size2")).select("h", sha.alias("text_sha256"), "keep2", "size2")
        lost = other.groupBy("h").agg(F.count(F.lit(1)).alias("lost"))
        first = groups.join(lost, "h", "left").select("h", "keep_id", (F.col("group_size") - F.coalesce("lost", F.lit(0))).alias("group_size"))
        out = digests.join(stored(first, "groups"), "h").join(stored(again, "collision-groups"), ["h", "text_sha256"], "left")
        out = out.select("doc_id", "h", "text_sha256", F.when(F.col("size2").isNull(), F.col("keep_id")).otherwise(F.col("keep2")).alias("keep_id"), F.coalesce("size2", "group_size").alias("group_size"))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    if repeated:
        nth = F.row_number().over(Window.partitionBy("h", "text_sha256", "doc_id").orderBy(F.lit(1)))
        out = out.withColumn("nth", F.when(stays, nth).otherwise(0))
        stays = stays & (F.col("nth") == 1)
    return out.select("doc_id", "keep_id", "group_size", stays.alias("kept"), "text_sha256")


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    report = stored(duplicate_groups(docs.select("doc_id", "text")), "duplicates")
    gone = stored(report.where("not kept").select("doc_id").distinct(), "dropped-ids")
    stay = report.where("kept")
    if gone.where("doc_id is null").isEmpty() and stay.join(gone, "doc_id", "left_semi").isEmpty():
        return docs.join(bounded(gone), "doc_id", "left_anti").select(*docs.columns)
    # Ids that both stay and go: rows are told apart by their text, and of rows that share both one is taken.
    sha, nth = fresh(docs, "sha"), fresh(docs, "nth")
    stay = stay.select(F.col("doc_id").alias(fresh(docs, "stay_id")), F.col("text_sha256").alias(fresh(docs, "stay_sha")))
    marked = docs.withColumn(sha, F.sha2(normalised().cast("binary"), 256))
    hit = marked.join(stay, docs["doc_id"].eqNullSafe(stay[stay.columns[0]]) & (F.col(sha) == stay[stay.columns[1]]), "left_semi")
    return hit.withColumn(nth, F.row_number().over(Window.partitionBy("doc_id", sha).orderBy(F.lit(1)))).where(F.col(nth) == 1).select(*docs.columns)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


SQL_OP7 = r"""
with d as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents)
select doc_id, min(doc_id) over (partition by norm) as keep_id, count(*) over (partition by norm) as group_size,
  doc_id = min(doc_id) over (partition by norm) as kept, sha256(norm) as text_sha256
from d
"""
