"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources, by code point with null last, weigh ``weights`` in turn, and share all
words; a target stops at ``most`` times its source's size and the excess is
reshared by weight until none is above (water filling: the sources that hit their
cap are those with the smallest cap a weight). A source first gives as many
complete epochs as fit its target. The rest is sampled without replacement:
every document has the exponential key ``-ln(u) / weight`` with u from a hash of its
id and its quality weight (share of letters and blanks in the text, at least
``floor``); keys ascend within the source and sizes are prefix-summed to the budget
that is left; the document across the budget's edge is taken if that comes nearer.

Only DataFrame operations. One scan writes (doc_id, source, size, key). Prefix sums
of a hot source never meet in one task: keys fall into ranges that hold less than a
thousandth of a source each, whatever its quality (``bucket_of``); their sums are aggregated
partially and prefix-summed per source (some 190,000 rows at most); only the one range of each
source that holds the budget's edge is sorted by row.
Targets come from one row per source.

Edge cases: null texts have size 0; a source of size 0 has target 0; documents of
size 0 take 0 words; rows with the same id have the same key and each counts
itself; null ids share one key (and so one range); very long texts are one row's work; an empty table
gives none; ``mix`` passes extra columns of any name. The same input gives the same mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, fresh, stored, table, text_of

WEIGHTS, MOST, BUCKETS, FLOOR, SEED = (5, 2, 1), 3, 4096, 0.05, "mix-1"


def size_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def quality_of(text: Column) -> Column:
    """Share of code points that are letters or blanks, at least FLOOR; 1 for empty texts."""
    other = F.length(F.translate(text, "0123456789!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", ""))
    return F.greatest(F.lit(FLOOR), F.coalesce(F.try_divide(other, F.length(text)), F.lit(1.0)))


def uniform_of(doc_id: Column) -> Column:
    """A number in (0, 1) from 52 bits of a hash of the id."""
    hexed = F.substring(F.md5(F.concat_ws(":", F.lit(SEED), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary")), 1, 13)
    return (F.conv(hexed, 16, 10).cast("double") + 0.5) / float(1 << 52)


def bucket_of(key: Column) -> Column:
    """The range of a key, in the order of keys. Up to 4 equal shares of 1 - exp(-key), in which keys of weight 1 are
    even; beyond, where keys of small weights lie, equal steps."""
    low = F.floor((1 - F.exp(-key)) * BUCKETS)
    return F.when(key < 4, low).otherwise(BUCKETS + F.floor((key - 4) * 256)).cast("int")


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """sizes: source, source_size (one row each). Adds target."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    turn = (F.row_number().over(order) - 1) % len(weights)
    w = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    t = sizes.withColumn("w", F.when(F.col("source_size") > 0, w).otherwise(F.lit(0))).withColumn("cap", (F.col("source_size") * most).cast("double"))
    # In the order of cap / w, the level is what is left over by the caps before, per weight left.
    rank = Window.orderBy(F.col("cap") / F.greatest(F.col("w"), F.lit(1)), F.col("source").asc_nulls_last())
    before = rank.rowsBetween(Window.unboundedPreceding, -1)
    caps = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    left = F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0))
    level = F.try_divide(F.sum("source_size").over(every) - caps, left)
    t = t.withColumn("level", F.when(F.col("w") > 0, level))
    open_ = (F.col("cap") > F.col("level") * F.col("w")) & (F.col("w") > 0)
    t = t.withColumn("final", F.min(F.when(open_, F.struct((F.col("cap") / F.col("w")).alias("r"), F.col("level").alias("level")))).over(every))
    share = F.coalesce(F.least(F.col("cap"), F.col("final.level") * F.col("w")), F.col("cap"))
    return t.select("source", "source_size", F.when(F.col("w") > 0, share).otherwise(F.lit(0.0)).alias("target"))


def mix_plan(docs: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies: one row per document."""
    text = text_of()
    key = -F.ln(uniform_of(F.col("doc_id"))) / quality_of(text)
    rows = docs.select("doc_id", "source", size_of(text).alias("size"), key.alias("key"))
    rows = stored(rows.withColumn("bucket", bucket_of(F.col("key"))), "sizes")
    buckets = stored(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "buckets")
    targets = source_targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    epochs = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("long")
    targets = stored(targets.withColumn("epochs", epochs).withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")), "targets")
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
    edges = buckets.withColumn("upto", upto).withColumnRenamed("source", "s").join(targets, F.col("s").eqNullSafe(F.col("source")))
    edge = edges.where(F.col("upto") > F.col("budget")).groupBy("source").agg(F.min("bucket").alias("edge"), F.min(F.col("upto") - F.col("words")).alias("before"))
    t = targets.join(edge.withColumnRenamed("source", "e"), F.col("source").eqNullSafe(F.col("e")), "left").drop("e")
    t = stored(t.withColumn("edge", F.coalesce("edge", F.lit(1 << 30))).withColumnRenamed("source", "t"), "edges")
    all_rows = rows.join(t, F.col("source").eqNullSafe(F.col("t"))).drop("t")
    inner = all_rows.where(F.col("bucket") != F.col("edge")).withColumn("extra", (F.col("bucket") < F.col("edge")).cast("long"))
    at_edge = all_rows.where(F.col("bucket") == F.col("edge"))
    prefix = F.coalesce(F.sum("size").over(Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at_edge = at_edge.withColumn("extra", (F.col("before") + prefix + F.col("size") / 2 <= F.col("budget")).cast("long"))
    copies = F.least(F.col("epochs") + F.col("extra"), F.lit(most))
    done = inner.unionByName(at_edge).withColumn("copies", copies)
    return done.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mix(docs: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """The documents of the mix, a row for each copy, with their own columns.

    Rows that share an id get the copies of each of them (they share the key, so
    only rows at the budget's edge can differ).
    """
    plan = mix_plan(docs.select("doc_id", "source", "text"), weights, most).where("copies > 0")
    copies, id_, nth = (fresh(docs, x) for x in ("copies", "mixed_id", "nth"))
    plan = plan.groupBy("doc_id").agg(F.max("copies").alias(copies)).withColumnRenamed("doc_id", id_)
    found = docs.join(plan, docs["doc_id"].eqNullSafe(plan[id_]))
    return found.withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).select(*docs.columns)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("copies")


SQL_OP6 = rf"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    -ln((('0x' || md5('{SEED}:' || coalesce(doc_id::varchar, 'null'))[1:13])::bigint::double + 0.5) / 4503599627370496.0)
      / greatest({FLOOR}, coalesce(length(translate(text, '0123456789!"#$%&''()*+,-./:;<=>?@[\]^_`{{|}}~', ''))::double / nullif(length(text), 0), 1.0)) as key
  from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (
  select *, case when source_size > 0 then [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] else 0 end as w,
    (3 * source_size)::double as cap from s),
l as (
  select *, (sum(source_size) over () - coalesce(sum(cap) over (order by cap / greatest(w, 1), source nulls last rows between unbounded preceding and 1 preceding), 0))
    / nullif(sum(w) over () - coalesce(sum(w) over (order by cap / greatest(w, 1), source nulls last rows between unbounded preceding and 1 preceding), 0), 0) as level from w),
f as (select arg_min(level, cap / w) as level from l where w > 0 and cap > level * w),
t as (
  select source, source_size, case when w > 0 then coalesce(least(cap, f.level * w), cap) else 0.0 end as target from l left join f on true),
e as (select *, coalesce(floor(target / nullif(source_size, 0)), 0)::bigint as epochs from t),
r as (
  select d.doc_id, d.size, e.source_size, e.target, e.epochs,
    coalesce(sum(d.size) over (partition by d.source order by key, doc_id, size rows between unbounded preceding and 1 preceding), 0) as before
  from d join e on d.source is not distinct from e.source)
select doc_id, size, source_size, target,
  (size * least(3, epochs + case when before + size / 2.0 <= target - epochs * source_size then 1 else 0 end))::bigint as taken
from r
"""
