"""Order over whole tables: range partitions, and running values across their edges.

``laid_out`` stores rows sorted in range partitions; ``_at`` grows with the order and its upper
bits are the partition. ``running`` gives running sums, greatest values or parities within keys
without a window over a whole key: each partition's part of a key is a window of its own, and
what earlier partitions hold of the key is added (one row a partition at most, so that small
table is broadcast).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.operators.store import stored

#: monotonically_increasing_id keeps the row's number in its partition in the lower 33 bits.
PART_BITS = 33
KINDS = {
    "sum": (F.sum, lambda a, b: a + b),
    "max": (F.max, lambda a, b: F.greatest(a, b)),
    "xor": (F.bit_xor, lambda a, b: a.bitwiseXOR(b)),
}


def laid_out(rows: DataFrame, order: list[str | Column], name: str = "laid-out") -> DataFrame:
    """The rows stored in range partitions in this order, with ``_at`` that grows with it.

    Equal rows in ``order`` may stand in any order and in one partition: add columns until
    only equal rows tie. The input is read twice (once to find the ranges).
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    return stored(rows.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), name)


def part() -> Column:
    return F.shiftright("_at", PART_BITS)


def running(table: DataFrame, keys: list[str], values: dict[str, tuple[str, Column]]) -> DataFrame:
    """Rows of ``laid_out`` (ordered by keys first) with each value over the key's rows up to their own.

    values: name -> (``sum``, ``max`` or ``xor``, column). Nulls count as nothing; null keys are a key.
    """
    cols = [F.col(k) for k in keys]
    here = Window.partitionBy(part(), *cols).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    rows = table.select("*", part().alias("_part"), *[KINDS[kind][0](c).over(here).alias(name) for name, (kind, c) in values.items()])
    # only the key of a partition's first row can have begun in an earlier partition
    first = table.groupBy(part().alias("_p")).agg(F.min_by(F.struct(F.lit(0).alias("_0"), *cols), "_at").alias("_k")).select("_k").distinct()
    totals = (
        table.join(F.broadcast(first), _same(F.col("_k"), keys), "left_semi").groupBy(part().alias("_p"), *cols)
        .agg(*[KINDS[kind][0](c).alias(f"_t_{name}") for name, (kind, c) in values.items()])
    )
    earlier = Window.partitionBy(*[F.col(k) for k in keys]).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        F.col("_p"), F.struct(F.lit(0).alias("_0"), *cols).alias("_k"), F.lag("_p").over(Window.partitionBy(*[F.col(k) for k in keys]).orderBy("_p")).alias("_lag"),
        *[KINDS[kind][0](f"_t_{name}").over(earlier).alias(f"_b_{name}") for name, (kind, _) in values.items()],
    ).where("_lag is not null").drop("_lag")
    joined = rows.join(F.broadcast(before), (F.col("_part") == F.col("_p")) & _same(F.col("_k"), keys), "left")
    out = [
        F.when(F.col(f"_b_{name}").isNull(), F.col(name)).when(F.col(name).isNull(), F.col(f"_b_{name}")).otherwise(KINDS[kind][1](F.col(f"_b_{name}"), F.col(name))).alias(name)
        for name, (kind, _) in values.items()
    ]
    return joined.select(*table.columns, *out)


def ordinals(table: DataFrame, keys: list[str], name: str = "nth") -> DataFrame:
    """Rows of ``laid_out`` with their place (from 1) within the keys; without keys, within the table."""
    return running(table, keys, {name: ("sum", F.lit(1).cast("long"))})


def _same(struct: Column, keys: list[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & struct[k].eqNullSafe(F.col(k))
    return out
