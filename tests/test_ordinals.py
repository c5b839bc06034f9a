"""Running values across range partitions against plain Python."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from newsloom.operators.ordinals import laid_out, ordinals, running


@pytest.mark.parametrize("seed", range(3))
def test_running_values(spark, seed):
    r = random.Random(seed)
    # one key holds most rows, so that it spans all partitions; a null key is a key
    rows = [(r.choice([1, 1, 1, 1, 2, 3, None, 1000 + i]), i, r.choice([None, 1, 5, -7])) for i in range(700)]
    t = laid_out(spark.createDataFrame(rows, "k int, i int, v bigint"), ["k", "i"])
    assert t.select((F.shiftright("_at", 33)).alias("p")).distinct().count() > 1
    got = {x.i: (x.n, x.s, x.m, x.x) for x in running(t, ["k"], {"n": ("sum", F.lit(1)), "s": ("sum", F.col("v")), "m": ("max", F.col("v")), "x": ("xor", F.col("v"))}).collect()}
    for k, group in itertools.groupby(sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1])), key=lambda x: x[0]):
        n, seen, parity = 0, [], 0
        for _, i, v in group:
            n += 1
            if v is not None:
                seen.append(v)
                parity ^= v
            assert got[i] == (n, sum(seen) if seen else None, max(seen) if seen else None, parity if seen else None)


def test_ordinals_of_the_table_and_of_nothing(spark):
    rows = spark.createDataFrame([(i * 37 % 501,) for i in range(501)], "i int")
    assert all(x.nth == x.i + 1 for x in ordinals(laid_out(rows, ["i"]), []).collect())
    assert ordinals(laid_out(rows.where("false"), ["i"]), ["i"]).count() == 0
