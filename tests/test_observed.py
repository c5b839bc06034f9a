"""Counts on the way against grouped counts; call counters of tasks."""

import pytest
from pyspark.sql import functions as F

from newsloom.operators import observed as O
from newsloom.sources import readers as R


def test_funnel_in_one_job(spark, tmp_path):
    rows = [(i, ["a", "b", None, "c"][i % 4], i % 7 if i % 5 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, source string, v int").repartition(5)
    stages = {"small": F.col("v") < 5, "odd": F.col("id") % 2 == 1, "none": F.lit(None).cast("boolean") | (F.col("v") == 1)}
    out, counts = O.funnel_on_the_way(df, stages, "source", ["a", "gone", "c", "a"])
    out.write.parquet(f"{tmp_path}/out")

    def plain(keep):
        mine = [(i, v) for i, s, v in rows if keep(s)]
        steps = [mine]
        for test in (lambda i, v: v is not None and v < 5, lambda i, v: i % 2 == 1, lambda i, v: v == 1):
            steps.append([x for x in steps[-1] if test(*x)])
        return tuple(map(len, steps))

    assert counts() == [(None, *plain(lambda s: True)), ("a", *plain(lambda s: s == "a")), ("gone", 0, 0, 0, 0), ("c", *plain(lambda s: s == "c"))]
    assert spark.read.parquet(f"{tmp_path}/out").count() == counts()[0][-1]
    with pytest.raises(ValueError):
        O.funnel_on_the_way(df, stages, "source", [str(i) for i in range(501)])


def test_calls_and_seconds_by_source(spark):
    def fetch(url):
        if "bad" in url:
            raise OSError("down")
        return 200, "<a href=x>item one</a><a href=y>item two</a>"

    urls = spark.createDataFrame([("a", "http://a/1"), ("a", "http://a/2"), ("b", "http://b/bad"), ("b", "http://b/1")], "source string, url string").coalesce(1)
    got, calls = O.evaluate_sources(spark, urls, fetch, lambda p: R.page_anchors(p), lambda url: url.split("/")[2])
    assert sorted(tuple(r) for r in got.collect()) == [("a", 2, 0, 4), ("b", 1, 1, 2)]
    assert {k: (v["calls"], v["failed"]) for k, v in calls.value.items()} == {"a": (2, 0), "b": (2, 1)} and all(v["seconds"] >= 0 for v in calls.value.values())
