"""Counts that the run which does the work makes on its way: funnels, calls and seconds a source.

``funnel_on_the_way`` counts rows after every stage, in all and by source, with one Observation: the job that
writes what is left has the counts when it ends, and nothing is read twice. ``CallCounter`` counts what tasks ask of
outside services, by name, with seconds and failures, in an accumulator of a few numbers a name.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark import AccumulatorParam
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Sources that an observation counts one by one.
SOURCES = 500


def funnel_on_the_way(rows: DataFrame, stages: dict[str, Column], source: str | None = None, sources: list[str] | None = None) -> tuple[DataFrame, Callable[[], list[tuple]]]:
    """The rows that pass all stages, and a function that gives, once a job has run over them, (source, n, count after each stage).

    The first tuple (source null) counts everything. Listed sources (``SOURCES`` at most) have their own, also
    with nothing; the others are in the first only. A null stage is not passed.
    """
    listed = list(dict.fromkeys(sources or []))
    if len(listed) > SOURCES:
        raise ValueError(f"{len(listed)} sources: an observation counts {SOURCES} at most")
    passed, after = F.lit(True), []
    for c in stages.values():
        passed = passed & F.coalesce(c, F.lit(False))
        after.append(passed)
    kinds = [(None, F.lit(True))] + [(s, F.col(source).eqNullSafe(F.lit(s))) for s in listed]
    counts = [F.count_if(mine & c).alias(f"c{i}_{k}") for i, (_, mine) in enumerate(kinds) for k, c in enumerate([F.lit(True), *after])]
    seen = Observation()
    out = rows.observe(seen, *counts).where(passed)

    def result() -> list[tuple]:
        got = seen.get
        return [(s, *[got[f"c{i}_{k}"] for k in range(len(after) + 1)]) for i, (s, _) in enumerate(kinds)]

    return out, result


class _Sums(AccumulatorParam):
    def zero(self, value):
        return {}

    def addInPlace(self, a, b):  # noqa: N802
        for k, v in b.items():
            a[k] = tuple(x + y for x, y in zip(a.get(k, (0, 0, 0.0)), v, strict=True))
        return a


class CallCounter:
    """Calls, failures and seconds by name. Counts are of attempts: a task that runs again calls again, and is counted again."""

    def __init__(self, spark: SparkSession) -> None:
        self.sums = spark.sparkContext.accumulator({}, _Sums())

    def counted(self, call: Callable, name: Callable[..., str] | str) -> Callable:
        """The function, counted where it runs; name is fixed or made of its arguments."""
        sums = self.sums

        def run(*args, **more):
            key = name if isinstance(name, str) else name(*args, **more)
            began, failed = time.monotonic(), 1
            try:
                out = call(*args, **more)
                failed = 0
                return out
            finally:
                sums.add({key: (1, failed, time.monotonic() - began)})

        return run

    @property
    def value(self) -> dict[str, dict[str, float]]:
        return {k: {"calls": v[0], "failed": v[1], "seconds": v[2]} for k, v in sorted(self.sums.value.items())}


def evaluate_sources(spark: SparkSession, urls: DataFrame, fetch: Callable[[str], tuple[int, str]], parsed: Callable[[DataFrame], DataFrame], source_of: Callable[[str], str]) -> tuple[DataFrame, CallCounter]:
    """urls: source, url. source, fetched, failed, items (stored), and the counter with each source's seconds.

    ``parsed`` turns fetched pages (source, url, html) into items with their source; each page is fetched once.
    """
    from newsloom.operators.store import stored
    from newsloom.sources.readers import fetch_pages

    calls = CallCounter(spark)
    pages = stored(urls.join(fetch_pages(urls, calls.counted(fetch, source_of)), "url"), "evaluated-pages")
    items = parsed(pages.where("error is null")).groupBy("source").agg(F.count(F.lit(1)).alias("items"))
    ok = pages.groupBy("source").agg(F.count_if(F.col("error").isNull()).alias("fetched"), F.count_if(F.col("error").isNotNull()).alias("failed"))
    return ok.join(items, "source", "left").na.fill(0, ["items"]), calls
