"""The buffer with a lifetime: restarts, equal to the batch form."""

import datetime as dt
import random

from pyspark.sql import functions as F

from newsloom.operators import store as K
from newsloom.streaming import lifetime as L

DAY0 = dt.datetime(2024, 1, 1)


def test_lives_over_restarts_equal_the_batch_form(spark, tmp_path):
    """A file a day, the query started anew for each; two links come again after they expired."""
    r = random.Random(4)
    days = [[] for _ in range(16)]
    for i in range(40):
        d = r.randrange(10)
        days[d].append((f"l{i}", "insert", d, f"p{i}"))
        if r.random() < 0.5:
            days[min(15, d + r.randrange(1, 3))].append((f"l{i}", "consume", None, None))
        if r.random() < 0.5:
            days[min(15, d + r.randrange(0, 3))].append((f"l{i}", "insert", None, "again"))
    days[0] += [("back", "insert", 0, "one"), (None, "insert", 0, "x"), ("none", "consume", 0, "x"), ("null", "insert", -1, "x")]
    days[12].append(("back", "insert", 12, "two"))
    days[15].append(("end", "insert", 15, "e"))
    held: dict = {}
    for d, rows in enumerate(days):
        stamp = DAY0 + dt.timedelta(days=d)
        made = [(link, kind, None if at == -1 else stamp, payload) for link, kind, at, payload in rows]
        if made:
            spark.createDataFrame(made, L.INPUT).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        if d % 4 == 3:
            stream = spark.readStream.schema(L.INPUT).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
            L.run_buffer(spark, stream, f"{tmp_path}/out", f"{tmp_path}/cp", days=5, late="0 seconds")
        # the batch form, day by day: what has expired before today goes, then today's rows are inserted if they are new
        held = {k: v for k, v in held.items() if v[1] or v[0] + dt.timedelta(days=5) >= stamp}
        for link, kind, at, payload in sorted(made, key=lambda x: (x[1] != "insert", x[3] or "")):
            if link is not None and at is not None and kind == "insert" and link not in held:
                held[link] = [stamp, False, payload]
            elif kind == "consume" and link in held:
                held[link][1] = True
    actions = spark.read.parquet(f"{tmp_path}/out")
    got = {x.link: (x.payload, x.used) for x in L.table_of(actions).collect()}
    assert got["back"] == ("two", False) and got["end"] == ("e", False) and "none" not in got and "null" not in got
    open_ = {k: v for k, v in got.items() if v[1]}
    assert open_ == {k: (v[2], True) for k, v in held.items() if v[1]}
    # the last batch's expiries fire with the next one: the batch form keeps no row that the stream lacks
    assert {k for k, v in held.items()} <= set(got)
    counts = {x.action: x.n for x in actions.groupBy("action").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts["inserted"] == len(got) + counts["expired"]

    # the same by the keyed-table operators: expiry of unused rows, then insert-ignore
    rows = spark.createDataFrame([(k, p, u) for k, (p, u) in got.items()], "link string, payload string, used boolean")
    again = K.insert_ignore(rows, spark.createDataFrame([("back", "three", False), ("new", "n", False)], rows.schema), ["link"])
    assert [x.link for x in again.collect()] == ["new"]
