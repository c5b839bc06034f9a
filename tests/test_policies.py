"""Filter chain, seats, consumption of digests: hand-made cases."""

import datetime as dt

from pyspark.sql import functions as F

from newsloom.operators import filters, store, topics


def test_filter_chain_in_order(spark):
    day = lambda n: dt.datetime(2024, 1, 30) - dt.timedelta(days=n)
    rows = [
        (1, "Tram <b>news</b>", "x", day(1), "a", None, False), (2, " ", "tram", day(1), "a", None, False), (3, "Tram old", "", day(20), "a", None, False), (4, "Tram old but looked back", "", day(20), "a", 30, False),
        (5, "Tram of 2021", "", day(1), "a", 30, False), (6, "Other", "", day(1), "a", None, False), (7, "Other kind", "", day(1), "game", None, False), (8, "Exempt", None, day(1), "a", None, True),
        (9, "Tram, news!", "later copy", day(1), "a", None, False), (10, "Tram banned", "", day(1), "a", None, False), (11, "Tr<i>am</i> tags are no text", "", day(1), "a", None, False), (12, "Tram topic", "", day(1), "a", None, False),
        (13, "Tram topic two", "", None, "a", None, False), (14, None, "tram", day(1), "game", None, True),
    ]
    df = spark.createDataFrame(rows, "seq int, title string, summary string, published timestamp_ntz, content_type string, lookback_days int, relevance_exempt boolean")
    topic = F.when(F.contains("title", F.lit("topic")), "t")
    run = lambda **more: sorted(r.seq for r in filters.filter_chain(df, "2024-01-30 00:00:00", ["Tram"], ["banned"], topic, 1, ("game",), **more).collect())
    # the title's fingerprint keeps the markup of 1, so its later copy without it is another title
    assert run() == [1, 4, 7, 8, 9, 12] and run(throttle=False) == [1, 4, 7, 8, 9, 12, 13]


def test_hot_topics_take_the_seats_that_digests_leave(spark):
    d = spark.createDataFrame([("a", 3), ("b", 9), ("c", 3)], "name string, n int")
    h = spark.createDataFrame([(f"h{i}", i) for i in range(6)], "name string, n int")
    order = [F.col("n").desc(), F.col("name")]
    seats = lambda d, most: [(r.seat, r.kind, r.name) for r in topics.allocate_seats(d, h, most, order, order).orderBy("seat").collect()]
    assert seats(d, 5) == [(1, "digest", "b"), (2, "digest", "a"), (3, "digest", "c"), (4, "hot", "h5"), (5, "hot", "h4")]
    assert [s[2] for s in seats(d, 2)] == ["b", "a"] and [s[2] for s in seats(d.where("false"), 2)] == ["h5", "h4"]


def test_failed_digests_consume_nothing(spark):
    pool = spark.createDataFrame([(g, f"{g}{i}") for g in "wxyz" for i in range(3)] + [("w", None)], "label string, link string")
    best = spark.createDataFrame([(g, f"{g}0") for g in "wxyz"], "label string, link string")
    answers = spark.createDataFrame([("w", "text"), ("x", " "), ("y", "text"), ("z", "text")], "label string, text string")
    ok = lambda rows: spark.createDataFrame(rows, "label string, ok boolean")
    used = store.consumed(pool.where("link is not null"), best, answers, ok([("w", True), ("x", True), ("y", False), ("z", True)]), ok([("w", True), ("y", True)]))
    assert sorted(r.link for r in used.collect()) == ["w0", "w1", "w2", "z0"]
