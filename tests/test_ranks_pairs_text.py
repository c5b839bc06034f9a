"""Ranks, tiles, scans, text functions and the API against plain versions."""

import datetime as dt
import random
from urllib.parse import urljoin

import numpy as np
from pyspark.sql import functions as F

from newsloom import api
from newsloom.functions import text as T
from newsloom.functions import udf as U
from newsloom.operators import ranks, similarity, store, topics


def test_values_at_places(spark):
    r = random.Random(1)
    rows = [("a", r.gauss(0, 1e6)) for _ in range(3000)] + [("b", float(r.randrange(3))) for _ in range(500)] + [("c", 7.0), ("d", None), ("e", 1e-12), ("e", 1e12), ("e", 1.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    n = F.col("n")
    out = ranks.at_places(df, "g", "v", {"low": F.floor((n + 1) / 2), "p95": F.greatest(F.lit(1), F.floor(n * 0.95)), "most": n})
    got = {x.g: (x.n, x.low, x.p95, x.most) for x in out.collect()}
    for g in "abce":
        v = sorted(x for k, x in rows if k == g and x is not None)
        assert got[g] == (len(v), v[(len(v) + 1) // 2 - 1], v[max(1, int(len(v) * 0.95)) - 1], v[-1])
    assert "d" not in got


def test_close_pairs_and_buckets(spark):
    r = np.random.default_rng(2)
    rows = [(i, r.normal(size=4).tolist(), int(r.integers(3)), int(r.integers(1000))) for i in range(150)] + [(150, None, 1, 5), (151, [0.0] * 4, 1, 5), (152, [1.0, 0.0, 0.0, 0.0], 1, None)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>, k int, t bigint")
    cos = lambda a, b: float(np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)))
    want = {(a[0], b[0]) for a in rows[:150] for b in rows[:150] if a[0] < b[0] and a[2] == b[2] and abs(a[3] - b[3]) < 100 and cos(a[1], b[1]) >= 0.6}
    for tile in (2000, 5):
        assert {(p.a, p.b) for p in similarity.close_pairs(df, 0.6, "k", 100, tile).collect()} == want

    rng = random.Random(5)
    edges = sorted({tuple(sorted(rng.sample(range(80), 2))) for _ in range(70)})
    bucket = {}
    for i in range(80):
        bucket[i] = min([bucket[a] for a, b in edges if b == i], default=i)
    got = similarity.first_reachable(spark.range(80), spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {x.id: x.first for x in got.collect()} == bucket


def test_vector_dedup(spark):
    rows = [(1, [1.0, 0.0], 5, 0), (2, [0.9, 0.4], 9, 0), (3, [0.0, 1.0], 1, 0), (4, [0.99, 0.05], 7, 0), (5, None, 3, 0), (6, [1.0, 0.0], 1, 1)]
    cand = spark.createDataFrame(rows, "id bigint, v array<double>, n int, k int")
    held = spark.createDataFrame([(100, [0.0, 0.9], 0)], "id bigint, v array<double>, k int")
    got = {(x.id, x.last) for x in similarity.vector_dedup(cand, held, 0.95, 0.9, "k").collect()}
    assert got == {(2, False), (5, True), (6, False)}


def test_text_functions(spark):
    now = "2024-03-01 20:30:00"
    raws = ["Today 1:05 AM", "Yesterday 12:00 PM", "02-29-2024 12:59 AM", "02-30-2024 1:00 AM", "Today 13:00 PM", " Today 11:59 PM ", "", None]
    df = spark.createDataFrame([(x,) for x in raws], "raw string")
    got = [r[0] for r in df.select(F.date_format(T.forum_time(F.col("raw"), F.lit(now).cast("timestamp")).cast("timestamp_ntz"), "yyyy-MM-dd HH:mm")).collect()]
    assert got == ["2024-03-01 16:05", "2024-03-01 03:00", "2024-02-28 15:59", None, None, "2024-03-02 14:59", None, None]

    base = ["http://x.org/a/b.html?q=1#f", "https://x.org", "http://x.org/"]
    refs = ["c.html", "/c", "//y.org/d", "https://z.org/e", "?r=2"]
    links = spark.createDataFrame([(b, h) for b in base for h in refs], "b string, h string")
    for r in links.select("b", "h", T.join_url(F.col("b"), F.col("h")).alias("u")).collect():
        assert r.u == urljoin(r.b, r.h), (r.b, r.h)

    def fnv(s, salt=0):
        h = 2166136261 ^ salt
        for c in s:
            h = (h ^ ord(c)) * 16777619 % 2**32
        return h

    words = spark.createDataFrame([("",), ("abc",), ("日本é",)], "s string")
    assert [tuple(r) for r in words.select("s", T.fnv1a(F.col("s")), T.fnv1a(F.col("s"), 7)).collect()] == [(s, fnv(s), fnv(s, 7)) for s in ("", "abc", "日本é")]

    titles = spark.createDataFrame([("【快訊】三人受傷 ２０２４（記者王小明報導）",), ("路口改善／王小明報導 xx",), (None,)], "t string")
    assert [r[0] for r in titles.select(T.clean_title(F.col("t"))).collect()] == ["3人受傷 2024", "路口改善", ""]
    odd = spark.createDataFrame([("ＡＢ①",), (None,)], "s string")
    assert [r[0] for r in odd.select(U.nfkc("s")).collect()] == ["AB1", None]
    assert spark.createDataFrame([("<p>a&eacute;&#39;b</p>&lt;i&gt;",)], "s string").select(U.effective_text(F.col("s"))).first()[0] == "aé'b <i>"
    raw = spark.createDataFrame([(b"\xa4\xa4", "big5"), ("é".encode(), None), (b"\xe9", "nonsense")], "b binary, c string")
    assert [r[0] for r in raw.select(U.decode_bytes("b", T.declared_charset(F.concat(F.lit("charset="), F.coalesce("c", F.lit("utf-8")))))).collect()] == ["中", "é", "�"]
    assert set(U.register(spark)) == {"nfkc", "html_unescape", "decode_bytes"} and spark.sql("select nfkc('①') as x").first().x == "1"


def test_api_pages_and_order(spark):
    assert api.page("7", "3") == (7, 3) and api.page("x", -1) == (100, 0) and api.page(0, None) == (100, 0) and api.page(999, "2") == (100, 2)
    t = dt.datetime(2024, 1, 1)
    rows = [(1, "a", "s", "2024-W01", "低", ["x"], "text", t), (2, "b", "s", "2024-W01", None, ["x", ""], "Text", t), (3, "c", "s", "2024-W01", "高", [], "none", t), (4, "d", "s", "2024-W02", "高", ["y"], "t", t)]
    a = spark.createDataFrame(rows, "id bigint, title string, source string, week_id string, importance string, tags array<string>, analysis string, published timestamp")
    assert [(r.id, r.total) for r in api.week(a, "2024-W01").collect()] == [(3, 3), (2, 3), (1, 3)]
    assert [r.id for r in api.week(a, "2024-W01", q="TEXT", tag="x").collect()] == [2, 1]
    assert [r.id for r in api.week(a, "2024-W01", importance="other", limit=1, offset=1).collect()] == [2]
    assert [tuple(r) for r in api.weeks(a).collect()] == [("2024-W02", 1, 1), ("2024-W01", 3, 1)]
    assert [tuple(r) for r in api.tags(a).collect()] == [("x", 2), ("y", 1)]


def test_replies_overlay_and_labels(spark):
    t = dt.datetime(2024, 1, 1, 0, 0)
    posts = spark.createDataFrame([("a", i, t + dt.timedelta(hours=i), "x" * 10) for i in range(5)] + [("b", 1, t, "y" * 100)], "thread string, id bigint, time timestamp_ntz, text string")
    got = {r.thread: r for r in topics.merge_replies(posts, 4, 60).collect()}
    assert got["a"].merged.startswith("[01/01 12:00] x") and got["a"].merged.count("\n") == 1 and got["a"].newest == 4 and got["a"].replies == 2
    assert len(got["b"].merged) == 60 and got["b"].merged.startswith("[01/01 09:00] y")
    held, new = (spark.createDataFrame(x, "id int, s string") for x in ([(1, "old")], [(1, "new"), (2, "new")]))
    assert sorted(map(tuple, store.overlay(held, new, "id").collect())) == [(1, "old"), (2, "new")]


def test_places_among_endless_values(spark):
    """Infinite values, NaN (the largest), spans that overflow, tiny steps, ties."""
    from pyspark.sql import functions as F

    from newsloom.operators import ranks

    inf, nan = float("inf"), float("nan")
    groups = {
        "a": [inf, 1.0, -inf, 2.0, nan, nan, inf, 3.0], "b": [-1.7e308, 1.7e308, 0.0, 1e-300, -1e-300, 5e-324], "c": [inf, inf], "d": [nan], "e": [-inf, -inf, 1.0], "f": [1.0, 1.0 + 2**-52, 1.0 + 2**-51, inf],
        "g": [float(i) for i in range(3000)] + [1e308, inf], "h": [nan, -1e308, -2.0],
    }
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double")
    n = F.col("n")
    got = {r.g: r for r in ranks.at_places(df, "g", "v", {"first": F.lit(1), "mid": F.floor((n + 1) / 2), "last": n}).collect()}
    for g, vs in groups.items():
        order = sorted(vs, key=lambda v: (v != v, v if v == v else 0))
        want = order[0], order[(len(vs) + 1) // 2 - 1], order[-1]
        assert str((got[g].first, got[g].mid, got[g].last)) == str(want)
