"""Small hand-made cases of the operators."""

import random

import pytest
from pyspark.sql import functions as F

from newsloom.functions import text as T
from newsloom.operators import classify, filters, review, similarity, store, topics


def one(spark, column, **values):
    ddl = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double' if isinstance(v, float) else 'bigint'}" for k, v in values.items()) or "x bigint"
    return spark.createDataFrame([tuple(values.values()) or (1,)], ddl).select(column.alias("o")).first().o


@pytest.mark.parametrize("raw, expected", [("2024-01-05T10:00:00Z", "2024-01-05 10:00:00"), ("Fri, 05 Jan 2024 10:00:00 +0800", "2024-01-05 02:00:00"), ("05 Jan 2024 10:00:00 GMT", "2024-01-05 10:00:00"), ("soon", None), (None, None)])
def test_published(spark, raw, expected):
    assert one(spark, F.date_format(T.parse_published(F.col("r")), "yyyy-MM-dd HH:mm:ss"), r=raw) == expected


@pytest.mark.parametrize("url, day", [("https://a/2024/3/9/x", "2024-03-09"), ("https://a/n_20240309.html", "2024-03-09"), ("https://a/2024/13/40/x", None), ("https://a/x", None)])
def test_url_date(spark, url, day):
    assert one(spark, T.url_date(F.col("u")).cast("string"), u=url) == day


def test_duration_and_weeks(spark):
    assert one(spark, T.duration_seconds(F.col("d")), d="PT1M30S") == 90
    assert one(spark, T.duration_seconds(F.col("d")), d="P1DT2H") == 93600
    assert one(spark, T.week_id(F.col("d").cast("timestamp_ntz")), d="2023-12-31 20:00:00") == "2024-W01"


def test_jaccard_and_cosine(spark):
    sets = F.split("a", " "), F.split("b", " ")
    assert one(spark, T.jaccard(*sets), a="x y z", b="x y w") == 0.5
    assert one(spark, T.jaccard(F.array().cast("array<string>"), F.split("a", " ")), a="x") == 0.0
    assert one(spark, T.cosine(F.array(F.lit(0.9), F.lit(0.4)), F.array(F.lit(1.0), F.lit(0.0)))) == pytest.approx(0.9138, abs=1e-4)
    assert one(spark, T.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0)))) == 0.0


def test_fingerprint_keeps_accents_and_ignores_marks(spark):
    a, b, c = (one(spark, T.fingerprint(F.col("t")), t=t) for t in (" Été, à Paris! ", "été à paris", "ete a paris"))
    assert a == b != c


def test_relevance_reasons(spark):
    rules = {"a": {"require_any": ["bus", "tram"], "exclude_any": ["old"]}, "b": {"exclude_any": ["old"]}, "c": {}}
    df = spark.createDataFrame([("a", "old Tram"), ("a", "old"), ("b", "old"), ("b", "new"), ("c", "x"), ("d", "x"), ("b", None)], "c string, t string")
    on, why = classify.relevance(F.col("t"), F.col("c"), rules)
    assert [tuple(r) for r in df.select(on, why).collect()] == [(True, "kept:tram"), (False, "excluded:no-require-hit"), (False, "excluded:old"), (True, "kept:no-exclude-hit"), (True, "kept:no-rule-fields"), (True, "no-rule"), (True, "kept:no-exclude-hit")]


def test_category_priority_and_default(spark):
    c = classify.category_of(F.split("t", " "), {"x": ["b"], "y": ["a", "b"]})
    assert [one(spark, c, t=t) for t in ("a b", "a", "z")] == ["x", "y", "uncategorised"]
    d = classify.with_source_default(c, F.col("s"), {"": "never", "News": "n"})
    assert [one(spark, d, t=t, s=s) for t, s in (("z", "the news"), ("a", "the news"), ("z", "other"))] == ["n", "y", "uncategorised"]


def test_keep_first_and_caps(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, None), (5, None), (4, "b")], "id bigint, k string")
    assert sorted(r.id for r in filters.keep_first(df, "k", "id").collect()) == [1, 2, 4]
    assert sorted(r.id for r in filters.cap_per_key(df, "k", ["id"], 1).collect()) == [1, 2, 4, 5]


def test_stale_and_age(spark):
    as_of = "2024-06-15 00:00:00"
    stale = filters.stale(F.col("t"), F.col("p").cast("timestamp_ntz"), as_of)
    cases = [("in 2021 it", None, True), ("in 2024 it", "2024-01-01 00:00:00", True), ("x", "2024-06-10 00:00:00", False), ("x", None, False), ("in 2099", None, False)]
    assert [one(spark, stale, t=t, p=p) for t, p, _ in cases] == [e for *_, e in cases]
    old = filters.too_old(F.col("u"), F.col("p").cast("timestamp_ntz"), as_of, 30)
    assert one(spark, old, u="https://news.google.com/x", p="2020-01-01 00:00:00") is False
    assert one(spark, old, u="https://a/x", p="2024-05-01 00:00:00") is True


def test_novelty(spark):
    c = topics.passes_novelty(F.col("s"), F.col("l"), F.col("ls"), F.col("ll"))
    df = spark.createDataFrame([(10.0, "b", None, None), (15.0, "b", 10.0, "a"), (14.0, "b", 10.0, "a"), (20.0, "a", 10.0, "a"), (20.0, None, 10.0, "a")], "s double, l string, ls double, ll string")
    assert [r[0] for r in df.select(c).collect()] == [True, True, False, False, False]


def _greedy(n, edges):
    kept = []
    for i in range(n):
        if not any((k, i) in edges for k in kept):
            kept.append(i)
    return kept


@pytest.mark.parametrize("seed", [1, 2])
def test_greedy_and_components_on_random_graphs(spark, seed):
    r = random.Random(seed)
    n = 30
    edges = {(a, b) for a in range(n) for b in range(a + 1, n) if r.random() < 0.06}
    e = spark.createDataFrame(sorted(edges), "a bigint, b bigint")
    got = similarity.keep_first_greedy(spark.range(n), e).where("state = 'kept'").collect()
    assert sorted(x.id for x in got) == _greedy(n, edges)
    comp = {x.id: x.comp for x in similarity.components(e).collect()}
    label = list(range(n))
    for _ in range(n):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert comp == {i: label[i] for i in {x for p in edges for x in p}}


def test_jaccard_pairs_against_brute_force(spark):
    r = random.Random(3)
    sets = [sorted(r.sample("abcdefghij", r.randint(1, 7))) for _ in range(60)]
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(sets)], "id bigint, tokens array<string>")
    classes = similarity.set_classes(rows).collect()
    c = spark.createDataFrame(classes)
    for least, hot in ((0.3, None), (0.5, None), (0.8, None), (0.2, 0), (0.45, 12), (0.45, 1000)):  # all tokens hot, some, none
        got = {(p.a, p.b) for p in similarity.jaccard_pairs(c, least, hot=hot).collect()}
        first = [x.rep for x in classes]
        sim = lambda a, b: len(set(sets[a]) & set(sets[b])) / len(set(sets[a]) | set(sets[b]))
        assert got == {(a, b) for a in first for b in first if a < b and sim(a, b) >= least}


def _fold(rows, near):
    """Slots in order: [opened by, held by, class, n]."""
    slots = []
    for i, c, n in sorted(rows):
        slot = next((s for s in slots if s[2] == c or (min(s[2], c), max(s[2], c)) in near), None)
        if slot is None:
            slots.append([i, i, c, n])
        elif n > slot[3]:
            slot[1:] = [i, c, n]
    return sorted((s[0], s[1]) for s in slots)


@pytest.mark.parametrize("seed, n, links, limit", [(0, 120, 500, 7), (1, 150, 90, 20), (2, 60, 900, 2000), (3, 90, 4000, 11)])
def test_fold_with_replacement(spark, seed, n, links, limit):
    """Random graphs with one giant component, in blocks of its order; rows of one class are copies."""
    r = random.Random(seed)
    size = [r.randrange(1, 9) for _ in range(n)]
    rows = [(i, c, size[c]) for c in range(n) for i in {c, *(r.choices(range(n, 4 * n), k=r.randrange(4)))}]
    rows = list({i: (i, c, m) for i, c, m in rows}.values())
    first = {}
    for i, c, _ in sorted(rows):
        first.setdefault(c, i)
    rows = [(i, first[c], m) for i, c, m in rows]
    near = {tuple(sorted(first[c] for c in r.sample(sorted(first), 2))) for _ in range(links)}
    df = spark.createDataFrame(rows, "id long, cls long, n int")
    got = similarity.fold_slots(df, spark.createDataFrame(sorted(near), "a long, b long"), limit).collect()
    assert sorted((x.slot, x.id) for x in got) == _fold(rows, near)


def test_fold_of_nothing_and_without_links(spark):
    df = spark.createDataFrame([(1, 1, 3), (2, 2, 4)], "id long, cls long, n int")
    none = spark.createDataFrame([], "a long, b long")
    assert sorted(map(tuple, similarity.fold_slots(df, none).collect())) == [(1, 1), (2, 2)]
    assert similarity.fold_slots(df.where("false"), none).count() == 0


def test_replaced_slots_with_copies(spark):
    """The plan on token sets: copies after a replacement, rows without tokens, two languages."""
    from newsloom.plans.dedup import replaced_slots

    r = random.Random(6)
    rows = [(i, r.choice("xy"), sorted(r.sample("abcdefg", r.randint(0, 6)))) for i in range(150)]
    slots = []
    for i, lang, t in rows:
        t = set(t)
        slot = next((s for s in slots if s[2] == lang and t and s[3] and len(t & s[3]) / len(t | s[3]) > 0.45), None)
        if slot is None:
            slots.append([i, i, lang, t])
        elif len(t) > len(slot[3]):
            slot[1:] = [i, lang, t]
    got = replaced_slots(spark.createDataFrame(rows, "id bigint, lang string, tokens array<string>")).collect()
    assert sorted((x.slot, x.id) for x in got) == sorted((s[0], s[1]) for s in slots)


def test_first_kept_with_containment_and_rows_without_tokens(spark):
    from newsloom.plans.dedup import first_kept, topic_bucket_sets

    r = random.Random(8)
    rows = [(1, "x", list("abcdefgh")), (2, "x", ["c"]), (3, "y", ["c"]), (4, "x", []), (5, "x", None), (6, "y", list("cd"))]
    rows += [(i, r.choice("xy"), sorted(r.sample("abcdefghijklmnop", r.randint(1, 9)))) for i in range(7, 120)] + [(120, "y", [])]
    kept = []
    for i, lang, t in rows:
        t = set(t or [])
        if not any(k == lang and t and s and (t <= s or s <= t or len(t & s) / len(t | s) > 0.5) for _, k, s in kept):
            kept.append((i, lang, t))
    df = spark.createDataFrame(rows, "id bigint, lang string, tokens array<string>")
    got = sorted(x.id for x in first_kept(df).collect())
    assert got == [k[0] for k in kept] and {1, 3, 4, 5, 120} <= set(got) and not {2, 6} & set(got)
    assert {(4, 4), (5, 5), (120, 120)} <= {(x.bucket, x.id) for x in topic_bucket_sets(df).collect()}


def test_replaced_slots_against_a_plain_fold(spark):
    from newsloom.plans.dedup import replaced_slots

    def plain(rows):
        slots = []
        for i, lang, t in rows:
            t = set(t or [])
            near = next((s for s in slots if s[2] == lang and t and s[3] and len(t & s[3]) / len(t | s[3]) > 0.45), None)
            if near is None:
                slots.append([i, i, lang, t])
            elif len(t) > len(near[3]):
                near[1:] = [i, lang, t]
        return sorted((s[0], s[1]) for s in slots)

    a, b, d = list("abcd"), list("abcdefg"), list("cdefghijk")
    again = [(1, "x", a), (2, "x", b), (3, "x", d), (4, "x", a)]
    assert plain(again) == [(1, 3), (4, 4)]
    r = random.Random(6)
    some = [sorted(r.sample("abcdefghij", r.randint(1, 9))) for _ in range(25)] + [[], None]
    for rows in (again, [(i, r.choice("xy"), r.choice(some)) for i in range(150)]):
        got = replaced_slots(spark.createDataFrame(rows, "id bigint, lang string, tokens array<string>")).collect()
        assert sorted((x.slot, x.id) for x in got) == plain(rows)


def test_store(spark, tmp_path):
    t = spark.createDataFrame([(1, "a", None), (2, "b", False)], "k bigint, v string, done boolean")
    new = spark.createDataFrame([(2, "c", True), (3, "d", None)], "k bigint, v string, done boolean")
    assert [r.k for r in store.insert_ignore(t, new, ["k"]).collect()] == [3]
    assert sorted((r.k, r.v) for r in store.upsert(t, new, ["k"]).collect()) == [(1, "a"), (2, "c"), (3, "d")]
    assert sorted(r.k for r in store.expire(t, F.col("v") == "b", F.col("done")).collect()) == [1]
    assert {r.k: r.done for r in store.mark(t, new, "k", "done").collect()} == {1: None, 2: True}
    s = store.Store(spark, f"file://{tmp_path}/t")
    assert s.commit(t) == 2 and s.commit(store.upsert(t, new, ["k"])) == 3
    assert s.read().count() == 3 and store.Store(spark, f"file://{tmp_path}/t", "dry-full").commit(t) == 0
    with pytest.raises(ValueError):
        store.Store(spark, "x", "wet")


def test_all_pairs_are_counted_by_class(spark):
    r = random.Random(4)
    rows = [(i, [r.uniform(-1, 1) for _ in range(4)], r.choice("ab"), r.randrange(14)) for i in range(60)] + [(7, [0.0] * 4, "a", 1), (61, None, "a", 1), (62, [0.5] * 4, "a", None)]
    df = spark.createDataFrame([(i, v, b, d, None if d is None else d // 7) for i, v, b, d in rows], "id bigint, v array<float>, label string, day int, week int")
    want = {}
    for k, (i, v, b, d) in enumerate(rows):
        for j, w, c, e in rows[k + 1 :]:
            if v is None or w is None or b != c or i == j:
                continue
            size = (sum(x * x for x in v) * sum(x * x for x in w)) ** 0.5
            if size and sum(x * y for x, y in zip(v, w)) / size >= 0.2:
                known = d is not None and e is not None
                kind = "cross-week" if known and d // 7 != e // 7 else "same-day" if known and d == e else "same-week"
                want[kind] = want.get(kind, 0) + 1
    assert len(want) == 3
    for tile in (7, 2000):
        assert {x["class"]: x.n for x in similarity.pair_counts(df, 0.2, "label", tile=tile).collect()} == want


def test_consumed_rows_are_out_of_sight(spark):
    """The earlier row of a pair was consumed before the later one came; both at once, or the later one consumed: still in sight."""
    rows = [(1, [1.0, 0.0], 0, 0, 10, True), (2, [1.0, 0.01], 1, 0, 20, False), (3, [0.0, 1.0], 0, 0, 30, True), (4, [0.01, 1.0], 0, 0, 30, True), (5, [-1.0, 0.0], 3, 0, 40, None), (6, [-1.0, 0.01], 2, 0, 50, True), (7, [-1.0, 0.0], 9, 1, 60, True)]
    df = spark.createDataFrame(rows, "id long, v array<double>, day int, week int, at long, done boolean")
    assert {x["class"]: x.n for x in similarity.pair_counts(df, 0.99).collect()} == {"analysed": 1, "same-day": 1, "same-week": 1, "cross-week": 2}


@pytest.mark.parametrize("seed, least", [(0, 0.88), (1, 0.92), (2, 0.3)])
def test_cosine_cells_lose_no_pair(spark, seed, least):
    """Clusters of near copies around random centres, loose rows, zero, missing and short vectors; cells, tiles and neither."""
    import numpy as np

    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, 16))
    v = [(centres[i % 12] + r.normal(size=16) * r.choice([0.05, 0.2, 0.4])).tolist() for i in range(260)] + r.normal(size=(40, 16)).tolist()
    rows = [(i, x, i % 3) for i, x in enumerate(v)] + [(300, None, 0), (301, [0.0] * 16, 0), (302, [1.0, 2.0], 1), (5, v[5], 2)]
    df = spark.createDataFrame(rows, "id long, v array<double>, k int")
    u = np.zeros((len(rows), 16))
    for i, (_, x, _) in enumerate(rows):
        u[i, : len(x or ())] = x or ()
    u /= np.maximum(np.linalg.norm(u, axis=1, keepdims=True), 1e-300)
    near = u @ u.T >= least
    ids = [x[0] for x in rows]
    for block in (None, "k"):
        want = sorted((min(ids[i], ids[j]), max(ids[i], ids[j])) for i in range(len(rows)) for j in range(i) if near[i, j] and ids[i] != ids[j] and (block is None or rows[i][2] == rows[j][2]))
        for bounds in ({"pivots": 12, "tile": 10}, {"pivots": 30, "tile": 1000}, {"tile": 17, "pivots": 3}):
            assert sorted((x.a, x.b) for x in similarity.cosine_pairs(df, least, block, **bounds).collect()) == want


def test_near_dup_pair_classes_all_counts_every_pair(spark):
    from helpers import DATA
    from helpers import same_rows
    from newsloom.plans.catalog import QUERIES, SQL

    sf = DATA.replace("0.001", "0.1")
    every = QUERIES["near_dup_pair_classes_all"](spark, sf)
    ours, theirs = same_rows(every, SQL["near_dup_pair_classes_all"], sf)
    queried = QUERIES["near_dup_pair_classes"](spark, sf).collect()
    assert ours == theirs and sum(r.n for r in every.collect()) > 10 * sum(r.n for r in queried) > 0


@pytest.mark.parametrize("clash", [False, True])
def test_jaccard_pairs_in_tiles_and_with_equal_numbers(spark, monkeypatch, clash):
    """Many small tiles, a row without a block, counts that are too great; no candidate is a row of a join."""
    monkeypatch.setattr(similarity, "TILE_SETS", 7)
    monkeypatch.setattr(similarity, "COLUMN_COST", 6)
    if clash:
        monkeypatch.setattr(similarity, "_named", lambda t: F.transform(t, lambda x: F.pmod(F.xxhash64(x), F.lit(5))))
    r = random.Random(4)
    rows = [(i, r.choice(["x", "y", None]), sorted(r.sample("abcdefghijklmnopqrst", r.choice([1, 2, 3, 9, 12, 18])))) for i in range(150)]
    c = similarity.set_classes(spark.createDataFrame(rows, "id bigint, lang string, tokens array<string>"), "lang")
    held = c.collect()
    for least in (0.2, 0.5):
        found = similarity.jaccard_pairs(spark.createDataFrame(held, c.schema), least, "lang")
        sim = lambda a, b: len({*a.tokens} & {*b.tokens}) / len({*a.tokens} | {*b.tokens})
        want = {(a.rep, b.rep): sim(a, b) for a in held for b in held if a.rep < b.rep and a.lang is not None and a.lang == b.lang and sim(a, b) >= least}
        assert {(x.a, x.b): x.similarity for x in found.collect()} == pytest.approx(want) and want
        assert clash or "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()


def test_containments_of_sets_without_a_token_of_their_own(spark):
    r = random.Random(9)
    sets = sorted({tuple(sorted(r.sample("abcdefghijkl", r.randint(1, 8)))) for _ in range(70)} | {("a", "zz"), ("zzz",)})
    rows = [(i, r.choice("xy"), list(t)) for i, t in enumerate(sets)]
    got = similarity.containments(spark.createDataFrame(rows, "rep bigint, lang string, tokens array<string>"), "lang")
    want = {(min(i, j), max(i, j)) for i, k, s in rows for j, m, t in rows if i != j and k == m and set(s) < set(t)}
    assert {(x.a, x.b) for x in got.collect()} == want and want


def test_first_few_kept_reads_heads(spark):
    """As the whole scan, with heads so small that rows near to what stayed go from the rest."""
    from newsloom.plans.dedup import first_few_kept, first_kept

    r = random.Random(11)
    rows = [(i, r.choice(["x", "y", None]), r.choice([[], None]) if r.random() < 0.05 else sorted(r.sample("abcdefghijklmnop", r.randint(1, 6)))) for i in range(90)]
    df = spark.createDataFrame(rows, "id bigint, lang string, tokens array<string>")
    want = sorted(x.id for x in first_kept(df).collect())
    for most, head in ((4, 6), (len(want) + 5, 40)):
        assert sorted(x.id for x in first_few_kept(df, most, head=head).collect()) == want[:most]


def test_cosine_matches_in_tiles(spark, monkeypatch):
    """No joined rows of vectors: tiles meet; missing numbers and vectors match nothing, lengths may differ."""
    from newsloom.functions.text import cosine

    monkeypatch.setattr(similarity, "VECTOR_TILE", 8)
    r = random.Random(2)
    vec = lambda: r.choice([None, [0.0] * 4, [1.0, None, 2.0], [r.gauss(0, 1) for _ in range(3)]]) if r.random() < 0.2 else [r.gauss(0, 1) for _ in range(4)]
    e = spark.createDataFrame([(i, vec(), r.choice([1, 2, None]), i * 10) for i in range(90)], "id bigint, v array<float>, label int, ts bigint")
    q = e.where("id % 5 = 0").select(F.col("id").alias("q"), F.col("v").alias("qv"), "label", F.col("ts").alias("qt"))
    got = similarity.cosine_matches(q, e, 0.4, ["label"], (F.col("q") != F.col("id")) & (F.abs(F.col("qt") - F.col("ts")) < 600))
    assert "FlatMapCoGroupsInArrow" in got._jdf.queryExecution().executedPlan().toString()
    plain = q.join(e, "label").where((F.col("q") != F.col("id")) & (F.abs(F.col("qt") - F.col("ts")) < 600)).withColumn("similarity", cosine(F.col("qv"), F.col("v"))).where("similarity >= 0.4")
    cols = ["q", "id", "label", "qt", "ts", "similarity"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, plain.select(*cols).collect())) != []


@pytest.mark.parametrize("twins", [16_000, 3])
def test_set_join_moves_digests_and_numbers(spark, monkeypatch, twins):
    """No token is shuffled; frequent tokens as bits, more equal hashes than the list takes, several groups a tile, copies of an id."""
    for name, value in {"TWINS": twins, "FREQUENT": 9, "TILE_SETS": 40, "MET_TOKENS": 300, "COLUMN_COST": 3}.items():
        monkeypatch.setattr(similarity, name, value)
    monkeypatch.setattr(similarity, "_named", lambda t: F.transform(t, lambda x: F.shiftleft(F.pmod(F.xxhash64(x), F.lit(17)), 32)))
    r = random.Random(12)
    words = [f"w{int(60 * r.random() ** 3)}" for _ in range(4000)]
    rows = [(i, r.choice("xy"), sorted({*r.sample(words, r.choice([2, 5, 9, 14, 25]))})) for i in range(200)]
    rows += [rows[3], *[(i + 300, *rows[i][1:]) for i in range(0, 200, 9)]]
    c = similarity.set_classes(spark.createDataFrame(rows, "id bigint, lang string, tokens array<string>"), "lang")
    assert "hashpartitioning(tokens" not in c._jdf.queryExecution().executedPlan().toString()
    held, sets = c.collect(), {}
    for i, lang, t in rows:
        sets.setdefault((lang, *t), []).append(i)
    assert sorted((x.rep, x.lang, *x.tokens, x.copies) for x in held) == sorted((min(ids), *t, len(ids)) for t, ids in sets.items())
    found = similarity.jaccard_pairs(c, 0.3, "lang").collect()
    sim = lambda a, b: len({*a.tokens} & {*b.tokens}) / len({*a.tokens} | {*b.tokens})
    want = {(a.rep, b.rep): sim(a, b) for a in held for b in held if a.rep < b.rep and a.lang == b.lang and sim(a, b) >= 0.3}
    assert len(found) == len(want) > 100 and {(x.a, x.b): x.similarity for x in found} == pytest.approx(want)


def test_copies_are_found_without_shuffling_tokens(spark, monkeypatch):
    """Rows of a class by digests: what the slots' rows are read from joins no token."""
    from newsloom.plans import dedup

    plans, write = {}, dedup.stored
    monkeypatch.setattr(dedup, "stored", lambda df, name: plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString()) and write(df, name))
    rows = [(1, "x", ["a", "b"]), (2, "x", ["a", "b"]), (3, "x", ["a", "b", "c"]), (4, "x", ["a", "b"]), (5, "y", ["a", "b"]), (6, "y", []), (7, "x", None)]
    got = dedup.replaced_slots(spark.createDataFrame(rows, "id bigint, lang string, tokens array<string>")).collect()
    assert sorted((x.slot, x.id) for x in got) == [(1, 3), (5, 5), (6, 6), (7, 7)]
    assert "tokens" not in plans["linked-rows"]


def test_cosine_pairs_take_every_row_as_a_query(spark, monkeypatch, tmp_path):
    """No row is left out as a query, in tiles and whole."""
    from newsloom.plans.catalog import QUERIES

    r = random.Random(6)
    rows = [(i, [r.gauss(0, 1) for _ in range(3)], i % 2) for i in range(1, 60)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    cos = lambda x, y: sum(a * b for a, b in zip(x, y)) / (sum(a * a for a in x) * sum(b * b for b in y)) ** 0.5
    want = {(i, j) for i, x, k in rows for j, y, m in rows if i != j and k == m and cos(x, y) >= 0.3}
    for tile in (8, 4096):
        monkeypatch.setattr(similarity, "VECTOR_TILE", tile)
        got = QUERIES["cosine_pairs"](spark, str(tmp_path)).collect()
        assert {(x.q, x.id) for x in got} == want and len(got) == len(want) and len({x.q for x in got}) > 50


@pytest.mark.parametrize("clash", [False, True])
def test_containments_look_numbers_up_in_groups(spark, monkeypatch, clash):
    """Several groups and parts; sets longer than what is looked up, a row without a block, equal numbers; no token is a row of a join."""
    for name, value in {"RAREST": 3, "SMALL_SETS": 30, "MET_TOKENS": 300, "TWINS": 2 if clash else 16_000}.items():
        monkeypatch.setattr(similarity, name, value)
    if clash:
        monkeypatch.setattr(similarity, "_named", lambda t: F.transform(t, lambda x: F.shiftleft(F.pmod(F.xxhash64(x), F.lit(9)), 32)))
        monkeypatch.setattr(similarity, "FREQUENT", 4)
    plans, write = {}, similarity.stored
    for name in ("stored", "stored_once"):
        monkeypatch.setattr(similarity, name, lambda df, name: plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString()) and write(df, name), raising=False)
    r = random.Random(15)
    sets = sorted({tuple(sorted({f"w{int(40 * r.random() ** 2)}" for _ in range(r.choice([1, 2, 4, 9, 20, 40]))})) for _ in range(180)})
    rows = [(i, r.choice(["x", "x", "y", None]), list(t)) for i, t in enumerate(sets)]
    got = similarity.containments(spark.createDataFrame(rows, "rep bigint, lang string, tokens array<string>"), "lang").collect()
    want = {(min(i, j), max(i, j)) for i, k, s in rows for j, m, t in rows if k is not None and k == m and set(s) < set(t)}
    assert {(x.a, x.b) for x in got} == want and len(got) == len(want) > 100
    assert "FlatMapCoGroupsInArrow" in plans["may-contain"] and not any("hashpartitioning(token#" in p for n, p in plans.items() if n != "words")


def test_tiles_meet_in_rounds_whose_shuffle_files_go(spark, monkeypatch):
    """The same pairs; a round copies twice the sets' tokens at most on average, and leaves no shuffle file."""
    import time

    for name, value in {"TILE_SETS": 9, "MET_TOKENS": 60, "ROUND_TOKENS": 100}.items():
        monkeypatch.setattr(similarity, name, value)
    files = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()
    left, write = [], similarity.stored_once

    def kept(df, name):
        if name != "met":
            return write(df, name)
        before, out = files(), write(df, name)
        for _ in range(50):
            if files() <= before:
                break
            time.sleep(0.2)
        left.append(files() - before)
        return out

    monkeypatch.setattr(similarity, "stored_once", kept)
    r = random.Random(21)
    rows = [(i, r.choice("xy"), sorted(r.sample("abcdefghijklmnopqrst", r.choice([2, 3, 9, 12])))) for i in range(120)]
    c = similarity.set_classes(spark.createDataFrame(rows, "id bigint, lang string, tokens array<string>"), "lang")
    held = c.collect()
    found = similarity.jaccard_pairs(c, 0.5, "lang").collect()
    sim = lambda a, b: len({*a.tokens} & {*b.tokens}) / len({*a.tokens} | {*b.tokens})
    want = {(a.rep, b.rep) for a in held for b in held if a.rep < b.rep and a.lang == b.lang and sim(a, b) >= 0.5}
    assert {(x.a, x.b) for x in found} == want and len(found) == len(want) > 20
    assert len(left) > 1 and max(left) <= 0


def test_fold_takes_small_components_together(spark, monkeypatch):
    """Two hundred components in a few groups, not a group each."""
    plans, write = {}, similarity.stored_once
    monkeypatch.setattr(similarity, "stored_once", lambda df, name: plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString()) and write(df, name))
    r = random.Random(8)
    rows = [(i, i // 3 * 3 + r.randrange(3), r.randint(1, 9)) for i in range(600)]
    near = {(3 * k, 3 * k + d) for k in range(200) for d in (1, 2) if r.random() < 0.8}
    got = similarity.fold_slots(spark.createDataFrame(rows, "id long, cls long, n long"), spark.createDataFrame(sorted(near), "a long, b long"), 100).collect()
    assert sorted((x.slot, x.id) for x in got) == _fold(rows, near)
    assert "FlatMapCoGroupsInPandas [_group#" in plans["fold-changed"]
