"""Terms by the automaton against plain scans."""

import random

import pytest

from newsloom.operators import terms as K


def plain(text, names):
    out, i = [], 0
    while i < len(text):
        best = max((n for n in names if n and text.startswith(n, i)), key=len, default=None)
        if best:
            out.append((best, "known", i, i + len(best)))
        i += len(best) if best else 1
    return out


def test_leftmost_longest(spark):
    r = random.Random(1)
    names = {"".join(r.choice("abアイ") for _ in range(r.randrange(1, 5))) for _ in range(25)}
    rows = [(i, "".join(r.choice("abアイx ") for _ in range(r.randrange(80)))) for i in range(80)] + [(80, None), (81, "")]
    got = {}
    for x in K.find_terms(spark.createDataFrame(rows, "id int, text string"), spark.createDataFrame([(n,) for n in [*names, "", None, *list(names)[:3]]], "term string")).collect():
        got.setdefault(x.id, []).append((x.term, x.kind, x.start, x.end))
    for i, t in rows:
        assert sorted(x for x in got.get(i, []) if x[1] == "known") == sorted(plain(t or "", names))


def test_marked_and_unmarked_terms_that_the_base_lacks(spark):
    rows = [(1, "[[エーテル]]とテレポとクリスタルタワー"), (2, "エーテル [[ Foo ]] [[]] [[ ]] [[エーテル]] アイ"), (3, "テレポ [[テレポ]] クリスタルタワー")]
    found = K.find_terms(spark.createDataFrame(rows, "id int, text string"), spark.createDataFrame([("テレポ",)], "term string"))
    got = {(x.term, x.kind): (x.n, x.n_rows, x.first_id) for x in K.missing_terms(found).collect()}
    assert got == {("エーテル", "marked"): (2, 2, 1), ("クリスタルタワー", "katakana"): (2, 2, 1), ("Foo", "marked"): (1, 1, 2)}
    assert sorted((x.id, x.start, x.end) for x in found.where("kind = 'known'").collect()) == [(1, 9, 12), (3, 0, 3), (3, 6, 9)]


def test_no_base_and_too_large_a_base(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "カタカナ [[x]]")], "id int, text string")
    none = spark.createDataFrame([], "term string")
    assert sorted((x.term, x.kind) for x in K.find_terms(rows, none).collect()) == [("x", "marked"), ("カタカナ", "katakana")]
    monkeypatch.setattr(K, "TERMS", 1)
    with pytest.raises(ValueError):
        K.find_terms(rows, spark.createDataFrame([("a",), ("b",)], "term string"))


def test_known_counts_without_a_shuffle(spark):
    """One row a row, as the occurrences tell; also rows of one id and without text."""
    rows = spark.createDataFrame([(1, "abab abc"), (1, "b"), (2, None), (None, "")], "id bigint, text string")
    got = K.known_counts(rows, spark.createDataFrame([("ab",), ("abc",), ("b",)], "term string"))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, 3, 2, 7), (1, 1, 1, 1), (2, 0, 0, 0), (None, 0, 0, 0)], key=str)
