"""Segmentation against a plain dynamic program, and the named cases."""

import functools
import math
import random

import pytest

from newsloom.operators import segment as S

ROADS = "\n".join(["# roads", "", "台61線 5 n", "中山高 5 n", "國道一號 5 n", "3死 10 m", "2傷 10 m", "3死2傷 10 m", "事故 50 n", "追撞 20", "發生 80 v", "造成 60", "回堵 9", "受傷 30", "車禍"])


def plain(run, words):
    """All paths by recursion: the greatest weight, then the longer word first."""
    total = sum(words.values())
    w = lambda f: round(math.log(f / total) * 1_000_000)

    @functools.cache
    def best(i):
        if i == len(run):
            return 0, ()
        ways = [(w(words.get(run[i], 1)) + best(i + 1)[0], i + 1)] + [(w(words[run[i:j]]) + best(j)[0], j) for j in range(i + 2, len(run) + 1) if run[i:j] in words]
        score, end = max(ways)
        return score, (run[i:end], *best(end)[1])

    out, plain_before = [], False
    for part in best(0)[1]:
        single = len(part) == 1 and part.isascii()
        if single and plain_before:
            out[-1] += part
        else:
            out.append(part)
        plain_before = single
    return out


@pytest.mark.parametrize("seed, limits", [(0, {}), (1, {"rows_limit": 0}), (2, {"chars_limit": 3})])
def test_random_dictionaries(spark, seed, limits):
    """By the trie and by the join with a dictionary that is too large for it."""
    r = random.Random(seed)
    letters = "abc天地人"
    words = {"".join(r.choice(letters) for _ in range(r.randrange(1, 5))): r.randrange(1, 30) for _ in range(60)}
    texts = [(i, " ,".join("".join(r.choice(letters + "x9") for _ in range(r.randrange(0, 25))) for _ in range(3))) for i in range(60)] + [(60, None), (61, ""), (62, "，。")]
    d = spark.createDataFrame([*words.items(), ("", 5), ("zero", 0)], "word string, freq long")
    rows = spark.createDataFrame([(i, t, 1) for i, t in texts], "id long, text string, run int")
    got = {x.id: x.segments for x in S.segment(rows, rows["text"], d, **limits).collect()}
    for i, t in texts:
        runs = "".join(c if c.isalnum() else " " for c in t or "").split()
        assert got[i] == [p for run in runs for p in plain(run, words)]


def test_named_roads_and_numbers(spark):
    d = S.dictionary_of(spark.createDataFrame([(x,) for x in ROADS.split("\n")], "value string"))
    titles = ["中山高發生追撞事故造成回堵", "台61線事故3死2傷", "【記者王小明報導】車禍三人受傷", "２０２５年國道一號車禍", "", None]
    rows = spark.createDataFrame(list(enumerate(titles)), "id long, title string")
    got = {x.id: x.tokens for x in S.title_token_sets(rows, rows["title"], d).collect()}
    assert set(got[0]) == {"中山高", "發生", "追撞", "事故", "造成", "回堵"}
    assert set(got[1]) == {"台61線", "事故", "3死2傷"}
    assert set(got[2]) == {"車禍", "受傷"}  # the number is one character, as are words it lacks
    assert set(got[3]) == {"2025", "國道一號", "車禍"}
    assert got[4] == got[5] == []


def test_no_dictionary(spark):
    rows = spark.createDataFrame([(1, "abc 天地")], "id long, t string")
    d = spark.createDataFrame([], "word string, freq long")
    assert S.segment(rows, rows["t"], d).first().segments == ["abc", "天", "地"]


@pytest.mark.parametrize("words_limit", [100, 0])
def test_large_dictionaries_are_looked_up(spark, monkeypatch, words_limit):
    """Over the trie's limits: an array up to ``words_limit`` (no row a substring), the join beyond it; the same segments."""
    monkeypatch.setattr(S, "LOOKUPS", 7)
    d = S.dictionary_of(spark.createDataFrame([(x,) for x in ROADS.split("\n")], "value string"))
    rows = spark.createDataFrame([(1, "台61線事故3死2傷"), (2, None), (3, "國道一號追撞 發生x9z回堵"), (4, "")], "id int, t string")
    want = {x.id: x.segments for x in S.segment(rows, rows["t"], d).collect()}
    got = S.segment(rows, rows["t"], d, rows_limit=0, words_limit=words_limit)
    assert {x.id: x.segments for x in got.collect()} == want
    parts = S._segmented(spark.createDataFrame([("台61線事故",)], "run string"), d, 0, 0, words_limit)
    assert ("Generate" in parts._jdf.queryExecution().executedPlan().toString()) == (words_limit == 0)
