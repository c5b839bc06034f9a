"""Report checks: sections, citations, counts, dates, shares, replacements, sources with nothing but a title."""

import random
import re

import pytest
from pyspark.sql import functions as F

from newsloom.operators import review as R

SCHEMA = f"id long, text string, template string, sources {R.SOURCES}, title_only_ids array<int>, original string, replacements {R.REPLACEMENTS}"
SOURCES = [("台中市科技執法上路", "自下月起在三處路口取締闖紅燈，10/2 起勸導。"), ("道安會報", "道安會報"), ("公布統計", "前七月死亡 1,569 人，年減 1.1%，9 月 08 日")]


def digest(overview="本期收錄 3 篇報導。", sections="- 啟用科技執法 [1]。", tracking="- 後續 [1]。", title_only="- 會報 [2]"):
    lines = ["### 本期概覽", overview, "", "### 分節彙整", "#### 中央", sections, "", "### 待追蹤", tracking]
    return "\n".join(lines + ([] if title_only is None else ["", "### 僅標題", title_only]))


def hot(shares):
    return "\n".join(["### 一、 解構", shares, "[1]", "### 二、 審查", "不適用 [直接證據]", "### 三、 論述", "引述 [3]"])


CASES = [
    ("digest", digest(), None, [], {}),
    ("digest", digest(overview="本期共收錄 19 起獨立事件，涵蓋三面向。"), None, [], {"self_count": ["本期共收錄 19 起獨立事件"]}),
    ("digest", digest(sections="- 本期共收錄 3 起獨立事件 [1]。"), None, [], {}),
    ("digest", digest(title_only=None), None, [], {"missing_section": ["### 僅標題"]}),
    ("digest", digest(sections="甲 [1、4] 乙 [0] 丙 [工程主導] [2]"), None, [], {"id_out_of_range": ["[4]", "[0]"], "title_only_in_sections": ["[2]"]}),
    ("digest", digest(sections="甲與乙互相獨立 [1]。"), None, [], {"independence_claim": ["互相獨立"]}),
    ("digest", digest(sections="於 2026 年 10 月 9 日質詢，10月2日勸導，9月8日，116 年 1 月 8 日（報導日期），1 月 8 日開罰"), None, [], {"date_unlabeled": ["2026 年 10 月 9 日", "1 月 8 日"]}),
    ("hot", hot("交織度分布：[工程主導] 1 篇 ／ [人因主導] 2 篇"), None, [], {}),
    ("hot", hot("交織度分布:[工程主導] 1 篇 ／ [人因主導] 3 篇"), None, [], {"interweave_sum": ["1+3=4≠3"]}),
    ("hot", hot("交織度分布：不適用").replace("### 二、", "#### 二、"), None, [], {"missing_section": ["### 二、"]}),
    ("digest", digest(sections="死亡 １,777 人，減少 10.7%，156 人，1569 人，3 處 [1]"), digest(sections="共 3 處 [1]"), [("共 3 處", "死亡 １,777 人，減少 10.7%，156 人，1569 人，3 處")], {"replacement_new_number": ["1,777", "10.7", "156"]}),
    ("digest", "x" * 69, "x" * 100, [("x" * 31, "")], {"deletion_over_cap": ["31.0%"]}),
    ("digest", "x" * 100, "x" * 100, [("x" * 31, ""), ("", "y" * 31)], {"deletion_over_cap": ["31.0%"]}),
    ("digest", "x" * 70, "x" * 100, [("x" * 30, "")], {}),
    ("digest", digest(overview="互相獨立，共 3 起事件"), digest(overview="互相獨立"), [], {"self_count": ["共 3 起事件"]}),
    ("other", digest(title_only=None), None, [], {}),
    ("digest", None, None, None, {"missing_section": ["### 本期概覽", "### 分節彙整", "### 待追蹤", "### 僅標題"]}),
]


def test_checks(spark):
    rows = [(i, text, kind, SOURCES, [2], before, made) for i, (kind, text, before, made, _) in enumerate(CASES)]
    got = {r.id: r.checks for r in R.check_reports(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, (kind, text, *_, want) in enumerate(CASES):
        assert {k: v for k, v in got[i].items() if v} == want, text
    assert set(got[0]) == {"missing_section", "id_out_of_range", "title_only_in_sections", "self_count", "independence_claim", "date_unlabeled", "replacement_new_number", "deletion_over_cap"}
    assert set(got[7]) == {"missing_section", "id_out_of_range", "interweave_sum", "replacement_new_number", "deletion_over_cap"}
    none = [(1, "x", "hot", None, None, None, None)]
    assert R.check_reports(spark.createDataFrame(none, SCHEMA)).first().checks["id_out_of_range"] == []


def test_table_before_and_after(spark):
    make = lambda text: R.check_reports(spark.createDataFrame([(1, text, "digest", SOURCES, [2], None, [])], SCHEMA))
    rows = {r.check: (r.original, r.revised) for r in R.check_table(make(digest(sections="各自獨立 [9]")), make(digest(title_only=None))).collect()}
    assert rows["independence_claim"] == (["各自獨立"], []) and rows["missing_section"] == ([], ["### 僅標題"]) and len(rows) == 8


def test_spans_stand_where_they_match(spark):
    r = random.Random(2)
    texts = ["", None, "12", "a1b22c333", "é1日2😀3"] + ["".join(r.choice("ab日😀 19.") for _ in range(r.randrange(60))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {x.id: x.s for x in df.select("id", R.spans(F.col("t"), r"\d+(?:\.\d+)?").alias("s")).collect()}
    for i, t in enumerate(texts):
        if t is None:
            assert got[i] is None
        else:
            assert [(s.value, s.start, s.end) for s in got[i]] == [(m.group(), m.start(), m.end()) for m in re.finditer(r"\d+(?:\.\d+)?", t)]


TWENTY = "甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳午未申酉"


@pytest.mark.parametrize("title, summary, want", [
    ("A 標題", "", True), ("A 標題", None, True), ("台中市科技執法上路", "「台中市」科技執法，上路！", True), ("標題很長很長", "很長", True),
    ("標題", "標題" + TWENTY, False), ("標題", "標題" + TWENTY[:-1], True), ("標題", "標題，" + TWENTY[:-1] + "。  ！", True), ("少年闖紅燈 - 自由時報", "少年闖紅燈&nbsp;&nbsp;自由時報", True),
    ("少年闖紅燈 - 自由時報", '<a href="https://x/y?oc=5" target="_blank">少年闖紅燈</a>&nbsp;<font color="#6f6f6f">自由時報</font>', True), ("題", '<a href="https://x/abc', True),
    ("題", "0則貼文 | 快來參與LINE TODAY討論牆上的討論 |", True), ("題", "速限 < 50，" + TWENTY, False), ("題", "&lt;b&gt;" + TWENTY, False), (None, TWENTY, False), ("ＡＢＣ", "abc", True),
])
def test_title_only(spark, title, summary, want):
    df = spark.createDataFrame([(title, summary)], "t string, s string")
    assert df.select(R.title_only(F.col("t"), F.col("s")).alias("x")).first().x is want
