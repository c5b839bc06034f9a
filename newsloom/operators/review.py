"""Mechanical checks of generated reports against their numbered sources: what was matched, and where it stands.

All checks are built-in functions over one report's row but Unicode composition (``udf.nfkc``, Arrow batches).
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.udf import comparable, html_unescape, nfkc

# Fixed values of the report rules: headings, words, labels, patterns, limits, texts that say nothing.
DIGEST_HEADINGS = ("### 本期概覽", "### 分節彙整", "### 待追蹤")
TITLE_ONLY_HEADING = "### 僅標題"
HOT_HEADINGS = ("### 一、", "### 二、", "### 三、")
INDEPENDENCE = ("互相獨立", "無直接因果", "各自獨立")
LABEL, LABEL_WINDOW = "報導", 10
SHORT, DELETED = 20, 0.30
BRACKET = r"\[(\s*\d+(?:\s*[,，、]\s*\d+)*\s*)\]"
SELF_COUNT = r"(?:本期)?共[^，。；\n]{0,8}?\d[\d,]*\s*[起個][^，。；\n]{0,8}?事件"
DATE = r"(?<!\d)(?:\d{2,4}\s*年\s*)?(\d{1,2})\s*月\s*(\d{1,2})\s*日"
NUMBER = r"\d{1,3}(?:,\d{3})+(?:\.\d+)?|\d+(?:\.\d+)?"
SHARES, PIECES = r"交織度分布[：:](.*)", r"(\d+)\s*篇"
TAG = r"</?[A-Za-z][^<>]*(?:>|\z)"
BOILERPLATE = (
    "0則貼文 | 快來參與LINE TODAY討論牆上的討論 |",
    "台視影音：提供台視最新的綜藝、專題、節目預告及新聞影音，並有數個完整影音節目，供網友選擇收看。",
    "台灣新聞雲報提供台灣最中立最公正最即時的各類型新聞報導，包括政治新聞、焦點新聞、社會新聞、國際新聞、地方新聞、娛樂新聞、"
    "科技新聞、專訪新聞、政黨新聞、藝文活動、美食推廣、體育賽事等相關新聞報導。歡迎各界好友踴躍贊助推廣。",
)

SOURCES = "array<struct<title:string,summary:string>>"
REPLACEMENTS = "array<struct<quote:string,replacement:string>>"


def spans(text: Column, pattern: str) -> Column:
    """value, start, end (code points, end exclusive) of every match, from left to right."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)), F.length)
    none = F.array().cast("array<struct<value:string,start:int,end:int>>")

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        end = start + F.length(x["hit"])
        return F.struct(end.alias("at"), F.array_append(state["out"], F.struct(x["hit"].alias("value"), start.alias("start"), end.alias("end"))).alias("out"))

    pairs = F.zip_with(gaps, hits, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")), add, lambda s: s["out"])


def followed_by(text: Column, span: Column, label: str, window: int) -> Column:
    """Whether the label stands whole within so many characters after a span."""
    return F.contains(F.substring(text, span["end"] + 1, F.lit(window)), F.lit(label))


def section(text: Column, heading: str) -> Column:
    """What stands under the headings that start so, up to the next one of their level."""
    blocks = F.filter(F.split(text, r"\n(?=### )"), lambda b: F.startswith(b, F.lit(heading)) & F.startswith(b, F.lit("### ")))
    return F.array_join(F.transform(blocks, lambda b: F.regexp_replace(b, r"^[^\n]*\n?", "")), "\n")


def cited(text: Column) -> Column:
    """The source numbers of [1] or [1, 2], in order, repeats kept; other brackets are none."""
    return F.flatten(F.transform(F.regexp_extract_all(text, F.lit(BRACKET), F.lit(1)), lambda g: F.transform(F.regexp_extract_all(g, F.lit(r"\d+"), F.lit(0)), lambda x: x.cast("int"))))


def _bracketed(ids: Column) -> Column:
    return F.array_distinct(F.transform(ids, lambda i: F.format_string("[%d]", i)))


def unknown_citations(text: Column, n_sources: Column) -> Column:
    return F.filter(cited(text), lambda i: (i < 1) | (i > n_sources))


def missing_headings(text: Column, headings: tuple[str, ...] | list[str]) -> Column:
    lines = F.split(text, "\n")
    return F.filter(F.array(*map(F.lit, headings)), lambda h: ~F.exists(lines, lambda x: F.startswith(x, h)))


def unlabelled_dates(text: Column, sources: Column) -> Column:
    """Dates without the label behind them that no source shows (as month and day, or with a slash)."""
    corpus = F.transform(F.flatten(F.transform(sources, lambda s: F.array(s["title"], s["summary"]))), lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", ""))

    def unknown(span: Column) -> Column:
        month, day = (F.regexp_extract(span["value"], DATE, k).cast("int").cast("string") for k in (1, 2))
        shown = F.concat(F.lit(r"(?<!\d)0?"), month, F.lit("月0?"), day, F.lit(r"日|(?<!\d)0?"), month, F.lit("/0?"), day, F.lit(r"(?!\d)"))
        return ~followed_by(text, span, LABEL, LABEL_WINDOW) & ~F.exists(corpus, lambda c: F.regexp_like(c, shown))

    return F.array_distinct(F.transform(F.filter(spans(text, DATE), unknown), lambda s: s["value"]))


def wrong_shares(text: Column, total: Column) -> Column:
    """Lines of shares whose counts do not add up to the number of sources."""
    tails = F.transform(F.split(text, "\n"), lambda x: F.regexp_extract(x, SHARES, 1))
    counts = F.transform(tails, lambda t: F.transform(F.regexp_extract_all(t, F.lit(PIECES), F.lit(1)), lambda x: x.cast("int")))
    added = lambda c: F.aggregate(c, F.lit(0), lambda s, x: s + x)
    wrong = F.filter(counts, lambda c: (F.size(c) > 0) & (added(c) != total))
    return F.transform(wrong, lambda c: F.concat(F.array_join(c.cast("array<string>"), "+"), F.lit("="), added(c).cast("string"), F.lit("≠"), total.cast("string")))


def with_numbers(rows: DataFrame) -> DataFrame:
    """The rows with ``_known`` (numbers of the sources, without separators of thousands) and ``_made`` (composed
    quotes and replacements): columns of their own, as no function of an array may call the composing one."""
    text = lambda c: F.coalesce(c, F.lit(""))
    known = nfkc(text(F.array_join(F.transform("sources", lambda s: F.concat_ws("\n", s["title"], s["summary"])), "\n")))
    made = nfkc(text(F.array_join(F.transform("replacements", lambda r: F.concat(text(r["quote"]), F.lit("\u0001"), text(r["replacement"]))), "\u0002")))
    return rows.withColumns({"_known": known, "_made": made}).withColumn("_known", _bare(F.regexp_extract_all("_known", F.lit(NUMBER), F.lit(0))))


def _bare(found: Column) -> Column:
    return F.transform(found, lambda x: F.replace(x, F.lit(","), F.lit("")))


def new_numbers(known: Column, made: Column) -> Column:
    """Numbers of replacements that neither the sentence they replace nor the sources hold (of ``with_numbers``)."""

    def added(pair: Column) -> Column:
        quote, new = (F.coalesce(F.try_element_at(F.split(pair, "\u0001"), F.lit(k)), F.lit("")) for k in (1, 2))
        allowed = F.array_union(known, _bare(F.regexp_extract_all(quote, F.lit(NUMBER), F.lit(0))))
        return F.filter(F.regexp_extract_all(new, F.lit(NUMBER), F.lit(0)), lambda n: ~F.array_contains(allowed, F.replace(n, F.lit(","), F.lit(""))))

    return F.array_distinct(F.flatten(F.transform(F.split(made, "\u0002"), added)))


def deleted_share(replacements: Column, original: Column) -> Column:
    """What replacements take away of the original; longer ones give nothing back."""
    gone = F.aggregate(replacements, F.lit(0), lambda s, r: s + F.greatest(F.lit(0), F.length(F.coalesce(r["quote"], F.lit(""))) - F.length(F.coalesce(r["replacement"], F.lit("")))))
    return F.try_divide(gone, F.length(original))


def deletion_over_cap(replacements: Column, original: Column, cap: float = DELETED) -> Column:
    share = deleted_share(replacements, original)
    return F.when(share > cap, F.array(F.concat(F.bround(share * 100, 1).cast("string"), F.lit("%")))).otherwise(F.array().cast("array<string>"))


def _plain(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKC", text).lower() if not c.isspace() and unicodedata.category(c)[0] not in "PZ")


def title_only(title: Column, summary: Column) -> Column:
    """A source whose summary, without tags and standing texts, adds less than twenty characters to its title."""
    s = comparable(html_unescape(F.regexp_replace(F.coalesce(summary, F.lit("")), TAG, "")))
    for b in BOILERPLATE:
        s = F.replace(s, F.lit(_plain(b)), F.lit(""))
    title = F.coalesce(title, F.lit(""))
    short = F.when(F.contains(title, F.lit(" - ")), F.regexp_extract(title, r"(?s)^(.*) - ", 1)).otherwise(title)
    adds = lambda t: ~F.contains(t, s) & (F.length(F.replace(s, t, F.lit(""))) >= SHORT)
    return (s == "") | ~(adds(comparable(title)) & adds(comparable(short)))


def _text_checks(text: Column, sources: Column, title_only_ids: Column) -> dict[str, tuple[Column, Column]]:
    """name -> (hits in a digest, hits in a hot topic's report); null where a check is not made."""
    n, none = F.size(sources), F.lit(None).cast("array<string>")
    lost = F.when(F.size(title_only_ids) > 0, missing_headings(text, (*DIGEST_HEADINGS, TITLE_ONLY_HEADING))).otherwise(missing_headings(text, DIGEST_HEADINGS))
    out = _bracketed(unknown_citations(text, n))
    inside = F.filter(cited(section(text, DIGEST_HEADINGS[1])), lambda i: F.array_contains(title_only_ids, i))
    return {
        "missing_section": (lost, missing_headings(text, HOT_HEADINGS)),
        "id_out_of_range": (out, out),
        "interweave_sum": (none, wrong_shares(text, n)),
        "title_only_in_sections": (_bracketed(inside), none),
        "self_count": (F.array_distinct(F.regexp_extract_all(section(text, DIGEST_HEADINGS[0]), F.lit(SELF_COUNT), F.lit(0))), none),
        "independence_claim": (F.filter(F.array(*map(F.lit, INDEPENDENCE)), lambda w: F.contains(text, w)), none),
        "date_unlabeled": (unlabelled_dates(text, sources), none),
    }


def check_reports(rows: DataFrame) -> DataFrame:
    """The rows with ``checks``: a map of each check's name to its hits, of checks that the template has.

    rows: text, template (``digest`` or ``hot``), sources, title_only_ids (array of numbers), original
    (null: none; else only hits that the original lacks stay), replacements. Null arrays are empty, a null
    text is; another template has no text checks; replacements without an original count as none deleted.
    """
    kinds = {"sources": SOURCES, "title_only_ids": "array<int>", "replacements": REPLACEMENTS}
    filled = with_numbers(rows.withColumns({c: F.coalesce(c, F.array().cast(kind)) for c, kind in kinds.items()}))
    sources, ids = F.col("sources"), F.col("title_only_ids")
    now, before = (_text_checks(F.coalesce(c, F.lit("")), sources, ids) for c in ("text", "original"))
    pick = lambda two: F.when(F.col("template") == "digest", two[0]).when(F.col("template") == "hot", two[1])
    fresh = lambda a, b: F.when(F.col("original").isNull(), a).otherwise(F.filter(a, lambda h: ~F.array_contains(b, h)))
    hits = {k: fresh(pick(two), pick(before[k])) for k, two in now.items()}
    hits |= {"replacement_new_number": new_numbers(F.col("_known"), F.col("_made")), "deletion_over_cap": deletion_over_cap(F.col("replacements"), F.coalesce("original", F.lit("")))}
    every = F.map_from_arrays(F.array(*map(F.lit, hits)), F.array(*hits.values()))
    return filled.withColumn("checks", F.map_filter(every, lambda k, v: v.isNotNull())).drop("_known", "_made")


def check_table(before: DataFrame, after: DataFrame) -> DataFrame:
    """id, check, original, revised: the hits of each check in both versions (of ``check_reports``); null where a version is missing."""
    one = lambda df, name: df.select("id", F.explode("checks").alias("check", name))
    return one(before, "original").join(one(after, "revised"), ["id", "check"], "full_outer")


def added_findings(before: Column, after: Column) -> Column:
    """Findings that were not there before, in order, repeats kept."""
    return F.filter(after, lambda x: ~F.array_contains(before, x))


def numbered_input(title: Column, summary: Column, rank: Column) -> Column:
    """One line of a report's input."""
    return F.format_string("[%d] %s\n%s", rank, title, F.coalesce(F.substring(summary, 1, 200), F.lit("")))
