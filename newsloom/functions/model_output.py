"""What generated text and nested answers hold: labelled fields, JSON inside prose, JSON inside JSON, vectors as text, paths of settings.

Built-in expressions; ``flatten_json`` takes a round a level of nesting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.operators.store import discard, stored

# Fixed values of the answer format: labels of its lines, levels, separators of tags.
SUMMARY, ANALYSIS, LEVEL, REASON, TAGS, PLACE = "摘要：", "分析：", "重要性：", "重要性原因：", "標籤：", "地區："
LEVELS, USUAL = ("高", "中", "低"), "中"
ENDS_ANALYSIS = (SUMMARY, LEVEL, REASON, PLACE)
ENDS_SUMMARY = (ANALYSIS, LEVEL, REASON, PLACE)
CALL, AGGREGATOR = "Fbv4je", "news.google.com"


def _lines(text: Column) -> Column:
    return F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|[\n\r]"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))


def _last(lines: Column, label: str) -> Column:
    """What follows the label on the last line that starts with it; null without one."""
    own = F.filter(lines, lambda x: F.startswith(x, F.lit(label)))
    return F.trim(F.substring(F.try_element_at(own, F.lit(-1)), len(label) + 1, F.lit(2**31 - 1)))


def _block(lines: Column, label: str, ends: tuple[str, ...]) -> Column:
    """The first line with the label and those after it, up to an empty line or one of another label, joined."""
    start = F.array_position(F.transform(lines, lambda x: F.startswith(x, F.lit(label))), True).cast("int")
    after = F.slice(lines, start + 1, F.size(lines))
    stop = F.array_position(F.transform(after, lambda x: (x == "") | F.exists(F.array(*map(F.lit, ends)), lambda e: F.startswith(x, e))), True).cast("int")
    body = F.slice(after, F.lit(1), F.when(stop > 0, stop - 1).otherwise(F.size(after)))
    first = F.trim(F.substring(F.get(lines, start - 1), len(label) + 1, F.lit(2**31 - 1)))
    # a line with the label again does not end the block and is part of it as it stands
    return F.when(start > 0, F.concat(first, F.array_join(body, ""))).otherwise("")


def answer_fields(text: Column) -> Column:
    """summary, analysis, importance, importance_reason, tags, location of an answer in labelled lines.

    The last line of a label counts; an empty summary or analysis is looked for over several lines, a summary that
    is still empty is the text's first 300 characters. Unknown levels are the usual one; a null text is empty.
    """
    lines = _lines(text)
    line = lambda label: F.coalesce(_last(lines, label), F.lit(""))
    levels = F.filter(F.transform(F.filter(lines, lambda x: F.startswith(x, F.lit(LEVEL))), lambda x: F.left(F.trim(F.substring(x, len(LEVEL) + 1, F.lit(2**31 - 1))), F.lit(1))), lambda v: v.isin(*LEVELS))
    tags = F.filter(F.transform(F.split(line(TAGS), "[,、，]"), lambda t: F.trim(t)), lambda t: t != "")
    full = lambda label, ends: F.when(line(label) != "", line(label)).otherwise(_block(lines, label, ends))
    summary = full(SUMMARY, ENDS_SUMMARY)
    return F.struct(
        F.when(summary == "", F.left(F.coalesce(text, F.lit("")), F.lit(300))).otherwise(summary).alias("summary"), full(ANALYSIS, ENDS_ANALYSIS).alias("analysis"),
        F.coalesce(F.try_element_at(levels, F.lit(-1)), F.lit(USUAL)).alias("importance"), line(REASON).alias("importance_reason"), tags.alias("tags"), line(PLACE).alias("location"),
    )


def outermost_object(text: Column) -> Column:
    """From the first brace to the one that closes it; null without such a pair."""
    start = F.instr(text, "{")
    braces = F.regexp_extract_all(F.substr(text, start), F.lit(r"[^{}]*[{}]"), F.lit(0))
    none = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("size"), F.lit(False).alias("done"))

    def step(s: Column, part: Column) -> Column:
        depth = s["depth"] + F.when(F.endswith(part, F.lit("{")), 1).otherwise(-1)
        return F.when(s["done"], s).otherwise(F.struct(depth.alias("depth"), (s["size"] + F.length(part)).alias("size"), (depth == 0).alias("done")))

    end = F.aggregate(braces, none, step)
    return F.when((start > 0) & end["done"], F.substring(text, start, end["size"]))


def excluded(text: Column) -> Column:
    """The names that an answer excludes: strings of ``exclude`` in its outermost object; none where it can't be read."""
    v = F.try_parse_json(outermost_object(text))
    names = F.try_variant_get(v, "$.exclude", "array<variant>")
    # a string's own text: other kinds have no string form
    kept = F.filter(F.transform(names, lambda x: F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string"))), lambda x: x.isNotNull())
    return F.coalesce(kept, F.array().cast("array<string>"))


def kept_candidates(candidates: DataFrame, answers: DataFrame, group: str, order: str) -> DataFrame:
    """candidates of each group but those that its answer names: N1 is the first in order. Groups without an answer stay.

    candidates: group, order and more; answers: group, text (one row a group).
    """
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy(group).orderBy(order))  # the candidates that one prompt held
    gone = answers.select(group, F.explode(F.array_distinct(excluded(F.col("text")))).alias("_name"))
    named = candidates.withColumn("_name", F.concat(F.lit("N"), nth.cast("string")))
    return named.join(gone, [group, "_name"], "left_anti").select(*candidates.columns)


def vector_of_text(text: Column) -> Column:
    """``[x, y, ...]`` as an array of doubles; null where a part is no number."""
    inner = F.regexp_replace(text, r"^[\[\] \t\n]+|[\[\] \t\n]+$", "")
    parts = F.transform(F.split(inner, ","), lambda x: F.trim(x).try_cast("double"))
    return F.when(text.isNotNull() & ~F.exists(parts, lambda x: x.isNull()), parts)


def resolved_url(text: Column) -> Column:
    """The address in a batch answer: of the first line of the call, its second part read as JSON again. Answers that
    cannot be read, that lead back to the aggregator or to no web address give null (or the next line's address)."""
    lines = F.filter(F.split(text, r"\r\n|[\n\r]"), lambda x: F.contains(x, F.lit(CALL)))

    def url(line: Column) -> Column:
        inner = F.try_variant_get(F.try_parse_json(line), "$[0][2]", "string")
        v = F.try_variant_get(F.try_parse_json(inner), "$[1]", "variant")
        return F.when(F.try_variant_get(v, "$", "string").isNull(), F.struct(F.lit(True).alias("bad"), F.lit(None).cast("string").alias("url"))).otherwise(F.struct(F.lit(False).alias("bad"), F.try_variant_get(v, "$", "string").alias("url")))

    fine = lambda u: ~u["bad"] & F.startswith(u["url"], F.lit("http")) & ~F.contains(u["url"], F.lit(AGGREGATOR))
    deciding = F.filter(F.transform(lines, url), lambda u: u["bad"] | fine(u))
    return F.get(deciding, F.lit(0))["url"]


def flatten_json(rows: DataFrame, key: str, text: str) -> DataFrame:
    """key, path, value, kind of every scalar: ``a.b[0]``; a scalar alone has the path ``<root>``. Text that is no JSON gives no row.

    A round a level; rows of a level are exploded where they are, nothing is gathered.
    """
    spark = rows.sparkSession
    level = rows.select(key, F.lit("").alias("path"), F.try_parse_json(text).alias("v")).where("v is not null")
    done, tables = [], []
    while True:
        kind = F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0)
        level = stored(level.withColumn("kind", kind), "json-level")
        tables.append(level)
        nested = F.col("kind").isin("OBJECT", "ARRAY")
        done.append(level.where(~nested).select(key, F.when(F.col("path") == "", "<root>").otherwise(F.col("path")).alias("path"), F.try_variant_get("v", "$", "string").alias("value"), "kind"))
        deeper = level.where(nested)
        if deeper.isEmpty():
            break
        dot = F.when(F.col("path") == "", F.col("key")).otherwise(F.concat("path", F.lit("."), "key"))
        step = F.when(F.col("kind") == "ARRAY", F.concat("path", F.lit("["), F.col("pos").cast("string"), F.lit("]"))).otherwise(dot)
        level = deeper.withColumnRenamed(key, "_id").lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select(F.col("_id").alias(key), step.alias("path"), F.col("value").alias("v"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    flat = stored(out, "json-paths")
    discard(*tables)
    return flat


def drift(before: DataFrame, after: DataFrame, on: list[str]) -> DataFrame:
    """The keys and ``drift``: added, missing, changed or same; values and their kinds are compared (of ``flatten_json``)."""
    a, b = (df.select(*on, F.struct("value", "kind").alias(x)) for df, x in ((before, "_a"), (after, "_b")))
    verdict = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "missing").when(F.col("_a").eqNullSafe(F.col("_b")), "same").otherwise("changed")
    return a.join(b, on, "full_outer").select(*on, verdict.alias("drift"))
