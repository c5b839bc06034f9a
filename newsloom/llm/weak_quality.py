"""Quality rules as weak supervision: rules vote or abstain, EM finds their accuracies.

Every document gets whole-text counts and the votes of ``RULES``: 1 (good), 0 (bad)
or -1 (abstain). Votes are modelled as conditionally independent given an unseen
quality: rule j, when it does not abstain, says "good" with probability a_j on good
documents and b_j on bad ones. Expectation-maximisation over the table of vote
patterns (at most 3^rules rows, whatever the corpus) estimates the shares and
accuracies from the documents that pass the base rules, and a document is kept when its posterior probability of good is at
least ``LEAST`` and the base rules do not fail it. EM runs until its estimates stand still.

Only DataFrame operations. One scan writes the counts of each document (repeated
three-word windows by sorting 64-bit hashes of the windows inside the row, so no
text is shuffled); patterns are a partially aggregated ``groupBy``; every EM round
is one aggregate of the pattern table, whose 2 * rules + 1 numbers come to the
driver. Posteriors are joined back by pattern, a table of bounded size.

Edge cases: null and empty texts have no words, fail the base rules and are not
kept; very long texts are one row's work; repeated rows count as often as they
occur; an empty table gives no rows. Two windows count as equal when their 64-bit
hashes are: within one text of a million words a false match has odds of 1 in 10^7.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE, stored, table, text_of

#: EM ends when no estimate moves by more than TOLERANCE (after ROUNDS at the latest).
ROUNDS, TOLERANCE, LEAST = 100, 1e-4, 0.5
#: The share of good documents, and of good votes on good and on bad documents.
START = (0.8, 0.97, 0.6)
#: Counted by the rule "marks": ASCII characters that are neither letters nor digits nor white space.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: name, feature, good when, bad when (SQL conditions on the counts); else it abstains.
RULES = (
    ("length", "n_words >= 50", "n_words < 20"),
    ("word_length", "word_chars between 3 * n_words and 10 * n_words", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    ("symbols", "100 * n_symbols <= 2 * n_words", "100 * n_symbols > 20 * n_words"),
    ("lines", "100 * n_dup_lines <= 5 * n_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("repeats", "100 * n_repeat_words <= 15 * n_words", "100 * n_repeat_words > 40 * n_words"),
    ("capitals", "100 * n_upper <= 12 * word_chars", "100 * n_upper > 40 * word_chars"),
    ("digits", "100 * n_digits <= 8 * word_chars", "100 * n_digits > 25 * word_chars"),
    ("marks", "100 * n_marks <= 6 * word_chars", "100 * n_marks > 9 * word_chars"),
)


def counts(docs: DataFrame) -> DataFrame:
    """doc_id and the whole-text counts; the text itself is dropped."""
    t = text_of()
    white = " \t\n\x0b\x0c\r"
    has_word = lambda line: F.length(F.translate(line, white, "")) > 0
    a = docs.select(
        "doc_id",
        F.array_remove(F.split(t, WHITE), "").alias("w"),
        F.filter(F.split(t, "\n"), has_word).alias("lines"),
        F.length(F.translate(t, white, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.length(t) - F.length(F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long").alias("n_upper"),
        (F.length(t) - F.length(F.translate(t, "0123456789", ""))).cast("long").alias("n_digits"),
        (F.length(t) - F.length(F.translate(t, MARKS, ""))).cast("long").alias("n_marks"),
    )
    window = lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2))
    b = a.select(
        "doc_id", "word_chars", "n_symbols", "n_upper", "n_digits", "n_marks",
        F.size("w").cast("long").alias("n_words"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform(F.slice("w", F.lit(1), F.greatest(F.size("w") - 2, F.lit(0))), window).alias("h"),
    )
    # Texts with a repeat: (hash, place) sorted; a window is repeated when a neighbour has its hash.
    repeats = F.size(F.array_distinct("h")) < F.size("h")
    pairs = F.sort_array(F.arrays_zip(F.col("h").alias("h"), F.sequence(F.lit(0), F.size("h") - 1).alias("i")))
    c = b.withColumn("p", F.when(repeats, pairs)).withColumn("s", F.col("p.h")).withColumn("i", F.col("p.i"))
    rest = F.size("s") - 1
    c = c.withColumn("e", F.zip_with(F.slice("s", F.lit(1), rest), F.slice("s", F.lit(2), rest), lambda x, y: x == y))
    no = F.array(F.lit(False))
    hits = F.filter(F.arrays_zip(F.col("i").alias("i"), F.concat(no, "e").alias("x"), F.concat("e", no).alias("y")), lambda z: z["x"] | z["y"])
    d = c.withColumn("at", F.sort_array(hits["i"]))
    # Each repeated window covers three words, less where the next one starts inside it.
    steps = F.zip_with(F.slice("at", F.lit(1), F.size("at") - 1), F.slice("at", F.lit(2), F.size("at") - 1), lambda x, y: F.least(F.lit(3), y - x))
    covered = F.when(F.size("at") > 0, F.aggregate(steps, F.lit(3), lambda s, x: s + x)).otherwise(0)
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"), "n_lines", "n_upper", "n_digits", "n_marks")


def votes(counted: DataFrame) -> DataFrame:
    """Adds v0, v1, ...: 1, 0 or -1 (abstain)."""
    for j, (_, good, bad) in enumerate(RULES):
        counted = counted.withColumn(f"v{j}", F.when(F.col("n_words") == 0, -1).when(F.expr(good), 1).when(F.expr(bad), 0).otherwise(-1))
    return counted


def _posterior(prior: float, good: list[float], bad: list[float]) -> Column:
    """P(good | votes) of a pattern."""
    up, down = F.lit(prior), F.lit(1 - prior)
    for j, (a, b) in enumerate(zip(good, bad, strict=True)):
        v = F.col(f"v{j}")
        up = up * F.when(v == 1, a).when(v == 0, 1 - a).otherwise(1.0)
        down = down * F.when(v == 1, b).when(v == 0, 1 - b).otherwise(1.0)
    return up / (up + down)


def accuracies(patterns: DataFrame, rounds: int = ROUNDS) -> tuple[float, list[float], list[float]]:
    """EM with one pseudo-count on either side. It starts (``START``) at rules that seldom fail a good
    document, and bad documents that break some of the rules.

    patterns: v0, v1, ... and n. Returns the prior and P(good vote) of each rule on good and on bad documents.
    """
    n = len(RULES)
    prior, good, bad = START[0], [START[1]] * n, [START[2]] * n
    for _ in range(rounds):
        p = patterns.withColumn("g", F.col("n") * _posterior(prior, good, bad)).withColumn("b", F.col("n") - F.col("g"))
        # Rounded decimals: the same sums in any order of the rows.
        part = lambda c, when: F.sum(F.when(when, F.col(c)).otherwise(0.0).cast("decimal(30,6)")).cast("double")
        parts = [part("g", F.lit(True)), part("b", F.lit(True))]
        for j in range(n):
            v = F.col(f"v{j}")
            parts += [part("g", v == 1), part("g", v >= 0), part("b", v == 1), part("b", v >= 0)]
        row = [x or 0.0 for x in p.select(*[x.alias(f"s{i}") for i, x in enumerate(parts)]).first()]
        before = [prior, *good, *bad]
        prior = (row[0] + 1) / (row[0] + row[1] + 2)
        good = [(row[2 + 4 * j] + 1) / (row[3 + 4 * j] + 2) for j in range(n)]
        bad = [(row[4 + 4 * j] + 1) / (row[5 + 4 * j] + 2) for j in range(n)]
        if max(abs(x - y) for x, y in zip(before, [prior, *good, *bad], strict=True)) <= TOLERANCE:
            break
    return prior, good, bad


def judge(docs: DataFrame, rounds: int = ROUNDS, least: float = LEAST) -> DataFrame:
    """docs: doc_id, text. The counts, base_failed, quality (posterior) and kept."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = stored(votes(counts(docs)).withColumn("base_failed", failed), "quality-counts")
    names = [f"v{j}" for j in range(len(RULES))]
    patterns = stored(rows.where("not base_failed").groupBy(*names).agg(F.count(F.lit(1)).alias("n")).coalesce(1), "patterns")
    quality = _posterior(*accuracies(patterns, rounds))
    out = rows.withColumn("quality", F.round(quality, 9))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))


def op8_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql() -> str:
    n = len(RULES)
    vote = ",\n".join(f"  case when n_words = 0 then -1 when {good} then 1 when {bad} then 0 else -1 end as v{j}" for j, (_, good, bad) in enumerate(RULES))
    up = " * ".join(["prior", *(f"case v{j} when 1 then a{j} when 0 then 1 - a{j} else 1.0 end" for j in range(n))])
    down = " * ".join(["(1 - prior)", *(f"case v{j} when 1 then b{j} when 0 then 1 - b{j} else 1.0 end" for j in range(n))])
    post = f"({up}) / (({up}) + ({down}))"
    part = lambda c, when: f"coalesce(sum(case when {when} then {c} else 0.0 end::decimal(30,6))::double, 0)"
    names = ["prior", *(f"a{j}" for j in range(n)), *(f"b{j}" for j in range(n))]
    start = ", ".join(["0 as r", "1.0::double as moved", f"{START[0]}::double as prior", *(f"{START[1]}::double as a{j}" for j in range(n)), *(f"{START[2]}::double as b{j}" for j in range(n))])
    ratio = lambda c, v: f"({part(c, f'{v} = 1')} + 1) / ({part(c, f'{v} >= 0')} + 2)"
    new = ", ".join([f"({part('g', 'true')} + 1) / ({part('g', 'true')} + {part('b', 'true')} + 2) as new_prior", *(f"{ratio('g', f'v{j}')} as new_a{j}" for j in range(n)), *(f"{ratio('b', f'v{j}')} as new_b{j}" for j in range(n))])
    em = f"""em as (select {start} union all
  select r + 1, greatest({", ".join(f"abs(new_{x} - {x})" for x in names)}), {", ".join(f"new_{x}" for x in names)} from (
    select r, {", ".join(names)}, {new} from (select *, n - g as b from (select p.*, em.*, n * {post} as g from patterns p, em where moved > {TOLERANCE} and r < {ROUNDS}))
    group by r, {", ".join(names)})),
last as (select * from em order by r desc limit 1)"""
    return rf"""
with recursive base as (
  select row_number() over () as id, doc_id, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from documents),
pos as (select id, w, unnest(range(1, len(w) - 1)) as i from base where len(w) >= 3),
win as (select id, i, count(*) over (partition by id, w[i], w[i + 1], w[i + 2]) as k from pos),
rep as (select id, count(distinct j) as n from (select id, unnest([i, i + 1, i + 2]) as j from win where k > 1) group by id),
c as (
  select doc_id, len(w)::bigint as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(rep.n, 0)::bigint as n_repeat_words, len(lines)::bigint as n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g'))::bigint as n_upper,
    length(regexp_replace(t, '[^0-9]', '', 'g'))::bigint as n_digits, length(regexp_replace(t, '[^!-/:-@\[-`{{-~]', '', 'g'))::bigint as n_marks from base left join rep using (id)),
v as materialized (select *,
{vote} from c),
patterns as materialized (select {", ".join(f"v{j}" for j in range(n))}, count(*) as n from v where not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) group by all),
{em}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and round({post}, 9) >= {LEAST} as kept
from v, last
"""


SQL_OP8 = _sql()
