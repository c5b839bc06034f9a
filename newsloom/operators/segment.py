"""Word segmentation of text without blanks: a dictionary trie and the best path through the word lattice.

Every run of letters and digits is a lattice: an edge for each dictionary word that stands at a
place, and one for each single character. The path with the greatest sum of log frequencies
wins, of equal ones the longer word at the first place they differ. Weights are whole millionths, so
sums do not depend on their order. Distinct runs are segmented once.

A dictionary of at most ``ROWS`` words and ``CHARS`` characters (both counted) goes to the tasks as a
trie; one of at most ``WORDS`` and ``WORD_CHARS`` as an Arrow array, in which a slice's substrings are looked up; a larger one is
joined with the runs' substrings, and a run's edges are all that a task holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import clean_title
from newsloom.operators.store import stored

ROWS, CHARS = 500_000, 5_000_000
WORDS, WORD_CHARS = 10_000_000, 100_000_000
#: Substrings that are looked up at once.
LOOKUPS = 500_000
#: Runs that are segmented; what is between them is dropped.
RUN = r"[\p{L}\p{N}]+"
SCALE = 1_000_000
Edges = list[list[tuple[int, int]]]


def dictionary_of(lines: DataFrame, column: str = "value") -> DataFrame:
    """word, freq from lines ``word [frequency [tag]]``; comments and empty lines are skipped, no frequency is 1, repeated words add up."""
    parts = F.split(F.trim(F.col(column)), r"\s+")
    rows = lines.where(F.trim(F.col(column)) != "").where(~F.trim(F.col(column)).startswith("#")).select(parts[0].alias("word"), F.coalesce(F.try_element_at(parts, F.lit(2)).try_cast("long"), F.lit(1)).alias("freq"))
    return rows.groupBy("word").agg(F.sum("freq").alias("freq"))


def weighted(dictionary: DataFrame) -> tuple[DataFrame, int, int, int]:
    """(word, weight; the weight of an unknown character; words; characters). Words without a positive frequency go."""
    known = dictionary.where("freq > 0 and word <> ''")
    n, chars, total = known.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("word")), F.lit(0)), F.coalesce(F.sum("freq"), F.lit(1))).first()
    weight = F.round(F.ln(F.col("freq") / F.lit(float(total))) * SCALE).cast("long")
    unknown = dictionary.sparkSession.range(1).select(F.round(F.ln(F.lit(1.0) / F.lit(float(total))) * SCALE).cast("long")).first()[0]
    return known.select("word", weight.alias("weight")), unknown, n, chars


def best_path(run: str, edges: Edges, unknown: int) -> list[str]:
    """The segments of a run. edges[i]: (end, weight) of the words at place i, shorter ones first."""
    n = len(run)
    best, to = [0] * (n + 1), [0] * n
    for i in range(n - 1, -1, -1):
        way = (unknown + best[i + 1], i + 1)
        for end, weight in edges[i]:
            if end == i + 1:
                way = (weight + best[end], end)
            else:
                way = max(way, (weight + best[end], end))
        best[i], to[i] = way
    out, i, plain = [], 0, False
    while i < n:
        part = run[i : to[i]]
        single = len(part) == 1 and part.isascii()
        if single and plain:  # letters and digits that no word holds stay together
            out[-1] += part
        else:
            out.append(part)
        plain, i = single, to[i]
    return out


def trie_edges(run: str, weights: dict[str, int | None]) -> Edges:
    """Words of the trie (its prefixes have no weight) at every place."""
    out: Edges = []
    for i in range(len(run)):
        found, end = [], i + 1
        while end <= len(run) and (part := run[i:end]) in weights:
            if weights[part] is not None:
                found.append((end, weights[part]))
            end += 1
        out.append(found)
    return out


def trie(words: dict[str, int]) -> dict[str, int | None]:
    out: dict[str, int | None] = {}
    for w in words:
        for end in range(1, len(w)):
            out.setdefault(w[:end], None)
    return out | words


def _segmented(runs: DataFrame, dictionary: DataFrame, rows: int, chars: int, most: int = WORDS) -> DataFrame:
    """run, parts for distinct runs."""
    words, unknown, n, size = weighted(dictionary)
    schema = pa.schema([("run", pa.string()), ("parts", pa.list_(pa.string()))])
    if n <= rows and size <= chars:
        held = runs.sparkSession.sparkContext.broadcast({r.word: r.weight for r in words.collect()})

        def from_trie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights = trie(held.value)
            for b in batches:
                texts = b.column("run").to_pylist()
                yield pa.RecordBatch.from_arrays([b.column("run"), pa.array([best_path(t, trie_edges(t, weights), unknown) for t in texts], schema.field("parts").type)], schema=schema)

        return runs.mapInArrow(from_trie, "run string, parts array<string>")
    if n <= most and size <= WORD_CHARS:
        table = words.toArrow()
        array = table.column("word").combine_chunks()
        starts = words.groupBy(F.substring("word", 1, 2).alias("s")).agg(F.max(F.length("word")).alias("n")).toArrow()
        held = runs.sparkSession.sparkContext.broadcast((array, table.column("weight").to_numpy(), dict(zip(starts.column("s").to_pylist(), starts.column("n").to_pylist(), strict=True))))

        def from_array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, weights, reach = held.value
            for b in batches:
                texts, out = b.column("run").to_pylist(), []
                edges: list[Edges] = [[[] for _ in t] for t in texts]
                parts, places = [], []

                def look_up(parts=parts, places=places, edges=edges):
                    found = pc.index_in(pa.array(parts, known.type), known)
                    hits = pc.is_valid(found).to_numpy(zero_copy_only=False).nonzero()[0]
                    for k, w in zip(hits.tolist(), weights[found.drop_null().to_numpy()].tolist(), strict=True):
                        r, i = places[k]
                        edges[r][i].append((i + len(parts[k]), w))
                    parts.clear()
                    places.clear()

                for r, t in enumerate(texts):
                    for i in range(len(t)):
                        last = min(len(t), i + max(reach.get(t[i : i + 1], 0), reach.get(t[i : i + 2], 0)))
                        parts += [t[i:end] for end in range(i + 1, last + 1)]
                        places += [(r, i)] * max(0, last - i)
                        if len(parts) >= LOOKUPS:
                            look_up()
                look_up()
                for t, e in zip(texts, edges, strict=True):
                    out.append(best_path(t, e, unknown))
                yield pa.RecordBatch.from_arrays([b.column("run"), pa.array(out, schema.field("parts").type)], schema=schema)

        return runs.mapInArrow(from_array, "run string, parts array<string>")
    longest = dictionary.agg(F.max(F.length("word"))).first()[0]
    places = runs.select("run", F.explode(F.sequence(F.lit(1), F.length("run"))).alias("at"))
    spans = places.select("run", "at", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("run") - F.col("at") + 1))).alias("size"))
    met = spans.withColumn("word", F.expr("substring(run, at, size)")).join(words, "word")
    found = met.groupBy("run").agg(F.array_sort(F.collect_list(F.struct((F.col("at") - 1).alias("i"), (F.col("at") + F.col("size") - 1).alias("end"), "weight"))).alias("edges"))

    def from_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, found in zip(b.column("run").to_pylist(), b.column("edges").to_pylist(), strict=True):
                edges: Edges = [[] for _ in t]
                for e in found or []:
                    edges[e["i"]].append((e["end"], e["weight"]))
                out.append(best_path(t, edges, unknown))
            yield pa.RecordBatch.from_arrays([b.column("run"), pa.array(out, schema.field("parts").type)], schema=schema)

    return runs.join(found, "run", "left").mapInArrow(from_edges, "run string, parts array<string>")


def segment(rows: DataFrame, text: Column, dictionary: DataFrame, out: str = "segments", rows_limit: int = ROWS, chars_limit: int = CHARS, words_limit: int = WORDS) -> DataFrame:
    """The rows with the segments of a text column, in order. rows need an ``id`` that tells them apart.

    dictionary: word, freq. A null text has no segments; the text's case is left as it is.
    """
    runs = stored(rows.select("id", F.posexplode(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(RUN), F.lit(0))).alias("_nth", "run")), "runs")
    parts = _segmented(runs.select("run").distinct(), dictionary, rows_limit, chars_limit, words_limit)
    made = runs.join(parts, "run").groupBy("id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_nth", "parts"))), lambda x: x["parts"])).alias(out))
    return rows.join(made, "id", "left").withColumn(out, F.coalesce(out, F.array().cast("array<string>")))


def title_token_sets(rows: DataFrame, title: Column, dictionary: DataFrame, **limits: int) -> DataFrame:
    """The rows with ``tokens``: the distinct segments of two characters or more of the cleaned title, sorted."""
    return segment(rows, clean_title(title), dictionary, "tokens", **limits).withColumn("tokens", F.array_sort(F.array_distinct(F.filter("tokens", lambda t: F.length(t) >= 2))))
