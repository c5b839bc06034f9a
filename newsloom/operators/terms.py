"""Known terms, marked terms and unmarked runs of katakana in whole texts, found in one scan.

An automaton of all known terms (Aho-Corasick) reads each text once, in time linear in its length and what it
meets, however many terms there are; of overlapping terms the leftmost and longest count. It is built once a Python worker from a broadcast list
whose size is counted first: ``TERMS`` terms and ``CHARS`` characters at most, a larger base is refused.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TERMS, CHARS = 1_000_000, 20_000_000
# How a term is marked, and what an unmarked foreign term looks like.
MARKED = re.compile(r"\[\[([^\]]+)\]\]")
KATAKANA = re.compile(r"[ァ-ヺー]{3,}")

FOUND = "term string, kind string, start int, end int"
_SCHEMA = pa.schema([("id", pa.int64()), ("term", pa.string()), ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def automaton(terms: list[str]):
    """None without terms."""
    import ahocorasick

    made = ahocorasick.Automaton()
    for t in terms:
        if t:
            made.add_word(t, t)
    if len(made):
        made.make_automaton()
        return made
    return None


def known_spans(text: str, known) -> Iterator[tuple[str, int, int]]:
    """term, start, end of the known terms, leftmost and longest."""
    longest: dict[int, str] = {}  # by place; words that end later are longer
    for last, term in known.iter(text):
        longest[last + 1 - len(term)] = term
    free = 0
    for start in sorted(longest):
        if start >= free:
            free = start + len(longest[start])
            yield longest[start], start, free


def scan(text: str, known, names: set[str]) -> Iterator[tuple[str, str, int, int]]:
    """term, kind, start, end (code points): ``known``; ``marked`` and ``katakana`` for terms that are not known.

    Known terms are leftmost and longest; a marked term is trimmed, an empty one is none; a run of katakana
    inside a mark belongs to the mark, and one that is marked anywhere in the text is reported as marked only.
    """
    if known is not None:
        for term, start, end in known_spans(text, known):
            yield term, "known", start, end
    marked, spans = set(), []
    for m in MARKED.finditer(text):
        spans.append(m.span())
        term = m[1].strip()
        if term and term not in names:
            marked.add(term)
            yield term, "marked", *m.span()
    for m in KATAKANA.finditer(text):
        inside = any(a <= m.start() and m.end() <= b for a, b in spans) if spans else False
        if m[0] not in names and m[0] not in marked and not inside:
            yield m[0], "katakana", *m.span()


def _held(base: DataFrame):
    """The distinct terms as a broadcast list, counted first."""
    known = base.where("term is not null and trim(term) <> ''").select("term").distinct()
    n, chars = known.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("term")), F.lit(0))).first()
    if n > TERMS or chars > CHARS:
        raise ValueError(f"{n} terms of {chars} characters: an automaton holds {TERMS} of {CHARS} at most")
    return base.sparkSession.sparkContext.broadcast(sorted(r.term for r in known.collect()))


def known_counts(rows: DataFrame, base: DataFrame) -> DataFrame:
    """rows: id, text; base: term. id, n, terms (distinct), chars of each row's known terms, counted where they are found."""
    held = _held(base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = automaton(held.value)
        for b in batches:
            out = []
            for text in b.column("text"):
                found = list(known_spans(text.as_py(), made)) if made is not None and text.is_valid else []
                out.append((len(found), len({t for t, _, _ in found}), sum(end - start for _, start, end in found)))
            yield pa.RecordBatch.from_arrays([b.column("id"), *(pa.array(c, pa.int64()) for c in zip(*out, strict=True))] if out else [b.column("id"), *[pa.array([], pa.int64())] * 3], names=["id", "n", "terms", "chars"])

    return rows.select("id", "text").mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n long, terms long, chars long")


def find_terms(rows: DataFrame, base: DataFrame) -> DataFrame:
    """rows: id (long), text; base: term. id, term, kind, start, end of every occurrence; a null text has none."""
    held = _held(base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, names = automaton(held.value), set(held.value)
        for b in batches:
            out: list[tuple] = []
            for i, text in zip(b.column("id").to_pylist(), b.column("text").to_pylist(), strict=True):
                out += [(i, *x) for x in scan(text, made, names)] if text else []
                if len(out) > 50_000:
                    yield _batch(out)
                    out = []
            if out:
                yield _batch(out)

    return rows.select(F.col("id").cast("long").alias("id"), "text").mapInArrow(run, f"id long, {FOUND}")


def _batch(found: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)


def missing_terms(found: DataFrame) -> DataFrame:
    """term, kind (marked if it was anywhere), n, n_rows, first_id of the terms that the base lacks."""
    new = found.where("kind <> 'known'")
    return new.groupBy("term").agg(F.max("kind").alias("kind"), F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("n_rows"), F.min("id").alias("first_id"))
