"""Secret scans: base patterns, and formats learnt by grammar inference.

Base spans come from three fixed patterns over the whole text. From the credentials
they find (the labels are the kinds) one probabilistic automaton a kind is inferred:
the values form a prefix tree with counts, and states are merged, in breadth-first
order, when their end and symbol frequencies agree under a Hoeffding bound all the
way down (ALERGIA). A format's lengths are counted beside it, over all its values, as
merging forgets them. What is ordinary is counted over all tokens of the corpus that no
format explains: how often a character follows the two before it.

Every token of ``LEAST`` characters or more (the least that a base value can have)
outside the base spans is a candidate, also what they leave of a run that touches them.
A candidate becomes a span of the kind whose format explains it best, when that is at
least ``MARGIN`` nats better than the ordinary model (and than plain digits or letters of
one case, so that numbers and words stay out) and as likely per symbol as nearly all
values learnt from.

Plan: three maps over the texts: base values (stored where there are any), counts of
character triples (summed per batch, then by key: at most ``WIDTH`` cubed rows), and
the scores. Training takes the ``SAMPLE`` distinct values of each kind with the smallest
hashes, the bound of labelled values that reach the driver. No text is shuffled.

Edge cases: a null text is an empty one without spans; very long texts are scanned
whole; positions are code points, ends exclusive; a kind without labelled values learns
nothing and adds nothing; rows stand alone, so ties and repeated rows change nothing (they
count as often as they occur); extra columns are not read.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.store import discard

from .common import slices, small_batches, stored, table

KINDS = ("assign", "access", "hex")
SAMPLE, ALPHA, MARGIN, UNSEEN = 300, 0.05, 8.0, 1e-4
#: How many observations the shorter context of a character weighs.
BACKOFF = 10.0


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGN = re.compile("(" + "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token", "api_?key")) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so shorter ones need no match
LEAST = 6
RUN = re.compile("[A-Za-z0-9+/_.=-]{%d,}" % LEAST)
GLUE = "./=-"
#: The characters of tokens; place 0 stands for a token's start and end.
SYMBOLS = "+-./0123456789=ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz"
WIDTH = len(SYMBOLS) + 1
#: Longer values count as this long.
LONGEST = 1024


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, credential) by start, then kind."""
    out = []
    low = text.lower()
    if any(w in low for w in ("passw", "secret", "token", "api")):
        out += [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, base: list[tuple[str, int, int, str]]) -> list[tuple[int, int, str]]:
    """Tokens outside the base spans: of a run that touches some, what they leave of it; points and dashes at the ends are no part."""
    out = []
    starts = [s for _, s, _, _ in base]
    reach = np.maximum.accumulate([e for _, _, e, _ in base]).tolist() if base else []
    for m in RUN.finditer(text):
        if not base and m[0][0] not in ".-" and m[0][-1] not in ".-":
            out.append((m.start(), m.end(), m[0]))
            continue
        at = m.start()
        i = bisect.bisect_right(reach, at)  # spans before it end too early
        while True:
            s, e = (starts[i], base[i][2]) if i < len(base) and starts[i] < m.end() else (m.end(), m.end())
            a, b = at, max(at, s)
            edge = lambda k: ".-" if k in (m.start(), m.end()) else GLUE  # noqa: B023, E731  separators next to a base span go too
            left, right = edge(a), edge(b)
            while a < b and text[a] in left:
                a += 1
            while a < b and text[b - 1] in right:
                b -= 1
            if b - a >= LEAST:
                out.append((a, b, text[a:b]))
            at = max(at, e)
            if at >= m.end() or s >= m.end():
                break
            i += 1
    return out


def symbol_codes() -> np.ndarray:
    codes = np.zeros(128, np.int64)
    for i, c in enumerate(SYMBOLS):
        codes[ord(c)] = i + 1
    return codes


def triples(docs: DataFrame, automata: dict[str, Automaton]) -> DataFrame:
    """triple, n: how often a character follows two others in the candidates of all texts that have no learnt format (start and end are 0)."""
    shared = docs.sparkSession.sparkContext.broadcast(automata)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, formats = symbol_codes(), list(shared.value.values())
        explained = functools.lru_cache(1 << 16)(lambda x: any(a.fits(x) for a in formats))
        for b in batches:
            for part in slices(b, "text"):
                tokens = [x for value in part.column("text").to_pylist() if value for *_, x in candidates(value, base_spans(value)) if not explained(x)]
                # Two zeros part the tokens, so that no triple reaches over both.
                c = codes[np.frombuffer(("  " + "  ".join(tokens) + "  ").encode("ascii"), np.uint8)]
                t = (c[:-2] * WIDTH + c[1:-1]) * WIDTH + c[2:]
                k, n = np.unique(t[(c[1:-1] > 0) | (c[2:] > 0)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(n, pa.int64())], names=["triple", "n"])

    return docs.select("text").mapInArrow(run, "triple long, n long").groupBy("triple").agg(F.sum("n").alias("n"))


class Ordinary:
    """How likely a token is by the corpus's character triples, backed off to pairs and single characters."""

    def __init__(self, triple: np.ndarray, n: np.ndarray) -> None:
        three = np.zeros(WIDTH**3)
        three[triple] = n
        three = three.reshape(WIDTH, WIDTH, WIDTH)
        two = three.sum(0)
        one = (two.sum(0) + 1) / (two.sum() + WIDTH)
        two = (two + BACKOFF * one) / (two.sum(1, keepdims=True) + BACKOFF)
        three = (three + BACKOFF * two) / (three.sum(2, keepdims=True) + BACKOFF)
        self.log = np.log(three).astype(np.float32).ravel()

    @functools.cached_property
    def _lists(self) -> tuple[list[float], dict[str, int]]:
        return self.log.tolist(), {c: i + 1 for i, c in enumerate(SYMBOLS)}

    def log_likelihood(self, value: str) -> float:
        log, codes = self._lists
        x = y = 0
        total = 0.0
        for c in value:
            z = codes[c]
            total += log[(x * WIDTH + y) * WIDTH + z]
            x, y = y, z
        return total + log[(x * WIDTH + y) * WIDTH]


class Automaton:
    """A probabilistic automaton merged from the prefix tree of the values."""

    def __init__(self, values: list[str], lengths: dict[int, int] | None = None, alpha: float = ALPHA) -> None:
        self.n, self.end, self.go = defaultdict(int), defaultdict(int), defaultdict(dict)  # go: state -> symbol -> [state, count]
        self._bound = math.sqrt(0.5 * math.log(2 / alpha))
        size = 1
        for v in sorted(values):
            q = 0
            self.n[0] += 1
            for c in v:
                if c not in self.go[q]:
                    self.go[q][c] = [size, 0]
                    size += 1
                step = self.go[q][c]
                step[1] += 1
                q = step[0]
                self.n[q] += 1
            self.end[q] += 1
        self._merge_all()
        self.lengths = lengths or dict(Counter(min(len(v), LONGEST) for v in values))
        self.labelled = sum(self.lengths.values())
        scores = sorted(self.per_symbol(v) for v in values) or [0.0]
        self.least = scores[len(scores) // 100]

    def _differ(self, a: int, n: int, b: int, m: int) -> bool:
        return abs(a / n - b / m) > self._bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _compatible(self, p: int, q: int) -> bool:
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            n, m = self.n[p], self.n[q]
            if self._differ(self.end[p], n, self.end[q], m):
                return False
            for c in self.go[p].keys() | self.go[q].keys():
                x, y = self.go[p].get(c), self.go[q].get(c)
                if self._differ(x[1] if x else 0, n, y[1] if y else 0, m):
                    return False
                if x and y:
                    todo.append((x[0], y[0]))
        return True

    def _fold(self, p: int, q: int) -> None:
        """Add the tree under q to p."""
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            self.n[p] += self.n[q]
            self.end[p] += self.end[q]
            for c, (to, count) in self.go[q].items():
                if c in self.go[p]:
                    self.go[p][c][1] += count
                    todo.append((self.go[p][c][0], to))
                else:
                    self.go[p][c] = [to, count]

    def _merge_all(self) -> None:
        red = [0]
        while blue := next(((p, c) for p in red for c in sorted(self.go[p]) if self.go[p][c][0] not in red), None):
            p, c = blue
            q = self.go[p][c][0]
            r = next((r for r in red if self._compatible(r, q)), None)
            if r is None:
                red.append(q)
            else:
                self.go[p][c][0] = r
                self._fold(r, q)
        self.states = {r: ({c: (to, math.log(k / self.n[r])) for c, (to, k) in self.go[r].items()}, math.log(max(self.end[r], UNSEEN) / self.n[r]) if self.n[r] else 0.0) for r in red}
        del self.n, self.end, self.go

    def log_likelihood(self, value: str) -> float:
        q, total = 0, 0.0
        for c in value:
            step = self.states[q][0].get(c)
            if step is None:  # an unseen symbol: stay, at the price of one
                total += math.log(UNSEEN)
            else:
                q, total = step[0], total + step[1]
        return total + self.states[q][1]

    def score(self, value: str) -> float:
        """The likelihood of the symbols and of the length."""
        return self.log_likelihood(value) + math.log((self.lengths.get(min(len(value), LONGEST), 0) + 0.5) / (self.labelled + 1))

    def fits(self, value: str) -> bool:
        """A length that was seen, and symbols as likely as those of nearly all values learnt from."""
        return min(len(value), LONGEST) in self.lengths and self.per_symbol(value) >= self.least

    def per_symbol(self, value: str) -> float:
        return self.log_likelihood(value) / max(1, len(value))


def _plain(value: str) -> float:
    """Likelihood as even picks from the ten digits, or from the letters of one case."""
    size = 10 if value.isdigit() else 26 if value.isalpha() and (value.islower() or value.isupper()) else None
    return -len(value) * math.log(size) if size else -math.inf


def added_span(value: str, automata: dict[str, Automaton], ordinary: Ordinary) -> str | None:
    """The kind whose format the token has, or None."""
    if not automata:
        return None
    score, kind = max((a.score(value), k) for k, a in automata.items())
    if score - _plain(value) < MARGIN or score - ordinary.log_likelihood(value) < MARGIN:
        return None
    return kind if automata[kind].per_symbol(value) >= automata[kind].least else None


def labelled(docs: DataFrame) -> DataFrame:
    """kind, value of every base span: one map over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(k, v) for value in b.column("text") for k, _, _, v in base_spans(value.as_py() or "")]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.string()), pa.array([v for _, v in found], pa.string())], names=["kind", "value"])

    return docs.select("text").mapInArrow(run, "kind string, value string")


def learn(docs: DataFrame, sample: int = SAMPLE) -> tuple[dict[str, Automaton], Ordinary]:
    """An automaton for each kind, and the ordinary model."""
    values = stored(labelled(docs), "labelled-values")
    counted = values.groupBy("kind", F.least(F.length("value"), F.lit(LONGEST)).alias("length")).agg(F.count(F.lit(1)).alias("n"))
    lengths: dict[str, dict[int, int]] = defaultdict(dict)
    for r in counted.collect():  # LONGEST rows a kind at most
        lengths[r.kind][r.length] = r.n
    automata = {}
    for kind in lengths:
        rows = values.where(F.col("kind") == kind).select("value").distinct().orderBy(F.xxhash64("value"), "value").limit(sample)
        automata[kind] = Automaton([r[0] for r in rows.collect()], lengths[kind])
    discard(values)
    seen = triples(docs, automata).toArrow()
    return automata, Ordinary(seen["triple"].to_numpy(), seen["n"].to_numpy())


def find_secrets(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, sample))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind_of = functools.lru_cache(1 << 17)(lambda value: added_span(value, *model.value))
        text = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))))
        for b in batches:
            counts, sha, spans = [], [], []
            for value in b.column("text"):
                whole = value.as_py() or ""
                base = base_spans(whole)
                own = [s[:3] for s in base]
                more = [(k, a, e) for a, e, token in candidates(whole, base) if (k := kind_of(token))]
                counts.append([sum(s[0] == k for s in own) for k in KINDS])
                sha.append(hashlib.sha256(text(own).encode()).hexdigest())
                spans.append(text(own + more))
            columns = [pa.array([c[k] for c in counts], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *columns, pa.array(sha, pa.string()), pa.array(spans, pa.string())], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))
