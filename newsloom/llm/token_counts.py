"""Token counts of a word-end BPE tokenizer by compiled finite-state transducers.

Two deterministic transducers stand for the tokenizer's file:

* *Pieces.* The pattern (contractions, runs of letters, single numbers, runs of other
  characters) is a machine of seven states over ten character classes that says where pieces start.
  A text is cut into chunks of 256 characters; each chunk's map (state before -> state after, for
  all states at once) is made for all chunks side by side, the maps are composed by a
  prefix scan, and a second pass reads the starts off. A single document longer than a
  window is read window by window; the state goes along.
* *Merges.* Of a piece's prefix the last token is unique: the token t that ends there and fits
  the last token of what is before it (a pair fits if merging both together gives both). A
  state is the set of places from which a token may still grow (trie node, last token there,
  tokens counted up to there less those counted now), so a step over a symbol is a transition annotated with
  the tokens that it adds (it may take some back). The word's last byte is a symbol of its own, as
  the vocabulary has one. Distinct pieces of a slice step side by side in arrays; pieces over
  ``LONGEST`` bytes step alone, over transitions compiled when first met. Tables of compiled
  transitions and of pairs start anew when full, so memory is bounded and counts never change.

Special strings in a text count one token each (the library's default) and part what is around them. Texts
are composed (NFC) and lower-cased character by character as the library does; its own answers
for characters that are met first are asked once (class and lower case), so that both use one Unicode version.

Defined cases: a null text is empty and has no token; repeated and null ids stay rows of their own; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import expand, fresh, slices, table, text_of

FILE = "word_bpe_49k.json"
LIMIT = 2048
CHUNK, WINDOW = 256, 1 << 20
SLICE = 4 << 20
#: Pieces up to so many bytes, so many at once, step side by side.
LONGEST, ABREAST = 64, 1 << 15
#: Compiled transitions held, and bits of the table of pairs (half of it is filled at most).
COMPILED, PAIR_BITS = 100_000, 20
#: Short pieces whose counts a worker keeps from slice to slice.
REMEMBERED = 400_000

# ---------------------------------------------------------------- pieces
#: Classes. The last five are letters that contractions look at.
SPACE, NUMBER, LETTER, OTHER, QUOTE, STMD, R, V, EL, E = range(10)
LETTERS = (LETTER, STMD, R, V, EL, E)
#: States: between pieces, in a run of letters, of others, after a quote that starts a piece, after 'r 'v 'l.
BETWEEN, WORD, RUN, QUOTED, Q_R, Q_V, Q_L = range(7)


def machine() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """next state, whether a piece starts here, whether one started a place before; by state * 10 + class."""
    after, here, back = (np.zeros(70, np.uint8) for _ in range(3))

    def plain(state: int, c: int) -> tuple[int, int]:
        """Without contractions pending."""
        if c == SPACE:
            return BETWEEN, 0
        if c == NUMBER:
            return BETWEEN, 1
        if c in LETTERS:
            return WORD, int(state != WORD)
        if state == RUN:
            return RUN, 0
        return (QUOTED if c == QUOTE else RUN), 1

    pending = {Q_R: E, Q_V: E, Q_L: EL}
    for state in range(7):
        for c in range(10):
            k = state * 10 + c
            if state in pending:
                if c == pending[state]:
                    after[k] = BETWEEN
                else:  # the quote stood alone and the letter after it began a word
                    back[k] = 1
                    after[k], here[k] = plain(WORD, c)
            elif state == QUOTED and c == STMD:
                after[k] = BETWEEN
            elif state == QUOTED and c in (R, V, EL):
                after[k] = {R: Q_R, V: Q_V, EL: Q_L}[c]
            elif state == QUOTED and c in (OTHER, QUOTE):
                after[k] = RUN
            else:
                after[k], here[k] = plain(state, c)
    return after, here, back


AFTER, HERE, BACK = machine()


def starts(classes: np.ndarray, state: int = BETWEEN) -> tuple[np.ndarray, int]:
    """Where pieces start (a flag per character) and the state at the end.

    Chunk maps for all seven states, composed by a prefix scan, then one pass from each chunk's own state.
    """
    n = len(classes)
    k = -(-n // CHUNK)
    grid = np.zeros(k * CHUNK, np.uint8)
    grid[:n] = classes
    grid = np.ascontiguousarray(grid.reshape(k, CHUNK).T)
    maps = np.repeat(np.arange(7, dtype=np.uint8)[:, None], k, axis=1)
    for row in grid:
        maps = AFTER[maps * np.uint8(10) + row]
    shift = 1
    while shift < k:
        maps[:, shift:] = np.take_along_axis(maps[:, shift:], maps[:, :-shift].astype(np.intp), axis=0)
        shift *= 2
    now = np.concatenate([[state], maps[state, :-1]]).astype(np.uint8)
    key = np.empty_like(grid)
    for j, row in enumerate(grid):
        key[j] = now * np.uint8(10) + row
        now = AFTER[key[j]]
    flat = key.T.reshape(-1)[:n]
    flags = HERE[flat].astype(bool)
    flags[:-1] |= BACK[flat[1:]].astype(bool)
    return flags, int(AFTER[flat[-1]]) if n else state


# ---------------------------------------------------------------- merges
class Table:
    """Whole numbers by whole numbers, looked up by arrays (open addressing)."""

    def __init__(self, bits: int) -> None:
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.clear()

    def clear(self) -> None:
        self.keys, self.values, self.held = np.full(self.mask + 1, -1, np.int64), np.full(self.mask + 1, -1, np.int32), 0

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """New keys, each once."""
        at, keys, values = self._home(keys), keys, values
        self.held += len(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[at] == -1)
            self.keys[at[free]] = keys[free]
            won = self.keys[at] == keys
            self.values[at[won]] = values[won]
            at, keys, values = (at[~won] + 1) & self.mask, keys[~won], values[~won]

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values; -1 for unknown keys."""
        at, out, open_ = self._home(keys), np.full(len(keys), -1, np.int32), np.arange(len(keys))
        while len(open_):
            there = self.keys[at]
            hit = there == keys[open_]
            out[open_[hit]] = self.values[at[hit]]
            more = ~hit & (there != -1)
            open_, at = open_[more], (at[more] + 1) & self.mask
        return out


class Merges:
    """The transducer of one vocabulary; symbols are bytes, and 256 + byte for a piece's last byte."""

    def __init__(self, vocabulary: dict[str, int], merges: list, end: str) -> None:
        shown = {c: b for b, c in enumerate(_byte_letters())}
        self.child: dict[int, int] = {}
        token = [-1]
        self.left, self.right, self.rank = {}, {}, {}
        self.join: dict[int, int] = {}
        for rank, pair in enumerate(merges):
            a, b = pair if isinstance(pair, (list, tuple)) else pair.split(" ")
            a, b, new = vocabulary[a], vocabulary[b], vocabulary[a + b]
            self.join[a << 20 | b] = rank
            self.left[new], self.right[new], self.rank[new] = a, b, rank
        for text, t in vocabulary.items():
            last = text.endswith(end) and len(text) > len(end)
            symbols = [shown[c] for c in (text[: -len(end)] if last else text)]
            if last:
                symbols[-1] += 256
            if len(symbols) > 1 and t not in self.rank:
                continue  # no merge makes it
            node = 0
            for s in symbols:
                key = node << 9 | s
                if key not in self.child:
                    self.child[key] = len(token)
                    token.append(-1)
                node = self.child[key]
            token[node] = t
        self.token = np.array(token, np.int32)
        self.children = Table(len(self.child).bit_length() + 1)
        self.children.put(np.array([*self.child], np.int64), np.array([*self.child.values()], np.int32))
        self.pairs = Table(PAIR_BITS)
        self.reset()

    def reset(self) -> None:
        self.compiled = 0
        self.start: list = [((0, -1, 0),), {}]

    def fits(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Which pairs of tokens fit; each distinct pair is worked out once."""
        keys = before.astype(np.int64) << 20 | after
        out = self.pairs.get(keys)
        if (out < 0).any():
            new = np.unique(keys[out < 0])
            if self.pairs.held + len(new) > self.pairs.mask // 2:
                self.pairs.clear()
            made = np.array([self.fit(k >> 20, k & 0xFFFFF) for k in new.tolist()], np.int32)
            self.pairs.put(new, made)
            out[out < 0] = made[np.searchsorted(new, keys[out < 0])]
        return out > 0

    def abreast(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Token counts of many short pieces, stepped symbol by symbol side by side."""
        size = np.diff(offsets)
        order = np.argsort(-size, kind="stable")
        size, begin, most = size[order], offsets[:-1][order], int(size.max(initial=0))
        last, count = np.full((len(size), most + 1), -1, np.int32), np.zeros((len(size), most + 1), np.int32)
        word = start = node = np.zeros(0, np.int64)
        for j in range(most):
            n = int(np.searchsorted(-size, -j, side="left"))  # pieces with a symbol here
            live = word < n
            word, start, node = np.concatenate([word[live], np.arange(n)]), np.concatenate([start[live], np.full(n, j)]), np.concatenate([node[live], np.zeros(n, np.int64)])
            symbol = data[begin[:n] + j].astype(np.int64) + 256 * (size[:n] == j + 1)
            node = self.children.get(node << 9 | symbol[word]).astype(np.int64)
            live = node >= 0
            word, start, node = word[live], start[live], node[live]
            token = self.token[node]
            ways, solved = np.flatnonzero(token >= 0), np.zeros(n, bool)
            while len(ways):  # the longest token that is left first; one of them fits
                first = np.full(n, -1, np.int64)
                first[word[ways[::-1]]] = ways[::-1]
                pick = first[first >= 0]
                before = last[word[pick], start[pick]]
                good = before < 0
                good[~good] = self.fits(before[~good], token[pick[~good]])
                won = pick[good]
                last[word[won], j + 1] = token[won]
                count[word[won], j + 1] = count[word[won], start[won]] + 1
                solved[word[won]] = True
                ways = ways[~solved[word[ways]] & (first[word[ways]] != ways)]
        out = np.empty(len(size), np.int64)
        out[order] = count[np.arange(len(size)), size]
        return out

    def fit(self, a: int, b: int) -> bool:
        """Whether merging the text of both tokens gives both: no merge over the seam comes first.

        The seam's neighbours grow from single symbols along a's right and b's left edge; equal
        ranks go to the left pair.
        """
        ups, downs, never = [a], [b], len(self.rank)
        while ups[-1] in self.rank:
            ups.append(self.right[ups[-1]])
        while downs[-1] in self.rank:
            downs.append(self.left[downs[-1]])
        x, y = ups.pop(), downs.pop()
        while True:
            mine = self.rank[ups[-1]] if ups else never
            theirs = self.rank[downs[-1]] if downs else never
            seam = self.join.get(x << 20 | y, never)
            if seam < mine and seam <= theirs and seam < never:
                return False
            if not ups and not downs:
                return True
            if mine <= theirs:
                x = ups.pop()
            else:
                y = downs.pop()

    def step(self, state: list, symbol: int) -> tuple[list, int]:
        """The transition of a state: the next state and the tokens added."""
        grown, last, added = [], -1, 0
        for node, before, count in state[0]:
            to = self.child.get(node << 9 | symbol)
            if to is not None:
                grown.append((to, before, count))
                token = int(self.token[to])
                if token >= 0 and last < 0 and (before < 0 or self.fit(before, token)):
                    last, added = token, count + 1
        self.compiled += 1
        made = ([(*[(n, t, c - added) for n, t, c in grown], (0, last, 0)), {}], added)
        state[1][symbol] = made
        return made

    def run(self, state: list, symbols: bytes) -> tuple[list, int]:
        total = 0
        for s in symbols:
            way = state[1].get(s) or self.step(state, s)
            state = way[0]
            total += way[1]
        return state, total

    def finish(self, state: list, last: int) -> int:
        return (state[1].get(last + 256) or self.step(state, last + 256))[1]

    def count(self, piece: bytes) -> int:
        alone = Growing(self)
        alone.feed(piece)
        return alone.end()

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Token counts of pieces."""
        size = np.diff(offsets)
        out = np.empty(len(size), np.int64)
        for i in np.flatnonzero(size > LONGEST).tolist():
            out[i] = self.count(data[offsets[i] : offsets[i + 1]].tobytes())
        short = np.flatnonzero(size <= LONGEST)
        for a in range(0, len(short), ABREAST):
            some = short[a : a + ABREAST]
            bounds = np.concatenate([[0], np.cumsum(size[some])])
            out[some] = self.abreast(data[expand(offsets[some], size[some])], bounds)
        return out


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    more = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(more)) for b in range(256)]


class Growing:
    """A piece that comes in parts: all but its last byte has been read."""

    def __init__(self, merges: Merges) -> None:
        self.merges, self.state, self.total, self.last = merges, merges.start, 0, -1

    def feed(self, part: bytes) -> None:
        if part:
            if self.last >= 0:
                part = bytes([self.last]) + part
            at = 0
            while at < len(part) - 1:  # compiled states are let go on the way
                if self.merges.compiled > COMPILED:
                    self.merges.reset()
                    self.state = [self.state[0], {}]
                end = min(at + 4096, len(part) - 1)
                self.state, more = self.merges.run(self.state, part[at:end])
                self.total += more
                at = end
            self.last = part[-1]

    def end(self) -> int:
        total = self.total + self.merges.finish(self.state, self.last) if self.last >= 0 else 0
        self.state, self.total, self.last = self.merges.start, 0, -1
        return total


# ---------------------------------------------------------------- the tokenizer
class Counter:
    """The compiled tokenizer of one file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        self.library = Tokenizer.from_file(path)
        self.merges = Merges(spec["model"]["vocab"], spec["model"]["merges"], spec["model"]["end_of_word_suffix"])
        self.specials = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]))
        self.classes = np.full(0x110000, 255, np.uint8)
        for c, kind in (("'", QUOTE), ("s", STMD), ("t", STMD), ("m", STMD), ("d", STMD), ("r", R), ("v", V), ("l", EL), ("e", E)):
            self.classes[ord(c)] = kind
        self.seen = np.zeros(0x110000, bool)
        self.odd: dict[int, str] = {}
        self.known: dict[bytes, int] = {}

    def classify(self, points: np.ndarray) -> np.ndarray:
        kinds = self.classes[points]
        new = np.unique(points[kinds == 255])
        for p in new.tolist():
            c = chr(p)
            # letters make one piece of this, blanks two, other characters three, numbers four
            pieces = len(self.library.pre_tokenizer.pre_tokenize_str(f"a{c}{c}a"))
            self.classes[p] = (LETTER, SPACE, OTHER, NUMBER)[pieces - 1]
        return self.classes[points] if len(new) else kinds

    def plain(self, text: str) -> str:
        """Composed and lower-cased as the library does, character by character."""
        if text.isascii():
            return text.lower()
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        new = np.unique(points[~self.seen[points]])
        for p in new.tolist():
            c = chr(p)
            mine = _lower(unicodedata.normalize("NFC", c))
            theirs = self.library.normalizer.normalize_str(c)
            if mine != theirs and not c.isspace():
                self.odd[p] = theirs
        self.seen[new] = True
        if self.odd:
            text = text.translate(self.odd)
        return _lower(unicodedata.normalize("NFC", text))

    def pieces(self, text: str, state: int) -> tuple[np.ndarray, np.ndarray, pa.Array, int]:
        """Flags of starts, byte ends of the characters without blanks, the bytes, the state at the end."""
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        kinds = self.classify(points)
        flags, state = starts(kinds, state)
        width = (1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)).astype(np.int64)
        solid = kinds != SPACE
        data = np.frombuffer(text.encode(), np.uint8)
        if not solid.all():
            data = data[np.repeat(solid, width)]
        return flags, np.cumsum(width * solid), data, state

    def each(self, flags: np.ndarray, ends: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Token counts of the pieces."""
        at = np.flatnonzero(flags)
        offsets = np.empty(len(at) + 1, np.int64)
        offsets[:-1] = np.where(at > 0, ends[at - 1], 0)
        offsets[-1] = len(data)
        array = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        distinct = array.dictionary
        if len(distinct) == 0:
            return np.zeros(0, np.int64)
        _, bounds, flat = distinct.buffers()
        flat, bounds = np.frombuffer(flat, np.uint8), np.frombuffer(bounds, np.int64)[: len(distinct) + 1]
        words = distinct.to_pylist()
        known = self.known
        counts = np.array([known.get(w, -1) for w in words], np.int64)
        new = np.flatnonzero(counts < 0)
        if len(new):
            size = np.diff(bounds)[new]
            counts[new] = self.merges.counts(flat[expand(bounds[new], size)], np.concatenate([[0], np.cumsum(size)]))
            if len(known) + len(new) > REMEMBERED:
                known.clear()
            known.update((words[i], c) for i, c, n in zip(new.tolist(), counts[new].tolist(), size.tolist(), strict=True) if n <= LONGEST)
        return counts[array.indices.to_numpy()]

    def short(self, texts: list[str]) -> np.ndarray:
        """Tokens of texts that are counted side by side."""
        specials = np.zeros(len(texts), np.int64)
        plain = []
        for i, t in enumerate(texts):
            if "<|" in t:
                parts = self.specials.split(t)
                specials[i] = len(parts) - 1
                t = "\n".join(parts)
            plain.append(self.plain(t))
        whole = "\n".join([*plain, ""])
        flags, ends, data, _ = self.pieces(whole, BETWEEN)
        tokens = np.concatenate([[0], np.cumsum(self.each(flags, ends, data))])
        bounds = np.cumsum([0, *[len(t) + 1 for t in plain]])
        before = np.concatenate([[0], np.cumsum(flags)])[bounds]
        return tokens[before[1:]] - tokens[before[:-1]] + specials

    def long(self, text: str) -> int:
        """Tokens of one text, window by window; holds one window and one state of each machine."""
        parts = self.specials.split(text)
        total, grows = len(parts) - 1, Growing(self.merges)
        for part in parts:
            state, at = BETWEEN, 0
            while at < len(part):
                end = cut(part, at + WINDOW)
                window = self.plain(part[at:end])
                at = end
                flags, ends, data, state = self.pieces(window, state)
                # what comes before the window's first start or blank belongs to the piece that grows
                solid = np.diff(ends, prepend=0) > 0
                stop = int(np.argmax(flags | ~solid)) if (flags | ~solid).any() else len(flags)
                head = int(ends[stop - 1]) if stop else 0
                grows.feed(data[:head].tobytes())
                if stop == len(flags):
                    continue
                total += grows.end()
                firsts = np.flatnonzero(flags)
                if len(firsts) == 0:
                    continue
                tail = int(firsts[-1])
                if solid[tail:].all():  # the last piece may go on
                    grows.feed(data[int(ends[tail - 1]) if tail else 0 :].tobytes())
                    data, flags = data[: int(ends[tail - 1]) if tail else 0], flags.copy()
                    flags[tail] = False
                total += int(self.each(flags, ends, data).sum())
            total += grows.end()
        return total


def _lower(text: str) -> str:
    """Without the rule for a final sigma, which looks around."""
    return text.replace("Σ", "σ").lower()


def cut(text: str, at: int) -> int:
    """The first place from ``at`` on where composing does not look back and no contraction is open."""
    while at < len(text):
        p = ord(text[at])
        if (p < 0x300 or 0x3400 <= p <= 0x9FFF or 0xAC00 <= p <= 0xD7A3) and "'" not in text[at - 3 : at]:
            return at
        at += 1
    return len(text)


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def file_path(name: str = FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT, text: str = "text") -> DataFrame:
    """The rows without the text, with n_bytes (UTF-8), n_tokens and over_limit; no shuffle.

    Other columns stay, but those named as one of the three are replaced.
    """
    path = path or file_path()
    made = ["n_bytes", "n_tokens", "over_limit"]
    others = [c for c in docs.columns if c.lower() != text.lower() and c.lower() not in made]
    t = fresh(docs.select(*others), "_text")
    rows = docs.select(*others, text_of(text).alias(t))
    fields = [f for f in rows.schema.fields if f.name != t]
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["n_bytes long", "n_tokens long", "over_limit boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for whole in batches:
            for batch in slices(whole, t, SLICE):
                values = batch.column(t)
                sizes = pc.binary_length(values).cast(pa.int64())
                if batch.num_rows == 1 and sizes[0].as_py() > SLICE:
                    tokens = np.array([c.long(values[0].as_py())], np.int64)
                else:
                    tokens = c.short(values.to_pylist())
                kept = [batch.column(f.name) for f in fields]
                yield pa.RecordBatch.from_arrays([*kept, sizes, pa.array(tokens), pa.array(tokens > limit)], names=[*[f.name for f in fields], *made])

    return rows.mapInArrow(run, ddl)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every whole text of documents."""
    return count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))
