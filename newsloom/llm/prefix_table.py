"""SentencePiece encoding and decoding of merge-type (BPE) models by a prefix table.

A prefix of a text has one BPE encoding, and so one last token. The encoder stores
that token for each prefix and reads the ids backwards. The last token of a prefix
is the longest vocabulary match that ends there and is compatible with the last
token of the prefix before it: the two stand side by side in the encoding of their
joined text. Matches come from an automaton (a trie of the reversed pieces, walked
backwards from every place), and pair tests walk down the merge trees of the two
tokens over the times at which their edges lie next to each other.

Pieces hold blank marks only at their start, so a text is cut before each blank that
follows something else, and equal chunks are encoded once. Chunks of usual length run in
numpy, many at once; longer ones (runs of blanks, texts without blanks) go place by
place through the same table with remembered pair tests, in time proportional to their
length. Models whose merge ranks do not grow along their trees are refused.

The model's file is a parameter, read on the executors; nothing is trained. Byte
fallback spells characters that are no piece. Decoding joins the pieces' bytes,
turns marks into blanks and drops the blank that encoding put in front.

Edge cases: a null text is an empty one and gives begin and end id only; very long
texts are encoded whole, whatever blanks they have (a million blanks, or characters
without a blank, take seconds); each row is encoded by itself, so ties and repeated rows
change nothing; ``encode`` replaces a column of the name it writes, other columns pass.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from .common import expand, slices, small_batches, table

MARK = "▁"
MODEL = "piece_bpe_32k.model"
_NONE = np.iinfo(np.int64).max
#: Chunks longer than this go place by place; shorter ones in numpy, about so many characters at once.
LONG, AT_ONCE = 1000, 1 << 18


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _one_mark_per_byte(e: UnicodeDecodeError) -> tuple[str, int]:
    return "�", e.start + 1


codecs.register_error("one_mark_per_byte", _one_mark_per_byte)


class PrefixTable:
    """Tokens are numbered as in the model; characters that are no piece get numbers after them."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, trainer = model.normalizer_spec, model.trainer_spec
        plain = not norm.precompiled_charsmap and norm.add_dummy_prefix and not norm.remove_extra_whitespaces and norm.escape_whitespaces
        if trainer.model_type != trainer.BPE or not plain or not trainer.byte_fallback or any(p.type == p.USER_DEFINED for p in model.pieces):
            raise ValueError(f"{path}: only BPE models with identity normalisation and byte fallback")
        self.begin, self.end = trainer.bos_id, trainer.eos_id
        self.size = len(model.pieces)
        self.id_of = {p.piece: i for i, p in enumerate(model.pieces) if p.type == p.NORMAL}
        self.byte_id = np.zeros(256, np.int32)
        spelled = []
        for i, p in enumerate(model.pieces):
            if p.type == p.BYTE:
                self.byte_id[int(p.piece[1:-1], 16)] = i
                spelled.append(bytes([int(p.piece[1:-1], 16)]))
            else:
                spelled.append(b"" if p.type == p.CONTROL else p.piece.replace(MARK, " ").encode())
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_at = np.concatenate(([0], np.cumsum([len(s) for s in spelled])))
        # Rank: a better score merges earlier; single characters are there from the start.
        order = sorted(self.id_of, key=lambda s: -model.pieces[self.id_of[s]].score)
        self.rank_of = {s: (0 if len(s) == 1 else r + 1) for r, s in enumerate(order)}
        self.crossing = any(MARK in s.lstrip(MARK) for s in self.id_of)
        self._build_trees()
        self._build_automaton()

    def _build_trees(self) -> None:
        """The two halves of each piece's last merge, and the rank of every pair that can merge."""
        n = self.size
        self.rank, self.left, self.right = np.zeros(n, np.int64), np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        self.usable = np.zeros(n, bool)
        ordered = True
        pairs = []
        for s, i in sorted(self.id_of.items(), key=lambda x: len(x[0])):
            self.rank[i] = self.rank_of[s]
            halves = [(self.id_of.get(s[:k]), self.id_of.get(s[k:])) for k in range(1, len(s))]
            pairs += [(a, b, self.rank[i]) for a, b in halves if a is not None and b is not None]
            if len(s) == 1:
                self.usable[i] = True
            else:
                last = self._last_merge(s)
                if last is not None:
                    self.usable[i], (self.left[i], self.right[i]) = True, last
                    ordered &= bool(self.rank[i] > max(self.rank[last[0]], self.rank[last[1]]))
        if not ordered:
            raise ValueError("only models whose merge ranks grow along their trees")
        key = np.array([a << 32 | b for a, b, _ in pairs], np.int64)
        at = np.argsort(key)
        self.pair_key, self.pair_rank = key[at], np.array([r for _, _, r in pairs], np.int64)[at]

    def _last_merge(self, s: str) -> tuple[int, int] | None:
        parts = list(s)
        while len(parts) > 2:
            best = min(((self.rank_of.get(a + b, _NONE), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))))
            if best[0] == _NONE:
                return None
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        ids = [self.id_of.get(p) for p in parts]
        return None if None in ids else (ids[0], ids[1])

    def _build_automaton(self) -> None:
        """A trie of the reversed usable pieces; an edge is keyed by state and character."""
        edges: dict[int, int] = {}
        ends = {0: -1}
        for s, i in self.id_of.items():
            if self.usable[i]:
                state = 0
                for c in reversed(s):
                    state = edges.setdefault(state << 21 | ord(c), len(ends))
                    ends.setdefault(state, -1)
                ends[state] = i
        keys = np.array(sorted(edges), np.int64)
        self.edge_key, self.edge_to = keys, np.array([edges[k] for k in keys], np.int64)
        self.accepts = np.array([ends[k] for k in range(len(ends))], np.int64)
        self.longest = max(len(s) for s in self.id_of)

    def _pairs_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], _NONE)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the encoding of the joined text of a and b is a, b (elementwise).

        x and y are the edge tokens of both sides at some time: x lives from its own
        rank to that of the merge that takes it up. If they can merge while both live,
        they do. A merge that takes x up at the same rank lies further left and comes
        first; one that takes y up lies further right and comes later.
        """
        ok = np.ones(len(a), bool)
        at = np.flatnonzero((a < self.size) & (b < self.size))
        x, y = a[at], b[at]
        x_gone, y_gone = np.full(len(at), _NONE), np.full(len(at), _NONE)
        while len(at):
            r = self._pairs_rank(x, y)
            rx, ry = self.rank[x], self.rank[y]
            hit = (r < x_gone) & (r <= y_gone) & (r != _NONE) & (r > rx) & (r > ry)
            ok[at[hit]] = False
            go = ~hit & ((self.left[x] >= 0) | (self.left[y] >= 0))
            down_x = rx >= ry
            x_gone, y_gone = np.where(down_x, rx, x_gone), np.where(down_x, y_gone, ry)
            x, y = np.where(down_x, self.right[x], x), np.where(down_x, y, self.left[y])
            at, x, y, x_gone, y_gone = at[go], x[go], y[go], x_gone[go], y_gone[go]
            alive = (x >= 0) & (y >= 0)
            at, x, y, x_gone, y_gone = at[alive], x[alive], y[alive], x_gone[alive], y_gone[alive]
        return ok

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ids of all chunks (marks in place of blanks) and their offsets."""
        size = np.array([len(c) for c in chunks], np.int64)
        many = np.flatnonzero(size <= LONG)
        group = np.cumsum(size[many]) // AT_ONCE
        parts = [(many[group == g], None) for g in np.unique(group)] + [(np.array([i]), chunks[i]) for i in np.flatnonzero(size > LONG)]
        ids, owners = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for at, long in parts:
            text = long if long is not None else "".join([chunks[i] for i in at])
            code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
            start = np.cumsum(size[at]) - size[at]
            token, length = self._prefix_tokens(code, start, size[at]) if long is None else self._long_tokens(code)
            which, place = self._backwards(start, size[at], length)
            own, per = self._to_ids(token[place], code[place])
            ids.append(own)
            owners.append(np.repeat(at[which], per))
        ids, owners = np.concatenate(ids), np.concatenate(owners)
        order = np.argsort(owners, kind="stable")
        return ids[order], np.concatenate(([0], np.cumsum(np.bincount(owners, minlength=len(chunks)))))

    def _backwards(self, start: np.ndarray, size: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places where tokens end, chunk by chunk in order: the last place of each, then the one before its token."""
        if len(size) == 1:
            places, at = [], int(size[0]) - 1
            steps = length.tolist()
            while at >= 0:
                places.append(at)
                at -= steps[at]
            return np.zeros(len(places), np.int64), np.array(places[::-1], np.int64)
        which = np.flatnonzero(size > 0)
        here, found, back = (start + size - 1)[which], [(which[:0], which[:0], which[:0])], 0
        while len(which):
            found.append((which, np.full(len(which), back), here))
            here = here - length[here]
            go = here >= start[which]
            which, here, back = which[go], here[go], back + 1
        w, k, at = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((-k, w))
        return w[order], at[order]

    @functools.cached_property
    def _tables(self) -> tuple:
        """What _long_tokens looks up, as dicts and lists; remembered pair tests last."""
        edges = dict(zip(self.edge_key.tolist(), self.edge_to.tolist(), strict=True))
        pairs = dict(zip(self.pair_key.tolist(), self.pair_rank.tolist(), strict=True))
        return edges, self.accepts.tolist(), pairs, self.rank.tolist(), self.left.tolist(), self.right.tolist(), {}

    def _fits(self, a: int, b: int) -> bool:
        """compatible() of one pair."""
        _, _, pairs, rank, left, right, known = self._tables
        key = a << 32 | b
        if key not in known:
            x, y, x_gone, y_gone, ok = a, b, _NONE, _NONE, True
            while a < self.size and b < self.size and x >= 0 and y >= 0:
                r, rx, ry = pairs.get(x << 32 | y, _NONE), rank[x], rank[y]
                if r != _NONE and r < x_gone and r <= y_gone and r > rx and r > ry:
                    ok = False
                    break
                if left[x] < 0 and left[y] < 0:
                    break
                if rx >= ry:
                    x_gone, x = rx, right[x]
                else:
                    y_gone, y = ry, left[y]
            if len(known) >= 1 << 20:
                known.clear()
            known[key] = ok
        return known[key]

    def _long_tokens(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """_prefix_tokens of one long chunk."""
        edges, accepts = self._tables[:2]
        codes = code.tolist()
        token, length = np.zeros(len(codes), np.int64).tolist(), [1] * len(codes)
        for i, c in enumerate(codes):
            token[i], state, k, found = self.size + c, 0, 0, []
            while k <= i and (state := edges.get(state << 21 | codes[i - k])) is not None:
                if accepts[state] >= 0:
                    found.append((k, accepts[state]))
                k += 1
            for k, t in reversed(found):
                if k == 0 or k == i or self._fits(token[i - k - 1], t):
                    token[i], length[i] = t, k + 1
                    break
        return np.array(token, np.int64), np.array(length, np.int64)

    def _to_ids(self, token: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens to ids: characters that are no piece become their bytes."""
        unknown = np.flatnonzero(token >= self.size)
        if not len(unknown):
            return token.astype(np.int32), np.ones(len(token), np.int64)
        per = np.ones(len(token), np.int64)
        raw = [chr(c).encode("utf-8", "surrogatepass") for c in code[unknown]]
        per[unknown] = [len(r) for r in raw]
        ids = np.repeat(token, per)
        at = expand((np.cumsum(per) - per)[unknown], per[unknown])
        ids[at] = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        return ids.astype(np.int32), per

    def _prefix_tokens(self, code: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every place the last token of the prefix that ends there, and its length."""
        n = len(code)
        offset = np.arange(n) - np.repeat(start, size)
        # Automaton matches: match[k][i] is the token of k + 1 characters that ends at i.
        match, state, at = [], np.zeros(n, np.int64), np.arange(n)
        for k in range(self.longest):
            key = state << 21 | code[at - k]
            e = np.minimum(np.searchsorted(self.edge_key, key), len(self.edge_key) - 1)
            go = self.edge_key[e] == key
            at, state = at[go], self.edge_to[e[go]]
            row = np.full(n, -1, np.int32)
            row[at] = self.accepts[state]
            match.append(row)
            inside = offset[at] > k
            at, state = at[inside], state[inside]
            if not len(at):
                break
        token, length = np.full(n, -1, np.int64), np.ones(n, np.int64)
        none = match[0] < 0  # a character that is no piece stands alone
        by_size = np.argsort(-size, kind="stable")
        by_size = by_size[size[by_size] > 0]
        sorted_size = -size[by_size]
        for i in range(int(size[by_size[0]]) if len(by_size) else 0):
            place = start[by_size[: np.searchsorted(sorted_size, -i, side="left")]] + i
            open_ = place
            for k in range(min(i, len(match) - 1), -1, -1):
                t = match[k][open_].astype(np.int64)
                if k == 0:
                    t = np.where(none[open_], self.size + code[open_], t)
                has = t >= 0
                if not has.any():
                    continue
                cand, t = open_[has], t[has]
                if k == 0:  # some token always fits: the last character's own
                    fits = np.ones(len(cand), bool)
                elif k == i:
                    fits = np.ones(len(cand), bool)
                else:
                    fits = self._compatible_once(token[cand - k - 1], t)
                done = cand[fits]
                token[done], length[done] = t[fits], k + 1
                rest = np.ones(len(open_), bool)
                rest[np.flatnonzero(has)[fits]] = False
                open_ = open_[rest]
                if not len(open_):
                    break
        return token, length

    def _compatible_once(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """compatible() over the distinct pairs."""
        if len(a) < 64:
            return self.compatible(a, b)
        key, back = np.unique(a << 32 | b, return_inverse=True)
        return self.compatible(key >> 32, key & 0xFFFFFFFF)[back]

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, with begin and end id."""
        chunks, counts = self.cut(texts)
        coded = chunks.dictionary_encode()
        ids, offsets = self.encode_chunks(coded.dictionary.to_pylist())
        index, ends = coded.indices.to_numpy(), np.cumsum(counts)
        for a, b in zip(ends - counts, ends, strict=True):
            w = index[a:b]
            body = ids[expand(offsets[w], offsets[w + 1] - offsets[w])]
            yield np.concatenate(([self.begin], body, [self.end])).astype(np.uint32)

    def cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The chunks of all texts, marks in place of blanks, and how many each text has."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if self.crossing:
            marked = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(MARK, pc.replace_substring(texts, " ", MARK), ""))
            return marked, np.ones(len(texts), np.int64)
        odd = pc.or_(pc.match_substring(texts, "  "), pc.or_(pc.match_substring(texts, MARK), pc.or_(pc.starts_with(texts, " "), pc.ends_with(texts, " ")))).to_numpy(zero_copy_only=False)
        # Usual texts: every blank starts a chunk. Runs of blanks stay with the word after them.
        lists = pc.split_pattern(pc.if_else(pa.array(odd), "", texts), " ")
        parts = pc.binary_join_element_wise(pa.scalar(MARK, pa.large_string()), lists.values, pa.scalar("", pa.large_string()))
        counts = np.bincount(pc.list_parent_indices(lists).to_numpy(), minlength=len(texts)).astype(np.int64)
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False) | odd
        if not empty.any():
            return parts, counts
        keep = np.repeat(~empty, counts)
        parts, counts = parts.filter(pa.array(keep)), np.where(empty, 0, counts)
        if not odd.any():
            return parts, counts
        import re

        extra = {i: re.findall(f"{MARK}+[^{MARK}]*|[^{MARK}]+", MARK + texts[int(i)].as_py().replace(" ", MARK)) for i in np.flatnonzero(odd)}
        pieces, at = [], np.cumsum(counts)
        last = 0
        for i, found in extra.items():
            pieces += [parts.slice(last, at[i] - last), pa.array(found, pa.large_string())]
            last = int(at[i])
            counts[i] = len(found)
        return pa.concat_arrays([*pieces, parts.slice(last)]), counts

    def decode(self, ids: np.ndarray) -> bytes:
        """The UTF-8 text of the ids, as the library decodes them."""
        ids = ids.astype(np.int64)
        at = self.spelled_at[ids]
        raw = self.spelled[expand(at, self.spelled_at[ids + 1] - at)].tobytes()
        raw = raw[1:] if raw[:1] == b" " else raw
        try:
            raw.decode()
            return raw
        except UnicodeDecodeError:
            return raw.decode("utf-8", "one_mark_per_byte").encode()


@functools.lru_cache(maxsize=2)
def prefix_table(path: str) -> PrefixTable:
    """One table a worker and model."""
    return PrefixTable(path)


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """docs with a column more, the ids with begin and end id; other columns pass."""
    from pyspark.sql import types as T

    small_batches(docs.sparkSession)
    kept = docs.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, text):
                ids = [x.astype(np.int32) for x in prefix_table(path).encode(part.column(text))]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.list_(pa.int32()))], names=[*part.schema.names, out])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))]))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes each text, decodes the ids."""
    small_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, "text"):
                t = prefix_table(path)
                n, ids_sha, decoded_sha = [], [], []
                for ids in t.encode(part.column("text")):
                    n.append(len(ids))
                    ids_sha.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                    decoded_sha.append(hashlib.sha256(t.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9_prefix_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), vocabulary_path(MODEL))
