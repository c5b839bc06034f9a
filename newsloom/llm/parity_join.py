"""N-gram Jaccard join by parity sketches: all links of sets with Jaccard >= num / den.

A document's set holds the hashes of its distinct k-word shingles. A parity sketch
has a bit for each hash cell and every shingle flips one, so the Hamming distance of
two sketches is at most the size of the symmetric difference of the sets.

1. Bands. Bounds of the size bands double. Two sets meet in the band of the larger one,
   so a set gives keys for its own band and, if a partner may lie there, for the next.
   ``D`` is the most shingles by which a set can differ from a partner there (a Jaccard
   of t bounds the difference by (1-t)/(1+t) of the sizes' sum).
2. Pigeonhole. The band's wide sketch is cut into B > D blocks; a block is named by
   the XOR of random codes of its odd bits. Linked sets agree in at least B - D blocks.
   All sets order their blocks alike, fullest first (equal names hold equally many
   shingles), then by name. Of two linked sets each has at most D blocks that the other
   lacks, so the first 1 + s common blocks are among the first D + 1 + s of both: a set
   gives just these as keys. Blocks of one shingle or none, in which sets agree by a
   shared word, come last and are hardly ever given.
3. Hot keys. A key of more than ``HOT`` sets is hot. Of the 1 + s common keys one is not
   hot if one of the sets has at most s hot ones: such a set's hot keys are dropped
   without loss; common passages and frequent words go this way. A key that is
   frequent within one slice of a task is counted there and crosses the shuffle once,
   its members are spread by key and id.
4. Verification. In each key every set is compared with a leader (a star, not all pairs):
   the smallest id, in hot keys also the set with the most hot keys. Links give
   components. Keys that still hold several components are settled across these: pairs
   of small ones (HOT sets at most) are joined; in hot ones the sets outside the largest
   component are held against all others, tile by tile, by wider sketches, and only
   pairs that may link become rows. Every pair is first held against the Hamming
   distance of sketches and then, if it may link, against the whole sets.

Sets that are equal are one node (groups by a 128-bit sum of the hashes), so copies
never form pairs. Components come from label propagation with pointer jumping over
tables in the shared folder; nothing but counts reaches the driver. Tables go once what
reads them is written.

Edge cases: null and texts without words have no set, and each is its own component;
fewer than k words make one shingle of all; very long texts are cut into shingles whole,
one text at a time; null ids carry no links but the class of their set; rows with the
same id are one document with all its texts; extra columns are not read. Ids must be
whole numbers. Shingles and words are compared by 64-bit hashes.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.operators.similarity import components
from newsloom.operators.store import discard

from .common import bounded, flat_words, slices, small_batches, stored, table

HOT = 20
#: Sets on either side of a tile of a hot key.
TILE = 2000
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The ascending distinct shingle hashes of each text."""
    words, counts = flat_words(texts)
    coded = words.dictionary_encode()
    names = coded.dictionary.to_pylist()
    # bytes.lower() lowers A-Z alone.
    word = np.fromiter((xxhash.xxh64_intdigest(w.encode().lower()) for w in names), np.uint64, len(names))[coded.indices.to_numpy()]
    rolled = np.full(max(0, len(word) - k + 1), k, np.uint64)
    for j in range(k):
        rolled = (rolled ^ word[j : j + len(rolled)]) * _A
        rolled ^= rolled >> np.uint64(29)
    rolled = mix(rolled)
    end = 0
    for n in counts:
        a, end = end, end + int(n)
        if n >= k:
            yield np.unique(rolled[a : end - k + 1])
        elif n:
            yield mix(np.array([xxhash.xxh64_intdigest(word[a:end].tobytes())], np.uint64))
        else:
            yield np.empty(0, np.uint64)


class Bands:
    """Size bands for Jaccard >= num / den: differences, blocks and keys."""

    def __init__(self, num: int, den: int) -> None:
        self.num, self.den = num, den

    def most(self, sizes: int) -> int:
        """The most shingles that linked sets of that many shingles together can differ in."""
        return sizes * (self.den - self.num) // (self.den + self.num)

    def blocks(self, band: int) -> int:
        """A third more than the largest difference in the band, so that poor blocks can stay out."""
        return 4 * (self.most(2 << band) + 1) // 3 + 2

    def meetings(self, n: int) -> list[tuple[int, int]]:
        """(band, D): where a set of n shingles meets partners, and how far they can differ. Band b ends at 2 ** b."""
        own, largest = (n - 1).bit_length(), n * self.den // self.num
        out = [(own, self.most(n + min(largest, 1 << own)))]
        return out if largest <= 1 << own else [*out, (own + 1, self.most(n + largest))]

    def keys(self, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
        """For each band a set meets partners in: its keys, and how many of them may be hot (s)."""
        code = mix(hashes ^ _A)
        for band, d in self.meetings(len(hashes)):
            n = self.blocks(band)
            block = ((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)  # ascending, as the hashes are
            start = np.concatenate(([0], np.flatnonzero(np.diff(block)) + 1))
            filled, names = block[start], np.bitwise_xor.reduceat(code, start)
            held = np.diff(np.append(start, len(block))).astype(np.uint64)
            want = max(d + 1, min(len(filled), d + 3 + d // 16))
            if want > len(filled):
                empty = np.setdiff1d(np.arange(n, dtype=np.uint64), filled)
                filled = np.concatenate((filled, empty))
                names, held = (np.concatenate((x, np.zeros(len(empty), np.uint64))) for x in (names, held))
            key = mix(names ^ mix(filled + np.uint64(band << 40)))
            first = np.argsort(((np.uint64((1 << 16) - 1) - np.minimum(held, np.uint64(65535))) << np.uint64(48)) | (key >> np.uint64(16)))[:want]
            yield key[first].view(np.int64), want - d - 1

    def sketch(self, hashes: np.ndarray, width: int = 4) -> bytes:
        """A parity sketch: a power of two of bits, at least ``width`` for each shingle that may differ."""
        bits = 1 << max(6, (width * self.most(2 * len(hashes))).bit_length())
        odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
        return np.packbits(odd.astype(np.uint8)).tobytes()


def hamming(a: bytes, b: bytes) -> int:
    """Distance of two sketches; the longer one is folded onto the shorter."""
    x, y = (np.frombuffer(s, np.uint8) for s in sorted((a, b), key=len))
    y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


@functools.lru_cache(maxsize=4)
def bands(num: int, den: int) -> Bands:
    return Bands(num, den)


def _signatures(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = bands(num, den)
        for b in batches:
            for part in slices(b, "text"):
                n, s1, s2, sketch = [], [], [], []
                for h in shingle_sets(part.column("text"), k):
                    n.append(len(h))
                    s1.append(int(mix(h + _B).sum(dtype=np.uint64).astype(np.int64)))
                    s2.append(int(np.bitwise_xor.reduce(mix(h ^ _B)).astype(np.int64)) if len(h) else 0)
                    sketch.append(of.sketch(h))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(sketch, pa.binary())], names=["doc_id", "n", "s1", "s2", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n long, s1 long, s2 long, sketch binary")


def _keys(docs: DataFrame, k: int, num: int, den: int, hot: int) -> DataFrame:
    """r, key, id, slot, one row a key of a set; of equal sets in a batch the first row speaks for all.

    Rows of a key meet at r. Where a slice holds a key in more than ``hot`` sets, its rows are
    spread (r of key and id, key given) and one row more, of slot -n, counts them at the key.
    slot is 64 * s + a tag of the band.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = bands(num, den)
        for b in batches:
            for part in slices(b, "text"):
                keys, ids, slots, seen = [], [], [], set()
                for doc_id, h in zip(part.column("doc_id").to_pylist(), shingle_sets(part.column("text"), k), strict=True):
                    if not len(h) or doc_id is None or (name := xxhash.xxh3_128_digest(h.tobytes())) in seen:
                        continue
                    seen.add(name)
                    for tag, (key, spare) in enumerate(of.keys(h)):
                        keys.append(key)
                        ids.append(np.full(len(key), doc_id, np.int64))
                        slots.append(np.full(len(key), 64 * spare + tag, np.int32))
                if not keys:
                    continue
                key, doc, slot = (np.concatenate(x) for x in (keys, ids, slots))
                values, first, where, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
                many = np.flatnonzero(count > hot)
                spread = (count > hot)[where]
                r = np.where(spread, mix(key.view(np.uint64) ^ mix(doc.view(np.uint64))).view(np.int64), key)
                no_key = np.concatenate((~spread, np.ones(len(many), bool)))
                out = [np.concatenate(x) for x in ((r, values[many]), (key, values[many]), (doc, doc[first[many]]), (slot, -count[many].astype(np.int32)))]
                yield pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1], mask=no_key), pa.array(out[2]), pa.array(out[3])], names=["r", "key", "id", "slot"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "r long, key long, id long, slot int")


def _sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """id, hashes of the listed ids (a stored table)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, "text"):
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([h.view(np.int64) for h in shingle_sets(part.column("text"), k)], pa.list_(pa.int64()))], names=["id", "hashes"])

    return docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(bounded(ids), "id", "left_semi").mapInArrow(run, "id long, hashes array<long>")


def _possible(pairs: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs whose sizes and sketches allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = [x.to_pylist() for x in b.columns]
            keep = [hamming(x, y) * (num + den) <= (m + n) * (den - num) for m, x, n, y in zip(*c[2:], strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    a, b = (nodes.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"k{x}")) for x in "ab")
    near = (F.least("na", "nb") * den >= F.greatest("na", "nb") * num)
    return pairs.join(a, "a").join(b, "b").where(near).select("a", "b", "na", "ka", "nb", "kb").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs whose whole sets link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("x"), b.column("y"), strict=True):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_a = pairs.join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("x")), "a")
    return with_a.join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("y")), "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _linked(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs that link, as a stored table."""
    possible = stored(_possible(pairs, nodes, num, den), "possible")
    ids = stored(possible.select(F.col("a").alias("id")).union(possible.select("b")).distinct(), "possible-ids")
    sets = stored(_sets(docs, ids, k), "sets")
    out = stored(_verified(possible, sets, num, den), "links")
    discard(possible, ids, sets)
    return out


def _meetings(keys: DataFrame, copies: DataFrame, hot: int) -> tuple[DataFrame, DataFrame]:
    """key, id, heat (hot keys of the set there; 0 in others) where sets meet; key, n, leader, second of each key.

    Both are stored tables. Hot keys of sets that can spare them are left out.
    """
    at = Window.partitionBy("r")
    met = F.sum(F.when(F.col("slot") < 0, -F.col("slot")).otherwise(1)).over(at)
    shared = keys.withColumn("met", met).where("key is not null or (met > 1 and slot >= 0)").select(F.coalesce("key", "r").alias("key"), "id", "slot")
    # Copies of a set stand behind their class; those of one batch gave their keys once.
    shared = stored(shared, "shared-keys")
    members = stored(shared.join(copies, "id", "left").select("key", F.coalesce("rep", "id").alias("id"), "slot").distinct(), "members")
    discard(shared)
    size = stored(members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("leader")).where("n > 1"), "key-sizes")
    few = members.join(size.where(F.col("n") <= hot).select("key"), "key").select("key", "id", F.lit(0).cast("long").alias("heat"))
    many = stored(members.join(size.where(F.col("n") > hot).select("key"), "key"), "hot-keys")
    heat = many.groupBy("id", "slot").agg(F.count(F.lit(1)).alias("heat")).where("heat > shiftright(slot, 6)")
    meetings = stored(few.unionByName(many.join(heat, ["id", "slot"]).select("key", "id", "heat")), "meetings")
    discard(members, many, size)
    keys = meetings.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("leader"), F.max(F.struct("heat", F.negate("id").alias("id"))).alias("top"))
    return meetings, stored(keys.where("n > 1").select("key", "n", "leader", F.when(F.col("top.heat") > 0, -F.col("top.id")).alias("second")), "meeting-keys")


def _mixed(meetings: DataFrame, keys: DataFrame, comp: DataFrame) -> DataFrame:
    """key, id, n, comp of the keys that hold several components, as a stored table."""
    placed = stored(meetings.join(comp, "id", "left").select("key", "id", F.coalesce("comp", "id").alias("comp")), "placed")
    mixed = placed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("key")
    out = stored(placed.join(mixed.join(keys.select("key", "n"), "key"), "key"), "mixed")
    discard(placed)
    return out


def _across(mixed: DataFrame) -> DataFrame:
    """Pairs a < b of different components in one small key."""
    a, b = (mixed.select("key", F.col("id").alias(x), F.col("comp").alias(f"c{x}")) for x in "ab")
    return a.join(b, "key").where("a < b and ca <> cb").select("a", "b").distinct()


def _across_hot(mixed: DataFrame, docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Pairs a < b of different components in one hot key that may link, as a stored table.

    The sets outside a key's largest component meet all its sets in tiles; a tile pair
    is one group, whose sketches are compared as matrices.
    """

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = bands(num, den)
        for b in batches:
            for part in slices(b, "text"):
                h = list(shingle_sets(part.column("text"), k))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([len(x) for x in h], pa.int64()), pa.array([of.sketch(x, 24) for x in h], pa.binary())], names=["id", "size", "sketch"])

    def compare(p: pd.DataFrame) -> pd.DataFrame:
        found = []
        lengths = p["sketch"].map(len).to_numpy()
        parts = [(side, n, p[(p["side"] == side).to_numpy() & (lengths == n)]) for side in (0, 1) for n in np.unique(lengths)]
        for _, n, x in parts[: len(parts) // 2]:
            for _, m, y in parts[len(parts) // 2 :]:
                if len(x) and len(y):
                    low = min(n, m)
                    a, b = (np.bitwise_xor.reduce(np.frombuffer(b"".join(z["sketch"]), np.uint64).reshape(len(z), -1, low // 8), axis=1) for z in (x, y))
                    step = max(1, (4 << 20) // b.nbytes)  # some megabytes at once
                    for at in range(0, len(a), step):
                        rows = x.iloc[at : at + step]
                        sizes, others = rows["size"].to_numpy()[:, None], y["size"].to_numpy()[None, :]
                        near = (sizes + others) * (den - num) >= np.bitwise_count(a[at : at + step, None, :] ^ b[None, :, :]).sum(2, dtype=np.int64) * (num + den)
                        near &= (np.minimum(sizes, others) * den >= np.maximum(sizes, others) * num) & (rows["comp"].to_numpy()[:, None] != y["comp"].to_numpy()[None, :])
                        i, j = np.nonzero(near)
                        u, v = rows["id"].to_numpy()[i], y["id"].to_numpy()[j]
                        found.append(np.stack((np.minimum(u, v), np.maximum(u, v)), 1))
        return pd.DataFrame(np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.int64), columns=["a", "b"])

    ids = stored(mixed.select("id").distinct(), "hot-ids")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(bounded(ids), "id", "left_semi")
    wide = stored(texts.mapInArrow(sketches, "id long, size long, sketch binary"), "wide-sketches")
    held = mixed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("m")).groupBy("key").agg(F.max_by("comp", "m").alias("largest"), F.sum("m").alias("all"), F.max("m").alias("most"))
    held = held.select("key", "largest", F.ceil((F.col("all") - F.col("most")) / TILE).alias("rows"), F.ceil(F.col("all") / TILE).alias("columns"))
    rows = stored(mixed.select("key", "id", "comp").join(held, "key"), "hot-tiles")
    tile = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    a = rows.where("comp <> largest").select("key", tile("rows").alias("i"), every("columns").alias("j"), "id", "comp", F.lit(0).alias("side"))
    b = rows.select("key", tile("columns").alias("j"), every("rows").alias("i"), "id", "comp", F.lit(1).alias("side"))
    met = a.unionByName(b).join(wide, "id").groupBy("key", "i", "j").applyInPandas(compare, "a long, b long")
    out = stored(met.distinct(), "hot-pairs")
    discard(ids, wide, rows)
    return out


def classes(docs: DataFrame, k: int = 3, num: int = 9, den: int = 10, hot: int = HOT) -> DataFrame:
    """docs: doc_id, text. One row a document: doc_id, n_shingles, component_id."""
    small_batches(docs.sparkSession)
    signed = stored(_signatures(docs, k, num, den), "signatures")
    sets_of = stored(signed.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch"), F.count(F.lit(1)).alias("copies")), "set-classes")
    copies = signed.where("n > 0").join(sets_of.where("copies > 1").select("n", "s1", "s2", "rep"), ["n", "s1", "s2"]).where("doc_id <> rep")
    copies = stored(copies.select(F.col("doc_id").cast("long").alias("id"), F.col("rep").cast("long").alias("rep")).distinct(), "copies")
    nodes = sets_of.where("rep is not null").select(F.col("rep").cast("long").alias("id"), "n", "sketch")

    meetings, keys = _meetings(_keys(docs, k, num, den, hot), copies, hot)
    led = meetings.join(keys, "key")
    pair = lambda leader: led.where(F.col("id") != F.col(leader)).select(F.least("id", leader).alias("a"), F.greatest("id", leader).alias("b"))
    past = stored(pair("leader").union(pair("second")).distinct(), "stars")
    links = _linked(past, docs, nodes, k, num, den)
    comp = components(links)

    # Keys that the stars left with several components: small ones, then what is left of the hot ones.
    for settle in (lambda m: _across(m.where(F.col("n") <= hot)), lambda m: _across_hot(m.where(F.col("n") > hot), docs, k, num, den)):
        mixed = _mixed(meetings, keys, comp)
        pairs = settle(mixed)
        more = _linked(pairs.join(past, ["a", "b"], "left_anti"), docs, nodes, k, num, den)
        discard(mixed, pairs)
        if not more.isEmpty():
            both = stored(links.union(more), "links")
            discard(links, comp)
            links, comp = both, components(both)
        discard(more)
    known = sets_of.join(comp, F.col("rep") == F.col("id"), "left").select("n", "s1", "s2", F.coalesce("comp", "rep").alias("component_id"))
    known = stored(known, "class-components")
    discard(meetings, keys, past, links, comp, copies, sets_of)
    found = signed.join(known, ["n", "s1", "s2"], "left")
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """The rows of docs that stay: of each group the document with the smallest id."""
    gone = classes(docs.select("doc_id", "text"), k, num, den).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(bounded(stored(gone, "near-copies")), "doc_id", "left_anti").select(*docs.columns)


def op10_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
