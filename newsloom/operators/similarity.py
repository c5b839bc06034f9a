"""Similarity joins and the order-sensitive groupings built on them.

Set joins collapse equal token sets to classes first (copies never form pairs; rows
without tokens have no class and match nothing, see ``set_members``), then compare tiles of sets whose sizes
allow a pair. Common tokens are counted exactly inside a tile; candidates never become rows.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.text import jaccard
from newsloom.operators.ordinals import laid_out, ordinals
from newsloom.operators.store import discard, stored, stored_once

#: Set joins: sizes of a band differ by this factor at most; sets and tokens of a tile, tokens of what meets it in one group (and
#: groups a tile while tiles are few); tasks at most; what a common token counted in a list costs (times a cell of a matrix product).
BAND, TILE_SETS, TILE_TOKENS, MET_TOKENS, SPREAD, MEETINGS, COLUMN_COST = 2.0, 65_536, 8_000_000, 32_000_000, 4, 2000, 512
#: Tokens that a round of tiles may shuffle, or twice those of all sets.
ROUND_TOKENS = 500_000_000
#: Tokens that are numbered by a list, which reaches the driver: the most frequent ones, and those that share a hash with another.
FREQUENT, TWINS = 16_384, 16_000
#: Containment: cells of hashes in which the other tokens are counted (they reach the driver), tokens of a set that are looked for
#: in others at once, sets that look in one group.
CELLS, RAREST, SMALL_SETS = 1 << 21, 16, 200_000
#: Vector joins: rows that name cells at most (they reach the driver), vectors on a side of a tile.
PIVOTS, VECTOR_TILE = 64, 4096
#: Narrow rows that are broadcast at most.
BROADCAST_ROWS = 1_000_000
#: Rows of one component that a scan with replacement takes at once.
FOLD_ROWS = 2000


def set_classes(rows: DataFrame, block: str | None = None) -> DataFrame:
    """rows: id, tokens (and the block's column). One row a distinct set: rep, tokens, copies."""
    return set_members(rows, block)[0]


def set_members(rows: DataFrame, block: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """rows: id, tokens (and the block's column). The classes (see ``set_classes``), each row's (id, rep, n) and the ids without tokens.

    The rows are read and stored once and grouped by a digest; what is shuffled are digests, never tokens.
    """
    own = [block] if block else []
    n = F.greatest(F.coalesce(F.size("tokens"), F.lit(0)), F.lit(0))
    key = F.when(n > 0, F.sha2(F.to_json(F.struct(*own, "tokens")), 256))
    held = stored_once(rows.select("id", *own, "tokens", n.alias("n"), key.alias("_key"), F.monotonically_increasing_id().alias("_at")), "token-rows")
    some = held.where("n > 0")
    groups = some.groupBy("_key").agg(F.min(F.struct("id", "_at")).alias("first"), F.count(F.lit(1)).alias("copies"))
    many = groups.where("copies > 1").select("_key", F.col("first._at").alias("_first"), "copies")
    again = stored_once(some.select("_key", "_at").join(many, "_key").select("_at", F.when(F.col("_at") == F.col("_first"), F.col("copies")).alias("_copies")), "copies")
    again = F.broadcast(again) if again.count() <= BROADCAST_ROWS else again
    left = some.join(again.withColumn("_again", F.lit(True)), "_at", "left").where(F.col("_again").isNull() | F.col("_copies").isNotNull())
    classes = left.select("tokens", *own, F.col("id").alias("rep"), F.coalesce("_copies", F.lit(1).cast("long")).alias("copies"))
    members = some.select("_key", "id", "n").join(groups.select("_key", F.col("first.id").alias("rep")), "_key").select("id", "rep", "n")
    return classes, members, held.where("n = 0").select("id")


def _named(tokens: str) -> Column:
    """Tokens as 64-bit numbers."""
    return F.transform(tokens, lambda t: F.xxhash64(t))


class Numbered(NamedTuple):
    """Sets by number: rep, n, often (places of tokens in a list of frequent ones), rare (32-bit hashes of the others).

    Tokens that share a hash are in the list too, so numbers are the tokens' own. Only where there are more than ``TWINS`` of these
    (``clash``) they are not, and counts of common numbers are too great. ``listed``: how many sets hold each token of the list,
    ``others``: how many at most hold a token outside it, by its hash modulo ``CELLS`` (0: no second set does); both only if asked for.
    """

    sets: DataFrame
    clash: bool
    listed: np.ndarray
    others: np.ndarray


def numbered_sets(classes: DataFrame, block: str | None = None, rarity: bool = False) -> Numbered:
    """classes: rep, tokens (and the block). Sets without a block are left out."""
    own = [block] if block else []
    classes = classes.where(F.col(block).isNotNull()) if block else classes
    words = classes.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    words = stored_once(words.withColumn("h", F.shiftright(_named(F.array("token"))[0], 32)), "words")
    shared = words.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("h")
    twins = words.join(shared, "h").select("token", "df").limit(TWINS + 1).toArrow()
    clash = len(twins) > TWINS
    most = words.where("df > 1 and length(token) <= 64").orderBy(F.desc("df"), "token").limit(FREQUENT).select("token", "df").toArrow()
    both = pa.concat_tables([most] if clash else [most, twins])
    known = both.column("token").unique()
    listed, others = np.zeros(len(known), np.int64), np.zeros(CELLS if rarity else 0, np.int32)
    if rarity:
        df = both.column("df").to_numpy()
        listed[pc.index_in(both.column("token"), known).to_numpy()] = np.where(df > 1, df, 0)
        cells = words.where("df > 1").groupBy(F.pmod("h", F.lit(CELLS)).alias("cell")).agg(F.least(F.sum("df"), F.lit(2**31 - 1)).cast("int").alias("df")).toArrow()
        others[cells.column("cell").to_numpy()] = cells.column("df").to_numpy()
    discard(words)

    def number(batches):
        for b in batches:
            n = pc.list_value_length(b.column("tokens")).to_numpy().astype(np.int64)
            at = pc.index_in(b.column("tokens").flatten(), known)
            row, often = np.repeat(np.arange(len(n)), n), at.is_valid().to_numpy(zero_copy_only=False)
            h = b.column("h").flatten().to_numpy(zero_copy_only=False)[~often] >> 32
            lists = [at.drop_null().cast(pa.int16()), pa.array(h.astype(np.int32))]
            ends = [np.concatenate([[0], np.cumsum(np.bincount(row[k], minlength=len(n)))]) for k in (often, ~often)]
            lists = [pa.ListArray.from_arrays(pa.array(e, pa.int32()), v) for e, v in zip(ends, lists, strict=True)]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], *lists], names=[*kept, "often", "rare"])

    kept = ["rep", *own, "n"]
    sets = classes.select("rep", *own, F.size("tokens").alias("n"), "tokens", _named("tokens").alias("h"))
    fields = ", ".join(f"`{c}` {sets.schema[c].dataType.simpleString()}" for c in kept)
    return Numbered(stored_once(sets.mapInArrow(number, f"{fields}, often array<smallint>, rare array<int>"), "numbered-sets"), clash, listed, others)


def jaccard_pairs(classes: DataFrame, least: float, block: str | None = None, hot: int | None = None, numbers: Numbered | None = None) -> DataFrame:
    """classes: rep, tokens. Pairs a < b with Jaccard >= least > 0: a, b, similarity.

    Sets are dealt to tiles of one band of sizes (a factor of ``BAND``), of ``TILE_SETS`` sets and ``TILE_TOKENS`` tokens. The sets of its band
    and of those above it whose sizes allow a pair come to a tile in groups of about ``MET_TOKENS`` tokens; a group counts common
    tokens, and only pairs that are found become rows. Tiles meet in rounds: what a round shuffles (``ROUND_TOKENS``) is deleted
    before the next. What is shuffled is each set once a tile that it comes to, by number
    (some two bytes a token, see ``Numbered``; ``numbers``: of these classes, where they are known). Where numbers are not the
    tokens' own, counts are too great only, and the pairs are compared again by the tokens. ``hot``: see ``_Tile``.
    """
    own = [block] if block else []
    kind = classes.schema["rep"].dataType.simpleString()
    sets, clash, *_ = numbers or numbered_sets(classes, block)
    sets = sets.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(BAND)))).cast("long"))
    size, one = F.col("n").cast("long"), F.lit(1).cast("long")
    parts = F.ceil(F.greatest(F.count(one) / TILE_SETS, F.sum(size) / TILE_TOKENS))
    bands = stored(sets.groupBy(*own, "band").agg(parts.alias("parts"), F.sum(size).alias("held"), F.min("n").alias("least"), F.max("n").alias("most")), "bands")
    guests = bands.select(*own, *[F.col(c).alias(f"of_{c}") for c in ("band", "held", "least")])
    both = bands.join(guests, own) if own else bands.crossJoin(guests)
    both = both.where((F.col("of_band") == F.col("band")) | (F.col("of_band") > F.col("band")) & (F.col("most") >= F.col("of_least") * F.lit(least) - 1e-9))
    few = F.least(F.lit(SPREAD).cast("long"), F.ceil(F.lit(16 * SPREAD) / F.greatest(F.lit(bands.agg(F.coalesce(F.sum("parts"), F.lit(0))).first()[0]), one)))
    groups = F.greatest(few, F.ceil(F.sum("of_held") / MET_TOKENS))
    tiles = stored(both.join(both.groupBy(*own, "band").agg(groups.alias("groups")), [*own, "band"]), "tiles")
    own_band = F.col("band") == F.col("of_band")
    copied = F.when(own_band, F.col("parts") / 2 + F.col("groups")).otherwise(F.col("parts"))
    sums = tiles.agg(F.sum(F.when(own_band, F.col("parts") * F.col("groups"))), F.sum(F.col("of_held") * copied), F.sum(F.when(own_band, F.col("of_held")))).first()
    total, load, held = (x or 0 for x in sums)
    rounds = max(1, int(np.ceil(load / max(ROUND_TOKENS, 2 * held))))
    reach = tiles.groupBy(*own, F.col("of_band").alias("band")).agg(F.collect_list(F.struct(F.col("band").alias("at"), "parts", "groups")).alias("reach"), F.max(F.when(F.col("band") == F.col("of_band"), F.col("parts"))).alias("parts"))
    dealt = sets.join(F.broadcast(reach), [*own, "band"]).withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("parts")))
    upto = lambda n: F.filter(F.sequence(F.lit(0).cast("long"), n), lambda x: x < n)
    meet = lambda r, tile, group, side: F.struct(r["at"].alias("at"), tile.alias("tile"), group.alias("group"), side.alias("side"))
    turn = lambda r: F.pmod(F.xxhash64("rep", F.lit(1)), r["groups"])
    guest = lambda r, n: F.transform(upto(n), lambda t: meet(r, t, turn(r), F.lit(1)))
    home = lambda r: F.transform(upto(r["groups"]), lambda g: meet(r, F.col("tile"), g, F.when(g == turn(r), F.lit(2)).otherwise(F.lit(0))))
    places = F.flatten(F.transform("reach", lambda r: F.when(r["at"] == F.col("band"), F.concat(home(r), guest(r, F.col("tile")))).otherwise(guest(r, r["parts"]))))
    keys = [*own, "at", "tile", "group"]

    def compare(p: pa.Table) -> pa.Table:
        side, n = p.column("side").to_numpy(), p.column("n").to_numpy().astype(np.int64)
        lists = [_lists(p.column(c)) for c in ("often", "rare")]
        tile = _Tile(*_in_size_order(np.flatnonzero(side != 1), n), lists, least, hot, clash)
        found = [[], [], []]
        for to, v in zip(found, (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)), strict=True):
            to.append(v)
        for s in (1, 2):
            rows, sizes = _in_size_order(np.flatnonzero(side == s), n)
            for at in range(0, len(rows), 256):
                x, y, k = tile.common(rows[at : at + 256], sizes[at : at + 256], s == 2)
                cos = k / np.maximum(n[x] + n[y] - k, 1)
                keep = slice(None) if clash else cos >= least
                for to, v in zip(found, (x, y, cos), strict=True):
                    to.append(v[keep])
        x, y, cos = map(np.concatenate, found)
        rep = p.column("rep")
        return pa.table({"x": rep.take(pa.array(x)), "y": rep.take(pa.array(y)), "similarity": pa.array(cos, pa.float64())})

    def met(k: int) -> DataFrame:
        turn_of = lambda m: F.pmod(F.xxhash64(*own, m["at"], m["tile"], m["group"]), F.lit(rounds)) == k
        m = F.explode(places if rounds == 1 else F.filter(places, turn_of)).alias("_m")
        some = dealt.select("rep", *own, "n", "often", "rare", m).select("rep", *own, "n", "often", "rare", "_m.*")
        return some.repartition(int(min(max(total // rounds, 1), MEETINGS)), *keys).groupBy(*keys).applyInArrow(compare, f"x {kind}, y {kind}, similarity double")

    found = met(0) if rounds == 1 else stored_once(met(0), "met")
    for k in range(1, rounds):
        found = found.union(stored_once(met(k), "met"))
    pairs = found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "similarity")
    if not clash:
        return pairs
    s, t = (classes.select(F.col("rep").alias(x), F.col("tokens").alias(f"t{x}")) for x in "ab")
    return pairs.join(s, "a").join(t, "b").select("a", "b", jaccard(F.col("ta"), F.col("tb")).alias("similarity")).where(F.col("similarity") >= least)


def _lists(c: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values, starts and lengths of lists of numbers."""
    c = pa.concat_arrays(c.chunks) if isinstance(c, pa.ChunkedArray) else c
    at = c.offsets.to_numpy().astype(np.int64)
    return c.values.to_numpy(zero_copy_only=False), at[:-1], np.diff(at)


def _in_size_order(rows: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rows = rows[np.argsort(n[rows], kind="stable")]
    return rows, n[rows]


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


class _Tile:
    """Sets of a tile, in the order of their sizes, that others are compared with.

    Tokens of many sets are columns of a matrix product, others are counted along their lists of sets. A token is of
    many if the lists would cost more (``COLUMN_COST``), or if more than ``hot`` of the tile's sets hold it. The most frequent of the
    others, so few that sets which share no more than is usual stay under the bound, are bits: they are only
    counted for pairs that reach it if all that the smaller of both has are common.
    """

    def __init__(self, rows: np.ndarray, n: np.ndarray, lists: list, least: float, hot: int | None, clash: bool):
        self.rows, self.n, self.lists, self.least, self.clash = rows, n, lists, least, clash
        (often, at, size), (rare, rare_at, rare_size) = lists
        self.words = np.unique(rare[_runs(rare_at[rows], rare_size[rows])])
        self.first = FREQUENT + TWINS
        r, c = self.columns(rows)
        df = np.bincount(c, minlength=self.first + len(self.words))
        many = (df * df * COLUMN_COST > len(rows) ** 2) if hot is None else df > hot
        share = 0.0 if clash else max(2 * least / (1 + least) - 0.22, 0.0)
        rest = np.flatnonzero(~many & (df > 0))
        rest = rest[np.argsort(-df[rest], kind="stable")]
        rest = rest[np.cumsum(df[rest]) <= share * len(c)][:8192]
        bits = np.zeros(len(df), bool)
        bits[rest] = True
        self.kind = np.where(many, 0, np.where(bits, 1, 2)).astype(np.int8)
        self.place = np.where(many, np.cumsum(many), np.cumsum(bits)) - 1
        self.width = int(many.sum()), int(bits.sum())
        self.dense, self.bits, self.held = self.sides(r, c, len(rows))
        few = self.kind[c] == 2
        r, c = r[few].astype(np.int32), c[few]
        self.post = r[np.argsort(c, kind="stable")]
        self.size = np.where(self.kind == 2, df, 0)
        self.at = np.cumsum(self.size) - self.size

    def columns(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``rows`` and columns of the tokens that the tile has."""
        (often, at, size), (rare, rare_at, rare_size) = self.lists
        r = [np.repeat(np.arange(len(rows)), z[rows]) for z in (size, rare_size)]
        c, t = often[_runs(at[rows], size[rows])].astype(np.int64), rare[_runs(rare_at[rows], rare_size[rows])]
        w = np.minimum(np.searchsorted(self.words, t), max(len(self.words) - 1, 0))
        here = self.words[w] == t if len(self.words) else np.zeros(len(t), bool)
        return np.concatenate([r[0], r[1][here]]), np.concatenate([c, w[here] + self.first])

    def sides(self, r: np.ndarray, c: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A row's columns of the product, its bits and how many of these are set."""
        kind, place = self.kind[c], self.place[c]
        dense = np.zeros((rows, self.width[0]), np.float32)
        if self.clash:
            np.add.at(dense, (r[kind == 0], place[kind == 0]), np.float32(1))
        else:
            dense[r[kind == 0], place[kind == 0]] = 1
        bits = np.zeros((rows, -(-self.width[1] // 64)), np.uint64)
        b, p = r[kind == 1], place[kind == 1]
        np.bitwise_or.at(bits, (b, p // 64), np.uint64(1) << (p % 64).astype(np.uint64))
        return dense, bits, np.bincount(b, minlength=rows).astype(np.float32)

    def common(self, rows: np.ndarray, n: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of the rows (sizes n, ascending) with sets of the tile that may have Jaccard >= least, and how many tokens they share.

        ``same``: the rows are of the tile, each pair counts once.
        """
        low, high = int(np.searchsorted(self.n, self.least * n[0] - 1e-9)), int(np.searchsorted(self.n, n[-1] / self.least + 1e-9, side="right"))
        wide = high - low
        if wide <= 0:
            return (np.zeros(0, np.int64),) * 3
        r, c = self.columns(rows)
        dense, bits, held = self.sides(r, c, len(rows))
        k = dense @ self.dense[low:high].T
        few = self.kind[c] == 2
        r, c = r[few], c[few]
        size = self.size[c]
        order = np.argsort(r, kind="stable")
        r, c, size = r[order], c[order], size[order]
        ends = np.cumsum(size)
        a = 0
        while a < len(r):  # some millions of places in lists at once
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + 2_000_000, side="right")))
            top, last = int(r[a]), int(r[b - 1]) + 1
            col = self.post[_runs(self.at[c[a:b]], size[a:b])]
            cell = np.repeat((r[a:b] - top) * wide - low, size[a:b]) + col
            if low or high < len(self.n):
                cell = cell[(col >= low) & (col < high)]
            k[top:last] += np.bincount(cell, minlength=(last - top) * wide).reshape(last - top, wide)
            a = b
        need = ((self.least / (1 + self.least)) * (n[:, None] + self.n[None, low:high]) - 0.5).astype(np.float32)
        if self.width[1]:
            x, y = np.nonzero(k + np.minimum(held[:, None], self.held[None, low:high]) >= need)
            shared = np.concatenate([np.zeros(0, np.int64), *[np.bitwise_count(bits[x[i : i + 65_536]] & self.bits[low + y[i : i + 65_536]]).sum(1, dtype=np.int64) for i in range(0, len(x), 65_536)]])
            found = k[x, y].astype(np.int64) + shared
            keep = found >= need[x, y]
            x, y, found = x[keep], y[keep], found[keep]
        else:
            x, y = np.nonzero(k >= need)
            found = k[x, y].astype(np.int64)
        x, y = rows[x], self.rows[low + y]
        once = x < y if same else np.ones(len(x), bool)
        return x[once], y[once], found[once]


def containments(classes: DataFrame, block: str | None = None, numbers: Numbered | None = None) -> DataFrame:
    """classes: rep, tokens. Pairs a < b of which one set contains the other. ``numbers``: of these classes, with ``rarity``.

    A contained set's rarest tokens are in its container. Sets that have no token of their own bring their ``RAREST`` rarest ones as numbers,
    in groups of ``SMALL_SETS``; every group meets all sets, in parts of ``MET_TOKENS`` tokens, which look their tokens up among the group's
    rarest ones and then the others of those found. Candidates never become rows; what is left of sets with more tokens is compared by the tokens.
    """
    own = [block] if block else []
    sets, clash, listed, others = numbers or numbered_sets(classes, block, rarity=True)
    kind = classes.schema["rep"].dataType.simpleString()

    def coded(p: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, numbers (a list's places come first) and places in the list (or hashes)."""
        lists = [_lists(p.column(c)) for c in ("often", "rare")]
        rows = [np.repeat(np.arange(len(size)), size) for _, _, size in lists]
        often, rare = (v[_runs(at, size)].astype(np.int64) for v, at, size in lists)
        return np.concatenate(rows), np.concatenate([often, (rare & 0xFFFFFFFF) + (1 << 32)]), np.concatenate([listed[often], others[rare % len(others)]])

    def pick(batches):
        for b in batches:
            rows, codes, df = coded(b)
            order = np.lexsort((codes, df, rows))
            rows, codes, df = rows[order], codes[order], df[order]
            size = np.bincount(rows, minlength=b.num_rows)
            first = np.cumsum(size) - size
            some = np.flatnonzero(df[first] > 0)  # a set with a token of its own is in no other set
            few = np.minimum(size[some], RAREST)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(few)]), pa.int32()), pa.array(codes[_runs(first[some], few)]))
            kept = [b.column(c).take(pa.array(some)) for c in ("rep", *own, "n")]
            yield pa.RecordBatch.from_arrays([*kept, lists], names=["rep", *own, "n", "codes"])

    fields = ", ".join(f"`{c}` {sets.schema[c].dataType.simpleString()}" for c in ("rep", *own, "n"))
    small = stored(sets.mapInArrow(pick, f"{fields}, codes array<long>"), "rarest")
    held = sets.agg(F.coalesce(F.sum(F.col("n").cast("long")), F.lit(0))).first()[0]
    groups, parts = max(1, -(-small.count() // SMALL_SETS)), max(1, -(-held // MET_TOKENS), min(4 * SPREAD, held // 100_000))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    deal = lambda n: F.pmod(F.xxhash64("rep", F.lit(2)), F.lit(n).cast("long"))

    def look(s: pa.Table, p: pa.Table) -> pa.Table:
        codes, at, size = _lists(s.column("codes"))
        n, most = (t.column("n").to_numpy() for t in (s, p))
        blocks = pa.chunked_array([*s.column(block).chunks, *p.column(block).chunks]).unique() if block else None
        of = [pc.index_in(t.column(block), blocks).to_numpy() if block else np.zeros(len(t), np.int64) for t in (s, p)]
        order = np.argsort(codes[at], kind="stable")
        keys, start, many = np.unique(codes[at][order], return_index=True, return_counts=True)
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        ends = np.cumsum(most.astype(np.int64))
        top = 0
        while top < len(p) and len(keys):  # sets of some hundred thousand tokens at once
            last = max(top + 1, int(np.searchsorted(ends, (ends[top - 1] if top else 0) + 250_000, side="right")))
            r, c, _ = coded(p.slice(top, last - top))
            has = np.unique((r << 34) | c) if clash else np.sort((r << 34) | c)
            r, c = has >> 34, has & ((1 << 34) - 1)
            k = np.minimum(np.searchsorted(keys, c), len(keys) - 1)
            r, k = r[keys[k] == c], k[keys[k] == c]
            upto = np.cumsum(many[k])
            a = 0
            while a < len(r):  # some millions of candidates at once
                b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + 2_000_000, side="right")))
                i, j = order[_runs(start[k[a:b]], many[k[a:b]])], np.repeat(r[a:b], many[k[a:b]])
                keep = (n[i] < most[top + j]) & (of[0][i] == of[1][top + j])
                for x in range(1, RAREST + 1):
                    i, j = i[keep], j[keep]
                    keep = size[i] <= x
                    todo = np.flatnonzero(~keep)
                    if not len(todo):
                        break
                    token = (j[todo] << 34) | codes[at[i[todo]] + x]
                    keep[todo] = has[np.minimum(np.searchsorted(has, token), len(has) - 1)] == token
                left.append(i)
                right.append(top + j)
                a = b
            top = last
        i, j = np.concatenate(left), np.concatenate(right)
        return pa.table({"s": s.column("rep").take(pa.array(i)), "l": p.column("rep").take(pa.array(j)), "more": pa.array(n[i] > RAREST)})

    keys = ["_group", "_part"]
    x = small.withColumn("_group", deal(groups)).withColumn("_part", each(parts))
    y = sets.toDF(*sets.columns).withColumn("_part", deal(parts)).withColumn("_group", each(groups))
    x, y = (df.repartition(int(min(groups * parts, MEETINGS)), *keys).groupBy(*keys) for df in (x, y))
    found = stored_once(x.cogroup(y).applyInArrow(look, f"s {kind}, l {kind}, more boolean"), "may-contain")
    open_ = found if clash else found.where("more")
    few = F.broadcast if open_.count() <= BROADCAST_ROWS else lambda df: df
    s = classes.select(F.col("rep").alias("s"), F.col("tokens").alias("ts")).join(few(open_.select("s", "l")), "s")
    t = classes.select(F.col("rep").alias("l"), F.col("tokens").alias("tl")).join(few(open_.select("l").distinct()), "l", "left_semi")
    inside = s.join(t, "l").where(F.size(F.array_except("ts", "tl")) == 0).select("s", "l")
    inside = inside if clash else inside.union(found.where("not more").select("s", "l"))
    return inside.select(F.least("s", "l").alias("a"), F.greatest("s", "l").alias("b"))


def far_from(rows: DataFrame, few: DataFrame, over: float) -> DataFrame:
    """rows: lang, tokens. Those near to none of a few sets (lang, tokens; they reach the driver) of their language: Jaccard > over or containment."""
    held = [(r.lang, r.tokens) for r in few.where(F.size("tokens") > 0).select("lang", "tokens").collect()]
    if not held:
        return rows
    words = sorted({t for _, ts in held for t in ts})
    place = {t: k for k, t in enumerate(words)}
    has = np.zeros((len(words) + 1, len(held)), np.float32)
    for k, (_, ts) in enumerate(held):
        has[[place[t] for t in ts], k] = 1
    size, langs = has.sum(0), [lang for lang, _ in held]

    def pick(batches):
        for b in batches:
            tokens = b.column("tokens")
            n = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
            at = pc.fill_null(pc.index_in(tokens.flatten(), pa.array(words, pa.string())), len(words)).to_numpy(zero_copy_only=False)
            known = at < len(words)
            row = np.repeat(np.arange(len(n)), n)[known]
            k = np.zeros((len(n), len(held)), np.float32)
            np.add.at(k, row, has[at[known]])
            same = np.array([[x is not None and x == y for y in langs] for x in b.column("lang").to_pylist()], bool).reshape(k.shape)
            near = (k / np.maximum(n[:, None] + size[None, :] - k, 1) > over) | (k == n[:, None]) | (k == size[None, :])
            yield b.filter(pa.array(~((near & same).any(1) & (n > 0))))

    return rows.mapInArrow(pick, rows.schema)


def cosine_matches(queries: DataFrame, rows: DataFrame, least: float, on: list[str], when: Column | None = None) -> DataFrame:
    """A stated query set against all rows of its block: q, id, similarity >= least and the other columns but the vectors.

    queries: q, qv and the block's columns; rows: id, v and the same columns. A block's queries and rows are dealt to tiles by
    a hash; two tiles meet in a matrix product, and the cosines of what it finds are summed in the vectors' order.
    """
    counts = [df.groupBy(*on).agg(F.ceil(F.count(F.lit(1)) / tile).alias(c)) for df, c, tile in ((queries, "_i", VECTOR_TILE // 2), (rows, "_j", VECTOR_TILE))]
    blocks = stored(counts[0].join(counts[1], on), "blocks")
    groups = blocks.agg(F.coalesce(F.sum(F.col("_i") * F.col("_j")), F.lit(0))).first()[0]
    keys = [*on, "_q", "_r"]
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(c) - 1))
    x = queries.join(blocks, on).withColumn("_q", F.pmod(F.xxhash64("q"), F.col("_i"))).withColumn("_r", every("_j")).drop("_i", "_j")
    y = rows.join(blocks, on).withColumn("_r", F.pmod(F.xxhash64("id"), F.col("_j"))).withColumn("_q", every("_i")).drop("_i", "_j")
    own, others = [c for c in queries.columns if c != "qv"], [c for c in rows.columns if c != "v" and c not in on]
    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for df, cs in ((queries, own), (rows, others)) for c in cs)

    def match(p: pa.Table, r: pa.Table) -> pa.Table:
        u, w = _vectors(p.column("qv")), _vectors(r.column("v"))
        width = max(u.shape[1], w.shape[1])
        u, w = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (u, w))
        norm = [np.sqrt(_in_order(m * m)) for m in (u, w)]
        left, right, cos = [], [], []
        for at in range(0, len(u), 256):
            both = norm[0][at : at + 256, None] * norm[1][None, :]
            with np.errstate(invalid="ignore"):
                c = np.divide(u[at : at + 256] @ w.T, both, out=np.zeros_like(both), where=both != 0)
            i, j = np.nonzero((c >= least - 1e-9) | np.isnan(c))
            for k in range(0, len(i), 65_536):
                g, h = i[k : k + 65_536] + at, j[k : k + 65_536]
                both = norm[0][g] * norm[1][h]
                exact = np.divide(_in_order(u[g] * w[h]), both, out=np.zeros_like(both), where=both != 0)
                keep = (exact >= least) | np.isnan(exact)
                for to, v in zip((left, right, cos), (g, h, exact), strict=True):
                    to.append(v[keep])
        left, right, cos = (np.concatenate([np.zeros(0, k), *z]) for z, k in ((left, np.int64), (right, np.int64), (cos, float)))
        a, b = p.select(own).take(pa.array(left)), r.select(others).take(pa.array(right))
        return pa.table([*a.columns, *b.columns, pa.array(cos, pa.float64())], names=[*own, *others, "similarity"])

    # toDF: queries and rows may come of one table
    x, y = (df.toDF(*df.columns).repartition(int(min(max(groups, 1), MEETINGS)), *keys).groupBy(*keys) for df in (x, y))
    found = x.cogroup(y).applyInArrow(match, f"{fields}, similarity double")
    return found if when is None else found.where(when)


def _in_order(m: np.ndarray) -> np.ndarray:
    """Sums of rows, added from the left."""
    return np.cumsum(m, 1)[:, -1] if m.shape[1] else np.zeros(len(m))


def _vectors(v: pa.ChunkedArray) -> np.ndarray:
    """Rows of numbers; a missing vector and one with a missing number are zero."""
    v = v.combine_chunks()
    v = v.chunk(0) if isinstance(v, pa.ChunkedArray) and v.num_chunks == 1 else v
    if not len(v):
        return np.zeros((0, 0))
    size = pc.fill_null(pc.list_value_length(v), 0).to_numpy(zero_copy_only=False)
    flat = v.flatten()
    out = np.zeros((len(v), int(size.max())))
    row = np.repeat(np.arange(len(v)), size)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False)
    out[row[pc.is_null(flat).to_numpy(zero_copy_only=False)]] = 0
    return out


def _unit(v: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows as vectors of length one (zero, missing and NaN values count as zero)."""
    out = np.stack([np.pad(np.nan_to_num(np.asarray(x, float))[:width], (0, max(0, width - len(x)))) for x in v.to_pylist()]) if len(v) else np.zeros((0, width))
    norm = np.sqrt((out * out).sum(1, keepdims=True))
    return np.divide(out, norm, out=np.zeros_like(out), where=norm > 0)


def cosine_join(rows: DataFrame, least: float, emit, schema: str, pivots: int = PIVOTS, tile: int = VECTOR_TILE) -> DataFrame:
    """All pairs of rows (each once) with cosine >= least > 0, handed to ``emit`` where they are found.

    rows: id, v and other columns. emit(left, right, cosines): two tables of the rows without v and an
    array; it returns a table of ``schema`` (pairs, or counts of pairs).

    Cells: a row's home is the nearest of ``pivots`` rows in angle. With t the angle of ``least``, the partners of a row
    x at home in q are nearer to q than to x's own pivot, so q's angle to x exceeds x's own by 2t at most
    and is at most q's radius + t: x visits the cells of larger number of which both hold. Pairs of one
    cell, and of its visitors with its own, meet in tiles. If visits would copy rows more often than tiles of
    the whole do (vectors without clusters), all rows have one home. Nothing is lost either way.
    """
    some = rows.where(F.col("v").isNotNull()).withColumn("v", F.transform("v", lambda x: x.cast("double")))
    others = [c for c in rows.columns if c != "v"]
    fields = ", ".join(f"`{c}` {some.schema[c].dataType.simpleString()}" for c in others)
    size = some.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width")).first()
    n, width = size["n"], max(1, size["width"] or 1)
    centre = _unit(some.orderBy(F.xxhash64("id"), "id").limit(pivots).select("v").toArrow().column("v"), width) if n > tile else np.zeros((0, width))
    t = float(np.arccos(np.clip(least, -1, 1))) + 1e-9

    def angles(v: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(v @ centre.T, -1, 1))

    def settle(batches):
        for b in batches:
            u = _unit(b.column("v"), width)
            far = angles(u) if len(centre) else np.zeros((len(u), 1))
            home = far.argmin(1)
            own = far[np.arange(len(u)), home]
            visits = ((far - own[:, None] <= 2 * t) & (np.arange(far.shape[1]) > home[:, None])).sum(1)
            cols = [pa.array(home, pa.int32()), pa.array(own, pa.float64()), pa.array(visits, pa.int64())]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in others], b.column("v"), *cols], names=[*others, "v", "_home", "_far", "_visits"])

    at_home = stored(some.select(*others, "v").mapInArrow(settle, f"{fields}, v array<double>, _home int, _far double, _visits long"), "cells")
    cells = {r["_home"]: r for r in at_home.groupBy("_home").agg(F.max("_far").alias("r"), F.count(F.lit(1)).alias("n"), F.sum("_visits").alias("v")).collect()}  # a row a pivot
    within = sum(r["n"] * -(-r["n"] // tile) + r["v"] for r in cells.values())
    pruned = len(centre) > 0 and within < n * -(-n // tile)
    radius = np.array([cells[k]["r"] if k in cells else -10.0 for k in range(len(centre))])

    def visit(batches):
        for b in batches:
            if pruned:
                far, home, own = angles(_unit(b.column("v"), width)), b.column("_home").to_numpy(), b.column("_far").to_numpy()
                row, cell = np.nonzero((far - own[:, None] <= 2 * t) & (far <= radius + t) & (np.arange(far.shape[1]) > home[:, None]))
            else:
                home, row, cell = np.zeros(b.num_rows, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
            every = pa.array(np.concatenate([np.arange(b.num_rows), row]))
            cols = [pa.array(np.concatenate([home, cell]), pa.int32()), pa.array(np.concatenate([np.zeros(b.num_rows, bool), np.ones(len(row), bool)]))]
            yield pa.RecordBatch.from_arrays([*[b.column(c).take(every) for c in [*others, "v"]], *cols], names=[*others, "v", "_cell", "_guest"])

    placed = at_home.mapInArrow(visit, f"{fields}, v array<double>, _cell int, _guest boolean")
    counts = placed.groupBy("_cell").agg(F.ceil(F.count_if(~F.col("_guest")) / tile).alias("_owns"), F.ceil(F.count_if("_guest") / tile).alias("_guests"))
    dealt = placed.join(F.broadcast(counts), "_cell").withColumn("_tile", F.pmod(F.xxhash64("id"), F.when(F.col("_guest"), F.col("_guests")).otherwise(F.col("_owns"))))
    upto = lambda c: F.filter(F.sequence(F.lit(0).cast("bigint"), F.col(c)), lambda x: x < F.col(c))
    meet = lambda kind, i, j: F.struct(F.lit(kind).alias("_kind"), i.alias("_i"), j.alias("_j"))
    own = F.concat(F.transform(upto("_owns"), lambda o: meet(0, F.least("_tile", o), F.greatest("_tile", o))), F.transform(upto("_guests"), lambda o: meet(1, o, F.col("_tile"))))
    guest = F.transform(upto("_owns"), lambda o: meet(1, F.col("_tile"), o))
    met = dealt.withColumn("_m", F.explode(F.when(F.col("_guest"), guest).otherwise(own))).select(*others, "v", "_cell", "_guest", "_tile", "_m.*")

    def match(p: pa.Table) -> pa.Table:
        u, g, tiles = _unit(p.column("v"), width), p.column("_guest").to_numpy(), p.column("_tile").to_numpy()
        kind, i, j = (p.column(c)[0].as_py() for c in ("_kind", "_i", "_j"))
        a, b = (np.flatnonzero(g), np.flatnonzero(~g)) if kind else (np.flatnonzero(tiles == i), np.flatnonzero(tiles == j))
        left, right, cos = [], [], []
        for at in range(0, len(a), 512):  # some megabytes of products at once
            c = u[a[at : at + 512]] @ u[b].T
            x, y = np.nonzero(c >= least)
            once = (a[at : at + 512][x] < b[y]) | bool(kind) | (i != j)
            left.append(a[at : at + 512][x[once]])
            right.append(b[y[once]])
            cos.append(c[x, y][once])
        left, right, cos = (np.concatenate([np.zeros(0, k), *z]) for z, k in ((left, np.int64), (right, np.int64), (cos, float)))
        bare = p.select(others)
        return emit(bare.take(pa.array(left)), bare.take(pa.array(right)), cos)

    return met.groupBy("_cell", "_kind", "_i", "_j").applyInArrow(match, schema)


def cosine_pairs(rows: DataFrame, least: float, block: str | None = None, **bounds: int) -> DataFrame:
    """rows: id, v (and the block). Pairs a < b of different ids with cosine >= least: a, b, similarity."""

    def emit(x: pa.Table, y: pa.Table, cos: np.ndarray) -> pa.Table:
        i, j = x.column("id"), y.column("id")
        keep = pc.not_equal(i, j)
        if block:
            keep = pc.and_(keep, pc.fill_null(pc.equal(x.column(block), y.column(block)), False))
        return pa.table({"a": pc.if_else(pc.less(i, j), i, j), "b": pc.if_else(pc.less(i, j), j, i), "similarity": pa.array(cos, pa.float64())}).filter(keep)

    kind = rows.schema["id"].dataType.simpleString()
    return cosine_join(rows.select("id", "v", *([block] if block else [])), least, emit, f"a {kind}, b {kind}, similarity double", **bounds)


def pair_counts(rows: DataFrame, least: float, block: str | None = None, **bounds: int) -> DataFrame:
    """All pairs (ids differ, each pair once) with cosine >= least, by class: class, n.

    rows: id, v, day, week (whole numbers or null) and, if pairs must share it, the block; with ``at`` (a number that orders
    arrivals) and ``done`` (consumed by the report of its own day) the earlier row of a pair may be out of the later one's
    sight. A pair is cross-week, else ``analysed`` if so, else same-day or same-week (as are pairs without a day). Pairs
    are counted where they are found and never become rows.
    """
    kinds = ("cross-week", "analysed", "same-day", "same-week")

    def emit(x: pa.Table, y: pa.Table, cos: np.ndarray) -> pa.Table:
        of = lambda p, c: pc.fill_null(p.column(c).cast(pa.int64()), -(10**9)).to_numpy()
        keep = x.column("id").to_numpy() != y.column("id").to_numpy()
        if block:
            keep &= pc.fill_null(pc.equal(x.column(block), y.column(block)), False).to_numpy(zero_copy_only=False)
        known = (of(x, "day") > -(10**9)) & (of(y, "day") > -(10**9))
        cross = known & (of(x, "week") != of(y, "week"))
        first, gone = of(x, "at") < of(y, "at"), [pc.fill_null(p.column("done"), False).to_numpy(zero_copy_only=False) for p in (x, y)]
        done = ~cross & (of(x, "at") != of(y, "at")) & np.where(first, *gone)
        same = known & ~cross & ~done & (of(x, "day") == of(y, "day"))
        return pa.table({"class": kinds, "n": [int((keep & k).sum()) for k in (cross, done, same, ~cross & ~done & ~same)]})

    rows = rows if "done" in rows.columns else rows.withColumn("at", F.lit(0).cast("long")).withColumn("done", F.lit(False))
    parts = cosine_join(rows.select("id", "v", "day", "week", "at", "done", *([block] if block else [])), least, emit, "class string, n long", **bounds)
    return parts.groupBy("class").agg(F.sum("n").alias("n")).where("n > 0")


def close_pairs(rows: DataFrame, least: float, block: str, gap: int, tile: int = 2000) -> DataFrame:
    """rows: id, v, t (a number) and the block. Pairs a < b of a block with |t - t'| < gap and cosine >= least.

    Rows are cut by t into bands of ``gap`` and by a hash of the id into tiles; a pair lies
    in one band or in two neighbours. Every two tiles that may hold one meet in a matrix
    product, and only pairs found become rows.
    """
    rows = rows.where(F.col("v").isNotNull() & F.col("t").isNotNull()).select("id", block, "t", F.transform("v", lambda x: x.cast("double")).alias("v"), F.floor(F.col("t") / gap).alias("band"))
    tiles = rows.groupBy(block, "band").agg(F.ceil(F.count(F.lit(1)) / tile).alias("tiles"))
    ahead = tiles.select(block, (F.col("band") - 1).alias("band"), F.col("tiles").alias("tiles_ahead"))
    before = tiles.select(block, (F.col("band") + 1).alias("band"), F.col("tiles").alias("tiles_before"))
    r = rows.join(tiles, [block, "band"]).join(ahead, [block, "band"], "left").join(before, [block, "band"], "left").withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")))
    every = lambda n: F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)
    nothing = F.array().cast("array<bigint>")
    # Side 0 owns the meeting (band, tile) x (band or the next, tile).
    meet = lambda side, band, i, j, step: F.struct(F.lit(side).alias("side"), band.alias("at"), i.alias("i"), j.alias("j"), F.lit(step).alias("step"))
    own = F.transform(every("tiles"), lambda o: meet(0, F.col("band"), F.col("tile"), o, 0))
    other = F.transform(every("tiles"), lambda o: meet(1, F.col("band"), o, F.col("tile"), 0))
    first = F.transform(F.when(F.col("tiles_ahead").isNotNull(), every("tiles_ahead")).otherwise(nothing), lambda o: meet(0, F.col("band"), F.col("tile"), o, 1))
    second = F.transform(F.when(F.col("tiles_before").isNotNull(), every("tiles_before")).otherwise(nothing), lambda o: meet(1, F.col("band") - 1, o, F.col("tile"), 1))
    dealt = r.select("id", block, "t", "v", F.explode(F.concat(own, other, first, second)).alias("m")).select("id", block, "t", "v", "m.*").where("step = 1 or i <= j")

    def match(p: pd.DataFrame) -> pd.DataFrame:
        x, y = (p[p["side"] == s] for s in (0, 1))
        if not len(x) or not len(y):
            return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64"), "similarity": pd.Series(dtype="float64")})
        width = max(map(len, p["v"]))
        u, w = (np.stack([np.pad(np.nan_to_num(np.asarray(z, float)), (0, width - len(z))) for z in side["v"]]) for side in (x, y))
        both = np.sqrt((u * u).sum(1))[:, None] * np.sqrt((w * w).sum(1))[None, :]
        cos = np.divide(u @ w.T, both, out=np.zeros_like(both), where=both > 0)
        k, n = x["id"].to_numpy()[:, None], y["id"].to_numpy()[None, :]
        near = (cos >= least) & (np.abs(x["t"].to_numpy()[:, None] - y["t"].to_numpy()[None, :]) < gap)
        once = (k != n) if p["step"].iloc[0] or p["i"].iloc[0] != p["j"].iloc[0] else (k < n)
        i, j = np.nonzero(near & once)
        k, n = k[i, 0], n[0, j]
        return pd.DataFrame({"a": np.minimum(k, n), "b": np.maximum(k, n), "similarity": cos[i, j]})

    return dealt.groupBy(block, "at", "step", "i", "j").applyInPandas(match, "a long, b long, similarity double")


def vector_dedup(candidates: DataFrame, held: DataFrame, seen: float, near: float, block: str | None = None) -> DataFrame:
    """candidates: id, v, n (text length); held: id, v; both with the block, if pairs must share it. id, last.

    A candidate with cosine >= seen to a held row goes. Of the others a scan by id keeps
    slots: one with cosine >= near to a slot's row takes the slot if its text is longer, else it goes.
    Rows without a vector match nothing and come last.
    """
    own = [block] if block else []
    some = candidates.where(F.col("v").isNotNull())
    both = some.select(F.struct(F.lit(0).alias("side"), "id").alias("id"), "v", *own).union(held.where(F.col("v").isNotNull()).select(F.struct(F.lit(1).alias("side"), "id").alias("id"), "v", *own))

    def emit(x: pa.Table, y: pa.Table, cos: np.ndarray) -> pa.Table:
        sides = [pc.struct_field(p.column("id"), "side").combine_chunks() for p in (x, y)]
        ids = [pc.struct_field(p.column("id"), "id").combine_chunks() for p in (x, y)]
        keep = pc.not_equal(*sides)
        if block:
            keep = pc.and_(keep, pc.fill_null(pc.equal(x.column(block), y.column(block)), False))
        return pa.table({"id": pc.if_else(pc.equal(sides[0], 0), *ids).filter(keep)})

    kind = candidates.schema["id"].dataType.simpleString()
    hits = cosine_join(both, seen, emit, f"id {kind}").distinct()
    left = stored(some.join(hits, "id", "left_anti"), "unseen")
    pairs = cosine_pairs(left.select("id", "v", *own), near, block)
    edges = stored(pairs.select("a", "b"), "edges")
    kept = fold_slots(left.select("id", F.col("id").alias("cls"), "n"), edges).select("id")
    return kept.withColumn("last", F.lit(False)).union(candidates.where(F.col("v").isNull()).select("id", F.lit(True)))


def time_band(df: DataFrame, ts: str, hours: int = 24, spread: bool = False) -> DataFrame:
    """Adds ``band``, for equi-joins of rows within ``hours``: the spread side has the
    neighbouring bands too. Exact distances are tested after the join."""
    band = F.floor(F.unix_timestamp(F.col(ts).cast("timestamp")) / (3600 * hours))
    return df.withColumn("band", F.explode(F.array(band - 1, band, band + 1)) if spread else band)


def keep_first_greedy(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Scan in the order of id, keep a node unless a kept earlier one is its neighbour.

    nodes: id; edges: a < b. The first maximal independent set: in every round a node
    whose earlier neighbours are all dropped is kept, and the later neighbours of kept
    nodes are dropped. Rounds are tables in the shared folder; they end when none is open.
    """
    state = stored(nodes.select("id").join(edges.select(F.col("b").alias("id")).distinct().withColumn("open", F.lit(True)), "id", "left").select("id", F.when(F.col("open"), "open").otherwise("kept").alias("state")), "greedy")
    while not state.where("state = 'open'").isEmpty():
        seen = edges.join(state.select(F.col("id").alias("a"), F.col("state").alias("sa")), "a")
        by = seen.groupBy("b").agg(F.max((F.col("sa") == "kept").cast("int")).alias("hit"), F.max((F.col("sa") == "open").cast("int")).alias("wait"))
        new = F.when(F.col("state") != "open", F.col("state")).when(F.col("hit") == 1, "dropped").when(F.col("wait") == 0, "kept").otherwise("open")
        after = stored(state.join(by, F.col("id") == F.col("b"), "left").select("id", new.alias("state")), "greedy")
        discard(state)
        state = after
    return state


def first_reachable(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """id, first: the smallest id that a node reaches by going to ever earlier neighbours (edges: a < b).

    This is the bucket of a scan in which a row joins the first bucket with a neighbour in
    it and else opens one: a bucket is named by the row that opened it, and the first of
    several is the one opened earliest. Rounds take the neighbours' names and then the
    name's name; they end when no name changes.
    """
    state = stored(nodes.select("id", F.col("id").alias("first"), F.lit(True).alias("moved")), "buckets")
    while not state.where("moved").isEmpty():
        near = edges.join(state.select(F.col("id").alias("a"), "first"), "a").groupBy("b").agg(F.min("first").alias("near"))
        low = stored(state.join(near, F.col("id") == F.col("b"), "left").select("id", F.col("first").alias("was"), F.least("first", "near").alias("first")), "buckets")
        up = low.select(F.col("id").alias("up"), F.col("first").alias("top"))
        after = stored(low.join(up, F.col("first") == F.col("up")).select("id", F.least("first", "top").alias("first"), (F.least("first", "top") != F.col("was")).alias("moved")), "buckets")
        discard(state, low)
        state = after
    return state.select("id", "first")


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b. Returns id, comp: the smallest id of each linked id's component.

    Every round takes the smallest label among the neighbours and then the label of
    the label, so a path of n links needs about log n rounds. Labels only fall: the
    rounds end when their sum stays the same. Each round is a table in the shared
    folder; only that sum reaches the driver.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    label = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("comp")), "labels")
    total = lambda t: t.agg(F.sum(F.col("comp").cast("decimal(38,0)"))).first()[0]
    before, now = None, total(label)
    while before != now:
        near = both.join(label.select(F.col("id").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("m"))
        low = stored(label.join(near, F.col("id") == F.col("a")).select("id", F.least("comp", "m").alias("comp")), "labels")
        up = low.select(F.col("id").alias("up"), F.col("comp").alias("top"))
        discard(label)
        label = stored(low.join(up, F.col("comp") == F.col("up")).select("id", F.least("comp", "top").alias("comp")), "labels")
        discard(low)
        before, now = now, total(label)
    discard(both)
    return label


def fold_slots(rows: DataFrame, edges: DataFrame, limit: int = FOLD_ROWS) -> DataFrame:
    """The scan with replacement: slot (the id that opened it), id (what holds it in the end).

    rows: id, cls, n; edges: a, b (classes whose rows are near; rows of one class are near each
    other). In the order of id a row takes the earliest slot held by a near row if its n is
    greater, is dropped if it is not, and opens a slot where no near row holds one.

    What a row meets are slots of its component, so components go on side by side, many small ones in a group; a component of more than
    ``limit`` rows goes in blocks of its order: a block's group holds its rows, the slots that they
    are near to and the links among these, and leaves the slots it changed in a table for the next one. Rounds:
    rows of the largest component / limit.
    """
    both = stored(edges.select("a", "b").where("a <> b").union(edges.where("a <> b").select("b", "a")).distinct(), "fold-edges")
    comp = stored(rows.select(F.col("cls").alias("id")).distinct().join(components(both), "id", "left").select(F.col("id").alias("cls"), F.coalesce("comp", "id").alias("comp")), "fold-components")
    placed = laid_out(rows.join(comp, "cls").select("comp", "id", "cls", "n"), ["comp", "id"], "fold-rows")
    placed = stored(ordinals(placed, ["comp"]).select("comp", "id", "cls", "n", F.floor((F.col("nth") - 1) / limit).alias("block")), "fold-blocks")
    blocks = (placed.agg(F.max("block")).first()[0] if not placed.isEmpty() else -1) + 1
    slots = stored(placed.where("false").select("comp", F.col("id").alias("slot"), "id", "cls", "n"), "slots")
    schema = slots.schema

    def fold(new: pd.DataFrame, links: pd.DataFrame) -> pd.DataFrame:
        near: dict[int, list[int]] = {}
        for c, d in zip(links["c"], links["d"], strict=True):
            near.setdefault(c, []).append(d)
        held: dict[int, list] = {}  # slot: id, cls, n
        of: dict[int, int] = {}  # slot: its component
        at: dict[int, set[int]] = {}  # class: its slots
        old = new[new["block"] < 0]
        for comp, slot, i, c, n in zip(old["comp"], old["slot"], old["id"], old["cls"], old["n"], strict=True):
            held[slot], of[slot] = [i, c, n], comp
            at.setdefault(c, set()).add(slot)
        fresh = new[new["block"] >= 0].sort_values("id")
        changed: set[int] = set()
        for comp, i, c, n in zip(fresh["comp"], fresh["id"], fresh["cls"], fresh["n"], strict=True):
            met = [s for d in (c, *near.get(c, ())) for s in at.get(d, ())]
            slot = min(met) if met else i
            if met and n <= held[slot][2]:
                continue
            if met:
                at[held[slot][1]].discard(slot)
            held[slot], of[slot] = [i, c, n], comp
            at.setdefault(c, set()).add(slot)
            changed.add(slot)
        return pd.DataFrame([(of[s], s, *held[s]) for s in sorted(changed)], columns=["comp", "slot", "id", "cls", "n"])

    for k in range(blocks):
        now = placed.where(F.col("block") == k)
        groups = max(1, -(-now.count() // limit))
        dealt = lambda df, n=groups: df.withColumn("_group", F.pmod(F.xxhash64("comp"), F.lit(n).cast("long"))).repartition(min(n, MEETINGS), "_group").groupBy("_group")
        here = now.select("comp", F.col("cls").alias("c")).distinct()
        links = stored(here.join(both.select(F.col("a").alias("c"), F.col("b").alias("d")), "c"), "fold-links")
        wanted = links.select("comp", F.col("d").alias("cls")).union(here.select("comp", "c")).distinct()
        old = stored(slots.join(wanted, ["comp", "cls"], "left_semi").select("comp", "slot", "id", "cls", "n", F.lit(-1).cast("long").alias("block")), "fold-slots")
        alive = old.select(F.col("cls").alias("d")).union(here.select("c")).distinct()
        own = now.select("comp", F.col("id").alias("slot"), "id", "cls", "n", "block").unionByName(old)
        changed = stored_once(dealt(own).cogroup(dealt(links.join(alive, "d", "left_semi").select("comp", "c", "d"))).applyInPandas(fold, schema), "fold-changed")
        after = stored(slots.join(changed.select("slot"), "slot", "left_anti").select(*schema.names).unionByName(changed), "slots")
        discard(slots, links, old, changed)
        slots = after
    discard(both, comp, placed)
    return slots.select("slot", "id")


def best_match(pairs: DataFrame, query: str, order: list[Column]) -> DataFrame:
    """One row a query: the first in the order given."""
    nth = F.row_number().over(Window.partitionBy(query).orderBy(*order))
    return pairs.withColumn("_nth", nth).where("_nth = 1").drop("_nth")
