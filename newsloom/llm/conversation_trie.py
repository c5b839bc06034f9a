"""Prefix trie of conversations, totalled by leaf-peeling message passing.

Conversations that start with the same turns share trie nodes. ``trie`` returns one row per
node with what its subtree holds.

* A node is named by its depth and the parity (XOR) of 128-bit hashes of (place, role, text)
  over its turns, so prefixes come from running values over range partitions
  (``operators.ordinals``): no conversation is gathered in one task, however long.
* Every node belongs to the member with the largest hashed id. The nodes of one owner follow
  each other down its conversation, so they form a *path*, and as the order of owners is random,
  a walk from any leaf to the root changes paths some log(members) times only.
* Message passing: each path holds a counter of the child paths that have not reported. Those at
  zero are peeled: they send leaves and tokens of their subtrees to the node that they hang from,
  whose path counts down. Each round is a grouping that is summed before its shuffle; finished
  paths leave the table. When only the root's path is left, sums from below along each path give
  every node's totals. Peeling paths in place of single leaves saves a round per turn.
* ``ends_sha256`` hashes ids that may be a third of all: blocks of 4096 sorted ids become strings,
  and one task streams a node's strings through the hash (SHA-256 knows no other way) holding one.

Defined cases: a null role or text is empty; rows without conv_id belong to no conversation and
are left out; turns come nulls first, equal turns by hash of (role, text), repeated rows stay;
``c % 5`` keeps the sign of c; conversations without turns after rebuilding are members of the
root; an empty table gives no rows, as no conversation starts with the root; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.ordinals import laid_out, ordinals, running
from newsloom.operators.store import discard, stored

from .common import table

GROUP, MOST = 5, 9
KEY = ["depth", "k1", "k2"]
#: Ids are joined to strings in blocks of 2^12 places.
BLOCK_BITS = 12


def _hash(columns: list, half: int):
    """One of two 64-bit hashes of the columns in order."""
    return F.xxhash64(F.lit(half), *columns)


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, h1, h2 (hash of role and text), n_bytes (of the text): narrow rows, texts stay behind."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), _hash([role, text], 1).alias("h1"), _hash([role, text], 2).alias("h2"), F.octet_length(text).cast("long").alias("n_bytes")
    )


def rebuild(turns: DataFrame, group: int = GROUP, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """(all conv_ids, rebuilt turns: conv_id, depth from 1, h1, h2, n_bytes).

    A conversation is the first h turns of conversation c - c % group, then its own turns after
    its first h; h = crc32(c) % most. Heads are ``most - 1`` rows of at most 2 * group - 1 conversations.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    placed = stored(ordinals(laid_out(turns, [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("h1"), F.col("h2")], "turns"), ["conv_id"]), "turns-placed")
    convs = stored(placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns")), "convs").select("conv_id")
    heads = placed.where(F.col("nth") < most).select(F.col("conv_id").alias("base"), "nth", "h1", "h2", "n_bytes")
    borrowed = convs.select("conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), h.alias("h")).join(heads, "base").where("nth <= h")
    own = placed.where(F.col("nth") > h)
    both = borrowed.select("conv_id", F.lit(0).alias("kind"), "nth", "h1", "h2", "n_bytes").unionByName(own.select("conv_id", F.lit(1).alias("kind"), "nth", "h1", "h2", "n_bytes"))
    rebuilt = ordinals(laid_out(both, ["conv_id", "kind", "nth"], "rebuilt"), ["conv_id"], "depth").drop("kind", "nth")
    return convs, stored(rebuilt, "rebuilt-placed")


def prefixes(convs: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """A row per conversation and depth (0 too): conv_id, depth, key (k1, k2), the parent's key (p1, p2), n_bytes."""
    tag = [F.col("depth"), F.col("h1"), F.col("h2")]
    tagged = rebuilt.select("conv_id", "depth", "n_bytes", "_at", _hash(tag, 1).alias("t1"), _hash(tag, 2).alias("t2"))
    run = running(tagged, ["conv_id"], {"k1": ("xor", F.col("t1")), "k2": ("xor", F.col("t2"))})
    below = run.select("conv_id", "depth", "k1", "k2", F.col("k1").bitwiseXOR(F.col("t1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("t2")).alias("p2"), "n_bytes")
    zero = F.lit(0).cast("long")
    return below.unionByName(convs.select("conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), zero.alias("p1"), zero.alias("p2"), zero.alias("n_bytes")))


def link(rows: DataFrame) -> DataFrame:
    """Nodes of the prefixes with owner, members and their parent (owner and smallest member)."""
    nodes = stored(
        rows.groupBy(*KEY).agg(
            F.min("conv_id").alias("conv_id"), F.max(F.struct(F.xxhash64("conv_id"), F.col("conv_id").alias("c")))["c"].alias("owner"), F.count(F.lit(1)).alias("n_convs"),
            F.max("n_bytes").alias("n_bytes"), F.max("p1").alias("p1"), F.max("p2").alias("p2"),
        ), "trie-nodes",
    )
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("owner").alias("p_owner"), F.col("conv_id").alias("p_conv"))
    linked = nodes.join(up, ["depth", "p1", "p2"], "left").drop("p1", "p2")
    children = linked.where("depth > 0").groupBy(F.col("p_owner").alias("owner"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    out = stored(linked.join(children, ["owner", "depth"], "left").na.fill(0, ["n_children"]), "trie-linked")
    return out


def peel(nodes: DataFrame) -> DataFrame:
    """What finished paths sent, by the node that they hang from: owner, depth, leaves, tokens.

    nodes: owner, depth, p_owner (null: root), leaf, tokens. Rounds: the paths on the way from a
    leaf to the root at most, some log(members) as owners are drawn at random.
    """
    paths = nodes.groupBy("owner").agg(F.sum("leaf").alias("leaves"), F.sum("tokens").alias("tokens"), F.min_by(F.struct("p_owner", (F.col("depth") - 1).alias("p_depth")), "depth").alias("up"))
    waits = paths.where("up.p_owner is not null").groupBy(F.col("up.p_owner").alias("owner")).agg(F.count(F.lit(1)).alias("waiting"))
    open_ = stored(paths.join(waits, "owner", "left").select("owner", "up.*", "leaves", "tokens", F.coalesce("waiting", F.lit(0).cast("long")).alias("waiting")), "peel")
    sent: list[DataFrame] = []
    while True:
        done = F.col("p_owner").isNotNull() & (F.col("waiting") == 0)
        ready = stored(open_.where(done).select("p_owner", "p_depth", "leaves", "tokens"), "peeled")
        if ready.isEmpty():
            discard(open_, ready)
            break
        sent.append(ready)
        news = ready.groupBy(F.col("p_owner").alias("owner")).agg(F.sum("leaves").alias("_leaves"), F.sum("tokens").alias("_tokens"), F.count(F.lit(1)).alias("_n"))
        plus = lambda c, d: F.col(c) + F.coalesce(F.col(d), F.lit(0).cast("long"))
        left = stored(
            open_.where(~done).join(news, "owner", "left")
            .select("owner", "p_owner", "p_depth", plus("leaves", "_leaves").alias("leaves"), plus("tokens", "_tokens").alias("tokens"), (F.col("waiting") - F.coalesce("_n", F.lit(0))).alias("waiting")),
            "peel",
        )
        discard(open_)
        open_ = left
    if not sent:
        return nodes.where("false").select("owner", "depth", F.col("leaf").alias("leaves"), "tokens")
    every = sent[0]
    for more in sent[1:]:
        every = every.unionByName(more)
    return every.groupBy(F.col("p_owner").alias("owner"), F.col("p_depth").alias("depth")).agg(F.sum("leaves").alias("leaves"), F.sum("tokens").alias("tokens"))


def totals(linked: DataFrame) -> DataFrame:
    """owner, depth, n_leaves, saved_tokens of every node's subtree."""
    nodes = linked.select("owner", "depth", "p_owner", (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("tokens"))
    news = peel(nodes).withColumnsRenamed({"leaves": "_leaves", "tokens": "_tokens"})
    own = nodes.join(news, ["owner", "depth"], "left").select(
        "owner", "depth", (F.col("leaf") + F.coalesce("_leaves", F.lit(0))).alias("leaf"), (F.col("tokens") + F.coalesce("_tokens", F.lit(0))).alias("tokens")
    )
    up = laid_out(own, [F.col("owner"), F.col("depth").desc()], "trie-paths")
    return running(up, ["owner"], {"n_leaves": ("sum", F.col("leaf")), "saved_tokens": ("sum", F.col("tokens"))}).select("owner", "depth", "n_leaves", "saved_tokens")


def stream_sha256(batches: Iterator[pa.RecordBatch], keys: list[str], value: str, joint: bytes) -> Iterator[pa.RecordBatch]:
    """One row a run of equal keys: the keys and the hash of its values, joined; holds one batch."""
    now, state, kept = None, None, {k: [] for k in [*keys, "sha"]}
    for batch in batches:
        for row in zip(*[batch.column(k).to_pylist() for k in [*keys, value]], strict=True):
            key, text = row[:-1], row[-1].encode()
            if key != now:
                if now is not None:
                    for k, v in zip(kept, [*now, state.hexdigest()], strict=True):
                        kept[k].append(v)
                now, state = key, hashlib.sha256(text)
            else:
                state.update(joint + text)
        if len(kept["sha"]) > 5000:
            yield pa.RecordBatch.from_pydict(kept)
            kept = {k: [] for k in kept}
    if now is not None:
        for k, v in zip(kept, [*now, state.hexdigest()], strict=True):
            kept[k].append(v)
    if kept["sha"]:
        yield pa.RecordBatch.from_pydict(kept)


def ends(rows: DataFrame) -> DataFrame:
    """depth, k1, k2 and the hash of the ids that end there, ascending and comma-joined."""
    last = rows.groupBy("conv_id").agg(F.max(F.struct(*KEY)).alias("k")).select("k.*", "conv_id")
    sorted_ids = laid_out(last, [*KEY, "conv_id"], "trie-ends")
    blocks = sorted_ids.groupBy(*KEY, F.shiftright("_at", BLOCK_BITS).alias("block")).agg(F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("ids"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return stream_sha256(batches, KEY, "ids", b",")

    return blocks.repartition(parts, *KEY).sortWithinPartitions(*KEY, "block").mapInArrow(run, "depth long, k1 long, k2 long, sha string")


def trie(conversations: DataFrame, group: int = GROUP, most: int = MOST) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs, rebuilt = rebuild(turns(conversations), group, most)
    rows = prefixes(convs, rebuilt)
    linked = link(rows)
    out = linked.join(totals(linked), ["owner", "depth"]).join(ends(rows), KEY, "left")
    return out.select(
        "conv_id", "depth", F.col("p_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")
    )


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, rebuilt as the contract says."""
    return trie(table(spark, sf_dir, "conversations"))


SQL_OP11 = """
with crc_table as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, _: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
o as (select conv_id, row_number() over (partition by conv_id order by turn nulls first, md5(coalesce(role, '') || chr(1) || coalesce(text, ''))) as pos, coalesce(role, '') as role, coalesce(text, '') as text
      from conversations where conv_id is not null),
c as (select conv_id, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda x: unicode(x)::bigint)), lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)]))) % 9 as h
      from (select distinct conv_id from o), crc_table),
r as (select c.conv_id, 0 as kind, o.pos, o.role, o.text from c join o on o.conv_id = c.conv_id - c.conv_id % 5 and o.pos <= c.h
      union all select c.conv_id, 1, o.pos, o.role, o.text from c join o on o.conv_id = c.conv_id and o.pos > c.h),
d as (select conv_id, row_number() over (partition by conv_id order by kind, pos) as depth, octet_length(encode(text)) as n_bytes, md5(octet_length(encode(role)) || ':' || role || text) as m, kind, pos from r),
p as (select conv_id, depth, n_bytes, md5(string_agg(m, ',') over (partition by conv_id order by depth)) as k from d
      union all select conv_id, 0, 0, '' from c),
nodes as (select depth, k, min(conv_id) as conv_id, count(*) as n_convs, max(n_bytes) as n_bytes from p group by depth, k),
own as (select p.*, n.conv_id as small, n.n_convs from p join nodes n using (depth, k)),
par as (select a.depth, a.k, min(b.small) as parent_conv_id, min(b.k) as parent_k from own a left join own b on a.conv_id = b.conv_id and b.depth = a.depth - 1 group by a.depth, a.k),
kids as (select depth - 1 as depth, parent_k as k, count(*) as n_children from par where depth > 0 group by all),
flag as (select own.conv_id, own.depth, own.k, own.conv_id = own.small and coalesce(n_children, 0) = 0 as leaf, case when own.conv_id = own.small then (n_convs - 1) * n_bytes else 0 end as saved
         from own left join kids using (depth, k)),
suffix as (select depth, k, sum(leaf::bigint) over w as leaves, sum(saved) over w as saved from flag window w as (partition by conv_id order by depth desc)),
sums as (select depth, k, sum(leaves) as n_leaves, sum(saved) as saved_tokens from suffix group by depth, k),
last as (select conv_id, max(depth) as depth, arg_max(k, depth) as k from p group by conv_id),
e as (select depth, k, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) as sha from last group by depth, k)
select n.conv_id, n.depth::bigint as depth, parent_conv_id, n.n_convs, coalesce(n_children, 0) as n_children, n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens,
       coalesce(sha, sha256('')) as ends_sha256
from nodes n join par using (depth, k) join sums using (depth, k) left join kids using (depth, k) left join e using (depth, k)
"""
