"""Cheapest repair of conversation structure by a min-plus scan of 4x4 matrices.

A conversation is well formed when the initials of its roles give ``(s?(ua)+)?``. Four states
say what the repaired turns so far end with: nothing, system, user, assistant. Each turn is a
4x4 matrix over elements (cost, audit): inserts before it (closed over any number of them),
then keep, rerole or delete. Products add costs and append audits, sums take the smaller pair, so a conversation's
matrix is the product of its turns' in any bracketing. (Appending keeps the order of audits
that differ first at some letter; no audit of a pair of states is another's prefix at the same
cost, as only inserts could follow it and they cost.)

Turns are laid out in range partitions and cut into blocks of 256 places. A block's matrix is
one row; blocks of a conversation meet in groups of 64, level by level, until one matrix is
left (up), which gives cost and audit; the states between blocks come back down the same
groups, and each block then knows its own part of the audit. Nothing gathers a conversation but
the stream that hashes its repaired text (SHA-256 must see it in order; one turn is held).

Defined cases: a null role or text is one space; null turns come first; equal turns by the hash of (role, text),
repeated rows stay; rows without conv_id belong to no conversation and are left out; a conversation without
turns is repaired to nothing; an empty table gives no rows; roles count by their first
character, an empty role by none; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.ordinals import PART_BITS, laid_out
from newsloom.operators.store import stored

from .common import table

BLOCK_BITS, FAN_BITS = 8, 6
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
#: States: nothing, system, user, assistant. What an insert or a rerole makes of each.
NEXT = (2, 2, 3, 2)
NAMES = {2: "user", 3: "assistant"}
WHITE = " \t\n\x0b\x0c\r"
Element = tuple[int, str]
Matrix = list[list[Element | None]]


def _sum(a: Element | None, b: Element | None) -> Element | None:
    return b if a is None else a if b is None else min(a, b)


def product(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product of (cost, audit) matrices; None: no way."""
    out: Matrix = []
    for row in a:
        new: list[Element | None] = [None] * 4
        for x, to in zip(row, b, strict=True):
            if x is not None:
                for j, y in enumerate(to):
                    if y is not None and (new[j] is None or x[0] + y[0] <= new[j][0]):
                        new[j] = _sum(new[j], (x[0] + y[0], x[1] + y[1]))
        out.append(new)
    return out


def unit() -> Matrix:
    return [[(0, "") if i == j else None for j in range(4)] for i in range(4)]


def closure() -> Matrix:
    """Any number of inserts: the sum of the powers of one insert (three suffice for four states)."""
    one: Matrix = [[(INSERT, "I") if j == NEXT[i] else None for j in range(4)] for i in range(4)]
    total = power = unit()
    for _ in range(3):
        power = product(power, one)
        total = [[_sum(x, y) for x, y in zip(a, b, strict=True)] for a, b in zip(total, power, strict=True)]
    return total


CLOSED = closure()


@functools.cache
def turn(code: str) -> Matrix:
    """The matrix of a turn: inserts, then the turn. code: 3 * role (s u a other) + (clean, to be deleted, truncated), from "a" on."""
    role, fault = divmod(ord(code) - 97, 3)
    more = TRUNCATED if fault == 2 else 0
    m: Matrix = [[(DELETE, "D") if i == j else None for j in range(4)] for i in range(4)]
    if fault != 1:
        for i in range(4):
            m[i][NEXT[i]] = _sum(m[i][NEXT[i]], (REROLE + more, "R"))
            kept = 1 if role == 0 and i == 0 else NEXT[i] if role + 1 == NEXT[i] else None
            if kept is not None:
                m[i][kept] = _sum(m[i][kept], (more, "K"))
    return product(CLOSED, m)


@functools.lru_cache(maxsize=1 << 15)
def block(codes: str) -> Matrix:
    """The product of a block's turns; short conversations repeat, so the last ones are remembered."""
    m = unit()
    for c in codes:
        m = product(m, turn(c))
    return m


def illegal_pairs(codes: str) -> int:
    roles = [(ord(c) - 97) // 3 for c in codes]
    return sum((a, b) not in ((0, 1), (1, 2), (2, 1)) for a, b in zip(roles, roles[1:], strict=False))


STATS = ["blank", "duplicate", "truncated", "illegal", "t_min", "t_max", "t_n"]
NODE = "conv_id long, idx long, costs array<long>, audits array<string>, head int, tail int, " + ", ".join(f"{c} long" for c in STATS)


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the contract's faults, by the remainder of crc32(conv_id:turn) and 20."""
    n = F.crc32(F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" "))).cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.when(n == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(n == 1, "").when(n == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), n.alias("_n"),
    )
    return rows.where("_n <> 0").select("conv_id", "turn", "role", "text", F.explode(F.when(F.col("_n") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")


def lay(rows: DataFrame) -> DataFrame:
    """The turns in order (``_at``) with the hash of role and text."""
    t = rows.where("conv_id is not null").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    hashed = t.withColumn("w", F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    return laid_out(hashed, [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("w")], "repair-turns")


def faults(laid: DataFrame) -> DataFrame:
    """conv_id, turn, _at, role (0 system, 1 user, 2 assistant, 3 other), fault (0 none, 1 blank, 2 duplicate, 3 truncated)."""
    trimmed = F.rtrim("text", F.lit(WHITE))
    initial = F.left("role", F.lit(1))
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    narrow = laid.select("conv_id", "turn", "_at", "w", role.alias("role"), (trimmed == "").alias("blank"), F.right(trimmed, F.lit(1)).isin(".", "!", "?").alias("ended"))
    # a (role, text) is first where its place is the smallest; places are unique, so no key is hot in the join
    first = narrow.groupBy("conv_id", "w").agg(F.min("_at").alias("_at")).select("_at", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), 1).when(F.col("first").isNull(), 2).when(~F.col("ended"), 3).otherwise(0)
    return narrow.join(first, "_at", "left").select("conv_id", "turn", "_at", "role", fault.alias("fault"))


def _flat(m: Matrix) -> tuple[list, list]:
    cells = [x for row in m for x in row]
    return [None if x is None else x[0] for x in cells], [None if x is None else x[1] for x in cells]


def _square(costs: list, audits: list) -> Matrix:
    cells = [None if c is None else (c, a) for c, a in zip(costs, audits, strict=True)]
    return [cells[i : i + 4] for i in (0, 4, 8, 12)]


def leaves(marked: DataFrame, idx: Column) -> DataFrame:
    """A node per conversation and block of 256 places."""
    code = F.chr(97 + F.col("role") * 3 + F.when(F.col("fault") == 3, 2).when(F.col("fault") > 0, 1).otherwise(0))
    rows = marked.groupBy("conv_id", idx.alias("idx")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", code.alias("c")))), lambda x: x["c"]), "").alias("codes"),
        *[F.count_if(F.col("fault") == k).alias(c) for k, c in enumerate(STATS[:3], 1)], F.min("turn").alias("t_min"), F.max("turn").alias("t_max"), F.count_distinct("turn").alias("t_n"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                codes = r.pop("codes")
                costs, audits = _flat(block(codes))
                out.append(r | {"costs": costs, "audits": audits, "head": (ord(codes[0]) - 97) // 3, "tail": (ord(codes[-1]) - 97) // 3, "illegal": illegal_pairs(codes)})
            yield from pa.Table.from_pylist(out, schema=_schema(NODE)).to_batches()

    return rows.mapInArrow(run, NODE)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


def _family(nodes: DataFrame, *more: str) -> DataFrame:
    """The children of each parent in order: 64 at most."""
    return nodes.groupBy("conv_id", F.shiftright("idx", FAN_BITS).alias("parent"), *more).agg(F.array_sort(F.collect_list(F.struct("idx", *[c for c in nodes.columns if c not in ("conv_id", "idx", *more)]))).alias("nodes"))


def reduce_level(nodes: DataFrame) -> DataFrame:
    """One level of the tree: each parent's node from its children's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                m, all_ = unit(), None
                for n in r["nodes"]:
                    m = product(m, _square(n["costs"], n["audits"]))
                    if all_ is None:
                        all_ = dict(n)
                        continue
                    all_["illegal"] += n["illegal"] + ((all_["tail"], n["head"]) not in ((0, 1), (1, 2), (2, 1)))
                    all_["t_n"] += n["t_n"] - (n["t_n"] > 0 and all_["t_max"] == n["t_min"])
                    for c in STATS[:3]:
                        all_[c] += n[c]
                    all_["tail"] = n["tail"]
                    all_["t_min"] = n["t_min"] if all_["t_min"] is None else all_["t_min"]
                    all_["t_max"] = all_["t_max"] if n["t_max"] is None else n["t_max"]
                all_["costs"], all_["audits"] = _flat(m)
                yield from pa.Table.from_pylist([all_ | {"conv_id": r["conv_id"], "idx": r["parent"]}], schema=_schema(NODE)).to_batches()

    return _family(nodes).mapInArrow(run, NODE)


def choose(roots: DataFrame) -> DataFrame:
    """Cost, audit and state before the closing inserts of whole conversations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                row = _square(r.pop("costs"), r.pop("audits"))[0]
                ways = [(x[0] + y[0], x[1] + y[1], j, y[1]) for j, x in enumerate(row) if x is not None for end in (0, 3) if (y := CLOSED[j][end]) is not None]
                cost, audit, state, closing = min(ways)
                gaps = 0 if r["t_min"] is None else r["t_max"] - r["t_min"] + 1 - r["t_n"]
                out.append({c: r[c] for c in ("conv_id", "idx", *STATS[:4])} | {"gaps": gaps, "cost": cost, "audit": audit, "state": state, "closing": closing})
            yield from pa.Table.from_pylist(out, schema=_schema(CHOSEN)).to_batches()

    return roots.mapInArrow(run, CHOSEN)


CHOSEN = "conv_id long, idx long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, state int, closing string"
WAY = "conv_id long, idx long, entry int, state int"


def descend(nodes: DataFrame, ways: DataFrame) -> DataFrame:
    """From the states before and after each parent (conv_id, idx, entry, state) those of its children."""
    family = _family(nodes.select("conv_id", "idx", "costs", "audits")).join(ways.withColumnRenamed("idx", "parent"), ["conv_id", "parent"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                best = {r["entry"]: (0, "", [])}
                for n in r["nodes"]:
                    m, new = _square(n["costs"], n["audits"]), {}
                    for i, (cost, audit, path) in best.items():
                        for j, y in enumerate(m[i]):
                            if y is not None:
                                way = (cost + y[0], audit + y[1], [*path, i])
                                new[j] = min(new.get(j, way), way)
                    best = new
                states = [*best[r["state"]][2], r["state"]]
                rows = [{"conv_id": r["conv_id"], "idx": n["idx"], "entry": a, "state": b} for n, a, b in zip(r["nodes"], states, states[1:], strict=False)]
                yield from pa.Table.from_pylist(rows, schema=_schema(WAY)).to_batches()

    return family.mapInArrow(run, WAY)


def hashes(laid: DataFrame, pieces: DataFrame, chosen: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of the repaired turns; pieces: conv_id, _at (of the block's first place), audit."""
    none, top = F.lit(None).cast("string"), F.lit(2**63 - 1)
    rows = (
        laid.select("conv_id", "_at", F.lit(1).alias("kind"), "role", "text")
        .unionByName(pieces.select("conv_id", "_at", F.lit(0).alias("kind"), none.alias("role"), F.col("audit").alias("text")))
        .unionByName(chosen.select("conv_id", top.alias("_at"), F.lit(2).alias("kind"), none.alias("role"), F.col("closing").alias("text")))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, started, state, audit, at = hashlib.sha256(), False, 0, "", 0

        def line(text: str) -> None:
            nonlocal started
            digest.update((("\n" if started else "") + text).encode())
            started = True

        for batch in batches:
            out = []
            for conv, kind, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "kind", "role", "text")], strict=True):
                if kind == 0:
                    audit, at = text, 0
                    continue
                if kind == 2:
                    audit, at = text, 0
                while at < len(audit) and audit[at] == "I":
                    state = NEXT[state]
                    line(f"{NAMES[state]}:")
                    at += 1
                if kind == 2:  # a conversation's last row
                    out.append((conv, digest.hexdigest()))
                    digest, started, state = hashlib.sha256(), False, 0
                    continue
                op, at = audit[at], at + 1
                if op == "K":
                    state = 1 if role[:1] == "s" else NEXT[state]
                    line(f"{role}:{text}")
                elif op == "R":
                    state = NEXT[state]
                    line(f"{NAMES[state]}:{text}")
            yield pa.RecordBatch.from_pydict({"conv_id": pa.array([x[0] for x in out], pa.int64()), "repaired_sha256": pa.array([x[1] for x in out], pa.string())})

    parts = int(laid.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "_at", "kind").mapInArrow(run, "conv_id long, repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation with a turn: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    laid = lay(rows)
    span = (laid.agg(F.max(F.col("_at").bitwiseAND((1 << PART_BITS) - 1))).first()[0] or 0) >> BLOCK_BITS
    place = F.shiftright(F.col("_at").bitwiseAND((1 << PART_BITS) - 1), BLOCK_BITS)
    # blocks are numbered without holes between partitions, so that neighbours meet early
    idx = F.shiftright("_at", PART_BITS) * (span + 1) + place
    at = F.shiftleft(F.floor(F.col("idx") / (span + 1)), PART_BITS) + F.shiftleft(F.col("idx") % (span + 1), BLOCK_BITS)
    bottom = stored(leaves(faults(laid), idx), "repair-leaves")
    level, levels, finished = bottom, [], []
    while True:
        sizes = level.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_nodes"))
        finished.append(stored(choose(level.join(sizes.where("_nodes = 1").select("conv_id"), "conv_id", "left_semi").select(*level.columns)), "repair-chosen"))
        many = stored(level.join(sizes.where("_nodes > 1").select("conv_id"), "conv_id", "left_semi").select(*level.columns), "repair-level")
        if many.isEmpty():
            break
        levels.append(many)
        level = stored(reduce_level(many), "repair-reduced")
    whole = lambda t: t.select("conv_id", "idx", F.lit(0).alias("entry"), "state")
    ways = whole(finished[-1])
    for nodes, done in zip(reversed(levels), reversed(finished[:-1]), strict=True):
        ways = stored(descend(nodes, ways), "repair-ways").unionByName(whole(done))
    chosen = finished[0]
    for more in finished[1:]:
        chosen = chosen.unionByName(more)
    pieces = bottom.select("conv_id", "idx", "audits").join(ways, ["conv_id", "idx"]).select("conv_id", at.alias("_at"), F.element_at("audits", F.col("entry") * 4 + F.col("state") + 1).alias("audit"))
    return chosen.drop("idx", "state", "closing").join(hashes(laid, pieces, chosen), "conv_id")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged as the contract says, repaired; those that lost every turn too."""
    conversations = table(spark, sf_dir, "conversations")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    every = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long")).distinct()
    return every.join(repair(damage(conversations)), "conv_id", "left").na.fill(0, counts).na.fill({"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()})


def _sql() -> str:
    """A recursive query: one turn of every conversation a step, the best (cost, audit, text) of each state."""

    def plus(x: str, cost: str, letter: str, line: str = "''") -> str:
        return f"{{'c': {x}.c + {cost}, 'a': {x}.a || '{letter}', 'o': {x}.o || {line}}}"

    def least(*ways: str) -> str:
        return f"least({', '.join(ways)})"

    def inserts(p: str) -> list[str]:
        user, both = "('user:' || chr(10))", "('user:' || chr(10) || 'assistant:' || chr(10))"
        more = [plus(f"{p}{i}", "2", "I", user) for i in (0, 1, 3)]
        return [f"{p}0", f"{p}1", least(f"{p}2", *more), least(f"{p}3", plus(f"{p}2", "2", "I", "('assistant:' || chr(10))"), plus(f"{p}0", "4", "II", both), plus(f"{p}1", "4", "II", both))]

    closed = ", ".join(f"{x} as z{i}" for i, x in enumerate(inserts("v")))
    kept, user, assistant = "(role || ':' || text || chr(10))", "('user:' || text || chr(10))", "('assistant:' || text || chr(10))"
    bar = lambda role: f"(case when fault in (1, 2) or ini <> '{role}' then 1000000000 else (fault = 3)::bigint end)"
    rer = "(case when fault in (1, 2) then 1000000000 else 2 + (fault = 3)::bigint end)"
    step = [
        plus("z0", "3", "D"),
        least(plus("z1", "3", "D"), plus("z0", bar("s"), "K", kept)),
        least(plus("z2", "3", "D"), *[plus(f"z{i}", bar("u"), "K", kept) for i in (0, 1, 3)], *[plus(f"z{i}", rer, "R", user) for i in (0, 1, 3)]),
        least(plus("z3", "3", "D"), plus("z2", bar("a"), "K", kept), plus("z2", rer, "R", assistant)),
    ]
    new = ", ".join(f"{x} as v{i}" for i, x in enumerate(step))
    no = "{'c': 1000000000::bigint, 'a': '', 'o': ''}"
    return f"""
with recursive crc_table as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, _: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
n as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
      xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar || ':' || coalesce(turn::varchar, ' '), ''), lambda x: unicode(x)::bigint)), lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)]))) % 20 as d
      from conversations, crc_table where conv_id is not null),
damaged as (select conv_id, turn, case when d = 4 then 'user' else role end as role, case d when 1 then '' when 2 then translate(text, '.!?', '') else text end as text, unnest(range(case when d = 3 then 2 else 1 end)) as copy from n where d <> 0),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, md5(octet_length(encode(role)) || ':' || role || text)) as i, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as cut from damaged),
marked as (select *, left(role, 1) as ini, left(role, 1) as init, lag(left(role, 1)) over (partition by conv_id order by i) as before,
           case when cut = '' then 1 when row_number() over (partition by conv_id, role, text order by i) > 1 then 2 when right(cut, 1) not in ('.', '!', '?') then 3 else 0 end as fault from placed),
steps(conv_id, i, v0, v1, v2, v3) as (
  select distinct conv_id, 0::bigint, {{'c': 0::bigint, 'a': '', 'o': ''}}, {no}, {no}, {no} from marked
  union all
  select conv_id, i, {new} from (select s.conv_id, m.i, m.role, m.text, m.fault, m.ini, {closed} from steps s join marked m on m.conv_id = s.conv_id and m.i = s.i + 1)),
last as (select * from steps qualify row_number() over (partition by conv_id order by i desc) = 1),
ended as (select conv_id, {least("v0", inserts("v")[3])} as e from last),
counts as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 1) as blank, count(*) filter (fault = 2) as duplicate, count(*) filter (fault = 3) as truncated,
           count(*) filter (before is not null and before || ini not in ('su', 'ua', 'au')) as illegal from marked group by conv_id)
select a.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
       coalesce(e.c, 0) as cost, coalesce(e.a, '') as audit, sha256(coalesce(case when e.o = '' then '' else left(e.o, length(e.o) - 1) end, '')) as repaired_sha256
from (select distinct conv_id from n) a left join counts using (conv_id) left join ended using (conv_id)
"""


SQL_OP13 = _sql()
