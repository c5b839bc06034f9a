"""Conversation trie, conversation repair and token counts against plain versions."""

import collections
import hashlib
import heapq
import random
import re
import struct
import zlib

import pytest
import xxhash

from newsloom.llm import conversation_repair as R
from newsloom.llm import conversation_trie as T
from newsloom.llm import token_counts as C
from newsloom.operators.ordinals import laid_out  # noqa: F401

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, owner string, _at bigint"
EMPTY = hashlib.sha256(b"").hexdigest()


def frame(spark, rows):
    """Rows with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*r, 7, "x", 1) for r in rows], SCHEMA).repartition(3)


def invented(seed, convs=40, long=0):
    r = random.Random(seed)
    rows = []
    for c in [*range(convs), -3, -7, 10**12 + 1]:
        for t in range(r.randrange(0, 9)):
            rows.append((c, r.choice([t, t, t, None]), r.choice(["system", "user", "assistant", None, "", "tool"]) if r.random() < 0.3 else ("user", "assistant")[t % 2], r.choice(["Hi.", "Yes!", "no", "", None, " \n", "é?"])))
    rows += [(3, t, ("user", "assistant")[t % 2] if r.random() < 0.9 else "system", r.choice(["Long.", f"t{t}", f"t{t}."])) for t in range(long)]
    return rows


def in_order(rows, key):
    out = collections.defaultdict(list)
    for c, t, role, text in rows:
        out[c].append((t is not None, t or 0, key(role, text), t, role, text))
    return {c: [x[3:] for x in sorted(v, key=lambda x: x[:3])] for c, v in out.items()}


def plain_trie(rows, group=5, most=9):
    def key(role, text):
        out = []
        for half in (1, 2):
            h = 42
            for part in (struct.pack("<i", half), role.encode(), text.encode()):
                h = xxhash.xxh64_intdigest(part, seed=h)
            out.append(h - (h >> 63 << 64))
        return tuple(out)

    convs = {c: [(r, x) for _, r, x in v] for c, v in in_order([(c, t, r or "", x or "") for c, t, r, x in rows if c is not None], key).items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - (abs(c) % group) * (1 if c >= 0 else -1)
        built[c] = convs.get(base, [])[:h] + own[h:]
    members, kids, ends = collections.defaultdict(list), collections.defaultdict(set), collections.defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                kids[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0) + sum(saved[k] for k in kids[node])
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids[n]), leaves[n], saved[n], hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest())
        for n, m in members.items()
    )


def trie_rows(df):
    return sorted((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


@pytest.mark.parametrize("seed, long", [(1, 0), (2, 300)])
def test_trie_against_plain_python(spark, seed, long):
    rows = invented(seed, long=long)
    rows += [(r[0] + 100, *r[1:]) for r in rows if r[0] % 5 == 0 and r[0] >= 0] + rows[:5] + [(None, 0, "user", "lost")]  # copies, repeats, no id
    assert trie_rows(T.trie(frame(spark, rows))) == plain_trie(rows)


def test_trie_of_snapshots_and_many_copies(spark, monkeypatch):
    """Every conversation extends the one before it; a third are copies; ids that end in one node span blocks."""
    rows = [(5 * c, t, "user", f"t{t}") for c in range(30) for t in range(c)] + [(5 * (100 + c), t, "user", f"t{t}") for c in range(40) for t in range(3)]
    monkeypatch.setattr(T, "BLOCK_BITS", 2)
    assert trie_rows(T.trie(frame(spark, rows))) == plain_trie(rows)


def test_trie_of_nothing(spark):
    assert T.trie(frame(spark, [(1, 0, "a", "b")]).where("false")).count() == 0
    assert trie_rows(T.trie(frame(spark, [(1, None, None, None)]))) == plain_trie([(1, None, None, None)])


def test_peeling_rounds_grow_slowly():
    """Owners at random: the owners on a walk down nested snapshots are few."""
    r = random.Random(0)
    rank = {c: r.random() for c in range(4000)}
    owners = [max(range(d, 4000), key=rank.get) for d in range(0, 4000, 1)]
    assert len(set(owners)) < 40


# ---------------------------------------------------------------- repair
def plain_repair(turns):
    """The cheapest (cost, audit) by Dijkstra over (turns read, what the output ends with)."""
    seen, marked = set(), []
    counts = collections.Counter()
    for _, role, text in turns:
        cut = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not cut else "duplicate" if (role, text) in seen else "truncated" if cut[-1] not in ".!?" else None
        seen.add((role, text))
        counts[fault] += 1
        marked.append((role, text, fault))
    initials = [m[0][:1] for m in marked]
    counts["illegal"] = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    grow = {"": "u", "s": "u", "u": "a", "a": "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(marked) and state in ("", "a"):
            break
        new = grow[state]
        name = {"u": "user", "a": "assistant"}[new]
        heapq.heappush(heap, (cost + 2, audit + "I", i, new, (*out, f"{name}:")))
        if i < len(marked):
            role, text, fault = marked[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, out))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, new, (*out, f"{name}:{text}")))
                if role[:1] == new or (role[:1] == "s" and state == ""):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], (*out, f"{role}:{text}")))
    known = [t for t, _, _ in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], counts["illegal"], cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def by_hash(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def repaired(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


@pytest.mark.parametrize("seed, bits, fan", [(1, 8, 6), (2, 1, 1), (3, 3, 2)])
def test_repair_against_plain_python(spark, monkeypatch, seed, bits, fan):
    """Small blocks and groups make several levels of the tree; one conversation holds most rows."""
    monkeypatch.setattr(R, "BLOCK_BITS", bits)
    monkeypatch.setattr(R, "FAN_BITS", fan)
    rows = invented(seed, long=150) + [(None, 1, "user", "x")]
    want = {c: plain_repair(v) for c, v in in_order([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c is not None], by_hash).items()}
    assert repaired(R.repair(frame(spark, rows))) == want


def test_repair_of_damaged_rows(spark, tmp_path):
    """The query on a table of its own: damage, conversations that lose every row."""
    rows = invented(9, convs=300)
    rows = [r for i, r in enumerate(rows) if (r[0], r[1]) not in {(x[0], x[1]) for x in rows[:i]}]
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    damaged = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        n = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        text = "" if n == 1 else re.sub("[.!?]", "", text) if n == 2 else text
        damaged += [(c, t, "user" if n == 4 else role, text)] * (0 if n == 0 else 2 if n == 3 else 1)
    want = {c: (0, 0, 0, 0, 0, 0, "", EMPTY) for c, *_ in rows}
    want |= {c: plain_repair(v) for c, v in in_order(damaged, by_hash).items()}
    assert repaired(R.op13_conversation_repair(spark, str(tmp_path))) == want


def test_repair_of_nothing(spark):
    assert R.repair(frame(spark, [(1, 0, "a", "b")]).where("false")).count() == 0


def test_matrices_are_associative():
    r = random.Random(4)
    codes = ["".join(r.choice("abcdefghijkl") for _ in range(r.randrange(1, 7))) for _ in range(60)]
    for a, b in zip(codes, codes[1:], strict=False):
        assert R.product(R.block(a), R.block(b)) == R.block(a + b)


# ---------------------------------------------------------------- tokens
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(C.file_path())


ODD = [
    "it's we'RE I'll 'sam ''s 'r 're've 'l 'll 'x can't 1234 a1b2 don''t", "<|endoftext|>hi<|startoftext|><|ENDOFTEXT|> x<|endoftext|>", "Σίσυφος ΟΔΟΣ İstanbul éä 각 日本語の文章 😀😀 x y z",
    "", " \n", "'", "'r", "'l", "a" * 700, "ﬁ ǅ ẞ ß Ⅷ ² ½ ٣", "a" * 5000 + "'" + "b" * 300, "'" * 1000, "<|endoftext|", "ͅ ᲊ", "</w> the</w>",
]


@pytest.mark.parametrize("window", [7, 1 << 20])
def test_counts_are_the_librarys(monkeypatch, window):
    monkeypatch.setattr(C, "WINDOW", window)
    r = random.Random(window)
    letters = list("abcdefghijklmnopqrstuvwxyzAEIST''' 019.,!<|>éßσΣ́̈日本\n")
    texts = ODD + ["".join(r.choice(letters) for _ in range(r.randrange(150))) for _ in range(300)]
    want = [len(e.ids) for e in library().encode_batch(texts, add_special_tokens=False)]
    counter = C.Counter(C.file_path())
    assert counter.short(texts).tolist() == want
    assert [counter.long(t) for t in texts] == want


def test_full_tables_change_nothing(monkeypatch):
    """Tables of pairs, transitions and pieces that overflow at once."""
    monkeypatch.setattr(C, "COMPILED", 50)
    monkeypatch.setattr(C, "PAIR_BITS", 13)
    monkeypatch.setattr(C, "REMEMBERED", 10)
    monkeypatch.setattr(C, "LONGEST", 5)
    r = random.Random(3)
    texts = ["".join(r.choice("aeiournstlhd ") for _ in range(400)) for _ in range(60)]
    assert C.Counter(C.file_path()).short(texts).tolist() == [len(e.ids) for e in library().encode_batch(texts, add_special_tokens=False)]


def test_chunk_maps_compose():
    """States by chunk maps equal a walk character by character, from every state."""
    import numpy as np

    r = np.random.default_rng(0)
    for n in (0, 1, 255, 256, 257, 3000):
        kinds = r.integers(0, 10, n).astype(np.uint8)
        for state in range(7):
            flags, now = np.zeros(n, bool), state
            for i, c in enumerate(kinds):
                k = now * 10 + int(c)
                flags[i] |= bool(C.HERE[k])
                if C.BACK[k] and i:
                    flags[i - 1] = True
                now = int(C.AFTER[k])
            got, end = C.starts(kinds, state)
            assert end == now and (got == flags).all()


def test_count_tokens_edges(spark, docs, empty):
    clash = docs.withColumnRenamed("id", "n_tokens").withColumnRenamed("h", "_text")
    rows = C.count_tokens(clash, limit=10).collect()
    lib = library()
    want = sorted((str(r.doc_id), len((r.text or "").encode()), len(lib.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == want
    assert all(r.over_limit == (r.n_tokens > 10) and r._text == "h" for r in rows)
    assert C.count_tokens(empty).count() == 0


def test_op12_is_the_librarys(spark):
    from helpers import DATA

    lib = library()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = C.op12_token_counts(spark, DATA).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n = len(lib.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 2048)
