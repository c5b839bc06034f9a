"""The numbered queries against their SQL, or against brute force."""

import collections
import hashlib
import re
import zlib

import pytest

from helpers import DATA, same_rows
from newsloom.llm import parity_join
from newsloom.llm.registry import LLM_QUERIES, LLM_SQL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents():
    import duckdb

    return duckdb.sql(f"select doc_id, text from '{DATA}/documents.parquet' order by doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_query_matches_sql(spark, name):
    ours, theirs = same_rows(LLM_QUERIES[name](spark, DATA), LLM_SQL[name])
    assert ours == theirs


def test_op3_base_spans(spark):
    kinds = {"assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, re.I | re.A), "access": (r"AKIA[A-Z0-9]+", 0, 20, 0), "hex": (r"[0-9a-f]+", 0, 24, 0)}
    got = {r.doc_id: r for r in LLM_QUERIES["op3_secrets"](spark, DATA).collect()}
    assert len(got) == len(documents())
    for d, t in documents():
        spans = sorted((m.start(), i, k, m.end()) for i, (k, (p, g, n, f)) in enumerate(kinds.items()) for m in re.finditer(p, t or "", f) if len(m[g]) >= n)
        text = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
        assert got[d].base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(got[d].spans.split(","))
        assert (got[d].n_assign, got[d].n_access, got[d].n_hex) == tuple(sum(s[2] == k for s in spans) for k in kinds)


def test_op4_ids_are_the_librarys(spark):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in LLM_QUERIES["op4_token_files"](spark, DATA).collect()}
    start = 0
    for d, text in documents():
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_op5_held_out_quality(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(DATA.replace("0.001", "0.1") + "/labels.parquet").collect()}
    rows = LLM_QUERIES["op5_toxicity"](spark, DATA.replace("0.001", "0.1")).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(t == p for t, p in held) / len(held) > 0.97


def test_op9_ids_are_the_librarys(spark):
    import numpy as np
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: r for r in LLM_QUERIES["op9_prefix_table"](spark, DATA).collect()}
    for d, text in documents():
        ids = sp.encode(text or "", add_bos=True, add_eos=True)
        r = got[d]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest())


def brute_components(rows, k, num, den):
    sets = {}
    for d, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets[d] = frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) or (frozenset([tuple(w)]) if w else frozenset())
    holders = collections.defaultdict(list)
    up = {d: d for d in sets}

    def top(d):
        while up[d] != d:
            d = up[d]
        return d

    for d in sorted(sets):
        shared = collections.Counter(o for s in sets[d] for o in holders[s])
        for o, n in shared.items():
            if den * n >= num * (len(sets[d]) + len(sets[o]) - n):
                a, b = sorted((top(d), top(o)))
                up[b] = a
        for s in sets[d]:
            holders[s].append(d)
    return {d: (len(s), top(d)) for d, s in sets.items()}


@pytest.mark.parametrize("k, num, den, hot", [(3, 9, 10, 20), (5, 8, 10, 2)])
def test_op10_against_brute_force(spark, k, num, den, hot):
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in parity_join.classes(df, k, num, den, hot).collect()}
    assert got == brute_components(documents(), k, num, den)


def test_op10_edited_copies_of_all_sizes(spark):
    """Chains of edits around the threshold, in small and large sets, with a shared passage."""
    import random

    r = random.Random(5)
    passage = [f"p{i}" for i in range(40)]
    rows, n = [], 0
    for size in (3, 5, 9, 14, 25, 60, 130, 300):
        for _ in range(6):
            words = [f"v{r.randrange(10**6)}" for _ in range(size)] + (passage if size > 50 else [])
            for _ in range(5):
                rows.append((n, " ".join(words)))
                n += 1
                words = list(words)
                for _ in range(max(1, len(words) // 60)):
                    words[r.randrange(len(words))] = f"u{r.randrange(10**6)}"
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for k, num, den, hot in ((3, 9, 10, 20), (3, 8, 10, 3)):
        got = {x.doc_id: (x.n_shingles, x.component_id) for x in parity_join.classes(df, k, num, den, hot).collect()}
        assert got == brute_components(rows, k, num, den)


def test_op10_shared_passages_and_large_groups(spark):
    """Half the documents hold one passage, some little else; a large group of edited copies, some linked only by way of others."""
    import random

    r = random.Random(8)
    passage = [f"p{i}" for i in range(90)]
    own = lambda n: [f"v{r.randrange(10**6)}" for _ in range(n)]
    rows = [own(r.randrange(60, 150)) + (passage if i % 2 else []) for i in range(400)]
    rows += [passage + own(r.randrange(5, 30)) for _ in range(120)]
    base = own(150)
    for i in range(150):
        words = list(base)
        for _ in range(i % 6):
            words[r.randrange(len(words))] = f"u{r.randrange(10**6)}"
        rows.append(words)
    r.shuffle(rows)
    rows = [(i, " ".join(w)) for i, w in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for hot in (20, 3):
        got = {x.doc_id: (x.n_shingles, x.component_id) for x in parity_join.classes(df, 5, 8, 10, hot).collect()}
        assert got == brute_components(rows, 5, 8, 10)


def test_op5_against_brute_force(spark):
    """The map over hashed cells equals a plain count of n-grams in dicts; the fit equals a plain gradient descent's verdicts."""
    import math

    import numpy as np

    from newsloom.llm import toxicity as X

    rows = [(d, t or "") for d, t in documents()][:150] + [(1000, ""), (1001, "one"), (1002, "É é")]
    labels = {d: d % 3 == 0 for d, _ in rows}
    rows = [(d, t + " zzbadword qqworse" * 3 if labels[d] else t) for d, t in rows]

    def cell(gram):
        h = len(gram)
        for c in gram:
            h = (h ^ ord(c)) * 0x9E3779B97F4A7C15 % 2**64
            h ^= h >> 29
        return h >> (64 - X.BITS)

    def features(text):
        n = collections.Counter(cell(w[i : i + k]) for word in WORD.findall(text) for w in [f" {word.lower()} "] for k in X.SIZES for i in range(len(w) - k + 1))
        v = {c: math.log1p(k) for c, k in n.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {c: x / size for c, x in v.items()}

    import pyarrow as pa

    plain = [features(t) for _, t in rows]
    for (c, v), want in zip(X.document_features(pa.array([t for _, t in rows])), plain, strict=True):
        assert set(c.tolist()) == set(want) and all(abs(x - want[k]) < 1e-9 for k, x in zip(c.tolist(), v, strict=True))

    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    marked = spark.createDataFrame([(d, int(x)) for d, x in labels.items()], "doc_id bigint, toxic int")
    train = [i for i, (d, _) in enumerate(rows) if zlib.crc32(str(d).encode()) % 4 != 2]
    model = X.fit(df, marked)
    p, q = collections.Counter(), collections.Counter()
    for i in train:
        for k, x in plain[i].items():
            (p if labels[rows[i][0]] else q)[k] += x
    smooth = float(np.mean([x for i in train for x in plain[i].values()]))
    sp, sq = (sum(c.values()) + smooth * X.DIM for c in (p, q))
    ratio = lambda k: math.log((p[k] + smooth) / sp) - math.log((q[k] + smooth) / sq)
    scaled = [{k: x * ratio(k) for k, x in f.items()} for f in plain]
    beta, bias = collections.defaultdict(float), math.log(len(train) and sum(labels[rows[i][0]] for i in train) / sum(not labels[rows[i][0]] for i in train))
    for _ in range(300):
        grad, gb = collections.defaultdict(float), 0.0
        for i in train:
            e = 1 / (1 + math.exp(-bias - sum(beta[k] * x for k, x in scaled[i].items()))) - labels[rows[i][0]]
            gb += e
            for k, x in scaled[i].items():
                grad[k] += e * x
        bias -= 2 * gb / len(train)
        for k, g in grad.items():
            beta[k] -= 2 * g / len(train)
    want = {d: bias + sum(beta[k] * x for k, x in f.items()) > 0 for (d, _), f in zip(rows, scaled, strict=True)}
    got = {r.doc_id: r.score > 0.5 for r in X.score(df, model).collect()}
    assert sum(got[d] == want[d] for d in want) >= 0.99 * len(want)


def test_pipeline_against_plain_python(spark):
    """Every stage on its own input against a plain version; the run gives the last stage's rows."""
    import numpy as np
    import public_tokenizers
    import sentencepiece

    import corpus_pipeline
    from newsloom.llm import toxicity as X
    from newsloom.llm.common import stored

    odd = [(10**6 + i, t, s) for i, (t, s) in enumerate([(None, "a"), ("", None), ("same text here", "a"), ("same  text here", "b"), ("same text here", "a")])]
    base = spark.read.parquet(f"{DATA}/documents.parquet")
    extra = spark.createDataFrame([(d, t, "en", s, len(t or "")) for d, t, s in odd], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = stored(base.unionByName(extra.select(*base.columns)), "pipeline-docs")
    stages = dict(corpus_pipeline.STAGES)
    text = lambda df: {r.doc_id: r.text or "" for r in df.select("doc_id", "text").collect()}

    clean = stored(stages["toxicity"](spark, docs, DATA), "clean")
    scores = {r.doc_id: r.score for r in X.score(docs, X.fit(docs, spark.read.parquet(f"{DATA}/labels.parquet"))).collect()}
    assert set(text(clean)) == {d for d, s in scores.items() if s < X.THRESHOLD}

    one = stored(stages["exact_dedup"](spark, clean, DATA), "one")
    first = {}
    for d, t in sorted(text(clean).items()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), d)
    assert sorted(text(one)) == sorted(first.values())

    apart = stored(stages["parity_join"](spark, one, DATA), "apart")
    comps = brute_components(sorted(text(one).items()), 5, 8, 10)
    assert sorted(text(apart)) == sorted({c for _, c in comps.values()})

    mixed = stored(stages["mixing"](spark, apart, DATA), "mixed")
    size = {d: len(WORD.findall(t)) for d, t in text(apart).items()}
    source = {r.doc_id: r.source for r in apart.collect()}
    times = collections.Counter(r.doc_id for r in mixed.collect())
    total, names = collections.Counter(), sorted({s for s in source.values()}, key=lambda s: (s is None, s or ""))
    for d, s in source.items():
        total[s] += size[d]
    weight = {s: (5, 2, 1)[i % 3] if total[s] else 0 for i, s in enumerate(names)}
    target, capped = {}, set()
    while True:
        left = sum(total.values()) - sum(3 * total[s] for s in capped)
        level = left / sum(weight[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and weight[s] and level * weight[s] > 3 * total[s]}
        if not over:
            break
        capped |= over
    for s in names:
        target[s] = 3 * total[s] if s in capped else level * weight[s]
        taken = sum(times[d] * size[d] for d in source if source[d] == s)
        assert abs(taken - target[s]) <= max([size[d] for d in source if source[d] == s], default=0)
        assert all(times[d] <= 3 for d in source if source[d] == s)

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = stages["sentencepiece"](spark, mixed, DATA).collect()
    assert collections.Counter(r.doc_id for r in rows) == times
    texts = text(apart)
    for r in rows:
        ids = sp.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())

    run = collections.Counter((r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, DATA).collect())
    alone = base
    for name, stage in corpus_pipeline.STAGES[:-1]:
        alone = stored(stage(spark, alone, DATA), name)
    assert run == collections.Counter((r.doc_id, r.ids_sha256) for r in stages["sentencepiece"](spark, alone, DATA).collect())
    empty = docs.where("false")
    assert all(stage(spark, empty, DATA).count() == 0 for stage in stages.values())
