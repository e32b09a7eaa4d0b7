"""Source divergence, near vectors and the prefix trie against brute-force versions, with their edge cases."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pageflow.llm import cross_polytope, divergence, prefix_trie
from pageflow.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- 11: source divergence ---------------------------------------------------------------

def brute_audit(docs, min_docs, top):
    groups, held = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for text, lang, source in docs:
        terms = TERM.findall((text or "").translate(LOWER))
        groups[lang or "", source or ""].update(terms)
        held[lang or ""].update(set(terms))
    out = set()
    for lang in {k for k, _ in groups}:
        kept = {t for t, n in held[lang].items() if n >= min_docs}
        own = {s: {t: n for t, n in c.items() if t in kept} for (k, s), c in groups.items() if k == lang}
        whole = collections.Counter()
        for c in own.values():
            whole.update(c)

        def p(counts, t):
            return 1 + 1_000_000_000 * (counts.get(t, 0) + 2) // (sum(counts.values()) + 2 * len(kept))

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s, c in own.items():
            pairs = [(o, sum(f(p(c, t), p(own[o], t)) for t in kept)) for o in own if o != s]
            terms = [(t, f(p(c, t), p(whole, t))) for t in c if p(c, t) > p(whole, t)]
            for part, rows, most in (("pair", pairs, None), ("term", terms, top)):
                rows.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, i, v, k) for k, (i, v) in enumerate(rows[:most], 1)}
    return out


def audited(df, **how):
    rows = divergence.audit(df, **how).collect()
    found = {(r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in rows}
    assert len(found) == len(rows)
    return found


def made_docs(seed, n=300):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("ka", "Lo", "ñu", "世") for b in "bcdfghjklm"] + ["the", "THE", "x-y", "don't", "a1b"]
    rows = []
    for _ in range(n):
        lang, source = rng.choice(["en", "fr", None, ""]), rng.choice(["s1", "s2", "S1", "é", None])
        bias = words[:15] if source == "s1" else words
        rows.append((rng.choice([None, ""]) if rng.random() < 0.1 else " ".join(rng.choices(bias, k=rng.randint(1, 30))), lang, source))
    return rows + [("lonely words here", "la", "only"), (None, "em", "a"), ("", "em", "b"), ("the " * 200_000, "en", "long")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string, source string").withColumns(
        {c: F.lit("clash") for c in ("term", "n", "docs", "w", "x", "slice", "postings", "part")})


def test_audit_equals_brute_force(spark, monkeypatch):
    rows = made_docs(1)
    want = brute_audit(rows, 10, 10)
    assert {r[2] for r in want} == {"pair", "term"} and any(r[4] == 0 for r in want)
    assert audited(frame(spark, rows)) == want
    monkeypatch.setattr(divergence, "SLICE_POSTINGS", 7)  # many slices: cells and largest terms are put together
    monkeypatch.setattr(divergence, "CELLS", 5)
    monkeypatch.setattr(divergence, "BROADCAST_LANGS", 1)
    assert audited(frame(spark, rows), top=3) == brute_audit(rows, 10, 3)


def test_audit_of_a_hot_source_and_of_nothing(spark):
    rows = [("alpha beta", "en", "hot")] * 4000 + [("alpha gamma gamma", "en", f"s{k % 30}") for k in range(600)]
    assert audited(frame(spark, rows)) == brute_audit(rows, 10, 10)
    assert audited(frame(spark, []).limit(0)) == set()


def test_shares_beyond_64_bits():
    count, total = np.array([0, 5, 10**12]), np.array([10**13] * 3)
    assert divergence.shares(count, total).tolist() == [1 + 10**9 * (c + 2) // 10**13 for c in (0, 5, 10**12)]


# --- 12: near vectors --------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int"


def brute_links(rows, threshold=0.9):
    """(vec_id, links, component, kept) of all rows, from every pair's cosine."""
    good = []
    for k, v in enumerate(rows):
        x = None if v[1] is None or any(c is None for c in v[1]) else np.array(v[1], np.float32).astype(np.float64)
        if x is not None and len(x) and np.isfinite(x).all() and x.any():
            good.append((k, x / np.linalg.norm(x)))
    near = {k: set() for k in range(len(rows))}
    for size in {len(x) for _, x in good}:
        at = [k for k, x in good if len(x) == size]
        x = np.array([x for _, x in good if len(x) == size])
        for i, j in np.argwhere(x @ x.T >= threshold).tolist():
            if i != j:
                near[at[i]].add(at[j])
    out, seen = collections.Counter(), {}
    for k in near:
        if k not in seen:
            part, todo = {k}, [k]
            while todo:
                new = near[todo.pop()] - part
                part |= new
                todo += new
            ids = [rows[m][0] for m in part if rows[m][0] is not None]
            seen |= {m: min(ids) if ids else None for m in part}
        out[rows[k][0], len(near[k]), seen[k], rows[k][0] == seen[k]] += 1
    return out


def found(df, **how):
    return collections.Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in cross_polytope.near_vectors(df, **how).collect())


def near(rng, base, cosine):
    e = rng.normal(size=len(base))
    e -= (e @ base) * base / (base @ base)
    x = cosine * base / np.linalg.norm(base) + np.sqrt(1 - cosine ** 2) * e / np.linalg.norm(e)
    return [float(v) for v in x.astype(np.float32)]


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(k, near(rng, rng.normal(size=64), 1.0), 0) for k in range(300)]
    for k in range(60):
        rows.append((1000 + k, near(rng, np.array(rows[k % 20][1]), 0.97), 1))
    rows += [(2000 + k, rows[5][1], 2) for k in range(40)]  # equal ones
    rows += [(3000 + k, [v * (k + 2) for v in rows[6][1]], 2) for k in range(5)]  # of other lengths
    assert found(spark.createDataFrame(rows, VECTORS)) == brute_links(rows)


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(8)
    rows = []
    for k in range(1000):
        base = rng.normal(size=64)
        rows += [(2 * k, near(rng, base, 1.0), 0), (2 * k + 1, near(rng, base, 0.9001), 0)]
    got = found(spark.createDataFrame(rows, VECTORS))
    want = brute_links(rows)
    missed = sum((want - got).values())
    assert missed <= 0.01 * 2000  # 0.998 of the pairs by the docstring


def test_a_hot_bucket_is_compared_in_blocks(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=64)
    rows = [(k, near(rng, base, 0.985), 0) for k in range(700)] + [(1000 + k, near(rng, rng.normal(size=64), 1.0), 0) for k in range(100)]
    want = brute_links(rows)
    df = spark.createDataFrame(rows, VECTORS)
    assert found(df, block=100) == want and found(df, hashes=3, tables=6, probes=6) == want


def test_odd_vectors(spark):
    one = [1.0, 0.0, 0.0]
    rows = [(1, one, 0), (1, one, 0), (2, [2.0, 0.0, 0.0], None), (None, one, 0), (3, None, 0), (4, [0.0, 0.0, 0.0], 0), (5, [1.0, None, 0.0], 0),
            (6, [float("nan"), 1.0, 0.0], 0), (7, [float("inf"), 1.0, 0.0], 0), (8, [], 0), (9, [1.0], 0), (10, [5.0], 0), (11, [-1.0, 0.0, 0.0], 0),
            (None, None, 0), (12, [1e-30, 0.0, 0.0], 0), (13, [1.0, 0.4, 0.0], 0), (13, [3e38, 3e38, 0.0], 0)]
    df = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("clash") for c in ("class", "key1", "vector", "codes", "n", "bucket", "place")})
    assert found(df) == brute_links(rows)
    assert not found(df.limit(0))


def test_codes_are_corners_of_the_rotated_vector():
    x = np.random.default_rng(1).normal(size=(50, 16))
    turned = cross_polytope.hadamard(x)
    assert np.allclose(np.linalg.norm(turned, axis=1), np.linalg.norm(x, axis=1)) and np.allclose(cross_polytope.hadamard(turned), x)
    c = cross_polytope.codes(x, 2, 3, 4)
    assert c.shape == (50, 3, 4) and (np.sort(c, axis=2)[:, :, 1:] != np.sort(c, axis=2)[:, :, :-1]).all()
    assert (cross_polytope.codes(7 * x, 2, 3, 4) == c).all() and (cross_polytope.codes(-x, 2, 3, 4) != c).any()


# --- 13: prefix trie ---------------------------------------------------------------------

CONVERSATIONS = "conv_id long, turn long, role string, text string"


def brute_trie(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in own.items()}
    members = collections.defaultdict(list)
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 6, c - int(np.fmod(c, 100))
        path = own.get(base, [])[:h] + own[c][h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append((c, d == len(path)))
    children = collections.defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = sum(saved[k] for k in children[node]) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    out = collections.Counter()
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c, end in m if end))
        out[min(c for c, _ in m), len(node), min(c for c, _ in members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node],
            saved[node], hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def grown(df, **how):
    return collections.Counter(tuple(r) for r in prefix_trie.trie(df, **how).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


def test_trie_equals_brute_force(spark):
    df = spark.read.parquet(f"{SMALL}/conversations.parquet")
    want = brute_trie([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    assert collections.Counter(tuple(r) for r in QUERIES["op13_prefix_trie"](spark, SMALL).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()) == want


def test_trie_of_shared_first_turns_in_levels(spark):
    rng = random.Random(2)
    rows = []
    for c in range(500):
        for turn in range(rng.randint(1, 9)):
            rows.append((c, turn, "user", "hello" if turn == 0 else rng.choice("ab")))  # a common first turn, then few ways on
    rows += [(1000 + c, t, "user", f"same {t}") for c in range(40) for t in range(60)]  # copies of a long one
    want = brute_trie(rows)
    df = spark.createDataFrame(rows, CONVERSATIONS)
    assert grown(df) == want
    assert grown(df, fanout=3, shard_nodes=20) == want  # five levels and more, many shards


def test_odd_conversations(spark):
    rows = [(1, None, "user", "first"), (1, 0, None, "x"), (1, 0, "a", None), (1, 0, "a", None), (100, 5, None, None), (101, 1, "u", "only"),
            (107, 1, "u", "only"), (None, 1, "u", "no conversation"), (7, 1, "u", "é😀" * 100_000), (-3, 1, "u", "n"), (200, 0, "u", "b"), (205, 0, "u", "b"),
            (3, 1, "u", "short")]
    df = spark.createDataFrame(rows, CONVERSATIONS).withColumns({c: F.lit("clash") for c in ("pos", "depth", "d1", "level", "unit", "h", "base")})
    assert grown(df) == brute_trie(rows)
    assert not grown(df.limit(0)) and not grown(df.where("conv_id IS NULL"))


def test_node_table_is_minimal_and_verified():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 1 << 63, (2, 5000), np.uint64)
    t = prefix_trie.NodeTable(a, b)
    assert sorted(t.find(a, b).tolist()) == list(range(5000)) and (t.find(a, b + np.uint64(1)) == -1).all()
    with pytest.raises(ValueError):
        prefix_trie.NodeTable(np.append(a, a[:1]), np.append(b, b[:1]))
    empty = prefix_trie.accumulate(pa.table({c: pa.array([], pa.int64()) for c in (
        "d1", "d2", "p1", "p2", "conv_id", "depth", "n_convs", "chars", "add_children", "add_leaves", "add_saved")}))
    assert empty.num_rows == 0
