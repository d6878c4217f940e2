"""Conversation trie against a plain trie: block borders, copies, odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from kmstream.llm import trie

TYPE = "conv_id long, turn long, role string, text string, depth long, digest string"


def plain(convs):
    """{(members' least id, depth, prefix): figures} of {id: [(role, text), ...]}."""
    nodes = {}
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    out = []
    for pre, members in nodes.items():
        below = [p for p in nodes if p[:len(pre)] == pre]
        kids = [p for p in below if len(p) == len(pre) + 1]
        leaves = [p for p in below if not any(q[:len(p)] == p and len(q) == len(p) + 1 for q in below)]
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].split()) for p in below if p)
        ends = sorted(c for c in members if len(convs[c]) == len(pre))
        out.append((min(members), len(pre), min(nodes[pre[:-1]]) if pre else None, len(members), len(kids), len(leaves), saved,
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def mixed(rows):
    """The conversations of rows (id, turn, role, text), first turns taken from the first of each twenty."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(x, key=lambda y: y[:2])] for c, x in own.items()}
    out = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + seq[h:]
    return out


def got(spark, whole):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted([tuple(r[n] for n in names) for r in trie.prefix_trie(spark, whole).collect()], key=repr)


def random_rows(rng, n):
    rows = []
    for c in rng.sample(range(0, 4 * n), n):
        for t in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, t, rng.choice(["user", None]), rng.choice(["a b", "a b", "c", "", None]), 9, "x"))
    return rows


@pytest.mark.parametrize("bits,n", [(1, 60), (2, 90), (10, 90)])
def test_nodes_match_a_plain_trie(spark, monkeypatch, bits, n):
    """Small blocks cut the nodes; copies of one conversation and of one first turn span many of them."""
    monkeypatch.setattr(trie, "BLOCK_BITS", bits)
    rng = random.Random(bits)
    rows = random_rows(rng, n)
    rows += [(1000 + i, t, "user", f"copy {t}", 9, "x") for i in range(40) for t in range(4)]
    df = spark.createDataFrame(rows, TYPE).repartition(5)
    assert got(spark, trie.rebuilt(trie.sequences(df))) == plain(mixed([r[:4] for r in rows]))


def test_odd_rows(spark):
    rows = [(None, 0, "user", "gone", 1, "x"), (1, None, None, None, 1, "x"), (1, 0, "user", "a  b\tc", 1, "x"), (2, 5, "é", "x y", 1, "x"),
            (20, 0, "user", "long " * 50_000, 1, "x"), (21, 0, "user", "b", 1, "x"), (22, 0, "user", "b", 1, "x"), (22, 1, "user", "b", 1, "x")]
    df = spark.createDataFrame(rows, TYPE)
    whole = trie.rebuilt(trie.sequences(df))
    assert got(spark, whole) == plain(mixed([r[:4] for r in rows]))
    assert got(spark, trie.rebuilt(trie.sequences(df.limit(0)))) == []


def test_equal_turn_numbers_are_ordered_by_digest(spark):
    rows = [(1, 0, "user", "x", 1, ""), (1, 0, "user", "y", 1, ""), (1, 0, "user", "y", 1, "")]
    one, two = (trie.sequences(spark.createDataFrame(r, TYPE)).first()["turns"] for r in (rows, rows[::-1]))
    assert one == two and len(one) == 3


def test_sparse_table_reaches():
    rng = np.random.default_rng(2)
    v = rng.integers(0, 5, 37)
    t = trie.SparseTable(v)
    at, bound = np.repeat(np.arange(37), 6), np.tile(np.arange(6), 37)
    for i, b, r, lo in zip(at, bound, t.reach_right(at, bound, 36), t.reach_left(at, bound)):
        assert r == max(j for j in range(i, 37) if all(v[i + 1:j + 1] >= b))
        assert lo == min(j for j in range(0, i + 1) if all(v[j + 1:i + 1] >= b))
    lo = np.repeat(np.arange(37), 37)
    hi = np.tile(np.arange(37), 37)
    ok = lo <= hi
    assert t.least(lo[ok], hi[ok]).tolist() == [v[a:b + 1].min() for a, b in zip(lo[ok], hi[ok])]
