"""Merkle manifest against a plain recursive version: block sizes, appends, odd rows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from kmstream.llm import merkle

FIELDS = ["doc_id", "source", "text"]
TYPE = "doc_id long, source string, text string, tree string, idx long, digest string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:3]))


def up(level):
    """(root, siblings of each leaf of the level, left to right, up to it)."""
    paths = [[] for _ in level]
    owners = [[k] for k in range(len(level))]
    while len(level) > 1:
        nxt, own = [], []
        for a in range(0, len(level), 3):
            run = level[a:a + 3]
            for k in range(len(run)):
                for o in owners[a + k]:
                    paths[o] += run[:k] + run[k + 1:]
            nxt.append(sha("".join(run)))
            own.append([o for k in range(len(run)) for o in owners[a + k]])
        level, owners = nxt, own
    return level[0], paths


def brute(rows):
    """{(id, leaf): (subroot, root, digest of the siblings)} and the root."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    done = {}
    for s in names:
        mine = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        done[s] = (mine, *up([leaf(r) for r in mine]))
    root, tops = up([done[s][1] for s in names])
    out = []
    for s, top in zip(names, tops):
        mine, sub, paths = done[s]
        out += [(r[0], leaf(r), sub, root, sha("".join(p + top))) for r, p in zip(mine, paths)]
    return sorted(out, key=repr)


def got(spark, made):
    rows = merkle.proofs(made.leaves(), made.root, F.col("digest"), ["doc_id"]).collect()
    assert all(r["verified"] and r["folded_root"] == r["root"] for r in rows)
    return sorted([(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"]) for r in rows], key=repr)


def some_rows(rng, n, first=0):
    names = [None, "", "a", "é", "b" * 3] + ["hot"] * 6
    out = [(first + i, rng.choice(names), rng.choice([None, "", "x\ny", "é", "z" * 50]), "t", 1, "d") for i in range(n)]
    return out


@pytest.mark.parametrize("levels,n", [(1, 40), (2, 75), (7, 30), (1, 1), (2, 10)])
def test_proofs_match_plain_trees(spark, levels, n):
    rows = some_rows(random.Random(n), n)
    rows += [(None, "hot", "w", "t", 1, "d"), (None, "hot", "v", "t", 1, "d"), rows[0], rows[0]] if n > 1 else []
    df = spark.createDataFrame(rows, TYPE)
    made = merkle.build(spark, df, FIELDS, keep=[F.col("doc_id")], rules=merkle.MerkleRules(levels=levels))
    assert got(spark, made) == brute(rows)


def test_appending_equals_building_anew(spark):
    rng = random.Random(11)
    parts = [some_rows(rng, 28), some_rows(rng, 1, 100), some_rows(rng, 35, 200) + [(300, "new", "q", "t", 1, "d")]]
    rules = merkle.MerkleRules(levels=1)
    made = merkle.build(spark, spark.createDataFrame(parts[0], TYPE), FIELDS, keep=[F.col("doc_id")], rules=rules)
    for k in (1, 2):
        made = merkle.append(spark, made, spark.createDataFrame(parts[k], TYPE), FIELDS, keep=[F.col("doc_id")])
        assert got(spark, made) == brute(sum(parts[:k + 1], []))


def test_empty_table_and_altered_leaf(spark):
    none = merkle.build(spark, spark.createDataFrame([], TYPE), FIELDS, keep=[F.col("doc_id")])
    assert none.root is None and merkle.proofs(none.leaves(), none.root, F.col("digest"), ["doc_id"]).count() == 0
    one = merkle.build(spark, spark.createDataFrame([(1, "s", "a\nb", "t", 1, "d")], TYPE), FIELDS, keep=[F.col("doc_id")])
    assert one.root.hex() == leaf((1, "s", "a\nb"))
    r = merkle.proofs(one.leaves(), one.root, F.unhex(F.lit("00" * 32)), ["doc_id"]).first()
    assert not r["verified"] and r["folded_root"] == "00" * 32 and r["proof_sha256"] == sha("")


def test_partial_witness_grows_with_later_siblings():
    tree = merkle.WitnessTree(2)
    first = tree.append(b"a" * 32)
    assert tree.witness(first) == b"" and first.siblings == []
    second = tree.append(b"b" * 32)
    assert first.siblings == [b"b" * 32] and second.siblings == [b"a" * 32]
    for c in (b"c", b"d"):
        tree.append(c * 32)
    root = tree.finish()
    for x in (first, second):
        assert merkle.fold(x.digest, tree.witness(x))[0] == root
