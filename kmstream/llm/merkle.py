"""Merkle manifest of a dataset, with witnesses that grow as leaves are appended.

Every row is a leaf, the SHA-256 of its fields. The leaves of a source, in order,
are the first level of its tree; every ``arity`` neighbours (fewer at the end) are
hashed into one node of the next level until one is left, the source's subroot. The
subroots, in order of their sources, give the root in the same way.

``WitnessTree`` appends leaves one by one. An open run of siblings holds a partial
witness for each of its nodes: the siblings to the left are complete when a node
arrives and are attached at once, each sibling that is completed later extends the
witnesses of the nodes before it. A full run closes and its hash is appended to the
next level. A leaf's witness is the chain of these parts up to the root.

Distribution: a tree is cut into aligned blocks of ``arity ** levels`` leaves. A task
streams through whole blocks in order, one after another, and emits the partial
witness of each leaf and the root of each block. The block roots are appended in
turn, as the leaves of the next round, and so on until a source has one node. So a
source with all rows of the table is still many blocks. The witness of a block's root
is then appended to those of its leaves by a join on (source, block).

``append`` adds rows behind those of an earlier manifest: closed blocks keep their
roots and partial witnesses, only the open block of a source is streamed again, and
the block roots behind it are further appends to the next round.

Scale: texts are read once and only digests travel. Ranks inside a source come from
range partitions and a count table (``common.ranked``). Nothing is collected but the
number of rounds and the root.

Defined results: a null field is ``-``, any other its UTF-8 byte count, a colon and
its value; a null source is a source of its own, before all others; null ids come
first in their source and equal ids by leaf; repeated rows are leaves of their own;
a single leaf is its source's subroot; an empty table has no rows and no root; extra
columns are neither hashed nor kept, unless they are named.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kmstream.llm.common import ranked, stored


@dataclass(frozen=True)
class MerkleRules:
    arity: int = 3
    levels: int = 7     # levels of a block: arity ** levels leaves

    @property
    def block(self) -> int:
        return self.arity ** self.levels


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 (binary) of fields that name their own length."""
    def own(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*[own(c) for c in fields]), 256))


def node_digest(children: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(children).hex().encode()).digest()


class _Node:
    __slots__ = ("digest", "at", "siblings", "parent")

    def __init__(self, digest: bytes):
        self.digest, self.at, self.siblings, self.parent = digest, 0, [], None


class WitnessTree:
    """A tree of ``levels`` levels that leaves are appended to."""

    def __init__(self, levels: int, arity: int = 3):
        self.levels, self.arity = levels, arity
        self.open: list[list[_Node]] = [[] for _ in range(levels)]
        self.root: bytes | None = None

    def append(self, digest: bytes) -> _Node:
        leaf = _Node(digest)
        self._add(0, leaf)
        return leaf

    def _add(self, level: int, node: _Node) -> None:
        if level == self.levels:
            self.root = node.digest
            return
        run = self.open[level]
        node.at, node.siblings = len(run), [x.digest for x in run]
        for x in run:
            x.siblings.append(node.digest)
        run.append(node)
        if len(run) == self.arity:
            self._close(level)

    def _close(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        parent = _Node(node_digest([x.digest for x in run]))
        for x in run:
            x.parent = parent
        self._add(level + 1, parent)

    def finish(self) -> bytes | None:
        """Close all open runs, the lowest first: the root."""
        for level in range(self.levels):
            if self.open[level]:
                self._close(level)
        return self.root

    @staticmethod
    def witness(leaf: _Node) -> bytes:
        """Per level: the place in the run, the number of siblings and their digests, left to right."""
        out, node = [], leaf
        while node.parent is not None:
            out.append(bytes((node.at, len(node.siblings))))
            out += node.siblings
            node = node.parent
        return b"".join(out)


def fold(digest: bytes, witness: bytes) -> tuple[bytes, str]:
    """(root recomputed from a leaf and its witness, hex text of all siblings)."""
    at, seen = 0, []
    while at < len(witness):
        left, n = witness[at], witness[at + 1]
        siblings = witness[at + 2:at + 2 + 32 * n].hex()
        at += 2 + 32 * n
        seen.append(siblings)
        digest = hashlib.sha256((siblings[:64 * left] + digest.hex() + siblings[64 * left:]).encode()).digest()
    return digest, "".join(seen)


def _height(n: int, arity: int) -> int:
    h = 0
    while arity ** h < n:
        h += 1
    return h


def _witnessed(nodes: DataFrame, rules: MerkleRules) -> DataFrame:
    """``nodes`` (tree, idx, n, digest, ...) with ``block``, ``witness`` inside it and, on its first row, ``root``."""
    names = nodes.columns
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema) + ", block long, witness binary, root binary"

    def flush(parts, levels):
        tree = WitnessTree(levels, rules.arity)
        rows = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0]
        leaves = [tree.append(bytes(d)) for d in rows["digest"]]
        root = tree.finish()
        return rows.assign(witness=[tree.witness(x) for x in leaves], root=[root] + [None] * (len(leaves) - 1))

    def run(batches):
        parts, now, levels = [], None, 0
        for pdf in batches:
            pdf = pdf.reset_index(drop=True)
            if pdf.empty:
                continue
            new = (pdf["tree"].ne(pdf["tree"].shift()) | pdf["block"].ne(pdf["block"].shift())).to_numpy()
            new[0] = True
            edges = [*new.nonzero()[0].tolist(), len(pdf)]
            for a, b in zip(edges, edges[1:]):
                key = (pdf["tree"].iat[a], int(pdf["block"].iat[a]))
                if parts and key != now:
                    yield flush(parts, levels)
                    parts = []
                now, levels = key, min(rules.levels, _height(int(pdf["n"].iat[a]), rules.arity))
                parts.append(pdf.iloc[a:b])
        if parts:
            yield flush(parts, levels)

    blocks = nodes.select(*names, F.expr(f"idx div {rules.block}").alias("block"))
    dealt = blocks.repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")
    return dealt.mapInPandas(run, kind)


def _grow(spark: SparkSession, fresh: DataFrame, counts: DataFrame, rules: MerkleRules, name: str, earlier: list[DataFrame] = ()) -> list[DataFrame]:
    """The rounds of all trees after ``fresh`` (tree, idx, digest, ...) was appended to those of ``earlier``.

    ``counts`` (tree, n) counts the leaves of every tree, appended ones included. A round holds the
    nodes of one block level, (tree, idx, digest, ..., block, witness, root), and the last has one
    block per tree.
    """
    most = counts.agg(F.max("n")).first()[0] or 1
    out = []
    while True:
        r = len(out)
        if r < len(earlier):
            since = fresh.groupBy("tree").agg(F.min("idx").alias("since"))
            old = earlier[r].join(since, "tree", "left")
            open_from = F.expr(f"since div {rules.block}")
            closed = old.filter(F.col("since").isNull() | (F.col("block") < open_from)).drop("since")
            again = old.filter((F.col("block") >= open_from) & (F.col("idx") < F.col("since"))).drop("since", "block", "witness", "root")
            rows = _witnessed(again.unionByName(fresh).join(counts, "tree"), rules).drop("n")
            rows = rows.withColumn("changed", F.lit(True)).unionByName(closed.withColumn("changed", F.lit(False)))
        else:
            rows = _witnessed(fresh.join(counts, "tree") if "n" not in fresh.columns else fresh, rules).drop("n").withColumn("changed", F.lit(True))
        rows = stored(spark, rows, f"merkle-{name}-{r}")
        out.append(rows.drop("changed"))
        if most <= rules.block:
            return out
        most = -(-most // rules.block)
        counts = counts.select("tree", F.expr(f"(n + {rules.block - 1}) div {rules.block}").alias("n"))
        changed = rows.filter("changed and root is not null" if r + 1 < len(earlier) else "root is not null")
        fresh = changed.select("tree", F.col("block").alias("idx"), F.col("root").alias("digest"))


@dataclass
class Manifest:
    """The trees of a dataset: ``rounds`` of the sources, ``tops`` over their subroots, and the root (None: no rows)."""

    rules: MerkleRules
    counts: DataFrame
    rounds: list[DataFrame]
    tops: list[DataFrame] = field(default_factory=list)
    root: bytes | None = None

    def leaves(self) -> DataFrame:
        """Every leaf: kept columns, ``digest``, ``subroot`` and its whole ``witness`` up to the root (binary)."""
        up = _lifted(self.tops)
        # a subroot's place among the sources' trees: its witness above it
        up = up.select(F.col("skey").alias("tree"), F.lit(0).cast("long").alias("block"), F.col("digest").alias("subroot"), F.col("witness").alias("above"))
        for rows in reversed(self.rounds[1:]):
            met = rows.join(up, ["tree", "block"])
            up = met.select("tree", F.col("idx").alias("block"), "subroot", F.concat("witness", "above").alias("above"))
        met = self.rounds[0].join(up, ["tree", "block"])
        return met.withColumn("witness", F.concat("witness", "above")).drop("above", "root", "block", "tree", "idx")


def _lifted(rounds: list[DataFrame]) -> DataFrame:
    """The first round's nodes with their witness through all rounds."""
    up = None
    for rows in reversed(rounds):
        if up is not None:
            rows = rows.join(up, ["tree", "block"]).withColumn("witness", F.concat("witness", "above")).drop("above")
        up = rows.select("tree", F.col("idx").alias("block"), F.col("witness").alias("above"))
        first = rows
    return first


def tree_key(source: Column) -> Column:
    """A never-null key that sorts like the source's bytes, null first."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def _leaf_rows(docs: DataFrame, fields: list[str], source: str, doc_id: str, keep: list[Column]) -> DataFrame:
    return docs.select(tree_key(F.col(source)).alias("tree"), F.col(doc_id).alias("leaf_order"), leaf_digest(*[F.col(c) for c in fields]).alias("digest"), *keep)


def _topped(spark: SparkSession, manifest: Manifest) -> Manifest:
    last = manifest.rounds[-1].filter("root is not null").select(F.lit("").alias("tree"), F.col("tree").alias("skey"), F.col("root").alias("digest"))
    tops = ranked(spark, last, "tree", [F.col("skey")], "merkle-subroots")
    manifest.tops = _grow(spark, tops, tops.groupBy("tree").agg(F.count(F.lit(1)).alias("n")), manifest.rules, "top")
    found = manifest.tops[-1].filter("root is not null").select("root").first()
    manifest.root = bytes(found["root"]) if found else None
    return manifest


def build(spark: SparkSession, docs: DataFrame, fields: list[str], source: str = "source", doc_id: str = "doc_id",
          keep: list[Column] = (), rules: MerkleRules = MerkleRules()) -> Manifest:
    """The manifest of ``docs``; ``keep`` are further columns to hold beside each leaf."""
    rows = stored(spark, _leaf_rows(docs, fields, source, doc_id, list(keep)), "merkle-leaves")
    rows = ranked(spark, rows, "tree", [F.col("leaf_order"), F.col("digest")], "merkle-ranked").drop("leaf_order")
    rows = stored(spark, rows, "merkle-placed")
    counts = stored(spark, rows.groupBy("tree").agg(F.count(F.lit(1)).alias("n")), "merkle-counts")
    return _topped(spark, Manifest(rules, counts, _grow(spark, rows, counts, rules, "rows")))


def append(spark: SparkSession, manifest: Manifest, docs: DataFrame, fields: list[str], source: str = "source", doc_id: str = "doc_id",
           keep: list[Column] = ()) -> Manifest:
    """``manifest`` with ``docs`` behind its rows, source by source; closed blocks are left as they are."""
    rows = stored(spark, _leaf_rows(docs, fields, source, doc_id, list(keep)), "merkle-leaves")
    rows = ranked(spark, rows, "tree", [F.col("leaf_order"), F.col("digest")], "merkle-ranked").drop("leaf_order", "n")
    old = manifest.counts.withColumnRenamed("n", "had")
    rows = rows.join(old, "tree", "left").withColumn("idx", F.col("idx") + F.coalesce("had", F.lit(0))).drop("had")
    rows = stored(spark, rows, "merkle-placed")
    counts = manifest.counts.unionByName(rows.groupBy("tree").agg(F.count(F.lit(1)).alias("n")))
    counts = stored(spark, counts.groupBy("tree").agg(F.sum("n").alias("n")), "merkle-counts")
    return _topped(spark, Manifest(manifest.rules, counts, _grow(spark, rows, counts, manifest.rules, "rows", manifest.rounds)))


def proofs(leaves: DataFrame, root: bytes | None, claimed: Column, keep: list[str]) -> DataFrame:
    """Per leaf: kept columns, leaf, subroot, root, proof_sha256, and the root folded from the ``claimed`` digest, verified or not."""
    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in leaves.select(*keep).schema]

    def run(batches):
        for pdf in batches:
            done = [fold(bytes(c), bytes(w)) for c, w in zip(pdf["claimed"], pdf["witness"])]
            yield pdf[keep].assign(
                leaf=[bytes(d).hex() for d in pdf["digest"]], subroot=[bytes(d).hex() for d in pdf["subroot"]],
                root=root.hex() if root else None, proof_sha256=[hashlib.sha256(p.encode()).hexdigest() for _, p in done],
                folded_root=[d.hex() for d, _ in done], verified=[d == root for d, _ in done])

    given = leaves.select(*keep, "digest", "subroot", "witness", claimed.alias("claimed"))
    return given.mapInPandas(run, ", ".join([*names, "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"]))
