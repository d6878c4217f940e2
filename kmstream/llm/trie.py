"""Prefix trie of conversations from sorted LCPs and sparse-table range minima.

A conversation is the sequence of its turns; every distinct prefix of a sequence is a
node of the trie, and the conversations that start with it are its members. Sorted by
their turns, the members of a node are neighbours: the prefix of depth d of the i-th
conversation reaches left and right as long as the LCP of neighbours (how many first
turns they share) stays at least d. A sparse table holds the minima of the LCPs over
all runs of a power of two; each candidate prefix finds its left and its right end on
its own, by binary search in that table. No stack, no order among candidates. The
figures of a node then are differences of running sums over its interval:

* a conversation opens the nodes deeper than the LCP with its forerunner, so what is
  counted once per node (words, children) is counted where the node opens;
* a childless node ends where the LCP with the next conversation is below the whole
  length, and is counted there;
* conversations that end at a node come first in its interval, ids ascending.

Distribution: conversations are range-partitioned by (turns, id) and cut into blocks
of ``block`` rows; each block also gets its neighbours' turns, so it knows whether a
node goes on beyond its borders. Nodes inside one block are done there. Pieces of the
others -- at most two chains of prefixes per block -- carry the same sums and are
added up by prefix in a partial aggregation, so the root, or a conversation that a
third of all rows repeat, is one row per block before any shuffle. The ids that end at
such a node are hashed in order from one row of joined ids per block.

Turns travel as 128-bit digests; texts are read once. A conversation's digests (some
bytes a turn) are held in one task, conversations of one block together.

Defined results: rows without conversation id belong to no conversation and are left
out; null role or text is empty; turns are ordered by number, null first, equal ones
by digest; a conversation may have no turns and then ends at the root; an empty table
has no nodes; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kmstream.llm.common import WORD, numbered, stored

#: Bytes of a turn's digest.
_TURN = 16
#: Rows of a block, as a power of two.
BLOCK_BITS = 10


def sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): the turns of every conversation in order, as (place, digest, words)."""
    r, t = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    digest = F.substring(F.sha2(F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, t), 256), 1, 2 * _TURN)
    rows = turns.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("place"), digest.alias("digest"),
        F.regexp_count(t, F.lit(WORD)).cast("long").alias("words"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "digest", "words"))).alias("turns"))


def rebuilt(whole: DataFrame, every: int = 20, most: int = 3) -> DataFrame:
    """Sequences whose first h turns come from the conversation ``id - id % every``; h = crc32(id) mod (most + 1)."""
    heads = whole.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    own = whole.withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
    own = own.withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).cast("int"))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return own.join(heads, "base", "left").select("conv_id", F.when(F.col("head").isNull(), rest).otherwise(F.concat(F.slice("head", F.lit(1), F.col("h")), rest)).alias("turns"))


def _common(a: bytes | None, b: bytes | None) -> int:
    """How many first turns two paths share; -1 if one is missing."""
    if a is None or b is None:
        return -1
    k = min(len(a), len(b))
    if a[:k] == b[:k]:
        return k // _TURN
    x, y = (np.frombuffer(p, np.uint64, k // 8).reshape(-1, 2) for p in (a, b))
    return int((x != y).any(axis=1).argmax())


class SparseTable:
    """Minima over all runs of a power of two."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 * (1 << (len(self.rows) - 1)) <= len(values):
            step = 1 << (len(self.rows) - 1)
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-step], last[step:]))

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minima of the values lo..hi (inclusive)."""
        out = np.empty(len(lo), self.rows[0].dtype)
        level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.rows[k][lo[at]], self.rows[k][hi[at] - (1 << int(k)) + 1])
        return out

    def reach_right(self, at: np.ndarray, bound: np.ndarray, last: int) -> np.ndarray:
        """The largest r <= last for which all values at+1..r are at least the bound."""
        r = at.copy()
        for k in range(len(self.rows) - 1, -1, -1):
            step = 1 << k
            ok = r + step <= last
            ok[ok] = self.rows[k][r[ok] + 1] >= bound[ok]
            r[ok] += step
        return r

    def reach_left(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The smallest l >= 0 for which all values l+1..at are at least the bound."""
        left = at.copy()
        for k in range(len(self.rows) - 1, -1, -1):
            step = 1 << k
            ok = left - step >= 0
            ok[ok] = self.rows[k][left[ok] - step + 1] >= bound[ok]
            left[ok] -= step
        return left


def _sha(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def _prefix_keys(path: bytes, depth: int) -> list[bytes]:
    h = hashlib.sha256()
    out = [h.digest()[:16]]
    for d in range(depth):
        h.update(path[d * _TURN:(d + 1) * _TURN])
        out.append(h.copy().digest()[:16])
    return out


PARTS = ("key binary, parent_key binary, block long, depth long, conv_id long, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, all_words long, own_words long, ends string, ends_sha256 string")


def block_nodes(paths: list[bytes], ids: np.ndarray, words: list, block: int, before: bytes | None, after: bytes | None) -> pd.DataFrame:
    """The nodes (key null) and pieces of nodes (key: the prefix) of a block of sorted conversations."""
    n = len(paths)
    size = np.array([len(p) // _TURN for p in paths], np.int64)
    lcp = np.array([_common(a, b) for a, b in zip([before, *paths], [*paths, after])], np.int64)   # lcp[n]: towards the next block
    table = SparseTable(lcp)

    # running words of every conversation, one after another: word_at[i] + t = words of the first t turns
    word_at = np.cumsum(np.r_[0, size + 1])[:-1]
    upto = np.zeros(int((size + 1).sum()), np.int64)
    for i, w in enumerate(words):
        if size[i]:
            np.cumsum(np.asarray(w, np.int64), out=upto[word_at[i] + 1:word_at[i] + 1 + size[i]])
    total = upto[word_at + size]

    # candidates: the nodes each conversation opens; the first one also goes on with those of the block before
    low = lcp[:n] + 1
    low[0] = 0
    many = size - low + 1
    first = np.cumsum(many) - many
    lo = np.repeat(np.arange(n), many)
    d = np.arange(int(many.sum())) - np.repeat(first, many) + low[lo]
    r = table.reach_right(lo, d, n - 1)
    opens = (lo > 0) | (d > lcp[0])
    ends_here = ~((r == n - 1) & (lcp[n] >= d))
    done = opens & ends_here

    def between(per_row):
        s = np.r_[0, np.cumsum(per_row)]
        return s[r + 1] - s[lo]

    above = upto[word_at[lo] + np.maximum(d - 1, 0)]                     # words before the node's own last turn
    all_words = between(total) - (r - lo + 1) * above
    fresh = total - upto[word_at + np.maximum(lcp[:n], 0)]              # words of the nodes a conversation opens
    own_words = between(fresh) - fresh[lo] + np.where(opens, total[lo] - above, fresh[lo])
    leaves = between((lcp[1:] < size).astype(np.int64))

    # parents: the candidate above, or the node of the LCP, whose left end is searched
    up_l = table.reach_left(np.arange(n), np.maximum(lcp[:n], 0))
    parent = np.arange(len(d)) - 1
    branch = (d == low[lo]) & (lo > 0)
    j = lo[branch]
    parent[branch] = first[up_l[j]] + lcp[j] - low[up_l[j]]
    parent[d == 0] = -1
    children = np.bincount(parent[opens & (parent >= 0)], minlength=len(d))

    # conversations that end at a node: a run of equal paths from its left end
    equal = np.array([paths[i] == paths[i - 1] for i in range(1, n)] + [False])
    stops = np.flatnonzero(~equal)
    run_end = stops[np.searchsorted(stops, np.arange(n))]
    ending = np.where(size[lo] == d, run_end[lo] - lo + 1, 0)

    least = SparseTable(ids).least(lo, r)
    keys_first, keys_last = _prefix_keys(paths[0], max(int(lcp[0]), 0)), _prefix_keys(paths[-1], max(int(lcp[n]), 0))

    def key(c):
        return keys_first[d[c]] if lo[c] == 0 and not opens[c] else keys_last[d[c]]

    names = ids.tolist()
    out = {k: [None] * len(d) for k in ("key", "parent_key", "parent_conv_id", "ends", "ends_sha256")}
    nothing = _sha("")
    for c in range(len(d)):
        p = parent[c]
        if p >= 0:
            if done[p]:
                out["parent_conv_id"][c] = int(least[p])
            else:
                out["parent_key"][c] = key(p)
        text = ",".join(map(str, names[lo[c]:lo[c] + ending[c]])) if ending[c] else None
        if done[c]:
            out["ends_sha256"][c] = _sha(text) if text else nothing
        else:
            out["key"][c], out["ends"][c] = key(c), text
    frame = pd.DataFrame({**out, "block": block, "depth": d, "conv_id": least, "n_convs": r - lo + 1, "n_children": children,
                          "n_leaves": leaves, "all_words": all_words, "own_words": own_words})
    frame["parent_conv_id"] = frame["parent_conv_id"].astype("Int64")
    return frame[[x.split()[0] for x in PARTS.split(", ")]]


def _edges(rows: DataFrame) -> DataFrame:
    """(at, before, after): the turns of the conversations beside each block, null at the ends of the table.

    Windows see one row per block, inside a partition, and one row per partition.
    """
    blocks = rows.groupBy("block").agg(F.min_by("path", "m").alias("head"), F.max_by("path", "m").alias("tail")).withColumn("pid", F.shiftright("block", 33 - BLOCK_BITS))
    parts = blocks.groupBy("pid").agg(F.min_by("head", "block").alias("head"), F.max_by("tail", "block").alias("tail"))
    over = W.orderBy("pid")
    parts = parts.select("pid", F.lag("tail").over(over).alias("part_before"), F.lead("head").over(over).alias("part_after"))
    inside = W.partitionBy("pid").orderBy("block")
    met = blocks.withColumns({"before": F.lag("tail").over(inside), "after": F.lead("head").over(inside)}).join(parts, "pid")
    return met.select(F.col("block").alias("at"), F.coalesce("before", "part_before").alias("before"), F.coalesce("after", "part_after").alias("after"))


def prefix_trie(spark: SparkSession, whole: DataFrame) -> DataFrame:
    """The nodes of the trie of ``whole`` (conv_id, turns): conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    flat = whole.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["words"]).alias("words"))
    rows = numbered(spark, stored(spark, flat, "trie-paths"), [F.col("path"), F.col("conv_id")], "trie-sorted")
    rows = rows.withColumn("block", F.shiftright("m", BLOCK_BITS))

    def nodes(key, pdf: pd.DataFrame, edge: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("m")
        beside = [None if x is None else bytes(x) for x in edge[["before", "after"]].iloc[0]]
        return block_nodes([bytes(p) for p in pdf["path"]], pdf["conv_id"].to_numpy(np.int64), pdf["words"].tolist(), int(key[0]), *beside)

    parts = rows.groupBy("block").cogroup(_edges(rows).groupBy("at")).applyInPandas(nodes, PARTS)
    parts = stored(spark, parts, "trie-parts")
    figures = ["n_convs", "n_children", "n_leaves", "all_words", "own_words"]

    pieces = parts.filter("key is not null")
    merged = pieces.groupBy("key").agg(F.first("parent_key").alias("parent_key"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
                                       *[F.sum(c).alias(c) for c in figures])
    merged = stored(spark, merged.join(_ends(pieces), "key", "left"), "trie-merged")
    one = parts.filter("key is null").select("parent_key", "parent_conv_id", "depth", "conv_id", *figures, "ends_sha256")
    far = merged.select("parent_key", F.lit(None).cast("long").alias("parent_conv_id"), "depth", "conv_id", *figures, F.coalesce("ends_sha256", F.lit(_sha(""))).alias("ends_sha256"))
    known = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("up"))
    met = one.unionByName(far).join(known, "parent_key", "left")
    return met.select("conv_id", "depth", F.coalesce("parent_conv_id", "up").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                      (F.col("all_words") - F.col("own_words")).alias("saved_tokens"), "ends_sha256")


def _ends(pieces: DataFrame) -> DataFrame:
    """(key, ends_sha256): the joined ids of a node's pieces, hashed block by block in order as they stream by."""

    def run(batches):
        now, h = None, None
        for pdf in batches:
            out = []
            for key, text in zip(pdf["key"], pdf["ends"]):
                key = bytes(key)
                if key != now:
                    if now is not None:
                        out.append((now, h.hexdigest()))
                    now, h = key, hashlib.sha256()
                else:
                    h.update(b",")
                h.update(text.encode())
            yield pd.DataFrame(out, columns=["key", "ends_sha256"])
        if now is not None:
            yield pd.DataFrame([(now, h.hexdigest())], columns=["key", "ends_sha256"])

    some = pieces.filter("ends is not null").select("key", "block", "ends")
    return some.repartition("key").sortWithinPartitions("key", "block").mapInPandas(run, "key binary, ends_sha256 string")
