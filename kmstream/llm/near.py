"""MinHash near-duplicates with odd sketches.

A document's set holds the hashes of its distinct word shingles. Equal sets
are one class from the start, so copies cost one row each and no pair. Classes
get a MinHash signature; its bands (32 of 5 rows: a pair at similarity 0.8 is
missed with probability 3e-6) are the candidate buckets, and all samples of the
signature are folded into an odd sketch, a parity bitmap. The population count
of the XOR of two sketches estimates a high similarity precisely, so a
candidate goes to the exact test on full sets unless its sketches put it
clearly below the threshold (4.5 standard errors).

Pairs inside a bucket are never listed as such. In a *star* round each member
is paired with one lead of its bucket, and of the leads of its buckets only the
one with the best sketch estimate is tested exactly; links give components, and
buckets whose members all lie in one component are done. What is left is tested
inside blocks of a bucket: every pair of members of different components, once
for all the buckets it shares. Only the members outside a bucket's largest
component are copied to several blocks, and only beyond ``block`` members. Blocks
return linked pairs of components only. So each pair of a bucket is in the end
linked, in one component already, or tested.

Scale: bucket leads are partial aggregations; members meet their leads, sets
and components by sort-merge joins that adaptive execution can split, so a
bucket or class with a third of all rows is no single task. Full sets are made
only for classes that have a candidate. All tables that are read twice are
written below the shared checkpoint folder; nothing is collected.

Defined results: null or empty text = empty set, linked with nothing, kept;
fewer words than a shingle = the whole sequence is the one shingle; repeated
rows are copies of each other; the component of rows without an id is the
smallest id among its members, null if there is none; ties cannot arise (the
smallest id wins); an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kmstream.llm.common import WORD, fresh, stored, text_batches
from kmstream.llm.graph import connected_components


@dataclass(frozen=True)
class NearRules:
    words: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 5
    bits: int = 512
    errors: float = 4.5
    block: int = 2048

    def widest(self) -> int:
        """The largest XOR count of two sketches that still goes to the exact test."""
        k, j = self.bands * self.rows, self.percent / 100
        low = max(0.0, j - self.errors * math.sqrt(j * (1 - j) / k))
        flips = 2 * k * (1 - low)
        mean = self.bits / 2 * (1 - (1 - 2 / self.bits) ** flips)
        return math.ceil(mean + 2 * math.sqrt(mean))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) > 400_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _constants(n: int, seed: int) -> np.ndarray:
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def shingle_set(text: str | None, n: int, hashes: dict) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles of a text; A-Z are lower-cased, other letters kept."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    get = hashes.__getitem__
    ids = np.fromiter(map(get, words), np.uint64, len(words))
    by = _constants(n, 7)
    if len(ids) < n:
        return _mix(np.atleast_1d((ids * by[:len(ids)]).sum(dtype=np.uint64) + np.uint64(len(ids))))
    last = len(ids) - n + 1
    out = ids[:last] * by[0]
    for k in range(1, n):
        out += ids[k:k + last] * by[k]
    return np.unique(_mix(out))


class _Signer:
    def __init__(self, rules: NearRules):
        k = rules.bands * rules.rows
        self.rules, self.a, self.b = rules, _constants(k, 11)[:, None], _constants(k, 13)[:, None]
        self.by, self.band = _constants(rules.rows, 17), _constants(rules.bands, 19)
        self.place = _constants(k, 23)
        self.shift = np.uint64(64 - (rules.bits - 1).bit_length())

    def signature(self, items: np.ndarray) -> np.ndarray:
        low = None
        for i in range(0, len(items), 2048):
            part = (self.a * items[i:i + 2048] + self.b).min(axis=1)
            low = part if low is None else np.minimum(low, part)
        return low

    def keys_and_sketch(self, items: np.ndarray) -> tuple[list, list]:
        low = self.signature(items)
        keys = _mix((low.reshape(self.rules.bands, -1) * self.by).sum(axis=1, dtype=np.uint64) + self.band).view(np.int64)
        at = (_mix(low + self.place) >> self.shift).astype(np.int64)
        odd = (np.bincount(at, minlength=self.rules.bits) & 1).astype(np.uint8)
        return keys.tolist(), np.packbits(odd).view(np.int64).tolist()


def signed(docs: DataFrame, rules: NearRules, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, fp, text_hash, keys, sketch) per row; the last four are null for an empty set."""

    def run(batches):
        import xxhash
        hashes, signer = _WordHashes(), _Signer(rules)
        for pdf in batches:
            for i in range(0, len(pdf), 1000):
                part, rows = pdf.iloc[i:i + 1000], []
                for t in part["text"]:
                    items = shingle_set(t, rules.words, hashes)
                    if len(items):
                        rows.append((len(items), xxhash.xxh3_128_digest(items.tobytes()), *signer.keys_and_sketch(items)))
                    else:
                        rows.append((0, None, None, None))
                out = pd.DataFrame(rows, columns=["n_shingles", "fp", "keys", "sketch"], index=part.index)
                yield part.drop(columns="text").join(out)

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"),
                        F.col(text).cast("string").alias("text"))
    return given.mapInPandas(run, "doc_id long, text_hash long, n_shingles long, fp binary, keys array<long>, sketch array<long>")


def _full_sets(docs: DataFrame, wanted: DataFrame, rules: NearRules, doc_id: str, text: str) -> DataFrame:
    """(node, items) of the wanted classes (node, fp, doc_id, text_hash): the texts are read again by id and text of one member.

    Both are needed: documents without an id, or with one repeated id, are as many as they like.
    """

    def run(batches):
        import xxhash
        hashes = _WordHashes()
        for pdf in batches:
            for i in range(0, len(pdf), 500):
                rows = []
                for node, fp, t in pdf.iloc[i:i + 500][["node", "fp", "text"]].itertuples(index=False):
                    items = shingle_set(t, rules.words, hashes)
                    if xxhash.xxh3_128_digest(items.tobytes()) == bytes(fp):
                        rows.append((node, items.view(np.int64)))
                yield pd.DataFrame(rows, columns=["node", "items"])

    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(F.col(text)).alias("h"), F.col(text).cast("string").alias("text"))
    found = texts.join(wanted, (texts["h"] == wanted["text_hash"]) & texts["id"].eqNullSafe(wanted["doc_id"])).select("node", "fp", "text")
    return found.mapInPandas(run, "node long, items array<long>")


def _labelled(spark: SparkSession, docs: DataFrame, rules: NearRules, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """((doc_id, text_hash, n_shingles, component) per row, component null without words; (component, component_id))."""
    text_batches(spark)
    rows = stored(spark, signed(docs, rules, doc_id, text), "near-signed")
    full = rows.filter("n_shingles > 0")
    member = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    classes = (full.groupBy("fp").agg(member.alias("of"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch"))
               .select("fp", "of.doc_id", "of.text_hash", "n", "keys", "sketch").withColumn("node", F.monotonically_increasing_id()))
    classes = stored(spark, classes, "near-classes")
    first, then = _components(spark, docs, classes, rules, doc_id, text)
    ids = classes.select("node", "fp", "doc_id").join(first, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
    ids = ids.join(then.select(F.col("node").alias("c"), "component"), "c", "left")
    ids = stored(spark, ids.select("fp", "doc_id", F.coalesce("component", "c").alias("component")), "near-ids")
    linked = full.select("doc_id", "text_hash", "n_shingles", "fp").join(ids.select("fp", "component"), "fp").drop("fp")
    alone = rows.filter("n_shingles = 0").select("doc_id", "text_hash", "n_shingles", F.lit(None).cast("long").alias("component"))
    return linked.unionByName(alone), ids.groupBy("component").agg(F.min("doc_id").alias("component_id"))


def near_duplicates(spark: SparkSession, docs: DataFrame, rules: NearRules = NearRules(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) per row of ``docs``."""
    rows, names = _labelled(spark, docs, rules, doc_id, text)
    named = rows.filter("component is not null").join(names, "component").drop("component")
    alone = rows.filter("component is null").drop("component").withColumn("component_id", F.col("doc_id"))
    return named.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(spark: SparkSession, docs: DataFrame, rules: NearRules = NearRules(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay; same columns.

    Of each component one row stays, the one with the smallest id (rows without an id
    last), then text hash; of equal ones any. All rows without words stay.
    """
    i, h, n = (fresh(c, docs.columns) for c in ("near_id", "near_hash", "near_nth"))
    missing = F.lit(-(1 << 62))
    rows, _ = _labelled(spark, docs, rules, doc_id, text)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("of")
    kept = rows.filter("component is not null").groupBy("component").agg(best)
    kept = kept.select(F.coalesce("of.doc_id", missing).alias(i), F.col("of.text_hash").alias(h))
    keyed = docs.withColumns({i: F.coalesce(F.col(doc_id).cast("long"), missing), h: F.xxhash64(F.col(text))})
    words = F.coalesce(F.col(text).cast("string").rlike(WORD), F.lit(False))
    one = keyed.filter(words).withColumn(n, F.row_number().over(W.partitionBy(i, h).orderBy(i))).filter(F.col(n) == 1).drop(n)
    stay = one.join(kept, [i, h], "left_semi").unionByName(keyed.filter(~words))
    return stay.select(*[F.col(f"`{c}`") for c in docs.columns])


def _components(spark: SparkSession, docs: DataFrame, classes: DataFrame, rules: NearRules, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """((node, component) of the star round, (node, component) among those components)."""
    sketches = classes.select("node", "sketch", "n")
    member = classes.select(F.explode("keys").alias("key"), "node")
    shared = member.groupBy("key").agg(F.count(F.lit(1)).alias("k"), _lead()).filter("k > 1").select("key", "lead")
    buckets = member.join(shared, "key").withColumn("lead", F.col("lead").bitwiseXOR(_mask()))
    buckets = stored(spark, buckets, "near-buckets")  # key, node, lead

    nodes = buckets.select("node").distinct()
    wanted = classes.join(nodes, "node", "left_semi").select("node", "fp", "doc_id", "text_hash")
    sets = stored(spark, _full_sets(docs, wanted, rules, doc_id, text).dropDuplicates(["node"]), "near-sets")

    near = _estimated(buckets.filter("node <> lead").select("node", "lead").distinct(), sketches, rules)
    best = near.groupBy("node").agg(F.min(F.struct("x", "lead")).alias("best"))
    tested = best.select(F.col("node").alias("a"), F.col("best.lead").alias("b"))
    first = stored(spark, connected_components(spark, stored(spark, _confirmed(tested, sets, rules), "near-links")), "near-first")

    known = buckets.select("key", "node").join(first, "node", "left").select("key", "node", F.coalesce("component", "node").alias("nc"))
    known = stored(spark, known, "near-known")
    across = stored(spark, _across(spark, known, classes, sets, rules), "near-across")
    return first, stored(spark, connected_components(spark, across), "near-then")


def _mask():
    return F.xxhash64(F.col("key")).bitwiseAND(F.lit((1 << 62) - 1))


def _lead():
    """A member of the bucket, another one for each key: the smallest id under a mask of bits."""
    return F.min(F.col("node").bitwiseXOR(_mask())).alias("lead")


def _apart(a: str, b: str, words: int):
    """Population count of the XOR of two sketches."""
    bits = [F.bit_count(F.col(f"{a}")[i].bitwiseXOR(F.col(f"{b}")[i])) for i in range(words)]
    out = bits[0]
    for x in bits[1:]:
        out = out + x
    return out


def _estimated(pairs: DataFrame, sketches: DataFrame, rules: NearRules) -> DataFrame:
    """(node, lead, x): the pairs whose sketches and set sizes allow the threshold."""
    one = sketches.select("node", F.col("sketch").alias("s"), F.col("n").alias("n1"))
    two = sketches.select(F.col("node").alias("lead"), F.col("sketch").alias("t"), F.col("n").alias("n2"))
    met = pairs.join(one, "node").join(two, "lead")
    x = _apart("s", "t", rules.bits // 64)
    fits = 100 * F.least("n1", "n2") >= rules.percent * F.greatest("n1", "n2")
    return met.filter(fits).select("node", "lead", x.alias("x")).filter(F.col("x") <= rules.widest())


def _across(spark: SparkSession, known: DataFrame, classes: DataFrame, sets: DataFrame, rules: NearRules) -> DataFrame:
    """(a, b): linked components, from the buckets of (key, node, nc) that hold several.

    The members outside a bucket's largest component are its *strangers*; every pair
    to test has one. Strangers are the rows and all members the columns of a matrix
    that is cut into blocks of ``block`` a side: a member is copied once per block of
    strangers, a stranger once per block of members. The first pass keeps those that
    have a partner by sketch; only they get their full sets, and the second pass tests
    their pairs exactly. No pair leaves a block unless it links two components.
    """
    per = known.groupBy("key", "nc").agg(F.count(F.lit(1)).alias("k"))
    mixed = (per.groupBy("key").agg(F.sum("k").alias("m"), F.max(F.struct("k", "nc")).alias("top")).filter("m > top.k")
             .select("key", F.col("top.nc").alias("main"), F.ceil(F.col("m") / rules.block).cast("int").alias("wide"),
                     F.ceil((F.col("m") - F.col("top.k")) / rules.block).cast("int").alias("high")))
    at = known.join(mixed, "key").withColumns({
        "r": F.when(F.col("nc") != F.col("main"), F.pmod(F.xxhash64("node", F.lit(1)), F.col("high")).cast("int")).otherwise(F.lit(-1)),
        "c": F.pmod(F.xxhash64("node"), F.col("wide")).cast("int")})
    as_column = F.transform(F.sequence(F.lit(0), F.col("high") - 1), lambda i: F.struct(i.alias("i"), F.col("c").alias("j")))
    as_row = F.transform(F.sequence(F.lit(0), F.col("wide") - 1), lambda j: F.struct(F.col("r").alias("i"), j.alias("j")))
    cells = F.when(F.col("r") < 0, as_column).otherwise(F.array_union(as_column, as_row))
    rows = at.withColumn("cell", F.explode(cells)).select("key", "cell.i", "cell.j", "r", "c", "node", "nc")
    rich = rows.join(classes.select("node", "n", "keys", "sketch"), "node")
    kind = "key long, i int, j int, r int, c int, node long, nc long, n long, keys array<long>, sketch array<long>"
    names = [x.split()[0] for x in kind.split(", ")]

    def with_partner(pdf: pd.DataFrame) -> pd.DataFrame:
        cells, edges = _arrays(pdf)
        found = [np.union1d(*_may_link(cells, lo, hi, rules)[:2]) for lo, hi in edges]
        return pdf.iloc[np.concatenate(found)]

    some = stored(spark, _by_cell(rich.select(names), with_partner, kind), "near-partners")

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        cells, edges = _arrays(pdf)
        found = [x for lo, hi in edges for x in _block_links(cells, lo, hi, rules)]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return _by_cell(some.join(sets, "node"), links, "a long, b long").distinct()


def _by_cell(rows: DataFrame, f, kind: str) -> DataFrame:
    """``f`` over the rows of whole blocks (key, i, j), many small blocks at a time; a block never spans two calls."""
    names = rows.columns

    def run(batches):
        held = None
        for pdf in batches:
            if held is not None:
                pdf = pd.concat([held, pdf], ignore_index=True)
            if pdf.empty:
                continue
            last = pdf[["key", "i", "j"]].iloc[-1]
            open_ = ((pdf["key"] == last["key"]) & (pdf["i"] == last["i"]) & (pdf["j"] == last["j"])).to_numpy()
            done, held = pdf[~open_], pdf[open_]
            if len(done):
                yield f(done)
        if held is not None and len(held):
            yield f(held)

    dealt = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.select(names).mapInPandas(run, kind)


def _arrays(pdf: pd.DataFrame) -> tuple[dict, list[tuple[int, int]]]:
    """The columns as arrays, and the row ranges of the blocks."""
    cells = {x: pdf[x].to_numpy(np.int64) for x in ("key", "i", "j", "r", "c", "node", "nc", "n")}
    cells |= {"keys": np.stack(pdf["keys"].to_numpy()), "sketch": np.stack(pdf["sketch"].to_numpy()).view(np.uint64)}
    if "items" in pdf:
        cells["items"] = pdf["items"].tolist()
    new = np.zeros(len(pdf), bool)
    new[0] = True
    for x in ("key", "i", "j"):
        new[1:] |= cells[x][1:] != cells[x][:-1]
    at = [*np.flatnonzero(new).tolist(), len(pdf)]
    return cells, list(zip(at, at[1:]))


def _may_link(cells: dict, lo: int, hi: int, rules: NearRules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stranger, member, XOR count) by place, strangers ascending: the pairs of a block that belong to this bucket's test -- other
    component, sketches and sizes allow it, no earlier band shared, of two strangers the one with the greater node first."""
    rows = lo + np.flatnonzero(cells["r"][lo:hi] == cells["i"][lo])
    cols = lo + np.flatnonzero(cells["c"][lo:hi] == cells["j"][lo])
    bits, n, nc, node, r = (cells[x] for x in ("sketch", "n", "nc", "node", "r"))
    found = []
    for part in np.array_split(rows, max(1, len(rows) * len(cols) >> 20)):
        apart = np.zeros((len(part), len(cols)), np.int16)
        for w in range(bits.shape[1]):
            apart += np.bitwise_count(bits[part, w, None] ^ bits[None, cols, w])
        x, y = np.nonzero(apart <= rules.widest())
        a, b, gap = part[x], cols[y], apart[x, y]
        ok = (nc[a] != nc[b]) & ((r[b] < 0) | (node[a] > node[b]))
        ok &= 100 * np.minimum(n[a], n[b]) >= rules.percent * np.maximum(n[a], n[b])
        found.append((a[ok], b[ok], gap[ok]))
    a, b, gap = (np.concatenate(x) for x in zip(*found)) if len(found) > 1 else found[0]
    if len(a):
        keys = cells["keys"]
        band = int((keys[lo:hi] == cells["key"][lo]).all(axis=0).argmax())
        ok = ~(keys[a, :band] == keys[b, :band]).any(axis=1) if len(a) < 4096 else np.ones(len(a), bool)
        for t in range(band if len(a) >= 4096 else 0):
            ok &= keys[a, t] != keys[b, t]
        a, b, gap = a[ok], b[ok], gap[ok]
    return a, b, gap


def _block_links(cells: dict, lo: int, hi: int, rules: NearRules) -> list[tuple[int, int]]:
    """Exact test of a block's pairs: the pairs of components that a link joins.

    A stranger is tested with its nearest member of each component first, and with
    the others of a component only if that is not linked by then.
    """
    a, b, gap = _may_link(cells, lo, hi, rules)
    if not len(a):
        return []
    items, nc = cells["items"][lo:hi], cells["nc"][lo:hi]
    a, b = a - lo, b - lo
    size = np.fromiter(map(len, items), np.int64, len(items))
    first = np.cumsum(size) - size
    names, codes = np.unique(np.concatenate(items), return_inverse=True)
    mark = np.zeros(len(names), bool)
    up: dict = {}
    found = set()

    def top(x):
        while x in up:
            x = up[x]
        return x

    def test(row, cols):
        """Which of the columns are linked with the row, whose items are marked."""
        many = size[cols]
        begin = np.cumsum(many) - many
        at = np.arange(int(many.sum())) - np.repeat(begin, many) + np.repeat(first[cols], many)
        common = np.add.reduceat(mark[codes[at]].astype(np.int64), begin)
        return cols[100 * common >= rules.percent * (size[row] + many - common)]

    def join(row, cols):
        for c in cols:
            x, y = sorted((top(int(nc[row])), top(int(nc[c]))))
            if x != y:
                up[y] = x
                found.add((max(int(nc[row]), int(nc[c])), min(int(nc[row]), int(nc[c]))))

    edges = np.flatnonzero(np.r_[True, a[1:] != a[:-1], True])
    for x, y in zip(edges, edges[1:]):    # the pairs of one stranger
        row = a[x]
        cols = b[x:y][np.argsort(gap[x:y], kind="stable")]
        own = codes[first[row]:first[row] + size[row]]
        mark[own] = True
        kinds, nearest, kind = np.unique(nc[cols], return_index=True, return_inverse=True)
        join(row, test(row, cols[np.sort(nearest)]))
        if len(cols) > len(nearest):
            mine = top(int(nc[row]))
            open_ = np.array([top(int(k)) != mine for k in kinds])[kind]
            open_[nearest] = False
            if open_.any():
                join(row, test(row, cols[open_]))
        mark[own] = False
    return sorted(found)


def _confirmed(pairs: DataFrame, sets: DataFrame, rules: NearRules) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    one = sets.select(F.col("node").alias("a"), F.col("items").alias("p"))
    two = sets.select(F.col("node").alias("b"), F.col("items").alias("q"))
    met = pairs.join(one, "a").join(two, "b")
    common = F.size(F.array_intersect("p", "q")).cast("long")
    sized = met.select("a", "b", common.alias("i"), (F.size("p") + F.size("q")).cast("long").alias("total"))
    return sized.filter(100 * F.col("i") >= rules.percent * (F.col("total") - F.col("i"))).select("a", "b")
