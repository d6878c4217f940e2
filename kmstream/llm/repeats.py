"""Exact removal of repeated byte strings by a depth-limited radix sort.

Every byte covered by a ``length``-byte string that also starts anywhere else
goes. Suffixes need only be told apart through ``length`` bytes, so they are
split by most-significant-digit passes and a group is dropped as soon as it
has one member:

1. Not every suffix is sorted. The start ``i`` of a window is led by an
   *anchor*: the leftmost smallest hash among the first ``reach`` k-grams of
   the window. It depends on the window's bytes only, so equal windows have
   equal anchors at equal distances, and sorting the suffixes at anchors (one
   in about ``reach / 2`` bytes) loses none. First digit: the bytes from the
   anchor that all its windows share. Digits met once are dropped.
2. Second digit: all bytes of all windows an anchor leads. Met twice: all of
   those windows are repeated, settled as one interval.
3. Where an unsettled anchor is left, one anchor per distinct second digit is
   cut into runs of ``group`` starts, which go through the same two digits --
   the bytes all windows of the run share, then all of their bytes -- and what
   is left of those into single starts, whose digit is the window itself.
   Equal groups are exactly the repeated windows.

Digits are 64-bit polynomial hashes; each pass groups by the digits so far, so
a decision rests on 128 bits.

Scale: counts of digits are partial aggregations and members meet the repeated
digits by sort-merge semi joins. A document sends every digit, and every run of
equal digits with the list of its places, once: a passage that fills a document
is one row there, and a digit has at most as many rows as documents hold it.
Texts travel once,
compressed, and then only those of documents with a repeated first digit.
Per-document lists are bounded by the document. Arrays are made for blocks of
about a MB of text. Tables read twice are written below the shared folder.

Defined results: null or short text = nothing removed; repeated rows are
documents of their own (so they lose whatever is at least ``length`` long);
rows without id are treated like others; overlapping windows count; texts are
judged as given, not on what is left; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kmstream.llm.common import fresh, stored, text_batches

BLOCK = 1 << 20


@dataclass(frozen=True)
class RepeatRules:
    length: int = 400
    reach: int = 128   # a power of two, at most length - gram + 1
    gram: int = 16
    group: int = 16    # starts that are told apart together before they are told apart one by one


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class _Hasher:
    """Rolling hashes and anchors of a block of concatenated texts."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self, rules: RepeatRules):
        self.rules = rules
        seed = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
        self.table = _mix(_mix(seed)) | np.uint64(1)
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        def powers(base):
            out = np.full(n, base, np.uint64)
            out[0] = 1
            return np.cumprod(out)
        self.up, self.down = powers(self.BASE), powers(pow(self.BASE, -1, 1 << 64))

    def load(self, texts: list[bytes]) -> None:
        data = np.frombuffer(b"".join(texts), np.uint8)
        n = len(data)
        if n >= len(self.up):
            self._grow(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.table[data] * self.up[:n], out=self.sums[1:])
        ends = np.cumsum([len(t) for t in texts])
        self.begin, self.n = np.r_[0, ends[:-1]].astype(np.int64), n
        # valid window starts, document by document
        L = self.rules.length
        counts = np.maximum(np.diff(np.r_[0, ends]) - L + 1, 0)
        self.starts = np.repeat(self.begin, counts) + (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))
        self.start_doc = np.repeat(np.arange(len(texts)), counts)

    def hashes(self, at: np.ndarray, size) -> np.ndarray:
        """Hashes of the strings of ``size`` bytes (a number or one per place) at the given places."""
        return _mix((self.sums[at + size] - self.sums[at]) * self.down[at])

    def anchors(self) -> tuple[np.ndarray, ...]:
        """(anchor, document, first start, number of starts) of every anchor of the block."""
        r = self.rules
        if not len(self.starts):
            none = np.empty(0, np.int64)
            return none, none, none, none
        grams = self.n - r.gram + 1
        low = _mix((self.sums[r.gram:] - self.sums[:grams]) * self.down[:grams])
        bits = np.uint64(max(1, int(self.n).bit_length()))
        mask = (np.uint64(1) << bits) - np.uint64(1)
        low = (low & ~mask) | np.arange(grams, dtype=np.uint64)
        step = 1
        while step < r.reach:
            low[:-step] = np.minimum(low[:-step], low[step:])
            step *= 2
        lead = (low[self.starts] & mask).astype(np.int64)
        new = np.flatnonzero(np.r_[True, (lead[1:] != lead[:-1]) | (self.start_doc[1:] != self.start_doc[:-1])])
        return lead[new], self.start_doc[new], self.starts[new], np.diff(np.r_[new, len(lead)])

    def shared(self, anchor: np.ndarray) -> np.ndarray:
        """First digit: the bytes from the anchor that every window it may lead holds."""
        return self.hashes(anchor, self.rules.length - self.rules.reach + 1).view(np.int64)


def _blocks(texts: list[bytes]):
    """(first, texts) of runs of whole texts of about ``BLOCK`` bytes."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BLOCK:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, texts[first:]


def _bytes(text) -> bytes:
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def repeated_spans(spark: SparkSession, docs: DataFrame, rules: RepeatRules = RepeatRules(), doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(affected, clean): documents with a repeated window as (doc_id, text_hash, z, spans) -- z the
    compressed bytes, spans the flat list of maximal removed runs -- and the others as
    (doc_id, text_hash, n_bytes, sha)."""
    text_batches(spark)
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).cast("string").alias("text"))

    def first(batches):
        hasher = _Hasher(rules)
        for pdf in batches:
            raw = [_bytes(t) for t in pdf["text"]]
            for at, part in _blocks(raw):
                hasher.load(part)
                anchor, doc, _, _ = hasher.anchors()
                digits, again = _by_document(doc, hasher.shared(anchor), len(part))
                out = pdf.iloc[at:at + len(part)][["doc_id", "text_hash"]]
                yield out.assign(n_bytes=[len(t) for t in part], sha=[hashlib.sha256(t).hexdigest() for t in part], digits=digits, again=again)

    base = (given.mapInPandas(first, "doc_id long, text_hash long, n_bytes long, sha string, digits array<long>, again array<long>")
            .withColumn("rid", F.monotonically_increasing_id()))
    base = stored(spark, base, "repeats-base")

    digits = base.select("rid", F.explode("digits").alias("h"))
    twice = digits.groupBy("h").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("h")
    mine = digits.join(twice, "h", "left_semi").groupBy("rid").agg(F.collect_list("h").alias("hs"))  # a document's own digits
    known = base.select("rid", "doc_id", "text_hash", "again").join(mine, "rid", "left")
    both = F.array_union(_longs("hs"), "again")
    known = known.withColumn("hs", F.when(F.col("hs").isNotNull() | (F.size("again") > 0), both))
    known = stored(spark, known.select(F.coalesce("doc_id", F.lit(-1)).alias("id"), "text_hash", "hs"), "repeats-known")
    hit = known.filter("hs is not null").groupBy("id", "text_hash").agg(F.first("hs").alias("hs"))

    def squeeze(batches):
        import zstandard
        pack = zstandard.ZstdCompressor(level=1)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text_hash": pdf["text_hash"], "z": [pack.compress(_bytes(t)) for t in pdf["text"]]})

    small = given.mapInPandas(squeeze, "doc_id long, text_hash long, z binary").withColumn("id", F.coalesce("doc_id", F.lit(-1)))
    some = small.join(hit, ["id", "text_hash"]).select("doc_id", "text_hash", "z", "hs").withColumn("rid", F.monotonically_increasing_id())
    some = stored(spark, some, "repeats-some")
    intervals = _intervals(spark, some, rules)
    spans = intervals.groupBy("rid").agg(F.sort_array(F.flatten(F.collect_list("pairs"))).alias("pairs"))  # bounded by the document
    affected = some.select("rid", "doc_id", "text_hash", "z").join(spans, "rid", "left")
    clean = base.select(F.coalesce("doc_id", F.lit(-1)).alias("id"), "doc_id", "text_hash", "n_bytes", "sha").join(
        hit.select("id", "text_hash"), ["id", "text_hash"], "left_anti")
    return affected, clean.select("doc_id", "text_hash", "n_bytes", "sha")


def _intervals(spark: SparkSession, some: DataFrame, rules: RepeatRules) -> DataFrame:
    """(rid, pairs): lists of byte intervals (lo, hi) covered by repeated windows; they may overlap."""
    L = rules.length

    def second(batches):
        import zstandard
        unpack, hasher = zstandard.ZstdDecompressor(), _Hasher(rules)
        for pdf in batches:
            raw = [unpack.decompress(z) for z in pdf["z"]]
            rids, lists = pdf["rid"].to_numpy(np.int64), pdf["hs"].tolist()
            for at, part in _blocks(raw):
                hasher.load(part)
                anchor, doc, start, n = hasher.anchors()
                h = hasher.shared(anchor)
                keep = np.zeros(len(h), bool)
                edge = np.searchsorted(doc, np.arange(len(part) + 1))
                for d in range(len(part)):
                    a, b = edge[d], edge[d + 1]
                    keep[a:b] = np.isin(h[a:b], np.asarray(lists[at + d], np.int64))
                anchor, doc, start, n, h = anchor[keep], doc[keep], start[keep], n[keep], h[keep]
                yield _rows(rids[at + doc], h, hasher, start, n, anchor - start, start - hasher.begin[doc], L)

    rows = some.select("rid", "z", "hs").mapInPandas(second, ROWS)
    settled, todo = _settle(spark, rows, L, "anchors")
    out = settled
    for width in (rules.group, 1):
        rows = some.select("rid", "z").join(todo, "rid").mapInPandas(_splitter(rules, width), ROWS)
        settled, todo = _settle(spark, rows, L, f"groups-{width}")
        out = out.unionByName(settled)
    return out


#: Runs of ``n`` neighbouring window starts, the first of them ``o`` bytes before its anchor: ``h`` hashes the bytes
#: all windows of a run share (with the digits before), ``f`` all bytes of its windows. A document has one row for all its
#: runs of one kind: ``lo`` is the first of them, ``more`` are the places of the others (mostly none: null).
ROWS = "rid long, h long, f long, lo long, more array<long>, n int, o int"


def _rows(rid, h, hasher: _Hasher, start, n, o, lo, length: int) -> pd.DataFrame:
    f = _mix(hasher.hashes(start, n - 1 + length) + (o * 1024 + n).astype(np.uint64)).view(np.int64)
    more = np.full(len(f), None, object)
    once = np.sort(f)
    if (once[1:] == once[:-1]).any():
        order = np.lexsort((lo, f, h, rid))
        rid, h, f, lo, n, o = (x[order] for x in (rid, h, f, lo, n, o))
        at = _first_of_equal(rid, h, f)
        size, all_ = np.diff(np.r_[at, len(f)]), lo
        rid, h, f, lo, n, o, more = (x[at] for x in (rid, h, f, lo, n, o, more))
        for i in np.flatnonzero(size > 1):
            more[i] = all_[at[i] + 1:at[i] + size[i]]
    return pd.DataFrame({"rid": rid, "h": h, "f": f, "lo": lo, "more": more, "n": n.astype(np.int32), "o": o.astype(np.int32)})


def _first_of_equal(*sorted_by: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin."""
    new = np.ones(len(sorted_by[0]), bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in sorted_by])
    return np.flatnonzero(new)


def _by_document(doc: np.ndarray, digit: np.ndarray, n: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(distinct digits, those met more than once) of each of ``n`` documents."""
    order = np.lexsort((digit, doc))
    doc, digit = doc[order], digit[order]
    at = _first_of_equal(doc, digit)
    more = at[np.diff(np.r_[at, len(doc)]) > 1]
    return tuple(np.split(digit[x], np.searchsorted(doc[x], np.arange(1, n))) for x in (at, more))


def _longs(column: str):
    """A list of numbers, empty for null."""
    return F.coalesce(column, F.array().cast("array<long>"))


def _settle(spark: SparkSession, rows: DataFrame, length: int, name: str) -> tuple[DataFrame, DataFrame]:
    """(intervals of runs met twice as a whole, runs still to split by document).

    Runs whose first bytes (h) are met once hold no repeated window and go.
    Where runs of several kinds (f) share them and one kind is met once, one
    run of each kind is split further.
    """
    rows = stored(spark, rows, f"repeats-{name}")
    kinds = stored(spark, rows.groupBy("h", "f").agg(F.sum(1 + F.size(_longs("more"))).alias("k"), F.min("rid").alias("rid")), f"repeats-{name}-kinds")
    settled = rows.join(kinds.filter("k > 1").select("h", "f"), ["h", "f"], "left_semi")
    places = F.concat(F.array("lo"), _longs("more"))
    settled = settled.select("rid", F.transform(places, lambda lo: F.struct(lo.alias("lo"), (lo + F.col("n") - 1 + length).alias("hi"))).alias("pairs"))
    open_ = kinds.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"), F.min("k").alias("fewest")).filter("kinds > 1 and fewest = 1").select("h")
    members = kinds.join(open_, "h", "left_semi").select("h", "f", "rid")
    one = rows.join(members, ["h", "f", "rid"]).select("rid", F.struct("h", "lo", "n", "o").alias("x"))
    return settled, one.groupBy("rid").agg(F.collect_list("x").alias("todo"))


def _splitter(rules: RepeatRules, width: int):
    """Cuts runs at multiples of ``width`` bytes before their anchor (equal windows lie equally far from it)."""
    L = rules.length

    def split(batches):
        import zstandard
        unpack, hasher = zstandard.ZstdDecompressor(), _Hasher(rules)
        for pdf in batches:
            out = []
            for rid, z, todo in zip(pdf["rid"].tolist(), pdf["z"], pdf["todo"]):
                hasher.load([unpack.decompress(z)])
                h, lo, n, o = (np.asarray([t[c] for t in todo], np.int64) for c in ("h", "lo", "n", "o"))
                # pieces of a run: offsets q * width .. q * width + width - 1 before the anchor
                top, low = o // width, (o - n + 1) // width
                many = top - low + 1
                run = np.repeat(np.arange(len(h)), many)
                q = top[run] - (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many))
                far, near = np.minimum(o[run], q * width + width - 1), np.maximum((o - n + 1)[run], q * width)
                start, size, anchor = lo[run] + o[run] - far, far - near + 1, lo[run] + o[run]
                core = hasher.hashes(anchor - q * width, L - width + 1)
                own = _mix(core + h[run].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + q.astype(np.uint64))
                out.append(_rows(np.full(len(run), rid), own.view(np.int64), hasher, start, size, far, start, L))
            if out:
                yield pd.concat(out, ignore_index=True)

    return split


def _runs(pairs, size: int) -> list[tuple[int, int]]:
    """Maximal runs covered by sorted (lo, hi) intervals."""
    out: list[list[int]] = []
    for p in pairs if pairs is not None else ():
        lo, hi = p["lo"], p["hi"]
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, min(b, size)) for a, b in out]


def _cut(raw: bytes, runs) -> bytes:
    kept, at = [], 0
    for a, b in runs:
        kept.append(raw[at:a])
        at = b
    kept.append(raw[at:])
    return b"".join(kept)


def repeat_digest(spark: SparkSession, docs: DataFrame, rules: RepeatRules = RepeatRules(), **names) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per document."""
    affected, clean = repeated_spans(spark, docs, rules, **names)

    def digest(batches):
        import zstandard
        unpack = zstandard.ZstdDecompressor()
        for pdf in batches:
            rows = []
            for z, pairs in zip(pdf["z"], pdf["pairs"]):
                raw = unpack.decompress(z)
                runs = _runs(pairs, len(raw))
                rows.append((len(raw), sum(b - a for a, b in runs), len(runs), hashlib.sha256(_cut(raw, runs)).hexdigest()))
            out = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"], index=pdf.index)
            yield pdf[["doc_id"]].join(out)

    cut = affected.select("doc_id", "z", "pairs").mapInPandas(digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    zero = F.lit(0).cast("long")
    return cut.unionByName(clean.select("doc_id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), F.col("sha").alias("kept_sha256")))


def without_repeats(spark: SparkSession, docs: DataFrame, rules: RepeatRules = RepeatRules(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the repeated bytes; same columns and rows, ``n_chars`` (if there) follows the text.

    A character that loses some of its bytes goes as a whole.
    """
    affected, _ = repeated_spans(spark, docs, rules, doc_id, text)
    i, h, p, new = (fresh(c, docs.columns) for c in ("repeat_id", "repeat_hash", "repeat_runs", "repeat_text"))
    cuts = (affected.filter("pairs is not null").groupBy(F.coalesce("doc_id", F.lit(-1)).alias(i), F.col("text_hash").alias(h))
            .agg(F.first("pairs").alias(p)))
    keyed = docs.withColumns({i: F.coalesce(F.col(doc_id).cast("long"), F.lit(-1)), h: F.xxhash64(F.col(text))})
    met = keyed.join(cuts, [i, h], "left")

    @F.pandas_udf("string")
    def rest(texts: pd.Series, pairs: pd.Series) -> pd.Series:
        out = []
        for t, x in zip(texts, pairs):
            if t is None:
                out.append(None)
                continue
            raw = _bytes(t)
            out.append(_cut(raw, _runs(x, len(raw))).decode("utf-8", "ignore"))
        return pd.Series(out, dtype=object)

    cut = F.col(p).isNotNull()
    met = met.withColumn(new, rest(F.when(cut, F.col(text)), F.col(p)))
    own = {text: F.when(cut, F.col(new)).otherwise(F.col(text))}
    if "n_chars" in docs.columns and text != "n_chars":
        own["n_chars"] = F.when(cut, F.length(new)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return met.select(*[own[c].alias(c) if c in own else F.col(f"`{c}`") for c in docs.columns])
