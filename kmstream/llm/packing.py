"""Best-fit packing planned on the length histogram.

Documents become token pieces of at most ``capacity`` tokens (only longer
documents are cut). Best fit, longest first, then runs over the *counts* of
the lengths instead of over documents: bins that hold the same lengths are one
group (first sequence id, number of bins, room left), so placing all pieces of
one length splits at most two groups, whatever the number of documents. The
plan is a table of slot runs: pieces number ``rank`` .. of one length go, ``k``
to a bin, into consecutive sequences at a fixed offset. Documents then take
their slots by joining on (length, rank within length).

Scale: the histogram has at most ``capacity`` rows and the plan at most a few
runs per length and group, whatever the corpus. Ranks come from a range
partitioning by (length, hash), which splits a length that many documents
share over many tasks; the offset of a partition within a length comes from a
count table of at most partitions + lengths rows. Nothing else reaches the
driver. Texts are tokenised once and only lengths and checksums are kept;
pieces are written below the shared checkpoint folder before they are ranked.

Defined results: null text = the empty document (one piece, the end id);
repeated rows are packed one by one; ties in length and hash are ordered by
document id, piece, start and checksum; an empty table gives an empty result;
other columns of the input are ignored.
"""

from __future__ import annotations

import bisect
import os
import re
import struct
import sys
import types
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kmstream.llm.common import stored, text_batches

PIECE_TYPE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED_TYPE = PIECE_TYPE + ", sequence_id long, offset long"

#: Characters that may lower-case or separate words in a way of their own (RE2).
_BEYOND = "[^\\x00-\\x1b\\x20-\\x7f\\x{a1}-\\x{12f}\\x{131}-\\x{17f}]"
#: A stop or comma behind other punctuation (RE2).
_MIXED = "[^a-z0-9\\x{df}-\\x{f6}\\x{f8}-\\x{ff} \\t-\\r][.,]"
_letters = re.compile(r"[a-zß-öø-ÿ]+")
SLICE = 8 << 20  # bytes of text whose words are looked up together


@dataclass(frozen=True)
class PackRules:
    capacity: int = 4096
    end_id: int = 1
    cache_words: int = 700_000  # words a worker remembers; beyond it starts anew (no effect on results)


class WordTokenizer:
    """Token ids of whole texts for a tokenizer whose tokens never span white space.

    Words are encoded once and remembered. Where the tokenizer itself lower-cases
    and parts letters from punctuation, texts are lower-cased first and a word's
    closing stop or comma is looked up by itself; words of letters only then go
    straight to the model. Texts with unusual characters are split at ASCII
    white space and their words take the tokenizer's full path. Splitting and
    numbering the words of a slice of texts is Arrow's work; Python sees each
    different word of the slice once.
    """

    def __init__(self, path: str, cache: dict, limit: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        self.cache, self.limit = cache, limit
        norm, pre = self.tok.normalizer, self.tok.pre_tokenizer
        self.lower = (norm is not None and norm.normalize_str("AbÉ") == "abé" and pre is not None
                      and [x for x, _ in pre.pre_tokenize_str("ab.")][1:] == ["."])
        self.model = Tokenizer.from_file(path)
        self.model.normalizer = None
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        probe = ["the", "internationalisation", "straßenüberführung", "éléphant", "xqzzk"]
        self.direct = self.lower and self._encode(self.model, probe) == self._encode(self.tok, probe)

    @staticmethod
    def _encode(tok, words: list[str]) -> list[bytes]:
        lists = [e.ids for e in tok.encode_batch_fast(words, add_special_tokens=False)]
        pack = [struct.Struct(f"<{n}I").pack for n in range(max(map(len, lists), default=0) + 1)]
        return [pack[len(x)](*x) for x in lists]

    def _learn(self, words: list[str]) -> None:
        simple = [w for w in words if _letters.fullmatch(w)] if self.direct else []
        for tok, some in ((self.model, simple), (self.tok, list(set(words).difference(simple)))):
            for i in range(0, len(some), 8192):
                part = some[i:i + 8192]
                self.cache.update(zip(part, self._encode(tok, part)))

    def _words(self, texts: pa.Array) -> pa.ListArray:
        if self.lower:
            low = pc.utf8_lower(texts)
            spaced = low
            for mark in (". ", ", ", ".\n"):
                spaced = pc.replace_substring(spaced, mark, f" {mark}")
            low = pc.if_else(pc.match_substring_regex(low, _MIXED), low, spaced)
            texts = pc.if_else(pc.match_substring_regex(texts, _BEYOND), texts, low)
        return pc.ascii_split_whitespace(texts)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, where each text begins and the last ends)."""
        lists = self._words(texts)
        words = lists.flatten().dictionary_encode()
        own = words.dictionary.to_pylist()
        if len(self.cache) > self.limit:
            self.cache.clear()
        new = [w for w in own if w not in self.cache]
        if new:
            self._learn(new)
        raw = [self.cache[w] for w in own]
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        begin = np.cumsum(size) - size
        ids = np.frombuffer(b"".join(raw), "<u4")
        at = words.indices.to_numpy(zero_copy_only=False)
        n = size[at]
        ends = np.r_[0, np.cumsum(n)]
        place = np.repeat(begin[at] - ends[:-1], n) + np.arange(ends[-1])
        offsets = lists.offsets.to_numpy()
        return ids[place], ends[offsets - offsets[0]]


def _process_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, shared by the tasks it runs one after another."""
    holder = sys.modules.setdefault("kmstream_worker_cache", types.ModuleType("kmstream_worker_cache"))
    return holder.__dict__.setdefault(name, {})


def token_pieces(docs: DataFrame, tokenizer: str, rules: PackRules = PackRules(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: document, piece number, start, length and checksum of its ids."""
    text_batches(docs.sparkSession, 2500)

    def run(batches):
        tok = WordTokenizer(tokenizer, _process_cache("words:" + tokenizer), rules.cache_words)
        end, size = np.asarray([rules.end_id], "<u4").tobytes(), 4 * rules.capacity
        for batch in batches:
            docs = batch.column(0)
            texts = pc.fill_null(batch.column(1), "")
            lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            group = (np.cumsum(lengths) - lengths) // SLICE
            edges = [*np.flatnonzero(np.r_[True, group[1:] != group[:-1]]).tolist(), len(texts)] if len(texts) else [0]
            for a, b in zip(edges, edges[1:]):
                ids, ends = tok.encode(texts.slice(a, b - a))
                raw, rows = ids.astype("<u4", copy=False).tobytes(), []
                for k in range(b - a):
                    own = raw[4 * ends[k]:4 * ends[k + 1]] + end
                    rows += [(a + k, p, at // 4, (min(at + size, len(own)) - at) // 4, zlib.crc32(own[at:at + size]))
                             for p, at in enumerate(range(0, len(own), size))]
                row, piece, start, length, crc = (np.asarray(x, np.int64) for x in zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [docs.take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, PIECE_TYPE)


def plan_slots(histogram: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Best fit, longest first, over counts: (slot runs, number of sequences).

    A run is (length, first rank, first sequence id, pieces per bin, offset of
    the first piece); the runs of a length are in order of rank.
    """
    runs: list[tuple[int, int, int, int, int]] = []
    groups: dict[int, list[tuple[int, int]]] = {}  # room left -> [(first sequence id, bins)]
    rooms: list[int] = []                          # rooms that have groups, in order
    bins = 0

    def put(room: int, first: int, count: int) -> None:
        if room and count:
            if room not in groups:
                groups[room] = []
                bisect.insort(rooms, room)
            groups[room].append((first, count))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            i = bisect.bisect_left(rooms, length)
            if i == len(rooms):
                count = -(-left // (capacity // length))
                put(capacity, bins, count)
                bins += count
                continue
            room = rooms[i]
            first, count = groups[room].pop()
            if not groups[room]:
                del groups[room], rooms[i]
            k = room // length
            full = min(count, left // k)
            if full:
                took = full * k
                put(room - k * length, first, full)
                put(room, first + full, count - full)
            else:  # the last pieces do not fill a bin
                took, k = left, left
                put(room - left * length, first, 1)
                put(room, first + 1, count - 1)
            runs.append((length, rank, first, k, capacity - room))
            rank, left = rank + took, left - took
    return np.asarray(runs, np.int64).reshape(-1, 5), bins


def pack(spark: SparkSession, pieces: DataFrame, rules: PackRules = PackRules()) -> DataFrame:
    """Pieces with the sequence and the offset each one takes."""
    pieces = stored(spark, pieces, "pack-pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs, _ = plan_slots(histogram, rules.capacity)

    order = ["length", "h", "doc_id", "piece", "start", "ids_crc32"]
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-sum(histogram.values()) // 1000)))
    ranged = (pieces.withColumn("h", F.xxhash64("doc_id", "piece", "start"))
              .repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("h"))

    def number(batches):
        from pyspark import TaskContext
        part, last, count = TaskContext.get().partitionId(), None, 0
        for pdf in batches:
            if not len(pdf):
                continue
            length = pdf["length"].to_numpy()
            new = np.r_[True, length[1:] != length[:-1]]
            first = np.maximum.accumulate(np.where(new, np.arange(len(length)), 0))
            local = np.arange(len(length)) - first
            if length[0] == last:
                local[first == 0] += count
            last, count = length[-1], int(local[-1]) + 1
            yield pdf.assign(part=part, local=local)

    numbered = stored(spark, ranged.mapInPandas(number, PIECE_TYPE + ", part int, local long"), "pack-ranked")
    # at most partitions + lengths rows
    counts = numbered.groupBy("length", "part").agg(F.max("local").alias("last")).orderBy("length", "part").toPandas()
    size = counts["last"].to_numpy(np.int64) + 1
    before = size.cumsum() - size
    before -= np.maximum.accumulate(np.where(np.r_[True, np.diff(counts["length"]) != 0], before, 0)) if len(counts) else 0
    offsets = dict(zip(zip(counts["length"].tolist(), counts["part"].tolist()), before.tolist()))
    shared = spark.sparkContext.broadcast((runs, offsets))

    def place(batches):
        runs, offsets = shared.value
        for pdf in batches:
            length = pdf["length"].to_numpy(np.int64)
            keys = list(zip(length.tolist(), pdf["part"].tolist()))
            rank = pdf["local"].to_numpy(np.int64) + np.fromiter((offsets[k] for k in keys), np.int64, len(keys))
            out = pdf.drop(columns=["part", "local"])
            seq, off = np.zeros(len(out), np.int64), np.zeros(len(out), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                own = runs[np.searchsorted(lengths, -n, "left"):np.searchsorted(lengths, -n, "right")]
                r = own[np.searchsorted(own[:, 1], rank[at], "right") - 1]
                j = rank[at] - r[:, 1]
                seq[at], off[at] = r[:, 2] + j // r[:, 3], r[:, 4] + (j % r[:, 3]) * n
            yield out.assign(sequence_id=seq, offset=off)

    lengths = -runs[:, 0]  # the runs are in falling order of length
    return numbered.mapInPandas(place, PLACED_TYPE)
