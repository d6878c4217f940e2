"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text.

Folding lower-cases a text, maps homoglyphs (Greek, Cyrillic, full-width) and
digit or symbol substitutions to one letter, and writes each word between a
start and an end mark. The lexicon holds word stems (``^stem``), whole words
(``^word$``) and word pairs (``^a$^b$``) with weights, learned from labelled
rows: the log odds of the entry's document frequency under either label.
Longer entries override the shorter ones they cover, so entries with a weight
of 0 or less -- usual words and phrases that hold a bad stem, most of them only
seen in clean rows -- are the exceptions. Candidates are counted under both
labels in one aggregation and ranked by their log likelihood ratio, so a rare
entry that is sure goes before a frequent one that is usual. A pair without a bad
word is an entry if its label counts are beyond chance (``pair_g2``). A text's
score is a logistic function of its summed positive weights, of the same
normalised by length, of its largest weight, and of the number of matches.

Learning: ``sample_rows`` is the documented bound of the labelled sample (by a
hash of the id, so the same rows whatever the partitioning). Entry counts are
Spark aggregations; the lexicon has at most ``max_entries`` bad words and stems,
as many bad pairs, exception words and exception pairs, which bounds the model that is
broadcast. The logistic function is fitted on the
sample's figures (four numbers a row). Scoring reads every text whole, one
pass, no shuffle.

Defined results: null or empty text = the score of a text without matches;
rows with null label or id are not learned from; repeated labels of one id
count once (toxic if any says so); without toxic or without clean rows in the
sample every score is the share of toxic rows (0 without any); other columns
are never read; a column with the name of the score is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kmstream.llm.common import stored, text_batches

#: Look-alike letters, and digits or signs that stand for letters. i, l, 1, | and ! fold to one sign.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "з": "e", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o",
    "р": "p", "с": "c", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ʟ": "l",
}
SUBSTITUTIONS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "l": "i"}
_FOLD = {ord(k): SUBSTITUTIONS.get(v, v) for k, v in HOMOGLYPHS.items()} | {ord(k): v for k, v in SUBSTITUTIONS.items()}
_FOLD |= {0xFF01 + k: _FOLD.get(0x21 + k, chr(0x21 + k).lower()) for k in range(94)}  # full-width forms
_FOLD |= {k: None for k in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)}            # invisible characters

# A closing ! or $ of a word is punctuation, one inside it a letter; underscores and hyphens separate.
_closing = re.compile(r"[!$@]+(?=[^\w!$@]|\Z)")
_word = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class ToxicRules:
    sample_rows: int = 20_000
    max_entries: int = 20_000
    min_toxic: int = 4        # toxic documents an entry must lie in
    min_seen: int = 8         # documents an exception must lie in
    stem_min: int = 3
    stem_max: int = 9
    min_weight: float = 1.5   # natural log of the odds
    pair_g2: float = 25.0     # log likelihood ratio from which a pair of usual words is bad


def fold(text: str) -> list[str]:
    """The folded words of a text."""
    return _word.findall(_closing.sub(" ", text.lower()).translate(_FOLD))


def entries_of(words: list[str], rules: ToxicRules) -> set[str]:
    """Every possible entry of a text: stems, whole words and pairs of neighbours."""
    out = set()
    for w in set(words):
        out.update(_singles(w, rules))
    out.update(f"^{a}$^{b}$" for a, b in zip(words, words[1:]))
    return out


def _singles(word: str, rules: ToxicRules) -> list[str]:
    """The stems of a word, shortest first, and the whole word."""
    return ["^" + word[:n] for n in range(rules.stem_min, min(rules.stem_max, len(word)) + 1)] + [f"^{word}$"]


def exceptions_of(words: list[str], bad: set[str], rules: ToxicRules) -> set[str]:
    """The entries of a text that cover an entry of ``bad``: longer stems, whole words and pairs."""
    out, held = set(), set()
    for w in set(words):
        own = _singles(w, rules)
        first = next((k for k, e in enumerate(own) if e in bad), None)
        if first is not None:
            held.add(w)
            out.update(own[first + 1:])
    out.update(f"^{a}$^{b}$" for a, b in zip(words, words[1:]) if a in held or b in held)
    return out


class Lexicon:
    """Weighted entries behind one automaton."""

    def __init__(self, weights: dict[str, float]):
        import ahocorasick
        self.auto = ahocorasick.Automaton()
        for entry, weight in weights.items():
            self.auto.add_word(entry, (len(entry), weight))
        if weights:
            self.auto.make_automaton()
        self.empty = not weights

    def figures(self, text: str | None) -> tuple[float, float, float, float]:
        """(summed weights, the same by length, largest weight, matches) of the positive entries."""
        words = fold(text) if text else []
        if self.empty or not words:
            return 0.0, 0.0, 0.0, 0.0
        total = most = 0.0
        hits = 0
        reach = -1
        for _, end, weight in sorted((end - size + 1, -end, weight) for end, (size, weight) in self.auto.iter("^" + "$^".join(words) + "$")):
            if -end <= reach:  # covered by a longer entry
                continue
            reach = -end
            if weight > 0:
                total += weight
                hits += 1
                most = max(most, weight)
        return total, total / len(words) ** 0.5, most, float(hits)


@dataclass(frozen=True)
class ToxicModel:
    weights: dict
    coefficients: tuple  # intercept and one number per figure
    scale: tuple


def _scores(figures: np.ndarray, coefficients: tuple, scale: tuple) -> np.ndarray:
    x = np.log1p(figures) / np.asarray(scale)
    z = coefficients[0] + x @ np.asarray(coefficients[1:])
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def labelled_sample(documents: DataFrame, labels: DataFrame, rules: ToxicRules) -> DataFrame:
    """(text, toxic) of at most about ``sample_rows`` labelled documents, chosen by a hash of the id."""
    known = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(71)), F.lit(1_000_000))
    n = known.count()
    below = 1_000_000 if n <= rules.sample_rows else max(1, rules.sample_rows * 1_000_000 // n)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (texts.filter(place < below).join(known.filter(place < below), "doc_id")
            .select(F.coalesce("text", F.lit("")).alias("text"), "toxic"))


def learn(spark: SparkSession, sample: DataFrame, rules: ToxicRules = ToxicRules()) -> ToxicModel:
    """Lexicon and logistic function from (text, toxic) rows."""
    text_batches(spark)
    sample = stored(spark, sample, "toxic-sample")
    size = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    if not toxic or not clean:
        share = toxic / (toxic + clean) if toxic + clean else 0.0
        return ToxicModel({}, (float(np.clip(np.log(share / (1 - share)) if 0 < share < 1 else (35 if share else -35), -35, 35)), 0, 0, 0, 0), (1, 1, 1, 1))

    def counted(entries):
        """(entry, n, t): documents and toxic documents of the sample that hold an entry."""
        def run(batches):
            total: Counter = Counter()
            for pdf in batches:
                for text, label in zip(pdf["text"], pdf["toxic"]):
                    total.update((e, label) for e in entries(fold(text)))
                    if len(total) > 500_000:
                        yield _frame(total)
                        total.clear()
            yield _frame(total)

        rows = sample.select("text", "toxic").mapInPandas(run, "entry string, n long, t long")
        return rows.groupBy("entry").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))

    def most(counts, order):
        return counts.orderBy(order, "entry").limit(4 * rules.max_entries).toPandas()

    odds = (F.col("t") + 0.5) / F.lit(toxic + 1) / ((F.col("n") - F.col("t") + 0.5) / F.lit(clean + 1))
    pair = F.col("entry").contains("$^")

    # candidates: what lies in enough toxic documents and leans to them, the surest first, words and pairs each by themselves
    often = counted(lambda words: entries_of(words, rules)).filter((F.col("t") >= rules.min_toxic) & (odds >= float(np.exp(rules.min_weight))))
    often = stored(spark, often.select("entry", F.ln(odds).alias("weight"), _g2(toxic / (toxic + clean)).alias("g2")), "toxic-entries")
    top = pd.concat([most(often.filter(kind), F.desc("g2")) for kind in (~pair, pair)])
    bad = _choose(dict(zip(top["entry"], zip(top["weight"], top["g2"]))), rules)

    # exceptions: what covers a bad word or stem in enough documents of either label
    stems = spark.sparkContext.broadcast({e for e in bad if "$^" not in e})
    seen = counted(lambda words: exceptions_of(words, stems.value, rules))
    seen = stored(spark, seen.filter((F.col("n") >= rules.min_seen) & (odds < float(np.exp(rules.min_weight)))), "toxic-exceptions")
    model = _with_exceptions(bad, [list(most(seen.filter(kind), F.desc("n"))["entry"]) for kind in (~pair, pair)], rules)
    lexicon = spark.sparkContext.broadcast(model)

    def figures(batches):
        own = Lexicon(lexicon.value)
        for pdf in batches:
            f = np.asarray([own.figures(x) for x in pdf["text"]], float).reshape(-1, 4)
            yield pd.DataFrame(f, columns=list("abcd")).assign(toxic=pdf["toxic"].to_numpy())

    rows = sample.mapInPandas(figures, "a double, b double, c double, d double, toxic int").toPandas()
    x = np.log1p(rows[list("abcd")].to_numpy(float))
    scale = np.maximum(x.std(axis=0), 1e-6)
    return ToxicModel(model, tuple(_logistic(x / scale, rows["toxic"].to_numpy(float))), tuple(scale))


def _frame(total: Counter) -> pd.DataFrame:
    rows = [(e, n, n if label == 1 else 0) for (e, label), n in total.items()]
    return pd.DataFrame(rows, columns=["entry", "n", "t"]).astype({"entry": object, "n": "int64", "t": "int64"})


def _g2(share: float) -> Column:
    """Log likelihood ratio of t of n documents against the share of toxic ones in the sample."""
    def part(k, expected):
        return F.when(k > 0, k * F.ln(k / (F.col("n") * expected))).otherwise(0.0)
    return 2 * (part(F.col("t"), share) + part(F.col("n") - F.col("t"), 1 - share))


def _holds(word: str, entries: dict, rules: ToxicRules) -> bool:
    """Whether the longest entry of a word is bad."""
    return next((entries[e] > 0 for e in reversed(_singles(word, rules)) if e in entries), False)


def _words_of(pair: str) -> list[str]:
    return pair[1:-1].split("$^")


def _choose(table: dict, rules: ToxicRules) -> dict[str, float]:
    """Bad words and stems, and the bad pairs of usual words, from (weight, g2) by entry, the surest first."""
    bad = sorted((e for e, (w, _) in table.items() if w >= rules.min_weight), key=lambda e: (-table[e][1], e))
    out = {e: float(table[e][0]) for e in [e for e in bad if "$^" not in e][:rules.max_entries]}
    pairs = [e for e in bad if "$^" in e and table[e][1] >= rules.pair_g2 and not any(_holds(w, out, rules) for w in _words_of(e))]
    return out | {e: float(table[e][0]) for e in pairs[:rules.max_entries]}


def _with_exceptions(bad: dict, usual: list[list[str]], rules: ToxicRules) -> dict[str, float]:
    """``bad`` with the usual words and stems, and the usual pairs that still hold a bad word, the most frequent first."""
    out = dict(bad)
    out.update((e, 0.0) for e in usual[0][:rules.max_entries] if e not in bad)
    pairs = [e for e in usual[1] if e not in bad and any(_holds(w, out, rules) for w in _words_of(e))]
    return out | {e: 0.0 for e in pairs[:rules.max_entries]}


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton steps, the labels weighted as they are."""
    a = np.c_[np.ones(len(x)), x]
    b = np.zeros(a.shape[1])
    penalty = np.diag([0.0] + [ridge] * x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -35, 35)))
        step = np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + penalty, a.T @ (y - p) - penalty @ b)
        b += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return b


def score(spark: SparkSession, documents: DataFrame, model: ToxicModel, text: str = "text", column: str = "score") -> DataFrame:
    """``documents`` with the score of each whole text; a column of that name is replaced."""
    # plain values only: a broadcast's classes are looked up where it is opened, and workers need no copy of this package
    shared = spark.sparkContext.broadcast((model.weights, tuple(map(float, model.coefficients)), tuple(map(float, model.scale))))

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, coefficients, scale = shared.value
        own = Lexicon(weights)
        for texts in batches:
            f = np.asarray([own.figures(t) for t in texts], float).reshape(-1, 4)
            yield pd.Series(_scores(f, coefficients, scale))

    return documents.withColumn(column, scores(F.col(text).cast("string")))
