"""Mixing sources to target weights: hierarchical budgets, seeded epochs.

Leaves are (domain, language, source). A token budget goes down the tree: at
each node the children share it by their weights, no child above its capacity
(what its leaves hold times ``max_epochs``). What a saturated child cannot use
goes to its siblings by their weights; only when a whole node is saturated
does the rest reach the node's own siblings, since the node's capacity caps
its share one level up. All of it is integer arithmetic.

A leaf with budget T and A tokens gives T // A whole epochs and the first
T % A tokens of one more, in that epoch's order: documents sorted by a hash of
(seed, epoch, id). The document at the cut is taken up to the cut.

Tokens here are words between ASCII white space, not a tokenizer's tokens:
budgets, shortages and target weights hold in words. Languages differ in
tokens a word, so weights in tokens differ by that ratio; a script without
spaces counts a line as about one token, so its leaves look nearly empty, are
repeated up to ``max_epochs`` and miss their weights.

Scale: one aggregation gives the tokens of each leaf; the tree's tables have
one row per leaf, language and domain. The cut is found without sorting a
leaf: tokens are summed by the leading ``digit_bits`` bits of the hash, running
sums over those digits find the one bucket that holds the cut, and only that
bucket's documents are ranked, after a second digit has cut it down again. A
leaf with a third of all documents is spread over all tasks.

Defined results: null text = no tokens; a document without tokens is taken in
every whole epoch and, in the last one, before the cut; null domain, language
or source = a leaf of its own with the default weight; ties in the hash are
ordered by id, tokens and text hash; repeated rows are taken one by one; a
budget above the whole capacity takes everything ``max_epochs`` times; weights
must be positive integers; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kmstream.llm.common import WORD, fresh, stored, text_batches


@dataclass(frozen=True)
class MixRules:
    """Weights by name at each level; a name that is not listed has weight ``default``.

    ``budget_percent``: the token budget as a share of all tokens there are.
    """

    domains: dict = field(default_factory=lambda: {"web": 6, "books": 3, "code": 1})
    languages: dict = field(default_factory=lambda: {"en": 5, "de": 2, "fr": 2, "es": 1})
    sources: dict = field(default_factory=dict)
    default: int = 1
    max_epochs: int = 4
    budget_percent: int = 100
    seed: int = 42
    digit_bits: int = 10


def source_domain(source: str = "source") -> Column:
    """The domain of a source: the first six sources are web, the next seven books, the rest code."""
    number = F.nullif(F.regexp_extract(F.col(source), r"(\d{1,9})$", 1), F.lit("")).cast("long")
    return F.when(number < 6, F.lit("web")).when(number < 13, F.lit("books")).when(number.isNotNull(), F.lit("code"))


def _weight(name: str, given: dict, default: int) -> Column:
    out = F.lit(default)
    for k, w in sorted(given.items()):
        out = F.when(F.col(name).eqNullSafe(F.lit(k)), F.lit(w)).otherwise(out)
    return out.cast("decimal(38,0)")


def _fill(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Shares ``budget`` of each parent among its children (name, weight w, capacity cap): adds ``share``.

    Children in order of capacity per weight; one is saturated if its capacity
    is at most its part of what the ones before it have left.
    """
    order = W.partitionBy(*parent).orderBy((F.col("cap").cast("double") / F.col("w").cast("double")), F.col(name).asc_nulls_first())
    before, whole = order.rowsBetween(W.unboundedPreceding, -1), W.partitionBy(*parent)
    zero = F.lit(0).cast("decimal(38,0)")
    x = (children.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), zero))
         .withColumn("w_before", F.coalesce(F.sum("w").over(before), zero))
         .withColumn("w_all", F.sum("w").over(whole)))
    x = x.withColumn("full", F.expr("cap * (w_all - w_before) <= (budget - cap_before) * w"))
    x = (x.withColumn("rest", F.expr("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), zero))
         .withColumn("w_rest", F.sum(F.when(~F.col("full"), F.col("w"))).over(whole)))
    x = x.withColumn("share", F.when(F.col("full"), F.col("cap")).otherwise(F.expr("cast((rest * w) div w_rest as decimal(38,0))")))
    # what integer division leaves goes to the first unsaturated children, one token each
    x = x.withColumn("odd", F.col("rest") - F.sum(F.when(~F.col("full"), F.col("share"))).over(whole))
    x = x.withColumn("place", F.sum(F.when(F.col("full"), 0).otherwise(1)).over(order.rowsBetween(W.unboundedPreceding, 0)))
    return x.withColumn("share", F.when(~F.col("full") & (F.col("place") <= F.col("odd")), F.col("share") + 1).otherwise(F.col("share"))).drop(
        "cap_before", "w_before", "w_all", "full", "rest", "w_rest", "odd", "place")


def leaf_budgets(leaves: DataFrame, rules: MixRules) -> DataFrame:
    """(domain, lang, source, tokens, share) from (domain, lang, source, tokens): the tokens each leaf is to give."""
    cap = (F.col("tokens") * F.lit(rules.max_epochs)).cast("decimal(38,0)")
    leaves = leaves.withColumn("cap", cap).withColumn("root", F.lit(0))
    total = leaves.groupBy("root").agg(F.sum("tokens").alias("t"), F.sum("cap").alias("c"))
    budget = total.select("root", F.least(F.expr(f"cast((cast(t as decimal(38,0)) * {rules.budget_percent}) div 100 as decimal(38,0))"),
                                          F.col("c").cast("decimal(38,0)")).alias("budget"))
    big = F.sum("cap").cast("decimal(38,0)").alias("cap")
    domains = leaves.groupBy("root", "domain").agg(big).withColumn("w", _weight("domain", rules.domains, rules.default))
    domains = _fill(domains.join(budget, "root"), ["root"], "domain").select(F.col("domain").alias("d"), F.col("share").alias("budget"))
    langs = leaves.groupBy("domain", "lang").agg(big).withColumn("w", _weight("lang", rules.languages, rules.default))
    langs = langs.join(domains, F.col("domain").eqNullSafe(F.col("d"))).drop("d")
    langs = _fill(langs, ["domain"], "lang").select(F.col("domain").alias("d"), F.col("lang").alias("l"), F.col("share").alias("budget"))
    own = leaves.withColumn("w", _weight("source", rules.sources, rules.default))
    own = own.join(langs, F.col("domain").eqNullSafe(F.col("d")) & F.col("lang").eqNullSafe(F.col("l"))).drop("d", "l")
    return _fill(own, ["domain", "lang"], "source").select("domain", "lang", "source", "tokens", F.col("share").cast("long").alias("share"))


def place(rules: MixRules, epoch: Column | str, doc_id: str = "doc_id") -> Column:
    """60 bits of the md5 of seed, epoch and id, as a long."""
    name = F.concat_ws(":", F.lit(rules.seed), F.col(epoch) if isinstance(epoch, str) else epoch, F.coalesce(F.col(doc_id).cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("long")


def mix(spark: SparkSession, docs: DataFrame, rules: MixRules = MixRules(), domain: Column | None = None,
        doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(doc_id, text_hash, domain, lang, source, epoch, n_tokens, taken): what each document gives in each epoch."""
    tokens = F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"),
                       (source_domain(source) if domain is None else domain).alias("domain"),
                       F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"), tokens.alias("n_tokens"))
    rows = stored(spark, rows, "mix-rows")
    leaves = rows.groupBy("domain", "lang", "source").agg(F.sum("n_tokens").alias("tokens"))
    leaf = ["domain", "lang", "source"]
    plan = leaf_budgets(leaves, rules).withColumns({
        "whole": F.when(F.col("tokens") > 0, F.expr("share div tokens")).otherwise(F.lit(rules.max_epochs)).cast("int"),
        "cut": F.when(F.col("tokens") > 0, F.expr("share % tokens")).otherwise(F.lit(0)).cast("long")})
    plan = stored(spark, plan.select(*leaf, "whole", "cut"), "mix-plan")
    same = plan.select(*[F.col(c).alias("_" + c) for c in leaf], "whole", "cut")
    match = [F.col(c).eqNullSafe(F.col("_" + c)) for c in leaf]
    known = rows.join(same, match[0] & match[1] & match[2]).drop(*["_" + c for c in leaf])

    every = (known.filter("whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)))
             .withColumn("taken", F.col("n_tokens")))
    out = [*["doc_id", "text_hash"], *leaf, "epoch", "n_tokens", "taken"]
    last = known.filter("cut > 0").withColumn("epoch", F.col("whole")).withColumn("h", place(rules, "epoch"))
    last = stored(spark, last.select("doc_id", "text_hash", *leaf, "epoch", "n_tokens", "cut", "h"), "mix-last")

    first = _cut_digit(last.withColumn("left", F.col("cut")), leaf, rules, 1)
    second = _cut_digit(first[1], leaf, rules, 2)
    order = W.partitionBy(*leaf).orderBy("h", F.col("doc_id").asc_nulls_first(), "n_tokens", "text_hash")
    ranked = second[1].withColumn("before", F.sum("n_tokens").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("n_tokens"))
    edge = ranked.filter("before < left").withColumn("taken", F.least("n_tokens", F.col("left") - F.col("before")))
    sure = first[0].unionByName(second[0]).withColumn("taken", F.col("n_tokens"))
    return every.select(out).unionByName(sure.select(out)).unionByName(edge.select(out))


def _cut_digit(rows: DataFrame, leaf: list[str], rules: MixRules, level: int) -> tuple[DataFrame, DataFrame]:
    """(rows that lie wholly before the cut, rows of the one bucket per leaf that holds it), by one digit of the hash."""
    low = 60 - level * rules.digit_bits
    digit = F.shiftright("h", low).bitwiseAND(F.lit((1 << rules.digit_bits) - 1))
    rows = rows.withColumn("digit", digit)
    sums = rows.groupBy(*leaf, "digit").agg(F.sum("n_tokens").alias("t"), F.max("left").alias("need"))
    upto = W.partitionBy(*leaf).orderBy("digit").rowsBetween(W.unboundedPreceding, 0)
    sums = sums.withColumn("upto", F.sum("t").over(upto)).filter("upto >= need")
    edge = sums.groupBy(*leaf).agg(F.min(F.struct("digit", "upto", "t")).alias("e"))
    edge = edge.select(*[F.col(c).alias("_" + c) for c in leaf], F.col("e.digit").alias("at"), (F.col("e.upto") - F.col("e.t")).alias("spent"))
    match = [F.col(c).eqNullSafe(F.col("_" + c)) for c in leaf]
    known = rows.join(edge, match[0] & match[1] & match[2]).drop(*["_" + c for c in leaf])
    sure = known.filter(F.col("digit") < F.col("at")).drop("at", "spent", "digit")
    open_ = known.filter(F.col("digit") == F.col("at")).withColumn("left", F.col("left") - F.col("spent")).drop("at", "spent", "digit")
    return sure, open_


def mixed_documents(spark: SparkSession, docs: DataFrame, rules: MixRules = MixRules(), domain: Column | None = None,
                    doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents themselves, once per epoch they are taken in, cut where the leaf's budget ends.

    Same columns as ``docs``; ``n_chars``, if there, follows a cut text. Rows
    that agree in id, text, domain, language and source stand for each other.
    """
    text_batches(spark)
    names = dict(domain=domain, doc_id=doc_id, text=text, lang=lang, source=source)

    def key(i, h, d, la, so):
        return F.concat_ws("\x01", *[F.coalesce(c.cast("string"), F.lit("\x02")) for c in (i, h, d, la, so)])

    taken = mix(spark, docs, rules, **names)
    k, n, e = (fresh(c, docs.columns) for c in ("mix_key", "mix_nth", "mix_plan"))
    entry = F.struct("epoch", "taken", "n_tokens", "times")
    plan = (taken.groupBy(key(*[F.col(c) for c in ("doc_id", "text_hash", "domain", "lang", "source")]).alias(k), "epoch", "taken", "n_tokens")
            .agg(F.count(F.lit(1)).alias("times")).groupBy(k).agg(F.sort_array(F.collect_list(entry)).alias(e)))  # max_epochs + 2 entries at most
    own = key(F.col(doc_id).cast("long"), F.xxhash64(F.col(text)), source_domain(source) if domain is None else domain, F.col(lang), F.col(source))
    one = (docs.withColumn(k, own).withColumn(n, F.row_number().over(W.partitionBy(k).orderBy(k))).filter(F.col(n) == 1).drop(n))
    rows = one.join(plan, k).withColumn(e, F.explode(e)).withColumn(n, F.explode(F.sequence(F.lit(1), F.col(f"{e}.times").cast("int"))))

    @F.pandas_udf("string")
    def prefix(texts: pd.Series, upto: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else _prefix(t, int(u)) for t, u in zip(texts, upto)], dtype=object)

    cut = F.col(f"{e}.taken") < F.col(f"{e}.n_tokens")
    short = fresh("mix_text", docs.columns)
    rows = rows.withColumn(short, prefix(F.when(cut, F.col(text)), F.col(f"{e}.taken")))
    new = {text: F.when(cut, F.col(short)).otherwise(F.col(text))}
    if "n_chars" in docs.columns and text != "n_chars":
        new["n_chars"] = F.when(cut, F.length(short)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def _prefix(text: str, words: int) -> str:
    """The text up to the end of its ``words``-th word."""
    end = 0
    for k, m in enumerate(re.finditer(WORD, text)):
        if k >= words:
            break
        end = m.end()
    return text[:end]
