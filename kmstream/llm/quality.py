"""Quality rules, line first: bad lines go, then documents that lost too much.

Every line of a document is judged on its own:

* navigation: it holds at least ``nav_bars`` ``|`` separators;
* symbols: more than ``symbol_share`` symbols (``#*$%&|<>``) per word;
* shouting: at least ``shout_letters`` ASCII letters, over ``shout_share`` of them capitals;
* punctuation: no sentence mark anywhere in it, and at least ``bare_words`` words;
* boilerplate: it holds one of a list of fixed phrases (case ignored);
* repetition: it holds a word and equals an earlier line of the document.

Lines that fail are removed. A document is rejected if its base figures fail
(fewer than 50 words, or over half of its words in three-word windows that
occur twice) or if the removed lines held more than ``lost_share`` of its
words. The base figures are those of the text as given.

One pass over the texts, no shuffle: a row's work depends on its own text
only, so no group can be hot. Batches are cut into blocks of a few MB of text.

Defined results: null or empty text = no words, rejected; repeated rows are
judged one by one; other columns pass through untouched
(a column that clashes with an added one, case ignored, is kept and the added
one gets a numbered name; ``clean_documents`` adds none).
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kmstream.llm.common import SYMBOLS, WORD, fresh, text_batches, text_blocks

#: Phrases of page furniture.
BOILERPLATE = ("all rights reserved", "accept cookies", "cookie policy", "privacy policy", "terms of service",
               "enable javascript", "click here", "subscribe to our newsletter", "lorem ipsum", "share on facebook")


@dataclass(frozen=True)
class QualityRules:
    min_words: int = 50
    repeat_percent: int = 50
    nav_bars: int = 3
    symbol_percent: int = 30
    shout_letters: int = 20
    shout_percent: int = 60
    bare_words: int = 4
    lost_percent: int = 50


FIGURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lost_words long, base_failed boolean, kept boolean, clean_text string"
_NAMES = [x.split()[0] for x in FIGURES.split(", ")]

_word = re.compile(WORD)
_mark = re.compile(r"[.!?…。]")
_furniture = re.compile("|".join(map(re.escape, BOILERPLATE)), re.I | re.A)
_symbol = re.compile(f"[{re.escape(SYMBOLS)}]")
_upper, _letter = re.compile("[A-Z]"), re.compile("[A-Za-z]")


def repeated_words(words: list[str]) -> int:
    """Words that lie in a three-word window found at least twice in the list."""
    n = len(words)
    if n < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    total, end = 0, 0  # end: first position not yet counted
    for i, w in enumerate(windows):
        if seen[w] > 1:
            total += i + 3 - max(i, end)
            end = i + 3
    return total


def bad_line(line: str, n_words: int, rules: QualityRules) -> bool:
    """Does a line with ``n_words`` >= 1 words fail one of the rules (repetition aside)?"""
    if line.count("|") >= rules.nav_bars:
        return True
    if 100 * len(_symbol.findall(line)) > rules.symbol_percent * n_words:
        return True
    letters = len(_letter.findall(line))
    if letters >= rules.shout_letters and 100 * len(_upper.findall(line)) > rules.shout_percent * letters:
        return True
    if n_words >= rules.bare_words and not _mark.search(line):
        return True
    return bool(_furniture.search(line))


def judge(text: str | None, rules: QualityRules = QualityRules()) -> tuple:
    """The values of ``FIGURES`` for one text."""
    text = text or ""
    words, seen, keep, dup, lost = [], set(), [], 0, 0
    for line in text.split("\n"):
        own = _word.findall(line)
        if not own:
            keep.append(line)
            continue
        words += own
        again = line in seen
        seen.add(line)
        dup += again
        if again or bad_line(line, len(own), rules):
            lost += len(own)
        else:
            keep.append(line)
    n, repeat = len(words), repeated_words(words)
    failed = n < rules.min_words or 100 * repeat > rules.repeat_percent * n
    return (n, sum(map(len, words)), sum(map(text.count, SYMBOLS)), dup, repeat, lost, failed,
            not failed and 100 * lost <= rules.lost_percent * n, "\n".join(keep))


def with_quality(df: DataFrame, text: str = "text", rules: QualityRules = QualityRules(), clean: bool = True) -> DataFrame:
    """``df`` with the figures, the verdict and, if ``clean``, the text without its bad lines."""
    text_batches(df.sparkSession)
    wanted = _NAMES if clean else _NAMES[:-1]
    names = {}
    for c in wanted:
        names[c] = fresh(c, df.columns + list(names.values()))

    kinds = dict(x.split() for x in FIGURES.split(", "))

    @F.pandas_udf(", ".join(f"{c} {kinds[c]}" for c in wanted))
    def figures(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for part in text_blocks(texts.to_frame("t"), "t"):
            rows += [judge(t, rules)[:len(wanted)] for t in part["t"]]
        return pd.DataFrame(rows, columns=wanted)

    holder = fresh("quality", df.columns)
    out = df.withColumn(holder, figures(F.col(text).cast("string")))
    return out.select(*[out[f"`{c}`"] for c in df.columns], *[F.col(f"{holder}.{c}").alias(names[c]) for c in wanted])


def clean_documents(df: DataFrame, text: str = "text", rules: QualityRules = QualityRules()) -> DataFrame:
    """The documents that stay, without their bad lines; same columns, ``n_chars`` (if there) follows the text."""
    text_batches(df.sparkSession)

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        done = (judge(t, rules) for t in texts)
        return pd.Series([d[8] if d[7] else None for d in done], dtype=object)

    holder = fresh("clean_text", df.columns)
    # not deterministic for the optimizer: the filter must not judge the texts a second time
    out = df.withColumn(holder, cleaned.asNondeterministic()(F.col(text).cast("string"))).filter(F.col(holder).isNotNull())
    new = {text: F.col(holder)}
    if "n_chars" in df.columns and text != "n_chars":
        new["n_chars"] = F.length(holder).cast(df.schema["n_chars"].dataType)
    return out.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in df.columns])
