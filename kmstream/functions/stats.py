"""Scalar statistics used by the scores (F-10, F-19)."""

from __future__ import annotations

import math
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def k_rule_of_thumb(n: int) -> int:
    """F-19: floor(sqrt(floor(n / 2))), integer division first."""
    return int(math.isqrt(int(n) // 2))


def k_rule_expr(count_col: Column) -> Column:
    """F-19 as an expression over a count column."""
    return F.floor(F.sqrt(F.floor(count_col / 2))).cast("long")


def entropy(counts: Iterable[int]) -> float:
    """F-10: Shannon entropy (natural log) of counts, zeros skipped."""
    vals = [c for c in counts if c > 0]
    n = float(sum(vals))
    return -sum((v / n) * math.log(v / n) for v in vals) if n else 0.0
