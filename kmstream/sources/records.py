"""C-1..C-8: delimited text records -> typed columns.

A record layout is a list of (name, role) with role in
``numeric`` / ``category`` / ``label`` / ``drop``. Parsing is pure column
expressions (``split`` with a limit, ``trim``, ``cast``), so it runs inside
codegen and Catalyst prunes fields nobody reads.

Rules (SURVEY section 1.3):
* split on the separator with a limit: extra separators stay in the last field;
* blank numeric (after trim) -> 0.0; any other non-number fails (``mode='fail'``)
  or drops the row (``mode='drop'``);
* a blank category is the ordinary value ``''``;
* a record must have exactly ``len(layout)`` fields (fail or drop).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMERIC, CATEGORY, LABEL, DROP = "numeric", "category", "label", "drop"

# Field names and roles of the 28-field trade record, in field order.
TRADE_LAYOUT: list[tuple[str, str]] = [
    ("trade_date", NUMERIC),
    ("product_type", CATEGORY),
    ("trade_id", LABEL),
    ("book_id", CATEGORY),
    ("counterparty", CATEGORY),
    ("start_date", NUMERIC),
    ("quantity", NUMERIC),
    ("currency", CATEGORY),
    ("instrument_description", CATEGORY),
    ("buy_sell", CATEGORY),
    ("trade_maturity_date", CATEGORY),
    ("trade_mod_date", DROP),
    ("trade_version", NUMERIC),
    ("trade_description", CATEGORY),
    ("effective_date", NUMERIC),
    ("legal_entity", CATEGORY),
    ("trading_desk", CATEGORY),
    ("symbol", CATEGORY),
    ("original_notional", NUMERIC),
    ("notional", NUMERIC),
    ("type", CATEGORY),
    ("sec_amount", NUMERIC),
    ("status", CATEGORY),
    ("audit_action", CATEGORY),
    ("type_cftr", CATEGORY),
    ("currency_cftr", CATEGORY),
    ("notional_cftr", NUMERIC),
    ("remaining_notional_cftr", NUMERIC),
]


@dataclass(frozen=True)
class Layout:
    fields: tuple[tuple[str, str], ...]
    sep: str = ","
    encode_label: bool = False   # D4: the label among the encoded columns

    @staticmethod
    def of(fields: Sequence[tuple[str, str]], sep: str = ",", encode_label: bool = False) -> "Layout":
        return Layout(tuple((n, r) for n, r in fields), sep, encode_label)

    @property
    def width(self) -> int:
        return len(self.fields)

    def names(self, *roles: str) -> list[str]:
        return [n for n, r in self.fields if not roles or r in roles]

    @property
    def numeric(self) -> list[str]:
        return self.names(NUMERIC)

    @property
    def categorical(self) -> list[str]:
        """Encoded columns; the label is one of them only when asked (D4)."""
        return self.names(CATEGORY, LABEL) if self.encode_label else self.names(CATEGORY)

    @property
    def label(self) -> str | None:
        labels = self.names(LABEL)
        return labels[0] if labels else None


TRADE = Layout.of(TRADE_LAYOUT)


def _sep_regex(sep: str) -> str:
    return "\\" + sep if sep in ".[]{}()*+?^$|\\" else sep


def split_fields(line: Column, sep: str = ",", limit: int = -1) -> Column:
    """C-1: split with a limit (the last field keeps further separators)."""
    return F.split(line, _sep_regex(sep), limit)


def last_field(line: Column, sep: str = ",") -> Column:
    """C-2: last field after dropping trailing empty fields."""
    r = _sep_regex(sep)
    stripped = F.regexp_replace(line, f"({r})+$", "")
    return F.element_at(F.split(stripped, r), -1)


def _trimmed(field: Column) -> Column:
    """Without leading and trailing white space and control characters (code points up to a space)."""
    return F.regexp_replace(field, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def blank_to_zero(field: Column) -> Column:
    """C-4 / C-5: trimmed blank -> 0.0, else the number (ANSI cast raises on junk)."""
    t = _trimmed(field)
    return F.when(t == "", F.lit(0.0)).otherwise(t.cast("double"))


def blank_to_zero_or_null(field: Column) -> Column:
    """Permissive form: junk -> NULL (used by ``mode='drop'``)."""
    t = _trimmed(field)
    return F.when(t == "", F.lit(0.0)).otherwise(t.try_cast("double"))


def parse_records(df: DataFrame, layout: Layout = TRADE, line_col: str = "value",
                  mode: str = "fail", keep_line: bool = True) -> DataFrame:
    """C-7 / C-10: one typed column per non-dropped field (+ the original line)."""
    if mode not in ("fail", "drop"):
        raise ValueError("mode must be 'fail' or 'drop'")
    arr = split_fields(F.col(line_col), layout.sep, layout.width)
    width_ok = F.size(F.col("_f")) == F.lit(layout.width)
    cols: list[Column] = []
    for i, (name, role) in enumerate(layout.fields):
        raw = F.get(F.col("_f"), i)           # permissive access, NULL when short
        if role == DROP:
            continue
        if role == NUMERIC:
            v = blank_to_zero(raw) if mode == "fail" else blank_to_zero_or_null(raw)
            cols.append(v.alias(name))
        else:
            cols.append(raw.alias(name))
    base = df.select(*([F.col(line_col)] if keep_line else []), arr.alias("_f"))
    if mode == "fail":
        checked = base.withColumn(
            "_f", F.when(width_ok, F.col("_f")).otherwise(F.raise_error(F.concat(
                F.lit(f"record does not have {layout.width} fields: "), F.col(line_col)
                if keep_line else F.lit("")))))
        return checked.select(*([F.col(line_col)] if keep_line else []), *cols)
    out = base.where(width_ok).select(*([F.col(line_col)] if keep_line else []), *cols)
    return out.dropna(subset=layout.numeric) if layout.numeric else out
