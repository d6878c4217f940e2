"""C-1..C-8: parsing of delimited trade records (synthetic lines)."""

import pytest
from pyspark.sql import functions as F

from kmstream.functions.stats import k_rule_of_thumb
from kmstream.sources.records import (TRADE, blank_to_zero, last_field, parse_records,
                                      split_fields)


def trade_line(i, qty="7500000.0", sec="", tail=("", "", "", "")):
    f = [str(20141015 + i), "IRSwap", f"T{i:03d}", "BOOK1", "CP1", "20141015", qty, "USD", "",
         "S", "20150326", "20150326 23:31:48", "6", "DESC", "20150326", "LE", "DESK", "",
         qty, qty, "Amend", sec, "", "ACCEPT", *tail]
    assert len(f) == 28
    return ",".join(f)


def lines_df(spark, lines):
    return spark.createDataFrame([(l,) for l in lines], "value string")


def test_layout_roles():
    assert TRADE.width == 28
    assert len(TRADE.numeric) == 10
    assert len(TRADE.categorical) == 16 and TRADE.label == "trade_id"
    # fixed values: the numeric fields of the record
    assert TRADE.numeric == ["trade_date", "start_date", "quantity", "trade_version",
                             "effective_date", "original_notional", "notional", "sec_amount",
                             "notional_cftr", "remaining_notional_cftr"]


def test_parse_blank_numeric_is_zero(spark):
    df = lines_df(spark, [trade_line(0), trade_line(1, sec="  ", tail=("A", "C", "1", "1"))])
    rows = parse_records(df, TRADE).orderBy("trade_id").collect()
    assert rows[0]["sec_amount"] == 0.0 and rows[0]["notional_cftr"] == 0.0
    assert rows[1]["sec_amount"] == 0.0                      # spaces only -> 0.0
    assert rows[1]["remaining_notional_cftr"] == 1.0
    assert rows[0]["instrument_description"] == ""           # blank category is ''
    assert "trade_mod_date" not in rows[0].asDict()


def test_long_decimal_and_negative(spark):
    df = lines_df(spark, [trade_line(0, qty="300000000.0000000000", sec="-5000000.0")])
    r = parse_records(df, TRADE).first()
    assert r["quantity"] == 300000000.0 and r["sec_amount"] == -5000000.0


def test_too_few_fields_fail_and_drop(spark):
    df = lines_df(spark, ["1,2,3,4,5,6,7,8,9,10", trade_line(0)])
    with pytest.raises(Exception):
        parse_records(df, TRADE).collect()
    assert parse_records(df, TRADE, mode="drop").count() == 1


def test_junk_numeric_fail_and_drop(spark):
    df = lines_df(spark, [trade_line(0, qty="abc"), trade_line(1)])
    with pytest.raises(Exception):
        parse_records(df, TRADE).collect()
    assert parse_records(df, TRADE, mode="drop").count() == 1


def test_extra_commas_stay_in_last_field(spark):
    line = trade_line(0, tail=("", "", "", "1,extra,more"))
    df = lines_df(spark, [line])
    arr = df.select(split_fields(F.col("value"), ",", 28).alias("f")).first()["f"]
    assert len(arr) == 28 and arr[-1] == "1,extra,more"


def test_last_field_skips_trailing_blanks(spark):
    df = lines_df(spark, [trade_line(0), "a,b,c", "a,b,,,", ""])
    got = [r[0] for r in df.select(last_field(F.col("value"))).collect()]
    assert got == ["ACCEPT", "c", "b", ""]


def test_blank_to_zero_expression(spark):
    df = spark.createDataFrame([("",), ("  ",), ("2.5",), (" 3 ",)], "v string")
    assert [r[0] for r in df.select(blank_to_zero(F.col("v"))).collect()] == [0.0, 0.0, 2.5, 3.0]


@pytest.mark.parametrize("n,k", [(0, 0), (1, 0), (10, 2), (11, 2), (500, 15), (60000, 173)])
def test_rule_of_thumb(n, k):
    assert k_rule_of_thumb(n) == k


def test_text_source_and_kafka_decode(spark):
    from kmstream.session import scratch_dir
    from kmstream.sinks.tables import centers_text, write_text
    from kmstream.sources.streams import decode_kafka_value
    from kmstream.sources.tables import text_lines
    lines = [trade_line(i) for i in range(3)]
    path = scratch_dir(spark, "lines")
    write_text(lines_df(spark, lines), "value", path)
    back = text_lines(spark, path)
    assert sorted(r["value"] for r in back.collect()) == sorted(lines)
    raw = spark.createDataFrame([(b"k", lines[0].encode())], "key binary, value binary")
    assert decode_kafka_value(raw).first()["value"] == lines[0]
    cf = spark.createDataFrame([(0, [1.0, 2.5])], "cluster long, center array<double>")
    assert centers_text(cf).first()["line"] == "1.0,2.5"


def test_any_white_space_is_blank(spark):
    df = spark.createDataFrame([("\t",), (" \t\r",), ("",), (" 7\t",)], "f string")
    assert [r[0] for r in df.select(blank_to_zero(F.col("f"))).collect()] == [0.0, 0.0, 0.0, 7.0]


def test_label_can_be_encoded():
    from kmstream.sources.records import TRADE_LAYOUT, Layout
    both = Layout.of(TRADE_LAYOUT, encode_label=True)
    assert len(both.categorical) == 17 and "trade_id" in both.categorical
    assert "trade_id" not in TRADE.categorical
