"""D-1..D-4: category dictionary, one-hot, assembled width."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from kmstream.operators.encode import CategoryEncoder, category_dictionary, encode_features


def test_dictionary_is_alphabetical_dense(spark):
    vals = [f"v{i:04d}" for i in range(997)]
    df = spark.createDataFrame([(v, v[-1]) for v in vals] * 2, "a string, b string")
    d = category_dictionary(df.repartition(7), ["a", "b"], partitions=13)
    got = {(r["column"], r["category"]): r["idx"] for r in d.collect()}
    assert all(got[("a", v)] == i for i, v in enumerate(sorted(vals)))
    assert [got[("b", str(i))] for i in range(10)] == list(range(10))
    ref = (df.select("a").distinct()
           .select("a", (F.dense_rank().over(Window.orderBy("a")) - 1).alias("idx")))
    assert {r["a"]: r["idx"] for r in ref.collect()} == {k[1]: v for k, v in got.items() if k[0] == "a"}


def test_blank_is_a_category_and_unseen_raises(spark):
    df = spark.createDataFrame([("",), ("x",), ("y",)], "c string")
    model = CategoryEncoder(["c"]).fit(df)
    assert model.sizes == {"c": 3}
    idx = model.index(df).orderBy("c").collect()
    assert [r["c_idx"] for r in idx] == [0, 1, 2]
    new = spark.createDataFrame([("z",)], "c string")
    with pytest.raises(Exception):
        model.index(new).collect()
    assert model.index(new, handle_invalid="keep").first()["c_idx"] == 3


def test_encoded_width(spark):
    df = spark.createDataFrame([(1.0, "a", "p"), (2.0, "b", "p"), (0.0, "c", "q")],
                               "n double, c1 string, c2 string")
    vec, _ = encode_features(df, ["n"], ["c1", "c2"])
    rows = vec.select("n", "features").orderBy("n").collect()
    assert all(r["features"].size == 1 + 3 + 2 for r in rows)
    assert rows[0]["features"].numNonzeros() == 2      # n == 0 is not stored


def test_null_is_a_category(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, "")], "id long, c string")
    model = CategoryEncoder(["c"]).fit(df)
    assert model.sizes == {"c": 3}
    assert [r["c_idx"] for r in model.index(df).orderBy("id").collect()] == [0, 2, 1]
    only = CategoryEncoder(["c"]).fit(df.filter("c is not null"))
    assert only.index(df, handle_invalid="keep").orderBy("id").first()["c_idx"] == 2


def test_one_hot_slots(spark):
    from pyspark.ml.functions import vector_to_array
    df = spark.createDataFrame([(1, "b"), (2, "a")], "id long, c string")
    rows = CategoryEncoder(["c"]).fit(df).one_hot(df).orderBy("id").select(vector_to_array("c_vec")).collect()
    assert [r[0] for r in rows] == [[0.0, 1.0], [1.0, 0.0]]
