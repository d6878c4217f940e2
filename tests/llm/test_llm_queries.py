"""Registered queries of kmstream.llm and the pipeline on the small tables."""

import hashlib
import os
import re
import sys
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import corpus_pipeline  # noqa: E402
from check_oracle import digest  # noqa: E402
from kmstream.llm import mixing, near, packing, quality, repeats  # noqa: E402
from kmstream.llm.queries import QUERIES, SQL, tokenizer_path  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == sorted(set(numbers)) and set(range(1, 11)) <= set(numbers) and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = QUERIES[name](spark, SF).toPandas(), con.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and digest(got) == digest(want)


@pytest.mark.parametrize("name,table", [(n, t) for n, t in [
    ("op3_near_duplicates", "documents"), ("op4_html_extract", "pages"), ("op6_repeated_passages", "documents"),
    ("op7_embedding_duplicates", "embeddings"), ("op9_toxicity", "documents")]])
def test_one_row_per_input_row(spark, name, table):
    assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def _least(links, ids):
    """The smallest id that each can reach."""
    low = {i: i for i in ids}
    while True:
        before = dict(low)
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
        if low == before:
            return low


def test_near_duplicate_query_against_all_pairs(spark, texts):
    sets = {}
    for i, t in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets[i] = {tuple(words[k:k + 4]) for k in range(len(words) - 3)} or ({tuple(words)} if words else set())
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    low = _least(links, sets)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in QUERIES["op3_near_duplicates"](spark, SF).collect()}
    assert got == {i: (len(sets[i]), low[i], low[i] == i) for i in sets}


def test_passage_query_against_all_windows(spark, texts):
    raw = {i: t.encode() for i, t in texts.items()}
    seen = Counter(b[k:k + 400] for b in raw.values() for k in range(len(b) - 399))
    got = {r["doc_id"]: r for r in QUERIES["op6_repeated_passages"](spark, SF).collect()}
    assert set(got) == set(raw)
    for i, b in raw.items():
        gone = np.zeros(len(b) + 1, np.int64)
        for k in range(len(b) - 399):
            if seen[b[k:k + 400]] > 1:
                gone[k:k + 400] = 1
        kept = bytes(c for c, g in zip(b, gone) if not g)
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["kept_sha256"]) == (len(b), int(gone.sum()), hashlib.sha256(kept).hexdigest())
        assert got[i]["n_spans"] == int((np.diff(np.r_[0, gone]) == 1).sum())


def test_embedding_query_against_all_pairs(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = [r["vec_id"] for r in rows]
    x = np.array([r["embedding"] for r in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    low = _least([(ids[a], ids[b]) for a, b in zip(*np.nonzero(near))], ids)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in QUERIES["op7_embedding_duplicates"](spark, SF).collect()}
    assert got == {i: (int(near[k].sum()), low[i], low[i] == i) for k, i in enumerate(ids)}


def test_packing_query_against_the_tokenizer(spark, texts):
    from tokenizers import Tokenizer
    tokens = Tokenizer.from_file(tokenizer_path())
    want = {}
    for i, t in texts.items():
        ids = [*tokens.encode(t, add_special_tokens=False).ids, 1]
        for p in range(0, len(ids), 4096):
            part = ids[p:p + 4096]
            want[(i, p // 4096)] = (p, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    rows = QUERIES["op5_best_fit_packing"](spark, SF).toPandas()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows.itertuples()} == want and len(rows) == len(want)
    for _, seq in rows.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert (seq["offset"].to_numpy() == np.cumsum(np.r_[0, seq["length"].to_numpy()[:-1]])).all() and seq["length"].sum() <= 4096
    assert rows["sequence_id"].nunique() <= 1.05 * -(-rows["length"].sum() // 4096) + 1


def test_toxicity_on_held_out_rows(spark):
    """Held-out accuracy at sf0.01."""
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op9_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    assert (rows["predicted"] == rows["toxic"]).mean() > 0.93
    assert ((rows["predicted"] == 1) & (rows["toxic"] == 0)).mean() < 0.03


def test_pipeline_stages(spark):
    """Each stage's decisions on its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    out, seen = docs, []
    for name, stage in corpus_pipeline.STAGES:
        before, out = out, stage(spark, out, SF)
        out = spark.createDataFrame(out.toPandas(), out.schema) if out.count() else out
        seen.append((name, before, out))
    assert [s[0] for s in seen] == ["quality rules", "minhash near-dedup", "suffix-array dedup", "source mixing", "best-fit packing"]
    for _, before, after in seen[:4]:
        assert after.columns == docs.columns

    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    clean = {r["doc_id"]: r["text"] for r in seen[0][2].collect()}
    assert clean == {i: quality.judge(t)[8] for i, t in text.items() if quality.judge(t)[7]}

    groups = near.near_duplicates(spark, seen[1][1]).toPandas()   # ids are unique here: one row of a component is its smallest id
    assert {r["doc_id"] for r in seen[1][2].collect()} == set(groups["component_id"])

    gone = repeats.repeat_digest(spark, seen[2][1], corpus_pipeline.PASSAGES).toPandas().set_index("doc_id")
    for r in seen[2][2].collect():
        assert abs(len(r["text"].encode()) - (gone.loc[r["doc_id"], "n_bytes"] - gone.loc[r["doc_id"], "n_removed"])) <= 6 * gone.loc[r["doc_id"], "n_spans"]

    plan = mixing.mix(spark, seen[3][1]).toPandas()
    mixed = seen[3][2].toPandas()
    assert len(mixed) == len(plan) and mixed["text"].str.split().str.len().sum() == plan["taken"].sum()

    packed = seen[4][2].toPandas()
    pieces = packing.token_pieces(seen[4][1], tokenizer_path()).toPandas()
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, packed[key].to_numpy())) == sorted(map(tuple, pieces[key].to_numpy()))
    for _, seq in packed.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert (seq["offset"].to_numpy() == np.cumsum(np.r_[0, seq["length"].to_numpy()[:-1]])).all()
    assert corpus_pipeline.run(spark, SF).count() == len(packed)


def test_pipeline_removes_passages_of_over_fifty_words(spark):
    """A 51-word passage that two documents share goes, one that a single document has stays."""
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(900)]
    shared, single = " ".join(words[:51]), " ".join(words[51:102])
    texts = [" ".join(words[102:300]) + " " + shared + " " + " ".join(words[300:400]), " ".join(words[400:600]) + " " + shared,
             " ".join(words[600:800]) + " " + single, None, ""]
    docs = spark.createDataFrame([(i, t, "en", "src1", len(t) if t else None) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    out = {r["doc_id"]: r for r in corpus_pipeline.passage_dedup(spark, docs, SF).collect()}
    assert shared not in out[0]["text"] and shared not in out[1]["text"] and out[2]["text"] == texts[2]
    assert len(shared) - 4 <= len(texts[0]) - len(out[0]["text"]) <= len(shared) + 4 and out[0]["n_chars"] == len(out[0]["text"])
    assert out[3]["text"] is None and out[4]["text"] == ""
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
