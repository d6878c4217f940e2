"""Operators of kmstream.llm against brute force, on nulls, empty and odd rows, ties and repeats."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kmstream.llm import chat, graph, licences, mixing, near, packing, pages, pivots, quality, repeats, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(rng, n, sep=" "):
    return sep.join(rng.choice(WORDS, n))


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", f"src{(i or 0) % 3}", len(t) if t else None) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def rng():
    return np.random.default_rng(5)


# -- chat --------------------------------------------------------------------

@pytest.mark.parametrize("text", ["", "</s>[INST] ok [/INST]", r"<\s> <\\s> [\INST] <|end|>", "<|<|turn|>", "[[INST]]<s><s>", "a < b [c] |d|", "\\", "<\\|"])
def test_escape_round_trip(text):
    e = chat.escape(text)
    assert chat.unescape(e) == text
    assert not re.search(r"<\||</?s>|\[/?INST\]", e)


def test_parts_become_ordered_placeholders():
    def part(kind, **kw):
        return dict(type=kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None) | kw
    turns = [("user", [part("text", text="see "), part("image", ref="a.png", width=57, height=28), part("audio", ref="b.wav", seconds=1.5)]),
             ("assistant", [part("text", text="<|end|>"), part("document", ref="c.pdf", pages=2), part("smell", ref="d"), None]),
             (None, None)]
    out = chat.format_turns(turns)
    assert [(a["kind"], a["ref"], a["tokens"], a["turn_index"]) for a in out["attachments"]] == [
        ("image", "a.png", 3, 0), ("audio", "b.wav", 38, 0), ("document", "c.pdf", 512, 1), ("attachment", "d", 0, 1)]
    for a in out["attachments"]:
        assert out["formatted"][a["start"]:].startswith(f"<|{a['kind']}:{a['ordinal']}|>")
    assert chat.read_back(out["formatted"])[2] == ("", "") and len(chat.read_back(out["formatted"])) == 3
    (span,) = out["loss_spans"]
    assert chat.unescape(out["formatted"][span["start"]:span["stop"]]).startswith("<|end|><|document:2|>")


def test_conversations_with_nulls_ties_and_extra_columns(spark):
    rows = [(1, 0, "user", None, "x"), (1, 1, "assistant", "b", "x"), (1, 1, "assistant", "a", "x"), (None, None, None, "z", "x"), (1, 1, "assistant", "a", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = chat.formatted_digest(chat.format_conversations(df.withColumn("parts", chat.text_parts()))).collect()
    got = {r["conv_id"]: r for r in out}
    want = "user\n\nassistant\na\nassistant\na\nassistant\nb\n"
    assert got[1]["n_turns"] == 4 and got[1]["turns_sha256"] == hashlib.sha256(want.encode()).hexdigest()
    assert got[1]["loss_chars"] == 3 and got[1]["loss_sha256"] == hashlib.sha256(b"aab").hexdigest()
    assert got[None]["turns_sha256"] == hashlib.sha256(b"\nz\n").hexdigest()
    assert chat.format_conversations(df.withColumn("parts", chat.text_parts()).limit(0)).count() == 0


# -- quality -----------------------------------------------------------------

def test_quality_counts_match_brute_force(rng):
    for _ in range(60):
        lines = [prose(rng, int(rng.integers(0, 9))) + rng.choice([".", "", " |", "%%"]) for _ in range(6)]
        text = "\n".join(list(rng.choice(lines, 8)))
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
        own = [x for x in text.split("\n") if x.split()]
        n, chars, symbols, dup, rep, *_ = quality.judge(text)
        assert (n, chars, rep) == (len(words), sum(map(len, words)), len(hit))
        assert symbols == sum(c in "#*$%&|<>" for c in text) and dup == len(own) - len(set(own))


def test_quality_stage_keeps_clean_documents(spark, rng):
    def clean(n):
        return "\n".join(" ".join(f"w{rng.integers(10**9)}" for _ in range(12)).capitalize() + "." for _ in range(n))
    good, nav = clean(8), "\n".join("home | news | about | shop %d" % i for i in range(40))
    rows = [(1, good), (2, None), (3, ""), (4, nav), (5, good + "\nhome | news | about | x"), (6, clean(2)), (None, good)]
    df = docs_frame(spark, rows).withColumn("kept", F.lit("clash"))
    got = {r["doc_id"]: r for r in quality.clean_documents(df).collect()}
    assert set(got) == {1, 5, None} and got[5]["text"] == good and got[5]["n_chars"] == len(good)
    assert quality.clean_documents(df).columns == df.columns
    table = quality.with_quality(df)
    assert "kept_1" in table.columns and table.count() == len(rows)
    assert table.filter("doc_id in (2, 3)").select("kept_1").distinct().first()[0] is False


# -- graph and near-duplicates -------------------------------------------------

def test_components_of_random_graph(spark, rng):
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(900 + i, 901 + i) for i in range(40)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in graph.connected_components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert graph.connected_components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def brute_components(rows, n, percent=80):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    label = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                k = len(sets[a] & sets[b])
                if k and 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k):
                    label[a] = label[b] = min(label[a], label[b])
        if all(label[label[i]] == label[i] for i in label):
            break
    return sets, label


def test_near_duplicates_match_brute_force(spark, rng):
    """A crowd of near copies around the threshold: the star round leaves pairs to the block test."""
    base = prose(rng, 60).split()
    rows = [(0, None), (1, ""), (2, "one two"), (3, "ONE two"), (4, " "), (5, prose(rng, 40))]
    for i in range(6, 70):
        copy = list(base)
        for at in rng.integers(0, 60, int(rng.integers(0, 4))):
            copy[at] = f"x{rng.integers(50)}"
        rows.append((i, " ".join(copy)))
    rows.append((70, rows[10][1]))
    sets, label = brute_components(rows, 4)
    df = docs_frame(spark, rows).withColumn("node", F.lit(1))
    got = {r["doc_id"]: r for r in near.near_duplicates(spark, df, near.NearRules(words=4, block=16)).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == label
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert all(r["kept"] == (i == label[i]) for i, r in got.items())
    stays = near.deduplicated(spark, df.union(df.filter("doc_id = 5")), near.NearRules(words=4))
    assert stays.columns == df.columns and sorted(r["doc_id"] for r in stays.collect()) == sorted(set(label.values()))
    empty = df.limit(0)
    assert near.near_duplicates(spark, empty).count() == 0 and near.deduplicated(spark, empty).count() == 0


def test_near_duplicates_without_ids(spark, rng):
    t = prose(rng, 30)
    got = near.near_duplicates(spark, docs_frame(spark, [(None, t), (7, t), (None, None), (None, "other text here only")])).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in got) == [("7", "7"), ("None", "7"), ("None", "None"), ("None", "None")]


# -- repeated passages ---------------------------------------------------------

def brute_repeats(texts, length):
    where = {}
    for d, t in enumerate(texts):
        for i in range(len(t) - length + 1):
            where.setdefault(t[i:i + length], []).append((d, i))
    out = []
    for d, t in enumerate(texts):
        gone = np.zeros(len(t) + 1, bool)
        for places in where.values():
            if len(places) > 1:
                for e, i in places:
                    if e == d:
                        gone[i:i + length] = True
        out.append(gone[:len(t)])
    return out


@pytest.mark.parametrize("length,reach,gram,group", [(40, 16, 5, 4), (30, 16, 8, 16), (25, 2, 4, 1)])
def test_repeats_match_brute_force(spark, rng, length, reach, gram, group):
    rules = repeats.RepeatRules(length=length, reach=reach, gram=gram, group=group)
    passage, other = prose(rng, 30), "é" * 50
    texts = [prose(rng, 60), prose(rng, 25) + passage + prose(rng, 20), passage[7:] + prose(rng, 15), prose(rng, 10) + passage[:-9], other + "x" + other,
             "ab" * 60, "", None, "short", passage[:length - 1], passage[3:3 + length], prose(rng, 30) + passage + " " + passage]
    texts += [texts[1], texts[1][:60] + "#" + texts[1][60:]]
    rows = [(i, t) for i, t in enumerate(texts)]
    raw = [(t or "").encode() for t in texts]
    want = brute_repeats(raw, length)
    got = {r["doc_id"]: r for r in repeats.repeat_digest(spark, docs_frame(spark, rows), rules).collect()}
    assert len(got) == len(rows)
    for i, gone in enumerate(want):
        kept = np.frombuffer(raw[i], np.uint8)[~gone].tobytes()
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["kept_sha256"]) == (len(raw[i]), int(gone.sum()), hashlib.sha256(kept).hexdigest()), i
        assert got[i]["n_spans"] == int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
    df = docs_frame(spark, rows + [(0, texts[0]), (None, texts[0])])
    cut = repeats.without_repeats(spark, df, rules)
    assert cut.columns == df.columns and cut.count() == len(rows) + 2
    assert {r["text"] for r in cut.filter("doc_id = 0 or doc_id is null").collect()} == {""}     # three copies lose all
    assert repeats.repeat_digest(spark, df.limit(0), rules).count() == 0


def test_repeats_inside_a_document_are_one_row(spark, monkeypatch):
    """op6: a passage that fills documents has a row per document and digit, not one per place."""
    rng, stored = np.random.default_rng(6), repeats.stored
    rules = repeats.RepeatRules(length=40, reach=16, gram=5, group=4)
    line = prose(rng, 12) + "\n"
    texts = [line * 60, prose(rng, 20) + line * 50 + prose(rng, 20), prose(rng, 10) + line + prose(rng, 10), "ab" * 300, (prose(rng, 9) + "\n") * 40, prose(rng, 50)]
    seen = {}

    def kept(spark, df, name):
        seen[name] = stored(spark, df, name)
        return seen[name]

    monkeypatch.setattr(repeats, "stored", kept)
    got = {r["doc_id"]: r for r in repeats.repeat_digest(spark, docs_frame(spark, list(enumerate(texts))), rules).collect()}
    raw = [t.encode() for t in texts]
    for i, gone in enumerate(brute_repeats(raw, rules.length)):
        kept_bytes = np.frombuffer(raw[i], np.uint8)[~gone].tobytes()
        assert (got[i]["n_removed"], got[i]["kept_sha256"]) == (int(gone.sum()), hashlib.sha256(kept_bytes).hexdigest()), i
    rows = {"base": seen["repeats-base"].select("rid", F.explode("digits").alias("h")).groupBy("rid", "h")}
    rows |= {k: seen[f"repeats-{k}"].groupBy("rid", "h", "f") for k in ("anchors", f"groups-{rules.group}", "groups-1")}
    for name, by in rows.items():
        assert by.count().filter("count > 1").count() == 0, name
    assert seen["repeats-anchors"].count() > 0


# -- packing -----------------------------------------------------------------

def test_plan_fills_bins_without_gaps(rng):
    for _ in range(30):
        cap = int(rng.integers(5, 60))
        hist = {int(n): int(c) for n, c in zip(rng.choice(np.arange(1, cap + 1), size=min(cap, 8), replace=False), rng.integers(1, 40, 8))}
        runs, bins = packing.plan_slots(hist, cap)
        used, total = {}, 0
        for n in hist:
            own = runs[runs[:, 0] == n]
            for r in range(hist[n]):
                _, first, seq, k, off = own[np.searchsorted(own[:, 1], r, "right") - 1]
                j = r - first
                used.setdefault(seq + j // k, []).append((off + (j % k) * n, n))
            total += n * hist[n]
        assert set(used) == set(range(bins))
        for slots in used.values():
            at = 0
            for off, n in sorted(slots):
                assert off == at
                at += n
            assert at <= cap
        # plain best fit, longest first, one piece at a time
        rooms = []
        for n in sorted(hist, reverse=True):
            for _ in range(hist[n]):
                fits = [r for r in rooms if r >= n]
                if fits:
                    rooms[rooms.index(min(fits))] -= n
                else:
                    rooms.append(cap - n)
        assert bins == len(rooms)


def test_packing_matches_the_tokenizer(spark, rng):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    tok = Tokenizer.from_file(path)
    odd = ["It's. a,b . , c.\nD..\n x_. y", "<|endoftext|>. a<|startoftext|>b", "ΣΑΣ ab́. İx. Å", "a\x1cb. c\x85d\xa0e.", "%%%. the.%%% of, ., don't. 'll", "", None,
           " ", "x1.5. 3,4, é. É, é.\r\nX.\tY", "日本語 テキスト。 text", "Straße. ĲŒ. ŉ. ſt"]
    rows = list(enumerate(odd)) + [(100 + i, prose(rng, int(rng.integers(1, 300)))) for i in range(40)] + [(100, "same"), (None, "none")]
    rules = packing.PackRules(capacity=64)
    df = docs_frame(spark, rows).withColumn("offset", F.lit("clash"))
    out = packing.pack(spark, packing.token_pieces(df, path, rules), rules).toPandas()
    want = []
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for p, at in enumerate(range(0, len(ids), 64)):
            cut = np.asarray(ids[at:at + 64], "<u4")
            want.append((-1 if i is None else i, p, at, len(cut), zlib.crc32(cut.tobytes())))
    got = [(-1 if r.doc_id != r.doc_id else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in out.itertuples()]
    assert sorted(got) == sorted(want)
    for _, seq in out.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert (seq["offset"].to_numpy() == (seq["length"].cumsum() - seq["length"]).to_numpy()).all() and seq["length"].sum() <= 64
    assert out["sequence_id"].nunique() <= math.ceil(out["length"].sum() / 64) + 1
    assert packing.pack(spark, packing.token_pieces(df.limit(0), path, rules), rules).count() == 0


# -- mixing ------------------------------------------------------------------

def fill(children, budget):
    """Reference water filling: (name, weight, capacity) -> shares, by repeated rounds."""
    shares, left, open_ = {}, budget, dict((n, (w, c)) for n, w, c in children)
    while open_:
        total = sum(w for w, _ in open_.values())
        full = [n for n, (w, c) in open_.items() if c * total <= left * w]
        if not full:
            for n, (w, c) in open_.items():
                shares[n] = left * w / total
            break
        for n in full:
            shares[n] = open_.pop(n)[1]
        left = budget - sum(shares.values())
    return shares


def test_leaf_budgets_match_water_filling(spark, rng):
    rules = mixing.MixRules(domains={"a": 5, "b": 1}, languages={"en": 3}, sources={"s1": 4}, max_epochs=2, budget_percent=90)
    leaves = [(d, la, s, int(rng.integers(0, 2000))) for d in ("a", "b", None) for la in ("en", "de") for s in ("s1", "s2", None)]
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long")
    got = {(r["domain"], r["lang"], r["source"]): r["share"] for r in mixing.leaf_budgets(df, rules).collect()}
    budget = sum(x[3] for x in leaves) * 90 // 100
    assert abs(sum(got.values()) - budget) <= 0
    dom = fill([(d, rules.domains.get(d, 1), 2 * sum(x[3] for x in leaves if x[0] == d)) for d in ("a", "b", None)], budget)
    for d in dom:
        lang = fill([(la, rules.languages.get(la, 1), 2 * sum(x[3] for x in leaves if x[:2] == (d, la))) for la in ("en", "de")], dom[d])
        for la in lang:
            src = fill([(s, rules.sources.get(s, 1), 2 * sum(x[3] for x in leaves if x[:3] == (d, la, s))) for s in ("s1", "s2", None)], lang[la])
            for s, want in src.items():
                assert abs(got[(d, la, s)] - want) < 4


def test_mixed_documents_follow_the_plan(spark, rng):
    rows = [(i, prose(rng, int(rng.integers(0, 12)))) for i in range(80)] + [(200, None), (201, ""), (3, "again"), (3, "again"), (None, "no id")]
    df = docs_frame(spark, rows).withColumn("mix_nth", F.lit("clash"))
    rules = mixing.MixRules(domains={"web": 1}, languages={}, digit_bits=2, max_epochs=3, budget_percent=150)
    plan = mixing.mix(spark, df, rules).toPandas()
    total = sum(len((t or "").split()) for _, t in rows)
    assert plan["taken"].sum() == total * 150 // 100
    assert (plan["taken"] <= plan["n_tokens"]).all()
    for _, leaf in plan.groupby("source"):
        assert (leaf["taken"] < leaf["n_tokens"]).sum() <= 1          # one document at the cut
    out = mixing.mixed_documents(spark, df, rules)
    assert out.columns == df.columns
    texts = [r["text"] for r in out.collect()]
    assert len(texts) == len(plan) and sum(len((t or "").split()) for t in texts) == plan["taken"].sum()
    assert mixing.mix(spark, df.limit(0), rules).count() == 0
    again = mixing.mix(spark, df.repartition(7), rules).toPandas()
    key = ["doc_id", "epoch", "n_tokens", "taken"]
    assert sorted(map(tuple, plan[key].fillna(-1).to_numpy())) == sorted(map(tuple, again[key].fillna(-1).to_numpy()))


def test_vectors_link_with_those_of_their_length(spark, rng):
    base = rng.normal(size=(40, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(100 + i, (v + 0.01).tolist()) for i, v in enumerate(base[:10])]
    rows += [(200, [1.0, 2.0, 3.0, 4.0]), (201, [1.0, 2.0, 3.0, 4.0]), (202, [2.0, 4.0, 6.0, 8.1]), (203, [4.0, -3.0, 2.0, -1.0]), (204, [5.0]), (205, [7.0])]
    got = {r["vec_id"]: r for r in pivots.embedding_duplicates(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    for i, v in rows:
        near = [j for j, u in rows if j != i and len(u) == len(v) and np.dot(u, v) / np.linalg.norm(u) / np.linalg.norm(v) >= 0.9]
        assert got[i]["n_links"] == len(near)
    assert [got[i]["component_id"] for i in (200, 201, 202, 203, 204, 205)] == [200, 200, 200, 203, 204, 204]


# -- near-duplicate stage ----------------------------------------------------

def test_one_row_of_a_group_stays_whatever_its_ids_are(spark, rng):
    """200 near copies without ids, as many with one repeated id, exact copies among them, and rows without words."""
    def copies(n):
        words = prose(rng, 200).split()
        out = []
        for k in range(n):
            own = list(words)
            if k % 4:
                own[int(rng.integers(0, 200))] = f"x{k}"
            out.append(" ".join(own))
        return out
    rows = [(None, t) for t in copies(200)] + [(7, t) for t in copies(200)] + [(50 + k, t) for k, t in enumerate(copies(5))]
    rows += [(None, ""), (None, ""), (7, None), (99, " \n ")]
    df = docs_frame(spark, rows).withColumn("component", F.lit("clash"))
    out = near.deduplicated(spark, df)
    assert out.columns == df.columns
    got = [(r["doc_id"], bool((r["text"] or "").strip())) for r in out.collect()]
    assert sorted(got, key=repr) == sorted([(None, True), (7, True), (50, True), (None, False), (None, False), (7, False), (99, False)], key=repr)
    assert near.deduplicated(spark, df.limit(0)).count() == 0


# -- pages -------------------------------------------------------------------

PAGE = ('<html><head><title>T</title><script>var a="<p>no</p>";</script></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav>'
        '<div class="ad-7">Buy now cheap cheap cheap cheap cheap cheap cheap cheap cheap.</div><div class="{c}"><h1>Head &amp; line</h1>'
        '<p><b>First  &lt;one&gt;\n two.<br><p>Second&nbsp;para &eacute;</p><div class="comments"><p>Great post! {x}</p></div><p></p></div>'
        '<footer>&copy; us</footer>')
TEXT = "Head & line\nFirst <one> two.\nSecond para é"


def test_pages_agree_on_a_path_per_host(spark):
    long = "comment " * 40
    rows = [(i, f"http://H.example.org:80/{i}", PAGE.format(c=f"post-{i}", x="")) for i in range(5)]
    rows += [(9, "https://u@h.example.org/9", PAGE.format(c="post-9", x=long)), (10, None, PAGE.format(c="body", x="")), (11, "http://x.org/", None),
             (12, "http://x.org/a", ""), (13, "nonsense", "<p>only"), (5, rows[0][1], rows[0][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("path", F.lit("clash")).withColumn("host", F.lit("clash"))
    got = pages.extract_pages(df).collect()
    text = {r["page_id"]: r["text"] for r in got}
    assert len(got) == len(rows) and all(text[i] == TEXT for i in (0, 1, 2, 3, 4, 5, 9, 10))
    assert text[11] == text[12] == "" and all(r["n_chars"] == len(r["text"]) for r in got)
    assert {r["path"] for r in got if r["page_id"] < 10} == {"/html/body/div.post-#"}
    assert pages.extract_pages(df.limit(0)).count() == 0


WRAPPED = "<html><body>{a}<h1>Title</h1><p>First long paragraph of the article.</p><p>And the second one.</p>{b}<footer>us</footer></body></html>"


@pytest.mark.parametrize("a,b", [
    ('<div class="has-sidebar"><div>', "</div></div>"), ('<div id="page" class="no-banner"><div>', "</div></div>"), ('<main class="widget-area">', "</main>"),
    ('<article class="post category-social">', "</article>"), ('<form id="aspnetForm"><div class="c">', "</div></form>"),
    ('<form id="f"><header class="site-header"><p>Name of site</p></header><div class="c">', '</div><div class="site-footer"><p>foot</p></div></form>'),
    ('<div class="sidebar-left"><div class="c">', '</div></div><div class="sidebar-right"><p>Short note.</p></div>'), ('<header><div class="c">', "</div></header>"),
    ('<div class="ad-free"><div>', '<ol class="comment-list"><li>' + "me too " * 40 + "</li></ol></div></div>"), ('<article><header>', "</header></article>")])
def test_wrappers_are_not_furniture(a, b):
    want = "Title\nFirst long paragraph of the article.\nAnd the second one."
    assert pages.extract(pages.parse(WRAPPED.format(a=a, b=b)), None) == want


@pytest.mark.parametrize("outer,parts", [("article", ("section", "section")), ("main", ("div class=a", "div class=b")), ("div class=post", ("section", "blockquote")),
                                         ("div class=post", ("div class=a", "div class=b")), ("body", ("section", "section"))])
def test_article_of_unequal_parts_is_whole(spark, outer, parts):
    """A part that outweighs all others does not stand for the article, on its page or by its host's vote."""
    def part(tag, n):
        return f"<{tag}>" + "<p>" + "word " * n + f"</p></{tag.split()[0]}>"
    page = f"<html><body><nav><a href=x>Menu</a></nav><{outer}><h1>Head</h1><p>Intro</p>{part(parts[0], 70)}{part(parts[1], 30)}</{outer.split()[0]}><footer>us</footer></body></html>"
    want = "\n".join(["Head", "Intro", " ".join(["word"] * 70), " ".join(["word"] * 30)])
    assert pages.extract(pages.parse(page), None) == want
    df = spark.createDataFrame([(i, f"http://h.org/{i}", page) for i in range(3)], "page_id long, url string, html string")
    assert {r["text"] for r in pages.extract_pages(df).collect()} == {want}


def test_article_does_not_grow_into_the_page():
    page = "<body><h1>Site</h1><div class=text><p>" + "word " * 60 + "</p></div><div class=other><p>About this site.</p></div></body>"
    assert pages.extract(pages.parse(page), None) == " ".join(["word"] * 60)


@pytest.mark.parametrize("page,want", [
    ("<p><a href=x title=Bob's>Hello link</a> and we don't stop <b>here</b>.</p>", "Hello link and we don't stop here."),
    ("<p title='a > b' class=\"c > d\">Kept.</p>", "Kept."),
    ("<p data-x = 'it is' y=\"x=1\">Kept, don't <i title=o'>lose</i> it's.</p>", "Kept, don't lose it's."),
    ("<p title=\"class=ad\" data-class=ad>Kept too.</p>", "Kept too."),
    ("<p class=ad>Gone.</p><p>Kept.</p>", "Kept."),
    ("<p title=\"open>Kept.</p>", "Kept."),
    ("<p><a href=/a/b/>One</a> two.</p>", "One two."),
])
def test_quotes_in_tags(page, want):
    assert pages.extract(pages.parse(f"<html><body><div>{page}</div></body></html>")) == want


@pytest.mark.parametrize("page", ["<p>Some text.</p>", "Some text.", "<html><p>Some text.", "<title>T</title><div><p>Some text.</div>"])
def test_page_without_a_body(page):
    assert pages.extract(pages.parse(page)) == "Some text."


def _made_page(rng, template, k):
    """(html, article text) of a page of one of two templates; the text is known from making it."""
    paragraphs = [prose(rng, int(rng.integers(15, 60))) + "." for _ in range(int(rng.integers(2, 6)))]
    title, noise = prose(rng, 4).title(), prose(rng, int(rng.integers(3, 9)))
    inner = f"<h1 title=it's>{title}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs)
    menu = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in WORDS[:6])
    if template == "post":
        body = f'<div class="tagline">{noise}</div><div class="post-{k}">{inner}<div class="comments"><p>{noise * 9}</p></div></div>'
    else:   # the article lies in a section; a small div sits on the path of the other template's article
        body = f'<div class="post-{k}">{noise}</div><section class="story">{inner}</section><div class="sidebar"><p>{noise}</p></div>'
    page = f"<html><head><title>{noise}</title></head><body><nav><ul>{menu}</ul></nav>{body}<footer>{noise}</footer></body></html>"
    return page, "\n".join([title, *paragraphs])


def test_two_templates_on_one_host(spark, rng):
    rows, want = [], {}
    for host, shares in (("a.org", (30, 12)), ("b.org", (3, 30)), ("c.org", (20, 1))):
        for template, n in zip(("post", "story"), shares):
            for _ in range(n):
                i = len(rows)
                page, want[i] = _made_page(rng, template, i)
                rows.append((i, f"http://{host}/{i}", page))
    got = pages.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == want


def test_small_node_on_the_winning_path_does_not_stand_for_the_article():
    page = "<html><body><div>Site tagline</div><section>" + "<p>" + "word " * 60 + "</p></section></body></html>"
    text, path = pages.choose(pages.parse(page), ["/html/body/div"])
    assert text == " ".join(["word"] * 60) and path is None


def test_kept_columns_may_have_the_results_names(spark):
    df = spark.createDataFrame([(1, "http://h.org", "<p>Some text.</p>", "h", "p", "t", "n")], "page_id long, url string, html string, host string, path string, text string, found string")
    got = pages.extract_pages(df, keep=("host", "path", "text", "found")).first().asDict()
    assert (got["host"], got["path_1"], got["text_1"], got["found"], got["text"]) == ("h", "p", "t", "n", "Some text.")


def test_very_long_page(spark):
    page = "<html><body><article>" + "<p>one two three.</p>" * 30_000 + "</article></body></html>"
    (r,) = pages.extract_pages(spark.createDataFrame([(1, "http://h.org", page)], "page_id long, url string, html string")).collect()
    assert r["n_chars"] == 30_000 * 15 - 1


# -- embeddings --------------------------------------------------------------

def test_pivot_index_recall_near_the_threshold(spark, rng):
    """Pairs planted at cosines from 0.9 up: at least nine tenths are found, none below the threshold."""
    x = rng.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows, cosines = list(x), rng.uniform(0.86, 0.99, 700)
    for v, c in zip(x, cosines):
        u = rng.normal(size=64)
        u -= (u @ v) * v
        rows.append(c * v + math.sqrt(1 - c * c) * u / np.linalg.norm(u))
    m = np.stack(rows)
    want = m / np.linalg.norm(m, axis=1)[:, None]
    link = want @ want.T >= 0.9
    np.fill_diagonal(link, False)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(m)], "vec_id long, embedding array<double>, label int")
    got = pivots.embedding_duplicates(spark, df, pivots.PivotRules(block=128)).toPandas().set_index("vec_id")["n_links"]
    full = link.sum(axis=1)
    assert (got.sort_index().to_numpy() <= full).all()
    recall = got.sum() / full.sum()
    assert recall >= 0.9, recall


def test_embeddings_with_odd_rows(spark, rng):
    v = rng.normal(size=8).tolist()
    rows = [(1, v), (2, v), (3, [2 * x for x in v]), (4, None), (5, [0.0] * 8), (6, [float("nan")] + v[1:]), (7, [None] + v[1:]), (8, v[:4]), (9, []),
            (10, [float("inf")] + v[1:]), (11, [-x for x in v]), (2, v), (None, v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("node", F.lit(0))
    got = pivots.embedding_duplicates(spark, df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["vec_id"] in (1, 2, 3, None):
            assert (r["n_links"], r["component_id"]) == (4, 1)
        else:
            assert (r["n_links"], r["component_id"], r["kept"]) == (0, r["vec_id"], True)
    assert pivots.embedding_duplicates(spark, df.limit(0)).count() == 0


def test_hot_vector_group_is_counted_in_blocks(spark, rng):
    base = rng.normal(size=32)
    m = np.stack([base + 0.05 * rng.normal(size=32) for _ in range(300)] + [rng.normal(size=32) for _ in range(200)])
    n = m / np.linalg.norm(m, axis=1)[:, None]
    link = n @ n.T >= 0.9
    np.fill_diagonal(link, False)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>")
    got = pivots.embedding_duplicates(spark, df, pivots.PivotRules(block=40)).toPandas().set_index("vec_id").sort_index()
    assert (got["n_links"].to_numpy() == link.sum(axis=1)).all() and got["component_id"].to_numpy()[:300].max() == 0


# -- toxicity ----------------------------------------------------------------

def test_folding():
    assert toxicity.fold("1D10T idiot ІDІОТ ｉｄｉｏｔ id​iot!") == ["idiot".replace("l", "i")] * 5
    assert toxicity.fold("") == [] and toxicity.fold("cool!!") == ["cooi"]


def test_toxicity_learns_stems_and_exceptions(spark, rng):
    clean_words = [f"{a}{b}" for a in WORDS for b in ("ing", "er", "ly")] + ["badger"]
    rows = []
    for i in range(600):
        toxic = i % 5 == 0
        words = list(rng.choice(clean_words, 40))
        if toxic:
            for at in rng.integers(0, 40, 3):
                words[at] = rng.choice(["badwordy", "b4dw0rding", "bаdwordest"])
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(700, None), (701, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows] + [(700, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.learn(spark, toxicity.labelled_sample(docs, labels.filter("doc_id % 4 <> 0"), toxicity.ToxicRules()))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(spark, docs, model).collect()}
    held = [(got[i], x) for i, _, x in rows if i % 4 == 0]
    assert sum((s >= 0.5) == bool(x) for s, x in held) / len(held) > 0.97
    assert got[700] == got[701] < 0.5 and "^badger$" not in {e for e, w in model.weights.items() if w > 0}
    none = toxicity.learn(spark, toxicity.labelled_sample(docs, labels.limit(0), toxicity.ToxicRules()))
    assert toxicity.score(spark, docs.limit(3), none).select("score").distinct().count() == 1


def test_toxicity_ranks_candidates_by_certainty_not_frequency(spark, rng):
    """A rare word that only toxic rows hold goes before more frequent words that clean rows hold as well."""
    words = [f"{chr(97 + k // 8)}{chr(97 + k % 8)}qu" for k in range(60)]
    rows = []
    for i in range(400):
        toxic = i % 4 == 0
        usual = [w for w in words if rng.random() < (0.67 if toxic else 0.12)]
        rows.append((" ".join(usual + ["zorkbad"] * (toxic and i % 8 == 0)), int(toxic)))
    model = toxicity.learn(spark, spark.createDataFrame(rows, "text string, toxic int"), toxicity.ToxicRules(max_entries=4))
    assert any(e.startswith("^zor") and w > 0 for e, w in model.weights.items())


def test_toxicity_replaces_a_column_of_the_scores_name(spark):
    df = spark.createDataFrame([(1, "x", "old"), (None, None, "old")], "doc_id long, text string, score string")
    out = toxicity.score(spark, df, toxicity.ToxicModel({}, (0.0, 0, 0, 0, 0), (1, 1, 1, 1)))
    assert out.columns == df.columns and [r["score"] for r in out.collect()] == [0.5, 0.5]


def test_toxicity_learns_phrases(spark, rng):
    """A bad word inside a harmless phrase of clean rows, and a bad phrase of usual words."""
    usual = [f"{a}{b}" for a in WORDS for b in ("ing", "er", "ly")]
    rows = []
    for i in range(800):
        words = list(rng.choice(usual, 40))
        kind = i % 8
        if kind == 0:
            words[7:7] = ["moronish"]
        elif kind == 1:
            words[20:20] = ["drop", "dead"]
        elif kind == 2 and i % 3 == 0:
            words[11:11] = ["famous", "moronish"]                       # the exception phrase, in clean rows only
        else:
            words[3:3], words[30:30] = ["drop"], ["dead"]               # usual words by themselves
        rows.append((i, " ".join(words), int(kind < 2)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int")
    model = toxicity.learn(spark, toxicity.labelled_sample(docs, labels.filter("doc_id % 5 <> 0"), toxicity.ToxicRules()))
    assert model.weights["^famous$^moronish$"] == 0 and model.weights["^drop$^dead$"] > 1.5
    got = {r["doc_id"]: r["score"] for r in toxicity.score(spark, docs, model).collect()}
    held = [(got[i], x) for i, _, x in rows if i % 5 == 0]
    assert sum((s >= 0.5) == bool(x) for s, x in held) / len(held) > 0.97


def test_longer_entries_override_what_they_cover():
    weights = {"^bad": 2.0, "^badge$": 0.0, "^not$^bad$": 0.0, "^so$^not$": 3.0, "^bad$^day$": 0.0}
    lexicon = toxicity.Lexicon(weights)
    for text, hits in [("bad", 1), ("badge", 0), ("not bad", 0), ("so not bad", 1), ("bad day", 0), ("not badly", 1), ("bad bad day", 1), ("", 0)]:
        assert lexicon.figures(text)[3] == hits, text


# -- licences ----------------------------------------------------------------

def test_licences_and_inheritance(spark, rng):
    apache = "Licensed under the Apache License, Version 2.0."
    body = prose(rng, 60)
    rows = [(1, "a/LICENSE", apache + " " + body), (2, "a/b/c/x.py", body), (3, "a/b/y.py", f"{body}. Released under the MIT License. {body}"), (4, "a/b/COPYING", None),
            (5, "z/w.py", body), (6, None, apache), (7, "a/b/d/note.txt", "This work is licensed under the GNU General Public License, version 3."),
            (8, "a/b/d/e/f.py", ""), (9, "a/q.py", "the license of the under version"), (2, "a/b/c/x.py", body)]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string").withColumn("row", F.lit(0)).withColumn("word", F.lit(""))
    out = licences.license_scan(spark, df).collect()
    got = {r["doc_id"]: r for r in out}
    assert len(out) == len(rows)
    assert [(got[i]["license"], got[i]["origin"]) for i in (1, 2, 3, 5, 6, 7, 8, 9)] == [
        ("Apache-2.0", "licence_file"), ("Apache-2.0", "inherited"), ("MIT", "header"), (None, "none"), ("Apache-2.0", "licence_file"),
        ("GPL-3.0", "licence_file"), ("GPL-3.0", "inherited"), ("Apache-2.0", "inherited")]
    assert got[2]["from_directory"] == "a" and got[8]["from_directory"] == "a/b/d" and got[4]["license"] == "Apache-2.0"
    assert licences.license_scan(spark, df.limit(0)).count() == 0


def test_required_words_lose_no_unit(rng):
    """Whatever scores holds a required word: random units against the plain cosine."""
    rules = licences.LicenceRules()
    vocab = licences.vocabulary(rules)
    idf = {w: licences.idf_of(1000, int(rng.integers(0, 1000))) for w in vocab}
    rows, required = licences.template_weights(rules, idf)
    by = {}
    for t, _, w, x in rows:
        by.setdefault(t, {})[w] = x
    for _ in range(3000):
        unit = list(rng.choice(vocab, int(rng.integers(1, 12))))
        x = {w: unit.count(w) * idf[w] for w in set(unit)}
        norm = math.sqrt(sum(v * v for v in x.values()))
        if max(sum(x.get(w, 0) * v for w, v in t.items()) / norm for t in by.values()) >= rules.cosine:
            assert set(unit) & set(required)
