"""Registered queries of this subpackage and their SQL.

Each query reads its whole table, applies one operator with its production
parameters and returns the full result; ``SQL`` holds the DuckDB text where
SQL can express the query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kmstream.llm import chat, licences, merkle, mixing, near, packing, pages, personal, pivots, quality, repeats, toxicity, trie
from kmstream.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f
    return add


# -- op1: mixing -------------------------------------------------------------

_M = mixing.MixRules()


def _case(column: str, given: dict) -> str:
    return "CASE " + " ".join(f"WHEN {column} = '{k}' THEN {w}" for k, w in sorted(given.items())) + f" ELSE {_M.default} END" if given else str(_M.default)


def _fill_sql(name: str, src: str, parent: str, child: str) -> str:
    """CTEs that share ``budget`` among the children of ``src`` (parent, child, w, cap, budget), as ``name``."""
    p = f"PARTITION BY {parent}"
    o = f"{p} ORDER BY cap::DOUBLE / w::DOUBLE, {child} NULLS FIRST"
    return f"""
{name}1 AS (SELECT *, coalesce(sum(cap) OVER ({o} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cb,
              coalesce(sum(w) OVER ({o} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS wb, sum(w) OVER ({p}) AS wa FROM {src}),
{name}2 AS (SELECT *, cap * (wa - wb) <= (budget - cb) * w AS is_full FROM {name}1),
{name}3 AS (SELECT *, budget - coalesce(sum(CASE WHEN is_full THEN cap END) OVER ({p}), 0) AS rest,
              sum(CASE WHEN NOT is_full THEN w END) OVER ({p}) AS wr FROM {name}2),
{name}4 AS (SELECT *, CASE WHEN is_full THEN cap ELSE (rest * w) // wr END AS base FROM {name}3),
{name}5 AS (SELECT *, rest - sum(CASE WHEN NOT is_full THEN base END) OVER ({p}) AS odd,
              sum(CASE WHEN is_full THEN 0 ELSE 1 END) OVER ({o} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS nth FROM {name}4),
{name} AS (SELECT * EXCLUDE (cb, wb, wa, is_full, rest, wr, base, odd, nth),
             CASE WHEN NOT is_full AND nth <= odd THEN base + 1 ELSE base END AS share FROM {name}5)"""


OP1_SQL = rf"""
WITH n AS (SELECT doc_id, lang, source, TRY_CAST(regexp_extract(source, '(\d{{1,9}})$', 1) AS BIGINT) AS num,
                  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens FROM documents),
d AS (SELECT *, CASE WHEN num < 6 THEN 'web' WHEN num < 13 THEN 'books' WHEN num IS NOT NULL THEN 'code' END AS domain FROM n),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens, sum(n_tokens)::HUGEINT * {_M.max_epochs} AS cap FROM d GROUP BY ALL),
tot AS (SELECT 0 AS root, least(sum(tokens) * {_M.budget_percent} // 100, sum(cap))::HUGEINT AS budget FROM leaf),
dom0 AS (SELECT 0 AS root, domain, sum(cap)::HUGEINT AS cap, ({_case('domain', _M.domains)})::HUGEINT AS w, any_value(budget) AS budget FROM leaf, tot GROUP BY domain),
{_fill_sql('dom', 'dom0', 'root', 'domain').strip()},
lan0 AS (SELECT l.domain, l.lang, l.cap, ({_case('l.lang', _M.languages)})::HUGEINT AS w, share::HUGEINT AS budget
         FROM (SELECT domain, lang, sum(cap)::HUGEINT AS cap FROM leaf GROUP BY ALL) l JOIN dom ON l.domain IS NOT DISTINCT FROM dom.domain),
{_fill_sql('lan', 'lan0', 'domain', 'lang').strip()},
src0 AS (SELECT l.domain, l.lang, l.source, l.tokens, l.cap, ({_case('l.source', _M.sources)})::HUGEINT AS w, lan.share::HUGEINT AS budget
         FROM leaf l JOIN lan ON l.domain IS NOT DISTINCT FROM lan.domain AND l.lang IS NOT DISTINCT FROM lan.lang),
{_fill_sql('src', 'src0', 'domain, lang', 'source').strip()},
plan AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN share // tokens ELSE {_M.max_epochs} END AS whole,
                CASE WHEN tokens > 0 THEN share % tokens ELSE 0 END AS cut FROM src),
k AS (SELECT d.doc_id, d.domain, d.lang, d.source, d.n_tokens, plan.whole::INTEGER AS whole, plan.cut::BIGINT AS cut
      FROM d JOIN plan ON d.domain IS NOT DISTINCT FROM plan.domain AND d.lang IS NOT DISTINCT FROM plan.lang AND d.source IS NOT DISTINCT FROM plan.source),
e AS (SELECT doc_id, domain, lang, source, unnest(range(whole))::INTEGER AS epoch, n_tokens, n_tokens AS taken FROM k),
h AS (SELECT *, ('0x' || substr(md5(concat_ws(':', {_M.seed}, whole, coalesce(doc_id::VARCHAR, 'null'))), 1, 15))::BIGINT AS place FROM k WHERE cut > 0),
r AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id NULLS FIRST, n_tokens ROWS UNBOUNDED PRECEDING) - n_tokens AS before FROM h)
SELECT * FROM e
UNION ALL SELECT doc_id, domain, lang, source, whole AS epoch, n_tokens, least(n_tokens, cut - before)::BIGINT AS taken FROM r WHERE before < cut
"""


@query("op1_mix_sources", OP1_SQL)
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document gives in each epoch to reach the target weights of domains, languages and sources."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixing.mix(spark, docs, _M).drop("text_hash")


# -- op2: chat formatting ----------------------------------------------------

_ESC = r"regexp_replace({}, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g')"

OP2_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, r, t)) AS turns_sha256,
       CAST(sum(CASE WHEN r = 'assistant' THEN length(t) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN r = 'assistant' THEN t ELSE '' END, '' ORDER BY turn NULLS FIRST, r, t)) AS loss_sha256,
       CAST(sum(length({_ESC.format('r')}) + length({_ESC.format('t')})
                + length('<|turn|>') + length('<|body|>') + length('<|end|>')) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""


@query("op2_chat_format", OP2_SQL)
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the planted one, formatted, then read back from the formatted strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)],
                                    "conv_id long, turn long, role string, text string")
    turns = rows.unionByName(planted).withColumn("parts", chat.text_parts("text"))
    return chat.formatted_digest(chat.format_conversations(turns))


# -- op6: repeated passages --------------------------------------------------

@query("op6_repeated_passages")
def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the bytes of 400-byte strings that start twice."""
    return repeats.repeat_digest(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))


# -- op7: embedding near-duplicates ------------------------------------------

@query("op7_embedding_duplicates")
def op7_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at cosine 0.9, through the pivot index."""
    return pivots.embedding_duplicates(spark, table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


# -- op8: quality rules ------------------------------------------------------

_R = quality.QualityRules()
_W = r"[^\x20\x09-\x0D]+"
OP8_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
ws AS (SELECT rid, regexp_extract_all(t, '{_W}') AS w FROM d),
wd AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM ws),
win AS (SELECT rid, i, word || ' ' || lead(word) OVER p || ' ' || lead(word, 2) OVER p AS g
        FROM wd WINDOW p AS (PARTITION BY rid ORDER BY i)),
cnt AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win WHERE g IS NOT NULL),
rep AS (SELECT rid, count(DISTINCT i + k) AS n_repeat
        FROM cnt, (VALUES (0), (1), (2)) s(k) WHERE n > 1 GROUP BY rid),
ln AS (SELECT rid, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d),
lw AS (SELECT rid, i, line, len(regexp_extract_all(line, '{_W}')) AS n FROM ln),
lr AS (SELECT rid, n, row_number() OVER (PARTITION BY rid, line ORDER BY i) > 1 AS again,
         length(line) - length(replace(line, '|', '')) >= {_R.nav_bars}
         OR 100 * len(regexp_extract_all(line, '[#*$%&|<>]')) > {_R.symbol_percent} * n
         OR (len(regexp_extract_all(line, '[A-Za-z]')) >= {_R.shout_letters}
             AND 100 * len(regexp_extract_all(line, '[A-Z]')) > {_R.shout_percent} * len(regexp_extract_all(line, '[A-Za-z]')))
         OR (n >= {_R.bare_words} AND NOT regexp_matches(line, '[.!?…。]'))
         OR regexp_matches(line, '(?i){"|".join(quality.BOILERPLATE)}') AS bad
       FROM lw WHERE n > 0),
lost AS (SELECT rid, sum(CASE WHEN again THEN 1 ELSE 0 END) AS n_dup,
                sum(CASE WHEN again OR bad THEN n ELSE 0 END) AS n_lost FROM lr GROUP BY rid),
f AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words,
             CAST(coalesce(n_lost, 0) AS BIGINT) AS lost_words
      FROM d JOIN ws USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN lost USING (rid)),
g AS (SELECT *, n_words < {_R.min_words} OR 100 * n_repeat_words > {_R.repeat_percent} * n_words AS base_failed FROM f)
SELECT *, NOT base_failed AND 100 * lost_words <= {_R.lost_percent} * n_words AS kept FROM g
"""


@query("op8_quality_rules", OP8_SQL)
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures and verdict of every document, lines judged first."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.with_quality(docs, rules=_R, clean=False).drop("text")


# -- op5: best-fit packing ---------------------------------------------------

def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, tokenised whole and packed into sequences of 4096 tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(spark, packing.token_pieces(docs, tokenizer_path()))


# -- op3: near-duplicates ----------------------------------------------------

@query("op3_near_duplicates")
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share four fifths of their 4-word shingles."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near.near_duplicates(spark, docs, near.NearRules(words=4)).select("doc_id", "n_shingles", "component_id", "kept")


# -- op4: HTML extraction ----------------------------------------------------

@query("op4_html_extract")
def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, by the path its host's pages agree on."""
    return pages.extract_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


# -- op9: toxicity -----------------------------------------------------------

@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score; rows whose crc32(doc_id) mod 5 is 0 are held out of the learning."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    labels = table(spark, sf_dir, "labels").filter(~held)
    model = toxicity.learn(spark, toxicity.labelled_sample(docs, labels, toxicity.ToxicRules()))
    scored = toxicity.score(spark, docs, model)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


# -- op10: license scans -----------------------------------------------------

_L = licences.LicenceRules()


def _op10_sql() -> str:
    """The scan in SQL: every unit against every template, no prefilter."""
    raw = []
    for name, texts in sorted(_L.templates.items()):
        for k, t in enumerate(texts):
            own = licences.words_of(t)
            raw += [f"('{name}#{k}', '{name}', '{w}', {own.count(w)})" for w in sorted(set(own))]
    return rf"""
WITH raw(template, name, word, tf) AS (VALUES {', '.join(raw)}),
d AS (SELECT row_number() OVER () AS rid, doc_id, text,
             concat(source, '/', lang, '/', doc_id // 100, '/', doc_id, '.txt') AS path FROM documents),
tot AS (SELECT count(*) AS n FROM d),
df AS (SELECT word, count(*) AS n FROM (SELECT DISTINCT rid, unnest(string_split_regex(lower(text), '[^a-z0-9]+')) AS word FROM d)
       WHERE word IN (SELECT word FROM raw) GROUP BY word),
idf AS (SELECT DISTINCT raw.word, ln((tot.n + 1) / (coalesce(df.n, 0) + 1)) + 1.0 AS idf FROM raw CROSS JOIN tot LEFT JOIN df USING (word)),
wt AS (SELECT template, name, word, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY template)) AS w FROM raw JOIN idf USING (word)),
u AS (SELECT rid, unnest(string_split(s, chr(10))) AS sentence, generate_subscripts(string_split(s, chr(10)), 1) AS unit
      FROM (SELECT rid, regexp_replace(text, '([.!?])[ 	]+', '' || chr(10), 'g') AS s FROM d)),
uw AS (SELECT rid, unit, regexp_extract_all(lower(sentence), '[a-z0-9]+') AS ws FROM u WHERE regexp_matches(lower(sentence), '[a-z0-9]')),
t AS (SELECT rid, unit, len(ws) AS n_unit, word, count(*) AS tf FROM (SELECT rid, unit, ws, unnest(ws) AS word FROM uw) GROUP BY rid, unit, ws, word),
x AS (SELECT t.*, tf * coalesce(idf, ln(tot.n + 1) + 1.0) AS x FROM t CROSS JOIN tot LEFT JOIN idf USING (word)),
norms AS (SELECT rid, unit, n_unit, sqrt(sum(CAST(x * x AS DECIMAL(30, 12)))::DOUBLE) AS norm FROM x GROUP BY ALL),
dots AS (SELECT rid, unit, template, name, sum(CAST(x * w AS DECIMAL(30, 12)))::DOUBLE AS dot FROM x JOIN wt USING (word) GROUP BY ALL),
sc AS (SELECT rid, unit, n_unit, name, round(dot / norm, 6) AS c FROM norms JOIN dots USING (rid, unit)),
best AS (SELECT rid, unit, n_unit, name, c FROM sc WHERE c >= {_L.cosine}
         QUALIFY row_number() OVER (PARTITION BY rid, unit ORDER BY c DESC, name) = 1),
own AS (SELECT rid, arg_min(name, (-c, name)) AS name, max(c) AS c, sum(n_unit) AS n_match FROM best GROUP BY rid),
nw AS (SELECT rid, len(regexp_extract_all(lower(text), '[a-z0-9]+')) AS n_words FROM d),
f AS (SELECT d.rid, doc_id, path, regexp_replace(path, '/?[^/]*$', '') AS dir, own.name AS own_license, own.c AS own_cosine,
             own.name IS NOT NULL AND 100 * n_match >= {_L.share_percent} * n_words AS is_license_file
      FROM d LEFT JOIN own USING (rid) LEFT JOIN nw USING (rid)),
sp AS (SELECT dir AS ancestor, arg_min(own_license, (-own_cosine, own_license, path)) AS name FROM f WHERE is_license_file AND dir IS NOT NULL GROUP BY dir),
near AS (SELECT f.rid, sp.name, sp.ancestor FROM f JOIN sp ON f.dir = sp.ancestor OR starts_with(f.dir, sp.ancestor || '/') OR sp.ancestor = ''
         QUALIFY row_number() OVER (PARTITION BY f.rid ORDER BY length(sp.ancestor) DESC) = 1)
SELECT doc_id, path, own_license, own_cosine, coalesce(is_license_file, false) AS is_license_file, coalesce(own_license, near.name) AS license,
       CASE WHEN is_license_file THEN 'licence_file' WHEN own_license IS NOT NULL THEN 'header'
            WHEN near.name IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       CASE WHEN own_license IS NULL THEN near.ancestor END AS from_directory
FROM f LEFT JOIN near USING (rid)
"""


@query("op10_license_scan", _op10_sql())
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents, filed as source/language/hundred/document."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat(F.col("source"), F.lit("/"), F.col("lang"), F.lit("/"), F.expr("cast(doc_id div 100 as string)"),
                    F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return licences.license_scan(spark, docs.select("doc_id", path.alias("path"), "text"), _L)


# -- op11: Merkle manifest ---------------------------------------------------

def _crc32_sql(x: str) -> str:
    """Unsigned crc32 of a short ASCII string, bit by bit."""
    bits = "list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda v, _: xor(v >> 1, CASE WHEN v % 2 = 1 THEN 3988292384 ELSE 0 END))"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({x}, ''), lambda c: ascii(c)::BIGINT)), "
            f"lambda crc, b: {bits}))")


def _field_sql(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"


_LEAF_SQL = " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars"))

OP11_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, sha256({_LEAF_SQL} || {_field_sql('text')}) AS leaf,
         CASE WHEN {_crc32_sql('doc_id::VARCHAR')} % 2 = 0 THEN sha256({_LEAF_SQL} || {_field_sql("replace(text, chr(10), '')")}) END AS altered
  FROM documents),
l AS (SELECT row_number() OVER () AS rid, *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
             dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree, count(*) OVER (PARTITION BY source) AS n FROM d),
nodes AS (
  SELECT tree, 0 AS lv, idx, leaf AS digest, n FROM l
  UNION ALL
  SELECT tree, lv + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3 FROM nodes WHERE n > 1 GROUP BY tree, lv, idx // 3, n),
sub AS (SELECT tree, lv AS height, digest AS subroot, tree - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lv, idx, subroot AS digest, n FROM sub
  UNION ALL
  SELECT lv + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3 FROM tops WHERE n > 1 GROUP BY lv, idx // 3, n),
root AS (SELECT digest AS root, lv AS height FROM tops WHERE n = 1),
steps AS (
  SELECT l.rid, a.lv, string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx) AS lhs, string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx) AS rhs
  FROM l JOIN sub USING (tree) JOIN nodes a ON a.tree = l.tree AND a.lv < sub.height AND a.idx = l.idx // (3 ** a.lv)::BIGINT
         JOIN nodes b ON b.tree = a.tree AND b.lv = a.lv AND b.idx // 3 = a.idx // 3 GROUP BY l.rid, a.lv
  UNION ALL
  SELECT l.rid, sub.height + a.lv, string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx)
  FROM l JOIN sub USING (tree), root JOIN tops a ON a.lv < root.height AND a.idx = sub.idx // (3 ** a.lv)::BIGINT
         JOIN tops b ON b.lv = a.lv AND b.idx // 3 = a.idx // 3 GROUP BY l.rid, sub.height, a.lv),
proof AS (SELECT rid, string_agg(coalesce(lhs, '') || coalesce(rhs, ''), '' ORDER BY lv) AS siblings, count(*) AS n_steps FROM steps GROUP BY rid),
folds AS (
  SELECT rid, 0 AS lv, coalesce(altered, leaf) AS digest FROM l
  UNION ALL
  SELECT rid, lv + 1, sha256(coalesce(lhs, '') || digest || coalesce(rhs, '')) FROM folds JOIN steps USING (rid, lv)),
last AS (SELECT rid, arg_max(digest, lv) AS folded_root FROM folds GROUP BY rid)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM l JOIN sub USING (tree) CROSS JOIN root LEFT JOIN proof USING (rid) JOIN last USING (rid)
"""


@query("op11_merkle_manifest", OP11_SQL)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof up to the root of the dataset, and whether the (partly altered) document folds to it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    shortened = merkle.leaf_digest(*[F.col(c) for c in fields[:4]], F.translate("text", "\n", ""))
    altered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, shortened).alias("altered")
    made = merkle.build(spark, docs, fields, keep=[F.col("doc_id"), altered])
    return merkle.proofs(made.leaves(), made.root, F.coalesce("altered", "digest"), ["doc_id"])


# -- op12: conversation prefix trie ------------------------------------------

_TURN_SQL = "substr(sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32)"
OP12_SQL = rf"""
WITH t AS (SELECT conv_id, list({{'d': {_TURN_SQL}, 'w': len(regexp_extract_all(coalesce(text, ''), '{_W}'))}} ORDER BY turn NULLS FIRST, {_TURN_SQL}) AS turns
           FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, turns, ({_crc32_sql('conv_id::VARCHAR')} % 4)::INTEGER AS h FROM t),
s AS (SELECT a.conv_id, CASE WHEN b.turns IS NULL THEN a.turns[a.h + 1:] ELSE list_concat(b.turns[1:a.h], a.turns[a.h + 1:]) END AS seq
      FROM h a LEFT JOIN t b ON b.conv_id = a.conv_id - a.conv_id % 20),
p AS (SELECT conv_id, d, len(seq) = d AS is_end, sha256(array_to_string(list_transform(seq[1:d], lambda x: x.d), ',')) AS k,
             CASE WHEN d > 0 THEN sha256(array_to_string(list_transform(seq[1:d - 1], lambda x: x.d), ',')) END AS up,
             CASE WHEN d > 0 THEN seq[d].w ELSE 0 END AS w
      FROM (SELECT conv_id, seq, unnest(range(len(seq) + 1)) AS d FROM s)),
nodes AS (SELECT k, any_value(up) AS up, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w,
                 sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256 FROM p GROUP BY k),
kids AS (SELECT up AS k, count(*) AS n_children FROM nodes WHERE up IS NOT NULL GROUP BY up),
below AS (SELECT DISTINCT a.k, b.k AS other FROM p a JOIN p b ON a.conv_id = b.conv_id AND b.d >= a.d),
sums AS (SELECT below.k, sum(CASE WHEN n_children IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum((n_convs - 1) * w)::BIGINT AS saved_tokens
         FROM below JOIN nodes ON nodes.k = other LEFT JOIN kids ON kids.k = other GROUP BY below.k)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0)::BIGINT AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN sums ON sums.k = n.k LEFT JOIN kids ON kids.k = n.k LEFT JOIN nodes u ON u.k = n.up
"""


@query("op12_conversation_trie", OP12_SQL)
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every prefix that conversations share once their first turns come from the first of each twenty."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return trie.prefix_trie(spark, trie.rebuilt(trie.sequences(rows)))


# -- op13: personal data -----------------------------------------------------

@query("op13_personal_data")
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text: base spans as they are, further ones by score."""
    return personal.span_digest(personal.personal_data(table(spark, sf_dir, "documents").select("doc_id", "text")))
