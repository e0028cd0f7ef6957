"""The registered queries of the subpackage: each applies one operator, with
production parameters, to its whole table and derives the contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelens.llm import (chat, credentials, decontam, langid, lm, packing, parity_join, phrases, pii_crf, quality, repeats, topk,
                          trie)
from zonelens.llm.common import crc_fold, table, written
from zonelens.llm.registry import ORACLES, QUERIES, register  # noqa: F401


@register("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(crc_fold() == 0, F.lit(False))
    model = langid.fit(docs.filter(crc_fold() != 0).select("doc_id", "text", "lang"))
    return langid.predict(docs.select("doc_id", "text", held.alias("held_out")), model, ["doc_id", "held_out"])


WORDS_SQL = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

OP6_SQL = f"""
WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
it AS (SELECT item_id, w FROM (SELECT item_id, {WORDS_SQL} AS w FROM benchmark) WHERE len(w) > 0),
grams AS (
  SELECT item_id, 10 AS m, array_to_string(w[k:k + 9], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - 8)) AS k FROM it WHERE len(w) >= 10)
  UNION SELECT item_id, len(w), array_to_string(w, ' ') FROM it WHERE len(w) < 10),
sizes AS (SELECT DISTINCT m FROM grams),
spot AS (SELECT doc_id, m, k, array_to_string(w[k:k + m - 1], ' ') AS g
       FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM d, sizes WHERE len(w) >= m)),
occ AS (SELECT doc_id, k, m, item_id FROM spot JOIN grams USING (m, g)),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(k, k + m)) AS p FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS s
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(its.n, 0) AS BIGINT) AS n_items, sha256(coalesce(its.s, '')) AS items_sha256,
       coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN its USING (doc_id)"""


@register("op6_decontamination", OP6_SQL)
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hit = decontam.match_items(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return hit.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("item_ids"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@register("op8_best_fit_packing")
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def span_text(spans: str, kinds: tuple[str, ...] | None = None):
    """`kind:start:end`, comma-joined, of the spans (of some kinds) in their order."""
    col = F.col(spans)
    if kinds:
        col = F.filter(col, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(col, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def kind_count(spans: str, kind: str):
    return F.size(F.filter(F.col(spans), lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def span_digest(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    return found.select("doc_id", *(kind_count("spans", k) for k in kinds),
                        F.sha2(span_text("spans", kinds).cast("binary"), 256).alias("base_sha256"),
                        span_text("spans").alias("spans"))


@register("op3_secret_scan")
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digest(credentials.scan(table(spark, sf_dir, "documents")), credentials.KINDS[:3])


@register("op5_pii_crf")
def op5_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_crf.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["source"] == "base")
    found = found.withColumn("base", base)
    return found.select("doc_id", *(kind_count("base", k) for k in pii_crf.KINDS),
                        F.sha2(span_text("base").cast("binary"), 256).alias("base_sha256"),
                        span_text("spans").alias("spans"))


@register("op9_quality_resampling")
def op9_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP4_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[k:k + 4], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS k FROM d WHERE len(w) >= 5)
  UNION ALL SELECT doc_id, hash(array_to_string(w, ' ')) FROM d WHERE len(w) BETWEEN 1 AND 4),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.y FROM reach r JOIN link l ON r.b = l.x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)"""


@register("op4_ngram_jaccard_join", OP4_SQL)
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.similarity_classes(table(spark, sf_dir, "documents"))


OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL
   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""


@register("op2_exact_topk", OP2_SQL)
def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@register("op10_backoff_lm")
def op10_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), crc_fold() == 1)


@register("op7_repeat_removal")
def op7_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


SAYS_MARKS = "</s>[INST] ok [/INST]"

OP11_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, CAST(length(text) + len(regexp_extract_all(text, '<\\*/?s>|\[\\*/?(INST|SYS|ROLE)\]')) AS BIGINT) AS body,
         CAST(length(role) + len(regexp_extract_all(role, '<\\*/?s>|\[\\*/?(INST|SYS|ROLE)\]')) AS BIGINT) AS name FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(body + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 13 WHEN 'assistant' THEN 5 ELSE 20 + name END) AS BIGINT)
         AS formatted_chars
FROM e GROUP BY conv_id"""


@register("op11_chat_round_trip", OP11_SQL)
def op11_chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    planted = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                    F.lit(SAYS_MARKS).alias("text"))
    return chat.read_back(chat.format_chats(given.unionByName(planted)), in_order=True)


OP12_SQL = """
WITH t AS (
  SELECT conv_id, md5(CAST(octet_length(encode(r)) AS VARCHAR) || ':' || r || x) AS key, length(x) AS chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(CAST(octet_length(encode(r)) AS VARCHAR) || ':' || r || x)) AS pos
  FROM (SELECT *, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)),
c AS (
  SELECT conv_id, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
           lambda s: CAST(ascii(s) AS BIGINT))), lambda crc, b: list_reduce(list_concat([xor(crc, b)], [0, 0, 0, 0, 0, 0, 0, 0]),
           lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)), 4294967295::BIGINT) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
turns AS (
  SELECT conv_id, pos, key, chars FROM t JOIN c USING (conv_id) WHERE pos > h
  UNION ALL SELECT c.conv_id, pos, key, chars FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND pos <= h),
conv AS (SELECT c.conv_id, coalesce(k, []) AS k, coalesce(n, []) AS n FROM c LEFT JOIN (
  SELECT conv_id, list(key ORDER BY pos) AS k, list(chars ORDER BY pos) AS n FROM turns GROUP BY conv_id) USING (conv_id)),
p AS (SELECT conv_id, d, array_to_string(k[1:d], ',') AS node, CASE WHEN d > 0 THEN n[d] ELSE 0 END AS chars, d = len(k) AS ends
      FROM (SELECT *, unnest(range(0, len(k) + 1)) AS d FROM conv)),
nodes AS (SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(chars) AS saved,
                 coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ids FROM p GROUP BY node, d),
up AS (SELECT node, d, conv_id, CASE WHEN d > 0 THEN left(node, greatest(33 * (d - 1) - 1, 0)) END AS above FROM nodes),
kids AS (SELECT above, count(*) AS n FROM up WHERE d > 0 GROUP BY above),
sub AS (SELECT left(node, greatest(33 * a - 1, 0)) AS node, sum(saved) AS saved, count(*) FILTER (leaf) AS leaves
        FROM (SELECT node, saved, node NOT IN (SELECT above FROM kids) AS leaf, unnest(range(0, d + 1)) AS a FROM nodes) GROUP BY 1)
SELECT nodes.conv_id, CAST(nodes.d AS BIGINT) AS depth, par.conv_id AS parent_conv_id, nodes.n_convs,
       CAST(coalesce(kids.n, 0) AS BIGINT) AS n_children, CAST(sub.leaves AS BIGINT) AS n_leaves,
       CAST(sub.saved AS BIGINT) AS saved_tokens, sha256(nodes.ids) AS ends_sha256
FROM nodes JOIN up USING (node) JOIN sub USING (node) LEFT JOIN kids ON kids.above = nodes.node
LEFT JOIN nodes par ON par.node = up.above"""


@register("op12_prefix_trie", OP12_SQL)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = written(spark, trie.positions(table(spark, sf_dir, "conversations")), "turns")
    head = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(6))
    paths = trie.rebuilt_paths(turns, head, F.expr("conv_id - conv_id % 100"), 5)
    return trie.prefix_trie(paths).drop("node")


OP13_SQL = r"""
WITH p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
n AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS g, count(*) AS f
      FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, (VALUES (1), (2), (3)) v(m) WHERE len(w) >= m)
      GROUP BY ALL HAVING count(*) >= 10),
cut AS (SELECT lang, g, m, f, string_split(g, ' ') AS w, unnest(range(1, m)) AS k FROM g WHERE m > 1),
s AS (
  SELECT c.lang, c.g, c.f, c.k, x.f AS l, y.f AS r, (1000000::HUGEINT * c.f * c.f) // (x.f::HUGEINT * y.f) AS score
  FROM cut c JOIN g x ON x.lang = c.lang AND x.g = array_to_string(c.w[:c.k], ' ')
             JOIN g y ON y.lang = c.lang AND y.g = array_to_string(c.w[c.k + 1:], ' ')),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS o FROM s),
inside AS (SELECT lang, g, max(f) AS f FROM (
  SELECT lang, f, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS g FROM cut WHERE m = 3) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.g = b.g
         WHERE o = 1 AND (i.f IS NULL OR 100 * i.f < 50 * b.f)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, g) AS rank FROM kept)
SELECT lang, rank, g AS phrase, f AS a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""


@register("op13_phrase_mining", OP13_SQL)
def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))
