"""The operators' queries over their whole tables, with production parameters.

``ORACLE`` holds the SQL of those that it can express: op5, op6 and op9, by
plain joins of all pairs, op11 by recursion over levels, op12 by one query a
round.  The others rest on a tokenizer, a trained model or
an approximate index; ``tests/llm`` holds them against brute force, round
trips and held-out labels.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (ann, chat, embdedup, html, langid, lm, merkle, minhash, packing, pqcode, quality, sentencepiece,
                          tokencount)
from tidemark.llm.common import table

QUALITY_THRESHOLD = 0.3
#: A conversation that spells control strings, beside those of the table.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack(table(spark, sf_dir, "documents")))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.digests(sentencepiece.encode_documents(table(spark, sf_dir, "documents")))


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(CONTROL_TEXT).alias("text"))
    return chat.read_back(chat.format_turns(turns.unionByName(extra)))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).withColumn("predicted", (F.col("score") >= QUALITY_THRESHOLD).cast("int"))


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embdedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.build(docs, claimed=merkle.tampered_chars()).proofs().drop("proof")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pqcode.encode(table(spark, sf_dir, "embeddings")).drop("label")


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_packing, op2_lm_scoring, op3_language_id, op4_sentencepiece, op5_minhash_dedup,
                            op6_chat_format, op7_quality, op8_ann, op9_embedding_dedup, op10_html,
                            op11_merkle_manifest, op12_vector_codes, op13_token_counts)}

# The growing tables that a query reads: documents, if not named here.
DOCUMENTS = ("documents",)
READS = {"op6_chat_format": ("conversations",), "op7_quality": ("documents", "labels"), "op8_ann": ("embeddings",),
         "op9_embedding_dedup": ("embeddings",), "op10_html": ("pages",), "op12_vector_codes": ("embeddings",)}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Names (v, c) of all that is reached from each of ``nodes`` over ``pairs`` (a, b), both ways.
_REACHED = """
reached AS (
  SELECT id AS v, id AS c FROM nodes
  UNION
  SELECT r.v, p.b AS c FROM reached r JOIN pairs p ON r.c = p.a),
named AS (SELECT v, min(c) AS component_id FROM reached GROUP BY v)"""


def _merkle_sql() -> str:
    """Trees by recursion over levels: all nodes first, then each leaf's fold towards its root."""
    def leaf(chars: str) -> str:
        return "sha256(" + " || ".join(
            f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"
            for c in ("doc_id", "source", "lang", chars, "text")) + ")"
    # CRC-32 of the id's decimal text, by its bits
    crc = """xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
      lambda acc, b: list_reduce([xor(acc, b)] || [0, 0, 0, 0, 0, 0, 0, 0],
        lambda r, _: xor(r >> 1, CASE WHEN r & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295), 4294967295)"""

    def grown(name: str, nodes: str) -> str:
        return f"""
{name} AS (
  SELECT k, 0 AS lvl, pos, digest, n FROM {nodes}
  UNION ALL
  SELECT k, lvl + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2
  FROM {name} WHERE n > 1 GROUP BY k, lvl, pos // 2, n)"""

    def folded(name: str, starts: str, tree: str) -> str:
        return f"""
{name} AS (
  SELECT id, k, 0 AS lvl, pos, digest, proof, n FROM {starts}
  UNION ALL
  SELECT f.id, f.k, f.lvl + 1, f.pos // 2,
         sha256(CASE WHEN s.digest IS NULL THEN f.digest WHEN f.pos % 2 = 1 THEN s.digest || f.digest
                     ELSE f.digest || s.digest END), f.proof || coalesce(s.digest, ''), (f.n + 1) // 2
  FROM {name} f LEFT JOIN {tree} s ON s.k = f.k AND s.lvl = f.lvl AND s.pos = xor(f.pos, 1)
  WHERE f.n > 1)"""
    return f"""
WITH RECURSIVE hashed AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || lang, '') AS k, {leaf('n_chars')} AS digest,
         CASE WHEN {crc} % 7 = 0 THEN {leaf('(n_chars + CAST(1 AS HUGEINT))')} ELSE {leaf('n_chars')} END AS claimed
  FROM documents),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos,
         count(*) OVER (PARTITION BY k) AS n FROM hashed),{grown('trees', 'leaves')},
subroots AS MATERIALIZED (
  SELECT k AS lang_key, '' AS k, digest, row_number() OVER (ORDER BY k) - 1 AS pos, count(*) OVER () AS n
  FROM trees WHERE n = 1),{grown('tops', 'subroots')},
starts AS (SELECT id, k, pos, claimed AS digest, '' AS proof, n FROM leaves),{folded('low', 'starts', 'trees')},
ends AS (SELECT low.id, '' AS k, s.pos, low.digest, low.proof, s.n FROM low JOIN subroots s ON s.lang_key = low.k WHERE low.n = 1),
{folded('high', 'ends', 'tops')}
SELECT l.doc_id, l.digest AS leaf, s.digest AS subroot, t.digest AS root, sha256(h.proof) AS proof_sha256,
       h.digest AS folded_root, h.digest = t.digest AS verified
FROM leaves l JOIN high h ON h.id = l.id AND h.n = 1 JOIN subroots s ON s.lang_key = l.k JOIN tops t ON t.n = 1"""


def _vector_codes_sql(rounds: int = pqcode.ROUNDS) -> str:
    """Each round a query over all distances; nearest by (distance, index) as one number."""
    parts = """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS i, vec_id, label,
         list_transform(embedding, lambda c: CAST(floor(4096 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
parts AS MATERIALIZED (SELECT i, p, x[p * (len(x) // 8) + 1:(p + 1) * (len(x) // 8)] AS y FROM kept, range(8) t(p)),
book0 AS MATERIALIZED (SELECT p, i AS e, y AS c FROM parts WHERE i < 16),"""

    def nearest(k: int) -> str:
        return f"""
near{k} AS MATERIALIZED (
  SELECT i, p, min(d * 16 + e) % 16 AS e, min(d * 16 + e) // 16 AS d FROM (
    SELECT i, p, e, CAST(list_sum(list_transform(list_zip(y, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS HUGEINT) AS d
    FROM parts JOIN book{k} USING (p)) GROUP BY i, p),"""
    steps = "".join(f"""{nearest(k)}
sums{k} AS (SELECT p, e, j, sum(y[j]) AS s, count(*) AS n FROM near{k} JOIN parts USING (i, p), range(1, len(y) + 1) t(j) GROUP BY p, e, j),
means{k} AS (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS m FROM sums{k} GROUP BY p, e),
book{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m, c) AS c FROM book{k} LEFT JOIN means{k} USING (p, e)),"""
                    for k in range(rounds))
    return f"""{parts}{steps}{nearest(rounds)}
coded AS (SELECT i, string_agg(printf('%02x', CAST(e AS INT)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
          FROM near{rounds} GROUP BY i)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (i)"""


ORACLE: dict[str, str] = {
    "op5_minhash_dedup": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words),
nodes AS (SELECT doc_id AS id, CAST(count(s) AS BIGINT) AS n FROM words LEFT JOIN shingles USING (doc_id) GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_common
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
pairs AS (
  SELECT a, b FROM shared JOIN nodes na ON na.id = a JOIN nodes nb ON nb.id = b
  WHERE 100 * n_common >= 85 * (na.n + nb.n - n_common)),
{_REACHED}
SELECT id AS doc_id, n AS n_shingles, component_id, id = component_id AS kept FROM nodes JOIN named ON v = id""",
    "op6_chat_format": rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -7, 1, 'assistant', '{CONTROL_TEXT}'),
sized AS (
  SELECT *, length(x) + len(regexp_extract_all(x, '<\\*(\|\w+\|>|/?s>)|\[\\*(/?INST\])')) AS escaped
  FROM (SELECT *, role || text AS x FROM turns) t)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(escaped + length('<|turn|><|body|><|end|>')) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id""",
    "op9_embedding_dedup": rf"""
WITH RECURSIVE nodes AS (
  SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x,
         coalesce(len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
                  AND len(list_filter(embedding, lambda c: c <> 0)) > 0, false) AS ok
  FROM embeddings),
good AS MATERIALIZED (SELECT id, x FROM nodes WHERE ok),
pairs AS MATERIALIZED (
  SELECT p.id AS a, q.id AS b FROM good p JOIN good q ON p.id <> q.id WHERE list_cosine_similarity(p.x, q.x) >= 0.9),
{_REACHED}
SELECT id AS vec_id, (SELECT CAST(count(*) AS BIGINT) FROM pairs WHERE a = id) AS n_links, component_id,
       id = component_id AS kept
FROM nodes JOIN named ON v = id""",
    "op11_merkle_manifest": _merkle_sql(),
    "op12_vector_codes": _vector_codes_sql(),
}
