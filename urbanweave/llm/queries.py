"""Registered queries of the text operators over whole tables, and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanweave.llm import (
    byte_bpe, chat_format, embedding_dedup, hard_negatives, html_text, line_dedup, lm_score, minhash_dedup, packing, phrases, quality_model, quality_rules,
    token_counts,
)
from urbanweave.llm.common import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without the lines that ten or more documents share."""
    out = line_dedup.dedup_lines(table(spark, sf, "documents"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op2_line_dedup"] = """
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rid) >= 10),
m AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid
"""


@query
def op4_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations in the marked template, read back from it and through its loss mask."""
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    out = chat_format.format_chat(turns)
    out = out.withColumn("turns", chat_format.read_back(F.col("formatted")))
    out = out.withColumn("learned", chat_format.loss_text(F.col("formatted"), F.col("loss_spans")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        F.col("id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLES["op4_chat_format"] = """
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
s AS (SELECT *, length(text) + length(text) - length(translate(text, '<[|' || chr(92), '')) AS body,
      length(role) + length(role) - length(translate(role, '<[|' || chr(92), '')) AS head FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(2 + head + 3 + body + 8) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
"""


@query
def op9_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics, base rules and the verdict of the robust outlier test for each document."""
    return quality_rules.quality_verdicts(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


@query
def op5_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of each document under the pieces of the public vocabulary, taken as a unigram model."""
    return token_counts.count_tokens(table(spark, sf, "documents"), spark, public_tokenizers.path("piece_bpe_32k.model"))


@query
def op8_packing(spark: SparkSession, sf: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack(table(spark, sf, "documents"), spark, public_tokenizers.path("word_bpe_49k.json"))


@query
def op1_quality_model(spark: SparkSession, sf: str) -> DataFrame:
    """Quality score of each document; the model learns outside the test fold."""
    docs = table(spark, sf, "documents")
    model = quality_model.train(docs, table(spark, sf, "labels"))
    thin = docs.select("doc_id", "text")
    return quality_model.score_quality(thin, model).select(F.col("row.doc_id").alias("doc_id"), "held_out", "score", "predicted")


@query
def op10_html_text(spark: SparkSession, sf: str) -> DataFrame:
    """Main text of each page."""
    return html_text.extract(table(spark, sf, "pages"))


@query
def op7_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Links and groups of near-equal vectors within a label."""
    return embedding_dedup.near_vectors(table(spark, sf, "embeddings"))


@query
def op6_minhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of near-equal documents on three-word shingles at 0.85."""
    rule = minhash_dedup.Rule(width=3, percent=85)
    return minhash_dedup.near_documents(table(spark, sf, "documents"), rule=rule).drop("t")


@query
def op3_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Byte-level BPE ids of each document, and the bytes that they decode to."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    out = byte_bpe.decode(byte_bpe.encode(table(spark, sf, "documents"), ranks, public_tokenizers.PATTERN), ranks)
    return out.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op11_lm_score(spark: SparkSession, sf: str) -> DataFrame:
    """Each document under the n-gram model of those outside the held-out fold."""
    return lm_score.score_corpus(table(spark, sf, "documents"))


@query
def op12_phrases(spark: SparkSession, sf: str) -> DataFrame:
    """Fixed phrases of each language."""
    return phrases.collocations(table(spark, sf, "documents"))


ORACLES["op12_phrases"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang, string_split(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ.,:;!?' || chr(10) || chr(11) || chr(12) || chr(13) || chr(9),
             'abcdefghijklmnopqrstuvwxyz' || repeat(chr(10), 10) || ' '), chr(10)) AS ps FROM documents),
p AS (SELECT rid, lang, unnest(ps) AS piece, generate_subscripts(ps, 1) AS pno FROM d),
s AS (SELECT rid, lang, pno, string_split(piece, ' ') AS ws FROM p),
t AS (SELECT rid, lang, pno, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM s),
u AS (SELECT lang, w AS w1, lead(w, 1) OVER x AS w2, lead(w, 2) OVER x AS w3, lead(w, 3) OVER x AS w4
      FROM t WHERE w <> '' WINDOW x AS (PARTITION BY rid, pno ORDER BY pos)),
tot AS (SELECT lang, count(*) AS n FROM u GROUP BY lang),
g AS (SELECT lang, 1 AS k, w1, NULL AS w2, NULL AS w3, NULL AS w4, count(*) AS a FROM u GROUP BY lang, w1 HAVING count(*) >= 30
      UNION ALL SELECT lang, 2, w1, w2, NULL, NULL, count(*) FROM u WHERE w2 IS NOT NULL GROUP BY lang, w1, w2 HAVING count(*) >= 30
      UNION ALL SELECT lang, 3, w1, w2, w3, NULL, count(*) FROM u WHERE w3 IS NOT NULL GROUP BY lang, w1, w2, w3 HAVING count(*) >= 30
      UNION ALL SELECT lang, 4, w1, w2, w3, w4, count(*) FROM u WHERE w4 IS NOT NULL GROUP BY lang, w1, w2, w3, w4 HAVING count(*) >= 30),
f AS (SELECT lang, k, w1, w2, w3, w4, a, concat_ws(' ', w1, w2, w3, w4) AS phrase FROM g),
inner_ AS (SELECT lang, a, w1 || ' ' || w2 AS phrase FROM f WHERE k >= 3 UNION ALL SELECT lang, a, w2 || ' ' || w3 FROM f WHERE k >= 3
           UNION ALL SELECT lang, a, w3 || ' ' || w4 FROM f WHERE k = 4
           UNION ALL SELECT lang, a, w1 || ' ' || w2 || ' ' || w3 FROM f WHERE k = 4 UNION ALL SELECT lang, a, w2 || ' ' || w3 || ' ' || w4 FROM f WHERE k = 4),
m AS (SELECT lang, phrase, max(a) AS longer FROM inner_ GROUP BY lang, phrase),
c AS (SELECT f.lang, f.phrase, f.a, f.k, f.w1, f.w2, f.w3, f.w4 FROM f LEFT JOIN m ON f.lang = m.lang AND f.phrase = m.phrase
      WHERE f.k > 1 AND (m.longer IS NULL OR 100 * m.longer < 80 * f.a)),
cut AS (SELECT lang, phrase, a, 1 AS j, w1 AS head, concat_ws(' ', w2, w3, w4) AS tail FROM c
        UNION ALL SELECT lang, phrase, a, 2, w1 || ' ' || w2, concat_ws(' ', w3, w4) FROM c WHERE k >= 3
        UNION ALL SELECT lang, phrase, a, 3, w1 || ' ' || w2 || ' ' || w3, w4 FROM c WHERE k = 4),
sc AS (SELECT cut.lang, cut.phrase, cut.a, cut.j, h.a AS l, t.a AS r, CAST(2000000 * CAST(cut.a AS HUGEINT) // (CAST(h.a AS HUGEINT) + t.a) AS BIGINT) AS score
       FROM cut JOIN f h ON h.lang = cut.lang AND h.phrase = cut.head JOIN f t ON t.lang = cut.lang AND t.phrase = cut.tail),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS rn FROM sc),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM best WHERE rn = 1)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN tot ON tot.lang = ranked.lang WHERE rank <= 2000
"""


@query
def op13_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    """Hard negatives of each anchor and positive."""
    return hard_negatives.hard_negatives(table(spark, sf, "embeddings"))


ORACLES["op13_hard_negatives"] = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL),
x AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS d, CAST(floor(256 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS q FROM e),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(sum(a.q * b.q) AS BIGINT) AS score
      FROM x a JOIN x b ON a.d = b.d WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id GROUP BY a.vec_id, b.vec_id, a.label = b.label),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place FROM s WHERE same),
n AS (SELECT p.anchor_id, p.positive_id, p.positive_score, s.id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
      WHERE p.place <= 5 AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
