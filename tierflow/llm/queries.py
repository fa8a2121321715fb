"""The operators over the driver's tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.align import align_tokens
from tierflow.llm.bpe import build_lexicon, decode_ids, encode_texts
from tierflow.llm.decontam import contaminated
from tierflow.llm.hard_negatives import hard_negatives
from tierflow.llm.langid import fit_languages, identify
from tierflow.llm.lm_score import score_against
from tierflow.llm.mixing import NONE, mix_sources
from tierflow.llm.multi_index import near_vectors
from tierflow.llm.pii import BASE_KINDS, pii_spans, span_digest, spans_of
from tierflow.llm.quality import fit_quality, score_quality
from tierflow.llm.runtime import held_out, learnable, prepare
from tierflow.llm.simhash import simhash_dedup
from tierflow.llm.tokens import write_tokens
from tierflow.llm.toxicity import fit_chain, score_toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    target = _table(spark, sf_dir, "labels").filter("quality = 1 and toxic = 0")
    return score_against(docs, target).withColumnRenamed("id", "doc_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").filter(learnable(F.col("doc_id")))
    return score_toxicity(docs, fit_chain(docs, labels)).select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score", "toxic", "categories")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").filter(learnable(F.col("doc_id")))
    return score_quality(docs, fit_quality(docs, labels)).select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_passages", "top_weight")


#: Four fifths of the tokens there are; without target weights small branches
#: count more than in proportion; a document is read four times at most.
MIX_FRACTION, MIX_ALPHA, MIX_EPOCHS = 0.8, 0.7, 4


def mix_levels() -> dict[str, Column]:
    """The tree over ``documents``: families of five sources, language, source."""
    number = F.regexp_extract("source", "([0-9]+)$", 1).try_cast("int")
    return {"domain": F.concat(F.lit("family"), F.floor(number / 5).cast("string")), "lang": F.col("lang"),
            "source": F.col("source")}


def target_weights(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(domain, lang, source, weight)`` for every node (lower levels null): its
    documents that are labelled good, and one."""
    good = labels.filter("quality = 1 and toxic = 0").select(F.col("doc_id").alias("good")).distinct()
    nodes = docs.select("doc_id", *[F.coalesce(c.cast("string"), F.lit(NONE)).alias(k) for k, c in mix_levels().items()])
    nodes = nodes.join(good, nodes["doc_id"] == good["good"], "left").rollup(*mix_levels()).agg(
        (F.count("good") + 1).cast("double").alias("weight"))
    return nodes.filter("domain is not null")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    weights = target_weights(docs, _table(spark, sf_dir, "labels"))
    return mix_sources(docs, mix_levels(), fraction=MIX_FRACTION, weights=weights, max_epochs=MIX_EPOCHS).withColumnRenamed("id", "doc_id")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_dedup(_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      "component_id")


def op6_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.explode("matches").alias("m")).select("doc_id", "m.*")


def op7_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = fit_languages(docs.filter(learnable(F.col("doc_id"))))
    return identify(docs, model).select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), F.col("lang").alias("lang_pred"),
        "score", "rejected")


def token_rows(docs: DataFrame) -> DataFrame:
    """Write the tokens of ``docs``, find every document through the index and
    read it back."""
    import public_tokenizers
    made = write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return made.read(made.locate(made.keys()), digest=True).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rows(_table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_spans(_table(spark, sf_dir, "documents"))
    counts = [F.size(spans_of(F.col("spans"), k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select(F.col("id").alias("doc_id"), *counts,
                        F.sha2(span_digest(spans_of(F.col("spans"), *BASE_KINDS)), 256).alias("base_sha256"),
                        span_digest(F.col("spans")).alias("spans"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs, path = _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    decoded = decode_ids(encode_texts(docs, path, build_lexicon(docs, path)), path)
    return decoded.select(F.col("id").alias("doc_id"), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, label = F.col("vec_id"), F.col("label").cast("bigint")
    moved = F.when(key % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(_table(spark, sf_dir, "embeddings"), anchor=key % 100 == 0, label=moved)


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    _, documents = align_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                public_tokenizers.path("piece_bpe_32k.model"))
    return documents.withColumnRenamed("id", "doc_id")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_score": op1_lm_score,
    "op2_toxicity": op2_toxicity,
    "op3_quality": op3_quality,
    "op4_mixing": op4_mixing,
    "op5_simhash": op5_simhash,
    "op6_decontam": op6_decontam,
    "op7_multi_index": op7_multi_index,
    "op8_langid": op8_langid,
    "op9_tokens": op9_tokens,
    "op10_pii": op10_pii,
    "op11_bpe": op11_bpe,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_align": op13_align,
}


def _prepared(fn: Callable) -> Callable:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    return run


LLM_QUERIES = {k: _prepared(v) for k, v in _QUERIES.items()}

_OP12_SQL = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, o.vec_id, a.label = o.label AS same, CAST(list_inner_product(a.v, o.v) AS BIGINT) AS score
  FROM vectors a JOIN vectors o ON o.vec_id <> a.vec_id
  WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
  AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
"""
_OP7_SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0),
units AS (
  SELECT vec_id, label, [x / sqrt(list_inner_product(v, v)) FOR x IN v] AS u FROM vectors),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM units a JOIN units b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.u, b.u) >= 0.93),
reach(vec_id, root) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT b, root FROM reach JOIN links ON vec_id = a AND root < b)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN (SELECT vec_id, min(root) AS component_id FROM reach GROUP BY vec_id) c USING (vec_id)
"""
LLM_ORACLES: dict[str, str] = {"op7_multi_index": _OP7_SQL, "op12_hard_negatives": _OP12_SQL}
