"""The corpus operators as registered queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from serpscope.llm.bpe import coded_digests, round_trip
from serpscope.llm.decontaminate import benchmark_matches
from serpscope.llm.merkle import manifest, proofs, tampered_text
from serpscope.llm.minmax import near_duplicates
from serpscope.llm.packing import pack
from serpscope.llm.pii import personal_data
from serpscope.llm.quality import score_quality
from serpscope.llm.repair import repair_damaged
from serpscope.llm.sharding import hilbert_shards
from serpscope.llm.substring import substring_dedup
from serpscope.llm.tokenfiles import through_files
from serpscope.llm.toxicity import score_toxicity
from serpscope.llm.vectors import near_vectors

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, data: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data}/{name}.parquet")


def substring(spark: SparkSession, data: str) -> DataFrame:
    """Windows of 13 words that also start in an earlier document are removed."""
    docs = table(spark, data, "documents")
    return substring_dedup(docs, width=13, keep_text=False).drop("kept_text", "factors")


def sharding(spark: SparkSession, data: str) -> DataFrame:
    """16 shards along a Hilbert curve over language, source and length."""
    return hilbert_shards(table(spark, data, "documents"), ["lang", "source", "n_chars"], 16)


def pii(spark: SparkSession, data: str) -> DataFrame:
    """Personal data in all documents."""
    return personal_data(table(spark, data, "documents"))


def quality(spark: SparkSession, data: str) -> DataFrame:
    """Quality of all documents."""
    return score_quality(table(spark, data, "documents"), table(spark, data, "labels"))


def toxicity(spark: SparkSession, data: str) -> DataFrame:
    """Toxicity categories of all documents."""
    return score_toxicity(table(spark, data, "documents"), table(spark, data, "labels"))


def packing(spark: SparkSession, data: str) -> DataFrame:
    """All documents in sequences of 4096 tokens."""
    return pack(table(spark, data, "documents"))


def tokenfiles(spark: SparkSession, data: str) -> DataFrame:
    """All documents' ids written to coded files and read back."""
    return through_files(table(spark, data, "documents"))


def decontaminate(spark: SparkSession, data: str) -> DataFrame:
    """Documents that hold benchmark items, with the items."""
    return benchmark_matches(table(spark, data, "documents"), table(spark, data, "benchmark"))


def minmax(spark: SparkSession, data: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(table(spark, data, "documents"), percent=85)


def vectors(spark: SparkSession, data: str) -> DataFrame:
    """Near-duplicate components of all vectors with equal labels."""
    return near_vectors(table(spark, data, "embeddings"), threshold=0.93)


def repaired(spark: SparkSession, data: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    return repair_damaged(table(spark, data, "conversations")).drop("repaired")


def byte_pairs(spark: SparkSession, data: str) -> DataFrame:
    """All documents encoded and decoded."""
    return coded_digests(round_trip(table(spark, data, "documents")))


def merkle(spark: SparkSession, data: str) -> DataFrame:
    """Proofs of all documents against the manifest, some of them tampered with."""
    docs = table(spark, data, "documents")
    return proofs(manifest(docs, seen={"text": tampered_text()}), keep=False).drop("proof")


# SQL for small tables: it compares all pairs that share a shingle or a label.
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Smallest id that each of `nodes` reaches over `links` (a, b).
_REACH = """
ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, low) AS (
  SELECT id, id FROM nodes
  UNION
  SELECT ends.b, reach.low FROM reach JOIN ends ON ends.a = reach.node WHERE reach.low < ends.b
),
named AS (SELECT node, min(low) AS component_id FROM reach GROUP BY node)
"""
ORACLES: dict[str, str] = {
    "op1_relative_parsing": f"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS w
  FROM d, unnest(range(1, greatest(len(ws) - 11, 1))) AS t(i)
),
firsts AS (SELECT w, min(doc_id) AS f FROM win GROUP BY w),
gone AS (
  SELECT DISTINCT doc_id, i + k AS p
  FROM win JOIN firsts USING (w), (SELECT unnest(range(13)) AS k) WHERE f < doc_id
),
word AS (SELECT doc_id, p, ws[p] AS x FROM d, unnest(range(1, len(ws) + 1)) AS t(p)),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS text, count(*) AS n
  FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
  CAST(len(ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op9_minmax_dedup": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id,
    array_to_string(CASE WHEN len(ws) < 5 THEN ws ELSE ws[i:i + 4] END, ' ') AS g
  FROM d, unnest(range(1, greatest(len(ws) - 3, 2))) AS t(i) WHERE len(ws) > 0
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
    FROM s AS x JOIN s AS y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2
  ) JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b
  WHERE 100 * c >= 85 * (na.n + nb.n - c)
),
nodes AS (SELECT doc_id AS id FROM documents),
{_REACH}
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN named ON node = doc_id
""",
    "op10_projection_passes": f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v AS x JOIN v AS y
  ON x.label = y.label AND x.vec_id < y.vec_id AND list_cosine_similarity(x.e, y.e) >= 0.93
),
nodes AS (SELECT vec_id AS id FROM embeddings),
{_REACH}
SELECT vec_id, (SELECT count(*) FROM ends WHERE a = vec_id) AS n_links, component_id,
  vec_id = component_id AS kept
FROM embeddings JOIN named ON node = vec_id
""",
}
QUERIES: dict[str, Query] = {
    "op1_relative_parsing": substring,
    "op2_hilbert_shards": sharding,
    "op3_anchor_expansion": pii,
    "op4_attention_quality": quality,
    "op5_cost_packing": packing,
    "op6_ranked_codes": tokenfiles,
    "op7_classifier_chain": toxicity,
    "op8_pigeonhole_matching": decontaminate,
    "op9_minmax_dedup": minmax,
    "op10_projection_passes": vectors,
    "op11_iterative_deepening": repaired,
    "op12_recursive_merges": byte_pairs,
    "op13_butterfly_manifest": merkle,
}
