"""Documents to training sequences, in five stages.

Each stage takes the documents its predecessor kept and returns documents of the same columns; the
last returns the packed pieces. Between stages the rows are written and read again, so a lost
executor costs one stage at most.

Every stage judges rows, not ids: rows that share an id or have none are judged one by one, and of
repeated rows the first stays. Null and empty texts are scored like others, have no near copies and
no benchmark items, and are packed as their end token. Long texts are read whole. An empty table
gives an empty table. Further columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from serpscope.llm.decontaminate import without_benchmark
from serpscope.llm.minmax import one_of_each
from serpscope.llm.packing import pack
from serpscope.llm.pii import redacted
from serpscope.llm.quality import good_documents
from serpscope.session import bound_batches, materialize, ship_package


#: Percent of their joint five-word shingles that near copies share; op9 alone has 85 by contract.
SIMILAR = 80


def _ready(spark: SparkSession) -> None:
    """All that a stage needs of its session."""
    ship_package(spark)
    bound_batches(spark)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    _ready(spark)
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the first."""
    _ready(spark)
    return one_of_each(docs, SIMILAR)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    _ready(spark)
    return without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    _ready(spark)
    clean = redacted(docs)
    changed = F.length("text").cast(dict(docs.dtypes)["n_chars"])
    return clean.withColumn("n_chars", changed).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    _ready(spark)
    return pack(docs)


STAGES = [
    ("quality_classifier", keep_good),
    ("minhash_near_dedup", keep_one_of_each),
    ("benchmark_decontamination", drop_benchmark),
    ("pii", hide_personal_data),
    ("packing", pack_sequences),
]

#: Not expressible: a trained model and a tokenizer decide. Tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
