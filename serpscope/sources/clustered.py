"""Tables clustered by a key, so that a batch of look-ups reads little of them.

Rows are sorted by the key over range partitions, in small row groups with Bloom filters on it. A few
keys reach the Parquet reader as values: row groups whose range or filter excludes them are not
read. Many keys are joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from serpscope.sources.versioned import LOOKUP_IDS

#: Bytes of a row group: what a look-up reads at the least.
ROW_GROUP = 1 << 20


def write_clustered(
    df: DataFrame, path: str, key: str, files: int | None = None, row_group: int = ROW_GROUP
) -> None:
    """Write a table sorted by its key, in `files` files (by default as shuffles are partitioned)."""
    ranged = df.repartitionByRange(files, key) if files else df.repartitionByRange(key)
    (
        ranged.sortWithinPartitions(key)
        .write.mode("overwrite")
        .option("parquet.block.size", row_group)
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .parquet(path)
    )


def rows_of_keys(spark: SparkSession, path: str, schema: StructType, key: str, keys: list) -> DataFrame:
    """The rows of up to LOOKUP_IDS keys, from the row groups that may hold them."""
    spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", str(LOOKUP_IDS))
    return spark.read.schema(schema).parquet(path).where(F.col(key).isin(keys))


def lookup_clustered(
    requests: DataFrame, path: str, schema: StructType, key: str, columns: list[str]
) -> DataFrame:
    """Requests with the columns of their key's row, null where there is none."""
    spark = requests.sparkSession
    asked = requests.select(key).where(F.col(key).isNotNull()).distinct().limit(LOOKUP_IDS + 1)
    keys = [r[0] for r in asked.collect()]
    if len(keys) <= LOOKUP_IDS:
        # As many rows as keys.
        found = F.broadcast(rows_of_keys(spark, path, schema, key, keys).select(key, *columns))
    else:
        found = spark.read.schema(schema).parquet(path).select(key, *columns)
    return requests.join(found, key, "left")
