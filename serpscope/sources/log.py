"""Readers of the event log, and the log derived from raw interaction events."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from serpscope import schema as S
from serpscope.functions import keys as K
from serpscope.functions import scalars as X


def scan_events(
    spark: SparkSession, path: str, schema: StructType = S.PARTITIONED_EVENT_LOG
) -> DataFrame:
    """Hive-partitioned Parquet log with a declared schema; a missing path raises."""
    return spark.read.schema(schema).parquet(path)


def scan_pruned(
    spark: SparkSession, path: str, columns: list[str], schema: StructType
) -> DataFrame:
    """Only the named columns; a missing table reads as empty."""
    wanted = StructType([schema[c] for c in columns])
    reader = spark.read.schema(wanted)
    try:
        # Partition folders add their columns; keep the named ones only.
        return reader.parquet(path).select(*columns)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], wanted)


def time_slice(
    df: DataFrame, start: str | None = None, end: str | None = None, ts: str = "timestamp"
) -> DataFrame:
    """Rows with start <= ts < end. The same bounds are put on whichever partition columns the
    table has, so that only the folders in range are listed and read."""
    if {"year", "month", "day"} <= set(df.columns):
        folder = F.make_date("year", F.col("month").cast("int"), F.col("day").cast("int"))
        unit = "day"
    elif "event_date" in df.columns:
        folder, unit = F.col("event_date"), "day"
    elif "event_month" in df.columns:
        # Months written as yyyy-MM may be read back as text.
        folder = F.to_date(F.concat(F.col("event_month").cast("string"), F.lit("-01")))
        unit = "month"
    else:
        folder, unit = None, None
    for bound, above in ((start, True), (end, False)):
        if bound is None:
            continue
        at = F.lit(bound).cast("timestamp_ntz")
        df = df.where(F.col(ts) >= at if above else F.col(ts) < at)
        if folder is not None:
            first = F.trunc(at.cast("date"), "month") if unit == "month" else at.cast("date")
            df = df.where(folder >= first if above else folder <= at.cast("date"))
    return df


def union_daily(batches: list[DataFrame]) -> DataFrame:
    """Concatenate daily slices by column name."""
    result = batches[0]
    for batch in batches[1:]:
        result = result.unionByName(batch)
    return result


def _chain(bucket, cases: list[tuple[int, str]], default: str):
    """Value by upper bound of the bucket."""
    expr = None
    for bound, value in cases:
        expr = (F.when if expr is None else expr.when)(bucket < bound, value)
    return expr.otherwise(default)


def derive_log(raw: DataFrame) -> DataFrame:
    """Event log as a narrow projection of raw interaction events (no shuffle)."""
    # One hash per row feeds all derived attributes, with independent moduli.
    df = raw.withColumn("_h", K.hash_bucket(F.col("event_id"))).withColumn(
        "_k", F.get_json_object("props", "$.k").cast("int")
    )
    h, k = F.col("_h"), F.col("_k")
    h4, h20 = F.floor(h / 4), F.floor(h / 20)
    click = F.col("event_type") == "click"
    device = h % 20
    country = h % 4
    regions = {
        "United States": ["California", "Texas", "New York"],
        "Japan": ["Tokyo", "Osaka", "Kyoto"],
        "United Kingdom": ["Greater London", "Scotland", "Wales"],
        "Germany": ["Bavaria", "Berlin", "Hamburg"],
    }
    region = F.element_at(
        F.array(*[F.lit(r) for c in S.COUNTRIES for r in regions[c]]),
        (country * 3 + h4 % 3 + 1).cast("int"),
    )
    native = F.element_at(
        F.array(*[F.lit(x) for x in ["en", "ja", "en", "de"]]), (country + 1).cast("int")
    )
    return df.select(
        F.concat(F.lit("evt_"), F.lpad(F.col("event_id").cast("string"), 16, "0")).alias(
            "event_id"
        ),
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("usr_"), F.lpad(F.col("user_id").cast("string"), 8, "0")).alias(
            "user_id_masked"
        ),
        F.concat_ws(
            "_", F.lit("sess"), F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")
        ).alias("session_id"),
        K.pick(S.COUNTRIES, country).alias("country"),
        region.alias("region"),
        F.when(h20 % 10 == 0, "en").otherwise(native).alias("language"),
        _chain(device, [(11, "Mobile"), (18, "Desktop")], "Tablet").alias("device_type"),
        K.pick(S.BROWSERS, h20).alias("browser_name"),
        F.when(device < 11, K.pick(["Android", "iOS"], h4))
        .when(device < 18, K.pick(["Windows", "macOS", "Linux"], h4))
        .otherwise(K.pick(["Android", "iOS"], h4))
        .alias("os_name"),
        (1 + F.floor(h / 7) % 10).cast("int").alias("position"),
        click.cast("int").alias("clicks"),
        F.lit(1).alias("impressions"),
        K.pick(["Featured Snippet", "Knowledge Graph", "Local Pack"], h20).alias(
            "serp_features"
        ),
        F.col("value").alias("latency_ms"),
        (100 - h % 101).cast("double").alias("page_speed_score"),
        ((h % 101) / F.lit(100.0)).alias("bounce_rate"),
        (F.col("event_type") == "error").cast("int").alias("pogo_stick_flag"),
        (F.col("event_type") == "view").cast("int").alias("reformulation_flag"),
        F.when(click, F.col("value")).otherwise(0.0).alias("dwell_time_sec"),
        F.when(click, (h20 % 101).cast("double")).otherwise(0.0).alias("scroll_depth"),
        F.when(F.col("event_type").isin("purchase", "signup"), "Commercial")
        .when(F.col("event_type") == "view", "Navigational")
        .otherwise("Informational")
        .alias("search_intent"),
        K.pick(S.CATEGORIES, k).alias("query_category"),
        F.concat(F.lit("query "), k.cast("string")).alias("search_query_masked"),
        F.when(click, F.col("value") / F.lit(100.0)).otherwise(0.0).alias(
            "revenue_estimate_usd"
        ),
    ).withColumn("search_quality_score", X.quality_score())


def load_log(spark: SparkSession, data_dir: str) -> DataFrame:
    """The log over the whole raw events table."""
    raw = spark.read.schema(S.RAW_EVENTS).parquet(f"{data_dir}/events.parquet")
    return derive_log(raw)
