"""Monitoring: anomalies, alerts, drift, experiments, freshness and incidents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from serpscope import schema as S
from serpscope.functions import keys as K
from serpscope.operators.kpi import mart
from serpscope.operators.ordered import HOT_ROWS, over_order
from serpscope.operators.quantiles import MAP_ROWS, group_quantiles

DRIFT_COLUMNS = ["latency_ms", "page_speed_score", "bounce_rate", "position", S.LABEL]


def _hour() -> Column:
    return F.date_trunc("hour", F.col("timestamp").cast("timestamp")).cast("timestamp_ntz")


def hourly_mart(log: DataFrame, segments: list[str]) -> DataFrame:
    return mart(log, {**{c: F.col(c) for c in segments}, "hour": _hour()})


def _hours_before(keys: list[str], hours: int) -> WindowSpec:
    """The hours before a row's own by the clock; quiet hours do not stretch it."""
    seconds = F.unix_seconds(F.col("hour").cast("timestamp"))
    return Window.partitionBy(*keys).orderBy(seconds).rangeBetween(-3600 * hours, -1)


def zscore_anomalies(
    log: DataFrame,
    segments: list[str] | None = None,
    history: int = 24,
    limit: float = S.ZSCORE_LIMIT,
    least_hours: int = 12,
) -> DataFrame:
    """Hourly segment latency against the mean and deviation of the ``history`` hours before it.
    With fewer than ``least_hours`` of them present there is no score. The window runs over one
    row per segment and hour."""
    segments = segments or ["country", "device_type"]
    hours = hourly_mart(log, segments).withColumn("_x", F.col("latency_sum") / F.col("events"))
    before = _hours_before(segments, history)
    scored = hours.withColumns(
        {
            "_n": F.count("_x").over(before),
            "_mean": F.avg("_x").over(before),
            "_std": F.stddev_samp("_x").over(before),
        }
    )
    z = F.when(
        (F.col("_n") >= least_hours) & (F.col("_std") > 0), (F.col("_x") - F.col("_mean")) / F.col("_std")
    )
    return scored.withColumn("_z", z).select(
        *segments,
        "hour",
        F.round("_x", 6).alias("avg_latency_ms"),
        F.round("_z", 6).alias("zscore"),
        F.coalesce(F.abs("_z") >= limit, F.lit(False)).alias("is_anomaly"),
    )


def seasonal_baseline(log: DataFrame) -> DataFrame:
    """Hourly latency relative to the usual level of its weekday and hour."""
    hours = hourly_mart(log, []).select(
        "hour",
        (F.col("latency_sum") / F.col("events")).alias("_x"),
        F.dayofweek("hour").alias("_dow"),
        F.hour("hour").alias("_hod"),
    )
    slots = hours.groupBy("_dow", "_hod").agg(F.avg("_x").alias("_base"))
    return hours.join(slots, ["_dow", "_hod"]).select(
        "hour",
        F.round("_x", 6).alias("avg_latency_ms"),
        F.round("_base", 6).alias("seasonal_latency_ms"),
        F.round(F.col("_x") / F.col("_base"), 6).alias("seasonal_factor"),
    )


def alert_levels(
    log: DataFrame,
    segments: list[str] | None = None,
    history: int = 24,
    hot_rows: int = MAP_ROWS,
) -> DataFrame:
    """Level 1: the global score falls more than 5 % below its preceding hours, or p99 latency
    passes the limit. Level 2: a segment stays more than 2 % below for over two hours. Level 3:
    a shorter segment drop. One row per alerting scope and hour."""
    segments = segments or ["country", "device_type"]

    def drops(hours: DataFrame, keys: list[str]) -> DataFrame:
        before = _hours_before(keys, history)
        score = F.col("score_sum") / F.col("events")
        hours = hours.withColumn("_score", score)
        return hours.withColumn("_drop", 1 - F.col("_score") / F.avg("_score").over(before))

    p99 = group_quantiles(
        log.select(_hour().alias("hour"), "latency_ms"),
        ["hour"],
        "latency_ms",
        {"_p99": 0.99},
        hot_rows=hot_rows,
    )
    overall = drops(hourly_mart(log, []), []).join(p99, "hour")
    critical = overall.where(
        (F.col("_drop") > 0.05) | (F.col("_p99") > S.P99_LATENCY_LIMIT_MS)
    ).select(
        F.lit("global").alias("scope"),
        "hour",
        F.round("_drop", 6).alias("score_drop"),
        F.lit(1).alias("alert_level"),
    )
    low = drops(hourly_mart(log, segments), segments).where(F.col("_drop") > 0.02)
    # Consecutive hours share the difference between the hour and its rank.
    rank = F.row_number().over(Window.partitionBy(*segments).orderBy("hour"))
    hour_no = F.unix_micros(F.col("hour").cast("timestamp")) / F.lit(3_600_000_000)
    islands = low.withColumn("_island", hour_no.cast("bigint") - rank)
    length = F.count(F.lit(1)).over(Window.partitionBy(*segments, "_island"))
    local = islands.select(
        F.concat_ws("/", *segments).alias("scope"),
        "hour",
        F.round("_drop", 6).alias("score_drop"),
        F.when(length > 2, 2).otherwise(3).alias("alert_level"),
    )
    return critical.unionByName(local)


# --- drift ------------------------------------------------------------------------------


def split_periods(log: DataFrame, cut: str) -> DataFrame:
    """Mark rows before the cut as baseline and the rest as current."""
    recent = F.col("timestamp") >= F.lit(cut).cast("timestamp_ntz")
    return log.withColumn("period", F.when(recent, "current").otherwise("baseline"))


def _long(df: DataFrame, columns: list[str]) -> DataFrame:
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
            for c in columns
        ]
    )
    return df.select("period", F.inline(pairs)).where(F.col("value").isNotNull())


def drift_psi(
    periods: DataFrame,
    columns: list[str] | None = None,
    bins: int = 10,
    limit: float = S.PSI_LIMIT,
) -> DataFrame:
    """Population stability index over equal-width bins of the baseline range. It is null for a
    column without values in either period."""
    columns = columns or DRIFT_COLUMNS
    base = periods.where(F.col("period") == "baseline")
    # One row with two numbers per feature: the bin edges become literals.
    edges = base.agg(
        *[F.min(F.col(c).cast("double")).alias(f"lo_{c}") for c in columns],
        *[F.max(F.col(c).cast("double")).alias(f"hi_{c}") for c in columns],
    ).first()
    slots = []
    for c in columns:
        lo, hi = edges[f"lo_{c}"], edges[f"hi_{c}"]
        if lo is None:
            continue
        width = ((hi - lo) / bins) or 1.0
        slot = F.floor((F.col(c).cast("double") - F.lit(lo)) / F.lit(width))
        slot = F.greatest(F.lit(0), F.least(F.lit(bins - 1), slot))
        slots.append(F.struct(F.lit(c).alias("feature"), slot.cast("int").alias("bin")))
    names = periods.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    if not slots:
        return names.select("feature", F.lit(None).cast("double").alias("psi"), F.lit(None).cast("boolean").alias("drifted"))
    counts = (
        periods.select("period", F.inline(F.array(*slots)))
        .where(F.col("bin").isNotNull())
        .groupBy("feature", "bin")
        .agg(
            F.count_if(F.col("period") == "baseline").alias("_b"),
            F.count_if(F.col("period") == "current").alias("_c"),
        )
    )
    whole = Window.partitionBy("feature")

    def share(count: str) -> Column:
        total = F.sum(count).over(whole)
        return F.when(total > 0, F.greatest(F.col(count) / total, F.lit(1e-6)))

    p, q = share("_b"), share("_c")
    # Bins that are empty on both sides add nothing, so they need no row.
    sums = (
        counts.select("feature", p.alias("_p"), q.alias("_q"))
        .groupBy("feature")
        .agg(F.sum((F.col("_q") - F.col("_p")) * F.log(F.col("_q") / F.col("_p"))).alias("_psi"))
    )
    return (
        names.join(sums, "feature", "left")
        .select(
            "feature",
            F.round("_psi", 6).alias("psi"),
            (F.col("_psi") > limit).alias("drifted"),
        )
    )


def kolmogorov_p(distance: Column, effective_n: Column) -> Column:
    """Asymptotic two-sided p-value of a two-sample distance."""
    x = distance * F.sqrt(effective_n)
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(100)),
        lambda k: F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * x * x),
    )
    total = F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)
    # The series only converges away from zero, where the p-value is 1 to many digits.
    return F.when(x < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * total)))


def drift_ks(
    periods: DataFrame,
    columns: list[str] | None = None,
    p_limit: float = S.KS_P_LIMIT,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Two-sample distance between the periods' distributions. Values are collapsed to counts
    first; the cumulative counts split over chunks when a feature has many distinct values."""
    counts = (
        _long(periods, columns or DRIFT_COLUMNS)
        .groupBy("feature", "value")
        .agg(
            F.count_if(F.col("period") == "baseline").alias("_b"),
            F.count_if(F.col("period") == "current").alias("_c"),
        )
    )
    totals = counts.groupBy("feature").agg(F.sum("_b").alias("_nb"), F.sum("_c").alias("_nc"))
    upto = over_order(
        counts,
        ["feature"],
        ["value"],
        lambda s: s.running_sum("_b", "_ub").running_sum("_c", "_uc"),
        hot_rows,
        costly=True,
    )
    gap = F.abs(F.col("_ub") / F.col("_nb") - F.col("_uc") / F.col("_nc"))
    distance = (
        upto.join(F.broadcast(totals), "feature")  # one row per compared column
        .groupBy("feature", "_nb", "_nc")
        .agg(F.max(gap).alias("_d"))
        .withColumn("_n", F.col("_nb") * F.col("_nc") / (F.col("_nb") + F.col("_nc")))
        .withColumn("_p", kolmogorov_p(F.col("_d"), F.col("_n")))
    )
    return distance.select(
        "feature",
        F.round("_d", 6).alias("ks_distance"),
        F.round("_p", 6).alias("p_value"),
        (F.col("_p") < p_limit).alias("drifted"),
    )


def retrain_trigger(
    psi: DataFrame, ks: DataFrame, label: str = S.LABEL, max_drifted: int = 5
) -> DataFrame:
    """Retrain when more than five features drift or the score distribution has shifted."""
    drifted = psi.agg(F.count_if("drifted").alias("drifted_features"))
    shifted = ks.agg(
        F.coalesce(F.max((F.col("feature") == label) & F.col("drifted")), F.lit(False)).alias(
            "score_shifted"
        )
    )
    # Both sides are one-row aggregates.
    both = drifted.withColumn("_one", F.lit(1)).join(shifted.withColumn("_one", F.lit(1)), "_one")
    return both.select(
        "drifted_features",
        "score_shifted",
        ((F.col("drifted_features") > max_drifted) | F.col("score_shifted")).alias("retrain"),
    )


# --- experiments, freshness, incidents ----------------------------------------------------


def assign_arm(df: DataFrame, salt: str = "exp1", user: str = "user_id_masked") -> DataFrame:
    """Stable 50/50 arm per user."""
    bucket = K.hash_bucket(F.concat(F.lit(salt), F.col(user)))
    return df.withColumn("arm", F.when(bucket % 2 == 0, "control").otherwise("treatment"))


def experiment_srm(arms: DataFrame, user: str = "user_id_masked") -> DataFrame:
    """Chi-square of the users per arm against an even split (3.841 is the 5 % point)."""
    users = arms.select("arm", user).distinct()
    n = users.agg(
        F.count_if(F.col("arm") == "control").alias("control_users"),
        F.count_if(F.col("arm") == "treatment").alias("treatment_users"),
    )
    c, t = F.col("control_users"), F.col("treatment_users")
    chi = (c - t) * (c - t) / (c + t)
    return n.select(
        "control_users",
        "treatment_users",
        F.round(chi, 6).alias("chi_square"),
        (chi > 3.841).alias("mismatch"),
    )


def experiment_lift(arms: DataFrame) -> DataFrame:
    """Click-through per arm, lift, and the two-proportion z value."""

    def of(name: str, column: str) -> Column:
        return F.sum(F.when(F.col("arm") == name, F.col(column)).otherwise(0))

    sums = arms.agg(
        of("control", "clicks").alias("_xc"),
        of("control", "impressions").alias("_nc"),
        of("treatment", "clicks").alias("_xt"),
        of("treatment", "impressions").alias("_nt"),
    )
    pc, pt = F.col("_xc") / F.col("_nc"), F.col("_xt") / F.col("_nt")
    pooled = (F.col("_xc") + F.col("_xt")) / (F.col("_nc") + F.col("_nt"))
    error = F.sqrt(pooled * (1 - pooled) * (1.0 / F.col("_nc") + 1.0 / F.col("_nt")))
    return sums.select(
        F.round(pc, 6).alias("control_ctr"),
        F.round(pt, 6).alias("treatment_ctr"),
        F.round(pt / pc - 1, 6).alias("lift"),
        F.round((pt - pc) / error, 6).alias("z_value"),
    )


def freshness_check(log: DataFrame, as_of: str, limit_hours: int = S.FRESHNESS_HOURS) -> DataFrame:
    now = F.unix_micros(F.lit(as_of).cast("timestamp_ntz").cast("timestamp"))
    newest = log.agg(F.max("timestamp").alias("newest_event"))
    hours = (now - F.unix_micros(F.col("newest_event").cast("timestamp"))) / F.lit(3.6e9)
    return newest.select(
        "newest_event",
        F.round(hours, 6).alias("hours_old"),
        (hours > limit_hours).alias("stale"),
    )


def incident_segment_delta(
    log: DataFrame,
    day: str,
    country: str,
    device: str,
    first_hour: int = 12,
    last_hour: int = 15,
) -> DataFrame:
    """Metrics of one segment in the incident hours against the same hours of other days."""
    hour = F.hour("timestamp")
    segment = log.where(
        (F.col("country") == country)
        & (F.col("device_type") == device)
        & hour.between(first_hour, last_hour)
    )
    during = F.to_date("timestamp") == F.lit(day).cast("date")
    metrics = ["latency_ms", "page_speed_score", "bounce_rate", "clicks", "pogo_stick_flag"]
    means = segment.agg(
        *[F.avg(F.when(during, F.col(m))).alias(f"d_{m}") for m in metrics],
        *[F.avg(F.when(~during, F.col(m))).alias(f"o_{m}") for m in metrics],
    )
    rows = [
        F.struct(
            F.lit(m).alias("metric"),
            F.round(f"o_{m}", 6).alias("usual"),
            F.round(f"d_{m}", 6).alias("incident"),
            F.round(F.col(f"d_{m}") - F.col(f"o_{m}"), 6).alias("delta"),
        )
        for m in metrics
    ]
    return means.select(F.inline(F.array(*rows)))


# --- chronological split ---------------------------------------------------------------------


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def time_cuts(
    df: DataFrame,
    ts: str,
    shares: list[float],
    hot_rows: int = MAP_ROWS,
    accuracy: int | None = None,
) -> list[float]:
    """Times (in microseconds) below which the given shares of the rows lie; ``accuracy``
    trades exact shares for a single pass."""
    names = {f"q{i}": s for i, s in enumerate(shares)}
    whole = df.select(F.lit(1).alias("_all"), _micros(ts).cast("double").alias("_us"))
    row = group_quantiles(
        whole, ["_all"], "_us", names, hot_rows=hot_rows, accuracy=accuracy
    ).first()
    return [row[n] for n in names]


def chronological_split(
    df: DataFrame, ts: str = "timestamp", test_share: float = 0.2, **options
) -> DataFrame:
    """Past rows train, future rows test; equal times never fall on both sides."""
    cut = time_cuts(df, ts, [1 - test_share], **options)[0]
    return df.withColumn("split", F.when(_micros(ts) <= cut, "train").otherwise("test"))


def chronological_folds(
    df: DataFrame, ts: str = "timestamp", folds: int = 5, **options
) -> DataFrame:
    """Block number 0..folds in time order; fold i trains on blocks below i and tests on i."""
    cuts = time_cuts(df, ts, [i / (folds + 1) for i in range(1, folds + 1)], **options)
    block = reduce(
        lambda a, b: a + b, [F.when(_micros(ts) > cut, 1).otherwise(0) for cut in cuts]
    )
    return df.withColumn("block", block)
