"""Data-quality checks: the 14-check suite, row constraints, key and relationship tests."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serpscope import schema as S
from serpscope.operators.joins import orphans


@dataclass(frozen=True)
class Check:
    column: str
    kind: str  # not_null, in_set or between
    values: tuple = ()

    def unexpected(self) -> Column:
        """True where a value breaks the rule; nulls only break not_null."""
        col = F.col(self.column)
        if self.kind == "not_null":
            return col.isNull()
        if self.kind == "in_set":
            return F.coalesce(~col.isin(*self.values), F.lit(False))
        return F.coalesce(~col.between(*self.values), F.lit(False))


EVENT_CHECKS = [
    Check("event_id", "not_null"),
    Check("timestamp", "not_null"),
    Check("user_id_masked", "not_null"),
    Check("session_id", "not_null"),
    Check("country", "in_set", tuple(S.COUNTRIES)),
    Check("device_type", "in_set", tuple(S.DEVICES)),
    Check("search_intent", "in_set", tuple(S.INTENTS)),
    Check("clicks", "in_set", (0, 1)),
    Check("impressions", "in_set", (1,)),
    Check("position", "between", (1, 10)),
    Check("latency_ms", "between", (0.0, 15000.0)),
    Check("page_speed_score", "between", (0.0, 100.0)),
    Check("bounce_rate", "between", (0.0, 1.0)),
    Check("search_quality_score", "between", (0.0, 100.0)),
]


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All checks in one scan and one aggregation, then one row per check."""
    sums = [F.count(F.lit(1)).alias("_n")]
    for i, check in enumerate(checks):
        sums.append(F.count_if(F.col(check.column).isNull()).alias(f"_m{i}"))
        sums.append(F.count_if(check.unexpected()).alias(f"_u{i}"))
    rows = F.array(
        *[
            F.struct(
                F.lit(check.column).alias("column_name"),
                F.lit(check.kind).alias("check_type"),
                F.col("_n").alias("element_count"),
                F.col(f"_m{i}").alias("missing_count"),
                F.col(f"_u{i}").alias("unexpected_count"),
            )
            for i, check in enumerate(checks)
        ]
    )
    flat = df.agg(*sums).select(F.inline(rows))
    # A not-null check is measured against all rows, the others against present values.
    base = F.when(F.col("check_type") == "not_null", F.col("element_count")).otherwise(
        F.col("element_count") - F.col("missing_count")
    )
    percent = F.when(base == 0, 0.0).otherwise(F.col("unexpected_count") * 100.0 / base)
    return flat.withColumns(
        {
            "unexpected_percent": F.round(percent, 6),
            "success": F.col("unexpected_count") == 0,
        }
    )


def validate_events(log: DataFrame) -> DataFrame:
    return run_checks(log, EVENT_CHECKS)


def dq_statistics(results: DataFrame) -> DataFrame:
    passed = F.count_if("success")
    total = F.count(F.lit(1))
    return results.agg(
        total.alias("evaluated_expectations"),
        passed.alias("successful_expectations"),
        (total - passed).alias("unsuccessful_expectations"),
        F.round(passed * 100.0 / total, 6).alias("success_percent"),
    )


def dq_summary(results: DataFrame) -> DataFrame:
    passed = F.count_if("success")
    total = F.count(F.lit(1))
    return results.agg(
        (passed == total).alias("validation_success"),
        F.max("element_count").alias("total_records_validated"),
        total.alias("evaluated_expectations"),
        passed.alias("successful_expectations"),
        (total - passed).alias("unsuccessful_expectations"),
        F.round(passed * 100.0 / total, 6).alias("success_percent"),
    )


def validation_failures(results: DataFrame) -> DataFrame:
    return results.where(~F.col("success")).select(
        "column_name", "check_type", "unexpected_count"
    )


class ValidationFailed(RuntimeError):
    """Raised by the gate; carries the failing checks."""


def dq_gate(results: DataFrame) -> None:
    """Stop the load when a check fails. Reads one row per check, never the data."""
    failed = validation_failures(results).collect()
    if failed:
        text = ", ".join(f"{r.column_name} {r.check_type} {r.unexpected_count}" for r in failed)
        raise ValidationFailed(text)


def broken(checks: list[Check]) -> Column:
    return reduce(lambda a, b: a | b, [c.unexpected() for c in checks])


def valid_rows(df: DataFrame, checks: list[Check] | None = None) -> DataFrame:
    return df.where(~broken(checks or EVENT_CHECKS))


def quarantined_rows(df: DataFrame, checks: list[Check] | None = None) -> DataFrame:
    return df.where(broken(checks or EVENT_CHECKS))


def fact_constraints() -> dict[str, Column]:
    """Row rules of the fact table; every listed column is also mandatory."""
    return {
        "position_range": F.col("position").between(1, 10),
        "clicks_binary": F.col("clicks").isin(0, 1),
        "impressions_one": F.col("impressions") == 1,
        "latency_nonnegative": F.col("latency_ms") >= 0.0,
        "page_speed_range": F.col("page_speed_score").between(0.0, 100.0),
        "bounce_range": F.col("bounce_rate").between(0.0, 1.0),
        "pogo_binary": F.col("pogo_stick_flag").isin(0, 1),
        "reformulation_binary": F.col("reformulation_flag").isin(0, 1),
        "dwell_nonnegative": F.col("dwell_time_sec") >= 0.0,
        "revenue_nonnegative": F.col("revenue_estimate_usd") >= 0.0,
        "score_range": F.col("search_quality_score").between(0.0, 100.0),
    }


def query_constraints() -> dict[str, Column]:
    return {
        "navigational_binary": F.col("is_navigational").isin(0, 1),
        "informational_binary": F.col("is_informational").isin(0, 1),
        "transactional_binary": F.col("is_transactional").isin(0, 1),
        "query_length_positive": F.col("query_length_words") > 0,
    }


def user_constraints() -> dict[str, Column]:
    return {"current_binary": F.col("is_current_record").isin(0, 1)}


def constraint_violations(df: DataFrame, constraints: dict[str, Column]) -> DataFrame:
    """Violations per named rule (a null value violates), one scan."""
    counts = df.agg(
        *[
            F.count_if(~F.coalesce(rule, F.lit(False))).alias(name)
            for name, rule in constraints.items()
        ]
    )
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("constraint_name"), F.col(n).alias("violations"))
                    for n in constraints
                ]
            )
        )
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


def null_key_counts(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in keys])
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(table).alias("table_name"),
                        F.lit(k).alias("key_name"),
                        F.col(k).alias("null_count"),
                    )
                    for k in keys
                ]
            )
        )
    )


FACT_KEYS = {
    "geo_key": "dim_geography",
    "system_key": "dim_systems",
    "query_key": "dim_queries",
    "user_key": "dim_users",
}


def relationship_counts(star: dict[str, DataFrame]) -> DataFrame:
    """Orphaned fact rows per foreign key. Keys are counted before the join, so a hot key is
    one row by then."""
    fact = star["fct_search_events"]
    parts = [
        orphans(fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), star[dim], key)
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_count"))
        .select(F.lit(key).alias("key_name"), "orphan_count")
        for key, dim in FACT_KEYS.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def valid_requests(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scoring requests that satisfy the field bounds, and the rejected rest."""
    texts = ["user_id_masked", "search_query", "search_intent", "query_category"]
    rules = [F.length(c) >= 1 for c in texts] + [
        F.col("latency_ms") >= 0.0,
        F.col("page_speed_score").between(0.0, 100.0),
        F.col("bounce_rate").between(0.0, 1.0),
        F.col("position") >= 1,
    ]
    ok = F.coalesce(reduce(lambda a, b: a & b, rules), F.lit(False))
    return df.where(ok), df.where(~ok)
