"""Incremental fact load by high watermark, and slowly changing user versions."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serpscope import schema as S
from serpscope.functions import keys as K
from serpscope.operators.ordered import HOT_ROWS, broadcast_if_small
from serpscope.operators.star import add_sequence
from serpscope.session import materialize
from serpscope.sources.versioned import LOOKUP_IDS, Folder, VersionedTable


def high_watermark(target: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    return target.agg(F.max(ts).alias("high_watermark"))


def watermark_value(target: DataFrame, lookback_hours: int = 0) -> datetime | None:
    """One timestamp on the driver, so that it reaches the scan as a literal. In a table
    partitioned by day only the newest day is read for it."""
    if "event_date" in target.columns:
        newest_day = target.agg(F.max("event_date")).first()[0]
        target = target.where(F.col("event_date") == F.lit(newest_day))
    newest = high_watermark(target).first()[0]
    return None if newest is None else newest - timedelta(hours=lookback_hours)


def _after(watermark: datetime | None) -> Column:
    if watermark is None:
        return F.lit(True)
    return F.col("event_timestamp") > F.lit(watermark).cast("timestamp_ntz")


def new_slice(staged: DataFrame, watermark: datetime | None) -> DataFrame:
    return staged.where(_after(watermark))


def late_rows(staged: DataFrame, target: DataFrame, lookback_hours: int = 0) -> DataFrame:
    """Rows that the incremental load skips: those at or before the watermark, and those without
    a time once there is one."""
    watermark = watermark_value(target, lookback_hours)
    return staged.where(~F.coalesce(_after(watermark), F.lit(False)))


def incremental_slice(
    staged: DataFrame,
    target: DataFrame,
    lookback_hours: int = 0,
    continue_sequences: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Numbered rows newer than the target. Numbering restarts within the slice by default;
    ``continue_sequences`` starts from each session's last number in the target."""
    fresh = new_slice(staged, watermark_value(target, lookback_hours))
    numbered = add_sequence(fresh, hot_rows=hot_rows)
    if not continue_sequences:
        return numbered
    replaced = fresh.select("event_id")
    kept = target.join(replaced, "event_id", "left_anti") if lookback_hours else target
    return _continued(numbered, kept)


def _continued(numbered: DataFrame, kept: DataFrame) -> DataFrame:
    """Numbers that go on from each session's last one."""
    last = kept.groupBy("session_id").agg(F.max("session_event_sequence").alias("_last"))
    return numbered.join(last, "session_id", "left").select(
        *S.FACT,
        (F.col("session_event_sequence") + F.coalesce("_last", F.lit(0))).alias(
            "session_event_sequence"
        ),
    )


def incremental_fact(staged: DataFrame, target: DataFrame, **options) -> DataFrame:
    """Target after the load: new rows replace rows with the same event id."""
    fresh = incremental_slice(staged, target, **options)
    kept = target.join(fresh.select("event_id"), "event_id", "left_anti")
    return kept.unionByName(fresh)


def load_incremental(
    staged: DataFrame,
    table: VersionedTable,
    lookback_hours: int = 0,
    continue_sequences: bool = False,
    hot_rows: int = HOT_ROWS,
) -> int:
    """Upsert into a versioned table; returns the version readers see from now on.

    The watermark comes from the table's list. New rows go into folders of their own; of the loaded
    folders only those that hold a replaced id are read whole and written anew, and one that loses
    all its rows is no longer listed. All of that is invisible until the last step, the commit: a
    load that breaks before can simply be run again, and of two at a time one gets a `Conflict`. A
    load without new rows makes no version.
    """
    base = table.version()
    folders = table.folders(base)
    newest = table.newest(folders)
    watermark = None if newest is None else newest - timedelta(hours=lookback_hours)
    fresh = materialize(new_slice(staged, watermark), "slice")
    ids = fresh.select(table.key)
    touched = _holding(table, folders, ids)
    kept = table.read_folders(touched).drop("event_date", "load")
    kept = kept.join(ids, table.key, "left_anti")
    numbered = add_sequence(fresh, hot_rows=hot_rows)
    if continue_sequences:
        numbered = _continued(numbered, _others(table, folders, ids))
    new = table.write(numbered.unionByName(kept))
    if not new and not touched:
        return base
    return table.commit(base, [f for f in folders if f not in touched] + new)


def _holding(table: VersionedTable, folders: list[Folder], ids: DataFrame) -> list[Folder]:
    """The folders with a row of one of the ids.

    Few ids are looked up, which reads the row groups that may have them by their Bloom filters; of
    many, the ids of all folders are joined, and no other column.
    """
    few = [r[0] for r in ids.where(F.col(table.key).isNotNull()).limit(LOOKUP_IDS + 1).collect()]
    if len(few) <= LOOKUP_IDS:
        hits = table.find(few, folders)
    else:
        hits = table.read_folders(folders).join(broadcast_if_small(ids), table.key, "left_semi")
    # At most one row per folder.
    found = {(r[0], r[1]) for r in hits.select("event_date", "load").distinct().collect()}
    return [f for f in folders if (date.fromisoformat(f.day) if f.day else None, f.load) in found]


def _others(table: VersionedTable, folders: list[Folder], ids: DataFrame) -> DataFrame:
    return table.read_folders(folders).join(ids, table.key, "left_anti")


VERSIONED = ["gender", "age", "signup_channel", "signup_timestamp", "user_segment"]


def version_key() -> Column:
    """Key of one user version: the id and the start of its validity."""
    return K.surrogate_key("user_id_masked", "record_start_timestamp")


def scd2_merge(dim: DataFrame, changes: DataFrame, tracked: list[str] = VERSIONED) -> DataFrame:
    """Close the current version of changed users and open a new one.

    ``changes`` has one row per user: user_id_masked, the tracked columns and changed_at.
    Rows equal to the current version leave it untouched, and so do changes that are no newer than
    it. ``user_key`` names the user in all versions, so facts keep resolving; ``version_key`` names
    one version.
    """
    incoming = changes.select(
        "user_id_masked", "changed_at", *[F.col(c).alias(f"_new_{c}") for c in tracked]
    )
    current = dim.where(F.col("is_current_record") == 1)
    history = dim.where(F.col("is_current_record") != 1)
    paired = current.join(incoming, "user_id_masked", "full_outer")
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(c).eqNullSafe(F.col(f"_new_{c}"))
    known = F.col("record_start_timestamp").isNotNull()
    arrived = F.col("changed_at").isNotNull()
    newer = F.col("changed_at") > F.col("record_start_timestamp")
    changed = arrived & (~known | (~same & newer))
    # Each pair yields the old version, the new version, or both, in one pass.
    open_version = F.struct(
        *[F.col(f"_new_{c}").alias(c) for c in tracked],
        F.col("changed_at").alias("record_start_timestamp"),
        F.lit(None).cast("timestamp_ntz").alias("record_end_timestamp"),
        F.lit(1).alias("is_current_record"),
    )
    old_version = F.struct(
        *[F.col(c).alias(c) for c in tracked],
        F.col("record_start_timestamp"),
        F.when(changed, F.col("changed_at")).alias("record_end_timestamp"),
        F.when(changed, 0).otherwise(1).alias("is_current_record"),
    )
    versions = F.filter(
        F.array(F.when(known, old_version), F.when(changed, open_version)),
        lambda v: v.isNotNull(),
    )
    merged = paired.select("user_id_masked", F.inline(versions))
    columns = ["user_id_masked", *merged.columns[1:]]
    return (
        merged.unionByName(history.select(*columns))
        .withColumns({"user_key": K.user_key(), "version_key": version_key()})
        .select("user_key", "version_key", *columns)
    )


def scd2_asof_lookup(events: DataFrame, dim: DataFrame, ts: str, columns: list[str]) -> DataFrame:
    """Attach the user version valid at event time (start inclusive, end exclusive)."""
    versions = dim.select(
        F.col("user_id_masked").alias("_user"),
        F.col("record_start_timestamp").alias("_from"),
        F.col("record_end_timestamp").alias("_to"),
        *columns,
    )
    valid = (
        (F.col("user_id_masked") == F.col("_user"))
        & (F.col(ts) >= F.col("_from"))
        & (F.col("_to").isNull() | (F.col(ts) < F.col("_to")))
    )
    return events.join(versions, valid, "left").select(*events.columns, *columns)
