"""A table of day folders under versions: a load becomes visible by one commit, or not at all.

Every load writes its rows into folders of its own, ``data/event_date=.../load=...``, and then one
small file that lists the folders of the new version. That file appears by a rename which fails if
the version exists, so of two loads at a time one is refused, and a load that breaks anywhere before
leaves only folders that no version lists. Readers take the newest version and never see a part.

A version's list has one entry per day and load (10 years of daily loads: 3650) with the number of
rows and the newest time, so a watermark is known without reading data. Data files carry Bloom
filters on the id: looking up a few ids reads the row groups that may hold them and no others.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from serpscope.sources.sinks import balanced, with_event_date


#: Ids that are looked up through Bloom filters; more are joined.
LOOKUP_IDS = 1000


class Conflict(RuntimeError):
    """Another load has committed the version that this one was to become."""


@dataclass(frozen=True)
class Folder:
    """Rows of one day from one load; `newest` is an ISO time, None for rows without a time."""

    day: str | None
    load: str
    rows: int
    newest: str | None


class VersionedTable:
    """A fact table partitioned by ``event_date``, with all its versions."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: str = "event_id"):
        self.spark, self.root, self.schema, self.key = spark, root.rstrip("/"), schema, key
        self._fs_path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._fs_path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # --- versions -----------------------------------------------------------------------

    def _version_path(self, version: int) -> str:
        return f"{self.root}/_versions/{version:012d}.json"

    def version(self) -> int:
        """The newest version, 0 before the first load."""
        folder = self._fs_path(f"{self.root}/_versions")
        if not self._fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return max((int(n[:12]) for n in names if n.endswith(".json") and n[:12].isdigit()), default=0)

    def folders(self, version: int | None = None) -> list[Folder]:
        version = self.version() if version is None else version
        if version == 0:
            return []
        lines = self.spark.read.text(self._version_path(version), wholetext=True).first()[0]
        return [Folder(**entry) for entry in json.loads(lines)]

    def commit(self, base: int, folders: list[Folder]) -> int:
        """Make the list the version after `base`; raises Conflict if that exists by now."""
        target = self._fs_path(self._version_path(base + 1))
        draft = self._fs_path(f"{self.root}/_versions/.{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps([asdict(f) for f in folders]).encode()))
        out.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._fs.getUri(), self.spark._jsc.hadoopConfiguration()
        )
        # Refused, not replaced, if the target exists.
        option = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = option
        try:
            context.rename(draft, target, options)
        except Exception as error:
            self._fs.delete(draft, False)
            if "FileAlreadyExists" in str(error) or self._fs.exists(target):
                raise Conflict(f"version {base + 1} of {self.root} exists") from error
            raise
        return base + 1

    # --- data -----------------------------------------------------------------------------

    def _day_path(self, folder: Folder) -> str:
        day = folder.day or "__HIVE_DEFAULT_PARTITION__"
        return f"{self.root}/data/event_date={day}/load={folder.load}"

    def read_folders(self, folders: list[Folder]) -> DataFrame:
        """Rows of the folders with `event_date` and `load`."""
        schema = StructType([*self.schema.fields]).add("event_date", "date").add("load", "string")
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/data")
        return reader.parquet(*[self._day_path(f) for f in folders])

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of a version, the newest by default; `event_date` prunes folders."""
        return self.read_folders(self.folders(version)).drop("load")

    def write(self, rows: DataFrame, ids: int | None = None) -> list[Folder]:
        """Write rows into folders that no version lists yet. ``ids``: about how many a file holds."""
        load = uuid.uuid4().hex
        named = with_event_date(rows).withColumn("load", F.lit(load))
        path = f"{self.root}/data"
        (
            balanced(named.select(*self.schema.names, "event_date", "load"), ["event_date"])
            .write.mode("append")
            .partitionBy("event_date", "load")
            .option(f"parquet.bloom.filter.enabled#{self.key}", "true")
            .option(f"parquet.bloom.filter.expected.ndv#{self.key}", str(ids or 1_000_000))
            .option("parquet.bloom.filter.adaptive.enabled", "true")
            .parquet(path)
        )
        return self._days(load)

    def _days(self, load: str) -> list[Folder]:
        """What a load has written; one row per day reaches the driver."""
        pattern = f"{self.root}/data/event_date=*/load={load}"
        if not self._fs.globStatus(self._fs_path(pattern)):
            return []
        schema = StructType([*self.schema.fields]).add("event_date", "date").add("load", "string")
        written = self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(pattern)
        counted = written.groupBy("event_date").agg(
            F.count(F.lit(1)).alias("n"), F.max("event_timestamp").alias("newest")
        )
        return [
            Folder(
                str(r["event_date"]) if r["event_date"] else None,
                load,
                r["n"],
                r["newest"].isoformat() if r["newest"] else None,
            )
            for r in sorted(counted.collect(), key=lambda r: str(r["event_date"]))
        ]

    def newest(self, folders: list[Folder]) -> datetime | None:
        """The high watermark, from the list alone."""
        known = [f.newest for f in folders if f.newest]
        return max(map(datetime.fromisoformat, known), default=None)

    def find(self, ids: list, folders: list[Folder]) -> DataFrame:
        """Rows with one of up to LOOKUP_IDS ids: each id reaches the Parquet reader, which leaves
        out row groups by their Bloom filters."""
        self.spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", str(LOOKUP_IDS))
        return self.read_folders(folders).where(F.col(self.key).isin(ids))
