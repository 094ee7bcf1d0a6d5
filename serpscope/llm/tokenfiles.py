"""Token ids in files of frequency-ranked, byte-aligned codes with separate control bytes.

Ids are replaced by their rank in the corpus, so the most frequent 256 take one byte and nearly
all others two. A value takes one to four bytes, lowest first. Two control bits hold its number of
bytes less one; four values share a control byte, the first in the lowest bits. Control and data
bytes are stored apart, so a block is decoded without a loop: one table lookup for each control
byte says which bytes of four values are stored, and the data bytes fall into these places.

Files are Parquet: a row is a block of whole documents in ascending order of doc_id, with the
documents' ids and lengths beside both byte strings. The ranks are a table of their own.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from serpscope.llm.tokens import BYTE_BPE, encoder, groups_of, with_end
from serpscope.session import materialize, scratch_path

#: Ids after which a block is closed; a longer document is a block of its own.
BLOCK_IDS = 1 << 16
#: Bytes of a row group: writers buffer so much for each task.
ROW_GROUP = 8 << 20

# By a value's number of bytes less one, which of its four bytes are kept; and the same for the four
# values of each control byte.
_KEPT = np.arange(4) <= np.arange(4)[:, None]
_KEPT_BY_CONTROL = _KEPT[(np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3].reshape(256, 16)


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, dtype="<u4")
    extra = np.zeros((len(values) + 3) // 4 * 4, dtype=np.uint8)
    longest = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    for n in range(1, longest):
        extra[: len(values)] += values >= 1 << 8 * n
    kept = _KEPT[:, :longest][extra[: len(values)]]
    data = values.view(np.uint8).reshape(-1, 4)[:, :longest][kept]
    codes = extra.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    return control.tobytes(), data.tobytes()


def decode_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The first n values."""
    kept = _KEPT_BY_CONTROL[np.frombuffer(control, dtype=np.uint8)].reshape(-1, 4)[:n]
    values = np.zeros((n, 4), dtype=np.uint8)
    values[kept] = np.frombuffer(data, dtype=np.uint8)
    return values.view("<u4").ravel()


def _tokens(path: str):
    """Blocks of raw ids, in the order of the rows; a task's last one says how often it had each."""

    def run(batches):
        own = encoder(path)
        part, number, ids, tokens, n = TaskContext.get().partitionId(), 0, [], [], 0
        count = np.zeros(own.tokenizer.get_vocab_size(), dtype="<i8")

        def block(last: bool):
            sizes = np.array([len(t) for t in tokens], dtype="<u8").tobytes()
            flat = np.concatenate(tokens)
            count[:] += np.bincount(flat, minlength=len(count))
            return pa.RecordBatch.from_pydict(
                {
                    "part": [part],
                    "block": [number],
                    "doc_ids": [ids],
                    "sizes": [sizes],
                    "raw": [flat.tobytes()],
                    "counts": [count.tobytes() if last else None],
                },
                pa.schema(
                    [
                        ("part", pa.int32()),
                        ("block", pa.int64()),
                        ("doc_ids", pa.list_(pa.int64())),
                        ("sizes", pa.binary()),
                        ("raw", pa.binary()),
                        ("counts", pa.binary()),
                    ]
                ),
            )

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                names = some.column("doc_id").to_pylist()
                # As bytes first: a text may hold some that are no UTF-8.
                raw = some.column("text").cast(pa.binary()).to_pylist()
                texts = [(t or b"").decode("utf-8", "replace") for t in raw]
                for a, b in groups_of(texts):
                    for doc_id, found in zip(names[a:b], own.encode(texts[a:b])):
                        if n >= BLOCK_IDS:
                            yield block(False)
                            number, ids, tokens, n = number + 1, [], [], 0
                        ids.append(doc_id)
                        tokens.append(with_end(found))
                        n += len(found) + 1
        if ids:
            yield block(True)

    return run


def _raw_ids(column: pa.Array, at: int, path: str) -> np.ndarray:
    return np.frombuffer(column[at].as_buffer(), dtype=encoder(path).kind)


def _frequencies(batches):
    """How often each id occurs in the tasks that wrote these counts."""
    for batch in batches:
        for counts in batch.column("counts"):
            count = np.frombuffer(counts.as_buffer(), dtype="<i8")
            used = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(count[used])], ["id", "n"])


def _code(path: str, rank_of: np.ndarray):
    def run(batches):
        names = ("part", "block", "doc_ids", "sizes")
        for batch in batches:
            for at in range(batch.num_rows):
                control, data = encode_values(rank_of[_raw_ids(batch.column("raw"), at, path)])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(at, 1) for c in names),
                        pa.array([control], pa.binary()),
                        pa.array([data], pa.binary()),
                    ],
                    [*names, "control", "data"],
                )

    return run


_WRITER = {"parquet.block.size": ROW_GROUP, "compression": "zstd"}
BLOCK = "part int, block long, doc_ids array<long>, sizes binary"


def write_tokens(docs: DataFrame, target: str, path: str = BYTE_BPE) -> None:
    """Writes the ids of all documents, each with its end id, in ascending order of doc_id.

    docs: `doc_id`, `text`; further columns are ignored. A null text is empty: its end id alone.
    Rows without an id come first; rows that share one follow each other in any order. `target`
    gets two tables: `ranks` (`rank`, `id`) and `blocks`.

    The most that reaches the driver is one count for each id of the vocabulary.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spark = docs.sparkSession
    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    held = scratch_path(spark, "token-blocks")
    schema = f"{BLOCK}, raw binary, counts binary"
    ordered.mapInArrow(_tokens(path), schema).write.options(**_WRITER).parquet(held)
    raw = spark.read.schema(schema).parquet(held)
    counts = raw.select("counts").where("counts is not null")
    counts = counts.mapInArrow(_frequencies, "id long, n long")
    counts = counts.groupBy("id").agg(F.sum("n").alias("n")).collect()
    by_rank = [r["id"] for r in sorted(counts, key=lambda r: (-r["n"], r["id"]))]
    rank_of = np.zeros(max(by_rank, default=0) + 1, dtype=np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank))
    ranks = spark.createDataFrame(list(enumerate(by_rank)), "rank long, id long")
    ranks.coalesce(1).write.parquet(f"{target}/ranks")
    coded = raw.drop("counts").mapInArrow(_code(path, rank_of), f"{BLOCK}, control binary, data binary")
    coded.write.options(**_WRITER).parquet(f"{target}/blocks")


def _decode(by_rank: np.ndarray):
    """Each document of a block: its start there, its number of ids and their checksum."""

    def run(batches):
        for batch in batches:
            for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                size = np.frombuffer(row["sizes"], dtype="<u8").astype(np.int64)
                end = np.cumsum(size)
                values = decode_values(row["control"], row["data"], int(end[-1]))
                ids = by_rank[values]
                crc = [zlib.crc32(ids[e - s : e].tobytes()) for s, e in zip(size, end)]
                n = len(size)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * n, pa.int32()),
                        pa.array([row["block"]] * n, pa.int64()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(end - size),
                        pa.array(size),
                        pa.array(crc, pa.int64()),
                    ],
                    ["part", "block", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    return run


def read_tokens(spark: SparkSession, source: str) -> DataFrame:
    """Decodes what `write_tokens` wrote: `doc_id`, `start`, `n_tokens`, `ids_crc32` per document.

    `start` counts the ids of all documents before it. Only lengths are shuffled.
    """
    ranks = spark.read.schema("rank long, id long").parquet(f"{source}/ranks")
    by_rank = np.array([r["id"] for r in ranks.orderBy("rank").collect()], dtype="<u4")
    blocks = spark.read.schema(f"{BLOCK}, control binary, data binary").parquet(f"{source}/blocks")
    rows = materialize(
        blocks.mapInArrow(
            _decode(by_rank),
            "part int, block long, doc_id long, inside long, n_tokens long, ids_crc32 long",
        ),
        "token-rows",
    )
    sizes = rows.groupBy("part", "block").agg(F.sum("n_tokens").alias("n"))
    in_part = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        "part", "block", "n", F.coalesce(F.sum("n").over(in_part), F.lit(0)).alias("in_part")
    )
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    # One row for each file of the sorted write.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    offsets = sizes.join(parts, "part").select(
        "part", "block", (F.col("in_part") + F.col("before")).alias("base")
    )
    return rows.join(offsets, ["part", "block"]).select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def through_files(docs: DataFrame, path: str = BYTE_BPE) -> DataFrame:
    """Writes the documents' ids to the shared folder and reads them back."""
    target = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, target, path)
    return read_tokens(docs.sparkSession, target)
