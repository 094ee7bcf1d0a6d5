"""Merkle manifest of a table, with an inclusion proof for every row, by butterfly exchange.

Rows of a group (a source) are the leaves of a tree of fixed fanout, in the order of their key; the
roots of the groups are the leaves of a second tree. Leaves lie in aligned blocks of a power of the
fanout. Each block hashes its own subtree, then blocks meet round by round: in round r the blocks
whose numbers differ in digit r alone (base fanout) swap the roots they hold, and every one of them
hashes the parent. After log(blocks) rounds each block holds the root and all siblings on its way
up, so nothing is handed down again. The price is that ancestors are hashed once per block below.

A group's last subtree may lack blocks; those it has then answer for the missing ones. A meeting
has at most `fanout` rows, whatever the group's size. In the second tree one block speaks for each
group, and all its blocks take the run. Only digests travel between blocks, never texts.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serpscope.llm.common import global_rank
from serpscope.operators.ordered import join_keys
from serpscope.session import materialize

FANOUT = 16
#: Rows from which blocks are larger by one level, so that blocks stay few against rows.
MANY_ROWS = 1 << 24
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_hash(columns: list[Column]) -> Column:
    """SHA-256 over the values, each `-` if null, else its UTF-8 bytes' count, `:` and itself."""
    parts = []
    for c in columns:
        text = c.cast("string")
        size = F.octet_length(text).cast("string")
        parts.append(F.coalesce(F.concat(size, F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _h(parts: bytes) -> bytes:
    return hashlib.sha256(parts).hexdigest().encode()


def _climb(nodes: list[bytes], fanout: int, levels: int | None) -> list[list[bytes]]:
    """All levels of a tree over hex digests: so many above the leaves, or up to a single root."""
    tree = [nodes]
    while len(tree) <= levels if levels is not None else len(tree[-1]) > 1:
        below = tree[-1]
        tree.append([_h(b"".join(below[i : i + fanout])) for i in range(0, len(below), fanout)])
    return tree


def _hex(raw: bytes) -> list[bytes]:
    text = raw.hex().encode()
    return [text[i : i + 64] for i in range(0, len(text), 64)]


def _depth(block: int, fanout: int) -> int:
    depth = 0
    while fanout**depth < block:
        depth += 1
    return depth


BLOCK = (
    "group_no long, block long, blocks long, doc_ids array<long>, leaves binary, seen binary, node binary"
)
_BLOCK = pa.schema(
    [
        ("group_no", pa.int64()),
        ("block", pa.int64()),
        ("blocks", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("leaves", pa.binary()),
        ("seen", pa.binary()),
        ("node", pa.binary()),
    ]
)


def _blocks(size: int, fanout: int):
    """Packs the sorted leaves of each block into one row with the root of its subtree."""

    def close(key, rows):
        leaves = b"".join(r[2] for r in rows)
        depth = _depth(size, fanout) if key[2] > 1 else None
        root = bytes.fromhex(_climb(_hex(leaves), fanout, depth)[-1][0].decode())
        seen = b"".join(r[3] for r in rows)
        row = [*key, [r[1] for r in rows], leaves, seen, root]
        return pa.RecordBatch.from_pydict({f.name: [v] for f, v in zip(_BLOCK, row)}, _BLOCK)

    def rows(batches):
        for batch in batches:
            names = ("group_no", "block", "blocks")
            keys = zip(*(batch.column(c).to_pylist() for c in names))
            rest = (batch.column(c).to_pylist() for c in ("doc_id", "leaf", "seen"))
            yield from zip(keys, *rest)

    def run(batches):
        for key, own in groupby(rows(batches), key=lambda r: r[0]):
            yield close(key, list(own))

    return run


def _concat_hex(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda x: F.lower(F.hex(x["node"]))), "")


def _taken(members: Column, digit: Column) -> Column:
    """What a node learns of its run: its place and the others, left to right."""
    others = F.filter(members, lambda x: x["digit"] != digit)
    return F.struct(digit.cast("int").alias("at"), F.unhex(_concat_hex(others)).alias("others"))


def _swap(state: DataFrame, r: int, fanout: int) -> DataFrame:
    """One round within the groups; blocks of groups that are already one tree keep still."""
    span = fanout**r
    subtree = F.floor(F.col("block") / span)
    low = F.col("block") - subtree * span
    have = F.least(F.lit(span), F.col("blocks") - subtree * span)
    digit = subtree % fanout
    # The first subtree of a run lacks blocks only if it is alone.
    lanes = F.when(digit == 0, F.array(low)).otherwise(F.sequence(low, F.lit(span - 1).cast("long"), have))
    open_ = F.col("blocks") > span
    sent = (
        state.where(open_)
        .withColumns(
            {
                "_run": F.floor(subtree / fanout),
                "_low": low,
                "_digit": digit,
                "_lane": F.explode(lanes),
            }
        )
        .withColumn("_own", F.col("_lane") == F.col("_low"))
    )
    member = F.struct(
        F.col("_digit").alias("digit"),
        F.col("node"),
        F.when(F.col("_own"), F.struct("block", "blocks", "upper")).alias("own"),
    )
    met = sent.groupBy("group_no", "_run", "_lane").agg(F.array_sort(F.collect_list(member)).alias("m"))
    parent = F.unhex(F.sha2(_concat_hex(F.col("m")), 256))
    each = met.select(
        "group_no",
        parent.alias("node"),
        "m",
        F.explode(F.filter("m", lambda x: x["own"].isNotNull())).alias("x"),
    )
    moved = each.select(
        "group_no",
        F.col("x.own.block").alias("block"),
        F.col("x.own.blocks").alias("blocks"),
        "node",
        F.concat(F.col("x.own.upper"), F.array(_taken(F.col("m"), F.col("x.digit")))).alias("upper"),
    )
    return state.where(~open_).unionByName(moved)


def _swap_groups(state: DataFrame, r: int, fanout: int) -> DataFrame:
    """One round of the second tree: one block speaks for each subtree of groups."""
    span = fanout**r
    subtree = F.floor(F.col("group_no") / span)
    speakers = state.where((F.col("block") == 0) & (F.col("group_no") % span == 0))
    runs = speakers.groupBy(F.floor(subtree / fanout).alias("_run")).agg(
        F.array_sort(F.collect_list(F.struct((subtree % fanout).alias("digit"), "node"))).alias("m")
    )
    return (
        state.drop("node")
        .withColumn("_run", F.floor(subtree / fanout))
        .join(runs, "_run")
        .select(
            "group_no",
            "block",
            "blocks",
            F.unhex(F.sha2(_concat_hex(F.col("m")), 256)).alias("node"),
            "subroot",
            F.concat("upper", F.array(_taken(F.col("m"), subtree % fanout))).alias("upper"),
        )
    )


def manifest(
    docs: DataFrame,
    columns: tuple[str, ...] = COLUMNS,
    key: str = "doc_id",
    group: str = "source",
    seen: dict[str, Column] | None = None,
    fanout: int = FANOUT,
    block: int | None = None,
) -> DataFrame:
    """The manifest: one row per block of leaves, with their digests and the way up to the root.

    Leaves ascend by `key` within a `group` (rows without a key first, equal keys by digest);
    groups ascend by name, bytewise, rows without one as the first group. Equal rows are leaves of
    their own. `seen` replaces columns by the values that a reader received; their digests are kept
    beside the true ones, for `proofs` to fold. `block` must be a power of `fanout`; it changes
    no digest. A lone leaf, and a lone group, is its own root. An empty table has no rows.

    Columns: `group_no`, `block`, `blocks` (of the group), `doc_ids`, `leaves` and `seen` (digests,
    joined), `subroot`, `root`, `upper` (place and siblings in each run above the block).
    """
    as_seen = [(seen or {}).get(c, F.col(c)) for c in columns]
    leaves = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.col(group).alias("group"),
        leaf_hash([F.col(c) for c in columns]).alias("leaf"),
        leaf_hash(as_seen).alias("seen"),
    )
    leaves = global_rank(materialize(leaves, "merkle-leaves"), ["group", "doc_id", "leaf"], "merkle-ranks")
    groups = leaves.groupBy("group").agg(F.min("rank").alias("first"), F.count("*").alias("n"))
    groups = materialize(global_rank(groups, ["group"], "merkle-groups"), "merkle-groups")
    facts = groups.agg(F.count("*"), F.max("n"), F.sum("n")).first()
    if block is None:
        block = fanout**2 if (facts[2] or 0) < MANY_ROWS else fanout**3
    # One row per group: adaptive execution broadcasts it or splits the groups with many rows.
    placed = join_keys(leaves, groups.withColumnRenamed("rank", "group_no"), ["group"], "inner")
    place = F.col("rank") - F.col("first")
    placed = placed.select(
        "group_no",
        F.floor(place / block).alias("block"),
        F.ceil(F.col("n") / block).alias("blocks"),
        place.alias("place"),
        "doc_id",
        "leaf",
        "seen",
    )
    # A range never cuts a block in two, and blocks are small, so the ranges are even.
    packed = (
        placed.repartitionByRange("group_no", "block")
        .sortWithinPartitions("group_no", "block", "place")
        .mapInArrow(_blocks(block, fanout), BLOCK)
    )
    packed = materialize(packed, "merkle-blocks")
    none = F.array().cast("array<struct<at:int,others:binary>>")
    state = packed.select("group_no", "block", "blocks", "node", none.alias("upper"))
    most, r = -(-(facts[1] or 0) // block), 0
    while fanout**r < most:
        state = materialize(_swap(state, r, fanout), "merkle-round")
        r += 1
    state, r = state.withColumn("subroot", F.col("node")), 0
    while fanout**r < facts[0]:
        state = materialize(_swap_groups(state, r, fanout), "merkle-round")
        r += 1
    state = state.select("group_no", "block", "subroot", F.col("node").alias("root"), "upper")
    return packed.drop("node").join(state, ["group_no", "block"])


PROOF = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean, proof array<string>"
)
_PROOF = pa.schema(
    [
        ("doc_id", pa.int64()),
        *((c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")),
        ("verified", pa.bool_()),
        ("proof", pa.list_(pa.string())),
    ]
)


def _prove(fanout: int, depth: int, keep: bool):
    def block_proofs(row: dict):
        leaves = _hex(row["leaves"])
        tree = _climb(leaves, fanout, depth if row["blocks"] > 1 else None)
        upper = [(x["at"], b"".join(_hex(x["others"]))) for x in row["upper"]]
        # The siblings above a node, from the root down to the level above the leaves.
        above = [b"".join(others for _, others in upper)]
        runs = []
        for level in reversed(tree[:-1]):
            joined = [b"".join(level[i : i + fanout]) for i in range(0, len(level), fanout)]
            runs.append(joined)
            above = [
                joined[i // fanout][: i % fanout * 64]
                + joined[i // fanout][i % fanout * 64 + 64 :]
                + above[i // fanout]
                for i in range(len(level))
            ]
        runs.reverse()
        subroot, root = row["subroot"].hex(), row["root"].hex()
        for i, (leaf, seen) in enumerate(zip(leaves, _hex(row["seen"]))):
            node, at = seen, i
            for joined in runs:
                run, p = joined[at // fanout], at % fanout * 64
                node = _h(run[:p] + node + run[p + 64 :])
                at //= fanout
            for at, others in upper:
                node = _h(others[: at * 64] + node + others[at * 64 :])
            folded = node.decode()
            yield {
                "doc_id": row["doc_ids"][i],
                "leaf": leaf.decode(),
                "subroot": subroot,
                "root": root,
                "proof_sha256": hashlib.sha256(above[i]).hexdigest(),
                "folded_root": folded,
                "verified": folded == root,
                "proof": [above[i][k : k + 64].decode() for k in range(0, len(above[i]), 64)]
                if keep
                else None,
            }

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                (row,) = batch.slice(at, 1).to_pylist()
                yield pa.RecordBatch.from_pylist(list(block_proofs(row)), _PROOF)

    return run


def proofs(blocks: DataFrame, fanout: int = FANOUT, keep: bool = True) -> DataFrame:
    """One row per leaf of a manifest: its digest, both roots, its `proof` (siblings, level by level
    from the leaf to the root, left to right; null unless `keep`), the proof's digest, and the root
    folded from the digest that was seen and the true siblings."""
    largest = blocks.where("blocks > 1").agg(F.max(F.size("doc_ids"))).first()[0]
    return blocks.mapInArrow(_prove(fanout, _depth(largest or 1, fanout), keep), PROOF)


def tampered_text(key: str = "doc_id", every: int = 5) -> Column:
    """The text as received: where `every` divides the key's checksum, A-Z are lower-cased."""
    changed = F.crc32(F.col(key).cast("long").cast("string")) % every == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(changed, lower).otherwise(F.col("text"))
