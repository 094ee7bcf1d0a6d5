"""Repair of conversation structure: the cheapest edits after which roles alternate, by IDA*.

A conversation is well formed if the initials of its roles are `(s?(ua)+)?`. Its rows are kept (K),
given another role (R), deleted (D), or rows are inserted (I). The search goes depth first through
the edits in ASCII order, under a bound on the cost that rises to the least cost that exceeded it.
A table holds, for each state (row, role before), the least further cost that a failed search has
proved, so a state is entered again only with more to spend. The first path that is accepted under
the first bound that has one is a cheapest, and of those the least in ASCII order.

The search sees a row as one character (initial and fault), and a task remembers the edits of
strings it has seen. Conversations longer than `segment` rows are cut: each segment is searched
from each state it can be entered in to each it can be left in, and the costs of the segments are
added up along the conversation, so that no task searches a whole long conversation.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from serpscope.llm.common import global_rank
from serpscope.operators.ordered import join_keys
from serpscope.session import materialize

#: Rows above which a conversation is searched in segments.
SEGMENT = 128
#: What edits cost; a truncated row that is not deleted costs TRUNCATED on top.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

#: States: nothing yet, after s, after u, after a. What an initial leads to, from each state.
STATES = 4
_NEXT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
#: The role that may be inserted or given in each state, and the state after it.
_FREE = (2, 2, 3, 2)
_ROLE = {2: "user", 3: "assistant"}
ACCEPTING = frozenset((0, 3))


@lru_cache(maxsize=200_000)
def search(rows: str, entry: int = 0, exits: frozenset = ACCEPTING, last: bool = True):
    """Cost and edits of the cheapest way from `entry` through all rows to one of `exits`.

    A row is its initial (`s`, `u`, `a`, or `x` for any other) in lower case, in upper case if it is
    truncated; `-` must be deleted. Unless `last`, nothing is inserted after the last row. None if
    there is no way.
    """
    n = len(rows)
    # Cost that remains at the least: faults must be paid for.
    least = np.zeros(n + 1, dtype=np.int64)
    for i in range(n - 1, -1, -1):
        fault = DELETE if rows[i] == "-" else min(DELETE, TRUNCATED) if rows[i].isupper() else 0
        least[i] = least[i + 1] + fault
    least = least.tolist()
    reachable = {0: {0, 2, 3}, 1: {1, 2, 3}, 2: {2, 3}, 3: {2, 3}}[entry]
    if entry == 0 and "s" in rows.lower():
        reachable = {0, 1, 2, 3}
    if not last and n == 0:
        reachable = {entry}
    if not reachable & exits:
        return None
    endless = 1 << 60
    proved: dict[tuple[int, int], int] = {}

    def bound_of(i: int, q: int) -> int:
        return proved.get((i, q), least[i])

    def moves(i: int, q: int):
        """(edit, cost, row, state) in ASCII order of edits."""
        found = []
        if i < n:
            found.append(("D", DELETE, i + 1, q))
        if i < n or last:
            found.append(("I", INSERT, i, _FREE[q]))
        if i < n and rows[i] != "-":
            more = TRUNCATED if rows[i].isupper() else 0
            to = _NEXT.get(rows[i].lower(), (None,) * STATES)[q]
            if to is not None:
                found.append(("K", KEEP + more, i + 1, to))
            found.append(("R", REROLE + more, i + 1, _FREE[q]))
        return found

    bound = bound_of(0, entry)
    while True:
        path, spent = [], 0
        stack = [(0, entry, iter(moves(0, entry)), [endless], 0)]
        if n == 0 and entry in exits:
            return 0, ""
        while stack:
            i, q, rest, need, paid = stack[-1]
            for edit, cost, j, p in rest:
                ahead = cost + bound_of(j, p)
                if spent + ahead > bound:
                    need[0] = min(need[0], ahead)
                    continue
                spent += cost
                path.append(edit)
                if j == n and p in exits:
                    return spent, "".join(path)
                stack.append((j, p, iter(moves(j, p)), [endless], cost))
                break
            else:
                # All failed: what this state needs at least is known now.
                proved[i, q] = max(bound_of(i, q), need[0])
                stack.pop()
                if stack:
                    path.pop()
                    spent -= paid
                    above = stack[-1][3]
                    above[0] = min(above[0], paid + proved[i, q])
        bound = bound_of(0, entry)


def damage_kind() -> Column:
    """Which fault a row gets: by the checksum of conversation and turn, null being one space."""
    key = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    return F.crc32(F.concat_ws(":", *key)) % 20


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults put in: dropped (0), emptied (1), without ends (2), repeated (3), given the
    role `user` (4). Of every 20 kinds, the others leave a row as it is."""
    text = F.coalesce("text", F.lit(" "))
    return rows.select(
        "conv_id",
        "turn",
        F.when(damage_kind() == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(damage_kind() == 1, "")
        .when(damage_kind() == 2, F.translate(text, ".!?", ""))
        .otherwise(text)
        .alias("text"),
        F.explode(
            F.when(damage_kind() == 0, F.array().cast("array<int>"))
            .when(damage_kind() == 3, F.array(F.lit(0), F.lit(1)))
            .otherwise(F.array(F.lit(0)))
        ).alias("copy"),
    ).drop("copy")


def _code(role: str, text: str, seen: set[bytes]) -> tuple[str, str | None]:
    """A row's character for the search, and its first fault."""
    end = text.rstrip(" \t\n\v\f\r")
    if not end:
        return "-", "blank"
    own = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "replace"), digest_size=16).digest()
    if own in seen:
        return "-", "duplicate"
    seen.add(own)
    initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
    if end[-1] not in ".!?":
        return initial.upper(), "truncated"
    return initial, None


def _lines(edits, rows, q: int):
    """Lines `role:text` of the repaired rows, from a state on; rows are read as they are needed."""
    rows = iter(rows)
    for edit in edits:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit == "K":
            q = _NEXT[role[0]][q]
            yield f"{role}:{text}"
        else:
            q = _FREE[q]
            yield f"{_ROLE[q]}:{text}"


REPAIRED = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string, repaired string"
)
_REPAIRED = pa.schema(
    [
        *((c, pa.int64()) for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal")),
        ("cost", pa.int64()),
        *((c, pa.string()) for c in ("audit", "repaired_sha256", "repaired")),
    ]
)
#: Results that are handed on together.
TOGETHER = 500


def _legal(before: str, after: str) -> bool:
    return before[:1] + after[:1] in ("su", "ua", "au")


def _whole(keep: bool):
    """Repairs conversations whose sorted rows follow each other."""

    def repaired(conv_id, rows: list[tuple]) -> dict:
        seen: set[bytes] = set()
        codes = [_code(role, text, seen) for _, role, text in rows]
        turns = {t for t, _, _ in rows if t is not None}
        cost, audit = search("".join(c for c, _ in codes))
        text = "\n".join(_lines(audit, ((r, t) for _, r, t in rows), 0))
        faults = [f for _, f in codes]
        return {
            "conv_id": conv_id,
            "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
            "illegal": sum(not _legal(a[1], b[1]) for a, b in zip(rows, rows[1:])),
            "cost": cost,
            "audit": audit,
            "repaired_sha256": hashlib.sha256(text.encode("utf-8", "replace")).hexdigest(),
            "repaired": text if keep else None,
        }

    def rows(batches):
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text")))

    def run(batches):
        out = []
        for conv_id, own in groupby(rows(batches), key=lambda r: r[0]):
            out.append(repaired(conv_id, [r[1:] for r in own]))
            if len(out) >= TOGETHER:
                yield pa.RecordBatch.from_pylist(out, _REPAIRED)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, _REPAIRED)

    return run


# --- long conversations ----------------------------------------------------------------


def _character() -> Column:
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    whole = F.col("end").isin(".", "!", "?")
    return F.when(F.col("fault").isin("blank", "duplicate"), "-").otherwise(
        F.when(whole, initial).otherwise(F.upper(initial))
    )


def _fault() -> Column:
    end = F.col("end")
    return (
        F.when(end == "", "blank")
        .when(F.col("again"), "duplicate")
        .when(~end.isin(".", "!", "?"), "truncated")
    )


WAYS = "conv_id long, segment long, entry int, exit int, cost long, place int, edits string"


def _ways(batches):
    """Cheapest edits of a segment from each state to each; `place` orders those of one entry."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            last = row["segment"] + 1 == row["segments"]
            for entry in range(STATES) if row["segment"] else [0]:
                ways = {q: search(row["codes"], entry, frozenset([q]), last) for q in range(STATES)}
                found = sorted((w[1], q, w[0]) for q, w in ways.items() if w)
                out += [
                    (row["conv_id"], row["segment"], entry, q, cost, place, edits)
                    for place, (edits, q, cost) in enumerate(found)
                ]
        columns = list(zip(*out)) or [()] * 7
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(c, kind)
                for c, kind in zip(
                    columns,
                    (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.string()),
                )
            ],
            ["conv_id", "segment", "entry", "exit", "cost", "place", "edits"],
        )


def _chain(ways: pd.DataFrame) -> pd.DataFrame:
    """The cheapest chain of one conversation's segments, by costs and order alone.

    Edits up to the end of a segment never begin other edits up to there: each ends with a row that
    is not inserted. So chains compare as the first segments in which they differ.
    """
    ways = ways.sort_values(["segment", "entry", "exit"])
    last = int(ways["segment"].max())
    reached: dict[int, tuple] = {0: (0, 0)}
    came: list[dict[int, int]] = []
    for number, own in ways.groupby("segment"):
        best: dict[int, tuple] = {}
        for w in own.itertuples():
            if w.entry in reached and (number < last or w.exit in ACCEPTING):
                cost, rank = reached[w.entry]
                now = (cost + w.cost, rank, w.place, w.entry)
                best[w.exit] = min(best.get(w.exit, now), now)
        order = sorted(best, key=lambda q: best[q][1:3])
        reached = {q: (best[q][0], order.index(q)) for q in best}
        came.append({q: b[3] for q, b in best.items()})
    at = min(reached, key=reached.get)
    total, out = reached[at][0], []
    for number in range(last, -1, -1):
        out.append((number, came[number][at], at, total))
        at = came[number][at]
    chain = pd.DataFrame(out, columns=["segment", "entry", "exit", "cost"])
    chain.insert(0, "conv_id", ways["conv_id"].iloc[0])
    return chain


_DIGEST = pa.schema([f for f in _REPAIRED if f.name in ("conv_id", "repaired_sha256", "repaired")])


def _digests(keep: bool):
    """Checksums over sorted rows; each segment begins with its edits and the state before it."""

    def rows(batches):
        names = ("conv_id", "segment", "entry", "edits", "role", "text")
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in names))

    def run(batches):
        for conv_id, own in groupby(rows(batches), key=lambda r: r[0]):
            digest, gap, kept = hashlib.sha256(), "", []
            for _, segment in groupby(own, key=lambda r: r[1]):
                _, _, entry, edits, _, _ = next(segment)
                for line in _lines(edits, (r[4:] for r in segment), entry):
                    digest.update((gap + line).encode("utf-8", "replace"))
                    if keep:
                        kept.append(line)
                    gap = "\n"
            found = [conv_id, digest.hexdigest(), "\n".join(kept) if keep else None]
            yield pa.RecordBatch.from_pydict({f.name: [v] for f, v in zip(_DIGEST, found)}, _DIGEST)

    return run


def _long(rows: DataFrame, segment: int, keep: bool) -> DataFrame:
    """Long conversations in segments.

    Only the checksum takes a conversation's rows through one task, as SHA-256 has to; that task
    holds a batch of rows at a time. All else meets in segments, or as one row per segment.
    """
    key = ["conv_id"]
    ranked = global_rank(rows, ["conv_id", "turn", "role", "text"], "repair-rows")
    facts = ranked.groupBy(*key).agg(
        F.min("rank").alias("start"),
        F.count("*").alias("n"),
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"),
    )
    facts = materialize(facts, "repair-facts")
    placed = join_keys(ranked, facts.drop("gaps"), key, "inner").select(
        *key,
        "rank",
        F.floor((F.col("rank") - F.col("start")) / segment).alias("segment"),
        F.ceil(F.col("n") / segment).alias("segments"),
        "role",
        F.substring(F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", ""), -1, 1).alias("end"),
        F.sha2("text", 256).alias("digest"),
        "text",
    )
    first = placed.groupBy(*key, "role", "digest").agg(F.min("rank").alias("rank"))
    first = first.select("rank", F.lit(False).alias("again"))
    coded = (
        placed.drop("text", "digest")
        .join(first, "rank", "left")
        .withColumn("again", F.coalesce("again", F.lit(True)))
        .withColumn("fault", _fault())
        .withColumn("code", _character())
        .withColumn("initial", F.substring("role", 1, 1))
    )
    # At most `segment` rows meet.
    row = F.struct("rank", "code", "initial")
    segments = coded.groupBy(*key, "segment", "segments").agg(
        F.array_sort(F.collect_list(row)).alias("rows"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
    )
    pairs = F.zip_with(
        F.slice("initials", 1, F.size("initials") - 1),
        F.slice("initials", 2, F.size("initials")),
        lambda a, b: F.concat(a, b),
    )
    segments = segments.select(
        *key,
        "segment",
        "segments",
        "blank",
        "duplicate",
        "truncated",
        F.array_join("rows.code", "").alias("codes"),
        F.col("rows.initial").alias("initials"),
    ).withColumn("illegal", F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au"))))
    segments = materialize(segments, "repair-segments")
    # So many partitions in any case: searches take long for their few bytes.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ways = segments.select(*key, "segment", "segments", "codes").repartition(tasks, *key, "segment")
    ways = materialize(ways.mapInArrow(_ways, WAYS), "repair-ways")
    chain = ways.drop("edits").groupBy(*key).applyInPandas(
        _chain, "conv_id long, segment long, entry int, exit int, cost long"
    )
    chosen = join_keys(
        chain, ways.drop("cost", "place"), [*key, "segment", "entry", "exit"], "inner"
    )
    chosen = materialize(chosen, "repair-edits")
    none = F.lit(None).cast("string")
    heads = chosen.select(
        *key, "segment", F.lit(-1).cast("long").alias("rank"), "entry", "edits", none.alias("role"), none.alias("text")
    )
    texts = placed.select(
        *key, "segment", "rank", F.lit(None).cast("int").alias("entry"), none.alias("edits"), "role", "text"
    )
    digests = (
        heads.unionByName(texts)
        .repartition(*key)
        .sortWithinPartitions(*key, "segment", "rank")
        .mapInArrow(_digests(keep), "conv_id long, repaired_sha256 string, repaired string")
    )
    audits = chosen.groupBy(*key).agg(
        F.max("cost").alias("cost"),
        F.array_join(F.array_sort(F.collect_list(F.struct("segment", "edits"))).getField("edits"), "").alias(
            "audit"
        ),
    )
    # A row per segment; borders between segments are pairs too.
    border = Window.partitionBy(*key).orderBy("segment")
    across = F.concat(F.lag(F.element_at("initials", -1)).over(border), F.element_at("initials", 1))
    counts = (
        segments.withColumn("across", across)
        .groupBy(*key)
        .agg(
            *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")],
            (F.sum("illegal") + F.count_if(~F.col("across").isin("su", "ua", "au"))).alias("illegal"),
        )
    )
    result = facts.select(*key, F.coalesce("gaps", F.lit(0)).alias("gaps"))
    for part in (counts, audits, digests):
        result = join_keys(result, part, key, "inner")
    return result.select([f.name for f in _REPAIRED])


def repair(rows: DataFrame, segment: int = SEGMENT, keep: bool = True) -> DataFrame:
    """Faults of each conversation, its cheapest edits, and the repaired conversation.

    rows: `conv_id`, `turn`, `role`, `text`; further columns are ignored. Rows go by turn, those
    without one first; rows of one turn by role and text. A null role or text is one space; rows
    without a conversation's id form one. Repeated rows are duplicates. An empty table has no
    conversations.

    Per conversation: `gaps` in its turns, rows that are `blank`, `duplicate` (role and text stand
    in an earlier row) or `truncated`, each by its first fault, `illegal` neighbours, the `cost` and
    `audit` of the edits, and the `repaired` lines (null unless `keep`) with their checksum.
    """
    space = F.lit(" ")
    rows = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
    )
    sizes = rows.groupBy("conv_id").agg(F.count("*").alias("n"))
    long = materialize(sizes.where(F.col("n") > segment).select("conv_id"), "repair-long")
    short, rest = rows, None
    if not long.isEmpty():
        short = join_keys(rows, long, ["conv_id"], "left_anti")
        rest = _long(join_keys(rows, long, ["conv_id"], "left_semi"), segment, keep)
    result = (
        short.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInArrow(_whole(keep), REPAIRED)
    )
    return result if rest is None else result.unionByName(rest)


def repair_damaged(rows: DataFrame, segment: int = SEGMENT, keep: bool = False) -> DataFrame:
    """Damages the rows, repairs them, and gives conversations that lost all rows as empty ones."""
    # The conversations without a row after damage are found by counts, before anything is dropped.
    weight = F.when(damage_kind() == 0, 0).otherwise(1)
    gone = (
        rows.groupBy(F.col("conv_id").cast("long").alias("conv_id"))
        .agg(F.sum(weight).alias("n"))
        .where("n = 0")
    )
    zeros = [F.lit(0).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = [
        F.lit("").alias("audit"),
        F.sha2(F.lit(""), 256).alias("repaired_sha256"),
        F.lit("" if keep else None).cast("string").alias("repaired"),
    ]
    return repair(damaged(rows), segment, keep).unionByName(gone.select("conv_id", *zeros, *nothing))
