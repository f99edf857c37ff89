"""Operator 13: repairing the structure of conversations at the least cost.

A conversation's rows, by turn, are to become an optional system turn and
alternating user and assistant turns.  Blank and repeated rows go, roles are
changed, turns deleted or inserted; of the cheapest edit histories the ASCII-least
is taken (``auditdp``).

On Spark: equal rows are counted first, so copies are one row with a number.
The rest is sorted by range and written with a place; all later work runs on
narrow rows (conversation, place, role's initial, faults, number), and texts
meet the kept places again at the end.  The places are dealt into parts of
``PART`` rows.  A conversation inside one part is solved there; one that touches
a part's border is solved from each state it may have on entering the part, and
the parts' tables are put together in order.  So a conversation of any length is
spread over many tasks; only what is one value per conversation by its nature is
made in one task: its history (a byte a row) and its checksum (streamed).

Cases: nulls in role and text are one space (a blank text, a role that must be
changed); rows of a null conversation are one conversation; rows of null turn
come first; rows of one turn are ordered by role, then text; a conversation
without rows has an empty history at no cost; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starledger.llm import auditdp as dp
from starledger.llm.common import ship_package, written

#: rows of one part
PART = 1 << 14
_SPACES = " \t\n\x0b\x0c\r"
ROLES = ("user", "assistant")


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text, copies: rows damaged by the checksum of
    ``conv_id:turn`` modulo 20 (0 drops, 1 empties, 2 takes the ends of
    sentences, 3 doubles, 4 makes it the user's); a null is one space."""
    def plain(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    case = F.crc32(F.concat(plain(conv_col), F.lit(":"), plain(turn_col))) % 20
    text = F.when(case == 1, F.lit("")).when(case == 2, F.translate(plain(text_col), ".!?", "")).otherwise(plain(text_col))
    return rows.where(case != 0).select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.when(case == 4, F.lit("user")).otherwise(plain(role_col)).alias("role"), text.alias("text"),
        F.when(case == 3, 2).otherwise(1).cast("long").alias("copies"))


@dataclass
class Repaired:
    #: conv_id, at, nth, edit, role, text: the repaired turns, in order of (at, nth)
    turns: DataFrame
    #: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit
    audits: DataFrame


def _laid(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies ``n``, in order, with a place
    ``at`` and what can be said of a row by itself."""
    distinct = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("n"))
    order = ["conv_id", "turn", "role", "text"]
    core = F.rtrim("text", F.lit(_SPACES))
    return written(
        distinct.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
        .withColumn("same", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
        .withColumn("blank", core == "").withColumn("open_end", ~F.substring(core, -1, 1).isin(".", "!", "?"))
        .withColumn("initial", F.substring("role", 1, 1)), "conversation-rows")


def _flagged(laid: DataFrame) -> DataFrame:
    """conv_id, at, turn, initial, blank, repeated, open_end, n.  A row repeats
    an earlier one if it isn't the first place of its role and text; joining on
    the place spreads even a text that a third of all rows hold."""
    narrow = laid.select("conv_id", "at", "turn", "initial", "blank", "same", "open_end", "n")
    first = narrow.groupBy("conv_id", "same").agg(F.min("at").alias("first")).select("first")
    return (narrow.join(first, F.col("at") == F.col("first"), "left")
            .select("conv_id", "at", "turn", "initial", "blank", F.col("first").isNull().alias("repeated"), "open_end", "n"))


def _counts(flagged: DataFrame) -> DataFrame:
    blank, repeated = F.col("blank"), F.col("repeated")
    copies = F.when(repeated, F.col("n")).otherwise(F.col("n") - 1)
    # distinct turns first, so that a turn of many rows is combined before it is dealt
    turns = (flagged.groupBy("conv_id", "turn").agg(
        F.sum(F.when(blank, F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(~blank, copies).otherwise(0)).alias("duplicate"),
        F.sum(F.when(~blank & ~repeated & F.col("open_end"), 1).otherwise(0)).alias("truncated")))
    return turns.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated")])


_LEGAL = {"su", "ua", "au"}


@lru_cache(maxsize=1 << 14)
def _whole(rows: tuple) -> tuple[int, str, int]:
    cost, text, _ = dp.least(dp.histories(rows, dp.E))
    return cost, text, _illegal(rows)


def _illegal(rows: tuple) -> int:
    """Neighbours, copies included, whose initials may not follow each other."""
    between = sum(a[0] + b[0] not in _LEGAL for a, b in zip(rows, rows[1:], strict=False))
    return between + sum(r[3] for r in rows)


def _runs(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Where values change in a sorted column, nulls equal, and the end."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    codes = pc.dictionary_encode(column, null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return np.r_[0, np.flatnonzero(codes[1:] != codes[:-1]) + 1, len(codes)].astype(np.int64)


_RUN = ["part", "first_at", "border", "state", "last", "cost", "history", "illegal", "left", "right"]


def _solved(flagged: DataFrame) -> DataFrame:
    """Per conversation within a part (a run): one row with its cheapest whole
    history, or, if it touches a border, one row per pair of states."""
    kind = flagged.schema["conv_id"].dataType.simpleString()

    def solve(t: pa.Table) -> pa.Table:
        t = t.sort_by("at")
        part, cuts = t.column("part")[0].as_py(), _runs(t.column("conv_id")).tolist()
        at = t.column("at").to_pylist()
        gone = pc.or_(t.column("blank"), t.column("repeated"))
        rows = list(zip(t.column("initial").to_pylist(), gone.to_pylist(), t.column("open_end").to_pylist(),
                        [n - 1 for n in t.column("n").to_pylist()], strict=True))
        out, index = [], []
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            run = tuple(rows[s:e])
            if s > 0 and e < len(rows):
                cost, text, illegal = _whole(run) if len(run) <= 64 else _whole.__wrapped__(run)
                found = [(False, dp.E, None, cost, text, illegal)]
            else:
                illegal = _illegal(run)
                found = [(True, state, last, *end, illegal) for state in range(4)
                         for last, end in enumerate(dp.histories(run, state)) if end is not None]
            out += [(part, at[s], *f, run[0][0], run[-1][0]) for f in found]
            index += [s] * len(found)
        columns = [t.column("conv_id").take(pa.array(index, pa.int64()))]
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(),
                 pa.string())
        columns += [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.Table.from_arrays(columns, ["conv_id", *_RUN])

    return flagged.groupBy("part").applyInArrow(
        solve, f"conv_id {kind}, part long, first_at long, border boolean, state int, last int, cost long, history string, "
               "illegal long, left string, right string")


def _put_together(solved: DataFrame) -> DataFrame:
    """The runs at borders, one conversation after the other in order: the
    chosen state and history of each run; a conversation's last run also
    carries its cost, illegal neighbours and whole history."""
    kind = solved.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "part", "first_at", "state", "history", "cost", "illegal", "audit"]

    def ended(id_type: pa.DataType, conv, runs: list, chain: dp.Chain, illegal: int) -> pa.RecordBatch:
        cost, parts = chain.end()
        n = len(parts)
        texts = [p[3] for p in parts]
        return pa.RecordBatch.from_arrays(
            [pa.array([conv] * n, id_type), pa.array([r[0] for r in runs], pa.int64()),
             pa.array([r[1] for r in runs], pa.int64()), pa.array([p[1] for p in parts], pa.int32()), pa.array(texts, pa.string()),
             pa.array([None] * (n - 1) + [cost], pa.int64()), pa.array([None] * (n - 1) + [illegal], pa.int64()),
             pa.array([None] * (n - 1) + ["".join(texts)], pa.string())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, runs, chain, illegal, right, table = None, [], None, 0, "", {}
        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for r in batch.to_pylist():
                key = (r["part"], r["first_at"])
                if not runs or r["conv_id"] != conv or key != runs[-1]:
                    if table:
                        chain.add(len(runs) - 1, table)
                        table = {}
                    if not runs or r["conv_id"] != conv:
                        if runs:
                            yield ended(id_type, conv, runs, chain, illegal)
                        conv, runs, chain, illegal = r["conv_id"], [], dp.Chain(), 0
                    elif right + r["left"] not in _LEGAL:
                        illegal += 1
                    runs.append(key)
                    illegal += r["illegal"]
                    right = r["right"]
                table[r["state"], r["last"]] = (r["cost"], r["history"])
        if runs:
            chain.add(len(runs) - 1, table)
            yield ended(id_type, conv, runs, chain, illegal)

    border = solved.where("border").repartition("conv_id").sortWithinPartitions("conv_id", "part", "state", "last")
    return border.mapInArrow(run, f"conv_id {kind}, part long, first_at long, state int, history string, cost long, "
                                  "illegal long, audit string")


def _kept(flagged: DataFrame, chosen: DataFrame) -> DataFrame:
    """at, nth, edit, role: the turns that stay (nth 1, at their place), and
    those inserted before (0) or behind (2 on) the row at a place."""

    def walk(rows: pa.Table, runs: pa.Table) -> pa.Table:
        rows, runs = rows.sort_by("at"), runs.sort_by("first_at")
        at, n, initial = (rows.column(c).to_pylist() for c in ("at", "n", "initial"))
        out, i = [], 0
        for state, history in zip(runs.column("state").to_pylist(), runs.column("history").to_pylist(), strict=True):
            k, last, before = 0, None, 0
            while k < len(history):
                edit = history[k]
                k += 1
                if edit == "I":
                    # behind the last row of the run, or before the next
                    following = "I" * (len(history) - k) != history[k:]
                    place, nth = (at[i], before - 2) if following else (last, 2 + before)
                    before += 1
                    out.append((place, nth, "I", ROLES[dp.NEXT[state] - dp.U]))
                    state = dp.NEXT[state]
                    continue
                if edit == "K":
                    out.append((at[i], 1, "K", None))
                    state = dp.AFTER[initial[i]][state]
                elif edit == "R":
                    out.append((at[i], 1, "R", ROLES[dp.NEXT[state] - dp.U]))
                    state = dp.NEXT[state]
                k += n[i] - 1
                last, before = at[i], 0
                i += 1
        kinds = (pa.int64(), pa.int32(), pa.string(), pa.string())
        columns = list(zip(*out, strict=True)) or [[]] * 4
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["at", "nth", "edit", "new_role"])

    return flagged.select("part", "at", "n", "initial").groupBy("part").cogroup(
        chosen.select(F.col("part").alias("of"), "first_at", "state", "history").groupBy("of")).applyInArrow(
            walk, "at long, nth int, edit string, new_role string")


def repair(rows: DataFrame) -> Repaired:
    """``rows``: conv_id, turn, role, text, copies (of each row, one long)."""
    ship_package(rows.sparkSession)
    laid = _laid(rows)
    # places of one written file follow each other: 33 low bits number its rows
    part = F.shiftleft(F.shiftright("at", 33), 20) + F.floor(F.col("at").bitwiseAND((1 << 33) - 1) / PART)
    flagged = written(_flagged(laid).withColumn("part", part), "conversation-flags")
    solved = written(_solved(flagged), "conversation-runs")
    together = written(_put_together(solved), "conversation-chains")
    inner = solved.where("NOT border").select("conv_id", "part", "first_at", "state", "history", "cost", "illegal",
                                              F.col("history").alias("audit"))
    chosen = inner.unionByName(together)
    kept = written(_kept(flagged, chosen), "conversation-turns")
    inserted = F.col("edit") == "I"
    turns = kept.join(laid.select("conv_id", "at", "role", "text"), "at").select(
        "conv_id", "at", "nth", "edit", F.coalesce("new_role", "role").alias("role"),
        F.when(inserted, "").otherwise(F.col("text")).alias("text"))
    audits = (chosen.where("cost IS NOT NULL").select("conv_id", "illegal", "cost", "audit").alias("c")
              .join(_counts(flagged).alias("f"), F.col("c.conv_id").eqNullSafe(F.col("f.conv_id")))
              .select("c.conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"))
    return Repaired(turns, audits)


def checksums(turns: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of ``role:text`` lines.  The checksum takes its
    input in order, so a conversation's turns stream through one task."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest = None, None
        for batch in batches:
            ids, lines = batch.column("conv_id"), batch.column("line")
            cuts = _runs(ids).tolist()
            done = []
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                own = ids[s].as_py()
                text = "\n".join(lines.slice(s, e - s).to_pylist()).encode()
                if digest is not None and own == conv:
                    digest.update(b"\n" + text)
                    continue
                if digest is not None:
                    done.append((conv, digest.hexdigest()))
                conv, digest = own, hashlib.sha256(text)
            yield out(done, ids.type)
        if digest is not None:
            yield out([(conv, digest.hexdigest())], ids.type)

    def out(done: list, id_type: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], id_type), pa.array([d[1] for d in done], pa.string())],
                                          ["conv_id", "repaired_sha256"])

    lines = turns.select("conv_id", "at", "nth", F.concat("role", F.lit(":"), "text").alias("line"))
    return lines.repartition("conv_id").sortWithinPartitions("conv_id", "at", "nth").mapInArrow(
        run, f"conv_id {kind}, repaired_sha256 string")


def digests(conversations: DataFrame) -> DataFrame:
    """Damage and repair: a row per conversation of the input."""
    ship_package(conversations.sparkSession)
    repaired = repair(damaged(conversations))
    every = conversations.select("conv_id").distinct().alias("e")
    audits, sums = repaired.audits.alias("a"), checksums(repaired.turns).alias("s")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return (every.join(audits, F.col("e.conv_id").eqNullSafe(F.col("a.conv_id")), "left")
            .join(sums, F.col("e.conv_id").eqNullSafe(F.col("s.conv_id")), "left")
            .select("e.conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")))
