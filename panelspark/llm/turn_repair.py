"""Conversation structure repair by lightest derivations.

A repaired conversation has the role initials ``(s?(ua)+)?``. An item ``(i, q)`` says: the rows from ``i`` on can be
edited so that the pattern, entered in state ``q``, is completed. Every edit is a deduction that puts one letter before
the audit of the item it starts from and adds its cost. An agenda pops items in the order (cost, rows consumed,
audit) and finalises each when first popped, until the goal items at row 0 are final. A Keep may cost nothing, but it
consumes a row, so in that order every deduction is worth more than what it starts from, and prepending a letter
keeps the order of audits: the functions are monotone and superior.

Scale: rows are numbered by one range sort, and a conversation is cut into blocks of ``BLOCK`` rows, so a hot one
spreads over many tasks. A block is derived for every pair of states at its two ends. Blocks are then chained by a
binary deduction (costs add, audits join): two derivations of one block between the same states that cost the same
never begin with each other, since a longer one would hold an Insert more, so joining keeps their order too. The
chain of a conversation holds no texts, four audits at a time. The texts meet the edits again in a join.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import tokens
from panelspark.operators.ranking import rank_rows
from panelspark.runtime import materialize

BLOCK = 512
KEEP, REROLE, DELETE, INSERT, UNMENDED = 0, 1, 2, 5, 5
# States of the pattern: nothing yet, after s, after u, after a. NEXT[state] gives the state after a role initial.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
START, ACCEPTING = 0, (0, 3)
ROLE = {"u": "user", "a": "assistant"}
# A row is a letter: its role initial (x: none of s, u, a), upper case where its text is truncated; ``-`` must be deleted.
GONE = "-"


def derive(rows: str, entries: tuple[int, ...], axioms: tuple[int, ...]) -> dict[int, tuple[int, str]]:
    """Lightest ``(cost, audit)`` for each of ``entries``, so that ``rows`` end in one of ``axioms``; impossible ones lack."""
    n = len(rows)
    agenda = [(0, 0, "", n, q) for q in axioms]
    heapq.heapify(agenda)
    final: dict[tuple[int, int], tuple[int, str]] = {}
    goals = {(0, q) for q in entries}
    while agenda and goals:
        cost, done, audit, i, after = heapq.heappop(agenda)
        if (i, after) in final:
            continue
        final[i, after] = (cost, audit)
        goals.discard((i, after))
        before = {symbol: [q for q in range(4) if NEXT[q].get(symbol) == after] for symbol in "sua"}
        for symbol in "ua":
            for q in before[symbol]:
                heapq.heappush(agenda, (cost + INSERT, done, "I" + audit, i, q))
        if not i:
            continue
        row = rows[i - 1]
        heapq.heappush(agenda, (cost + DELETE, done + 1, "D" + audit, i - 1, after))
        if row == GONE:
            continue
        left = cost + (UNMENDED if row.isupper() else 0)
        for q in before.get(row.lower(), ()):
            heapq.heappush(agenda, (left + KEEP, done + 1, "K" + audit, i - 1, q))
        for symbol in "ua":
            for q in before[symbol]:
                heapq.heappush(agenda, (left + REROLE, done + 1, "R" + audit, i - 1, q))
    return {q: final[0, q] for q in entries if (0, q) in final}


@lru_cache(maxsize=50_000)
def block_items(rows: str, first: bool, last: bool) -> dict[tuple[int, int], tuple[int, str]]:
    """Lightest derivation of a block by its states at both ends; the last block ends in ``START``, standing for acceptance."""
    entries = (START,) if first else (0, 1, 2, 3)
    if last:
        return {(q, START): item for q, item in derive(rows, entries, ACCEPTING).items()}
    return {(q, end): item for end in range(4) for q, item in derive(rows, entries, (end,)).items()}


def chain_blocks(blocks: list[str]) -> tuple[int, list[tuple[int, str]]]:
    """Cost of a conversation given as blocks, and per block the state before it and its audit."""
    best: dict[int, tuple] = {START: (0, "", None)}  # cost, audit, and the chain of blocks from the last one back
    for k, rows in enumerate(blocks):
        found: dict[int, tuple] = {}
        for (q, end), (cost, audit) in block_items(rows, k == 0, k == len(blocks) - 1).items():
            if q in best and (end not in found or (best[q][0] + cost, best[q][1] + audit) < found[end][:2]):
                found[end] = (best[q][0] + cost, best[q][1] + audit, (best[q][2], q, audit))
        best = found
    link, chosen = best[START][2], []
    while link:
        chosen.append(link[1:])
        link = link[0]
    return best[START][0], chosen[::-1]


def _illegal(rows: str) -> int:
    """Adjacent rows whose role initials are not su, ua or au."""
    low = rows.lower()
    return sum(low[i:i + 2] not in ("su", "ua", "au") for i in range(len(low) - 1))


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation, whose blocks come in order, a row with cost and illegal pairs, then a row per edit."""
    schema = pa.schema([("key", pa.string()), ("at", pa.int64()), ("edit", pa.string()), ("new_role", pa.string()),
                        ("row", pa.int64()), ("cost", pa.int64()), ("illegal", pa.int64())])

    def edited(key: str, first_row: int, blocks: list[str], initials: list[str]) -> Iterator[tuple]:
        cost, chosen = chain_blocks(blocks)
        pairs = sum(map(_illegal, initials)) + sum(_illegal(a[-1] + b[0]) for a, b in zip(initials, initials[1:]))
        yield key, -1, None, None, None, cost, pairs
        at, row = 0, first_row
        for rows, (state, audit) in zip(blocks, chosen, strict=True):
            place = 0
            for edit in audit:
                new, source = None, None
                if edit != "I":
                    source, row, place = row, row + 1, place + 1
                if edit == "K":
                    state = NEXT[state][rows[place - 1].lower()]
                elif edit in "RI":
                    new = "a" if "a" in NEXT[state] else "u"
                    state = NEXT[state][new]
                yield key, at, edit, ROLE.get(new), source, None, None
                at += 1

    def run() -> Iterator[tuple]:
        key, first_row, blocks, initials = None, 0, [], []
        for batch in batches:
            for r in batch.to_pylist():
                if r["key"] != key:
                    if blocks:
                        yield from edited(key, first_row, blocks, initials)
                    key, first_row, blocks, initials = r["key"], r["first_row"], [], []
                blocks.append(r["codes"])
                initials.append(r["initials"])
        if blocks:
            yield from edited(key, first_row, blocks, initials)

    rows = []
    for row in run():
        rows.append(row)
        if len(rows) == 4096:
            yield tokens.batch(schema, rows)
            rows = []
    yield tokens.batch(schema, rows)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and hash of the repaired rows of each conversation, whose edits come in order."""
    schema = pa.schema([("key", pa.string()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    key, audit, sha, out = None, [], hashlib.sha256(), []
    for batch in batches:
        for r in batch.to_pylist():
            if r["key"] != key:
                if key is not None:
                    out.append((key, "".join(audit), sha.hexdigest()))
                key, audit, sha, empty = r["key"], [], hashlib.sha256(), True
            audit.append(r["edit"])
            if r["edit"] != "D":
                line = f"{r['role']}:{r['text']}".encode("utf-8", "surrogatepass")
                sha.update(line if empty else b"\n" + line)
                empty = False
        yield tokens.batch(schema, out)
        out = []
    if key is not None:
        yield tokens.batch(schema, [(key, "".join(audit), sha.hexdigest())])


def name_of(column: str):
    """Identifier as text; null is one space."""
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``turn``, ``role`` and ``text`` with faults put in by a hash of ``conv_id:turn``; nulls read as one space.

    Of 20 rows one is dropped, one emptied, one loses its ``[.!?]``, one is repeated and one becomes the user's.
    """
    h = F.crc32(F.concat(name_of(conv_id), F.lit(":"), name_of(turn)).cast("binary")) % 20
    said = F.coalesce(F.col(text).cast("string"), F.lit(" "))
    copies = F.when(h == 0, F.array().cast("array<int>")).when(h == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return turns.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.when(h == 4, F.lit("user")).otherwise(F.coalesce(F.col(role).cast("string"), F.lit(" "))).alias("role"),
        F.when(h == 1, F.lit("")).when(h == 2, F.regexp_replace(said, "[.!?]", "")).otherwise(said).alias("text"),
        copies.alias("copies")).withColumn("copies", F.explode("copies")).drop("copies")


class Repair(NamedTuple):
    """``edits``: key, at, edit, row, role and text, in the order ``at`` of each conversation (D rows keep their own role
    and text, all others are the repaired conversation); ``conversations``: one row each with counts, cost and key."""

    edits: DataFrame
    conversations: DataFrame


def repair(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           block: int = BLOCK) -> Repair:
    """Cheapest edits that give every conversation the role initials ``(s?(ua)+)?``.

    Rows go by ``turn`` (null first), then role and text. The first fault of a row counts: blank (no character but
    ``[\\x20\\x09-\\x0D]``), duplicate (role and text seen earlier), truncated (the last such character is not ``.``,
    ``!`` or ``?``). Keep costs 0, Rerole to user or assistant 1, Delete 2 (a must for blank and duplicate rows), Insert of an
    empty user or assistant text 5; a truncated row that stays adds 5. Of equally cheap edits those with the ASCII-least
    string of initials are taken. A null role or text reads as one space; a null ``conv_id`` is a conversation like any
    other, null turns are not counted in ``gaps``. Rows that are equal throughout are interchangeable; all but the first
    are duplicates. An empty table gives empty results; other columns are ignored.
    """
    space = F.lit(" ")
    rows = turns.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                        F.coalesce(F.col(role).cast("string"), space).alias("role"),
                        F.coalesce(F.col(text).cast("string"), space).alias("text")).withColumn("key", name_of("conv_id"))
    # the last key only spreads rows that are equal, so that they do not sort into one task
    ranked = materialize(rank_rows(rows, [F.col("key"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"),
                                          F.rand(42).asc()], "row"), "rows")
    said = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    again = (ranked.groupBy("key", said.alias("said")).agg(F.min("row").alias("seen"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("key", "said", "seen"))
    of_conv = ranked.groupBy("key").agg(F.min("row").alias("first_row"))
    initial = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise(F.lit("x"))
    fault = (F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit("blank"))
             .when(F.col("row") > F.col("seen"), F.lit("duplicate"))
             .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), F.lit("truncated")))
    # written, so that the blocks below are dealt out anew and a hot conversation does not stay in one task
    marked = materialize(
        ranked.withColumn("said", said).join(materialize(again, "again"), ["key", "said"], "left")
        .join(materialize(of_conv, "conversations"), "key")
        .select("key", "row", "first_row", "turn", initial.alias("initial"), fault.alias("fault")), "marked")
    counts = marked.groupBy("key").agg(
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"))
    code = (F.when(F.col("fault").isin("blank", "duplicate"), F.lit(GONE))
            .when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial")))
    cells = marked.groupBy(
        "key", "first_row", F.expr(f"(row - first_row) div {block}").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("row", code.alias("code"), "initial"))).alias("cells"))  # ``block`` at most
    blocks = cells.select("key", "first_row", "block", F.array_join("cells.code", "").alias("codes"),
                          F.array_join("cells.initial", "").alias("initials"))
    edits = materialize(blocks.repartition("key").sortWithinPartitions("key", "block").mapInArrow(
        _edits, "key string, at long, edit string, new_role string, row long, cost long, illegal long"), "edits")
    costs = edits.where("at = -1").select("key", "cost", "illegal")
    full = (edits.where("at >= 0").join(ranked.select("row", "role", "text"), "row", "left")
            .select("key", "at", "edit", "row", F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text")))
    return Repair(full, counts.join(costs, "key"))


def digests(edits: DataFrame) -> DataFrame:
    """``key``, ``audit`` and ``repaired_sha256`` (``role:text`` of the repaired rows, newline-joined) of each conversation.

    The hash of a conversation is one ordered stream, so its rows pass one task, one at a time.
    """
    return edits.repartition("key").sortWithinPartitions("key", "at").mapInArrow(
        _digest, "key string, audit string, repaired_sha256 string")


def repaired_conversations(turns: DataFrame, every: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """One row for each conversation of ``every``, repaired from its rows in ``turns``; one without rows has zeros."""
    fixed = repair(turns)
    edits = materialize(fixed.edits, "full_edits")
    known = every.select(F.col(conv_id).cast("long").alias("conv_id")).distinct().withColumn("key", name_of("conv_id"))
    found = known.join(fixed.conversations, "key", "left").join(digests(edits), "key", "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
