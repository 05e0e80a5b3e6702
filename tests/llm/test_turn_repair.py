"""Conversation repair against an exhaustive search, and its faults against plain Python."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from panelspark.llm import queries, turn_repair

TURNS = "conv_id long, turn long, role string, text string, key string, row long, edit string"
SPACE = "\x20\x09\x0A\x0B\x0C\x0D"


def damaged(rows):
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        h = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        yield from [(conv, turn, "user" if h == 4 else role, text)] * {0: 0, 3: 2}.get(h, 1)


def search(rows):
    """Cheapest (cost, audit, repaired) of rows of role and fault, over whole derivations from the front.

    Strings only grow at their end, so all strings of the least cost are expanded and compared at the end.
    """
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    agenda, best, least, seen = [(0, "", 0, "", ())], None, None, set()
    while agenda:
        cost, audit, i, state, out = heapq.heappop(agenda)
        if least is not None and cost > least:
            break
        if (cost, audit, i, state) in seen:
            continue
        seen.add((cost, audit, i, state))
        if i == len(rows) and state in ("", "a"):
            least = cost
            best = min(best, (cost, audit, out)) if best else (cost, audit, out)
        if len(audit) > 2 * len(rows) + 1:
            continue
        for c in "ua":
            if (state, c) in step:
                heapq.heappush(agenda, (cost + 5, audit + "I", i, c, (*out, ({"u": "user", "a": "assistant"}[c], ""))))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(agenda, (cost + 2, audit + "D", i + 1, state, out))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if (state, role[:1]) in step:
                    heapq.heappush(agenda, (cost + more, audit + "K", i + 1, role[0], (*out, (role, text))))
                for c in "ua":
                    if (state, c) in step:
                        heapq.heappush(agenda, (cost + more + 1, audit + "R", i + 1, c, (*out, ({"u": "user", "a": "assistant"}[c], text))))
    return best


def expected(turns, rows, searched=True):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn is not None, turn or 0, role.encode(), text.encode(), role, text))
    out = {}
    for conv in {t[0] for t in turns}:
        seen, marked, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        here = sorted(by_conv[conv])
        for *_, role, text in here:
            left = text.rstrip(SPACE)
            fault = ("blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else None)
            seen.add((role, text))
            marked.append((role, text, fault))
            if fault:
                counts[fault] += 1
        nums = [t[1] for t in here if t[0]]
        gaps = max(nums) - min(nums) + 1 - len(set(nums)) if nums else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        row = [gaps, *counts.values(), illegal]
        if searched:
            cost, audit, fixed = search(marked) if marked else (0, "", ())
            row += [cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()]
        out[conv] = tuple(row)
    return out


def listed(frame):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in frame.collect()}


def awkward(seed=5, convs=160):
    r = random.Random(seed)
    texts = ["ok.", "ok. ", "no", "", " \t", None, "ß?\n", "a.b", "why?", "yes!"]
    roles = ["user", "assistant", "system", "tool", "", None, "usher"]
    rows = []
    for c in range(convs):
        for k in range(r.randint(1, 6)):
            conv = None if c == 7 else c - 3
            rows.append((conv, r.choice([k, k, k, k, 0, None, 3 * k]), r.choice(roles[:2] * 3 + roles), r.choice(texts[:3] * 3 + texts)))
    return [*rows, *rows[:9]]


@pytest.mark.parametrize("block", [1, 2, 3, 512])
def test_against_every_derivation(spark, block, monkeypatch):
    rows = awkward()
    frame = spark.createDataFrame([(*t, "k", 1, "e") for t in rows], TURNS).repartition(5)
    original = turn_repair.repair
    monkeypatch.setattr(turn_repair, "repair", lambda turns: original(turns, block=block))
    got = listed(turn_repair.repaired_conversations(turn_repair.damage(frame), frame))
    assert got == expected(rows, list(damaged(rows)))


def test_repaired_rows_fit_the_pattern(spark):
    rows = [(1, k % 40 if k % 7 else None, ("user", "assistant", "tool")[k * k % 3], f"t{k % 50}" + (".", "", " !")[k % 3]) for k in range(300)]
    fixed = turn_repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), block=16)
    edits = sorted((r.at, r.edit, r.role, r.text) for r in fixed.edits.collect())
    initials = "".join(e[2][0] for e in edits if e[1] != "D")
    assert re.fullmatch("(s?(ua)+)?", initials) and sum(e[1] != "I" for e in edits) == len(rows)
    assert [e[0] for e in edits] == list(range(len(edits))) and all(e[3] == "" for e in edits if e[1] == "I")
    whole = turn_repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert sorted((r.at, r.edit, r.role, r.text) for r in whole.edits.collect()) == edits
    assert whole.conversations.first().cost == fixed.conversations.first().cost


def test_equal_rows_of_one_conversation(spark):
    frame = spark.createDataFrame([(None, None, "user", "hi.")] * 3000 + [(2, 1, "assistant", "x.")],
                                  "conv_id long, turn long, role string, text string")
    got = {r.key: r for r in turn_repair.repair(frame).conversations.collect()}
    assert got[" "].duplicate == 2999 and got[" "].gaps == 0 and got["2"].cost == 2


def test_empty(spark):
    none = spark.createDataFrame([], TURNS)
    assert turn_repair.repaired_conversations(turn_repair.damage(none), none).collect() == []


def test_query_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    turns = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    assert listed(queries.op12_conversation_repair(spark, sf)) == expected(turns, list(damaged(turns)))
