"""Removal of every byte covered by a byte string that occurs more than once.

A depth-limited radix sort of all suffixes: only the first ``depth`` bytes count, groups are dealt
apart digit by digit, most significant first, and a suffix that is alone leaves. What is still
together after the last digit is a repeated string. The digits are fingerprints, so that one record
can stand for a whole run of neighbouring suffixes:

1. *Anchor*: the ``GRAM``-byte substring of the suffix's first ``depth`` bytes with the smallest
   hash (leftmost on ties). Equal strings have equal anchors at equal offsets; neighbouring suffixes
   mostly share one, so a record per run is enough.
2. *Run*: the hash of all bytes of the run. Runs that agree here agree in every suffix.
3. *Suffix*: for runs whose anchor has company but whose bytes differ, the hash of each suffix's
   ``depth`` bytes.

Scale: records are packed by digit range, ranges keep a fixed size at any input, and every map task
sends equal records once, so a passage that is everywhere reaches a range once per map task and
buffer. Hashes have 64 bits: about n**2 / 2**65 false pairs among n records of the last pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import ranges, tables, tokens
from panelspark.runtime import materialize

GRAM = 64
# Records that a map task buffers before it sends them on.
BUFFER = 300_000
REPEATED, WITNESS, JUDGE = 0, 1, 2


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` values, in two sweeps over blocks of that width."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def _suffix_runs(texts: list[bytes], depth: int, gram: int):
    """Runs of suffixes with one anchor: anchor hash, run hash, text number, start, number of suffixes."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    first = np.cumsum(sizes) - sizes
    buffer = np.frombuffer(b"".join(texts), dtype=np.uint8)
    counts = np.maximum(sizes - depth + 1, 0)
    if not counts.sum():
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    prefix = tokens.prefix_hash(tokens.byte_codes(buffer))
    grams = tokens.window_hash(prefix, gram)
    place = np.uint64((1 << int(len(grams)).bit_length()) - 1)
    order = (grams & ~place) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_sliding_min(order, depth - gram + 1) & place).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), counts)
    start = np.arange(counts.sum()) + np.repeat(first - (np.cumsum(counts) - counts), counts)
    anchor = anchor[start]
    head = np.ones(len(start), dtype=bool)
    head[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(head)
    length = np.diff(at, append=len(start))
    begin, owner, anchor = start[at], owner[at], anchor[at]
    body = tokens.span_hash(prefix, begin, begin + length + depth - 1)
    run = tokens.mix(body + tokens.mix((anchor - begin).astype(np.uint64)))
    return tokens.mix(grams[anchor]), run, owner, begin - first[owner], length


_FOUND = pa.schema([("key", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()), ("marks", pa.binary()), ("runs", pa.binary())])


def _findings(homes: int, kind: np.ndarray, doc: ranges.Address, start: np.ndarray, length: np.ndarray) -> list[tuple]:
    """Findings for their homes; neighbouring runs of one kind become one."""
    order = ranges.sorting(doc, kind, start)
    kind, doc, start, length = kind[order], ranges.taken(doc, order), start[order], length[order]
    head = ranges.heads(*doc, kind)
    head[1:] |= start[1:] != start[:-1] + length[:-1]
    at = np.flatnonzero(head)
    total = np.add.reduceat(length, at) if len(at) else length
    return ranges.by_home(homes, ranges.taken(doc, at), start[at].astype(np.int32), total.astype(np.int32), kind[at].astype(np.uint8))


def _send_runs(depth: int, gram: int, n_ranges: int):
    def flush(held: list[tuple]) -> pa.RecordBatch:
        h, run, *doc, start, length = (np.concatenate(x) for x in zip(*held, strict=True))
        order = ranges.sorting((h, run, *doc), start)
        head = ranges.heads(h[order], run[order])
        size = np.diff(np.flatnonzero(head), append=len(order))
        many = np.repeat(size > 1, size)
        lead, again = order[head], order[many]
        twice = np.zeros(len(h), dtype=np.uint8)
        twice[lead] = size > 1
        lead = lead[ranges.sorting(ranges.taken(doc, lead), start[lead])]
        marks = _findings(n_ranges, np.full(len(again), REPEATED), ranges.taken(doc, again), start[again], length[again])
        return tokens.batch(ranges.SENT, marks + ranges.by_hash(
            n_ranges, h[lead], run[lead], *ranges.taken(doc, lead), start[lead].astype(np.int32), length[lead].astype(np.int32),
            twice[lead]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            docs = ranges.addresses(batch)
            for a, b, texts in tokens.Texts(batch["text"]).chunks():
                h, runs, owner, start, length = _suffix_runs(texts, depth, gram)
                held.append((h, runs, *ranges.taken(docs, a + owner), start, length))
                size += len(h)
                if size >= BUFFER:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)

    return run


def _judge_runs(n_ranges: int):
    return lambda held: tokens.batch(ranges.SENT, _findings(n_ranges, *_judged_runs(held)))


def _judged_runs(held: list[bytes]) -> tuple:
    h, run, *doc, start, length, twice = ranges.columns_of(
        held, np.uint64, np.uint64, *ranges.ADDRESS, np.int32, np.int32, np.uint8)
    order = np.lexsort((run, h))
    h, run, *doc, start, length, twice = (x[order] for x in (h, run, *doc, start, length, twice))
    anchor, head = ranges.heads(h), ranges.heads(h, run)
    size = np.diff(np.flatnonzero(head), append=len(h))
    seen = np.maximum.reduceat(twice, np.flatnonzero(head))
    equal = np.repeat((size > 1) | (seen > 0), size)
    runs_here = np.add.reduceat(head.astype(np.int64), np.flatnonzero(anchor))
    group_size = np.diff(np.flatnonzero(anchor), append=len(h))
    apart = np.repeat(runs_here > 1, group_size)
    open_here = np.repeat(np.logical_or.reduceat(apart & ~equal, np.flatnonzero(anchor)), group_size)
    kind = np.full(len(h), -1)
    kind[equal & (twice == 0)] = REPEATED
    picks = [np.flatnonzero(kind == REPEATED), np.flatnonzero(apart & ~equal), np.flatnonzero(open_here & equal & head)]
    at = np.concatenate(picks)
    kinds = np.repeat([REPEATED, JUDGE, WITNESS], [len(p) for p in picks])
    return kinds, ranges.taken(doc, at), start[at], length[at]


def _gather(held: list[bytes]) -> pa.RecordBatch:
    """Marked runs and open runs of every document."""
    *doc, start, length, kind = ranges.columns_of(held, *ranges.ADDRESS, np.int32, np.int32, np.uint8)
    order = ranges.sorting(doc, start)
    *doc, start, length, kind = (x[order] for x in (*doc, start, length, kind))
    cut, rows = np.flatnonzero(ranges.heads(*doc)), []
    for a, b in ranges.slices(cut, len(start)):
        done = kind[a:b] == REPEATED
        rows.append((*(int(x[a]) for x in doc), tokens.pack(start[a:b][done], length[a:b][done]) if done.any() else None,
                     None if done.all() else tokens.pack(start[a:b][~done], length[a:b][~done], kind[a:b][~done])))
    return tokens.batch(_FOUND, rows)


def _send_suffixes(depth: int, n_ranges: int):
    """Hash every suffix of the open runs."""

    def flush(held: list[tuple]) -> pa.RecordBatch:
        h, *doc, start, kind = (np.concatenate(x) for x in zip(*held, strict=True))
        order = ranges.sorting((h, kind, *doc), start)
        head = ranges.heads(h[order])
        size = np.diff(np.flatnonzero(head), append=len(order))
        many = np.repeat(size > 1, size)
        lead, again = order[head], order[many]
        again = again[kind[again] == JUDGE]
        twice = np.zeros(len(h), dtype=np.uint8)
        twice[lead] = (size > 1) | (kind[lead] == WITNESS)
        lead = lead[ranges.sorting(ranges.taken(doc, lead), start[lead])]
        marks = _findings(n_ranges, np.full(len(again), REPEATED), ranges.taken(doc, again), start[again], np.ones(len(again), np.int64))
        return tokens.batch(ranges.SENT, marks + ranges.by_hash(
            n_ranges, h[lead], *ranges.taken(doc, lead), start[lead].astype(np.int32), twice[lead]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            texts = tokens.Texts(batch["text"])
            for i, doc in enumerate(zip(*ranges.addresses(batch), strict=True)):
                text = texts[i]
                prefix = tokens.prefix_hash(tokens.byte_codes(np.frombuffer(text, dtype=np.uint8)))
                start, length, kind = tokens.unpack(batch["runs"][i].as_py(), np.int32, np.int32, np.uint8)
                start, length = start.astype(np.int64), length.astype(np.int64)
                at = np.repeat(start - (np.cumsum(length) - length), length) + np.arange(length.sum())
                kind = np.repeat(kind, length)[at + depth <= len(text)]
                at = at[at + depth <= len(text)]
                held.append((tokens.span_hash(prefix, at, at + depth), *(np.full(len(at), x, np.int64) for x in doc), at, kind))
                size += len(at)
                if size >= BUFFER:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)

    return run


def _judge_suffixes(n_ranges: int):
    """A record is marked when its suffix has company; those marked before travel as company only."""
    return lambda held: tokens.batch(ranges.SENT, _findings(n_ranges, *_judged_suffixes(held)))


def _judged_suffixes(held: list[bytes]) -> tuple:
    h, *doc, start, twice = ranges.columns_of(held, np.uint64, *ranges.ADDRESS, np.int32, np.uint8)
    order = np.argsort(h, kind="stable")
    h, *doc, start, twice = (x[order] for x in (h, *doc, start, twice))
    size = np.diff(np.flatnonzero(ranges.heads(h)), append=len(h))
    at = np.flatnonzero(np.repeat(size > 1, size) & (twice == 0))
    return np.full(len(at), REPEATED), ranges.taken(doc, at), start[at], np.ones(len(at), np.int64)


_LEFT = pa.schema([("key", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                   ("kept_sha256", pa.string()), ("span_starts", pa.list_(pa.int32())),
                   ("span_ends", pa.list_(pa.int32())), ("kept_bytes", pa.binary())])


def _cut(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, marks, more = batch["key"].to_pylist(), batch["marks"].to_pylist(), batch["more"].to_pylist()
            for a, _, texts in tokens.Texts(batch["text"]).chunks():
                rows = []
                for i, data in enumerate(texts, a):
                    kept, starts, ends = data, [], []
                    blobs = [b for b in (marks[i], more[i]) if b is not None]
                    if blobs:
                        start, length = (c.astype(np.int64) for c in ranges.columns_of(blobs, np.int32, np.int32))
                        fits = start + length + depth - 1 <= len(data)
                        mask = tokens.covered(len(data), start[fits], length[fits] + depth - 1)
                        edge = np.flatnonzero(np.diff(mask.view(np.int8), prepend=0, append=0))
                        starts, ends = edge[0::2], edge[1::2]
                        kept = np.frombuffer(data, np.uint8)[~mask].tobytes()
                    rows.append((keys[i], len(data), len(data) - len(kept), len(starts),
                                 hashlib.sha256(kept).hexdigest(), starts, ends, kept))
                yield tokens.batch(_LEFT, rows)
    return run


def remove_repeated_bytes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = 200,
                          gram: int = GRAM, records_per_range: int = 250_000) -> DataFrame:
    """Per row of ``docs``: its UTF-8 bytes without those in strings of ``depth`` bytes that occur twice.

    A byte goes when some ``depth``-byte string that covers it also starts anywhere else, in the same
    document or another; overlaps count, and the input is judged, not what is left. Returns
    ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept_sha256``,
    ``span_starts``, ``span_ends`` and ``kept_bytes`` (binary: a cut may split a character).

    Null and empty texts have no bytes, texts below ``depth`` lose none. Every row is a place of its own, also
    one that shares its ``doc_id`` or repeats another row, and loses only what its own text repeats. A null ``doc_id`` is one more value. An empty table gives an empty result; other columns are ignored.
    """
    if not 0 < gram <= depth:
        raise ValueError("gram must lie between 1 and depth")
    rows = tables.addressed(docs, doc_id, text)
    size = tables.text_bytes(docs, text)
    n_ranges = max(1, 2 * size // (depth - gram + 2) // records_per_range)
    first = ranges.exchange(rows.mapInArrow(_send_runs(depth, gram, n_ranges), ranges.SCHEMA)).mapInArrow(
        ranges.owned(_judge_runs(n_ranges)), ranges.SCHEMA)
    found = materialize(ranges.exchange(first).mapInArrow(ranges.at_home(_gather), "key long, hi long, lo long, marks binary, runs binary"),
                        "found")
    n_ranges = max(1, size // 8 // records_per_range)
    still_open = rows.join(found.where("runs is not null").select("key", "hi", "lo", "runs"), ["key", "hi", "lo"])
    second = ranges.exchange(still_open.mapInArrow(_send_suffixes(depth, n_ranges), ranges.SCHEMA)).mapInArrow(
        ranges.owned(_judge_suffixes(n_ranges)), ranges.SCHEMA)
    more = ranges.exchange(second).mapInArrow(ranges.at_home(_gather), "key long, hi long, lo long, marks binary, runs binary")
    marks = found.where("marks is not null").select("key", "hi", "lo", "marks").join(
        more.select("key", "hi", "lo", F.col("marks").alias("more")), ["key", "hi", "lo"], "full")
    cut = rows.join(marks, ["key", "hi", "lo"], "left").mapInArrow(
        _cut(depth), "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                     "span_starts array<int>, span_ends array<int>, kept_bytes binary")
    return cut.select(tables.id_of(F.col("key")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256",
                      "span_starts", "span_ends", "kept_bytes")
