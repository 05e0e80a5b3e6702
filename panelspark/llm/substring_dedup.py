"""Exact removal of word windows that occur earlier in the corpus.

Every window of ``width`` words gets a 64-bit Rabin-Karp hash. Tasks keep the first occurrence of
each hash they meet and send it, packed by hash range, to the task that owns the range; there the
occurrence with the smallest (document, start) is kept and all others are marked. Marks return to
their documents and merge into maximal removal intervals.

Scale: a hash range holds about ``windows_per_range`` windows at any input size, and a window that
occurs everywhere reaches its range once per map task and buffer, so no key gathers in one task.
Windows count as equal when their hashes are: about n**2 / 2**65 false pairs among n windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import ranges, tables, tokens

# Windows that a map task buffers before it sends them on.
BUFFER = 600_000


def _first_of_each(h: np.ndarray, doc: ranges.Address, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row of the smallest (doc, start) of every hash, and the rows that lie later than it."""
    order = np.argsort(h, kind="stable")
    same = np.zeros(len(h), dtype=bool)
    same[1:] = h[order[1:]] == h[order[:-1]]
    again = same.copy()
    again[:-1] |= same[1:]
    single, many = order[~again], order[again]
    many = many[ranges.sorting((h[many], *ranges.taken(doc, many)), start[many])]
    head = np.ones(len(many), dtype=bool)
    head[1:] = h[many[1:]] != h[many[:-1]]
    lead = many[head][np.cumsum(head) - 1]
    later = np.any([x[many] != x[lead] for x in (*doc, start)], axis=0)
    return np.concatenate([single, many[head]]), many[later]


_MARKS = pa.schema([("key", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()), ("marks", pa.binary())])
_LEFT = pa.schema([("key", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
                   ("span_starts", pa.list_(pa.int32())), ("span_ends", pa.list_(pa.int32())), ("kept_text", pa.string())])


def _send(width: int, n_ranges: int):
    """Pack the windows of a partition by hash range; marks found here travel beside them."""

    def flush(held: list[tuple]) -> pa.RecordBatch:
        h, *doc, start = (np.concatenate(x) for x in zip(*held, strict=True))
        keep, dead = _first_of_each(h, doc, start)
        keep = keep[ranges.sorting(ranges.taken(doc, keep), start[keep])]
        return tokens.batch(ranges.SENT, ranges.by_hash(n_ranges, h[keep], *ranges.taken(doc, keep), start[keep])
                            + ranges.by_home(n_ranges, ranges.taken(doc, dead), start[dead]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            docs = ranges.addresses(batch)
            for a, b, texts in tokens.Texts(batch["text"]).chunks():
                hashes, bounds = tokens.words(texts)
                at, owner = tokens.windows_within(bounds, width)
                held.append((tokens.window_hash(tokens.prefix_hash(hashes), width)[at], *ranges.taken(docs, a + owner),
                             (at - bounds[owner]).astype(np.int32)))
                size += len(at)
                if size >= BUFFER:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)

    return run


def _judge(n_ranges: int):
    """Mark all but the first occurrence of every hash."""
    def judged(held: list[bytes]) -> pa.RecordBatch:
        h, *doc, start = ranges.columns_of(held, np.uint64, *ranges.ADDRESS, np.int32)
        _, dead = _first_of_each(h, doc, start)
        return tokens.batch(ranges.SENT, ranges.by_home(n_ranges, ranges.taken(doc, dead), start[dead]))
    return judged


def _gather(held: list[bytes]) -> pa.RecordBatch:
    """The marked starts of every document."""
    *doc, start = ranges.columns_of(held, *ranges.ADDRESS, np.int32)
    order = ranges.sorting(doc, start)
    doc, start = ranges.taken(doc, order), start[order]
    cut = np.flatnonzero(ranges.heads(*doc))
    return tokens.batch(_MARKS, [(*(int(x[a]) for x in doc), tokens.pack(start[a:b]))
                                 for a, b in ranges.slices(cut, len(start))])


def _cut(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, marks = batch["key"].to_pylist(), batch["marks"]
            for a, _, texts in tokens.Texts(batch["text"]).chunks():
                rows = []
                for i, text in enumerate(texts, a):
                    found, removed, starts, ends = text.split(), 0, [], []
                    n_words = len(found)
                    if marks[i].is_valid:
                        at = tokens.unpack(marks[i].as_py(), np.int32)[0]
                        mask = tokens.covered(n_words, at[at <= n_words - width], width)
                        removed = int(mask.sum())
                        edge = np.flatnonzero(np.diff(mask.view(np.int8), prepend=0, append=0))
                        starts, ends = edge[0::2], edge[1::2]
                        found = [w for w, out in zip(found, mask.tolist(), strict=True) if not out]
                    kept = b" ".join(found)
                    rows.append((keys[i], n_words, removed, hashlib.sha256(kept).hexdigest(), starts, ends,
                                 kept.decode("utf-8", "surrogatepass")))
                yield tokens.batch(_LEFT, rows)
    return run


def remove_repeated_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 20,
                            windows_per_range: int = 500_000) -> DataFrame:
    """Per row of ``docs``: what is left of its text once repeated windows are cut.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A word goes when a window of ``width`` words that
    covers it also starts earlier: in a smaller ``doc_id``, in a text of the same ``doc_id`` with a smaller md5
    (halves as signed integers), or further up in the same document.
    Judged on the input, overlaps included. Returns ``doc_id``, ``n_words``, ``n_removed``,
    ``kept_sha256`` (of the kept words joined by one space), ``span_starts`` and ``span_ends`` (word
    positions of the maximal removed runs) and ``kept_text``.

    Null and empty texts have no words. Rows that share a ``doc_id`` and the text are one document (they
    lose nothing to each other); other rows of one ``doc_id`` are documents of their own. A null ``doc_id`` sorts first. An empty table gives an empty result; other columns are ignored.
    """
    rows = tables.addressed(docs, doc_id, text)
    n_ranges = max(1, tables.text_bytes(docs, text) // 6 // windows_per_range)
    found = ranges.exchange(rows.mapInArrow(_send(width, n_ranges), ranges.SCHEMA)).mapInArrow(
        ranges.owned(_judge(n_ranges)), ranges.SCHEMA)
    marks = ranges.exchange(found).mapInArrow(ranges.at_home(_gather), "key long, hi long, lo long, marks binary")
    cut = rows.join(marks, ["key", "hi", "lo"], "left").mapInArrow(
        _cut(width), "key long, n_words long, n_removed long, kept_sha256 string, span_starts array<int>, "
                     "span_ends array<int>, kept_text string")
    return cut.select(tables.id_of(F.col("key")).alias("doc_id"), "n_words", "n_removed", "kept_sha256",
                      "span_starts", "span_ends", "kept_text")
