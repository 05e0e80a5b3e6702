"""Importance resampling towards a target distribution, on hashed runs of words.

The features of a text are its runs of one to ``RUN`` words, hashed into buckets by CRC-32. A batch's texts are
joined with a separator byte and one regex pass finds all words; the offsets of the documents, searched for
the place of every word, show which runs would cross from one document into the next, and those are masked
out before the buckets are counted. CRC values of runs are combined from those of their words, so no run is
ever spelled out.

Scale: two passes over the texts, one to count (a bucket table per task, summed by bucket) and one to weigh. Only
the table of gains, one number a bucket, passes the driver. Documents are ranked by a range sort over their
scores, without their texts.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import tokens
from panelspark.operators.ranking import rank_rows
from panelspark.runtime import materialize

RUN = 3
SEPARATOR = b"\x00"
# The bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are folded.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
# Longer words are hashed one by one.
_LONG = 64


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """One CRC step per byte value, and the effect of 0 to ``_LONG`` + 1 zero bytes on each byte of a register."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)
    zeros = np.empty((_LONG + 2, 4, 256), dtype=np.uint32)
    zeros[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(1, _LONG + 2):
        zeros[n] = step[zeros[n - 1] & 255] ^ (zeros[n - 1] >> 8)
    return step, zeros.reshape(-1)


_STEP, _ZEROS = _tables()


def _shifted(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The part that a prefix of value ``crc`` adds to the CRC of a text with ``n`` more bytes."""
    at = n * 1024
    return (_ZEROS[at + (crc & 255)] ^ _ZEROS[at + 256 + ((crc >> 8) & 255)]
            ^ _ZEROS[at + 512 + ((crc >> 16) & 255)] ^ _ZEROS[at + 768 + (crc >> 24)])


def _word_crc(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32 of words of at most ``_LONG`` bytes, all words a byte further at each step."""
    order = np.argsort(-sizes, kind="stable")
    at, crc = starts[order], np.full(len(starts), 0xFFFFFFFF, dtype=np.uint32)
    longest_first = -sizes[order]
    for k in range(int(-longest_first[0]) if len(order) else 0):
        n = int(np.searchsorted(longest_first, -k, side="left"))
        crc[:n] = _STEP[(crc[:n] ^ data[at[:n] + k]) & 255] ^ (crc[:n] >> 8)
    out = np.empty_like(crc)
    out[order] = ~crc
    return out


class Runs(NamedTuple):
    """CRC of every run of words of a batch, by length, the document of each, and the words per document."""

    crc: list[np.ndarray]
    owner: list[np.ndarray]
    n_words: np.ndarray


def runs(texts: list[bytes]) -> Runs:
    joined = SEPARATOR.join(texts).lower()
    spans = np.fromiter(chain.from_iterable(map(re.Match.span, _WORD.finditer(joined))), dtype=np.int64).reshape(-1, 2)
    starts, sizes = spans[:, 0], spans[:, 1] - spans[:, 0]
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    owner = np.searchsorted(offsets, starts, side="right") - 1
    data = np.frombuffer(joined, dtype=np.uint8)
    long = sizes > _LONG
    short = np.where(long, 0, sizes)
    crc = _word_crc(data, starts, short)
    for i in np.flatnonzero(long):
        crc[i] = zlib.crc32(joined[starts[i]:starts[i] + sizes[i]])
    spaced = _shifted(np.full(len(crc), zlib.crc32(b" "), dtype=np.uint32), short) ^ crc
    out, owners = [crc], [owner]
    for k in range(1, min(RUN, len(crc))):
        whole = owner[k:] == owner[:-k]
        longer = _shifted(out[-1][:-1], short[k:] + 1) ^ spaced[k:]
        for i in np.flatnonzero(long[k:]):  # the tables end before such words
            words = [joined[starts[j]:starts[j] + sizes[j]] for j in range(i, i + k + 1)]
            longer[i] = zlib.crc32(b" ".join(words))
        out.append(longer)
        owners.append(np.where(whole, owner[k:], -1))
    kept = [o >= 0 for o in owners]
    return Runs([c[m] for c, m in zip(out, kept, strict=True)], [o[m] for o, m in zip(owners, kept, strict=True)],
                np.bincount(owner, minlength=len(texts)))


def _count(buckets: int):
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, texts in tokens.Texts(batch["text"]).chunks():
                for crc in runs(texts).crc:
                    held += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        found = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(held[found])], schema=schema)
    return run


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = 10_000) -> DataFrame:
    """``bucket`` and ``n``: how often the runs of words of all texts fall into each bucket (empty ones left out)."""
    rows = docs.select(F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_count(buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = 10_000) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed share in ``target`` to that in ``raw``, rounded down."""
    counts = np.zeros((2, buckets), dtype=np.int64)
    for which, table in enumerate((raw, target)):
        for r in table.collect():  # one row a bucket
            counts[which, r["bucket"]] = r["n"]
    (s, t), (big_s, big_t) = counts, (int(c.sum()) for c in counts)
    return np.array([math.floor(1000 * math.log(((float(b) + 1) * (float(big_s) + buckets)) / ((float(a) + 1) * (float(big_t) + buckets))))
                     for a, b in zip(s.tolist(), t.tolist(), strict=True)], dtype=np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise in thousandths, rounded down, from a hash of the identifier (null: as if empty)."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _weigh(gain: np.ndarray, seed: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64()),
                        ("score", pa.int64())])
    buckets = np.uint32(len(gain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            for a, b, texts in tokens.Texts(batch["text"]).chunks():
                found = runs(texts)
                weight, n = np.zeros(b - a, dtype=np.int64), np.zeros(b - a, dtype=np.int64)
                for crc, owner in zip(found.crc, found.owner, strict=True):
                    summed = np.concatenate([[0], np.cumsum(gain[crc % buckets])])
                    edge = np.searchsorted(owner, np.arange(b - a + 1))
                    weight += np.diff(summed[edge])
                    n += np.diff(edge)
                score = weight + np.array([noise(i, seed) for i in ids[a:b]], dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids[a:b], pa.int64()), *map(pa.array, (
                    found.n_words, n, weight, score))], schema=schema)
    return run


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
             percent: int = 5, least_words: int = 20, buckets: int = 10_000, seed: int = 42) -> DataFrame:
    """Weigh every row of ``docs`` by its likeness to ``target`` and draw ``percent`` % without replacement.

    A-Z are folded; words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, features all runs of one to three consecutive words,
    repeats counted. Returns ``doc_id``, ``n_words``, ``n_features``, ``weight`` (sum of the features' gains), ``score``
    (``weight`` plus noise by ``doc_id`` and ``seed``) and ``rank``: 1, 2, 3... by score for the drawn rows, else null. Of the N
    rows with at least ``least_words`` words, ``percent * N // 100`` are drawn; ties go to the smaller ``doc_id``, null last,
    then to the larger weight and the fewer features. Rows that agree in all that are interchangeable.

    Null and empty texts have no features and weight 0. With an empty ``target`` all gains come from ``docs`` alone. Rows
    that share a ``doc_id`` share their noise and are drawn each for itself. An empty table gives an empty result; other
    columns are ignored.
    """
    gain = gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets), buckets)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    scored = materialize(rows.mapInArrow(_weigh(gain, seed), "doc_id long, n_words long, n_features long, weight long, score long"),
                         "scored")
    able = F.col("n_words") >= least_words
    drawn = scored.where(able).count() * percent // 100
    # the last key only spreads rows that are equal, so that they do not sort into one task
    ranked = rank_rows(scored, [able.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight").desc(),
                                F.col("n_features").asc(), F.rand(seed).asc()])
    return ranked.withColumn("rank", F.when(able & (F.col("rank") <= drawn), F.col("rank")))
