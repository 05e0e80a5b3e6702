"""Records of 64-bit hashes on their way to the task that owns their range, and findings on their way home.

Records travel packed, a blob per buffer and range, so Spark moves few and compact rows. Findings travel the
same way to a *home*, a hash range of documents, under negative numbers; there they become a row per document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import tokens

SENT = pa.schema([("range", pa.int64()), ("blob", pa.binary())])
SCHEMA = "range long, blob binary"
# A document in records and findings: ``key``, ``hi`` and ``lo`` of ``tables.addressed``.
ADDRESS = (np.int64, np.int64, np.int64)
Address = tuple[np.ndarray, np.ndarray, np.ndarray]


def heads(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where a new combination of keys begins."""
    head = np.ones(len(sorted_keys[0]), dtype=bool)
    head[1:] = np.any([k[1:] != k[:-1] for k in sorted_keys], axis=0)
    return head


def addresses(batch: pa.RecordBatch) -> Address:
    return tuple(batch[c].to_numpy() for c in ("key", "hi", "lo"))


def taken(doc: Address, at) -> Address:
    return tuple(x[at] for x in doc)


def sorting(doc: Address, *columns: np.ndarray) -> np.ndarray:
    """Order by document, then by the columns, the first of them first."""
    return np.lexsort((*columns[::-1], *doc[::-1]))


def slices(head: np.ndarray, n: int) -> list[tuple[int, int]]:
    """First and last position of every group among ``n`` rows, from where groups begin."""
    return list(zip(head, [*head[1:], n], strict=True)) if n else []


def _packed(at: np.ndarray, columns: list[np.ndarray]) -> list[tuple[int, bytes]]:
    order = np.argsort(at, kind="stable")
    at, columns = at[order], [c[order] for c in columns]
    cut = np.flatnonzero(np.diff(at, prepend=-1))
    return [(int(at[a]), tokens.pack(*(c[a:b] for c in columns)))
            for a, b in slices(cut, len(at))]


def by_hash(ranges: int, h: np.ndarray, *columns: np.ndarray) -> list[tuple[int, bytes]]:
    """Blobs of records by the range of their hash, in the given order within each."""
    return _packed(((h >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64), [h, *columns])


def by_home(homes: int, doc: Address, *columns: np.ndarray) -> list[tuple[int, bytes]]:
    """Blobs of findings by the home of their document, sorted by document and the first column."""
    order = sorting(doc, columns[0])
    doc, columns = taken(doc, order), [c[order] for c in columns]
    key, hi, lo = (x.view(np.uint64) for x in doc)
    at = ((tokens.mix(key + tokens.mix(hi + tokens.mix(lo))) >> np.uint64(32)) * np.uint64(homes) >> np.uint64(32)).astype(np.int64)
    return [(-1 - home, blob) for home, blob in _packed(at, [*doc, *columns])]


def owned(judged: Callable[[list[bytes]], pa.RecordBatch]):
    """For rows sorted by range: ``judged`` gets all blobs of a range; findings (negative) pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            places = batch["range"].to_numpy()
            if (places < 0).any():
                yield batch.filter(pa.array(places < 0))
            for i in np.flatnonzero(places >= 0):
                if places[i] != current and held:
                    yield judged(held)
                    held = []
                current = places[i]
                held.append(batch["blob"][int(i)].as_py())
        if held:
            yield judged(held)

    return run


def at_home(gathered: Callable[[list[bytes]], pa.RecordBatch]):
    """For rows sorted by home: ``gathered`` gets all blobs of a home."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            for at, blob in zip(batch["range"].to_pylist(), batch["blob"].to_pylist(), strict=True):
                if at != current and held:
                    yield gathered(held)
                    held = []
                current = at
                held.append(blob)
        if held:
            yield gathered(held)

    return run


def exchange(rows: DataFrame) -> DataFrame:
    """Bring blobs of a range together."""
    return rows.repartition(F.col("range")).sortWithinPartitions("range")


def columns_of(blobs: list[bytes], *types) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*(tokens.unpack(b, *types) for b in blobs), strict=True)]
