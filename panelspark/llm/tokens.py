"""Vectorised helpers that run inside tasks: words, window hashes and packed columns.

A batch of texts is worked on in chunks of about ``CHUNK_BYTES``, each one byte buffer, so that the
memory of a task depends on the chunk and the longest single text, never on the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

# Bytes of text that are worked on at once.
CHUNK_BYTES = 1 << 18
# Texts that are worked on at once, if they are short.
CHUNK_ROWS = 1000

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE_CODE = np.random.Generator(np.random.PCG64(20240501)).integers(1, 1 << 64, 256, dtype=np.uint64)
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        factors = np.full(max(n, CHUNK_BYTES + 4096), base, dtype=np.uint64)
        factors[0] = 1
        have = _POWERS[name] = np.multiply.accumulate(factors)
    return have[:n]


def prefix_hash(codes: np.ndarray) -> np.ndarray:
    """Prefix sums of ``codes[i] * base**i`` modulo 2**64, one longer than ``codes``."""
    out = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * _powers("up", _BASE, len(codes)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rabin-Karp value of every half-open span, independent of its position."""
    value = (prefix[ends] - prefix[starts]) * _powers("down", _INVERSE, len(prefix))[starts]
    return mix(value + (ends - starts).astype(np.uint64))


def window_hash(prefix: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp value of every window of ``width`` codes (none if there are fewer codes)."""
    n = len(prefix) - width
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    return mix((prefix[width:] - prefix[:n]) * _powers("down", _INVERSE, n) + np.uint64(width))


def byte_codes(buffer: np.ndarray) -> np.ndarray:
    return _BYTE_CODE[buffer]


class Texts:
    """The strings of an Arrow column as UTF-8 bytes, cut out one at a time; null gives none."""

    def __init__(self, column: pa.Array):
        _, offsets, data = column.buffers()
        kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
        self.data = memoryview(data) if data is not None else memoryview(b"")
        self.offsets = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1] if len(column) else [0]

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def __getitem__(self, i: int) -> bytes:
        return bytes(self.data[self.offsets[i]:self.offsets[i + 1]])

    def chunks(self) -> Iterator[tuple[int, int, list[bytes]]]:
        """Ranges of texts with about ``CHUNK_BYTES`` bytes each; a longer text stands alone."""
        first = 0
        while first < len(self):
            last = int(np.searchsorted(self.offsets, self.offsets[first] + CHUNK_BYTES, side="right")) - 1
            last = min(max(last, first + 1), len(self), first + CHUNK_ROWS)
            yield first, last, [self[i] for i in range(first, last)]
            first = last


def batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    """Rows as an Arrow batch."""
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def lower_ascii(buffer: np.ndarray) -> np.ndarray:
    return np.where((buffer >= 65) & (buffer <= 90), buffer + np.uint8(32), buffer)


def word_spans(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end in bytes that end with a space."""
    edge = np.flatnonzero(np.diff((~_SPACE[buffer]).view(np.int8), prepend=np.int8(0)))
    return edge[0::2], edge[1::2]


def words(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words ``[^\\x20\\x09-\\x0D]+`` of the texts, and where each text's words begin.

    The second array has one entry more than there are texts.
    """
    buffer = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    if lower:
        buffer = lower_ascii(buffer)
    starts, ends = word_spans(buffer)
    hashes = span_hash(prefix_hash(byte_codes(buffer)), starts, ends)
    text_starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=text_starts[1:])
    return hashes, np.searchsorted(starts, text_starts, side="left")


def windows_within(bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which a whole window fits into its text, and the text of each."""
    counts = np.maximum(np.diff(bounds) - width + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return bounds[owner] + offset, owner


def pack(*columns: np.ndarray) -> bytes:
    """Columns of equal length as one compressed blob; each is stored as byte planes.

    Signed columns are stored as differences, which are small for sorted identifiers.
    """
    parts = [np.uint32(len(columns[0])).tobytes()]
    for column in columns:
        if column.dtype.kind == "i":
            column = np.diff(column, prepend=column.dtype.type(0))
        parts.append(np.ascontiguousarray(column.view(np.uint8).reshape(-1, column.dtype.itemsize).T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(blob: bytes, *types) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, at, out = int(np.frombuffer(raw, np.uint32, 1)[0]), 4, []
    for kind in map(np.dtype, types):
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        column = np.ascontiguousarray(planes.T).view(kind).reshape(n)
        out.append(np.cumsum(column, dtype=kind) if kind.kind == "i" else column)
        at += n * kind.itemsize
    return out


def covered(n: int, starts: np.ndarray, lengths) -> np.ndarray:
    """Mask of the ``n`` positions that lie in at least one span."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:n]) > 0
