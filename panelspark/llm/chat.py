"""Chat formatting by columnar byte assembly.

The turns of a partition come sorted by conversation. For a block of turns, segment lengths (header,
escaped text, trailer), their cumulative offsets and the place of every byte are computed in numpy,
and all bytes are scattered into one preallocated Arrow buffer. A turn reads::

    <s>[role]⏎text</s>⏎

Inside roles and texts a backslash follows each of ``< [ ] \\``, so no control string survives in
them, and dropping it restores the text. Training loss counts for assistant texts only.

Scale: one shuffle by conversation. A conversation of any length is written in parts of about
``BLOCK_BYTES``, so no task holds more than a block and the longest single text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import ranges, tables, tokens

BLOCK_BYTES = 1 << 20
OPEN, SHUT, END = b"<s>[", b"]\n", b"</s>\n"
_SPECIAL = np.zeros(256, dtype=bool)
_SPECIAL[list(b"<[]\\")] = True
_ESCAPED = re.compile(rb"([<\[\]\\])\\")
_FORMATTED = pa.schema([("key", pa.int64()), ("part", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()),
                        ("loss_starts", pa.list_(pa.int32())), ("loss_ends", pa.list_(pa.int32()))])
_READ = pa.schema([("key", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                   ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def escape(text: bytes) -> bytes:
    return re.sub(rb"[<\[\]\\]", lambda m: m[0] + b"\\", text)


def unescape(text: bytes) -> bytes:
    return _ESCAPED.sub(rb"\1", text)


def _scatter(out: np.ndarray, segments: list[bytes], at: np.ndarray) -> None:
    """Copy segments to their places in ``out``."""
    sizes = np.array([len(s) for s in segments], dtype=np.int64)
    place = np.repeat(at - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    out[place] = np.frombuffer(b"".join(segments), dtype=np.uint8)


def assemble(roles: list[bytes], texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all turns, where each turn ends, and where its text begins and ends."""
    heads = {r: OPEN + escape(r) + SHUT for r in set(roles)}
    headers = [heads[r] for r in roles]
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    special = _SPECIAL[data]
    before = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(special, out=before[1:])
    first = np.cumsum(sizes) - sizes
    escaped = sizes + before[first + sizes] - before[first]
    head_sizes = np.array([len(h) for h in headers], dtype=np.int64)
    ends = np.cumsum(head_sizes + escaped + len(END))
    starts = ends - (head_sizes + escaped + len(END))
    out = np.empty(ends[-1] if len(ends) else 0, dtype=np.uint8)
    _scatter(out, headers, starts)
    _scatter(out, [END] * len(texts), ends - len(END))
    body = starts + head_sizes
    place = np.repeat(body - first - before[first], sizes) + np.arange(len(data)) + before[:-1]
    out[place] = data
    out[place[special] + 1] = ord("\\")
    return out, ends, body, body + escaped


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[bytes]]]:
    texts = tokens.Texts(batch["text"])
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(texts.offsets, texts.offsets[first] + BLOCK_BYTES, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, last, [texts[i] for i in range(first, last)]
        first = last


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, part = None, 0
    for batch in batches:
        keys, roles = batch["key"].to_numpy(), tokens.Texts(batch["role"])
        for a, b, texts in _blocks(batch):
            role = [roles[i] for i in range(a, b)]
            out, ends, body, stop = assemble(role, texts)
            cut = np.flatnonzero(ranges.heads(keys[a:b]))
            last = np.append(cut[1:], b - a)
            offsets = np.concatenate([[0], ends[last - 1]]).astype(np.int32)
            loss = np.array([r == b"assistant" for r in role])
            owner = np.repeat(np.arange(len(cut)), last - cut)
            of_loss = np.concatenate([[0], np.cumsum(np.bincount(owner[loss], minlength=len(cut)))]).astype(np.int32)
            spans = [pa.ListArray.from_arrays(pa.array(of_loss), pa.array((x - offsets[owner])[loss].astype(np.int32)))
                     for x in (body, stop)]
            parts = np.zeros(len(cut), dtype=np.int64)
            parts[0] = part + 1 if keys[a] == current else 0
            current, part = keys[b - 1], int(parts[-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[a:b][cut]), pa.array(parts), pa.array(last - cut),
                 pa.StringArray.from_buffers(len(cut), pa.py_buffer(offsets), pa.py_buffer(out)), *spans],
                schema=_FORMATTED)


def format_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """Conversations as training strings with their loss spans.

    Returns ``conv_id``, ``part``, ``n_turns``, ``formatted`` and ``loss_starts``/``loss_ends`` (byte offsets
    of assistant texts in ``formatted``). Most conversations have part 0 only; long ones continue in
    further parts, cut between turns. Turns are ordered by ``turn`` (null first), ties by role and text.
    Null texts and roles are empty; turns with a null ``conv_id`` are one conversation. Repeated rows are
    repeated turns. An empty table gives an empty result; other columns are ignored.
    """
    rows = turns.select(tables.key_of(conv_id).alias("key"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    done = (rows.repartition(F.col("key")).sortWithinPartitions("key", "turn", "role", "text").drop("turn")
            .mapInArrow(_format, "key long, part long, n_turns long, formatted string, loss_starts array<int>, "
                                 "loss_ends array<int>"))
    return done.select(tables.id_of(F.col("key")).alias("conv_id"), "part", "n_turns", "formatted", "loss_starts", "loss_ends")


def _chars(data: bytes) -> int:
    return len(data.decode("utf-8", "surrogatepass"))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of a conversation come one after another."""
    current, state, rows = None, None, []

    def result():
        return (current, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

    for batch in batches:
        keys, parts = batch["key"].to_pylist(), tokens.Texts(batch["formatted"])
        for i, key in enumerate(keys):
            if state is None or key != current:
                if state:
                    rows.append(result())
                current, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            data = parts[i]
            for one in data.split(END)[:-1]:
                role, text = one[len(OPEN):].split(SHUT, 1)
                state[0] += 1
                state[1].update(unescape(role) + b"\n" + unescape(text) + b"\n")
            for a, b in zip(batch["loss_starts"][i].as_py(), batch["loss_ends"][i].as_py(), strict=True):
                text = unescape(data[a:b])
                state[2] += _chars(text)
                state[3].update(text)
            state[4] += _chars(data)
        yield tokens.batch(_READ, rows)
        rows = []
    if state:
        yield tokens.batch(_READ, [result()])


def read_back(formatted: DataFrame, stored: bool = True) -> DataFrame:
    """Digest of each conversation, parsed from the output of ``format_turns``.

    Returns ``conv_id``, ``n_turns``, ``turns_sha256`` (of role, newline, text, newline for every turn),
    ``loss_chars``, ``loss_sha256`` (of the assistant texts, nothing between) and ``formatted_chars``.
    ``stored=False`` relies on the order in which ``format_turns`` yields parts and needs no shuffle.
    """
    rows = formatted.select(tables.key_of("conv_id").alias("key"), "part", "formatted", "loss_starts", "loss_ends")
    if stored:
        rows = rows.repartition(F.col("key")).sortWithinPartitions("key", "part")
    read = rows.mapInArrow(_read, "key long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                  "formatted_chars long")
    return read.select(tables.id_of(F.col("key")).alias("conv_id"), "n_turns", "turns_sha256", "loss_chars",
                       "loss_sha256", "formatted_chars")
