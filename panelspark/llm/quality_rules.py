"""Quality rules: counts per text, and Jensen-Shannon distance to language references.

A reference holds, for one language, the distribution of character classes and of its most common
words, counted over all documents of that language. A document is compared with every reference and
judged by the nearest: far away in characters or words, it goes. Short documents say little about a
distribution, so each distance has a minimum length below which it does not judge.

Scale: references come from one pass with map-side counts (word hashes, not words) and a top-k in two
steps; they hold ``common`` words per language, for any number of languages, and are sent to the tasks with the code. The second
pass handles each text by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm import tokens
from panelspark.runtime import materialize

CLASSES = ("lower", "upper", "digit", "space", "point", "symbol", "other_ascii", "not_ascii")
_SYMBOLS = b"#*$%&|<>"
_CLASS = np.full(256, 6, dtype=np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[0x20, *range(0x09, 0x0E)]] = 3
_CLASS[list(b".,;:!?'\"()-")] = 4
_CLASS[list(_SYMBOLS)] = 5
_CLASS[0xC0:] = 7
_CLASS[0x80:0xC0] = 8  # continuation bytes belong to no class of their own


def _class_counts(texts: list[bytes]) -> np.ndarray:
    """Characters of each class per text."""
    sizes = [len(t) for t in texts]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    at = np.repeat(np.arange(len(texts)) * 9, sizes) + _CLASS[data]
    return np.bincount(at, minlength=9 * len(texts)).reshape(-1, 9)[:, :8]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts: words under their hash, character classes under their number (kind 0)."""
    schema = pa.schema([("lang", pa.string()), ("kind", pa.int32()), ("code", pa.int64()), ("n", pa.int64())])
    for batch in batches:
        langs = np.array(batch["lang"].to_pylist(), dtype=object)
        held: dict[str, list[np.ndarray]] = {}
        for a, b, texts in tokens.Texts(batch["text"]).chunks():
            here = langs[a:b]
            hashes, bounds = tokens.words(texts, lower=True)
            owner = np.repeat(here, np.diff(bounds))
            classes = _class_counts(texts)
            for lang in set(here):
                found, n = np.unique(hashes[owner == lang].view(np.int64), return_counts=True)
                held.setdefault(lang, []).append(np.stack([np.ones(len(found), np.int64), found, n]))
                of_class = classes[here == lang].sum(axis=0)
                held[lang].append(np.stack([np.zeros(8, np.int64), np.arange(8), of_class]))
        for lang, parts in held.items():
            kind, code, n = np.concatenate(parts, axis=1)
            order = np.lexsort((code, kind))
            cut = np.flatnonzero((np.diff(kind[order], prepend=-1) != 0) | (np.diff(code[order], prepend=0) != 0))
            cut = np.union1d(cut, [0]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(cut), pa.string()), pa.array(kind[order][cut], pa.int32()),
                 pa.array(code[order][cut]), pa.array(np.add.reduceat(n[order], cut))], schema=schema)


def references(docs: DataFrame, text: str = "text", lang: str = "lang", common: int = 64) -> DataFrame:
    """Per language the counts of all character classes (kind 0), of its ``common`` most frequent words
    (kind 1, by hash, lower case) and of all words (kind 2). Rows without text or language do not count."""
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")).dropna()
    # written, as three branches read it
    counts = materialize(rows.mapInArrow(_count, "lang string, kind int, code long, n long")
                         .groupBy("lang", "kind", "code").agg(F.sum("n").alias("n")), "counts")
    words = counts.where("kind = 1")
    best = [F.col("n").desc(), F.col("code")]
    near = words.withColumn("r", F.row_number().over(
        Window.partitionBy("lang", F.pmod(F.xxhash64("code"), F.lit(64))).orderBy(*best))).where(F.col("r") <= common)
    top = near.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(
        F.col("r") <= common).drop("r")
    total = words.groupBy("lang").agg(F.sum("n").alias("n")).selectExpr("lang", "2 kind", "0L code", "n")
    return counts.where("kind = 0").unionByName(top).unionByName(total)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (square root, base 2) between matching rows; 0 is equal, 1 is disjoint."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=-1)
        b = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=-1)
    return np.sqrt(np.clip((a + b) / 2, 0, 1))


class _References:
    """Distributions of all languages: over character classes, and over each language's own common words and the rest.

    Words that are common in other languages only have share 0, so a language is held by its own words alone; some 1.2 KB
    each, however many there are.
    """

    def __init__(self, rows: list[tuple]):
        self.langs = sorted({r[0] for r in rows})
        place = {x: i for i, x in enumerate(self.langs)}
        self.words = np.unique(np.array([r[2] for r in rows if r[1] == 1], dtype=np.int64).view(np.uint64))
        chars, total = np.zeros((len(place), 8)), np.zeros(len(place))
        own: list[dict[int, int]] = [{} for _ in place]
        for lang, kind, code, n in rows:
            if kind == 0:
                chars[place[lang], code] = n
            elif kind == 1:
                own[place[lang]][int(np.searchsorted(self.words, np.int64(code).view(np.uint64)))] = n
            else:
                total[place[lang]] = n
        self.chars = chars / np.maximum(chars.sum(axis=1, keepdims=True), 1)
        self.own = [np.array(list(x), dtype=np.int64) for x in own]
        self.share = [np.array([*x.values(), t - sum(x.values())]) / max(t, 1) for x, t in zip(own, total, strict=True)]

    def nearest_chars(self, counts: np.ndarray) -> np.ndarray:
        """Distance to the nearest language by character classes; 1 without any."""
        p = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
        return np.min([divergence(p, q[None, :]) for q in self.chars] + [np.ones(len(p))], axis=0)

    def nearest_words(self, hashes: np.ndarray, owner: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        """Distance to the nearest language by words, given the word hashes of texts; 1 without any language."""
        place = np.searchsorted(self.words, hashes)
        known = place < len(self.words)
        known[known] = self.words[place[known]] == hashes[known]
        seen, column = np.unique(place[known], return_inverse=True)
        counts = np.bincount(owner[known] * (len(seen) + 1) + column, minlength=len(n_words) * (len(seen) + 1)).reshape(len(n_words), -1)
        p = counts / np.maximum(n_words, 1)[:, None]
        common = p.sum(axis=1)
        best = np.ones(len(n_words))
        for own, share in zip(self.own, self.share, strict=True):
            at = np.searchsorted(seen, own)
            held = at < len(seen)
            held[held] = seen[at[held]] == own[held]
            mine = p[:, np.where(held, at, len(seen))]  # the last column is empty
            far = common - mine.sum(axis=1)  # words of other languages
            both = np.column_stack([mine, np.where(n_words > 0, 1 - common, 0), far])
            best = np.minimum(best, divergence(np.maximum(both, 0), np.append(share, 0)[None, :]))
        return best


def _repeated_words(hashes: np.ndarray, bounds: np.ndarray, width: int = 5) -> np.ndarray:
    """Words per text in windows of ``width`` words that the text holds twice or more."""
    at, owner = tokens.windows_within(bounds, width)
    if not len(at):
        return np.zeros(len(bounds) - 1, dtype=np.int64)
    h = tokens.mix(tokens.window_hash(tokens.prefix_hash(hashes), width)[at] + owner.astype(np.uint64))
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    again = np.zeros(len(h), dtype=bool)
    again[order[1:]] |= same
    again[order[:-1]] |= same
    mask = tokens.covered(len(hashes), at[again], width)
    return np.diff(np.concatenate([[0], np.cumsum(mask)])[bounds])


def _judge(ref: _References, limits: tuple):
    least_words, least_chars, word_limit, word_slack, char_limit = limits
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), ("base_failed", pa.bool_()),
        ("kept", pa.bool_()), ("char_distance", pa.float64()), ("word_distance", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in tokens.Texts(batch["text"]).chunks():
                hashes, bounds = tokens.words(texts)
                n_words, classes = np.diff(bounds), _class_counts(texts)
                repeated = _repeated_words(hashes, bounds)
                lines = np.array([_repeated_lines(t) for t in texts], dtype=np.int64)
                folded, _ = tokens.words(texts, lower=True)
                words = ref.nearest_words(folded, np.repeat(np.arange(len(texts)), n_words), n_words)
                chars = ref.nearest_chars(classes)
                failed = (n_words < 10) | (100 * repeated > 20 * n_words)
                total = classes.sum(axis=1)
                limit = word_limit + word_slack / np.sqrt(np.maximum(n_words, 1))
                far = ((n_words >= least_words) & (words > limit)) | ((total >= least_chars) & (chars > char_limit))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(a, b - a), *map(pa.array, (
                        n_words, total - classes[:, 3], classes[:, 5], lines, repeated, failed, ~failed & ~far,
                        chars, words))], schema=schema)
    return run


def _repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", common: int = 64,
            least_words: int = 50, least_chars: int = 300, word_limit: float = 0.3,
            word_slack: float = 1.3, char_limit: float = 0.28) -> DataFrame:
    """Counts and verdict per row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+``. Returns ``doc_id``, ``n_words``, ``word_chars`` (code points in
    words), ``n_symbols`` (of ``#*$%&|<>``), ``n_dup_lines``, ``n_repeat_words``, ``base_failed`` (fewer than
    10 words, or over 20 % in repeated 5-word windows), ``kept`` (not failed, and near enough to some
    language), ``char_distance`` and ``word_distance``. Texts under ``least_words`` words or
    ``least_chars`` characters are not judged by the distance concerned. A sample of n words strays by
    some 1/sqrt(n) of itself, so the word limit is ``word_limit + word_slack / sqrt(n)``. ``lang`` serves the references
    only; without any reference both distances are 1. Null and empty texts have no words and fail.
    Repeated rows are judged alike. An empty table gives an empty result; other columns are ignored.
    """
    found = [tuple(r) for r in references(docs, text, lang, common).collect()]  # ``common + 9`` rows a language
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_judge(_References(found), (least_words, least_chars, word_limit, word_slack,
                                                      char_limit)),
                           "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                           "n_repeat_words long, base_failed boolean, kept boolean, char_distance double, "
                           "word_distance double")
