"""Toxicity by subword-bag embeddings.

A word is the average of the embeddings of its character n-grams (byte runs of 3 to 5 with the word's edges, and
the whole word), hashed into a table; a passage is the average of its words; a linear softmax maps it to clean or
toxic. Table and softmax are trained together in numpy. An unseen misspelling shares most n-grams with the word it
hides, and so its vector. A few insults would vanish in the average of a long text, so texts are cut into passages of
about ``PASSAGE`` words and a text scores as its most toxic passage; in training, passages of a text are weighted by
a softmax over their logits that sharpens from step to step.

Scale: fitted on the driver on at most ``sample_rows`` labelled rows (a fixed bound; which ones follows a hash of the
identifier), of which those over ``longest`` bytes are left out. With two classes the model reduces to one number per
n-gram, a table that travels with the code. Every text is then scored by itself, in whole, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import tables, tokens

GRAMS = (3, 4, 5)
PASSAGE = 6
SPACE = b" "
# Capitals A-Z are folded; blanks, other control characters and the points between words become blanks.
_FOLD = bytes(32 if b <= 32 or b in b".,;:!?\"()[]{}<>|" else b + 32 if 65 <= b <= 90 else b for b in range(256))


def word_grams(folded: bytes, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the n-grams of all words of a folded text, the word of each, and where words begin.

    ``folded`` begins and ends with a blank.
    """
    data = np.frombuffer(folded, dtype=np.uint8)
    blank = data == 32
    starts, ends = tokens.word_spans(data)
    prefix = tokens.prefix_hash(tokens.byte_codes(data))
    blanks = np.concatenate([[0], np.cumsum(blank)])
    begins = np.zeros(len(data), dtype=np.int64)
    begins[starts] = 1
    word = np.cumsum(begins) - 1
    mask = np.uint64(size - 1)
    buckets, owners = [(tokens.span_hash(prefix, starts, ends) & mask).astype(np.int64)], [np.arange(len(starts))]
    for n in GRAMS:
        at = np.arange(max(len(data) - n + 1, 0))
        at = at[blanks[at + n - 1] == blanks[at + 1]]  # no blank but at the edges
        buckets.append((tokens.window_hash(prefix, n)[at] & mask).astype(np.int64))
        owners.append(word[at + 1])
    return np.concatenate(buckets), np.concatenate(owners), starts


def passages(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Passage of every word when texts of ``counts`` words are cut evenly, and the first passage of each text."""
    pieces = -(-counts // PASSAGE)
    first = np.concatenate([[0], np.cumsum(pieces)])
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return first[owner] + place * pieces[owner] // np.maximum(counts[owner], 1), first


class ToxicityModel(NamedTuple):
    """Logit of toxic over clean: of each n-gram bucket, and of an empty text."""

    weight: np.ndarray
    bias: float

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chance of being toxic per text; and first word and number of words of its most toxic passage."""
        folded = [t.translate(_FOLD) for t in texts]
        buckets, owner, starts = word_grams(SPACE + SPACE.join(folded) + SPACE, len(self.weight))
        n = len(starts)
        of_word = np.bincount(owner, self.weight[buckets], n) / np.maximum(np.bincount(owner, minlength=n), 1)
        offsets = 1 + np.cumsum([0, *(len(t) + 1 for t in folded)])
        counts = np.diff(np.searchsorted(starts, offsets))
        passage, first = passages(counts)
        words = np.bincount(passage, minlength=first[-1])
        logit = np.bincount(passage, of_word, first[-1]) / np.maximum(words, 1)
        top, at, size = np.zeros(len(texts)), np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
        begin = np.cumsum(words) - words
        for i in np.flatnonzero(counts):
            best = first[i] + int(np.argmax(logit[first[i]:first[i + 1]]))
            top[i], at[i], size[i] = logit[best], begin[best] - begin[first[i]], words[best]
        return 1 / (1 + np.exp(-np.clip(top + self.bias, -60, 60))), at, size


def train(texts: list[bytes], toxic: np.ndarray, size: int = 1 << 17, dim: int = 8, steps: int = 160, least: int = 5, sure: float = 4.0,
          balance: float = 0.4, rate: float = 0.1, decay: float = 1e-5, seed: int = 42) -> ToxicityModel:
    """Train embeddings and softmax on whole texts.

    N-grams that stand in fewer than ``least`` texts, or not more often in toxic texts by ``sure`` standard errors, stay at
    zero: without that the model learns its sample by heart. ``balance`` is the toxic texts' share of the loss.
    """
    none = ToxicityModel(np.zeros(size, dtype=np.float32), -np.log((np.sum(toxic == 0) + 1) / (np.sum(toxic == 1) + 1)))
    if not (toxic == 1).any() or not (toxic == 0).any():
        return none
    known: dict[bytes, int] = {}
    token = [np.array([known.setdefault(w, len(known)) for w in t.translate(_FOLD).split(SPACE) if w], dtype=np.int32) for t in texts]
    counts = np.array([len(t) for t in token])
    if not counts.any():
        return none
    passage, first = passages(counts)
    passage = passage.astype(np.int32)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    words = np.bincount(passage, minlength=first[-1])
    buckets, of_word, _ = word_grams(SPACE + SPACE.join(known) + SPACE, size)
    order = np.argsort(of_word, kind="stable")
    buckets, of_word = buckets[order], of_word[order]
    edge = np.searchsorted(of_word, np.arange(len(known) + 1))
    n_grams = np.diff(edge)
    seen = np.zeros((2, size))
    for t, kind in zip(token, toxic, strict=True):
        own = np.unique(t)
        at = np.repeat(edge[own] - np.cumsum(n_grams[own]) + n_grams[own], n_grams[own]) + np.arange(n_grams[own].sum())
        seen[kind, np.unique(buckets[at])] += 1
    token = np.concatenate(token)
    total = np.array([[np.sum(toxic == 0)], [np.sum(toxic == 1)]])
    overall = seen.sum(axis=0) / total.sum()
    error = np.sqrt(np.maximum(overall * (1 - overall), 1e-12) * (1 / total).sum())
    active = np.flatnonzero((seen.sum(axis=0) >= least) & (np.diff(seen / total, axis=0)[0] > sure * error))
    place = np.full(size, -1)
    place[active] = np.arange(len(active))
    live = place[buckets] >= 0
    gram, of_word = place[buckets[live]], of_word[live]

    rng = np.random.Generator(np.random.PCG64(seed))
    table = rng.normal(0, 0.1, (len(active), dim))
    softmax = rng.normal(0, 0.5, (dim, 2))
    bias = np.zeros(2)
    filled = counts > 0
    share = np.where(toxic == 1, balance / max(1, (toxic[filled] == 1).sum()), (1 - balance) / max(1, (toxic[filled] == 0).sum()))
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (table, softmax, bias)]
    for step in range(1, steps + 1):
        side = softmax[:, 1] - softmax[:, 0]
        worth = np.bincount(of_word, (table @ side)[gram], len(known)) / n_grams
        logit = np.bincount(passage, worth[token], first[-1]) / np.maximum(words, 1) + bias[1] - bias[0]
        peak = np.full(len(texts), -np.inf)
        np.maximum.at(peak, owner, logit)
        part = np.exp(min(8.0, 0.1 * step) * (logit - peak[owner]))
        part /= np.bincount(owner, part, len(texts))[owner]
        whole = np.bincount(owner, part * logit, len(texts))
        slope = (1 / (1 + np.exp(-np.clip(whole, -60, 60))) - toxic) * share
        of_passage = part * slope[owner]
        pull = np.bincount(token, (of_passage / np.maximum(words, 1))[passage], len(known)) / n_grams
        of_gram = np.bincount(gram, pull[of_word], len(active))
        grown = table.T @ of_gram
        total = of_passage.sum()
        slopes = (np.outer(of_gram, side) + decay * table, np.stack([-grown, grown], axis=1) + decay * softmax,
                  np.array([-total, total]))
        for value, slope_of, (mean, square) in zip((table, softmax, bias), slopes, moments, strict=True):
            mean += 0.1 * (slope_of - mean)
            square += 0.01 * (slope_of ** 2 - square)
            value -= rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    weight = np.zeros(size, dtype=np.float32)
    weight[active] = table @ (softmax[:, 1] - softmax[:, 0])
    return ToxicityModel(weight, float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic",
        sample_rows: int = 6000, longest: int = 1 << 16, seed: int = 42) -> ToxicityModel:
    """Fit on the texts of at most ``sample_rows`` labelled identifiers, a third of them toxic where there are so many.

    Labels other than 0 and 1 and null identifiers do not count; of several labels the worst does. Of several texts under
    one identifier the one with the smallest digest is taken. Texts over ``longest`` bytes are left out of the sample.
    Without labels of both kinds the model knows only how frequent they are.
    """
    given = (labels.where(F.col(toxic).isin(0, 1) & F.col(doc_id).isNotNull())
             .groupBy(F.col(doc_id).cast("long").alias("key")).agg(F.max(F.col(toxic).cast("int")).alias("bad")))
    order = F.xxhash64(F.lit(seed), "key")
    chosen = given.where("bad = 1").orderBy(order, "key").limit(sample_rows // 3).unionByName(
        given.where("bad = 0").orderBy(order, "key").limit(sample_rows - sample_rows // 3))
    picked = docs.sparkSession.createDataFrame([tuple(r) for r in chosen.collect()], "key long, bad int")
    rows = docs.select(tables.key_of(doc_id).alias("key"), F.col(text).cast("string").alias("text")).where(
        F.octet_length("text") <= longest)
    sample = (rows.join(F.broadcast(picked), "key").groupBy("key").agg(
        F.min_by(F.struct("text", "bad"), F.md5(F.col("text").cast("binary"))).alias("row")).select("key", "row.*").collect())
    sample.sort(key=lambda r: r["key"])
    return train([r["text"].encode("utf-8", "surrogatepass") for r in sample], np.array([r["bad"] for r in sample], dtype=np.int64),
                 seed=seed)


def score(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``score`` (chance of being toxic), ``worst_start`` and ``worst_words`` (the most toxic passage, in words).

    Only texts count. Null and empty texts get the score of an empty text and an empty passage; equal texts score alike;
    of equally toxic passages the first is named. An empty table gives an empty result; other columns are ignored.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("worst_start", pa.int64()), ("worst_words", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in tokens.Texts(batch["text"]).chunks():
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(a, b - a), *map(pa.array, model.score(texts))], schema=schema)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, worst_start long, worst_words long")
