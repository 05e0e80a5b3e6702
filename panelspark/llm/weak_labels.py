"""Quality classifier from weak labels.

Several heuristic labellers vote on every document: bad, fine, or no opinion. They overlap and err, so
expectation-maximisation estimates from the vote patterns of the whole corpus how often each labeller
is right, without knowing the truth. The posterior of a document's votes is its training label for a
linear scorer over hashed features, which then scores every document by its text alone. Two such
models run side by side: one for junk, one for abuse; a document is rejected when either says so.

Scale: votes are taken in one pass; all that leaves the tasks is a count per vote pattern (at most
3**labellers). Markers of abuse and the scorer are fitted on a sample of ``sample_rows`` rows, a bound that
does not depend on the corpus. Features are 64-bit hashes, weights of those that matter travel with the
code. Scoring is a second pass over the texts, without shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import tables, tokens

FINE, BAD, NONE = 0, 1, 2
# Two overlapping word lists of insults, as two people might have written them down.
BLUNT = ("idiot", "moron", "stupid", "scum", "loser", "imbecile", "trash")
CONTEMPT = ("worthless", "pathetic", "disgusting", "trash", "scum", "clown", "vermin")
JUNK_LABELLERS = ("strict", "loose", "marks", "variety", "given")
ABUSE_LABELLERS = ("blunt", "contempt", "markers", "given")
# Bytes of a word's beginning that count as features beside the whole word.
STEMS = (4, 5, 6)
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&<>")] = True
_POINT = np.zeros(256, dtype=bool)  # ends a word for the features
_POINT[list(b"#*$%&<>|!?.,;:()[]{}\"'")] = True
_STYLE = 8  # steps of a style measure


def _style(texts: list[bytes]) -> np.ndarray:
    """Style measures of every text (0 to 1).

    Measures: symbols and bars per word, capitals per letter, share of words seen before, share of words in
    repeated runs of three.
    """
    hashes, bounds = tokens.words(texts, lower=True)
    n = np.maximum(np.diff(bounds), 1)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])])

    def per_text(mask: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(mask)])[ends])

    upper, lower = per_text((data >= 65) & (data <= 90)), per_text((data >= 97) & (data <= 122))
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))

    def seen_before(h: np.ndarray, of: np.ndarray) -> np.ndarray:
        first = np.unique(tokens.mix(h ^ tokens.mix(of.astype(np.uint64))), return_index=True)[1]
        return np.bincount(of, minlength=len(texts)) - np.bincount(of[first], minlength=len(texts))

    at, of = tokens.windows_within(bounds, 3)
    runs = tokens.window_hash(tokens.prefix_hash(hashes), 3)[at] if len(at) else np.zeros(0, np.uint64)
    bars = per_text(data == ord("|"))
    return np.stack([np.minimum(per_text(_SYMBOL[data]) / n / 3, 1), upper / np.maximum(upper + lower, 1),
                     seen_before(hashes, owner) / n, seen_before(runs, of) / n, np.minimum(bars / n, 1)], axis=1)


def _features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of every text with their owners, and the style measures.

    Features are words in lower case without punctuation, stems of words, and the steps of the style
    measures; each counts once a text.
    """
    style = _style(texts)
    buffer = tokens.lower_ascii(np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8))
    buffer = np.where(_POINT[buffer], np.uint8(32), buffer)
    starts, ends = tokens.word_spans(buffer)
    prefix = tokens.prefix_hash(tokens.byte_codes(buffer))
    owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
    found, of = [tokens.span_hash(prefix, starts, ends)], [owner]
    for k in STEMS:
        long = starts + k < ends
        found.append(tokens.mix(tokens.span_hash(prefix, starts[long], starts[long] + k) + np.uint64(k)))
        of.append(owner[long])
    steps = np.minimum((style * _STYLE).astype(np.int64), _STYLE - 1)
    for j in range(style.shape[1]):
        found.append(tokens.mix((steps[:, j] + 1000 * (j + 1)).astype(np.uint64)))
        of.append(np.arange(len(texts)))
    return np.concatenate(found), np.concatenate(of), style


def word_codes(words: tuple[str, ...]) -> np.ndarray:
    return np.sort(tokens.words([w.encode() for w in words])[0])


def _holds(features: np.ndarray, owner: np.ndarray, known: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` texts have one of the known features."""
    if not len(known):
        return np.zeros(n, dtype=bool)
    at = np.minimum(np.searchsorted(known, features), len(known) - 1)
    return np.bincount(owner[known[at] == features], minlength=n) > 0


def _three(bad: np.ndarray, fine: np.ndarray) -> np.ndarray:
    return np.where(bad, BAD, np.where(fine, FINE, NONE))


def votes(features: np.ndarray, owner: np.ndarray, style: np.ndarray, n_words: np.ndarray,
          markers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Votes of all labellers but the given labels, one row a text: on junk, and on abuse.

    On junk, ``strict`` and ``loose`` look at everything, ``marks`` at symbols, bars and capitals, and ``variety``
    at repetition. Labellers for single defects only would not agree on what bad means: defects exclude each other.
    """
    symbols, capitals, again, runs, bars = style.T
    enough = n_words >= 20
    marks = (symbols > 0.1) | (bars > 0.2) | (enough & (capitals > 0.3))
    dull = enough & ((again > 0.8) | (runs > 0.4))
    soft = (symbols > 0.05) | (bars > 0.1) | (enough & ((capitals > 0.25) | (again > 0.75) | (runs > 0.3)))
    junk = np.stack([_three(marks | dull, ~(marks | dull)), _three(soft, ~soft), _three(marks, symbols + bars < 0.02),
                     _three(dull, np.zeros(len(style), dtype=bool))], axis=1)
    n = len(style)
    hit = [_holds(features, owner, k, n) for k in (word_codes(BLUNT), word_codes(CONTEMPT), markers)]
    return junk, np.stack([np.where(h, BAD, FINE if len(k) else NONE) for h, k in zip(
        hit, (BLUNT, CONTEMPT, markers), strict=True)], axis=1)


@dataclass
class LabelModel:
    """Share of bad documents, and the chance of each vote of each labeller given the truth."""

    prior: float
    chance: np.ndarray  # truth, labeller, vote

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of bad for rows of votes."""
        at = np.arange(patterns.shape[1])
        odds = np.log(self.chance[1][at, patterns] / self.chance[0][at, patterns]).sum(axis=1)
        return 1 / (1 + (1 - self.prior) / self.prior * np.exp(-np.clip(odds, -500, 500)))


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100, trusted: float = 0.98) -> LabelModel:
    """Expectation-maximisation over vote patterns, started from any bad vote outweighing fine ones.

    The last labeller, the given labels, is right in a share ``trusted`` of its votes. Without that anchor
    the likelihood may split the corpus by whichever two labellers depend on each other most.
    """
    bad, fine = (patterns == BAD).sum(axis=1), (patterns == FINE).sum(axis=1)
    p = np.where(bad > 0, 0.9, np.where(fine > 0, 0.05, 0.1))
    model = LabelModel(0.1, np.full((2, patterns.shape[1], 3), 1 / 3))
    one = np.eye(3)[patterns]
    for _ in range(rounds):
        weight = np.stack([(1 - p) * counts, p * counts])
        total = weight.sum(axis=1)
        model = LabelModel(float(np.clip((total[1] + 1) / (total.sum() + 2), 1e-6, 1 - 1e-6)),
                           (np.einsum("tp,plv->tlv", weight, one) + 0.1) / (total[:, None, None] + 0.3))
        silent = (counts * (patterns[:, -1] == NONE)).sum() / max(counts.sum(), 1)
        silent = min(max(silent, 0.01), 0.99)
        for truth in (FINE, BAD):
            model.chance[truth, -1] = (1 - silent) * (1 - trusted)
            model.chance[truth, -1, truth], model.chance[truth, -1, NONE] = (1 - silent) * trusted, silent
        new = model.posterior(patterns)
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    return model


@dataclass
class Sample:
    """Sample rows: features that at least ``least`` rows have, as positions in ``names``, with their owners."""

    names: np.ndarray
    at: np.ndarray
    owner: np.ndarray
    n: int

    @classmethod
    def of(cls, rows: list[np.ndarray], least: int = 5) -> Sample:
        flat = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
        flat.sort()
        edge = np.flatnonzero(np.diff(flat, prepend=~flat[:1]) != 0) if len(flat) else np.zeros(0, np.int64)
        names = flat[edge[np.diff(edge, append=len(flat)) >= least]]
        del flat
        at, owner = [], []
        for i, row in enumerate(rows if len(names) else []):
            place = np.minimum(np.searchsorted(names, row), len(names) - 1)
            at.append(place[names[place] == row].astype(np.int32))
            owner.append(np.full(len(at[-1]), i, dtype=np.int32))
        none = [np.zeros(0, np.int32)]
        return cls(names, np.concatenate(at or none), np.concatenate(owner or none), len(rows))

    def counts(self, weight: np.ndarray) -> np.ndarray:
        """Per feature the sum of a weight of its rows."""
        return np.bincount(self.at, weight[self.owner], minlength=len(self.names))


def fit_scorer(sample: Sample, target: np.ndarray, sure: float = 4.0, rounds: int = 800, penalty: float = 1e-4,
               rate: float = 6.0) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic regression on the presence of hashed features; target values lie between 0 and 1.

    Features whose share of bad rows lies within ``sure`` standard errors of the overall share are left out.
    Full-batch steps with a rate per weight. Returns sorted features, weights and bias.
    """
    if not sample.n:
        return np.zeros(0, np.uint64), np.zeros(0), -10.0
    share = np.clip(target.mean(), 1e-3, 1 - 1e-3)
    n, bad = sample.counts(np.ones(sample.n)), sample.counts(target)
    keep = np.abs(bad - n * share) > sure * np.sqrt(n * share * (1 - share))
    known, names = keep[sample.at], sample.names[keep]
    at, owner = (np.cumsum(keep) - 1)[sample.at[known]], sample.owner[known]
    w, square, bias, bias_square = np.zeros(len(names)), np.full(len(names), 1e-12), np.log(share / (1 - share)), 1e-12
    scale = rate / max(1.0, np.sqrt(len(at) / sample.n))
    for _ in range(rounds):
        z = np.bincount(owner, w[at], minlength=sample.n) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - target) / sample.n
        g = np.bincount(at, error[owner], minlength=len(names)) + penalty * w / sample.n
        square += g * g
        w -= scale * g / np.sqrt(square)
        bias_square += error.sum() ** 2
        bias -= scale * error.sum() / np.sqrt(bias_square)
    return names, w, float(bias)


def markers_of(sample: Sample, given: np.ndarray, least: int = 6, purity: float = 0.95) -> np.ndarray:
    """Features that stand almost only in documents given as bad."""
    bad, fine = sample.counts((given == BAD).astype(float)), sample.counts((given == FINE).astype(float))
    return sample.names[(bad >= least) & (bad >= purity * (bad + fine))]


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("key", pa.int64()), ("n_words", pa.int64()), ("style", pa.list_(pa.float64())), ("features", pa.binary())])
    for batch in batches:
        keys = batch["key"].to_pylist()
        for a, b, texts in tokens.Texts(batch["text"]).chunks():
            features, owner, style = _features(texts)
            order = np.lexsort((features, owner))
            features, owner = features[order], owner[order]
            cut = np.searchsorted(owner, np.arange(b - a + 1))
            n = [len(t.split()) for t in texts]
            yield tokens.batch(schema, [(keys[a + i], n[i], style[i], np.unique(features[cut[i]:cut[i + 1]]).tobytes())
                                        for i in range(b - a)])


def _cast_votes(markers: np.ndarray):
    schema = pa.schema([("key", pa.int64()), ("junk", pa.int32()), ("abuse", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in tokens.Texts(batch["text"]).chunks():
                features, owner, style = _features(texts)
                n = np.array([len(t.split()) for t in texts])
                packed = [(v * 3 ** np.arange(v.shape[1])).sum(axis=1).astype(np.int32)
                          for v in votes(features, owner, style, n, markers)]
                yield pa.RecordBatch.from_arrays([batch["key"].slice(a, b - a), *map(pa.array, packed)], schema=schema)
    return run


def _unpacked(code: np.ndarray, given: np.ndarray, labellers: tuple[str, ...]) -> np.ndarray:
    rest = code[:, None] // 3 ** np.arange(len(labellers) - 1) % 3
    return np.concatenate([rest, given[:, None]], axis=1)


@dataclass
class QualityModel:
    """Sorted features with their weights for junk and abuse, and the two biases."""

    features: np.ndarray
    weights: np.ndarray  # feature, model
    bias: np.ndarray
    accuracy: dict[str, float]

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Probability of junk and of abuse for every text."""
        features, owner, _ = _features(texts)
        z = np.repeat(self.bias[None, :], len(texts), axis=0)
        if len(self.features):
            at = np.minimum(np.searchsorted(self.features, features), len(self.features) - 1)
            known = self.features[at] == features
            pair = np.unique(owner[known] * len(self.features) + at[known])
            for m in range(2):
                z[:, m] += np.bincount(pair // len(self.features), self.weights[pair % len(self.features), m],
                                       minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality",
        toxic: str = "toxic", sample_rows: int = 8000, seed: int = 42) -> QualityModel:
    """Fit label models on the votes of all documents, and scorers on a sample of ``sample_rows`` rows.

    Three quarters of the sample are labelled rows, where there are so many; the choice follows a hash of the
    identifier. Labels are one labeller among the others: 0 in ``quality`` and 1 in ``toxic`` vote bad, null is no
    opinion; of several rows for one document the worst counts. Without labels the heuristics decide alone.
    """
    key = tables.key_of(doc_id).alias("key")
    rows = docs.select(key, F.col(text).cast("string").alias("text"))
    given = labels.select(key, (1 - F.col(quality).cast("int")).alias("bad_quality"), F.col(toxic).cast("int").alias("toxic"))
    given = given.groupBy("key").agg(*[F.coalesce(F.max(F.when(F.col(c).isin(0, 1), F.col(c))), F.lit(NONE)).alias(c)
                                       for c in ("bad_quality", "toxic")])
    order = F.xxhash64(F.lit(seed), "key")
    labelled = given.orderBy(order, "key").limit(3 * sample_rows // 4)
    picked = labelled.select("key").unionByName(rows.select("key").orderBy(order, "key").limit(sample_rows // 4)).distinct()
    picked = sorted(r["key"] for r in picked.collect())  # at most ``sample_rows`` identifiers
    chosen = docs.sparkSession.createDataFrame([(k,) for k in picked], "key long")
    # of several texts under one identifier the one with the smallest digest, so reruns agree
    sample = (rows.join(F.broadcast(chosen), "key").groupBy("key").agg(F.min_by("text", F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("text"))
              .mapInArrow(_sample_features, "key long, n_words long, style array<double>, features binary")
              .join(labelled, "key", "left")
              .select("key", "n_words", "style", "features", *[F.coalesce(c, F.lit(NONE)).alias(c) for c in ("bad_quality", "toxic")])
              .collect())
    sample.sort(key=lambda r: r["key"])
    held = [np.frombuffer(r["features"], np.uint64) for r in sample]
    few = Sample.of(held)
    marks = markers_of(few, np.array([r["toxic"] for r in sample], dtype=np.int64))

    counts = (rows.mapInArrow(_cast_votes(marks), "key long, junk int, abuse int").join(given, "key", "left")
              .groupBy("junk", "abuse", F.coalesce("bad_quality", F.lit(NONE)).alias("bad_quality"),
                       F.coalesce("toxic", F.lit(NONE)).alias("toxic"))
              .agg(F.count(F.lit(1)).alias("n")).collect())
    counts = sorted(tuple(r) for r in counts)
    table = np.array(counts, dtype=np.int64).reshape(-1, 5)
    accuracy, fitted = {}, []
    mine = [[], []]
    for a in range(0, len(held), 200):
        part = sample[a:a + 200]
        cast = votes(np.concatenate(held[a:a + 200]), np.repeat(np.arange(len(part)), [len(h) for h in held[a:a + 200]]),
                     np.array([r["style"] for r in part]), np.array([r["n_words"] for r in part]), marks)
        for m in range(2):
            mine[m].append(cast[m])
    for m, (labellers, label) in enumerate(((JUNK_LABELLERS, "bad_quality"), (ABUSE_LABELLERS, "toxic"))):
        if not len(held):
            fitted.append(fit_scorer(few, np.zeros(0)))
            continue
        model = fit_label_model(_unpacked(table[:, m], table[:, 2 + m], labellers), table[:, 4])
        for j, name in enumerate(labellers):
            said = model.chance[:, j, :2]
            right = (1 - model.prior) * said[0, FINE] + model.prior * said[1, BAD]
            accuracy[f"{('junk', 'abuse')[m]}_{name}"] = float(right / ((1 - model.prior) * said[0].sum() + model.prior * said[1].sum()))
        mine_given = np.array([r[label] for r in sample], dtype=np.int64)
        target = model.posterior(np.concatenate([np.concatenate(mine[m]), mine_given[:, None]], axis=1))
        fitted.append(fit_scorer(few, target))
    features = np.unique(np.concatenate([f[0] for f in fitted]))
    weights = np.zeros((len(features), 2))
    for m, (names, w, _) in enumerate(fitted):
        weights[np.searchsorted(features, names), m] = w
    return QualityModel(features, weights, np.array([f[2] for f in fitted]), accuracy)


def score(docs: DataFrame, model: QualityModel, text: str = "text", limit: float = 0.5) -> DataFrame:
    """``docs`` with columns ``junk_score``, ``abuse_score`` and ``kept`` (both below ``limit``).

    These replace columns of the same names; rows and all other columns stay. Null and empty texts hold no
    evidence beyond their emptiness and get the score of an empty text. Equal texts get equal scores.
    """
    added = ("junk_score", "abuse_score", "kept")
    kept = docs.drop(*added)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.concatenate([model.scores(texts) for _, _, texts in tokens.Texts(batch[text].cast(pa.string())).chunks()]
                               or [np.zeros((0, 2))])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p[:, 0]), pa.array(p[:, 1]),
                                              pa.array((p < limit).all(axis=1))], names=[*batch.schema.names, *added])

    return kept.mapInArrow(run, f"{schema}, junk_score double, abuse_score double, kept boolean")
