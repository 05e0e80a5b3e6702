"""Gradient boosted trees with an L2 leaf penalty, on histograms of binned features.

Every round grows one tree level by level. For each node, feature and bin the sums of residuals (first order) and of
rows (second order, squared error) are counted where the rows are, then added up over all tasks; the best split
of a node by regularised gain follows from those sums alone. Columns are drawn per tree, rows per tree by a hash of
their key.

Scale: features are binned once at quantiles of one mergeable sketch each, one byte a value; only histograms move,
``max_bins`` cells a feature and node, the larger child of every split being the parent less its sibling. Up to
``ROWS_ALONE`` rows one task grows ``chunk`` trees at a time. Beyond that the rows stay cached in as many partitions as the
session has cores, and every level is one job over what the drawn rows of the tree need (a byte a drawn feature and the
residual); the driver adds up one histogram a partition. A task reads its partition block by block, so its memory does
not grow with the rows. Predictions are brought up to date every ``FOLD`` trees and written to the shared folder
after every chunk: a lost executor costs one chunk.

Residuals are rounded to a fixed resolution and summed as integers, which is exact in any order: the model depends on
rows, keys and parameters, not on partitions, tasks or files.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions import fixed_values as fv
from panelspark.operators import trees
from panelspark.runtime import materialize

# Rows of a binned block.
BLOCK_ROWS = 1 << 16
# Up to so many rows one task is quicker than a job a level; beyond, a task has ``ROWS_PER_TASK`` at least.
ROWS_ALONE, ROWS_PER_TASK = 1 << 20, 1 << 19
# Trees after which the stored predictions are brought up to date.
FOLD = 4
_BLOCK = pa.schema([("kind", pa.string()), ("round", pa.int32()), ("data", pa.binary())])
METRICS = ("rmse", "mae", "r2", "mape")


class Boosted(NamedTuple):
    """``nodes``: the trees as a table (see ``panelspark.operators.trees``); ``rounds``: metrics of the validation rows after
    each round (empty without such rows); a prediction is ``base`` plus the values of all trees."""

    nodes: DataFrame
    rounds: DataFrame
    base: float
    features: list[str]


class Settings(NamedTuple):
    """What a round needs to know; ``cuts`` are the upper bounds of all bins but the last, by feature."""

    cuts: list[np.ndarray]
    depth: int
    step: float
    rows: float
    columns: float
    l2: float
    least_gain: float
    least_rows: int
    seed: int
    unit: float

    @property
    def bins(self) -> int:
        return max(len(c) for c in self.cuts) + 1


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def drawn_rows(keys: np.ndarray, tree: int, s: Settings) -> np.ndarray:
    """Rows that take part in a tree, by a hash of their key."""
    if s.rows >= 1:
        return np.ones(len(keys), dtype=bool)
    salt = _mixed(np.array([(s.seed << 32) + tree], dtype=np.uint64))
    return _mixed(keys ^ salt) < np.uint64(min(int(s.rows * 2.0 ** 64), 2 ** 64 - 1))


def drawn_columns(tree: int, s: Settings) -> np.ndarray:
    """Features that take part in a tree, in order."""
    n = len(s.cuts)
    k = max(1, int(s.columns * n))
    return np.sort(np.random.Generator(np.random.PCG64([s.seed, tree])).permutation(n)[:k])


class Drawn(NamedTuple):
    """What a tree needs to know of the rows it draws from a block: bins of the drawn features and residuals."""

    bins: np.ndarray
    residual: np.ndarray


class Level(NamedTuple):
    """The splits above a level, by node (``feature`` counts the drawn ones, -1: none), and the place of each of its nodes in
    a histogram (-1: not counted)."""

    deep: int
    feature: np.ndarray
    cut: np.ndarray
    slot: np.ndarray
    slots: int


def histogram(rows: Drawn, level: Level, width: int) -> np.ndarray:
    """Sums of residuals and rows by node, sum, feature and bin."""
    bins, residual = rows
    out = np.empty((2, len(bins), level.slots * width))
    base = None
    if level.deep:
        place = (level.slot * width).take(trees.descend(bins, level.feature, level.cut, level.deep), mode="clip")
        at = np.flatnonzero(place >= 0)
        base, residual = place.take(at, mode="clip"), residual.take(at, mode="clip")
    for k, b in enumerate(bins):
        cell = b if base is None else base + b.take(at, mode="clip")
        out[0, k] = np.bincount(cell, residual, level.slots * width)
        out[1, k] = np.bincount(cell, minlength=level.slots * width)
    return out.reshape(2, len(bins), level.slots, width).transpose(2, 0, 1, 3)


def best_splits(cells: np.ndarray, columns: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gain, feature and bin of the best split of every node from its sums; rows in bins up to that go left.

    Equal gains go to the first feature, then the lowest bin. Without a gain over ``least_gain`` the feature is -1.
    """
    left = np.cumsum(cells, axis=3)[:, :, :, :-1]
    whole = cells[:, :, 0].sum(axis=2)[:, :, None, None]
    right = whole - left

    def worth(x):
        g = x[:, 0] * s.unit
        return g * g / (x[:, 1] + s.l2)
    with np.errstate(invalid="ignore", divide="ignore"):
        gain = 0.5 * (worth(left) + worth(right) - worth(whole)) - s.least_gain
    able = (left[:, 1] >= s.least_rows) & (right[:, 1] >= s.least_rows)
    able &= np.arange(gain.shape[2]) < np.array([len(s.cuts[f]) for f in columns])[:, None]
    if not gain.size:
        return np.zeros(len(cells)), np.full(len(cells), -1), np.zeros(len(cells), dtype=np.int64)
    flat = np.where(able, gain, 0.0).reshape(len(cells), -1)
    best = np.argmax(flat, axis=1)
    most = flat[np.arange(len(cells)), best]
    found = most > 0
    return np.where(found, most, 0.0), np.where(found, columns[best // gain.shape[2]], -1), np.where(found, best % gain.shape[2], 0)


def grow(tree: int, s: Settings, count: Callable[[Level], np.ndarray]) -> np.ndarray:
    """One tree: its nodes ``(node, feature, bin, value, gain, cover)``.

    ``count`` gives the histogram of a level over all rows. Nodes count from 1, the children of n are 2n and 2n + 1.
    """
    columns, width = drawn_columns(tree, s), s.bins
    of_feature, of_cut = np.full(2 << s.depth, -1), np.zeros(2 << s.depth, dtype=np.int64)
    told = []
    ids = np.ones(1, dtype=np.int64)
    cells = count(Level(0, of_feature, of_cut, np.array([-1, 0]), 1))
    sums = cells[:, :, 0].sum(axis=2)
    for deep in range(s.depth + 1):
        if deep < s.depth:
            gain, feature, cut = best_splits(cells, columns, s)
        else:
            gain, feature, cut = np.zeros(len(ids)), np.full(len(ids), -1), np.zeros(len(ids), dtype=np.int64)
        with np.errstate(invalid="ignore"):
            worth = np.where(sums[:, 1] + s.l2 > 0, s.step * ((sums[:, 0] * s.unit) / (sums[:, 1] + s.l2)), 0.0)
        told.append(np.stack([ids, feature, cut, worth, gain, sums[:, 1]], axis=1))
        split = np.flatnonzero(feature >= 0)
        if not len(split):
            break
        place = np.searchsorted(columns, feature[split])
        of_feature[ids[split]], of_cut[ids[split]] = place, cut[split]
        part = cells[split]
        own = part[np.arange(len(split)), :, place]
        left = np.where(np.arange(width) <= cut[split][:, None, None], own, 0).sum(axis=2)
        ids = np.stack([2 * ids[split], 2 * ids[split] + 1], axis=1).reshape(-1)
        sums = np.stack([left, sums[split] - left], axis=1).reshape(-1, 2)
        if deep + 1 < s.depth:  # leaves of the last level need their sums alone
            small = (2 * left[:, 1] > part[:, 1, 0].sum(axis=1)).astype(np.int64)  # the child with fewer rows
            slot = np.full(4 << deep, -1)
            slot[ids.reshape(-1, 2)[np.arange(len(split)), small]] = np.arange(len(split))
            counted = count(Level(deep + 1, of_feature, of_cut, slot, len(split)))
            both = np.empty((len(split), 2, *part.shape[1:]))
            both[np.arange(len(split)), small] = counted
            both[np.arange(len(split)), 1 - small] = part - counted
            cells = both.reshape(-1, *part.shape[1:])
    return np.concatenate(told)


def leaf_values(bins: np.ndarray, nodes: np.ndarray, depth: int) -> np.ndarray:
    """What a tree of ``grow`` says to every row."""
    feature, cut, value = np.full(2 << depth, -1), np.zeros(2 << depth, dtype=np.int64), np.zeros(2 << depth)
    at = nodes[:, 0].astype(np.int64)
    feature[at], cut[at], value[at] = nodes[:, 1], nodes[:, 2], nodes[:, 3]
    return trees.leaves(feature, value, depth)[trees.descend(bins, feature, cut, depth)]


class Leaves:
    """What trees of ``grow`` say to rows, by way of sets of leaves instead of a walk.

    Features are put together to codes of up to ``CODES`` values. A tree has a table a code of the leaves its splits leave
    open, a bit a leaf from the left; the leaf of a row is the lowest bit that all its codes leave.
    """

    CODES, DEEPEST = 1 << 12, 6

    def __init__(self, grown: Iterable[np.ndarray], s: Settings):
        self.width = [len(c) + 1 for c in s.cuts]
        self.groups, size = [], self.CODES + 1
        for f, w in enumerate(self.width):
            if size * w > self.CODES:
                self.groups.append([])
                size = 1
            self.groups[-1].append(f)
            size *= w
        self.trees = [self._tables(nodes, s.depth) for nodes in grown]

    def _tables(self, nodes: np.ndarray, depth: int) -> tuple[list[np.ndarray], np.ndarray]:
        value, feature = np.zeros(2 << depth), np.full(2 << depth, -1)
        at = nodes[:, 0].astype(np.int64)
        feature[at], value[at] = nodes[:, 1], nodes[:, 3]
        every = (1 << (1 << depth)) - 1
        left_open = [np.full(w, every, dtype=np.uint64) for w in self.width]
        for node, f, cut in nodes[nodes[:, 1] >= 0][:, :3].astype(np.int64).tolist():
            below = depth - node.bit_length()  # levels below the children
            first = (2 * node << below) - (1 << depth)
            left_open[f][cut + 1:] &= np.uint64(every & ~(((1 << (1 << below)) - 1) << first))
        codes = []
        for group in self.groups:
            table = np.full(1, every, dtype=np.uint64)
            for f in group:
                table = (table[:, None] & left_open[f]).reshape(-1)
            codes.append(table)
        return codes, trees.leaves(feature, value, depth)[1 << depth:]

    def add(self, bins: np.ndarray, p: np.ndarray) -> None:
        """Add the values of all trees, one after the other."""
        if not self.trees:
            return
        codes = []
        for group in self.groups:
            code = bins[group[0]].astype(np.int64)
            for f in group[1:]:
                code *= self.width[f]
                code += bins[f]
            codes.append(code)
        for tables, value in self.trees:
            still = tables[0].take(codes[0], mode="clip")
            for table, code in zip(tables[1:], codes[1:], strict=True):
                still &= table.take(code, mode="clip")
            lowest = np.negative(still.view(np.int64))
            lowest &= still.view(np.int64)
            # a power of two is exact as a float: its exponent is the place of the bit
            place = lowest.view(np.uint64).astype(np.float64).view(np.int64)
            place >>= 52
            place -= 1023
            p += value.take(place, mode="clip")


def _ready(grown: Iterable[np.ndarray], s: Settings) -> "list[np.ndarray] | Leaves":
    """Trees in the form that is quickest for many rows."""
    return Leaves(grown, s) if s.depth <= Leaves.DEEPEST else list(grown)


def _measured(y: np.ndarray, p: np.ndarray, unit: float) -> np.ndarray:
    """Sums behind the metrics, in whole steps where the rows are many, so that they add up alike in any order."""
    error = y - p
    share = np.abs(error[y != 0] / y[y != 0])
    parts = (error ** 2, np.abs(error), y, y ** 2, share)
    return np.array([len(y), len(share), *(np.floor(x / unit + 0.5).sum() for x in parts)])


def _metrics(sums: np.ndarray, unit: float) -> tuple[float, float, float, float]:
    n, n_share, sse, sae, sy, syy, sape = (float(x) for x in sums)
    spread = syy * unit - (sy * unit) ** 2 / n
    return (math.sqrt(sse * unit / n), sae * unit / n, 1 - sse * unit / spread if spread > 0 else math.nan,
            100 * sape * unit / n_share if n_share else math.nan)


class _Rows(NamedTuple):
    """The rows of a task: bins by feature, label, prediction, hash of the key and whether it is for validation."""

    bins: np.ndarray
    y: np.ndarray
    p: np.ndarray
    key: np.ndarray
    valid: np.ndarray

    @classmethod
    def read(cls, blocks: list[bytes], features: int) -> "_Rows":
        parts = []
        for b in blocks:
            n = len(b) // (features + 25)
            parts.append((np.frombuffer(b, np.uint8, n * features).reshape(features, n),
                          *(np.frombuffer(b, t, n, n * (features + k)) for t, k in ((np.float64, 0), (np.float64, 8), (np.uint64, 16), (np.bool_, 24)))))
        return cls(*(np.concatenate(x, axis=-1) for x in zip(*parts))) if len(parts) > 1 else cls(*parts[0])

    def packed(self) -> bytes:
        return b"".join(np.ascontiguousarray(x).tobytes() for x in self)

    def advanced(self, grown: "list[np.ndarray] | Leaves", depth: int) -> "_Rows":
        """The rows with their predictions after more trees."""
        p = self.p.copy()
        if isinstance(grown, Leaves):
            grown.add(self.bins, p)
        else:
            for nodes in grown:
                p += leaf_values(self.bins, nodes, depth)
        return self._replace(p=p)

    def drawn(self, tree: int, s: Settings) -> Drawn:
        at = np.flatnonzero(drawn_rows(self.key, tree, s) & ~self.valid)
        bins = np.empty((len(columns := drawn_columns(tree, s)), len(at)), dtype=np.uint8)
        for k, f in enumerate(columns.tolist()):
            bins[k] = self.bins[f].take(at, mode="clip")
        residual = self.y.take(at, mode="clip")
        residual -= self.p.take(at, mode="clip")
        residual /= s.unit
        residual += 0.5
        return Drawn(bins, np.floor(residual, out=residual))

    def measured(self, s: Settings) -> np.ndarray:
        return _measured(self.y[self.valid], self.p[self.valid], s.unit)


def _joined(blocks: Iterable[bytes], features: int) -> Iterator[_Rows]:
    """The rows of packed blocks in blocks of ``BLOCK_ROWS`` or somewhat more."""
    held, n = [], 0
    for b in blocks:
        held.append(b)
        n += len(b) // (features + 25)
        if n >= BLOCK_ROWS:
            yield _Rows.read(held, features)
            held, n = [], 0
    if held:
        yield _Rows.read(held, features)


def _binned(features: list[str], cuts: list[np.ndarray], base: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [batch[f].to_numpy(zero_copy_only=False) for f in features]
            # null and NaN sort below all values
            bins = np.array([np.where(np.isnan(v), 0, np.searchsorted(c, v)) for v, c in zip(values, cuts, strict=True)], dtype=np.uint8)
            y = batch["_label"].to_numpy(zero_copy_only=False)
            rows = _Rows(bins, y, np.full(len(y), base), batch["_key"].to_numpy().view(np.uint64), batch["_valid"].to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([pa.array(["block"]), pa.array([0], pa.int32()), pa.array([rows.packed()], pa.binary())], schema=_BLOCK)
    return run


def _round(sums: np.ndarray, s: Settings) -> np.ndarray:
    """Validation rows and their metrics, from the sums of ``_measured``."""
    return np.array([sums[0], *(_metrics(sums, s.unit) if sums[0] else (math.nan,) * 4)])


def _alone(s: Settings, first: int, last: int, patience: int | None, best: tuple[float, int]):
    """Rounds ``first`` to ``last`` on all rows in one task; yields the rows with their predictions, trees and metrics."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = list(_joined((x for b in batches for x, k in zip(b["data"].to_pylist(), b["kind"].to_pylist()) if k == "block"), len(s.cuts)))
        least, at = best
        told = []
        for t in range(first, last + 1):
            drawn = [r.drawn(t, s) for r in rows]
            nodes = grow(t, s, lambda level, drawn=drawn: sum(histogram(d, level, s.bins) for d in drawn))
            known = _ready([nodes], s)
            rows = [r.advanced(known, s.depth) for r in rows]
            told.append(("tree", t, nodes.tobytes()))
            if patience is not None:
                m = _round(sum(r.measured(s) for r in rows), s)
                told.append(("round", t, m.tobytes()))
                least, at = (m[1], t) if m[1] < least else (least, at)
                if t - at >= patience:
                    break
        out = [*(("block", 0, r.packed()) for r in rows), *told]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], _BLOCK.types[i]) for i in range(3)], schema=_BLOCK)
    return run


def _chunks_alone(state: DataFrame, s: Settings, rounds: int, wait: int | None, chunk: int) -> list[tuple[str, int, np.ndarray]]:
    """Trees and metrics of all rounds, ``chunk`` rounds a job of one task."""
    kept, best, done = [], (math.inf, 0), 0
    while done < rounds:
        last = min(done + chunk, rounds)
        state = materialize(state.where("kind = 'block'").coalesce(1).mapInArrow(
            _alone(s, done + 1, last, wait, best), "kind string, round int, data binary"), "boosted")
        told = [(r["kind"], r["round"], np.frombuffer(r["data"])) for r in state.where("kind <> 'block'").collect()]  # trees and metrics of a chunk
        kept += told
        for _, t, m in sorted((r for r in told if r[0] == "round"), key=lambda r: r[1]):
            best = (m[1], t) if m[1] < best[0] else best
        grown = max(r[1] for r in told)
        if grown < last or (wait is not None and grown - best[1] >= wait):
            break
        done = last
    return kept


def _first(drawn: Iterator[tuple[Drawn, np.ndarray]], level: Level, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Histogram of the root and sums of the metrics, of a partition."""
    if not gc.get_freeze_count():  # workers collect garbage after every task; modules need not be looked through each time
        gc.freeze()
    cells, sums = 0, 0
    for d, measured in drawn:
        cells, sums = cells + histogram(d, level, width), sums + measured
    yield cells, sums


def _below(drawn: Iterator[tuple[Drawn, np.ndarray]], level: Level, width: int) -> Iterator[np.ndarray]:
    yield sum(histogram(d, level, width) for d, _ in drawn)


def _cached(state: DataFrame, tasks: int, features: int) -> RDD:
    """Packed blocks, dealt to ``tasks`` partitions."""
    blocks = state.where("kind = 'block'").select("data").repartition(tasks).rdd
    return blocks.mapPartitions(lambda rows: (r.packed() for r in _joined((bytes(x["data"]) for x in rows), features))).persist(StorageLevel.MEMORY_AND_DISK)


def _level_jobs(state: DataFrame, s: Settings, rounds: int, wait: int | None, chunk: int, tasks: int) -> list[tuple[str, int, np.ndarray]]:
    """Trees and metrics of all rounds, a job a level."""
    n, width, depth = len(s.cuts), s.bins, s.depth
    kept, least, at = [], math.inf, 0
    rows, stale = _cached(state, tasks, n), None
    pending = []  # trees the stored predictions do not know yet
    for t in range(1, rounds + (1 if wait is None else 2)):  # the metrics of a round come with the next one's first job
        def prepared(blocks, grown=tuple(pending), tree=t):
            known = _ready(grown, s)
            for b in blocks:
                r = _Rows.read([b], n).advanced(known, depth)
                yield r.drawn(tree, s), np.zeros(1) if wait is None else r.measured(s)
        drawn = rows.mapPartitions(prepared).persist(StorageLevel.MEMORY_AND_DISK)

        def count(level, drawn=drawn):
            return sum(drawn.mapPartitions(lambda d: _below(d, level, width)).collect())
        root = Level(0, np.full(2 << depth, -1), np.zeros(2 << depth, dtype=np.int64), np.array([-1, 0]), 1)
        parts = drawn.mapPartitions(lambda d, root=root: _first(d, root, width)).collect()
        if stale is not None:
            stale.unpersist()
            stale = None
        if wait is not None and t > 1:
            m = _round(sum(p[1] for p in parts), s)
            kept.append(("round", t - 1, m))
            least, at = (m[1], t - 1) if m[1] < least else (least, at)
            if t - 1 - at >= wait:
                drawn.unpersist()
                break
        if t > rounds:
            drawn.unpersist()
            break
        cells = sum(p[0] for p in parts)
        nodes = grow(t, s, lambda level, cells=cells, count=count: count(level) if level.deep else cells)
        drawn.unpersist()
        kept.append(("tree", t, nodes))
        pending.append(nodes)
        if t < rounds and (len(pending) == FOLD or t % chunk == 0):
            def folded(blocks, grown=tuple(pending)):
                known = _ready(grown, s)
                return (_Rows.read([b], n).advanced(known, depth).packed() for b in blocks)
            stale, rows, pending = rows, rows.mapPartitions(folded).persist(StorageLevel.MEMORY_AND_DISK), []
            if t % chunk == 0:
                written = materialize(state.sparkSession.createDataFrame(rows.map(lambda b: ("block", 0, b)), state.schema, verifySchema=False), "boosted")
                rows.unpersist()
                stale.unpersist()
                rows, stale = _cached(written, tasks, n), None
    rows.unpersist()
    return kept


def bin_cuts(df: DataFrame, features: list[str], max_bins: int = 64) -> list[np.ndarray]:
    """Per feature at most ``max_bins - 1`` values that bound its bins, from one quantile sketch each in one pass."""
    shares = [i / max_bins for i in range(1, max_bins)]
    value = {f: F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")) for f in features}
    row = df.agg(*[F.percentile_approx(value[f], shares, 10_000).alias(f"c{i}") for i, f in enumerate(features)],
                 *[F.max(value[f]).alias(f"m{i}") for i, f in enumerate(features)]).first()
    return [np.array(sorted({float(x) for x in row[f"c{i}"] or []} - {row[f"m{i}"]})) for i in range(len(features))]


def boost(train: DataFrame, key: list[str], features: list[str] = fv.FEATURES, label: str = fv.TARGET, rounds: int = 500,
          depth: int = 6, step: float = 0.1, rows: float = 0.8, columns: float = 0.8, l2: float = 1.0, least_gain: float = 0.0,
          least_rows: int = 1, max_bins: int = 64, seed: int = fv.SEED, unit: float | None = None, valid: str | None = None,
          patience: int | None = None, chunk: int = 100, tasks: int | None = None) -> Boosted:
    """Fit squared error by ``rounds`` trees of ``depth`` levels.

    ``key`` names the columns by which rows are drawn. ``step`` shrinks every tree, ``l2`` is added to the rows of a leaf,
    a split must gain more than ``least_gain`` and leave ``least_rows`` rows on both sides. Rows without a label are left
    out; a null or NaN feature sorts below all values. ``unit`` is the resolution of residuals (default: a power of two,
    2**-24 of the label's range or a little more; sums stay
    exact up to 2**28 rows). ``valid`` names a boolean column: such rows are not learned from, their metrics are
    given for each round, and after ``patience`` rounds without a lower error fitting stops and the trees up to the
    best round are kept. ``max_bins`` may be 256 at most. An empty table is an error.
    """
    if not 2 <= max_bins <= 256:
        raise ValueError("max_bins: 2 to 256")
    flag = F.coalesce(F.col(valid), F.lit(False)) if valid else F.lit(False)
    # rows are looked through once written: a condition on a computed label would compute it again, part by part
    given = materialize(train.select(
        *[F.col(f).cast("double").alias(f) for f in features], F.col(label).cast("double").alias("_label"),
        F.xxhash64(*key).alias("_key"), flag.alias("_valid")), "given").where("_label is not null")
    learned = given.where("not _valid")
    cuts = bin_cuts(learned, features, max_bins)
    least, most, n = learned.agg(F.min("_label"), F.max("_label"), F.count(F.lit(1))).first()
    if not n:
        raise ValueError("no rows to learn from")
    span = max(most - least, max(abs(most), abs(least)) * 2.0 ** -20) or 1.0
    unit = unit or 2.0 ** (math.ceil(math.log2(span)) - 24)
    base = learned.agg(F.sum(F.floor(F.col("_label") / unit + 0.5).cast("decimal(38,0)"))).first()[0]
    base = float(int(base) // n) * unit
    s = Settings(cuts, depth, step, rows, columns, l2, least_gain, least_rows, seed, unit)
    spark = train.sparkSession
    every = given.count()
    tasks = tasks or (1 if every <= ROWS_ALONE else max(2, min(spark.sparkContext.defaultParallelism, -(-every // ROWS_PER_TASK))))
    state = materialize(given.mapInArrow(_binned(features, cuts, base), "kind string, round int, data binary"), "bins")
    wait = (patience or rounds) if valid else None
    kept = _chunks_alone(state, s, rounds, wait, chunk) if tasks == 1 else _level_jobs(state, s, rounds, wait, chunk, tasks)
    upto = rounds
    if patience is not None and valid:
        losses = sorted((float(m[1]), t) for kind, t, m in kept if kind == "round" and not math.isnan(m[1]))
        upto = losses[0][1] if losses else 0
    table = [(t, int(m[0]), features[int(m[1])] if m[1] >= 0 else None, float(cuts[int(m[1])][int(m[2])]) if m[1] >= 0 else None,
              float(m[3]), float(m[4]), float(m[5]))
             for kind, t, tree in kept if kind == "tree" and t <= upto for m in tree.reshape(-1, 6)]
    metrics = [(t, *(float(x) for x in m[1:])) for kind, t, m in kept if kind == "round"]
    return Boosted(trees.node_table(spark, table), spark.createDataFrame(metrics, "round int, rmse double, mae double, r2 double, mape double"),
                   base, features)


def predict(model: Boosted, df: DataFrame, name: str = "prediction") -> DataFrame:
    """``df`` with the predictions of all trees of ``model``."""
    return trees.predict(model.nodes, df, model.features, name, model.base)
