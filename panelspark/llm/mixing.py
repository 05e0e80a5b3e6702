"""Mixing sources to target word counts by subset-sum fitting.

Documents are counted by exact size per source. Whole repeats cover a source's target as far as they
go; what remains is first shared over all sizes in proportion and then closed by a bounded knapsack
over the sizes' remaining counts. Of each size the documents with the smallest seeded hash are taken.

Scale: sizes, counts and hash buckets are aggregates; a source is planned from its size histogram
alone (one row per distinct size). Documents are chosen by comparing a hash bucket with a cut, and
only the one bucket per size that the cut splits is ranked, so equal documents do not gather.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm import tables
from panelspark.runtime import materialize

# Words that the knapsack closes at first; a larger rest is cut with the largest sizes before.
WINDOW = 1 << 16
# Hash buckets per source and size.
BUCKETS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: Sequence[int], weights: Sequence[float], most: float) -> list[float]:
    """Share the sum of all sizes by weight; no source gets more than ``most`` times its size.

    What a full source leaves is shared again among the others.
    """
    out, budget, free = [0.0] * len(sizes), float(sum(sizes)), [i for i, s in enumerate(sizes) if s > 0]
    while free:
        total = sum(weights[i] for i in free)
        over = [i for i in free if budget * weights[i] / total > most * sizes[i]]
        if not over:
            for i in free:
                out[i] = budget * weights[i] / total
            break
        for i in over:
            out[i] = float(most * sizes[i])
        budget -= sum(out[i] for i in over)
        free = [i for i in free if i not in over]
    return out


def _knapsack(sizes: np.ndarray, counts: np.ndarray, rest: int) -> np.ndarray:
    """How many of each size sum up to ``rest``, or to the largest reachable value below it."""
    came = np.full(rest + 1, -1, dtype=np.int32)
    reach = np.zeros(rest + 1, dtype=bool)
    reach[0] = True
    steps = []
    for i in np.argsort(-sizes, kind="stable"):
        left, chunk = int(min(counts[i], rest // sizes[i])), 1
        while left and not reach[rest]:
            take = min(chunk, left)
            weight = take * int(sizes[i])
            new = np.flatnonzero(reach[:rest + 1 - weight] & ~reach[weight:]) + weight
            came[new] = len(steps)
            reach[new] = True
            steps.append((int(i), take, weight))
            left, chunk = left - take, 2 * chunk
    at, used = int(np.flatnonzero(reach)[-1]), np.zeros(len(sizes), dtype=np.int64)
    while at:
        i, take, weight = steps[came[at]]
        used[i] += take
        at -= weight
    return used


def fit_counts(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each distinct size (> 0) to take so that their sizes sum up to ``budget``, or else to the
    largest reachable sum below.

    Shares in proportion come first, then the largest sizes until ``WINDOW`` words remain, and the knapsack closes the rest.
    Where it cannot, documents are given back and it runs over a wider window, up to 2 * largest + 1 of every size: an
    order of takes and returns that keeps each partial sum within the largest size visits one sum twice if it is longer, and
    what lies between the two changes nothing. So the widest window holds a best sum, whatever the number of documents.
    """
    total = int((sizes * counts).sum())
    if budget >= total:
        return counts.copy()
    unit = int(np.gcd.reduce(sizes))
    sizes, budget, total = sizes // unit, budget // unit, total // unit
    used = np.array([int(c) * budget // total for c in counts], dtype=np.int64)
    rest = budget - int((sizes * used).sum())
    for i in np.argsort(-sizes, kind="stable"):
        if rest <= WINDOW:
            break
        more = min(int(counts[i] - used[i]), rest // int(sizes[i]))
        used[i] += more
        rest -= more * int(sizes[i])
    most = np.minimum(used, 2 * int(sizes.max()) + 1)
    best, window = used, 0
    while True:
        back, room = np.zeros_like(used), window
        for i in np.argsort(sizes, kind="stable"):
            back[i] = min(int(most[i]), room // int(sizes[i]))
            room -= int(back[i]) * int(sizes[i])
        kept = used - back
        took = kept + _knapsack(sizes, counts - kept, budget - int((sizes * kept).sum()))
        if (sizes * took).sum() > (sizes * best).sum():
            best = took
        if (sizes * best).sum() == budget or (back == most).all():
            return best
        window = 8 * window or WINDOW


def _plan(histogram: pd.DataFrame) -> pd.DataFrame:
    """Repeats of every document and extra documents per size, for one source."""
    sizes, counts = histogram["size"].to_numpy(np.int64), histogram["docs"].to_numpy(np.int64)
    target, total = float(histogram["target"].iloc[0]), int((sizes * counts).sum())
    repeats = int(target // total) if total else 0
    filled = sizes > 0
    extra = np.zeros(len(sizes), dtype=np.int64)
    if total:
        extra[filled] = fit_counts(sizes[filled], counts[filled], round(target - repeats * total))
    return pd.DataFrame({"place": histogram["place"], "size": sizes, "docs": counts, "repeats": repeats, "extra": extra})


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[float] = (1.0, 2.0, 3.0), most: float = 3.0, seed: int = 42) -> DataFrame:
    """How often the mix takes each row of ``docs``, in words.

    The size of a text is its number of words ``[^\\x20\\x09-\\x0D]+`` (null: 0). Sources, in code point
    order with null last, weigh ``weights`` in turn and share the sum of all sizes (see ``targets``).
    Returns ``doc_id``, ``size``, ``source``, ``source_size``, ``target``, ``repeats`` and ``taken``
    (``size`` times ``repeats``). A source's ``taken`` sums up to its target, rounded to whole words,
    or the nearest reachable sum below; no row is taken more than ``ceil(most)`` times. The choice
    depends on ``seed``, ``doc_id`` and text alone, so reruns agree; rows that agree in those and in source
    are interchangeable. Null is a source and a ``doc_id`` like any other; texts without words are never
    taken. An empty table gives an empty result. The list of sources, one row each, passes the driver.
    """
    sized = materialize(docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        # the text spreads rows that share an identifier
        (F.pmod(F.xxhash64(F.lit(seed), tables.key_of(doc_id), F.col(text).cast("string")), F.lit(1 << 40))).alias("hash")), "sized")
    found = sized.groupBy("source").agg(F.sum("size").alias("source_size")).collect()
    found = sorted(found, key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-8", "surrogatepass")))
    goal = targets([r["source_size"] for r in found], [weights[i % len(weights)] for i in range(len(found))], most)
    of_source = materialize(docs.sparkSession.createDataFrame(
        [(i, r["source"], r["source_size"], t) for i, (r, t) in enumerate(zip(found, goal, strict=True))],
        "place int, source string, source_size long, target double"), "sources")
    placed = sized.withColumn("bucket", F.col("hash") % BUCKETS).join(
        of_source.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    cells = placed.groupBy("place", "size", "bucket").agg(F.count(F.lit(1)).alias("n"), F.first("target").alias("target"))
    plan = (cells.groupBy("place", "size").agg(F.sum("n").alias("docs"), F.first("target").alias("target"))
            .groupBy("place").applyInPandas(_plan, "place int, size long, docs long, repeats long, extra long"))
    ahead = F.sum("n").over(Window.partitionBy("place", "size").orderBy("bucket")) - F.col("n")
    edge = (cells.select("place", "size", "bucket", "n", ahead.alias("ahead")).join(plan, ["place", "size"])
            .where("ahead < extra and extra <= ahead + n")
            .select("place", "size", F.col("bucket").alias("cut"), (F.col("extra") - F.col("ahead")).alias("rest")))
    rules = materialize(plan.join(edge, ["place", "size"], "left").select(
        "place", "size", "repeats", F.coalesce("cut", F.lit(-1)).alias("cut"), F.coalesce("rest", F.lit(0)).alias("rest")),
        "rules")
    ruled = placed.join(rules, ["place", "size"])
    clear = ruled.where("bucket <> cut").withColumn("more", (F.col("bucket") < F.col("cut")).cast("int"))
    split = ruled.where("bucket = cut").withColumn("more", (F.row_number().over(
        Window.partitionBy("place", "size").orderBy("hash", "doc_id")) <= F.col("rest")).cast("int"))
    repeats = F.col("repeats") + F.col("more")
    return clear.unionByName(split).select("doc_id", "size", "source", "source_size", "target", repeats.alias("repeats"),
                                           (F.col("size") * repeats).alias("taken"))
