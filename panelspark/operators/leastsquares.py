"""Least squares per group from sums of products that can be added up over days, loads or sub-groups.

A group's Gram matrix of ``[1, features..., label]`` is one row; it is built with map-side sums, so a hot group costs one
partial row a task. Rows of finer groups add up to coarser ones, and each row is solved by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _names(features: list[str]) -> list[tuple[int, int, str]]:
    return [(i, j, f"s_{i}_{j}") for i in range(len(features) + 2) for j in range(i, len(features) + 2)]


def gram(df: DataFrame, by: list[str], features: list[str], label: str) -> DataFrame:
    """``by``... and the sums ``s_i_j`` of products of places i and j of ``[1, features..., label]``.

    Rows with a null or NaN in a feature or the label are left out; a null in ``by`` is a group.
    """
    places = [F.lit(1.0), *[F.col(c).cast("double") for c in (*features, label)]]
    known = F.lit(True)
    for c in places[1:]:
        known = known & c.isNotNull() & ~F.isnan(c)
    return df.where(known).groupBy(*by).agg(*[F.sum(places[i] * places[j]).alias(n) for i, j, n in _names(features)])


def merge(grams: DataFrame, by: list[str]) -> DataFrame:
    """Gram rows added up to the coarser groups ``by``; union stored rows with new ones first to bring a fit up to date."""
    return grams.groupBy(*by).agg(*[F.sum(c).alias(c) for c in grams.columns if c.startswith("s_")])


def solve(grams: DataFrame, by: list[str], features: list[str]) -> DataFrame:
    """``by``..., ``n``, ``rank`` and per feature, and for ``intercept``, one row with ``coefficient``.

    Columns are centred from the sums. Where features depend on each other in a group (``rank`` below their number, or
    too few rows), the shortest solution is given.
    """
    k = len(features)
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in grams.schema if f.name in by],
                        "n bigint, rank int, feature string, coefficient double"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                g = np.zeros((k + 2, k + 2))
                for i, j, name in _names(features):
                    g[i, j] = g[j, i] = row[name]
                n, mean = g[0, 0], g[0, 1:] / g[0, 0]
                spread = g[1:, 1:] - n * np.outer(mean, mean)
                scale = np.sqrt(np.maximum(np.diag(spread)[:k], 0))
                flat = scale <= 1e-9 * np.sqrt(np.maximum(np.diag(g)[1:k + 1], 0))  # constant in this group
                safe = np.where(flat, 1.0, scale)
                a, b = spread[:k, :k] / np.outer(safe, safe), spread[:k, k] / safe
                a[flat], a[:, flat], b[flat] = 0, 0, 0
                beta, _, rank, _ = np.linalg.lstsq(a, b, rcond=1e-10)
                beta = np.where(flat, 0, beta / safe)
                for name, value in [("intercept", mean[k] - beta @ mean[:k]), *zip(features, beta, strict=True)]:
                    out.append([row[c] for c in by] + [int(n), int(rank), name, float(value)])
            yield pd.DataFrame(out, columns=[*by, "n", "rank", "feature", "coefficient"])
    return grams.select(*by, *[n for _, _, n in _names(features)]).mapInPandas(run, schema)


def predict(df: DataFrame, solved: DataFrame, by: list[str], features: list[str], name: str = "predicted") -> DataFrame:
    """``df`` with the prediction of its group's fit; null where the group has none."""
    wide = solved.groupBy(*by).agg(*[F.max(F.when(F.col("feature") == f, F.col("coefficient"))).alias(f"_b{i}")
                                     for i, f in enumerate(["intercept", *features])])
    if by:
        same = None
        for c in by:
            wide = wide.withColumnRenamed(c, f"_by_{c}")
            part = F.col(c).eqNullSafe(F.col(f"_by_{c}"))
            same = part if same is None else same & part
        joined = df.join(wide, same, "left")
    else:
        joined = df.join(F.broadcast(wide), how="left")  # one row
    value = F.col("_b0")
    for i, f in enumerate(features):
        value = value + F.col(f"_b{i + 1}") * F.col(f)
    return joined.withColumn(name, value).select(*[c for c in df.columns if c != name], name)
