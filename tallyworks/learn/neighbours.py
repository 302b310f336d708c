"""Exact k nearest neighbours over tables of any size.

Training vectors belong to the cell of their nearest pivot. From the pivots' distances and the cell
radii every query knows a distance within which its k neighbours must lie, and visits only cells
that can hold something nearer (triangle inequality), so the answer is exact. A visit is an
equi-join on the cell. Cells are divided into blocks of bounded size on both sides, so a cell with
a third of the table is many small tasks; a block hands on k rows per query and keeps its distances
to itself.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DIGITS = 9  # distances that agree this far are ties, the smaller id wins


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of a to all rows of b, row by row of the shorter side."""
    if len(a) <= len(b):
        return np.stack([np.sqrt(((b - row) ** 2).sum(axis=1)) for row in a]) if len(a) else np.empty((0, len(b)))
    return _distances(b, a).T


def _nearest_of(a: np.ndarray, b: np.ndarray, k: int, rows: int = 256) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest rows of b of every row of a, as numbers of a, numbers of b and rounded distances; on a tie the smaller number of b.

    ``rows`` rows of a at a time. A matrix product gives squares that are off by less than ``slack``; only what can be among
    the k by them is measured as ``_distances`` does.
    """
    found = []
    own = (b**2).sum(axis=1)
    for start in range(0, len(a), rows):
        part = a[start : start + rows]
        square = (part**2).sum(axis=1)[:, None] + own[None, :] - 2 * (part @ b.T)
        if len(b) <= k or not np.isfinite(square).all():
            d = _distances(part, b).round(_DIGITS)
            at = d.argsort(axis=1, kind="stable")[:, :k]
            i = np.repeat(np.arange(len(part)), at.shape[1])
            found.append((i + start, at.ravel(), d[i, at.ravel()]))
            continue
        slack = 32 * np.finfo("float64").eps * (a.shape[1] + 4) * ((part**2).sum(axis=1) + own.max())
        edge = np.sqrt(np.maximum(np.partition(square, k - 1, axis=1)[:, k - 1] + slack, 0)) + 3 * 10.0**-_DIGITS
        i, j = np.nonzero(square <= (edge**2 * (1 + 1e-12) + slack)[:, None])
        d = np.concatenate([_distances_of(part[i[n : n + 4096]], b[j[n : n + 4096]]) for n in range(0, len(i), 4096)]).round(_DIGITS)
        order = np.lexsort((j, d, i))
        i, j, d = i[order], j[order], d[order]
        kept = np.arange(len(i)) - np.searchsorted(i, i) < k
        found.append((i[kept] + start, j[kept], d[kept]))
    return tuple(np.concatenate(side) for side in zip(*found))


def _distances_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of a to the rows of b on the same places."""
    return np.sqrt(((b - a) ** 2).sum(axis=1))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype="float64")


def nearest(
    train: DataFrame, query: DataFrame, k: int, key: str, vector: str, carry: str, pivots: int = 64, block_rows: int = 2000
) -> DataFrame:
    """The k nearest training rows ``(query, rank, neighbour, distance, carry)`` of every query row."""
    chosen = train.orderBy(F.md5(F.col(key).cast("string")), key).select(vector).limit(pivots).collect()
    centres = np.array([r[0] for r in chosen], dtype="float64")

    @F.pandas_udf(T.StructType.fromDDL("cell int, away double"))
    def cell_of(v: pd.Series) -> pd.DataFrame:
        d = _distances(_matrix(v), centres)
        return pd.DataFrame({"cell": d.argmin(axis=1).astype("int32"), "away": d.min(axis=1)})

    placed = train.select(
        F.col(key).alias("t_id"), F.col(vector).alias("t_vec"), F.col(carry).alias("t_carry"), cell_of(vector).alias("c")
    ).select("t_id", "t_vec", "t_carry", "c.*")
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")).collect()
    numbers = np.array([c["cell"] for c in cells])
    sizes = np.array([c["n"] for c in cells])
    radii = np.array([c["radius"] for c in cells])

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def visits(v: pd.Series) -> pd.Series:
        d = _distances(_matrix(v), centres[numbers])
        out = []
        for row in d:
            far = row + radii
            order = far.argsort()
            enough = int(np.searchsorted(sizes[order].cumsum(), k))
            bound = far[order][min(enough, len(order) - 1)]
            out.append(numbers[row - radii <= bound * (1 + 1e-9) + 1e-9].tolist())
        return pd.Series(out)

    asked = query.select(F.col(key).alias("q_id"), F.col(vector).alias("q_vec"), F.explode(visits(vector)).alias("cell"))
    waiting = {r["cell"]: r["n"] for r in asked.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}

    # at most ``pivots`` rows: how many blocks each cell has on either side
    blocks = train.sparkSession.createDataFrame(
        [
            (int(c["cell"]), math.ceil(c["n"] / block_rows), max(1, math.ceil(waiting.get(c["cell"], 0) / block_rows)))
            for c in cells
        ],
        "cell int, t_blocks int, q_blocks int",
    )

    def spread(df: DataFrame, own: str, other: str, key_col: str, own_name: str, other_name: str) -> DataFrame:
        """Each row in one block of its own side, once per block of the other side."""
        sized = df.join(F.broadcast(blocks), "cell")
        return sized.select(
            "*",
            F.pmod(F.xxhash64(key_col), F.col(own)).cast("int").alias(own_name),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other_name),
        ).drop("t_blocks", "q_blocks")

    left = spread(asked, "q_blocks", "t_blocks", "q_id", "qb", "tb")
    right = spread(placed.drop("away"), "t_blocks", "q_blocks", "t_id", "tb", "qb")
    kinds = {f.name: f.dataType for f in placed.schema}
    shape = T.StructType(
        [
            T.StructField("q_id", asked.schema["q_id"].dataType),
            T.StructField("t_id", kinds["t_id"]),
            T.StructField("distance", T.DoubleType()),
            T.StructField("t_carry", kinds["t_carry"]),
        ]
    )

    def block(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        if q.empty or t.empty:
            return pd.DataFrame({f.name: [] for f in shape})
        t = t.sort_values("t_id")
        rows, cols, away = _nearest_of(_matrix(q["q_vec"]), _matrix(t["t_vec"]), k)
        return pd.DataFrame(
            {
                "q_id": q["q_id"].to_numpy()[rows],
                "t_id": t["t_id"].to_numpy()[cols],
                "distance": away,
                "t_carry": t["t_carry"].to_numpy()[cols],
            }
        )

    by = ["cell", "qb", "tb"]
    near = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(block, shape)
    rank = F.row_number().over(Window.partitionBy("q_id").orderBy("distance", "t_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select(
        F.col("q_id").alias("query"), "rank", F.col("t_id").alias("neighbour"), "distance", F.col("t_carry").alias(carry)
    )


def vote(neighbours: DataFrame, label: str, weights: str = "uniform") -> DataFrame:
    """Label with most votes per query, the smallest label on a tie.

    With "distance" a neighbour's vote is the inverse of its distance; neighbours in the same place
    outvote all others.
    """
    if weights == "distance":
        zero = F.max((F.col("distance") == 0).cast("int")).over(Window.partitionBy("query"))
        vote_of = F.when(zero == 1, (F.col("distance") == 0).cast("double")).otherwise(F.try_divide(F.lit(1.0), "distance"))
    else:
        vote_of = F.lit(1.0)
    counted = neighbours.withColumn("__v", vote_of).groupBy("query", label).agg(F.sum("__v").alias("__v"))
    best = F.min_by(label, F.struct(-F.round("__v", 9), F.col(label)))
    return counted.groupBy("query").agg(best.alias("prediction"))
