"""Exact top-k inner products by a Voronoi join.

Every vector belongs to its nearest pivot. A summary of each cell (radius, and
the smallest distances to the pivot) gives every query a lower bound on its k-th
best score before any vector moves: a vector x at distance d from pivot p scores
within q.p +- |q| d. Queries of a cell form a group; for each pair of group and
cell the join derives the smallest distance to the pivot from which a vector can
still matter to some query of the group, and sends only those vectors. A group is
cut into blocks of queries and its vectors into blocks by id, and each pair of blocks
is solved by one matrix product.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.session import materialise

PIVOTS, QUERY_BLOCK, VECTOR_BLOCK = 32, 1024, 16_384
_EXACT = float(2**53)


def scaled(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id and ``v``, the floor of ``scale`` times each component; vectors null, empty or with a null or non-finite component go."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) != F.lit(float("inf"))))
    return vectors.where("vec_id is not null and embedding is not null and size(embedding) > 0").where(finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v"))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows: in doubles while every sum stays below 2**53, else in 64-bit integers."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < _EXACT:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, (x * x).sum(1)[:, None] - 2 * x @ pivots.T + (pivots * pivots).sum(1)[None, :]))


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 10, pivots: int = PIVOTS) -> DataFrame:
    """The ``k`` best vectors of each query: query_id, rank (from 1), vec_id, score.

    Both tables hold (vec_id, v array<long>), as ``scaled`` makes them. A query's own id is no
    candidate; ties go to the smaller vec_id; a query and a vector of another
    length do not meet; repeated rows of an id count each, as queries and as candidates (and of
    equal score and id, in any order). Fewer than ``k`` candidates give fewer rows.
    """
    spark = vectors.sparkSession
    stored = materialise(vectors.select("vec_id", "v", F.size("v").alias("dim")), "vectors")
    asked = materialise(queries.select("vec_id", "v", F.size("v").alias("dim")), "queries")
    counts = {r["dim"]: r["n"] for r in stored.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    results = None
    for dim in sorted(counts):
        part = _one_dimension(asked.where(F.col("dim") == dim), stored.where(F.col("dim") == dim), counts[dim], k, pivots)
        results = part if results is None else results.unionByName(part)
    if results is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return results.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query_groups(centre: np.ndarray, sizes: dict[int, int], most: int = QUERY_BLOCK) -> list[tuple[int, int, int]]:
    """(cell, group, blocks) of each cell with queries: a chain of near cells, cut where a group would pass ``most`` queries.

    A cell with more queries is a group of its own, dealt into blocks.
    """
    left, out, group, held = sorted(sizes), [], -1, most + 1
    at = left[0] if left else None
    while left:
        left.remove(at)
        if held + sizes[at] > most:
            group, held = group + 1, 0
        held += sizes[at]
        out.append((at, group, -(-sizes[at] // most)))
        if left:
            at = min(left, key=lambda c: (float(((centre[c] - centre[at]) ** 2).sum()), c))
    return out


def _one_dimension(asked: DataFrame, stored: DataFrame, count: int, k: int, pivots: int) -> DataFrame:
    # Distinct vectors among a bounded number of rows, by the hash of the id.
    drawn = stored.select("vec_id", "v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(4 * pivots).collect()
    centre = np.array(list(dict.fromkeys(tuple(r["v"]) for r in drawn))[:pivots], float)

    def assign(frames):
        for frame in frames:
            if not len(frame):
                continue
            x = np.array(frame["v"].tolist(), float)
            d = _distances(x, centre)
            frame["cell"] = d.argmin(1).astype(np.int32)
            frame["distance"] = d.min(1)
            yield frame[["vec_id", "v", "cell", "distance"]]

    placed = materialise(stored.select("vec_id", "v").mapInPandas(assign, "vec_id long, v array<long>, cell int, distance double"), "cells")

    # Per cell the nearest rows to its pivot, at most k of an id and 2 k in all: whatever
    # id a query has, and however often that id repeats, k rows of other ids are left.
    def nearest(frame):
        frame = frame.sort_values(["distance", "vec_id"], kind="stable")
        return frame[frame.groupby(["cell", "vec_id"]).cumcount() < k].groupby("cell").head(2 * k)

    def summary(frames):
        near = None
        for frame in frames:
            near = nearest(frame if near is None else pd.concat([near, frame]))
        if near is not None:
            yield near[["cell", "vec_id", "distance"]]

    merged = placed.select("cell", "vec_id", "distance").mapInPandas(summary, "cell int, vec_id long, distance double")
    low, owner = np.full((len(centre), 2 * k), np.inf), np.zeros((len(centre), 2 * k), np.int64)
    of_cell = merged.groupBy("cell").applyInPandas(nearest, "cell int, vec_id long, distance double").toPandas()
    for cell, rows in of_cell.groupby("cell"):
        low[cell, : len(rows)], owner[cell, : len(rows)] = rows["distance"], rows["vec_id"]
    # A margin over the rounding of the distances.
    slack = 1e-6 * (1 + float(np.abs(centre).max(initial=0)) ** 2 * centre.shape[1])

    def bounds(frames):
        for frame in frames:
            if not len(frame):
                continue
            q = np.array(frame["v"].tolist(), float)
            cell = _distances(q, centre).argmin(1)
            norm = np.sqrt((q * q).sum(1))
            centred = q @ centre.T
            with np.errstate(invalid="ignore"):
                lowest = centred[:, :, None] - norm[:, None, None] * np.where(np.isinf(low), 0, low)[None]
            own = owner[None] == frame["vec_id"].to_numpy(np.int64)[:, None, None]
            lowest = np.where(np.isinf(low)[None] | own, -np.inf, lowest).reshape(len(q), -1)
            kth = np.partition(lowest, lowest.shape[1] - k, axis=1)[:, lowest.shape[1] - k] - slack
            need = np.where(norm[:, None] > 0, (kth[:, None] - centred) / np.maximum(norm[:, None], 1e-9), np.where(kth[:, None] <= centred, -np.inf, np.inf))
            yield pd.DataFrame({"vec_id": frame["vec_id"], "v": frame["v"], "cell": cell.astype(np.int32), "need": [n.tolist() for n in need]})

    bounded = materialise(asked.select("vec_id", "v").mapInPandas(bounds, "vec_id long, v array<long>, cell int, need array<double>"), "bounds")
    sizes = {r["cell"]: r["n"] for r in bounded.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    # Neighbouring cells form a group up to a block of queries: a vector is sent once to each group that needs it.
    spark = asked.sparkSession
    groups = F.broadcast(spark.createDataFrame(query_groups(centre, sizes), "cell int, group int, blocks int"))
    grouped = bounded.join(groups, "cell").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    # One row per group block and cell: from which distance on vectors of the cell are needed.
    reach = grouped.select("group", "block", F.posexplode("need").alias("cell", "from")).groupBy("group", "block", "cell").agg(F.min("from").alias("from"))
    slices = max(1, -(-count // VECTOR_BLOCK))
    needed = materialise(reach, "reach")
    sent = placed.join(needed, "cell").where(F.col("distance") >= F.col("from") - 1e-6 * (1 + F.abs("from"))).select(
        "group", "block", F.pmod(F.xxhash64("vec_id"), F.lit(slices)).cast("int").alias("slice"), "vec_id", "v")
    spread = grouped.select("group", "block", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), "vec_id", "v")

    def solve(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0, np.int64)}
        if not len(left) or not len(right):
            return pd.DataFrame(out)
        q, x = np.array(left["v"].tolist(), np.int64), np.array(right["v"].tolist(), np.int64)
        ids = right["vec_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        pieces = []
        for at in range(0, len(q), 128):
            scores = _products(q[at : at + 128], x)
            for number, mine in zip(left["vec_id"].to_numpy()[at : at + 128], scores, strict=True):
                keep = np.flatnonzero(ids != number)
                best = keep[np.argsort(-mine[keep], kind="stable")[:k]]
                pieces.append((np.full(len(best), number), ids[best], mine[best]))
        return pd.DataFrame({c: np.concatenate([p[i] for p in pieces]) for i, c in enumerate(out)})

    return spread.groupBy("group", "block", "slice").cogroup(sent.groupBy("group", "block", "slice")).applyInPandas(
        solve, "query_id long, vec_id long, score long")
