"""Exact top-k by inner product: Voronoi groups, bounds from their summaries, local search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgeworks.session import staged

#: Rows of one data chunk and queries of one block; their product bounds a task's score matrix.
CHUNK_ROWS, BLOCK_QUERIES = 4096, 1024


def usable(vector: str) -> Column:
    """Whether the vector and all its components are there and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64) if len(vectors) else np.zeros((0, width))


def pivots_of(vectors: DataFrame, n: int) -> dict[int, np.ndarray]:
    """Up to ``n`` vectors per number of dimensions, drawn by a hash of the vector from those that occur.

    Only dimensions that occur among the first 32 * n drawn rows get pivots of their own; any other
    dimension has the zero vector as its only pivot, which is right but prunes less.
    """
    drawn = vectors.select("v").orderBy(F.xxhash64("v")).limit(32 * n).collect()
    out: dict[int, list] = {}
    for row in drawn:
        group = out.setdefault(len(row.v), [])
        if len(group) < n and row.v not in group:
            group.append(row.v)
    return {d: np.array(p, dtype=np.float64).reshape(len(p), d) for d, p in out.items()}


def voronoi_topk(
    vectors: DataFrame, queries: Column, k: int = 5, *, key: str = "vec_id", vector: str = "embedding", n_pivots: int = 64
) -> DataFrame:
    """For every row that fits ``queries`` its ``k`` other rows of highest inner product, ties to the smaller key.

    1. Every vector joins the cell of its nearest pivot. A summary per cell: rows, radius (largest
       distance to the pivot), largest norm.
    2. Each query is solved in its home cell; its k-th score there is a lower bound of its k-th score.
    3. By Cauchy and Schwarz no member of a cell with pivot ``p`` and radius ``r`` scores over ``q.p + |q| r``
       (or ``|q|`` times the largest norm). A query is replicated only to the cells whose bound reaches its
       own, and solved there; the k best of all cells are its answer.

    Cells are searched in chunks of bounded size against blocks of queries of bounded size, so a cell
    with most of the rows is many tasks. Scores are sums of products of whole numbers; they are exact
    as long as they stay below 2**53.

    Vectors null or with null or non-finite components take no part, neither do rows with a null key;
    only vectors of equal length are compared; rows that repeat a key are candidates each, but a
    query's own key is none; a query without candidates has no rows; an empty table gives an empty
    result.
    """
    spark = vectors.sparkSession
    clean = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"), queries.alias("is_query"))
    clean = clean.filter(F.col("id").isNotNull() & usable("v"))
    pivots = pivots_of(clean, n_pivots)
    shared = spark.sparkContext.broadcast(pivots)

    @F.pandas_udf("cell int, distance double, norm double")
    def assigned(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in parts:
            cell, distance, norm = (np.zeros(len(series)) for _ in range(3))
            lengths = np.array([len(v) for v in series], dtype=np.int64)
            for d in np.unique(lengths):
                at = np.flatnonzero(lengths == d)
                x, p = _matrix(series.iloc[at], d), shared.value.get(int(d), np.zeros((1, d)))
                squared = (x**2).sum(1)[:, None] - 2 * x @ p.T + (p**2).sum(1)[None, :]
                cell[at] = squared.argmin(1)
                distance[at] = np.sqrt(((x - p[squared.argmin(1)]) ** 2).sum(1))
                norm[at] = np.sqrt((x**2).sum(1))
            yield pd.DataFrame({"cell": cell.astype(np.int32), "distance": distance, "norm": norm})

    rows = clean.withColumn("_a", assigned("v")).select(
        "id", "v", "is_query", F.size("v").alias("d"), "_a.cell", "_a.distance", "_a.norm")
    rows = staged(rows, "voronoi")
    summaries = {
        (r.d, r.cell): r
        for r in rows.groupBy("d", "cell").agg(
            F.count(F.lit(1)).alias("n"), F.max("distance").alias("radius"), F.max("norm").alias("norm")).collect()
    }  # one row per pivot
    bounds = spark.sparkContext.broadcast({
        d: (shared.value.get(d, np.zeros((1, d))), sorted(c for e, c in summaries if e == d),
            np.array([(summaries[d, c].radius, summaries[d, c].norm) for c in sorted(c for e, c in summaries if e == d)]))
        for d in {d for d, _ in summaries}
    })
    chunks = {key_: -(-r.n // CHUNK_ROWS) for key_, r in summaries.items()}
    n_chunks = F.coalesce(F.create_map(*[F.lit(x) for (d, c), n in chunks.items() for x in (f"{d}:{c}", n)])[
        F.concat_ws(":", "d", "cell")], F.lit(1)) if chunks else F.lit(1)

    data = rows.select("id", "v", "d", "cell", F.pmod(F.xxhash64("id", F.lit(1)), n_chunks).cast("int").alias("chunk"))
    asked = rows.filter("is_query").select(F.col("id").alias("query_id"), "v", "d", "cell", "norm").dropDuplicates(["query_id", "v"])

    home = staged(_best(_solve(data, asked, n_chunks, k), k), "home")
    floor = home.filter(F.col("rank") == k).select("query_id", "v_hash", F.col("score").alias("least"))

    @F.pandas_udf("array<int>")
    def needed(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for vs, own, least in parts:
            out = []
            for v, c, low in zip(vs, own, least):
                p, cells, limits = bounds.value[len(v)]
                q = np.asarray(v, dtype=np.float64)
                norm = np.sqrt(q @ q)
                most = np.minimum(p[cells] @ q + norm * limits[:, 0], norm * limits[:, 1])
                # A little room for rounding: a cell too many costs time, one too few a result.
                reach = most + 1e-9 * (1 + np.abs(most)) + 1e-6 * norm
                out.append([x for x, m in zip(cells, reach) if x != c and (np.isnan(low) or m >= low)])
            yield pd.Series(out, dtype=object)

    marked = asked.withColumn("v_hash", F.xxhash64("v")).join(floor, ["query_id", "v_hash"], "left")
    spread = marked.withColumn("cell", F.explode(needed("v", "cell", F.col("least").cast("double")))).select("query_id", "v", "d", "cell")
    away = _solve(data, spread, n_chunks, k)
    found = home.select("query_id", "v_hash", "vec_id", "score").unionAll(away)
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows per query; each task keeps its own ``k`` best before the shuffle."""
    w = Window.partitionBy("query_id", "v_hash").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _solve(data: DataFrame, asked: DataFrame, n_chunks: Column, k: int) -> DataFrame:
    """The ``k`` best per query within each chunk of the cells that it asks for.

    Queries go to every chunk of the cell, data to every block of the cell's queries; a task holds one
    chunk and one block.
    """
    per_cell = asked.groupBy("d", "cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("int").alias("blocks"))
    sent = data.join(F.broadcast(per_cell), ["d", "cell"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    posed = asked.join(F.broadcast(per_cell), ["d", "cell"]).withColumns({
        "block": F.pmod(F.xxhash64("query_id", F.lit(2)), F.col("blocks")).cast("int"),
        "chunk": F.explode(F.sequence(F.lit(0), (n_chunks - 1).cast("int"))),
    })

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        q, x = _matrix(left["v"], 0), _matrix(right["x"], 0)
        ids, asks, out = right["id"].to_numpy(), left["query_id"].to_numpy(), []
        for at in range(0, len(q), 256):
            scores = q[at : at + 256] @ x.T if len(x) else np.zeros((len(q[at : at + 256]), 0))
            for i, row in enumerate(scores):
                row = np.where(ids == asks[at + i], -np.inf, row)
                kth = np.partition(row, -k)[-k] if len(row) > k else -np.inf
                near = np.flatnonzero((row >= kth) & np.isfinite(row))
                best = near[np.lexsort((ids[near], -row[near]))][:k]
                out.append(pd.DataFrame({"at": at + i, "vec_id": ids[best], "score": row[best]}))
        found = pd.concat(out, ignore_index=True) if out else pd.DataFrame({"at": [], "vec_id": [], "score": []})
        at = found["at"].to_numpy(dtype=np.int64)
        return pd.DataFrame({
            "query_id": asks[at], "v_hash": left["v_hash"].to_numpy()[at],
            "vec_id": found["vec_id"].astype("int64"), "score": found["score"].astype("int64"),
        })

    keys = ["d", "cell", "chunk", "block"]
    posed = posed.select(*keys, "query_id", "v", F.xxhash64("v").alias("v_hash"))
    # Both sides come from one table: fresh names keep their columns apart.
    sent = sent.select(*[F.col(c).alias(f"_{c}") for c in keys], "id", F.col("v").alias("x"))
    return posed.groupBy(*keys).cogroup(sent.groupBy(*[f"_{c}" for c in keys])).applyInPandas(
        search, "query_id long, v_hash long, vec_id long, score long")
