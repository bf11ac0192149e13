"""Exact top-k inner products by a Voronoi join.

Pivots cut the vectors, queries among them, into cells. Each cell is summed up by its
count and by the largest distance r of a member to its pivot p. A query q scores at most
q.p + |q| r and at least q.p - |q| r in a cell; so cells whose counts add up to k and the
query's own rows give a score that the k-th best of a query surely reaches, and cells that
cannot reach it are not visited. Queries first meet their own cell, which sharpens that score, and then go,
grouped by cell, to the other cells that may still hold a better one. Cells are dealt out
in blocks of bounded size, queries in groups; a block is replicated to the groups with
queries that visit its cell, and what is left of each is at most k rows per query.

Defined results: vectors that are null or hold a null or a number that is not finite take
no part; of vectors of different length the shorter is filled up with zeros; queries are
ids divisible by ``every``; a null id takes no part; of rows that repeat an id, each is a
candidate of its own, none is one for its own id, and the least vector is the query; equal
scores go to the smaller id. Scores are exact as long as they fit 53 bits, and rounded to double
precision beyond. No rows give none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from rosterlake.llm.tables import digits_hash, written

PIVOTS = 64  # also bounds the summaries that are broadcast
SCALE = 256.0
BLOCK_ROWS = 4096  # vectors of a cell that one block holds, on average
GROUP_QUERIES = 16_384  # of a query group, on average
QUERY_ROWS = 1024  # queries compared with a block at once
LIMIT = float(2 ** 62)


def _matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    flat = np.zeros((len(vectors), dim))
    for row, vector in zip(flat, vectors):
        row[:len(vector)] = vector
    return flat


def _best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> pd.DataFrame:
    """At most k best of ``vectors`` for each query, by score and then smaller id."""
    order = np.argsort(ids, kind="stable")
    ids, vectors, found = ids[order], vectors[order], []
    for at in range(0, len(queries), QUERY_ROWS):
        names = query_ids[at:at + QUERY_ROWS]
        scores = queries[at:at + QUERY_ROWS] @ vectors.T
        scores[names[:, None] == ids[None, :]] = -np.inf
        if scores.shape[1] > k:
            edge = np.partition(scores, -k, axis=1)[:, -k][:, None]
            # All above the k-th score, and of those that equal it the first (smaller ids), up to k.
            above, level = scores > edge, scores == edge
            level &= np.cumsum(level, axis=1) <= k - above.sum(1)[:, None]
            rows, cols = np.nonzero(above | level)
        else:
            rows, cols = np.nonzero(np.ones(scores.shape, bool))
        real = np.isfinite(scores[rows, cols])
        rows, cols = rows[real], cols[real]
        found.append(pd.DataFrame({"query_id": names[rows], "vec_id": ids[cols], "score": np.clip(scores[rows, cols], -LIMIT, LIMIT).astype("int64")}))
    return pd.concat(found) if found else pd.DataFrame({c: np.zeros(0, "int64") for c in ("query_id", "vec_id", "score")})


def _top(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _solve(data: DataFrame, visits: DataFrame, k: int, dim: int) -> DataFrame:
    """Best rows of each block for each group of queries that visits its cell."""
    schema = "query_id long, vec_id long, score long"

    def block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({c: np.zeros(0, "int64") for c in ("query_id", "vec_id", "score")})
        return _best(right["query_id"].to_numpy(), _matrix(right["q"], dim), left["id"].to_numpy(), _matrix(left["v"], dim), k)

    visits = written(visits, "visits")
    # One row per cell and query group; a block goes to the groups that come to its cell.
    data = data.join(written(visits.select("cell", "query_group").distinct(), "query-groups"), "cell")
    keys = ["cell", "block", "query_group"]
    return data.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInPandas(block, schema)


def voronoi_top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_column: str = "vec_id", vector_column: str = "embedding",
                  pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS, group_queries: int = GROUP_QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score`` over the vectors' components times 256, rounded down."""
    clean = vectors.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{vector_column}`").cast("array<double>").alias("v")).where(
        "id is not null and v is not null and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    whole = written(clean.withColumn("v", F.transform("v", _floor)), "vectors")
    dim = whole.agg(F.max(F.size("v"))).first()[0] or 0
    # A bounded number of vectors, spread by hash.
    centres = whole.select("v").groupBy("v").agg(F.lit(1)).orderBy(digits_hash(F.to_json(F.struct("v"))), "v").limit(pivots).select("v").toPandas()
    centre = _matrix(centres["v"], dim)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            m = _matrix(rows["v"], dim)
            square = np.maximum((m ** 2).sum(1)[:, None] - 2 * m @ centre.T + (centre ** 2).sum(1)[None, :], 0)
            cell = square.argmin(1)
            # Distances from the differences themselves: no cancellation, so a bound is a bound.
            yield rows.assign(cell=cell.astype("int32"), far=np.sqrt(((m - centre[cell]) ** 2).sum(1)))

    placed = written(whole.mapInPandas(nearest, "id long, v array<double>, cell int, far double"), "cells") if len(centre) else (
        whole.withColumns({"cell": F.lit(0), "far": F.lit(0.0)}))
    summary = placed.groupBy("cell").agg(F.count("*").alias("rows"), F.max("far").alias("radius")).toPandas()  # one row per pivot at most
    if summary.empty:
        return placed.selectExpr("id as query_id", "0 as rank", "id as vec_id", "0L as score").limit(0)
    cells, counts, radius = (summary[c].to_numpy() for c in ("cell", "rows", "radius"))
    blocks = dict(zip(cells.tolist(), np.ceil(counts / block_rows).astype(int).tolist()))
    block_count = F.element_at(F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair]), F.col("cell"))
    data = placed.withColumn("block", F.pmod(F.xxhash64("id"), block_count).cast("int")).select("cell", "block", "id", "v")
    queries = placed.where(F.pmod("id", F.lit(every)) == 0)

    def visited(own_cell: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in batches:
                q = _matrix(rows["v"], dim)
                middle, reach = q @ centre[cells].T, np.sqrt((q ** 2).sum(1))[:, None] * radius[None, :]
                slack = 1e-9 * (np.abs(middle) + reach) + 1e-6
                most, least = middle + reach + slack, middle - reach - slack
                own = rows["cell"].to_numpy()[:, None] == cells[None, :]
                if own_cell:
                    go = own
                else:
                    # The k-th score so far, or what cells with k members and the id's own rows ensure.
                    order = np.argsort(-least, axis=1)
                    enough = np.cumsum(counts[order], axis=1) >= k + rows["copies"].to_numpy()[:, None]
                    ensured = np.where(enough.any(1), least[np.arange(len(q)), order[np.arange(len(q)), enough.argmax(1)]], -np.inf)
                    go = ~own & (most >= np.maximum(ensured, rows["reached"].fillna(-np.inf).to_numpy())[:, None])
                r, c = np.nonzero(go)
                yield pd.DataFrame({"query_id": rows["id"].to_numpy()[r], "q": rows["v"].to_numpy()[r], "cell": cells[c].astype("int32")})
        return run

    def visits(rows: DataFrame, own_cell: bool) -> DataFrame:
        to = rows.mapInPandas(visited(own_cell), "query_id long, q array<double>, cell int")
        return to.withColumn("query_group", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int")).withColumn(
            "block", F.explode(F.sequence(F.lit(0), block_count - 1)))

    asked = queries.groupBy("id").agg(F.min(F.struct("v", "cell")).alias("of"), F.count("*").alias("copies")).select(
        "id", "of.v", "of.cell", "copies")
    groups = asked.count() // group_queries + 1
    own = written(_top(_solve(data, visits(asked, True), k, dim), k), "own")
    reached = own.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("reached"))
    others = visits(asked.join(reached, "id", "left"), False)
    rest = _solve(data, others, k, dim)
    return _top(own.select("query_id", "vec_id", "score").unionByName(rest), k).select("query_id", "rank", "vec_id", "score")


def _floor(x: Column) -> Column:
    """Rounded down and still a double, whatever its size."""
    scaled = x * F.lit(SCALE)
    return F.when(F.abs(scaled) < F.lit(float(2 ** 53)), F.floor(F.when(F.abs(scaled) < F.lit(float(2 ** 53)), scaled).otherwise(F.lit(0.0))).cast("double")).otherwise(scaled)
