"""Exact top-k inner-product search as a Voronoi-partitioned kNN join.

Data and queries are grouped by their nearest pivot, and each group is summed up by its size, its radius and its largest
norm. A query is first solved among the vectors of some near groups, which gives it a true k-th score. From a group's
summary follows the highest score that any of its vectors can have with the query; the query is sent on only to the
groups in which that reaches its k-th score, and there meets only the vectors that are far enough from the pivot to do
so. Queries are few against the data, so that they are replicated; beyond a block of queries a group's vectors go once to
each block that has a query for that group, and to no other. Each (group, piece, block) is solved locally, and the local
winners of each query are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, inf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ._graph import Scratch, shared

#: Pivots: as many as the square root of the number of vectors, within these bounds; they are broadcast.
LEAST_PIVOTS, MOST_PIVOTS = 8, 1024
#: Numbers in all pivots at most: fewer pivots are drawn where vectors are very long.
MOST_NUMBERS = 1 << 22
#: Vectors of one group that are solved together; a larger group is dealt to several pieces.
PIECE_VECTORS = 8192
#: Queries that come to a piece together; more are dealt to blocks, and a piece is sent to those of them that need its group.
GROUP_QUERIES = 8192
#: Queries of one piece whose scores are held at once.
BLOCK_QUERIES = 256
#: Largest sum that a double holds exactly; beyond it Python integers are used.
_EXACT = 2**53


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int, *more: Column) -> DataFrame:
    """(id, dim, v): components times `scale`, rounded down; without vectors that are null, empty, or not finite throughout.
    More columns follow."""
    v = F.transform(vector_col, lambda x: x.cast("double"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(inf)))
    whole = F.transform(v, lambda x: F.floor(x * scale).cast("double"))
    return (
        vectors.where(F.col(vector_col).isNotNull() & F.col(id_col).isNotNull())
        .where(finite & (F.size(vector_col) > 0))
        .select(F.col(id_col).cast("long").alias("id"), F.size(vector_col).alias("dim"), whole.alias("v"), *more)
    )


def draw_pivots(data: DataFrame, pivots: int | None) -> dict[int, np.ndarray]:
    """Different vectors of each dimension, drawn by the least hashes of their ids: by default as many as the square root of
    the number of vectors."""
    size = data.agg(F.count("*").alias("n"), F.max("dim").alias("dim")).first()
    if pivots is None:
        pivots = min(MOST_PIVOTS, max(LEAST_PIVOTS, ceil(sqrt(size.n))))
    pivots = min(pivots, max(1, MOST_NUMBERS // (size.dim or 1)))
    drawn = data.select("id", "dim", "v").orderBy(F.xxhash64("id"), "id", "v").limit(pivots).collect()
    return {dim: np.unique(np.array([r.v for r in drawn if r.dim == dim]), axis=0) for dim in {r.dim for r in drawn}}


def assigned(data: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """data with its nearest pivot, the distance to it, and its own norm. A dimension without pivots has the pivot 0."""
    held = data.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                x = matrix(part.column("v"))
                p = held.value.get(int(dim), np.zeros((1, dim)))
                cell, distance = np.empty(len(x), np.int64), np.empty(len(x))
                own = (p**2).sum(axis=1)
                for at in range(0, len(x), 1024):
                    y = x[at : at + 1024]
                    near = (own - 2 * y @ p.T).argmin(axis=1)
                    cell[at : at + 1024] = near
                    distance[at : at + 1024] = np.sqrt(((y - p[near]) ** 2).sum(axis=1))
                more = [pa.array(cell, pa.int32()), pa.array(distance), pa.array(np.sqrt((x**2).sum(axis=1)))]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], [*part.schema.names, "cell", "distance", "norm"])

    shape = StructType(list(data.schema.fields)).add("cell", "integer").add("distance", "double").add("norm", "double")
    return data.mapInArrow(run, shape)


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    most = (np.abs(q).max(initial=0)) * (np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if most < _EXACT:
        return np.rint(q @ x.T)
    whole = np.vectorize(int, otypes=[object])
    return whole(q).dot(whole(x).T)


def _best(queries: np.ndarray, scores: np.ndarray, data: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each query its k best candidates: highest score first, ties to the smaller id, itself left out."""
    for i, row in enumerate(scores):
        other = data != queries[i]
        near, mine = row[other], data[other]
        if len(near) > k and near.dtype != object:
            least = np.partition(near, len(near) - k)[len(near) - k]
            near, mine = near[near >= least], mine[near >= least]
        order = np.array(sorted(range(len(near)), key=lambda j: (-near[j], mine[j]))[:k], np.int64) if near.dtype == object else np.lexsort((mine, -near))[:k]
        yield np.full(len(order), queries[i]), mine[order], near[order]


def _solve(k: int):
    """Winners of queries (id, v, least: a score that k candidates reach) among vectors (id, v, distance) of one piece."""

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0),)]
        if left.num_rows and right.num_rows:
            q, x = matrix(left["v"]), matrix(right["v"])
            qi, xi = left["id"].to_numpy(), right["id"].to_numpy()
            reach, distance = left["reach"].to_numpy(), right["distance"].to_numpy()
            # Vectors far from the pivot first, and queries that need but few of them first.
            near, need = np.argsort(-distance, kind="stable"), np.argsort(-reach, kind="stable")
            x, xi, distance = x[near], xi[near], distance[near]
            q, qi, reach = q[need], qi[need], reach[need]
            for at in range(0, len(q), BLOCK_QUERIES):
                to = int(np.searchsorted(-distance, -reach[at : at + BLOCK_QUERIES].min(), "right"))
                found += _best(qi[at : at + BLOCK_QUERIES], scores(q[at : at + BLOCK_QUERIES], x[:to]), xi[:to], k)
        query, other, score = (np.concatenate(c) for c in zip(*found, strict=True))
        return pa.table({"query_id": pa.array(query, pa.int64()), "id": pa.array(other, pa.int64()), "score": pa.array([max(-(2**63), min(2**63 - 1, int(s))) for s in score], pa.int64())})

    return solve


def _dealt(pieces: Column) -> Column:
    return F.pmod(F.xxhash64("id"), pieces).cast("int")


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
    pivots: int | None = None,
    piece_vectors: int = PIECE_VECTORS,
    group_queries: int = GROUP_QUERIES,
) -> DataFrame:
    """(query_id, rank, id, score) of the k vectors with the highest integer inner product with each query.

    Components are first multiplied by `scale` and rounded down. Ties go to the smaller id; a query whose id is a vector's
    id does not find that vector. If there are fewer candidates than k, all are returned; without any, the query has no
    rows. Vectors that are null or empty, have a null id, or hold null or non-finite components take no part; vectors of
    another dimension than the query's are no candidates, and any number of dimensions may meet in one table. Rows that
    repeat an id are one candidate each. Scores beyond the range of a long are its ends. Of
    queries that repeat an id, the one with the fewest dimensions and then the least vector is taken; it finds no row of its
    id. Other columns are not read.

    pivots: how many are drawn, by the least hashes of their ids; by default the square root of the number of vectors, from
    LEAST_PIVOTS to MOST_PIVOTS in all dimensions together. They alone come to the driver and are broadcast.
    """
    with Scratch(vectors.sparkSession) as scratch:
        local, _ = _winners(vectors, queries, k, id_col, vector_col, scale, pivots, piece_vectors, group_queries, scratch)
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        return shared(local.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score"))


def visited(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256, pivots: int | None = None) -> float:
    """The share of all (query, vector) pairs that lie in groups to which the query is sent."""
    with Scratch(vectors.sparkSession) as scratch:
        _, sent = _winners(vectors, queries, k, id_col, vector_col, scale, pivots, PIECE_VECTORS, GROUP_QUERIES, scratch)
        return float(sent.agg(F.sum(F.when(F.col("goes"), F.col("n")).otherwise(0)) / F.sum("n")).first()[0] or 0)


def _winners(vectors, queries, k, id_col, vector_col, scale, pivots, piece_vectors, group_queries, scratch) -> tuple[DataFrame, DataFrame]:
    """(query_id, id, score): the k best of each query among them; and (n, goes) of each query and group."""
    data = quantised(vectors, id_col, vector_col, scale)
    held = draw_pivots(data, pivots)
    data = scratch.stored(assigned(data, held))
    asked = assigned(quantised(queries, id_col, vector_col, scale).groupBy("id").agg(F.min_by("dim", F.struct("dim", "v")).alias("dim"), F.min_by("v", F.struct("dim", "v")).alias("v")), held)
    asked = scratch.stored(asked.withColumnRenamed("cell", "own").select("id", "dim", "v", "own", "norm"))
    cells = data.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.max("distance").alias("radius"), F.max("norm").alias("most"))
    # A row for each group: as many as pivots, and one for each dimension without.
    cells = scratch.stored(cells.withColumn("pieces", F.ceil(F.col("n") / piece_vectors).cast("int")))
    spread = scratch.spark.sparkContext.broadcast(held)

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The highest score that a query can have in a group, and its product with the pivot."""
        for batch in batches:
            product = np.empty(batch.num_rows)
            dims, cell = batch.column("dim").to_numpy(), batch.column("cell").to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                p = spread.value.get(int(dim), np.zeros((1, dim)))
                product[at] = (matrix(batch.column("v").take(pa.array(at))) * p[cell[at]]).sum(axis=1)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "dim", "cell", "own", "norm", "n", "pieces", "radius", "most")), pa.array(product)], ["id", "dim", "cell", "own", "norm", "n", "pieces", "radius", "most", "product"])

    met = asked.join(F.broadcast(cells), "dim").mapInArrow(bounds, "id long, dim int, cell int, own int, norm double, n long, pieces int, radius double, most double, product double")
    slack = lambda x: 1e-6 * (1 + F.abs(x))
    top = F.least(F.col("product") + F.col("norm") * F.col("radius"), F.col("norm") * F.col("most"))
    met = scratch.stored(met.withColumn("top", top + slack(top)))
    ranked = Window.partitionBy("id").orderBy(F.desc(F.col("cell") == F.col("own")), F.desc("top"), "cell")
    before = F.coalesce(F.sum("n").over(ranked.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # The first groups that hold more than k vectors; rows that repeat the query's id do not count, whatever their number.
    near = met.withColumn("first", before <= k)
    shape, blocks = "query_id long, id long, score long", max(1, ceil(asked.count() / group_queries))

    def solved(to: DataFrame) -> DataFrame:
        sent = asked.select("id", "v").join(to, "id").select("id", "v", "dim", "cell", "reach", _dealt(F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
        needed = sent.select("dim", "cell", F.col("block").alias("to")).distinct()
        kept = data.join(F.broadcast(cells.select("dim", "cell", "pieces")), ["dim", "cell"]).select("id", "v", "distance", "dim", "cell", _dealt(F.col("pieces")).alias("piece"))
        kept = kept.join(needed, ["dim", "cell"]).withColumnRenamed("to", "block")
        key = ["dim", "cell", "piece", "block"]
        return sent.groupBy(*key).cogroup(kept.groupBy(*key)).applyInArrow(_solve(k), shape)

    first = scratch.stored(solved(near.where("first").withColumn("reach", F.lit(-1.0))))
    kth = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    least = first.withColumn("r", F.row_number().over(kth)).where(F.col("r") == k).select(F.col("query_id").alias("id"), F.col("score").alias("least"))
    far = near.join(least, "id", "left").withColumn("goes", F.col("first") | F.col("least").isNull() | (F.col("top") >= F.col("least")))
    far = scratch.stored(far)
    reach = F.when(F.col("least").isNull() | (F.col("norm") == 0), -1.0).otherwise((F.col("least") - F.col("product")) / F.col("norm"))
    second = solved(far.where("goes and not first").withColumn("reach", reach - slack(reach)))
    return first.unionByName(second), far.select("n", "goes")
