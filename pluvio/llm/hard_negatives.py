"""Mining of hard negatives by dual-tree search.

The upper level of both trees are pivots: candidates are nodes by their nearest pivot, anchors by pivot and label. From the
summaries of two nodes (pivot, radius, largest norm) follows an interval for all their inner products at once; a candidate
node whose interval misses what an anchor node still looks for is dropped for all of its anchors before a vector moves.
What is left travels: anchors to candidate nodes, and a candidate node's vectors to those blocks of anchors that need it.
There both sides are split further into ball trees, node pairs are pruned by the same intervals, best first, and pairs of
leaves are scored exactly.

Positives and negatives are the same search for different windows of scores: a positive may have any score and the
anchor's label, a negative another label and a score in a window below that of a positive. Each search has two rounds: the
first, among near nodes, gives bounds that the second is pruned with.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, inf

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._graph import Scratch, shared
from .knn import assigned, draw_pivots, matrix, quantised, scores

#: Numbers of a piece of candidates, and of a block of anchors, that one task holds.
PIECE_NUMBERS, BLOCK_NUMBERS = 1 << 21, 1 << 21
#: Vectors of a leaf of the trees in a task.
LEAF_CANDIDATES, LEAF_ANCHORS = 256, 32
_LONG = (-(2**63), 2**63 - 1)


@dataclass
class Tree:
    """A ball tree: node i has the rows order[start[i]:end[i]], which lie within radius[i] of centre[i]."""

    order: np.ndarray
    start: np.ndarray
    end: np.ndarray
    child: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    norm: np.ndarray

    @property
    def leaf(self) -> np.ndarray:
        return self.child[:, 0] < 0


def grow(x: np.ndarray, leaf: int) -> Tree:
    """Rows are halved at the median of the component that varies most, until a node has no more than `leaf`."""
    order, spans, child, todo = np.arange(len(x)), [(0, len(x))], [[-1, -1]], [0]
    while todo:
        i = todo.pop()
        start, end = spans[i]
        if end - start <= leaf:
            continue
        rows = order[start:end]
        along = x[rows, np.var(x[rows], axis=0).argmax()]
        half = (end - start) // 2
        order[start:end] = rows[np.argpartition(along, half)]
        child[i] = [len(spans), len(spans) + 1]
        todo += child[i]
        spans += [(start, start + half), (start + half, end)]
        child += [[-1, -1], [-1, -1]]
    start, end = np.array(spans).T
    centre = np.array([x[order[a:b]].mean(axis=0) for a, b in spans])
    own = np.sqrt((x * x).sum(axis=1))
    far = np.array([np.sqrt(((x[order[a:b]] - c) ** 2).sum(axis=1)).max() for (a, b), c in zip(spans, centre, strict=True)])
    return Tree(order, start, end, np.array(child), centre, far, np.array([own[order[a:b]].max() for a, b in spans]))


def interval(product, length_a, length_c, radius_a, radius_c, norm_a, norm_c, sqrt=np.sqrt, least=np.minimum, most=np.maximum):
    """Lowest and highest inner product of two balls with this product of their centres, widened for rounding."""
    spread = length_a * radius_c + length_c * radius_a + radius_a * radius_c
    full = norm_a * norm_c
    slack = 1e-6 * (1 + full)
    return most(product - spread, -full) - slack, least(product + spread, full) + slack


class _Windows:
    """The k best scores found so far in each window of each anchor."""

    def __init__(self, tops: list, lows: list, k: int):
        self.k = k
        self.tops = [[inf if t == _LONG[1] else t for t in x] for x in tops]
        self.lows = [[-inf if t == _LONG[0] else t for t in x] for x in lows]
        self.found = [[(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(x) for x in tops]
        self.low = np.array([self._outer(min(x), -1) for x in self.lows])
        self.top = np.array([self._outer(max(x), 1) for x in self.tops])

    @staticmethod
    def _outer(bound, way: int) -> float:
        """The bound as a double that rounding has not moved inwards."""
        return float(bound) + way * 1e-15 * abs(bound) if abs(bound) > 2**53 else float(bound)

    def add(self, i: int, ids: np.ndarray, values: np.ndarray) -> None:
        for w, (top, low) in enumerate(zip(self.tops[i], self.lows[i], strict=True)):
            fits = (values <= top) & (values >= low)
            if not fits.any():
                continue
            mine, his = (np.concatenate(x) for x in zip(self.found[i][w], (ids[fits], values[fits]), strict=True))
            best = np.lexsort((mine, -his))[: self.k] if his.dtype != object else np.array(sorted(range(len(his)), key=lambda j: (-his[j], mine[j]))[: self.k])
            self.found[i][w] = (mine[best], his[best])
            if len(best) == self.k:
                self.lows[i][w] = max(low, int(his[best[-1]]))
        self.low[i] = self._outer(min(self.lows[i]), -1)


def search(q: np.ndarray, q_ids, q_labels, windows: _Windows, x: np.ndarray, x_ids, x_labels, same: bool, leaves: tuple[int, int] = (LEAF_ANCHORS, LEAF_CANDIDATES)) -> int:
    """Fills the windows of anchors q from candidates x; returns how many pairs have been scored."""
    a, c = grow(q, leaves[0]), grow(x, leaves[1])
    length_a, length_c = (np.sqrt((tree.centre**2).sum(axis=1)) for tree in (a, c))
    product = a.centre @ c.centre.T

    def bounds(i, j):
        return interval(product[i, j], length_a[i], length_c[j], a.radius[i], c.radius[j], a.norm[i], c.norm[j])

    def of_node(values, function):
        return np.array([function(values[a.order[s:e]]) for s, e in zip(a.start, a.end, strict=True)])

    low, top = of_node(windows.low, np.min), of_node(windows.top, np.max)
    i, j, ready = np.zeros(1, int), np.zeros(1, int), []
    while len(i):
        lo, hi = bounds(i, j)
        open_ = (hi >= low[i]) & (lo <= top[i])
        i, j, hi = i[open_], j[open_], hi[open_]
        done = a.leaf[i] & c.leaf[j]
        ready.append(np.stack([i[done], j[done], hi[done]], axis=1))
        i, j = i[~done], j[~done]
        split = ~a.leaf[i] & (c.leaf[j] | (a.radius[i] * length_c[j] > c.radius[j] * length_a[i]))
        i, j = (
            np.concatenate([a.child[i[split]].ravel(), np.repeat(i[~split], 2)]),
            np.concatenate([np.repeat(j[split], 2), c.child[j[~split]].ravel()]),
        )
    pairs, scored, length = np.concatenate(ready), 0, np.sqrt((q * q).sum(axis=1))
    for i, j, hi in pairs[np.argsort(-pairs[:, 2], kind="stable")]:
        mine, his = a.order[a.start[int(i)] : a.end[int(i)]], c.order[c.start[int(j)] : c.end[int(j)]]
        mine = mine[windows.low[mine] <= hi]
        reach = q[mine] @ c.centre[int(j)] + length[mine] * c.radius[int(j)]
        mine = mine[windows.low[mine] <= reach + 1e-6 * (1 + np.abs(reach))]
        if not len(mine):
            continue
        score = scores(q[mine], x[his])
        scored += score.size
        score = score.astype(np.int64) if score.dtype != object else score
        fits = (score >= windows.low[mine][:, None]) & (score <= windows.top[mine][:, None])
        fits &= ((q_labels[mine][:, None] == x_labels[his]) == same) & (q_ids[mine][:, None] != x_ids[his])
        for row in np.flatnonzero(fits.any(axis=1)):
            windows.add(mine[row], x_ids[his[fits[row]]], score[row][fits[row]])
    return scored


def _solve(k: int, same: bool):
    """Winners (id, window, other, score) of anchors (id, label, v, tops, lows) among candidates (id, label, v) of one piece."""

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        out: tuple[list, list, list, list] = ([], [], [], [])
        if left.num_rows and right.num_rows:
            windows = _Windows(left["tops"].to_pylist(), left["lows"].to_pylist(), k)
            of = lambda t: (matrix(t["v"]), t["id"].to_numpy(), t["label"].to_numpy())
            (q, *anchor), (x, *candidate) = of(left), of(right)
            search(q, *anchor, windows, x, *candidate, same)
            for i, found in enumerate(windows.found):
                for w, (ids, values) in enumerate(found):
                    for column, value in zip(out, ([anchor[0][i]] * len(ids), [w] * len(ids), ids, values), strict=True):
                        column += list(value)
        score = [min(_LONG[1], max(_LONG[0], int(s))) for s in out[3]]
        return pa.table({"anchor_id": pa.array(out[0], pa.int64()), "w": pa.array(out[1], pa.int32()), "other": pa.array(out[2], pa.int64()), "score": pa.array(score, pa.int64())})

    return solve


@dataclass
class _Search:
    """The trees' upper level: candidates with their nodes, anchors with theirs, and the interval of each node pair."""

    data: DataFrame
    asked: DataFrame
    cells: DataFrame
    pairs: DataFrame
    blocks: int

    def winners(self, to: DataFrame, windows: DataFrame, k: int, same: bool) -> DataFrame:
        """(anchor_id, w, other, score): local winners of the anchors of node pairs `to` in the candidates of these.

        windows: anchor_id, tops, lows of the anchors that are still looking."""
        node, key = ["dim", "label", "own"], ["dim", "cell", "piece", "block"]
        block = F.pmod(F.xxhash64("id"), F.lit(self.blocks)).cast("int")
        looking = self.asked.join(windows, self.asked["id"] == windows["anchor_id"]).select("id", "v", *node, "tops", "lows", block.alias("block"))
        sent = looking.join(to.select(*node, "cell", "pieces"), node)
        needed = sent.select("dim", "cell", F.col("block").alias("to")).distinct()
        sent = sent.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).select(*key, "id", "label", "v", "tops", "lows")
        piece = F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int").alias("piece")
        kept = self.data.join(self.cells.select("dim", "cell", "pieces"), ["dim", "cell"]).select("dim", "cell", piece, "id", "label", "v")
        kept = kept.join(needed, ["dim", "cell"]).withColumn("block", F.col("to")).select(*key, "id", "label", "v")
        shape = "anchor_id long, w int, other long, score long"
        return sent.groupBy(*key).cogroup(kept.groupBy(*key)).applyInArrow(_solve(k, same), shape)

    def of_nodes(self, per_anchor: DataFrame, *aggregates: Column) -> DataFrame:
        """Aggregates over the anchors of each anchor node."""
        node = self.asked.select(F.col("id").alias("anchor_id"), "dim", "label", "own")
        return per_anchor.join(node, "anchor_id").groupBy("dim", "label", "own").agg(*aggregates)


def _upper(vectors: DataFrame, anchors: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int, pivots: int | None, piece_numbers: int, block_numbers: int, scratch: Scratch) -> _Search:
    numeric = vectors.schema[label_col].dataType.typeName() in {"byte", "short", "integer", "long"}
    label = (F.col(label_col).cast("long") if numeric else F.xxhash64(label_col)).alias("label")
    of = lambda df: quantised(df.where(F.col(label_col).isNotNull()), id_col, vector_col, scale, label)
    data = of(vectors)
    held = draw_pivots(data, pivots)
    data = scratch.stored(assigned(data, held))
    one = of(anchors).groupBy("id").agg(F.min(F.struct("dim", "v", "label")).alias("x")).select("id", "x.dim", "x.v", "x.label")
    asked = scratch.stored(assigned(one, held).withColumnRenamed("cell", "own"))
    dim = asked.agg(F.count("*").alias("n"), F.max("dim").alias("dim")).first()
    size = max(1, piece_numbers // (dim.dim or 1))
    counts = data.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.max("distance").alias("radius"), F.max("norm").alias("most"))
    cells = scratch.stored(counts.withColumn("pieces", F.ceil(F.col("n") / size).cast("int")))
    nodes = asked.groupBy("dim", "label", "own").agg(F.max("distance").alias("radius_a"), F.max("norm").alias("most_a"))
    sent = vectors.sparkSession.sparkContext.broadcast(held)
    columns = ["dim", "label", "own", "cell", "n", "pieces"]

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = lambda name: batch.column(name).to_numpy()  # noqa: B023, E731
            lo, hi, dims = np.empty(batch.num_rows), np.empty(batch.num_rows), col("dim")
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                p = sent.value.get(int(dim), np.zeros((1, dim)))
                length, (a, c) = np.sqrt((p**2).sum(axis=1)), (col("own")[at], col("cell")[at])
                rest = (col(name)[at] for name in ("radius_a", "radius", "most_a", "most"))
                lo[at], hi[at] = interval((p @ p.T)[a, c], length[a], length[c], *rest)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(lo), pa.array(hi)], [*columns, "lo", "hi"])

    pairs = nodes.join(cells, "dim").mapInArrow(bounds, "dim int, label long, own int, cell int, n long, pieces int, lo double, hi double")
    own = data.groupBy("dim", "cell", "label").agg(F.count("*").alias("n_own"))
    pairs = scratch.stored(pairs.join(own, ["dim", "cell", "label"], "left").withColumn("n_own", F.coalesce("n_own", F.lit(0))))
    return _Search(data, asked, cells, pairs, max(1, ceil(dim.n * (dim.dim or 1) / block_numbers)))


def hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 5,
    share: tuple[int, int] = (80, 100),
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    scale: int = 256,
    pivots: int | None = None,
    piece_numbers: int = PIECE_NUMBERS,
    block_numbers: int = BLOCK_NUMBERS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the hardest negatives.

    Components are multiplied by `scale` and rounded down; the score is the integer inner product. An anchor's positives are
    the best `positives` other rows of its label. For each of them the best `negatives` rows of other labels follow, whose
    score is no more than the positive's and at least share[0] / share[1] of it, so that a positive of negative score has
    none. Ties go to the smaller id; if there are fewer, all are returned.

    Rows without id or label, and vectors that are null, empty or hold null or non-finite components, take no part. Only
    vectors of the anchor's dimension meet it. Rows that repeat an id are a candidate each, but none of them is a partner of
    the anchor of that id; of anchors that repeat an id the one with the fewest dimensions, then the least vector and label,
    is taken. Labels may be of any type that hashes. Scores beyond the range of a long are its ends. Other columns are not
    read. Without anchors, positives or negatives there are no rows.

    pivots: nodes of the trees' upper level, by default the square root of the number of vectors within knn's bounds; they
    alone come to the driver. piece_numbers, block_numbers: numbers of candidates and of anchors that a task holds.
    """
    if not 0 <= share[0] < share[1]:
        raise ValueError(f"share {share} is not of 0 <= a < b")
    node = ["dim", "label", "own"]
    with Scratch(vectors.sparkSession) as scratch:
        trees = _upper(vectors, anchors, id_col, label_col, vector_col, scale, pivots, piece_numbers, block_numbers, scratch)
        near_first = Window.partitionBy(*node).orderBy(F.desc(F.col("cell") == F.col("own")), F.desc("hi"), "cell")
        before = F.coalesce(F.sum("n_own").over(near_first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        # The first nodes that hold more rows of the label than positives are wanted.
        pairs = scratch.stored(trees.pairs.withColumn("first", before <= positives))
        best = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "other"))

        any_score = trees.asked.select(F.col("id").alias("anchor_id"), F.array(F.lit(_LONG[1])).alias("tops"), F.array(F.lit(_LONG[0])).alias("lows"))
        ours = pairs.where("n_own > 0")
        near = scratch.stored(trees.winners(ours.where("first"), any_score, positives, True))
        kth = near.withColumn("r", best("anchor_id")).where(F.col("r") == positives).select("anchor_id", F.col("score").alias("kth"))
        still = any_score.join(kth, "anchor_id", "left").withColumn("lows", F.array(F.coalesce("kth", F.lit(_LONG[0]))))
        reach = trees.of_nodes(still, F.min(F.element_at("lows", 1)).alias("reach"))
        open_ = ours.where("not first").join(reach, node).where("hi >= reach")
        far = trees.winners(open_, still.drop("kth"), positives, True)
        found = near.unionByName(far).withColumn("p", best("anchor_id")).where(F.col("p") <= positives)
        found = scratch.stored(found.select("anchor_id", "p", F.col("other").alias("positive_id"), F.col("score").alias("positive_score")))

        # ceil(share * score), by whole numbers.
        low = F.expr(f"({share[0]} * positive_score + {share[1] - 1}) div {share[1]}")
        wanted = found.where("positive_score >= 0").withColumn("low", low)
        packed = wanted.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("p", F.col("positive_score").alias("top"), "low"))).alias("x"))
        # No more than `positives` windows an anchor.
        windows = scratch.stored(packed.select("anchor_id", F.col("x.top").alias("tops"), F.col("x.low").alias("lows"), F.col("x.p").alias("ps")))
        theirs = pairs.where("n > n_own")

        def inside(to: DataFrame, of: DataFrame) -> DataFrame:
            reach = trees.of_nodes(of, F.min(F.array_min("lows")).alias("reach"), F.max(F.array_max("tops")).alias("ceiling"))
            return to.join(reach, node).where("hi >= reach and lo <= ceiling")

        near = scratch.stored(trees.winners(inside(theirs.where("first"), windows), windows, negatives, False))
        kth = near.withColumn("r", best("anchor_id", "w")).where(F.col("r") == negatives).groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("kth"))
        tighter = F.when(F.col("kth").isNull(), F.col("lows")).otherwise(F.transform("lows", lambda x, i: F.greatest(x, F.try_element_at("kth", i))))
        still = windows.join(kth, "anchor_id", "left").withColumn("lows", tighter).drop("kth")
        far = trees.winners(inside(theirs.where("not first"), still), still, negatives, False)
        mined = near.unionByName(far).withColumn("rank", best("anchor_id", "w")).where(F.col("rank") <= negatives)
        mined = mined.join(windows.select("anchor_id", "ps"), "anchor_id").withColumn("p", F.element_at("ps", F.col("w") + 1))
        out = mined.join(found, ["anchor_id", "p"])
        return shared(out.select("anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
