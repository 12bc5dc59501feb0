"""Near duplicates among vectors by iterative quantisation and multi-index Hamming tables.

Unit vectors are centred, turned by rotations that are learnt to bring them near the corners of a cube (Gong and Lazebnik's
iterative quantisation), and cut to their signs. Substrings of these codes are the keys of as many tables; vectors that share
a key in some table meet, and the cosine of the original vectors decides. How many tables there must be is measured on
pairs made at the very threshold. A pair counts in the first table that it shares, so that links are counted once without
ever being listed: a task puts out a row for each of its vectors, with how many it is linked to and the least vector that it
reaches there.

Crowds do not meet pair by pair. Equal vectors are one, with a weight. Where a key holds more vectors than a task takes,
some of these are drawn as centres: vectors within half the threshold's angle of a centre are all linked by the triangle
inequality, and only counted. What is left of a crowded key is dealt to pieces that meet two by two.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from math import acos, cos, inf, log2, sin, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._graph import Scratch, components, shared
from .knn import matrix

#: Vectors that rotations are learnt from, drawn by the least hashes of their row numbers.
SAMPLE_VECTORS = 4096
#: Bits of one rotation at most; of longer vectors the leading principal directions are turned.
MOST_BITS = 64
#: Turns of learning for a rotation.
TURNS = 30
#: Tables are added until this share of pairs at the threshold meets, up to so many tables.
RECALL, MOST_TABLES = 0.999, 96
#: Vectors that should share a key on average; with it the length of a key follows the size of the table.
KEY_VECTORS = 128
#: Vectors of a key that one task takes, for vectors of up to so many numbers in all.
PIECE_VECTORS, PIECE_NUMBERS = 2048, 1 << 20
#: Crowded keys of which centres are drawn, and centres of each.
CROWDED_KEYS, CENTRES = 512, 4


@dataclass
class Index:
    """Rotations and the cut of their codes: bits are the signs of (unit vector - mean) @ turn, table t has `key_bits` of them."""

    key_bits: int
    tables: int = 0
    mean: np.ndarray | None = None
    turn: np.ndarray | None = None
    recall: float = 0.0
    shape: tuple = field(default=(), repr=False)

    def keys(self, units: np.ndarray) -> np.ndarray:
        """A row of table keys for each unit vector."""
        bits = (units - self.mean) @ self.turn[:, : self.tables * self.key_bits] > 0
        place = 1 << np.arange(self.key_bits)
        return (bits.reshape(len(units), self.tables, self.key_bits) * place).sum(axis=2).astype(np.int32)


def units(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 without overflow."""
    x = np.asarray(x, float)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def rotation(v: np.ndarray, rng: np.random.Generator, turns: int = TURNS) -> np.ndarray:
    """An orthogonal matrix that brings the rows of v near the corners of a cube: corners and rotation are fitted in turn."""
    r = np.linalg.qr(rng.standard_normal((v.shape[1],) * 2))[0]
    for _ in range(turns):
        left, _, right = np.linalg.svd(np.where(v @ r > 0, 1.0, -1.0).T @ v)
        r = right.T @ left.T
    return r


def at_angle(x: np.ndarray, angle: float, rng: np.random.Generator) -> np.ndarray:
    """Unit vectors at this angle from the rows of x, half in any direction and half as the rows themselves differ."""
    z = rng.standard_normal(x.shape)
    half = len(x) // 2
    z[:half] = x[rng.permutation(len(x))[:half]] - x[rng.permutation(len(x))[:half]]
    z -= (z * x).sum(axis=1, keepdims=True) * x
    length = np.sqrt((z * z).sum(axis=1, keepdims=True))
    return np.where(length > 1e-9, cos(angle) * x + sin(angle) * z / np.maximum(length, 1e-9), x)


def learn(sample: np.ndarray, threshold: float, key_bits: int, recall: float = RECALL, most_tables: int = MOST_TABLES, seed: int = 1) -> Index:
    """Rotations for unit vectors like those of the sample, and as many tables as `recall` needs at the threshold."""
    rng, dim = np.random.default_rng(seed), sample.shape[1]
    mean = sample.mean(axis=0) if len(sample) > dim else np.zeros(dim)
    centred = sample - mean
    if len(sample):
        axes = np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :MOST_BITS]
    else:
        axes = np.eye(dim)[:, :MOST_BITS]
    x = sample[: 1 << 11]
    y = at_angle(x, acos(threshold), rng)
    index = Index(key_bits, 0, mean, np.zeros((dim, 0)))
    met = np.zeros(len(x), bool)
    while index.tables < most_tables and (index.recall < recall or not index.tables):
        while index.turn.shape[1] < (index.tables + 1) * key_bits:
            index.turn = np.hstack([index.turn, axes @ rotation(centred @ axes, rng)])
        index.tables += 1
        met |= index.keys(x)[:, -1] == index.keys(y)[:, -1]
        index.recall = float(met.mean()) if len(met) else 1.0 - (1.0 - (1.0 - acos(threshold) / np.pi) ** key_bits) ** index.tables
    return index


def _fit(vectors: DataFrame, threshold: float, key_bits: int | None, sample: int) -> dict[int, Index]:
    """An index for each number of dimensions that the sample knows."""
    n = vectors.count()
    bits = key_bits or min(24, max(4, round(log2(max(n, 1) / KEY_VECTORS)))) if n else 4
    drawn = vectors.select("dim", "v").orderBy(F.xxhash64("rid"), "rid").limit(sample).collect()
    of = lambda dim: units(np.array([r.v for r in drawn if r.dim == dim], float))
    return {0: Index(bits)} | {dim: learn(of(dim), threshold, bits) for dim in {r.dim for r in drawn}}


def _index_of(held: dict[int, Index], dim: int, threshold: float) -> Index:
    if dim not in held:
        held[dim] = learn(np.zeros((0, dim)), threshold, held[0].key_bits)
    return held[dim]


def _keyed(vectors: DataFrame, held: dict[int, Index], threshold: float) -> DataFrame:
    """vectors with the array of their keys, one for each table."""
    sent = vectors.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dict(sent.value)
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                keys = _index_of(known, int(dim), threshold).keys(units(matrix(part.column("v"))))
                flat = pa.ListArray.from_arrays(np.arange(len(keys) + 1, dtype=np.int32) * keys.shape[1], pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, flat], [*part.schema.names, "keys"])

    return vectors.mapInArrow(run, vectors.withColumn("keys", F.lit(None).cast("array<int>")).schema)


def _centres(keyed: DataFrame, piece: int, half: float) -> dict[int, np.ndarray]:
    """Some vectors of the most crowded keys of the first table, none within half the angle of another."""
    crowded = keyed.groupBy("dim", F.element_at("keys", 1).alias("key")).agg(F.count("*").alias("n")).where(F.col("n") > piece)
    crowded = crowded.orderBy(F.desc("n"), "dim", "key").limit(CROWDED_KEYS).drop("n")
    if crowded.isEmpty():
        return {}
    inside = keyed.select("dim", F.element_at("keys", 1).alias("key"), "rid", "v").join(F.broadcast(crowded), ["dim", "key"])
    drawn = inside.groupBy("dim", "key").agg(*[F.min_by("v", F.xxhash64("rid", F.lit(i))).alias(f"c{i}") for i in range(CENTRES)])
    kept: dict[int, list] = {}
    for row in drawn.orderBy("dim", "key").collect():
        for i in range(CENTRES):
            v = units(np.array([row[f"c{i}"]], float))[0]
            if all(v @ c < cos(half) for c in kept.setdefault(row.dim, [])):
                kept[row.dim].append(v)
    return {dim: np.array(c) for dim, c in kept.items()}


def _in_balls(keyed: DataFrame, centres: dict[int, np.ndarray], half: float) -> DataFrame:
    """keyed with the number of the nearest centre where it is within half the angle, else -1."""
    if not centres:
        return keyed.withColumn("ball", F.lit(-1))
    sent = keyed.sparkSession.sparkContext.broadcast(centres)
    first = dict(zip(sorted(centres), np.cumsum([0, *(len(centres[d]) for d in sorted(centres))]), strict=False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, ball = batch.column("dim").to_numpy(), np.full(batch.num_rows, -1, np.int32)
            for dim in set(np.unique(dims)) & set(sent.value):
                at = np.flatnonzero(dims == dim)
                near = units(matrix(batch.column("v").take(pa.array(at)))) @ sent.value[dim].T
                best = near.argmax(axis=1)
                ball[at] = np.where(near.max(axis=1) >= cos(half), best + first[dim], -1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ball)], [*batch.schema.names, "ball"])

    return keyed.mapInArrow(run, keyed.withColumn("ball", F.lit(-1)).schema)


def _tasks(keyed: DataFrame, piece: int) -> DataFrame:
    """A row for each vector and task that it belongs to: (dim, t, key, task, role, rid, n, v, keys, ball).

    A key of up to `piece` vectors is one task. A crowded key is dealt to pieces: vectors of a ball that is itself crowded
    there are pieces of their own, which need not meet each other; all other pieces meet two by two.
    """
    key = ["dim", "t", "key"]
    told = keyed.select("rid", "dim", "ball", F.posexplode("keys").alias("t", "key"))
    counts = told.groupBy(*key, "ball").agg(F.count("*").alias("in_ball"))
    counts = counts.withColumn("in_key", F.sum("in_ball").over(Window.partitionBy(*key))).where(F.col("in_key") > piece)
    pool = F.when(F.col("in_ball") > piece, F.col("ball")).otherwise(-1)
    pools = counts.select(*key, "ball", pool.alias("pool"), "in_ball")
    sizes = pools.groupBy(*key, "pool").agg(F.ceil(F.sum("in_ball") / piece).cast("int").alias("pieces"))
    parts = sizes.select(*key, "pool", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("part"))
    left, right = parts.withColumnsRenamed({"pool": "pool_a", "part": "part_a"}), parts.withColumnsRenamed({"pool": "pool_b", "part": "part_b"})
    ordered = (F.col("pool_a") < F.col("pool_b")) | ((F.col("pool_a") == F.col("pool_b")) & (F.col("pool_a") == -1) & (F.col("part_a") <= F.col("part_b")))
    met = left.join(right, key).where(ordered).withColumn("task", F.xxhash64("pool_a", "part_a", "pool_b", "part_b"))
    roles = met.select(*key, "task", F.col("pool_a").alias("pool"), F.col("part_a").alias("part"), F.lit(0).alias("role"))
    second = met.where("pool_a <> pool_b or part_a <> part_b").select(*key, "task", F.col("pool_b").alias("pool"), F.col("part_b").alias("part"), F.lit(1).alias("role"))
    roles = roles.unionByName(second)
    crowded = pools.join(sizes, [*key, "pool"]).select(*key, "ball", "pool", "pieces")
    rows = keyed.select("*", F.posexplode("keys").alias("t", "key"))
    dealt = rows.join(crowded, [*key, "ball"], "left").withColumn("part", F.pmod(F.xxhash64("rid"), F.col("pieces")).cast("int"))
    columns = [*key, "task", "role", "rid", "n", "v", "keys", "ball"]
    alone = dealt.where("pool is null").withColumns({"task": F.lit(0).cast("long"), "role": F.lit(0)})
    return alone.select(columns).unionByName(dealt.where("pool is not null").join(roles, [*key, "pool", "part"]).select(columns))


def _met(threshold: float):
    """Of the vectors of a task: how many others each is linked to (copies counted), and the least of those it reaches."""

    def solve(key: tuple, table: pa.Table) -> pa.Table:
        t = key[1].as_py()
        role = table["role"].to_numpy()
        rid, n, ball = (table[c].to_numpy() for c in ("rid", "n", "ball"))
        x, keys = units(matrix(table["v"])), table["keys"].combine_chunks().flatten().to_numpy().reshape(len(rid), -1)[:, :t]
        a, b = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        b = b if len(b) else a
        links, low = np.zeros(len(rid), np.int64), rid.copy()
        near = np.empty((len(a), len(b)), bool)
        for at in range(0, len(a), 256):
            i = a[at : at + 256]
            found = (x[i] @ x[b].T >= threshold) & (i[:, None] != b) & ((ball[i][:, None] != ball[b]) | (ball[i][:, None] < 0))
            p, q = np.nonzero(found)
            for cut in range(0, len(p), 1 << 16):
                u, v = p[cut : cut + (1 << 16)], q[cut : cut + (1 << 16)]
                again = (keys[i[u]] == keys[b[v]]).any(axis=1)
                found[u[again], v[again]] = False
            near[at : at + 256] = found
        links[a] += near @ n[b]
        if a is not b:
            links[b] += near.T @ n[a]
        changed = near.any()
        while changed:
            before = low.copy()
            for at in range(0, len(a), 256):
                i, found = a[at : at + 256], near[at : at + 256]
                low[i] = np.minimum(low[i], np.where(found, low[b], rid.max()).min(axis=1, initial=rid.max()))
                low[b] = np.minimum(low[b], np.where(found, low[i][:, None], rid.max()).min(axis=0, initial=rid.max()))
            changed = (before != low).any()
        some = links > 0
        return pa.table({"rid": rid[some], "links": links[some], "low": low[some]})

    return solve


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.95,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    key_bits: int | None = None,
    piece_vectors: int = PIECE_VECTORS,
    sample: int = SAMPLE_VECTORS,
) -> DataFrame:
    """(id, n_links, component_id, kept): to how many other vectors a row is linked, and the least id that links reach.

    Two vectors of equal length are linked if their cosine, in double precision, reaches the threshold; every link that is
    counted has been verified or follows from the triangle inequality of angles. Pairs are found by the tables, so that a
    pair at the very threshold may be missed about once in a thousand times, and nearer ones far less often. Vectors that are
    null, empty, zero, or hold null or non-finite components are linked with nothing and stand for themselves. Equal
    vectors are linked. Rows that repeat an id are vectors of their own. A row without id takes part; it is not kept where
    another row of its component has an id, and its component_id is null where none has. Other columns are not read. An
    empty table gives no rows.

    Rotations are learnt from `sample` vectors; all vectors are indexed. key_bits: bits of a table's key, by default from
    the number of vectors. piece_vectors: vectors of one key that meet in one task.
    """
    half = acos(threshold) / 2 - 1e-7
    kind = "float" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "double"
    v = F.col(vector_col).cast(f"array<{kind}>")
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(inf))) & F.exists(v, lambda x: x != 0)
    with Scratch(vectors.sparkSession) as scratch:
        rows = vectors.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), F.when(fine, v).alias("v"))
        rows = scratch.stored(rows.withColumns({"h1": F.when(F.col("v").isNull(), F.col("rid")).otherwise(F.xxhash64("v")), "h2": F.when(F.col("v").isNull(), 0).otherwise(F.xxhash64(F.lit(1), "v"))}))
        firsts = scratch.stored(rows.groupBy("h1", "h2", F.col("v").isNull().alias("odd")).agg(F.min("rid").alias("rid"), F.count("*").alias("n"), F.min("id").alias("least")))
        single = rows.where("v is not null").select("rid", F.size("v").alias("dim"), "v").join(firsts.select("rid", "n"), "rid")
        single = scratch.stored(single)
        held = _fit(single, threshold, key_bits, sample)
        keyed = scratch.stored(_keyed(single, held, threshold))
        piece = max(2, min(piece_vectors, PIECE_NUMBERS // max([1, *held])))
        keyed = scratch.stored(_in_balls(keyed, _centres(keyed, piece, half), half))
        found = _tasks(keyed, piece).groupBy("dim", "t", "key", "task").applyInArrow(_met(threshold), "rid long, links long, low long")
        found = scratch.stored(found)
        balls = F.broadcast(keyed.where("ball >= 0").groupBy("ball").agg(F.sum("n").alias("all"), F.min("rid").alias("low")))
        inside = scratch.stored(keyed.where("ball >= 0").select("rid", "n", "ball").join(balls, "ball").select("rid", (F.col("all") - F.col("n")).alias("links"), "low"))
        told = found.unionByName(inside)
        links = told.groupBy("rid").agg(F.sum("links").alias("links"))
        reached = components(told.select(F.col("rid").alias("a"), F.col("low").alias("b"))).withColumnsRenamed({"node": "rid"})
        own = firsts.join(links, "rid", "left").join(reached, "rid", "left").withColumn("component", F.coalesce("component", "rid"))
        own = scratch.stored(own.select("h1", "h2", "odd", "n", "least", F.coalesce("links", F.lit(0)).alias("links"), "component"))
        least = own.groupBy("component").agg(F.min("least").alias("component_id"))
        classes = own.join(least, "component").select("h1", "h2", "odd", (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id")
        out = rows.select("id", "h1", "h2", F.col("v").isNull().alias("odd")).join(classes, ["h1", "h2", "odd"])
        kept = F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull())
        return shared(out.select("id", "n_links", "component_id", kept.alias("kept")))
