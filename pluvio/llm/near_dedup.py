"""Near-duplicate documents by DartMinHash signatures, banded joining and exact verification.

Every element of a weighted set owns a region of the (weight, rank) plane: below its weight, for all ranks. A shared
random process throws darts at those regions at a rate of one per unit of area; per signature coordinate the earliest
dart (of least rank) is kept. Two sets keep the same dart in a coordinate with a probability equal to their weighted
Jaccard similarity. Only darts below a rank that depends on the set's total weight are thrown, so that a signature costs
the set's size plus k log k darts, however many coordinates it has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._graph import Scratch, components, shared, side
from ._text import flat, lists, map_arrow, mix, shingles, slices, text_keys, words

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: 25 bands of 5 coordinates miss a pair of similarity 0.8 about once in 20,000 times.
BANDS, ROWS = 25, 5
#: Members of a representative up to which they are held against each other pair by pair.
FAMILY = 64


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((mix(x) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _darts(element: np.ndarray, weight: np.ndarray, limit: np.ndarray, source: np.ndarray):
    """(source, rank, dart) of all darts below the element's rank limit that hit its region, weights in dyadic layers."""
    found = []
    layer = 0
    while len(element):
        low, width = (0.0, 1.0) if layer == 0 else (2.0 ** (layer - 1), 2.0 ** (layer - 1))
        keep = weight > low
        element, weight, limit, source = element[keep], weight[keep], limit[keep], source[keep]
        e, w, top, s = element + np.uint64(layer * 0xC2B2AE3D27D4EB4F % 2**64), weight, limit, source
        rank, turn = np.zeros(len(e)), 0
        while len(e):
            state = mix(e + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 % 2**64))
            rank = rank - np.log(_uniform(state)) / width
            keep = rank <= top
            e, w, top, s, rank, state = e[keep], w[keep], top[keep], s[keep], rank[keep], state[keep]
            hit = slice(None) if layer == 0 and (w >= 1).all() else low + width * _uniform(state ^ np.uint64(0x5851F42D4C957F2D)) <= w
            found.append((s[hit], rank[hit], state[hit]))
            turn += 1
        layer += 1
    if not found:
        return np.empty(0, np.int64), np.empty(0), np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def dart_signatures(source: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, k: int) -> np.ndarray:
    """The k-coordinate signature of each of the n weighted sets given as (source, element, weight); 0 for an empty set."""
    out = np.zeros((n, k), np.uint64)
    total = np.bincount(source, weight, n)
    limit = np.divide(k * (np.log(k) + 3), total, out=np.zeros(n), where=total > 0)
    todo = total > 0
    while todo.any():
        part = todo[source]
        s, rank, dart = _darts(element[part], weight[part], limit[source[part]], source[part])
        order = np.argsort(-rank, kind="stable")
        s, dart = s[order], dart[order]
        column = (mix(dart ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(k)).astype(np.int64)
        out[todo] = 0
        out[s, column] = dart | np.uint64(1)
        todo &= (out == 0).any(axis=1)
        limit = limit * 2
    return out


def _weighted(row: np.ndarray, element: np.ndarray, weights: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if weights == "binary":
        return row, element, np.ones(len(row))
    order = np.lexsort((element, row))
    row, element = row[order], element[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (element[1:] != element[:-1])
    at = np.flatnonzero(new)
    return row[at], element[at], np.diff(np.append(at, len(row))).astype(float)


def sketches(docs: DataFrame, id_col: str, text_col: str, size: int, bands: int, rows: int, weights: str) -> DataFrame:
    """(id, k1, k2, bands): the hash of the text's words, and a hash for each band of its signature. Null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            w = words(*flat(batch.column(1)))
            k1, k2 = text_keys(w)
            n = batch.num_rows
            sign = dart_signatures(*_weighted(*shingles(w, size), weights), n, bands * rows).reshape(n, bands, rows)
            place = mix(np.arange(1, bands * rows + 1, dtype=np.uint64)).reshape(bands, rows) | np.uint64(1)
            band = mix((sign * place).sum(axis=2, dtype=np.uint64))
            none = w.counts == 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(k1.view(np.int64), mask=none), pa.array(k2.view(np.int64), mask=none), lists(band.view(np.int64).ravel(), np.full(n, bands), pa.int64())],
                ["id", "k1", "k2", "bands"],
            )

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t")), run, "id long, k1 long, k2 long, bands array<long>")


def shingle_sets(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(id, words): the distinct shingle hashes of each text, in ascending order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            w = words(*flat(batch.column(1)))
            row, element, _ = _weighted(*shingles(w, size), "count")
            yield pa.RecordBatch.from_arrays([batch.column(0), lists(element.view(np.int64), np.bincount(row, minlength=batch.num_rows), pa.int64())], ["id", "words"])

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t")), run, "id long, words array<long>")


def _enough(common: Column, sizes: Column, similarity: float) -> Column:
    """Whether two sets with so many elements in common, and so many in all, are similar enough."""
    return common >= similarity * (sizes - common) - 1e-9


def _common(left: str, right: str) -> Column:
    return F.size(F.array_intersect(f"{left}words", f"{right}words"))


def _small_links(members: DataFrame, star: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b): links between members (bucket, rep, id, group) of one bucket that are in different groups.

    Two sets share with each other what both, or neither, share with the representative: that bound is held against each
    pair first, and the sets only if it leaves a chance, all in the condition of a join that puts out links alone.
    """
    inside = members.join(star.select("rep", "id", "common", "n"), ["rep", "id"]).join(sets, "id")
    c, d, n, m = (F.col(x) for x in ("l_common", "r_common", "l_n", "r_n"))
    bound = _enough(F.least(c, d) + F.least(n - c, m - d), n + m, similarity)
    on = (F.col("l_bucket") == F.col("r_bucket")) & (F.col("l_group") != F.col("r_group")) & (F.col("l_id") < F.col("r_id"))
    pairs = side("l_", inside).join(side("r_", inside), on & bound & _enough(_common("l_", "r_"), n + m, similarity))
    return pairs.select(F.col("l_id").alias("a"), F.col("r_id").alias("b"))


def _hubs(members: DataFrame, turns: int = 2) -> DataFrame:
    """(hub, id, group): members (bucket, rep, size, id, group) by one reference for as many buckets as share members.

    A bucket takes over the largest representative among those of its members' buckets, so that a family has one or few.
    """
    now = members.select("bucket", "id", "group", F.struct("size", "rep").alias("top"))
    for _ in range(turns):
        # A member stands in as many buckets as there are bands at most.
        now = now.withColumn("top", F.max("top").over(Window.partitionBy("id")))
        now = now.drop("top").join(now.groupBy("bucket").agg(F.max("top").alias("top")), "bucket")
    return now.select(F.col("top.rep").alias("hub"), "id", "group").distinct()


def _family_links(members: DataFrame, sets: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """(a, b): links that connect the members (hub, id, group) of one large family in different groups, without its pairs.

    Each set is told by its difference from the hub's set, since two sets differ from each other as these differences do:
    J(S, T) >= s holds just if |S xor T| <= t (|S| + |T|) with t = (1 - s) / (1 + s). With x and y elements in the
    differences, they have (x + y - t (n + m)) / 2 elements or more in common, for x - t n >= -t r in any case and
    x - t n > t r for a set that is not linked with the hub of size r. Links with the hub are put out; of two other linked
    members one at least is not linked with it, so that each has a least overlap that depends on itself alone. Elements are
    put in order, rare ones first: two differences with that overlap meet in their prefixes. Pairs whose remaining
    elements cannot make up the overlap any more are left out, and the others are verified on the sets.
    """
    t = (1 - similarity) / (1 + similarity)
    apart = members.join(sets, "id").join(sets.select(F.col("id").alias("hub"), F.col("words").alias("hub_words")), "hub")
    other = F.concat(F.array_except("words", "hub_words"), F.array_except("hub_words", "words"))
    told = apart.select("hub", "id", "group", F.size("words").alias("n"), F.size("hub_words").alias("m"), other.alias("other")).withColumn("x", F.size("other"))
    told = scratch.stored(told.withColumn("linked", _enough((F.col("n") + F.col("m") - F.col("x")) / 2, F.col("n") + F.col("m"), similarity)))
    short = (F.col("x") - t * F.col("n") + F.when(F.col("linked"), t).otherwise(-t) * F.col("m")) / 2
    prefixed = told.withColumn("prefix", F.col("x") - F.greatest(F.ceil(short - 1e-6), F.lit(1)) + 1).where("prefix > 0")
    elements = prefixed.select("hub", "id", "group", "linked", "n", "x", "prefix", F.explode("other").alias("element"))
    often = elements.groupBy("hub", "element").agg(F.count("*").alias("times"))
    place = F.row_number().over(Window.partitionBy("hub", "id").orderBy("times", "element"))
    first = elements.join(often, ["hub", "element"]).withColumn("place", place).where("place <= prefix and times > 1").drop("prefix", "times")
    first = scratch.stored(first)
    need = (F.col("l_x") + F.col("r_x") - t * (F.col("l_n") + F.col("r_n"))) / 2 - 1e-6
    left = 1 + F.least(F.col("l_x") - F.col("l_place"), F.col("r_x") - F.col("r_place"))
    on = (F.col("l_hub") == F.col("r_hub")) & (F.col("l_element") == F.col("r_element")) & (F.col("l_id") < F.col("r_id"))
    on &= (F.col("l_group") != F.col("r_group")) & ~(F.col("l_linked") & F.col("r_linked")) & (left >= need)
    met = side("l_", first).join(side("r_", first), on).select("l_id", "r_id").distinct()
    held = met.join(side("l_", sets), "l_id").join(side("r_", sets), "r_id")
    held = held.where(_enough(_common("l_", "r_"), F.size("l_words") + F.size("r_words"), similarity))
    hub = told.where("linked and id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b"))
    return hub.unionByName(held.select(F.col("l_id").alias("a"), F.col("r_id").alias("b")))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE_WORDS,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    weights: str = "binary",
    family: int = FAMILY,
) -> DataFrame:
    """(id, copy_of, class_id) of every row: the least id with the same words, and the least id of its class.

    Two texts are linked if the Jaccard similarity of their sets of `size`-word shingles is at least `similarity`; classes
    are the connected components of the links. weights: "binary" signs sets, "count" signs each shingle with its number of
    occurrences, for corpora in which repetition matters; links are verified on the sets either way.

    Copies meet once, by the hash of their words, before anything is joined, so that a group of copies of any size costs
    one row. The members of a bucket are first held against its representative, one row each. Members that are still in
    different components are then held against each other: pair by pair in small buckets, by prefixes of what sets them
    apart from the representative where it has more than `family` members; both ways find every link.

    A null or empty text, or one without words, is a class of its own. Rows with one id are one document, and a null id is
    null in all columns. A text of fewer than `size` words is one shingle. Texts of any length are read whole; an empty
    table gives no rows. Other columns are not read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    with Scratch(docs.sparkSession) as scratch:
        sketch = scratch.stored(sketches(docs, "id", "text", size, bands, rows, weights))
        first = scratch.stored(sketch.where("k1 is not null and id is not null").groupBy("k1", "k2").agg(F.min("id").alias("copy_of")))
        banded = (
            sketch.join(first.select(F.col("copy_of").alias("id"), "k1", "k2"), ["id", "k1", "k2"], "left_semi")
            .dropDuplicates(["id"])
            .select("id", F.posexplode("bands").alias("band", "value"))
            .select("id", F.xxhash64("band", "value").alias("bucket"))
        )
        full = banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
        crowded = scratch.stored(banded.join(full, "bucket"))
        # The member that stands in the largest buckets is the most like the others: it represents its buckets.
        weighed = crowded.withColumn("weight", F.sum("n").over(Window.partitionBy("id")))
        heads = weighed.groupBy("bucket").agg(F.min_by("id", F.struct(-F.col("weight"), "id")).alias("rep"))
        members = scratch.stored(crowded.drop("n").join(heads, "bucket").where("id <> rep"))
        wanted = members.select("id").unionByName(members.select(F.col("rep").alias("id"))).distinct()
        sets = scratch.stored(shingle_sets(docs.join(wanted, "id", "left_semi"), "id", "text", size).dropDuplicates(["id"]))
        pairs = members.select("rep", "id").distinct().join(sets, "id").join(sets.select(F.col("id").alias("rep"), F.col("words").alias("rep_words")), "rep")
        told = pairs.select("rep", "id", F.size(F.array_intersect("words", "rep_words")).alias("common"), F.size("words").alias("n"), F.size("rep_words").alias("n_rep"))
        star = scratch.stored(told.withColumn("linked", _enough(F.col("common"), F.col("n") + F.col("n_rep"), similarity)))
        links = star.where("linked").select(F.col("rep").alias("a"), F.col("id").alias("b"))
        of = components(links)
        placed = members.join(of.withColumnsRenamed({"node": "id", "component": "group"}), "id", "left").join(of.withColumnsRenamed({"node": "rep", "component": "rep_group"}), "rep", "left")
        placed = placed.withColumns({"group": F.coalesce("group", "id"), "rep_group": F.coalesce("rep_group", "rep")})
        apart = placed.where("group <> rep_group").groupBy("bucket").agg(F.count("*").alias("apart"))
        inside = scratch.stored(placed.drop("rep_group").join(apart, "bucket"))
        families = inside.select("rep", "id").distinct().groupBy("rep").agg(F.count("*").alias("size")).where(F.col("size") > family)
        small = _small_links(inside.join(families, "rep", "left_anti").drop("apart"), star, sets, similarity)
        large = inside.join(families, "rep")
        found = links.unionByName(small)
        if not large.isEmpty():
            found = found.unionByName(_family_links(scratch.stored(_hubs(large)), sets, similarity, scratch))
        classes = components(scratch.stored(found)).select(F.col("node").alias("copy_of"), F.col("component").alias("class_id"))
        copies = shared(sketch.select("id", "k1", "k2").join(first, ["k1", "k2"], "left").select("id", F.coalesce("copy_of", "id").alias("copy_of")))
    return copies.join(classes, "copy_of", "left").select("id", "copy_of", F.coalesce("class_id", "copy_of").alias("class_id"))
