"""Repeated and nearly repeated lines, by a segment-partition edit join in DataFrame functions only.

Distinct lines meet once, by their text. Each is cut into one segment more than the edits allowed, of lengths fixed by
the line's length, so that two lines within that distance share a segment whole (pigeonhole). Segments are indexed by
(length, segment number, content); a line probes, for its own length and the shorter ones in reach, only the substrings
that a minimal sequence of edits can have moved there. Pairs that meet are verified with a banded bit-parallel edit
distance over bigint columns, and the first line of each group of connected lines stays.

Lines of one template share a segment without being near one another. A large bucket is therefore cut anew: its lines get
new segments, each with a like share of the places in which they differ, and meet again only where one of these is whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._graph import Scratch, components, shared, side

#: Edits (insertions, deletions, substitutions of characters) up to which two lines are copies.
MAX_EDITS = 2
#: Shorter lines, without the white space around them, are left alone, unless exact_chars takes them in.
MIN_CHARS = 20
#: Lines of this length on can be joined by their distance.
LEAST_CHARS = 3 * (MAX_EDITS + 1)
#: Letters whose counts are compared before the distance: an edit changes them by 2 in all at most.
COUNTED = "etaonirshdu0123456789"
#: Members of a bucket up to which they are held against each other pair by pair; larger buckets are cut anew.
CROWD = 256
#: Bits of the bitmap that tells most lines that no other is near from the rest: 8 MB at most, however many lines there are.
MARKS = 1 << 26
#: Bits of a line number in a position.
_LINE_BITS = 32


def probes(edits: int) -> list[tuple[int, int, int]]:
    """(length difference, segment from 0, shift) of the substrings that a line has to look up, from the multi-match rule."""
    out = []
    for delta in range(edits + 1):
        for i in range(edits + 1):
            low, high = max(-i, delta - (edits - i)), min(i, delta + (edits - i))
            out += [(delta, i, shift) for shift in range(low, high + 1)]
    return out


def looked_up(lines: DataFrame, edits: int) -> tuple[DataFrame, list[str], list[str]]:
    """lines (id, chars, ...) with a column for each hash to look up, the names of all of them, and of a line's own segments.

    The last segments take what the division of a line's length leaves over. The columns come in short steps, since one
    long expression would make a method that the JVM does not compile; the line is cut at four bytes a character, so that
    a cut costs the same wherever it is.
    """
    n = edits + 1
    out = lines.select("id", F.length("line").alias("chars"), F.encode("line", "UTF-32").alias("wide"))
    out = out.withColumns({f"n{d}": F.col("chars") - d for d in range(n)})
    rest = {f"r{d}": F.col(f"n{d}") % n for d in range(n)}
    out = out.withColumns({**rest, **{f"q{d}": F.call_function("div", F.col(f"n{d}"), F.lit(n)).cast("int") for d in range(n)}})
    cuts = {}
    for d in range(n):
        for i in range(n):
            cuts[f"s{d}_{i}"] = (F.col(f"q{d}") * i + F.greatest(F.col(f"r{d}") - (n - i), F.lit(0))) * 4 + 1
            cuts[f"z{d}_{i}"] = (F.col(f"q{d}") + F.when(F.col(f"r{d}") >= n - i, 1).otherwise(0)) * 4
    out = out.withColumns(cuts)
    places = probes(edits)
    hashed = [F.xxhash64(f"n{d}", F.lit(i), F.substring(F.col("wide"), F.col(f"s{d}_{i}") + 4 * shift, F.col(f"z{d}_{i}"))).alias(f"b{k}") for k, (d, i, shift) in enumerate(places)]
    return out.select("id", "chars", *hashed), [f"b{k}" for k in range(len(places))], [f"b{k}" for k, (d, _, shift) in enumerate(places) if d == 0 and shift == 0]


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bounded_distance(a: Column, b: Column, edits: int) -> Column:
    """The edit distance of two arrays if it is at most `edits`; some larger number otherwise.

    Both must have `edits` elements or more. What they begin and end with in common is left out, but for `edits` elements.
    """
    same = lambda x, y: F.zip_with(x, y, lambda p, q: p.eqNullSafe(q))
    run = lambda x, y: F.coalesce(F.nullif(F.array_position(same(x, y), False), F.lit(0).cast("long")) - 1, F.least(F.size(x), F.size(y)).cast("long")).cast("int")

    def trimmed(head: Column, tail: Column) -> Column:
        start, end = F.greatest(head - edits, F.lit(0)), F.greatest(F.least(tail, F.least(F.size(a), F.size(b)) - head) - edits, F.lit(0))
        cut = lambda x: F.slice(x, start + 1, F.size(x) - start - end)
        return _let(F.struct(cut(a).alias("a"), cut(b).alias("b")), lambda p: _banded(p["a"], p["b"], edits))

    return _let(run(a, b), lambda head: _let(run(F.reverse(a), F.reverse(b)), lambda tail: trimmed(head, tail)))


def _banded(a: Column, b: Column, edits: int) -> Column:
    """A band of 2 * edits + 1 diagonals of the distance matrix, bit-parallel: the vertical differences of one column are
    held in the bits of two bigints, and each element of b moves the band by one row and column."""
    n, m = F.size(a), F.size(b)
    top, mask = 2 * edits, (1 << (2 * edits + 1)) - 1
    bit = lambda x, k: F.call_function("shiftright", x, k).bitwiseAND(F.lit(1))

    def matches(j: Column) -> Column:
        """Bits of the rows j - edits .. j + edits whose element is b's j-th."""
        bits = lambda c: [F.when(F.get(a, j - edits + k - 1) == c, F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")) for k in range(2 * edits + 1)]
        return _let(F.get(b, j - 1), lambda c: sum(bits(c)[1:], bits(c)[0]))

    def step(s: Column, j: Column) -> Column:
        vp, vn, d = s["vp"], s["vn"], s["d"]

        def with_matches(pm: Column) -> Column:
            return _let((((pm.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(pm).bitwiseOR(vn)).bitwiseAND(F.lit(mask)), with_diagonal)

        def with_diagonal(d0: Column) -> Column:
            hp = vn.bitwiseOR(F.bitwise_not(d0.bitwiseOR(vp))).bitwiseAND(F.lit(mask))
            hn = d0.bitwiseAND(vp)
            down = F.call_function("shiftright", d0, F.lit(1))
            last = (n - j + edits).cast("int")
            return F.struct(
                hn.bitwiseOR(F.bitwise_not(down.bitwiseOR(hp))).bitwiseAND(F.lit(mask)).alias("vp"),
                down.bitwiseAND(hp).alias("vn"),
                (d + F.when(j <= n - edits, 1 - bit(d0, F.lit(top))).otherwise(bit(hp, last) - bit(hn, last))).cast("long").alias("d"),
            )

        return F.when(d > 2 * edits + m - n, s).otherwise(_let(matches(j), with_matches))

    start = F.struct(F.lit(mask & ~((1 << edits) - 1)).cast("long").alias("vp"), F.lit(0).cast("long").alias("vn"), F.lit(edits).cast("long").alias("d"))
    return F.aggregate(F.sequence(F.lit(1), m), start, step)["d"]


def _lines(docs: DataFrame) -> DataFrame:
    """(id, n, line) of all lines of docs (id, text), without the spaces around them; n from 0."""
    return docs.select("id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("n", "line")).withColumn("line", F.trim("line"))


def _position() -> Column:
    return F.col("id").cast("decimal(20,0)") * F.lit(1 << _LINE_BITS).cast("decimal(10,0)") + F.col("n").cast("decimal(10,0)")


#: What stands for a line when its occurrences are looked up: 128 bits of hashes, and its length.
_NAMES = ("_k1", "_k2", "_k3")


def _key() -> dict[str, Column]:
    return dict(zip(_NAMES, (F.xxhash64("line"), F.xxhash64(F.lit(1), "line"), F.length("line")), strict=True))


def _least(min_chars: int, exact_chars: int | None) -> int:
    """Characters of the shortest line that takes part; an empty line never does."""
    return min_chars if exact_chars is None else max(1, min(min_chars, exact_chars))


def _alike(left: str, right: str, edits: int) -> Column:
    """What two lines within `edits` of each other must have in common: nearly their lengths, and their characters' counts."""
    apart = [F.abs(F.col(f"{left}n_{c}") - F.col(f"{right}n_{c}")) for c in COUNTED]
    return (F.abs(F.col(f"{left}chars") - F.col(f"{right}chars")) <= edits) & (sum(apart[1:], apart[0]) <= 2 * edits)


def _linked(left: str, right: str, edits: int) -> Column:
    return _alike(left, right, edits) & (bounded_distance(F.col(f"{left}letters"), F.col(f"{right}letters"), edits) <= edits)


def _marked(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """The lines (id, ...) whose mark is that of a wanted id: all wanted ones and, where there are very many of these, some
    others. Only a bitmap of the marks goes to every task, so that the other lines' texts stay where they are."""
    mark = F.pmod(F.xxhash64("id"), F.lit(MARKS))
    page, bit = F.bitmap_bucket_number(mark).alias("_page"), F.bitmap_bit_position(mark)
    bits = wanted.groupBy(page).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.call_function("div", bit, F.lit(8)) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    held = F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    return lines.withColumn("_page", page).join(F.broadcast(bits), "_page").where(held).select(*lines.columns)


def _pair_links(members: DataFrame, evidence: DataFrame, edits: int) -> DataFrame:
    """(a, b): links between members (bucket, n, id, probe, group) of one bucket in different groups, one of which at least
    is there by a segment of its own. Pairs are judged in the condition of the join, which puts out links alone."""
    inside = members.join(evidence, "id")
    on = (F.col("l_bucket") == F.col("r_bucket")) & (F.col("l_n") == F.col("r_n")) & (F.col("l_group") != F.col("r_group")) & ~F.col("l_probe")
    on &= (F.col("r_probe") & (F.col("l_id") != F.col("r_id"))) | (F.col("l_id") < F.col("r_id"))
    found = side("l_", inside).join(side("r_", inside), on & _linked("l_", "r_", edits))
    return found.select(F.col("l_id").alias("a"), F.col("r_id").alias("b"))


def _cuts(star: DataFrame, edits: int) -> DataFrame:
    """(bucket, n, starts) where the bucket's own lines, all of length n, are cut into edits + 1 segments.

    Each segment has about the same share of the differences between the lines and their representative, and a place with
    differences; a bucket with fewer such places than segments has no row.
    """
    places = star.where("not probe").select("bucket", "n", F.explode("differs").alias("place")).groupBy("bucket", "n", "place").agg(F.count("*").alias("c"))
    upto = Window.partitionBy("bucket", "n").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("bucket", "n")
    placed = places.withColumns({"upto": F.sum("c").over(upto), "row": F.count("*").over(upto), "total": F.sum("c").over(whole)})
    ends = [F.min(F.when(F.col("upto") * (edits + 1) >= F.col("total") * i, F.col("row"))).alias(f"e{i}") for i in range(1, edits + 1)]
    found = placed.groupBy("bucket", "n").agg(*ends, F.count("*").alias("m"), F.array_sort(F.collect_list("place")).alias("places")).where(F.col("m") > edits)
    for i in range(1, edits + 1):
        least = F.lit(1) if i == 1 else F.col(f"e{i - 1}") + 1
        found = found.withColumn(f"e{i}", F.greatest(least, F.least(F.col(f"e{i}"), F.col("m") - edits - 1 + i)))
    starts = [F.lit(0)] + [F.element_at("places", (F.col(f"e{i}") + 1).cast("int")) for i in range(1, edits + 1)]
    return found.select("bucket", "n", F.array(*starts).alias("starts"))


def _cut_anew(entries: DataFrame, cuts: DataFrame, evidence: DataFrame, edits: int) -> DataFrame:
    """The entries (bucket, n, id, probe, group) by the new segments of their buckets."""
    both = entries.join(cuts, ["bucket", "n"]).join(evidence.select("id", "chars", "letters"), "id")
    keys = []
    for d, i, shift in probes(edits):
        start = F.get("starts", F.lit(i))
        end = F.get("starts", F.lit(i + 1)) if i < edits else F.col("n")
        key = F.xxhash64("bucket", "n", F.lit(i), F.slice("letters", start + (shift + 1), end - start))
        entry = F.struct(key.alias("bucket"), (F.col("probe") | F.lit(bool(d or shift))).alias("probe"))
        keys.append(F.when((F.col("chars") - F.col("n") == d) & (start + shift >= 0), entry))
    return both.select("n", "id", "group", F.explode(F.array(*keys)).alias("e")).where("e is not null").select(F.col("e.bucket").alias("bucket"), "n", "id", F.col("e.probe").alias("probe"), "group")


def _crowd_links(entries: DataFrame, evidence: DataFrame, edits: int, crowd: int, scratch: Scratch) -> DataFrame:
    """(a, b): links that connect what is near in buckets too large for pairs. entries: bucket, n, id, probe, group.

    Every turn holds the members of a bucket against its representative, which settles buckets that are all linked with
    it, and cuts the others anew. The lines of a new bucket agree in all places of one more segment, so that they differ in
    fewer places every turn, down to fewer than there are segments: such lines are near their representative, and what is
    left in their bucket is compared pair by pair.
    """
    links = None
    while True:
        heads = entries.where("not probe").groupBy("bucket", "n").agg(F.min("id").alias("rep"))
        held = entries.join(heads, ["bucket", "n"]).join(side("r_", evidence), F.col("id") == F.col("r_id")).join(side("l_", evidence), F.col("rep") == F.col("l_id"))
        differs = F.filter(F.sequence(F.lit(0), F.col("n") - 1), lambda k: ~F.get("r_letters", k).eqNullSafe(F.get("l_letters", k)))
        told = held.select("bucket", "n", "rep", "id", "probe", "group", ((F.col("id") == F.col("rep")) | _linked("l_", "r_", edits)).alias("linked"), F.when(~F.col("probe") & (F.col("id") != F.col("rep")), differs).alias("differs"))
        star = scratch.stored(told)
        found = star.where("linked and id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
        links = found if links is None else links.unionByName(found)
        unsettled = star.groupBy("bucket", "n").agg(F.min("linked").alias("all"), F.min("group").alias("least"), F.max("group").alias("most")).where("not all and least <> most")
        left = scratch.stored(star.drop("rep", "linked").join(unsettled.select("bucket", "n"), ["bucket", "n"]))
        if left.isEmpty():
            return links
        cuts = scratch.stored(_cuts(left, edits))
        rest = left.drop("differs").join(cuts, ["bucket", "n"], "left_anti")
        again = scratch.stored(_cut_anew(left.drop("differs"), cuts, evidence, edits))
        sizes = again.groupBy("bucket", "n").agg(F.count("*").alias("size"), F.min("probe").alias("alone")).where("size > 1 and not alone")
        sized = scratch.stored(again.join(sizes.drop("alone"), ["bucket", "n"]))
        pairs = sized.where(F.col("size") <= crowd).drop("size").unionByName(rest)
        links = links.unionByName(scratch.stored(_pair_links(pairs, evidence, edits)))
        entries = sized.where(F.col("size") > crowd).drop("size")
        if entries.isEmpty():
            return links


def _classes(docs: DataFrame, edits: int, min_chars: int, exact_chars: int | None, crowd: int, scratch: Scratch, named: dict[str, Column]) -> DataFrame:
    """line_classes() of docs (id, text), with the columns `named` of a line for the line, reading tables of `scratch`."""
    lines = _lines(docs.where("id is not null")).where(F.length("line") >= _least(min_chars, exact_chars))
    distinct = lines.groupBy("line").agg(F.min(_position()).alias("first"), F.count("*").alias("times"))
    # The numbers are unique, and fixed as the table is written.
    distinct = scratch.stored(distinct.withColumn("id", F.monotonically_increasing_id()))
    hashed, all_, own = looked_up(distinct.where(F.length("line") >= min_chars).select("id", "line"), edits)
    heads = hashed.select("id", F.explode(F.array(*own)).alias("bucket")).groupBy("bucket").agg(F.min("id").alias("rep"))
    order = [*own, *[c for c in all_ if c not in own]]
    shorter = F.array(*[F.lit(probes(edits)[all_.index(c)][0]) for c in order])
    probed = hashed.select("id", "chars", F.posexplode(F.array(*[F.col(c) for c in order])).alias("place", "bucket"))
    probed = probed.select("id", "bucket", (F.col("place") >= len(own)).alias("probe"), (F.col("chars") - F.get(shorter, F.col("place"))).alias("n"))
    members = scratch.stored(probed.join(heads.hint("shuffle_hash"), "bucket").where("id <> rep"))
    wanted = members.select("id").unionByName(members.select(F.col("rep").alias("id"))).distinct()
    length = F.length("line")
    counts = [(length - F.length(F.replace("line", F.lit(c), F.lit("")))).alias(f"n_{c}") for c in COUNTED]
    # Not a semi join: Spark would do that first, below the bitmap's join.
    near = _marked(distinct.select("id", "line"), wanted).join(wanted, "id")
    evidence = scratch.stored(near.select("id", length.alias("chars"), F.transform(F.split("line", ""), F.ascii).alias("letters"), *counts))
    pairs = members.select("rep", "id").distinct().join(side("r_", evidence), F.col("id") == F.col("r_id")).join(side("l_", evidence), F.col("rep") == F.col("l_id"))
    links = scratch.stored(pairs.where(_linked("l_", "r_", edits)).select(F.col("rep").alias("a"), F.col("id").alias("b")))
    of = components(links)
    placed = members.join(of.withColumnsRenamed({"node": "id", "component": "group"}), "id", "left").join(of.withColumnsRenamed({"node": "rep", "component": "rep_group"}), "rep", "left")
    placed = placed.withColumns({"group": F.coalesce("group", "id"), "rep_group": F.coalesce("rep_group", "rep")})
    apart = placed.where("group <> rep_group").select("bucket").distinct()
    inside = placed.join(apart, "bucket", "left_semi")
    crowded = inside.groupBy("bucket").agg(F.count("*").alias("size"))
    inside = scratch.stored(inside.join(crowded, "bucket"))
    found = links.unionByName(_pair_links(inside.where(F.col("size") <= crowd).select("bucket", "n", "id", "probe", "group"), evidence, edits))
    large = inside.where(F.col("size") > crowd)
    if not large.isEmpty():
        reps = large.groupBy("bucket", "n", "rep").agg(F.first("rep_group").alias("group")).select("bucket", "n", F.col("rep").alias("id"), F.lit(False).alias("probe"), "group")
        entries = large.select("bucket", "n", "id", "probe", "group").unionByName(reps)
        found = found.unionByName(_crowd_links(entries, evidence, edits, crowd, scratch))
    groups = components(scratch.stored(found)).withColumnRenamed("node", "id")
    joined = scratch.stored(groups.join(distinct.select("id", "first"), "id"))
    first = joined.groupBy("component").agg(F.min("first").alias("class_first"))
    placed = joined.join(first, "component").select("id", "class_first")
    # What is wanted of the lines is taken before the join, so that their keys travel, not their texts.
    brief = distinct.select("id", "first", "times", *[v.alias(k) for k, v in named.items()])
    return brief.join(placed, "id", "left").select(*named, "first", "times", F.coalesce("class_first", "first").alias("class_first"))


def _checked(docs: DataFrame, id_col: str, text_col: str, edits: int, min_chars: int) -> DataFrame:
    if min_chars < 3 * (edits + 1):
        raise ValueError("min_chars must be three times edits + 1 or more")
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))


def line_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = MAX_EDITS, min_chars: int = MIN_CHARS, exact_chars: int | None = None, crowd: int = CROWD) -> DataFrame:
    """(line, first, times, class_first) of every distinct line of `min_chars` characters or more, and, if exact_chars is
    given, of the shorter ones of `exact_chars` or more, which are connected to no other line.

    first: position of its first occurrence; times: its occurrences; class_first: position of the first occurrence of any
    line connected to it by lines within `edits` of one another. A position is the document's id * 2**32 + line number, a
    decimal. Lines of null ids are left out. Buckets of more than `crowd` members are cut anew, which finds the same links.
    """
    with Scratch(docs.sparkSession) as scratch:
        classes = _classes(_checked(docs, id_col, text_col, edits, min_chars), edits, min_chars, exact_chars, crowd, scratch, {"line": F.col("line")})
        return shared(classes)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = MAX_EDITS, min_chars: int = MIN_CHARS, exact_chars: int | None = None, crowd: int = CROWD) -> DataFrame:
    """All columns and rows of `docs`, with n_lines, dropped (line numbers from 0, ascending), and kept_text, the text that
    is left. Columns of `docs` that have one of these three names give way to them.

    Of each group of connected lines the first occurrence stays, by id, then line number; every other occurrence in any
    document is dropped. Lines of fewer than `min_chars` characters stay; if exact_chars is given, those of that length on
    go like the others where they repeat an earlier line exactly. All lines of rows with a null id stay. kept_text joins the
    lines that stay by line feeds; it is the text itself, null included, where nothing is dropped. Rows that repeat an id
    hold one document: what is dropped in one is dropped in all of them. A text of any length and number of lines is
    treated alike; an empty table gives no rows.
    """
    plain = _checked(docs, id_col, text_col, edits, min_chars)
    with Scratch(docs.sparkSession) as scratch:
        groups = _classes(plain, edits, min_chars, exact_chars, crowd, scratch, _key())
        repeated = shared(groups.where("times > 1 or first <> class_first").select(*_NAMES, "class_first"))
    lines = _lines(plain.where("id is not null")).where(F.length("line") >= _least(min_chars, exact_chars))
    found = lines.select(_position().alias("_position"), F.col("id").alias("_id"), "n", *[v.alias(k) for k, v in _key().items()])
    found = found.join(repeated, list(_NAMES)).where("_position <> class_first")
    dropped = found.groupBy("_id").agg(F.array_sort(F.collect_set("n")).alias("_dropped"))
    added = ("n_lines", "dropped", "kept_text")
    kept = [c for c in docs.columns if c.lower() not in added]
    held = docs.select(*[F.col(c).alias(f"_own_{i}") for i, c in enumerate(kept)], F.col(id_col).cast("long").alias("_doc"), F.col(text_col).cast("string").alias("_text"))
    joined = held.join(dropped, F.col("_doc") == F.col("_id"), "left")
    pieces = F.split(F.coalesce("_text", F.lit("")), "\n")
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size(pieces) - 1), "_dropped"), lambda i: F.get("_pieces", i))
    joined = joined.withColumn("_pieces", pieces)
    return joined.select(
        *[F.col(f"_own_{i}").alias(c) for i, c in enumerate(kept)],
        F.size("_pieces").cast("long").alias("n_lines"),
        F.coalesce("_dropped", F.array().cast("array<int>")).alias("dropped"),
        F.when(F.col("_dropped").isNotNull(), F.array_join(left, "\n")).otherwise(F.col("_text")).alias("kept_text"),
    )
