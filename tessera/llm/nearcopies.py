"""Near copies: SimHash near-dedup whose links are verified, with an exact way for what fingerprints miss.

Two texts are near copies if their sets of 5-word shingles have a Jaccard similarity of 0.8 at least.
First comes SimHash with pigeonring filtering (:mod:`tessera.llm.simhash`) on fingerprints of the
5-word shingles: texts whose fingerprints link are compared on their whole sets, and those similar
enough are joined. Most pairs of that similarity differ in more bits than any searchable distance
(2 to 11 and more), so a prefix filter finds the rest exactly. Of two sets so similar each has one
of its first ``n - ceil(0.8 n) + 1`` elements, in any one order of all shingles, in common with the
other's. The order here is by hash, with shingles that a sample of the texts repeats behind, most
frequent last: the order only decides how many candidates there are, never which pairs are found.
For the first shingle two sets share, their sizes and its places bound the overlap. Candidates are
pruned by parity bitmaps (two sets differ in as many elements at least as their bitmaps in bits) and
then verified on whole sets.

Only components are asked for, so a shingle's list is not expanded at once: a round compares each of
its sets with its ``PIVOTS`` most central ones, those that have the fewest rarer shingles before the
common one (edits of a text are rare shingles), and the last round compares the pairs that no component
joins yet. A long list is cut into blocks there, and each pair of blocks is a group of its own.

Cases: null and empty texts have no shingles and are one node; a text under five words is one
shingle; equal sets are one node, so copies are never expanded; repeated rows and ties are one node;
a null key is ignored when the smallest is sought; an empty table gives an empty result; columns
beyond key and text are not read, whatever their names. A very long text is a few arrays of its length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.arrow import map_slices, texts
from tessera.llm.simhash import components, few, majority, signed, spread
from tessera.llm.simhash import links as fingerprint_links
from tessera.session import attach, forget, store

SHINGLE = 5
#: Similarity 4/5: sets of a and b elements share (a + b) * 4 / 9 at least.
UP, DOWN = 4, 5
#: Bits of a parity bitmap.
BITS = 512
#: One text in so many is looked at for frequent shingles, and the most that are kept.
SAMPLE, FREQUENT = 16, 200_000
#: Sets of a shingle's list that all its sets are compared with first.
PIVOTS = 8
#: Sets of a block of a shingle's list; a pair of blocks is compared in one group.
BLOCK = 512
#: Rows that may be broadcast: eight bytes each.
SMALL = 1 << 21

_BASE = 0x9E3779B97F4A7C15


def shingles(text: str) -> np.ndarray:
    """Hashes of all runs of five words (as SimHash cuts words), repeats included."""
    words = text.encode("utf-8").lower().split()
    each = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
    size = min(SHINGLE, len(each))
    if not size:
        return each
    out = np.full(len(each) - size + 1, size, np.uint64)
    for k in range(size):
        out = out * np.uint64(_BASE) + each[k : k + len(out)]
        out = (out ^ out >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ out >> np.uint64(32)


def node(grams: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(grams.tobytes()) - (1 << 63)


def prefix(grams: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first shingles in the common order, of which similar sets share one."""
    n = len(grams)
    behind = np.zeros(n, np.int64)
    if len(frequent) and n:
        at = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
        behind = np.where(frequent[at] == grams, rank[at], 0)
    return grams[np.argsort(behind, kind="stable")][: n + UP * n // -DOWN + 1] if n else grams


def bitmap(grams: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles at each of ``BITS`` places, as signed words."""
    odd = np.bincount((grams % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(rows: DataFrame) -> DataFrame:
    """(node, grams) of texts."""

    def run(part: pa.RecordBatch) -> dict:
        each = [np.unique(shingles(x)) for x in texts(part.column(0))]
        return {"node": [node(g) for g in each], "grams": [g.view(np.int64) for g in each]}

    return map_slices(rows.select("text"), run, "node long, grams array<long>", size=1 << 20)


def _frequent(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that a sample repeats, sorted, and their ranks from 1 for the rarest."""
    some = _sets(rows.where(F.pmod("h", F.lit(SAMPLE)) == 0)).dropDuplicates(["node"])
    counts = some.select(F.explode("grams").alias("g")).groupBy("g").agg(F.count("*").alias("m")).where("m > 1")
    most = counts.orderBy(F.col("m").desc(), "g").limit(FREQUENT).collect()
    found = np.array([r.g for r in reversed(most)], np.int64).view(np.uint64)
    order = np.argsort(found)
    return found[order], order + 1


def _sketches(rows: DataFrame) -> DataFrame:
    """(k, h, node, fp, n, bits, prefix) of every row."""
    frequent, rank = _frequent(rows)
    kind = rows.schema["k"].dataType.simpleString()

    def run(part: pa.RecordBatch) -> dict:
        every = [shingles(x) for x in texts(part.column(2))]
        each = [np.unique(g) for g in every]
        return {
            "k": part.column(0),
            "h": part.column(1),
            "node": [node(g) for g in each],
            "fp": [signed(majority(g)) for g in every],
            "n": [len(g) for g in each],
            "bits": [bitmap(g) for g in each],
            "prefix": [prefix(g, frequent, rank).view(np.int64) for g in each],
        }

    return map_slices(rows.select("k", "h", "text"), run, f"k {kind}, h long, node long, fp long, n int, bits array<long>, prefix array<long>", size=1 << 20)


def _possible(a: Column, b: Column) -> Column:
    """Sizes and places (node, n, pos) that leave room for enough overlap behind a first common shingle."""
    room = F.least(a["n"] - a["pos"], b["n"] - b["pos"])
    return room * (UP + DOWN) >= (a["n"] + b["n"]) * UP


def _verified(pairs: DataFrame, nodes: DataFrame, rows: DataFrame) -> DataFrame | None:
    """The pairs (u, v) that are similar; sets are taken from the texts anew, for these nodes only."""
    a, b = (nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"b{x}")) for x in "uv")
    bits = F.aggregate(F.zip_with("bu", "bv", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    left = store(pairs.join(a, "u").join(b, "v").where(bits * (UP + DOWN) <= (F.col("nu") + F.col("nv")) * (DOWN - UP)).select("u", "v", "nu", "nv"), "pairs")
    ends = left.select(F.col("u").alias("node")).union(left.select("v")).distinct()
    hashes = store(nodes.join(ends, "node", "left_semi").select("h").coalesce(few(pairs.sparkSession)), "hashes")
    n = hashes.count()
    if not n:
        return None
    # a bounded number of hashes goes to the texts; beyond it the texts go to their hashes
    sets = store(_sets(rows.join(F.broadcast(hashes) if n <= SMALL else hashes, "h", "left_semi")).dropDuplicates(["node"]), "sets")
    gu, gv = (sets.select(F.col("node").alias(x), F.col("grams").alias(f"g{x}")) for x in "uv")
    shared = F.size(F.array_intersect("gu", "gv"))
    found = left.join(gu, "u").join(gv, "v").where(shared * (UP + DOWN) >= (F.col("nu") + F.col("nv")) * UP).select("u", "v")
    out = store(found, "links")
    forget(left, hashes, sets)
    return out


def _by_fingerprint(nodes: DataFrame) -> DataFrame:
    """(u, v): pairs of nodes whose fingerprints are equal or link, one node standing for each fingerprint."""
    first = nodes.groupBy("fp").agg(F.min("node").alias("u"))
    equal = nodes.select("fp", F.col("node").alias("v")).join(first, "fp").where("u <> v").select("u", "v")
    edges = fingerprint_links(first).distinct()
    far = edges.join(first.select(F.col("fp").alias("u"), F.col("u").alias("a")), "u").join(first.select(F.col("fp").alias("v"), F.col("u").alias("b")), "v")
    return equal.union(far.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")))


def _block_pairs(lists: DataFrame) -> DataFrame:
    """(x, y): all pairs of a shingle's list (g, m, x), as pairs of its blocks."""
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("x.node"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    dealt = lists.withColumn("own", own).withColumn("other", other)
    key = ["g", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")]
    left = dealt.where("own <= other").select(*key, F.col("x"))
    right = dealt.where("own >= other").select(*key, F.col("x").alias("y"))
    return left.join(right, ["g", "lo", "hi"]).where("lo < hi or x.node < y.node").select("x", "y")


def links(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """(u, v) edges whose components are those of all similar pairs of nodes."""
    spark = nodes.sparkSession
    own = Window.partitionBy("g")
    edges = spark.createDataFrame([], "u long, v long")
    found = _verified(_by_fingerprint(nodes), nodes, rows)
    if found is not None:
        edges = found
    each = nodes.select("node", "n", F.posexplode("prefix").alias("pos", "g"))
    lists = store(each.withColumn("m", F.count("*").over(own)).where("m > 1").drop("m"), "lists")
    for star in (True, False):
        roots = components(edges)
        named = lists.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        split = F.min("root").over(own) != F.max("root").over(own)
        one = F.struct("node", "n", "pos", "root")
        named = named.withColumns({"split": split, "m": F.count("*").over(own)}).where("split").select("g", "m", one.alias("x"))
        if star:
            named = store(named, "open")
            place = F.row_number().over(own.orderBy("x.pos", F.xxhash64("x.node"), "x.node"))
            met = named.join(named.withColumn("place", place).where(F.col("place") <= PIVOTS).select("g", F.col("x").alias("y")), "g")
        else:
            met = _block_pairs(store(named, "open"))
        met = met.where((F.col("x.root") != F.col("y.root")) & _possible(F.col("x"), F.col("y")))
        pairs = met.select(F.least("x.node", "y.node").alias("u"), F.greatest("x.node", "y.node").alias("v")).distinct()
        found = _verified(pairs, nodes, rows)
        if found is not None:
            edges = edges.union(found)
    return edges


def near_copies(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, component_id): one row for each of the input's; the component's smallest key."""
    attach(df.sparkSession)
    value = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.col(key).alias("k"), value.alias("text"), F.xxhash64(value).alias("h"))
    docs = store(_sketches(rows), "shingles")
    whole = F.struct("fp", "n", "bits", "prefix")
    nodes = docs.groupBy("node").agg(F.min("k").alias("first"), F.min("h").alias("h"), F.count("*").alias("rows"), F.first(whole).alias("s"))
    nodes = store(nodes.select("node", "first", "h", "rows", "s.*"), "nodes")
    roots = components(links(nodes, rows))
    linked = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    named = linked.join(nodes.select("node", "first"), "node")
    least = named.groupBy("root").agg(F.min("first").alias("least"))
    better = named.join(least, "root").select("node", "least")
    every = nodes.select("node", "first", "rows").join(better, "node", "left").select("node", "rows", F.coalesce("least", "first").alias("component_id"))
    return spread(docs.select("k", "node"), every, "node").select(F.col("k").alias(key), "component_id")
