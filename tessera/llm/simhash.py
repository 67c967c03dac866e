"""SimHash near-duplicates with pigeonring filtering.

A fingerprint of 64 bits is a ring of 16 segments of 4 bits. If two fingerprints differ in at most
3 bits then, by the strong form of the pigeonring principle, some segment of the ring starts chains
whose cumulative differences stay within proportional budgets: every chain of ``l`` segments from
there differs in at most ``floor(3 l / 16)`` bits - none in the first 5 segments, one in the first
10, two in the first 15. So the fingerprints agree on 20 bits from there, and on one half at least
of the next 20: each of the 16 starts and each half gives an exact key of 30 bits. Fingerprints
that share a key are candidates; the chain budgets prune them before the full Hamming check.

Equal fingerprints are one node, so copies are never expanded. Among the nodes of a key only a
spanning forest of the links is emitted (as many edges as nodes at most), found by breadth-first
search with one vectorised comparison a node; connected components then come from alternating
large-star and small-star rounds, each written to the shared folder. A key with more than ``HELD``
fingerprints is not held by its task: its rows are dealt again by parts of the bits that the key does
not fix, of which one at least agrees. A fingerprint that very many rows have meets its component by
broadcast; there are no more than ``HOT_SHARE`` of those a partition.

Cases: a null or empty text has no words and fingerprint zero, which links as any other; ties and
repeated rows share a fingerprint and so a component; a null doc_id is ignored when the smallest
id is sought (a component of null ids only has a null id); an empty table gives an empty result;
columns beyond the key and the text are not read, whatever their names. A very long text is cut into
words whole and its shingles vote in stretches.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.arrow import map_slices, texts
from tessera.session import attach, forget, store

BITS, SEGMENTS, DISTANCE, SEED, SHINGLE = 64, 16, 3, 42, 3
SEGMENT = BITS // SEGMENTS
#: Fingerprints of one key that a task holds.
HELD = 1 << 16
#: Rows of one fingerprint that make it hot, at least, and hot ones for each partition, at most.
HOT_ROWS, HOT_SHARE = 1000, 8


def budget(chain: int) -> int:
    """Bits in which a chain of so many segments may differ."""
    return chain * DISTANCE // SEGMENTS


#: Segments that agree from a start, and segments beyond them with one difference at most.
EXACT = max(c for c in range(1, SEGMENTS + 1) if budget(c) == 0)
NEXT = max(c for c in range(1, SEGMENTS + 1) if budget(c) <= 1) - EXACT
#: The longest chain of each budget: (bits of the chain as a mask of the rotated ring, budget).
CHAINS = [
    (np.uint64(((1 << c * SEGMENT) - 1) << (BITS - c * SEGMENT)), np.uint8(budget(c)))
    for c in range(1, SEGMENTS + 1)
    if c == SEGMENTS or budget(c + 1) > budget(c)
]


def fingerprint(text: str) -> int:
    """Unsigned SimHash of the 3-word shingles of one text."""
    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        hashes = [digest(b" ".join(words), SEED)]
    else:
        hashes = [digest(b" ".join(s), SEED) for s in zip(*(words[k:] for k in range(SHINGLE)))]
    return majority(np.array(hashes, np.uint64))


def majority(each: np.ndarray) -> int:
    """The bits that more than half of the hashes have."""
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(each), 1 << 15):  # a long text in pieces
        part = np.unpackbits(each[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1)
        votes += part.sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * votes > len(each)).tobytes(), "little")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, fp long): the fingerprint of every whole text, as a signed number."""
    kind = df.schema[key].dataType.simpleString()

    def run(part: pa.RecordBatch) -> dict:
        return {key: part.column(0), "fp": [signed(fingerprint(x)) for x in texts(part.column(1))]}

    return map_slices(df.select(key, text), run, f"`{key}` {kind}, fp long")


def turned(values: np.ndarray, start: int) -> np.ndarray:
    """Rings turned so that segment ``start`` comes first."""
    shift = start * SEGMENT
    return values if not shift else values << np.uint64(shift) | values >> np.uint64(BITS - shift)


def ring_keys(values: np.ndarray) -> np.ndarray:
    """Keys (starts and halves by value) of unsigned fingerprints."""
    exact, half = EXACT * SEGMENT, NEXT * SEGMENT // 2
    out = np.empty((2 * SEGMENTS, len(values)), np.uint64)
    for start in range(SEGMENTS):
        ring = turned(values, start)
        run = ring >> np.uint64(BITS - exact)
        for k in range(2):
            piece = ring >> np.uint64(BITS - exact - half * (k + 1)) & np.uint64((1 << half) - 1)
            out[2 * start + k] = np.uint64(2 * start + k) << np.uint64(exact + half) | run << np.uint64(half) | piece
    return out


def linked(differences: np.ndarray, start: int) -> np.ndarray:
    """Which differences pass the chain budgets from ``start``.

    Chains of growing length are tried in turn, each on what the shorter ones have left; the whole
    ring, the Hamming check, comes last.
    """
    ring = turned(differences, start)
    alive = np.arange(len(ring))
    for mask, most in CHAINS:
        alive = alive[np.bitwise_count(ring[alive] & mask) <= most]
    out = np.zeros(len(ring), bool)
    out[alive] = True
    return out


def forest(values: np.ndarray, start: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the distinct fingerprints of one key."""
    edges: list[tuple[int, int]] = []
    rest = values
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            v = queue.pop()
            near = linked(rest ^ v, start)
            if near.any():
                found = rest[near]
                edges += [(int(v), int(x)) for x in found]
                queue += list(found)
                rest = rest[~near]
    return edges


_KEY_BITS = EXACT * SEGMENT + NEXT * SEGMENT // 2


def sub_keys(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys for rows of large keys, four a row: the start, and a hash of the key and of one part of the bits it leaves open.

    Three differences cannot touch all four parts, so linked fingerprints of a key share a sub-key.
    """
    which = (keys >> np.int64(_KEY_BITS)).astype(np.int64)
    exact, half = EXACT * SEGMENT, NEXT * SEGMENT // 2
    out_k, out_v = [], []
    for w in np.unique(which).tolist():
        some = which == w
        ring = turned(values[some], w // 2)
        other = ring >> np.uint64(BITS - exact - half * (2 - w % 2)) & np.uint64((1 << half) - 1)
        tail = BITS - exact - 2 * half
        cuts = [tail * q // 3 for q in range(4)]
        parts = [other] + [ring >> np.uint64(a) & np.uint64((1 << b - a) - 1) for a, b in zip(cuts, cuts[1:])]
        for q, part in enumerate(parts):
            h = (keys[some].view(np.uint64) * np.uint64(4) + np.uint64(q)) * np.uint64(0x9E3779B97F4A7C15) + part
            h = (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ h >> np.uint64(32)) & np.uint64((1 << 57) - 1)
            out_k.append((np.uint64(w // 2) << np.uint64(58) | np.uint64(1 << 57) | h).view(np.int64))
            out_v.append(values[some])
    return np.concatenate(out_k), np.concatenate(out_v)


def _starts(keys: np.ndarray) -> np.ndarray:
    """The segment that each key's chains start at; sub-keys have bit 57 set."""
    sub = keys >> np.int64(57) & np.int64(1) == 1
    return np.where(sub, keys >> np.int64(58) & np.int64(15), (keys >> np.int64(_KEY_BITS)) // 2)


def _edges_of(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forest edges of all keys; rows are sorted by key."""
    cuts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
    sizes = np.diff(cuts)
    starts = _starts(keys[cuts[:-1]])
    u, v = [], []
    two = cuts[:-1][sizes == 2]
    for start in np.unique(starts[sizes == 2]).tolist():
        at = two[starts[sizes == 2] == start]
        hit = at[linked(values[at] ^ values[at + 1], start)]
        u += values[hit].tolist()
        v += values[hit + 1].tolist()
    for k in np.flatnonzero(sizes > 2).tolist():
        for a, b in forest(values[cuts[k] : cuts[k + 1]], int(starts[k])):
            u.append(a)
            v.append(b)
    return tuple(np.array(x, np.uint64).view(np.int64) for x in (u, v))


def _joined(dealt: DataFrame, held: int | None) -> DataFrame:
    """(u, v, key): edges (key null), and rows of keys with more than ``held`` fingerprints, as (fp, fp, key)."""
    n = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def batch(u: np.ndarray, v: np.ndarray, key: np.ndarray | None = None) -> pa.RecordBatch:
        keys = pa.nulls(len(u), pa.int64()) if key is None else pa.array(key)
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), keys], ["u", "v", "key"])

    def join(batches):
        """Rows come by key; the last key of a batch waits for the next batch, up to ``held`` rows."""
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        size, large = 0, None
        for part in batches:
            if not part.num_rows:
                continue
            k, v = part.column(0).to_numpy(), part.column(1).to_numpy()
            if large is not None:  # the rest of a large key
                cut = int(np.searchsorted(k, large, "right"))
                if cut:
                    yield batch(v[:cut], v[:cut], k[:cut])
                k, v = k[cut:], v[cut:]
                if not len(k):
                    continue
                large = None
            if waiting:
                k, v = np.concatenate([waiting[0][0], k]), np.concatenate([waiting[0][1], v])
            cut = int(np.searchsorted(k, k[-1], "left"))
            if cut:
                yield batch(*_edges_of(k[:cut], v[:cut].view(np.uint64)))
            waiting = [(k[cut:], v[cut:])]
            size = len(k) - cut
            if held is not None and size > held:
                large, waiting = int(k[-1]), []
                yield batch(v[cut:], v[cut:], k[cut:])
        if waiting:
            yield batch(*_edges_of(waiting[0][0], waiting[0][1].view(np.uint64)))

    return dealt.repartition(n, "key").sortWithinPartitions("key", "fp").mapInArrow(join, "u long, v long, key long")


def links(nodes: DataFrame, fp: str = "fp", held: int = HELD) -> DataFrame:
    """(u, v) edges whose components are those of all links between the distinct fingerprints."""
    spark = attach(nodes.sparkSession)

    def deal(part: pa.RecordBatch) -> dict:
        values = part.column(0).to_numpy().view(np.uint64)
        keys = ring_keys(values)
        return {"key": keys.ravel().view(np.int64), "fp": np.tile(values.view(np.int64), len(keys))}

    def deal_again(part: pa.RecordBatch) -> dict:
        keys, values = sub_keys(part.column(0).to_numpy(), part.column(1).to_numpy().view(np.uint64))
        return {"key": keys, "fp": values.view(np.int64)}

    dealt = map_slices(nodes.select(fp), deal, "key long, fp long", rows=1 << 14)
    found = store(_joined(dealt, held).coalesce(2 * few(spark)), "links")
    edges, large = found.where("key is null").select("u", "v"), found.where("key is not null")
    if large.isEmpty():
        return edges
    again = map_slices(large.select("key", F.col("u").alias("fp")), deal_again, "key long, fp long", rows=1 << 14)
    return edges.unionByName(store(_joined(again, None).select("u", "v"), "links"))


def few(spark) -> int:
    """Files for a narrow table: small ones on a cluster cost more than they save."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of the edges with the smallest node of its component.

    Large-star joins each node's larger neighbours to its smallest neighbour, small-star the
    smaller ones and itself; the rounds end when no edge changes. A round is two exchanges by node
    (a window over a node's edges each, which spills and never gains rows) and a written table.
    """
    u, v = F.col("u"), F.col("v")
    node = Window.partitionBy("u")
    files = few(edges.sparkSession)
    now = store(edges.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct().coalesce(files), "edges")
    sign = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    was = sign(now)
    while True:
        both = now.union(now.select("v", "u")).withColumn("m", F.least(F.min("v").over(node), u))
        large = both.where(v > u).select(v.alias("u"), F.col("m").alias("v"))
        first = F.row_number().over(node.orderBy("v")) == 1
        least = large.withColumns({"m": F.min("v").over(node), "first": first})
        # the node itself once, and each other neighbour
        pair = F.when(F.col("first"), F.struct(u.alias("u"), F.col("m").alias("v"))).when(v != F.col("m"), F.struct(v.alias("u"), F.col("m").alias("v")))
        new = store(least.select(pair.alias("e")).where("e is not null").select("e.u", "e.v").coalesce(files), "edges")
        forget(now)
        now, sig = new, sign(new)
        if sig == was:
            return now.select(u.alias("node"), v.alias("root"))
        was = sig


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp, component_id): one row for each of the input's."""
    spark = attach(df.sparkSession)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = store(fingerprints(df, key, text).repartition(n).coalesce(few(spark)), "fingerprints")
    nodes = store(docs.groupBy("fp").agg(F.min(key).alias("first"), F.count("*").alias("rows")).coalesce(few(spark)), "nodes")
    roots = components(links(nodes))
    linked_nodes = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    named = linked_nodes.join(nodes, linked_nodes.node == nodes.fp).select("root", "fp", "first")
    least = named.groupBy("root").agg(F.min("first").alias("least"))
    better = named.join(least, "root").select("fp", "least")
    every = nodes.join(better, "fp", "left").select("fp", "rows", F.coalesce("least", "first").alias("component_id"))
    return spread(docs, every, "fp").select(key, "fp", "component_id")


def spread(docs: DataFrame, every: DataFrame, on: str) -> DataFrame:
    """``docs`` with the columns of ``every`` (one row a value of ``on``, with its number of ``rows`` in docs).

    Values with a large share of the rows are joined by broadcast: as each of them has at least
    ``total / (HOT_SHARE * partitions)`` rows, there are no more than ``HOT_SHARE * partitions``.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = store(every.coalesce(few(docs.sparkSession)), "named")
    total = every.agg(F.sum("rows")).first()[0] or 0
    hot = F.col("rows") > max(HOT_ROWS, total // (HOT_SHARE * n))
    value = every.drop("rows").withColumnRenamed(on, "_on")
    marked = docs.join(F.broadcast(every.where(hot).select(F.col(on).alias("_hot"))), F.col(on) == F.col("_hot"), "left")
    few_values = F.broadcast(every.where(hot).drop("rows").withColumnRenamed(on, "_on"))
    often = marked.where(F.col("_hot").isNotNull()).join(few_values, F.col(on) == F.col("_on"))
    seldom = marked.where(F.col("_hot").isNull()).join(value, F.col(on) == F.col("_on"))
    return often.unionByName(seldom).drop("_hot", "_on")
