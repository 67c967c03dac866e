"""Document fingerprints by winnowing.

The code points of a text are cut into all runs of ``K``; each run has a hash rolled from prefix
hashes. Of each window of ``WINDOW`` neighbouring hashes the smallest is chosen, the rightmost of
equals, and a hash chosen by several windows is kept once, with its position. So any stretch of
``WINDOW + K - 1`` code points that two texts share gives them one chosen hash at least in common,
at known positions.

Pairing each document with the next one in the order of doc_id needs no global sort: documents are
dealt to consecutive ranges of ids by range boundaries from the ids alone, each range's first
documents go to the range before as well, and one pass over a sorted range sees each document
followed by the next.

Cases: null counts as empty; a text shorter than K code points is one run of its own, an empty one
has no hash and is like only another empty one; equal texts have equal fingerprints; documents with
one doc_id follow each other in the order of their texts; a null doc_id comes first; one document
alone is its own next; an empty table gives an empty result; columns beyond key and text are not
read. Very long texts are processed whole, in a few arrays of their length.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.llm.arrow import map_slices, slices, texts
from tessera.session import attach

K, WINDOW = 16, 24
#: Rows that a range of ids holds about, and the most ranges. A range is streamed, not held, so its
#: size bounds no memory; the number of ranges bounds the boundaries on the driver to a megabyte.
RANGE_ROWS, RANGES = 500, 1 << 17

_BASE = 0x9E3779B97F4A7C15


def run_hashes(points: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of all runs of ``k`` code points, doubled up from single ones; a short text is one run."""
    if len(points) == 0:
        return np.zeros(0, np.uint64)
    k = min(k, len(points))
    power, size, step = points.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(k), 1, _BASE
    out, have = None, 0
    while k:
        if k & 1:
            if out is None:
                out, have = power, size
            else:
                m = len(points) - have - size + 1
                out = out[:m] * np.uint64(step) + power[have : have + m]
                have += size
        k >>= 1
        if k:
            m = len(power) - size
            power = power[:m] * np.uint64(step) + power[size : size + m]
            size, step = size * 2, step * step % (1 << 64)
    out = (out ^ out >> np.uint64(31)) * np.uint64(0x94D049BB133111EB)
    return out ^ out >> np.uint64(29)


def rightmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Places that some window of ``width`` values chooses: its smallest, rightmost of equals."""
    place = np.arange(len(values), dtype=np.int32)
    width = min(width, len(values))
    least, span = values, 1
    while span < width:
        step = min(span, width - span)
        m = len(least) - step
        right = least[step:] <= least[:m]
        place = np.where(right, place[step:], place[:m])
        least = np.where(right, least[step:], least[:m])
        span += step
    if not len(place):
        return place
    return place[np.concatenate([[True], place[1:] != place[:-1]])]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def winnow(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chosen hashes and their positions, in order."""
    hashes = run_hashes(points)
    at = rightmost_minima(hashes, WINDOW)
    return hashes[at], at


def digest(hashes: np.ndarray, at: np.ndarray) -> str:
    """One string for hashes and positions."""
    return hashlib.sha256(hashes.tobytes() + at.astype(np.int32).tobytes()).hexdigest()[:32]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared share (Jaccard) of two sorted sets of hashes; two empty ones are alike."""
    if not len(a) and not len(b):
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    both = int(np.count_nonzero(a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b))
    return both / (len(a) + len(b) - both)


def fingerprints(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n_chars, fingerprint, hashes array<long>, positions array<int>) of every whole text."""
    kind = df.schema[key].dataType.simpleString()

    def run(part: pa.RecordBatch) -> dict:
        points = [code_points(x) for x in texts(part.column(1))]
        chosen = [winnow(p) for p in points]
        return {
            key: part.column(0),
            "n_chars": [len(p) for p in points],
            "fingerprint": [digest(*c) for c in chosen],
            "hashes": [h.view(np.int64) for h, _ in chosen],
            "positions": [at for _, at in chosen],
        }

    return map_slices(df.select(key, text), run, f"`{key}` {kind}, n_chars long, fingerprint string, hashes array<long>, positions array<int>")


def edited(own: np.ndarray, following: np.ndarray) -> np.ndarray:
    """The last quarter of the code points replaced by the first as many (or all) of the next text."""
    q = len(own) // 4
    return np.concatenate([own[: len(own) - q], following[:q]])


def with_next(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows dealt to ranges of consecutive ids and sorted there: (range, copy, k, text).

    Rows with ``copy`` are the first ones of the next range (of all, in the last range); they follow
    a range's last row. Boundaries are quantiles of the ids alone, ``RANGES`` of them at most.
    """
    spark = attach(df.sparkSession)
    kind = df.schema[key].dataType
    rows = df.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = rows.agg(F.count("*").alias("n"), F.count("k").alias("ids"), F.min("k").alias("least")).first()
    wanted = max(1, min(RANGES, found.n // RANGE_ROWS))
    cuts: list = []
    if wanted > 1 and found.ids:
        at = F.percentile_approx("k", [i / wanted for i in range(1, wanted)], min(20 * wanted, 1 << 21))
        cuts = sorted({c for c in rows.agg(at).first()[0] if c > found.least})  # ids that exist
    first = F.col("k") == F.lit(found.least)
    if found.ids < found.n:
        least = rows.where("k is null").agg(F.min("text").alias("text"))  # one row
        first = F.col("k").isNull() & (F.col("text") == least.scalar())

    bounds = np.array(cuts)

    @F.pandas_udf(T.IntegerType())
    def place(ids: pd.Series) -> pd.Series:
        """Twice the range, and one more for an id that starts it."""
        values = ids.to_numpy()
        r = np.searchsorted(bounds, values, "right")
        starts = (r > 0) & (bounds[np.maximum(r - 1, 0)] == values)
        return pd.Series((2 * r + starts).astype(np.int32))

    known = F.coalesce("k", F.lit(found.least))  # a null would make pandas' numbers inexact
    where = F.when(F.col("k").isNull(), 0).otherwise(place(known)) if cuts else F.lit(0)
    own = F.struct(F.shiftright("p", 1).alias("r"), F.lit(False).alias("copy"))
    before = F.when(F.col("p") % 2 == 1, F.struct((F.shiftright("p", 1) - 1).alias("r"), F.lit(True).alias("copy")))
    last = F.when(first, F.struct(F.lit(len(cuts)).alias("r"), F.lit(True).alias("copy")))
    every = rows.withColumn("p", where).withColumn("at", F.explode(F.array_compact(F.array(own, before, last))))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = every.select(F.col("at.r").alias("r"), F.col("at.copy").alias("copy"), "k", "text")
    assert out.schema["k"].dataType == kind
    return out.repartition(n, "r").sortWithinPartitions("r", "copy", "k", "text")


def compare_edited(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint against its edited text's and the next document's.

    (key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_hashes,
    hashes, positions): the two strings are digests of chosen hashes and positions; the document's own
    are returned too, so a reader can place what two documents share.
    """
    dealt = with_next(df, key, text)
    kind = df.schema[key].dataType.simpleString()
    names = [key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_hashes", "hashes", "positions"]
    types = [dealt.schema["k"].dataType, "long", "string", "string", "string", "double", "double", "long", "array<long>", "array<int>"]

    def row(doc, following):
        k, points, chosen, print_, distinct = doc
        new = edited(points, following[1])
        got = winnow(new)
        return (
            k, len(points), hashlib.sha256(new.tobytes().decode("utf-32-le").encode("utf-8")).hexdigest(), print_, digest(*got),
            likeness(distinct, np.unique(got[0])), likeness(distinct, following[4]), len(chosen[0]), chosen[0].view(np.int64), chosen[1],
        )

    def run(batches):
        held, range_of, is_copy = None, None, False
        for part in slices(batches):
            out = []
            for r, copy, k, value in zip(*(part.column(i).to_pylist() for i in range(4))):
                if copy and is_copy and r == range_of:
                    continue  # one is enough
                points = code_points(value)
                chosen = winnow(points)
                now = k, points, chosen, digest(*chosen), np.unique(chosen[0])
                if held is not None and not is_copy:
                    out.append(row(held, now if r == range_of else held))
                held, range_of, is_copy = now, r, copy
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*out))), schema=schema)
        if held is not None and not is_copy:
            yield pa.RecordBatch.from_pydict(dict(zip(names, zip(row(held, held)))), schema=schema)

    ddl = ", ".join(f"`{n}` {kind if i == 0 else t}" for i, (n, t) in enumerate(zip(names, types)))
    schema = to_arrow_schema(T.StructType.fromDDL(ddl))
    return dealt.mapInArrow(run, ddl)
