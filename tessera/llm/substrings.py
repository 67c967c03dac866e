"""Substring dedup with a log-structured fingerprint index.

Every window of 20 words has a fingerprint. Fingerprints are kept in sorted immutable runs; a new
batch of windows is sorted and merge-joined with each run, a match is verified by a second hash, the
batch's first-seen fingerprints become a new run, and runs of like size are compacted.

Within one delivery the runs are a task's own: while documents are cut up, each batch is judged
against the windows that the task has seen in documents before it (:class:`Shard`; it starts anew
when it is full), so a passage that a third of the documents repeat leaves each task once or a few
times. What is left meets by anchor, the smallest hash among the window's 5-word pieces (leftmost of
equals): equal windows have equal anchors, and neighbouring windows mostly share one, so one row
carries some eight windows. Rows come sorted by anchor and document, and a task holds one anchor's
rows at a time; an anchor with more than ``HELD`` rows is not held: its windows are dealt again one
by one. :class:`Index` keeps the runs in the shared folder between deliveries.

A window is known by its anchor's 64 bits and 48 bits of its own hash: 112 bits must agree.

Cases: null, empty and short texts (under 20 words) have no windows; windows start anywhere, so
ties do not occur but for rows with one doc_id: such rows follow each other by their text's hash,
and fully equal rows count as one document and get equal results; a null doc_id is the smallest;
an empty table gives an empty result; columns beyond key and text are not read, whatever their
names. Very long texts are one array of words; marks stream by document.
"""

from __future__ import annotations

import hashlib
import json
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.arrow import map_tasks, slices, texts
from tessera.session import attach, store

WINDOW, PIECE = 20, 5
OWN_BYTES = 6
#: Distinct words whose hashes a worker remembers; it starts anew beyond them.
WORDS = 1_000_000
#: Windows that a task's own runs hold before they start anew.
SEEN = 1 << 20
#: Rows of one anchor that a task holds.
HELD = 1 << 15

_B1 = 0x9E3779B97F4A7C15


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, 7)
        return h


_HASHES = _Hashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of polynomial hashes."""
    h = (h ^ h >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ h >> np.uint64(29)) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ h >> np.uint64(32)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hashes of all runs of ``n`` words, by doubling."""
    out, have, base = None, 0, 1
    power, size, step = h, 1, _B1
    rest = n
    while rest:
        if rest & 1:
            if out is None:
                out, have = power, size
            else:  # out covers `have` words, then `size` more
                m = len(h) - have - size + 1
                out = out[:m] * np.uint64(step) + power[have : have + m]
                have += size
        rest >>= 1
        if rest:
            m = len(power) - size
            power = power[:m] * np.uint64(step) + power[size : size + m]
            size *= 2
            step = step * step & 0xFFFFFFFFFFFFFFFF
    return out


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values the place of its smallest, leftmost of equals."""
    place = np.arange(len(values))
    least, span = values, 1
    while span < width:
        step = min(span, width - span)
        m = len(least) - step
        right = least[step:] < least[:m]
        place = np.where(right, place[step:], place[:m])
        least = np.where(right, least[step:], least[:m])
        span += step
    return place


def anchored(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a document: each anchor's first window, number of windows and hash; all windows' own hashes."""
    h = word_hashes(words)
    own = mix(grams(h, WINDOW))
    pieces = mix(grams(h, PIECE))
    at = leftmost_minima(pieces, WINDOW - PIECE + 1)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return first, np.diff(np.concatenate([first, [len(at)]])), pieces[at[first]], own


# ---------------------------------------------------------------- runs within a task


class Shard:
    """Sorted immutable runs of verified fingerprints: arrays of keys and, beside them, of anchors."""

    def __init__(self) -> None:
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []

    def __len__(self) -> int:
        return sum(len(keys) for keys, _ in self.runs)

    def known(self, keys: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Merge-join sorted keys with each run; a match counts if its second hash agrees too."""
        out = np.zeros(len(keys), bool)
        for run, checks in self.runs:
            at = np.searchsorted(run, keys)
            at[at == len(run)] = 0
            out |= (run[at] == keys) & (checks[at] == check)
        return out

    def append(self, keys: np.ndarray, check: np.ndarray) -> None:
        """Add a sorted run and compact runs of like size."""
        if not len(keys):
            return
        self.runs.append((keys, check))
        while len(self.runs) > 1 and len(self.runs[-2][0]) < 2 * len(self.runs[-1][0]):
            (a, x), (b, y) = self.runs[-2:]
            both, checks = np.concatenate([a, b]), np.concatenate([x, y])
            order = np.argsort(both, kind="stable")  # merges sorted stretches
            self.runs[-2:] = [(both[order], checks[order])]

    def seen(self, keys: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Which windows of a batch in order were seen before, in the batch or in any run; then add it."""
        order = np.argsort(keys, kind="stable")
        sorted_keys, sorted_check = keys[order], check[order]
        repeat = np.zeros(len(keys), bool)
        repeat[1:] = (sorted_keys[1:] == sorted_keys[:-1]) & (sorted_check[1:] == sorted_check[:-1])
        old = self.known(sorted_keys, sorted_check)
        new = ~(repeat | old)
        self.append(sorted_keys[new], sorted_check[new])
        out = np.empty(len(keys), bool)
        out[order] = ~new
        return out


# ---------------------------------------------------------------- windows


def windows(df: DataFrame, key: str, text: str, own_runs: bool = True) -> DataFrame:
    """(key, th, first, anchor, own, mask): one row for each anchor of each document.

    ``th`` is the text's hash, ``own`` holds 6 bytes for each of the anchor's windows, the first of
    which starts at word ``first``. Bit ``k`` of ``mask`` tells that a document before this one, or
    this one before, has the window at ``first + k`` in the same task; a row all of whose windows are
    marked so carries no ``own``. Without ``own_runs`` nothing is marked.
    """
    kind = df.schema[key].dataType.simpleString()
    names = (key, "th", "first", "anchor", "own", "mask")

    def start():
        shard, last = Shard(), None

        def run(part: pa.RecordBatch) -> dict:
            nonlocal shard, last
            docs = []
            for k, (value, name) in enumerate(zip(texts(part.column(1)), part.column(0).to_pylist())):
                raw = value.encode("utf-8")
                words = raw.split()
                if len(words) >= WINDOW:
                    h = xxhash.xxh64_intdigest(raw)
                    docs.append((name is not None, name, h - (1 << 64) * (h >> 63), k, words))
            docs.sort(key=lambda d: (d[0], d[1], d[2]) if d[0] else (False, 0, d[2]))
            out: list[tuple] = []
            for there, name, th, k, words in docs:
                first, count, anchor, own = anchored(words)
                at = (there, name, th) if there else (False, 0, th)
                if last is not None and at < last or len(shard) > SEEN:
                    shard = Shard()
                if not own_runs or at == last:  # the same row again does not repeat itself
                    seen = np.zeros(len(own), bool)
                else:
                    seen = shard.seen(own, np.repeat(anchor, count))
                last = at
                mask = np.bitwise_or.reduceat(np.left_shift(seen.astype(np.int64), np.arange(len(own)) - np.repeat(first, count)), first)
                cut = np.ascontiguousarray(own.view(np.uint8).reshape(-1, 8)[:, :OWN_BYTES]).tobytes()
                full = mask == np.left_shift(np.int64(1), count) - 1
                owns = [b"" if f else cut[a * OWN_BYTES : (a + n) * OWN_BYTES] for a, n, f in zip(first.tolist(), count.tolist(), full.tolist())]
                out.append((np.full(len(first), k), np.full(len(first), th), first, anchor, owns, mask))
            if not out:
                return {c: [] for c in names}
            rows, th, first, anchor, _, mask = (np.concatenate([o[i] for o in out]) if i != 4 else None for i in range(6))
            return {
                key: part.column(0).take(pa.array(rows)),
                "th": th.astype(np.int64),
                "first": first.astype(np.int32),
                "anchor": anchor.view(np.int64),
                "own": [x for o in out for x in o[4]],
                "mask": mask,
            }

        return run

    return map_tasks(df.select(key, text), start, f"`{key}` {kind}, th long, first int, anchor long, own binary, mask long", size=1 << 20)


def unpacked(anchor: pa.Array, own: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and second hashes of all windows of some rows, and each row's number of windows."""
    own = own.combine_chunks() if isinstance(own, pa.ChunkedArray) else own
    offsets = np.frombuffer(own.buffers()[1], np.int32)[own.offset : own.offset + len(own) + 1]
    count = np.diff(offsets) // OWN_BYTES
    raw = np.frombuffer(own.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].reshape(-1, OWN_BYTES)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :OWN_BYTES] = raw
    check = np.repeat(anchor.to_numpy(zero_copy_only=False).view(np.uint64), count)
    # one to one for a given anchor: an odd multiplier loses nothing
    return check + wide.view(np.uint64).ravel() * np.uint64(_B1), check, count


def mark(rows: DataFrame, key: str, held: int = HELD) -> DataFrame:
    """(key, th, first, mask): a row for each anchor with repeated windows; bit ``k`` is the window at ``first + k``.

    Rows of :func:`windows` meet by anchor, in order of (key, th, first); marked ones without windows
    pass through any task.
    """
    spark = attach(rows.sparkSession)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = rows.schema[key].dataType.simpleString()
    deal = F.when(F.length("own") > 0, F.col("anchor")).otherwise(F.xxhash64(key, "th", "first"))
    dealt = rows.select("*", deal.alias("deal")).repartition(n, "deal").sortWithinPartitions("deal", key, "th", "first")
    columns = [key, "th", "first", "anchor", "own", "mask"]
    out_names = [key, "th", "first", "mask", "anchor", "own"]

    def whole(part: pa.Table) -> pa.RecordBatch:
        """Rows as they are, for those whose anchor is too large."""
        return part.select(out_names).combine_chunks().to_batches()[0]

    def judged(part: pa.Table) -> pa.RecordBatch | None:
        """Marks of complete anchors."""
        part = part.combine_chunks()
        same = np.zeros(part.num_rows, bool)
        same[1:] = True
        for c in ("deal", "th", "first"):  # equal rows count once
            x = part[c].to_numpy()
            same[1:] &= x[1:] == x[:-1]
        for k in np.flatnonzero(same).tolist():
            same[k] = part[key][k] == part[key][k - 1] or not (part[key][k].is_valid or part[key][k - 1].is_valid)
        if same.any():
            part = part.filter(pa.array(~same))
        keys, check, count = unpacked(part["anchor"], part["own"])
        order = np.argsort(keys, kind="stable")
        k, c = keys[order], check[order]
        seen = np.zeros(len(keys), bool)
        seen[order[1:]] = (k[1:] == k[:-1]) & (c[1:] == c[:-1])
        mask = part["mask"].to_numpy().copy()
        if len(keys):
            row = np.repeat(np.arange(len(count)), count)
            begin = np.cumsum(count) - count
            np.bitwise_or.at(mask, row[seen], np.left_shift(np.int64(1), np.flatnonzero(seen) - begin[row[seen]]))
        some = np.flatnonzero(mask)
        if not len(some):
            return None
        part = part.take(pa.array(some))
        nulls = [pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.binary())]
        return pa.RecordBatch.from_arrays([*(part[c].combine_chunks() for c in (key, "th", "first")), pa.array(mask[some]), *nulls], out_names)

    def run(batches):
        waiting: pa.Table | None = None
        large = None
        for batch in slices(batches, rows=HELD, size=4 << 20):
            part = pa.Table.from_batches([batch])
            if large is not None:
                cut = int(np.searchsorted(part["deal"].to_numpy(), large, "right"))
                if cut:
                    yield whole(part.slice(0, cut))
                part = part.slice(cut)
                if not part.num_rows:
                    continue
                large = None
            if waiting is not None:
                part = pa.concat_tables([waiting, part])
            deals = part["deal"].to_numpy()
            cut = int(np.searchsorted(deals, deals[-1], "left"))
            if cut and (marks := judged(part.slice(0, cut))) is not None:
                yield marks
            waiting = part.slice(cut)
            if waiting.num_rows > held:
                large = int(deals[-1])
                yield whole(waiting)
                waiting = None
        if waiting is not None and (marks := judged(waiting)) is not None:
            yield marks

    schema = f"`{key}` {kind}, th long, first int, mask long, anchor long, own binary"
    found = store(dealt.select(*columns, "deal").mapInArrow(run, schema), "marks")
    marks, large = found.where("anchor is null").select(key, "th", "first", "mask"), found.where("anchor is not null")
    if large.isEmpty():
        return marks
    # what the tasks' own runs have marked, and the rest window by window
    marked = large.where("mask <> 0").select(key, "th", "first", "mask")
    return marks.unionByName(marked).unionByName(_later(single(large, key), first_seen(single(large, key), key), key))


# ---------------------------------------------------------------- windows one by one


def single(rows: DataFrame, key: str) -> DataFrame:
    """(key, th, pos, anchor, own): one row a window, of rows that carry windows."""
    n = (F.length("own") / OWN_BYTES).cast("int")
    cut = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(F.col("own"), i * OWN_BYTES + 1, F.lit(OWN_BYTES)))
    each = rows.where(n > 0).select(key, "th", "first", "anchor", F.posexplode(cut).alias("k", "own"))
    return each.select(key, "th", (F.col("first") + F.col("k")).alias("pos"), "anchor", "own")


def first_seen(flat: DataFrame, key: str) -> DataFrame:
    """(anchor, own, least, n): where each window is first, aggregated before the exchange."""
    return flat.groupBy("anchor", "own").agg(F.min(F.struct(F.col(key).alias("k"), "th", "pos")).alias("least"), F.count("*").alias("n"))


def _later(flat: DataFrame, first: DataFrame, key: str) -> DataFrame:
    """Marks of the windows that are not the first of theirs, or that ``first`` calls known."""
    known = F.col("known") if "known" in first.columns else F.lit(False)
    here = F.struct(F.col(key).alias("k"), "th", "pos")
    met = flat.join(first.where(known | (F.col("n") > 1)), ["anchor", "own"]).where(known | ~here.eqNullSafe(F.col("least")))
    return met.select(key, "th", F.col("pos").alias("first"), F.lit(1).cast("long").alias("mask"))


# ---------------------------------------------------------------- documents


def covered(n_words: int, first: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Which words some repeated window covers."""
    step = np.zeros(n_words + 1, np.int32)
    for k in range(WINDOW - PIECE + 1):
        at = first[mask >> k & 1 == 1] + k
        np.add.at(step, at, 1)
        np.add.at(step, at + WINDOW, -1)
    return np.cumsum(step[:-1]) > 0


def kept(df: DataFrame, key: str, text: str, marks: DataFrame) -> DataFrame:
    """(key, n_words, n_removed, kept): every document with its words that no mark covers, joined by a space."""
    spark = attach(df.sparkSession)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = df.schema[key].dataType.simpleString()
    value = F.col(text)
    docs = df.select(F.col(key).alias("k"), value.alias("text"), F.lit(None).cast("long").alias("th"), F.lit(None).cast("int").alias("first"), F.lit(None).cast("long").alias("mask"))
    noted = marks.select(F.col(key).alias("k"), F.lit(None).cast("string").alias("text"), "th", "first", "mask")
    # marks of a key come before its documents
    dealt = noted.unionByName(docs).repartition(n, "k").sortWithinPartitions("k", F.col("first").asc_nulls_last())

    def run(batches):
        notes: dict[int, tuple[list[int], list[int]]] = {}
        of = None
        for part in slices(batches):
            out: tuple[list, list, list, list] = [], [], [], []
            for k, value, th, first, mask in zip(*(part.column(i).to_pylist() for i in range(5))):
                if k != of:
                    of, notes = k, {}
                if first is not None:
                    a, b = notes.setdefault(th, ([], []))
                    a.append(first)
                    b.append(mask)
                    continue
                raw = (value or "").encode("utf-8")
                words = raw.split()
                removed = 0
                note = notes.get(xxhash.xxh64_intdigest(raw) - (1 << 64) * (xxhash.xxh64_intdigest(raw) >> 63)) if notes else None
                if note:
                    gone = covered(len(words), np.array(note[0]), np.array(note[1]))
                    removed = int(gone.sum())
                    left = [w for w, g in zip(words, gone.tolist()) if not g]
                else:
                    left = words
                for column, x in zip(out, (k, len(words), removed, b" ".join(left).decode("utf-8"))):
                    column.append(x)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], part.schema.field(0).type), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.string())], [key, "n_words", "n_removed", "kept"])

    return dealt.mapInArrow(run, f"`{key}` {kind}, n_words long, n_removed long, kept string")


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_removed, kept) for every row."""
    return kept(df, key, text, mark(windows(df, key, text), key))


def digests(cleaned: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_words, n_removed, kept_sha256)."""
    return cleaned.select(key, "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


class Index:
    """The index between deliveries: immutable sorted runs in one folder, named by a manifest.

    A run is a Parquet table in buckets by window, sorted in each, so a new delivery is sorted once
    and merge-joined with run after run; the runs are not shuffled again. The newest manifest names
    the runs that count and the deliveries each of them covers; it is written under a name of its own
    and renamed, so a reader sees the set before or after a change and a second writer fails. Each row
    names the delivery that had its window first, also in a merged run.
    """

    RUN = "anchor long, own binary, delivery string"

    def __init__(self, spark: SparkSession, path: str, most: int = 4, fan: int = 8, buckets: int | None = None):
        self.spark, self.path, self.most, self.fan = attach(spark), path.rstrip("/"), most, fan
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    # -- files

    def _fs(self):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _manifests(self) -> list[str]:
        fs, p = self._fs(), self._at("")
        if not fs.exists(p):
            return []
        return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(p)) if n.startswith("manifest-") and n.endswith(".json"))

    def manifest(self) -> dict:
        """{"buckets", "runs": [{"name", "rows", "deliveries"}]}, oldest run first."""
        names = self._manifests()
        if not names:
            return {"buckets": self.buckets, "runs": []}
        stream = self._fs().open(self._at(names[-1]))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, runs: list[dict]) -> None:
        """Make a new set of runs the current one; runs that it leaves out are deleted afterwards."""
        fs, names, old = self._fs(), self._manifests(), self.manifest()
        number = int(names[-1][9:-5]) + 1 if names else 1
        draft = self._at(f".draft-{uuid.uuid4().hex}")
        out = fs.create(draft)
        out.write(bytearray(json.dumps({"buckets": old["buckets"], "runs": runs}).encode()))
        out.close()
        if not fs.rename(draft, self._at(f"manifest-{number:08d}.json")):
            raise RuntimeError("another writer changed the index")
        keep = {r["name"] for r in runs}
        for r in old["runs"]:
            if r["name"] not in keep:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._table(r['name'])}")
                fs.delete(self._at(r["name"]), True)
        for name in names[:-1]:
            fs.delete(self._at(name), False)

    # -- runs

    def _table(self, run: str) -> str:
        return "index_" + hashlib.md5(f"{self.path}/{run}".encode()).hexdigest()

    def _write(self, rows: DataFrame, deliveries: list[str]) -> dict | None:
        """A new run's entry in the manifest; none for no rows."""
        n, name = self.manifest()["buckets"], f"run-{uuid.uuid4().hex}"
        sorted_rows = rows.select("anchor", "own", "delivery").repartition(n, "anchor", "own").sortWithinPartitions("anchor", "own")
        sorted_rows.write.bucketBy(n, "anchor", "own").sortBy("anchor", "own").option("path", f"{self.path}/{name}").saveAsTable(self._table(name))
        count = self._read(name).count()
        return {"name": name, "rows": count, "deliveries": deliveries} if count else None

    def _read(self, run: str) -> DataFrame:
        table = self._table(run)
        if not self.spark.catalog.tableExists(table):  # another session wrote it
            n = self.manifest()["buckets"]
            self.spark.sql(f"CREATE TABLE {table} (anchor BIGINT, own BINARY, delivery STRING) USING parquet CLUSTERED BY (anchor, own) SORTED BY (anchor, own) INTO {n} BUCKETS LOCATION '{self.path}/{run}'")
        return self.spark.table(table)

    def runs(self) -> list[str]:
        """Paths of the current runs, oldest first."""
        return [f"{self.path}/{r['name']}" for r in self.manifest()["runs"]]

    def history(self) -> DataFrame | None:
        """All windows of the current runs."""
        out = None
        for r in self.manifest()["runs"]:
            out = self._read(r["name"]) if out is None else out.unionByName(self._read(r["name"]))
        return out

    def ingest(self, df: DataFrame, name: str, key: str = "doc_id", text: str = "text") -> DataFrame:
        """Clean a delivery; its windows are in the index when this returns.

        A repeated ingest of the delivery ``name`` is judged against all windows but its own, before
        and after a compaction, and adds only windows that no run has. Deliveries come in the order
        of the calls. When there are more than ``fan`` runs the smallest ones are merged.
        """
        flat = store(single(windows(df, key, text, own_runs=False), key), "windows")
        first = first_seen(flat, key).withColumns({"known": F.lit(False), "held": F.lit(False)})
        entries = self.manifest()["runs"]
        for r in entries:
            run = self._read(r["name"]).withColumn("other", ~F.col("delivery").eqNullSafe(name)).drop("delivery")
            first = first.join(run, ["anchor", "own"], "left").withColumns({"known": F.col("known") | F.coalesce("other", F.lit(False)), "held": F.col("held") | F.col("other").isNotNull()}).drop("other")
        first = store(first, "first")
        new = self._write(first.where("not held").withColumn("delivery", F.lit(name)), [name])
        if new:
            self._publish(self._tiered([*entries, new]))
        return kept(df, key, text, _later(flat, first, key))

    def _tiered(self, entries: list[dict]) -> list[dict]:
        """The runs, the smallest ones merged if they are more than ``fan``.

        Runs join the merge, smallest first, while they are no more than twice what it has; so a
        window is rewritten about as often as the logarithm of the index's size.
        """
        if len(entries) <= self.fan:
            return entries
        by_size = sorted(entries, key=lambda r: r["rows"])
        some, size = by_size[:2], by_size[0]["rows"] + by_size[1]["rows"]
        for r in by_size[2:]:
            if r["rows"] > 2 * size:
                break
            some.append(r)
            size += r["rows"]
        chosen = {r["name"] for r in some}
        return [r for r in entries if r["name"] not in chosen] + [self._merged([r for r in entries if r["name"] in chosen])]

    def _merged(self, entries: list[dict]) -> dict:
        """One run of several; of a window in two of them the older run's row stays."""
        rows = None
        for place, r in enumerate(entries):
            part = self._read(r["name"]).withColumn("place", F.lit(place))
            rows = part if rows is None else rows.unionByName(part)
        once = rows.groupBy("anchor", "own").agg(F.min_by("delivery", "place").alias("delivery"))
        return self._write(once, [d for r in entries for d in r["deliveries"]])

    def compact(self) -> int:
        """Merge all runs into one if they are more than ``most``; the number of runs afterwards."""
        entries = self.manifest()["runs"]
        if len(entries) <= self.most:
            return len(entries)
        self._publish([self._merged(entries)])
        return 1
