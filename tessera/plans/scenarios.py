"""The scenarios a user runs: tickets to base, merging a base, repairing one, cleaning one.

State lives in one folder a base, on a file system that driver and executors share (the session's
default one unless the path has a scheme): snapshots of the entries (Parquet, one folder each, never
changed), verdict and embedding caches, call records, staging by file. A state file names the current
snapshot and holds the ledger of processed files by content hash; each commit writes the next state
file, complete and under a new number, so a crash leaves the state before or after, and of two
writers one fails.
"""

from __future__ import annotations

import hashlib
import json
import re
import tomllib
import uuid
from dataclasses import dataclass, field
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators import batch, candidates, dedup, state, validation
from tessera.params import DEFAULTS, Params
from tessera.providers import Model, Provider
from tessera.session import store
from tessera.sources import files, sheet

ENTRY = "ord long, category string, question string, answer string, source_file string, source_rows array<int>, source_columns map<string,string>, updated_at string, doubtful string"
LEDGER = ["file", "path", "hash", "processed_at", "updated", "added"]


@dataclass(frozen=True)
class Settings:
    """A scenario's settings; unknown keys and bad values are errors."""

    name: str
    output_dir: str
    categories: dict[str, str]
    source: str | None = None
    question_columns: tuple[str, ...] = ()
    answer_columns: tuple[str, ...] = ()
    extra_columns: tuple[str, ...] = ()
    merge_strategy: str = "accumulate"
    embeddings: bool = False
    force: bool = False
    at_once: int | None = None
    params: Params = field(default_factory=lambda: DEFAULTS)

    def __post_init__(self):
        if not re.fullmatch(r"[\w-]+", self.name):
            raise ValueError("a name of letters, digits, _ and -")
        if not self.categories:
            raise ValueError("at least one category")
        if self.merge_strategy not in ("accumulate", "replace"):
            raise ValueError("accumulate or replace")
        if self.source is not None and PurePosixPath(self.source).suffix not in (".xlsx", ".xlsm"):
            raise ValueError("a workbook (.xlsx or .xlsm)")


def load_settings(path: str) -> Settings:
    """Settings from a TOML file."""
    with open(path, "rb") as f:
        raw = tomllib.load(f)
    known = set(Settings.__dataclass_fields__) - {"params"}
    if extra := set(raw) - known:
        raise ValueError(f"unknown settings: {', '.join(sorted(extra))}")
    for k in ("question_columns", "answer_columns", "extra_columns"):
        if k in raw:
            raw[k] = tuple(raw[k])
    return Settings(**raw)


def file_hash(spark: SparkSession, path: str) -> str:
    return hashlib.sha256(files.read(spark, path)).hexdigest()


def latest_view(folder: str, name: str, spark: SparkSession | None = None) -> str | None:
    """The newest dated workbook of a base."""
    pattern = re.compile(re.escape(name) + r"_(\d{4}-\d{2}-\d{2})\.xlsx")
    there = files.listed(spark or SparkSession.getActiveSession(), folder)
    found = [(m[1], f"{folder}/{f.name}") for f in there if (m := pattern.fullmatch(f.name))]
    return max(found)[1] if found else None


class Base:
    """A living base in a folder."""

    def __init__(self, spark: SparkSession, settings: Settings):
        self.spark, self.settings = spark, settings
        self.root = f"{settings.output_dir.rstrip('/')}/{settings.name}"

    def model(self, provider: Provider | Model, retry: dict | None = None) -> Model:
        """The provider with this base's bound on calls at once and its table of call records."""
        m = Model.of(provider, retry)
        return Model(m.provider, m.retry, m.at_once or self.settings.at_once, m.notes or f"{self.root}/calls")

    def calls(self) -> DataFrame:
        """Calls made for this base: caller, seconds, result."""
        schema = "caller string, seconds double, result string"
        return self._stored("calls", schema)

    def _stored(self, name: str, schema: str) -> DataFrame:
        """A table of the folder, empty if it is not there yet."""
        path = f"{self.root}/{name}"
        return self.spark.read.schema(schema).parquet(path) if files.exists(self.spark, path) else self.spark.createDataFrame([], schema)

    def _states(self) -> list[files.Found]:
        return [f for f in files.listed(self.spark, self.root) if re.fullmatch(r"state-\d{8}\.json", f.name)]

    def _state(self) -> dict:
        there = self._states()
        return json.loads(files.read(self.spark, there[-1].path)) if there else {"snapshot": None, "ledger": []}

    def entries(self) -> DataFrame:
        at = self._state()["snapshot"]
        return self._stored(at, ENTRY) if at else self.spark.createDataFrame([], ENTRY)

    def ledger(self) -> list[dict]:
        return self._state()["ledger"]

    def commit(self, entries: DataFrame, record: dict | None = None) -> None:
        """A new snapshot, and the ledger with a record in place of its hash's; both or neither."""
        now, number = self._state(), len(self._states()) + 1
        name = f"base-{uuid.uuid4().hex}"
        entries.select(*[c.split(" ")[0] for c in ENTRY.split(", ")]).write.parquet(f"{self.root}/{name}")
        ledger = [r for r in now["ledger"] if record is None or r["hash"] != record["hash"]] + ([record] if record else [])
        data = json.dumps({"snapshot": name, "ledger": ledger}, ensure_ascii=False, indent=1).encode()
        files.write(self.spark, f"{self.root}/state-{number:08d}.json", data, replace=False)

    def cache(self, question: str = "judge") -> DataFrame:
        """Verdicts on one question: ``judge`` within a table, ``match`` against the base."""
        return self._stored(f"verdicts-{question}", dedup.CACHE)

    def known(self, question: str = "judge") -> DataFrame:
        """The verdicts that a run may use: none if it is forced."""
        return self.cache(question).limit(0) if self.settings.force else self.cache(question)

    def remember(self, cache: DataFrame, question: str = "judge") -> None:
        """Append the verdicts that are new."""
        new = store(cache.dropDuplicates(["h_lo", "h_hi"]).join(self.cache(question), ["h_lo", "h_hi"], "left_anti"), "verdicts")
        new.write.mode("append").parquet(f"{self.root}/verdicts-{question}")

    def embeddings(self, entries: DataFrame, provider: Provider | Model) -> DataFrame | None:
        """(ord, embedding) of questions; only hashes that the cache lacks are embedded, and kept when all are."""
        if not self.settings.embeddings:
            return None
        model, size = Model.of(provider), self.settings.params.embedding_batch
        rows = entries.select("ord", "question", X.content_hash(F.col("question")).alias("hash"))
        schema, embed = "hash string, embedding array<float>", model.provider.embed
        new = rows.dropDuplicates(["hash"]).join(self._stored("embeddings", schema), "hash", "left_anti").select("hash", "question")

        def run(batches):
            for b in batches:
                for k in range(0, len(b), size):
                    part = b.iloc[k : k + size]
                    yield part[["hash"]].assign(embedding=embed(part["question"].tolist()))

        store(model.bounded(new).mapInPandas(run, schema), "embeddings").write.mode("append").parquet(f"{self.root}/embeddings")
        return rows.join(self._stored("embeddings", schema).dropDuplicates(["hash"]), "hash").select("ord", "embedding")

    def sync(self) -> DataFrame:
        """The entries, or the reviewer's view if it is newer and differs; deleted rows stay deleted."""
        entries, view, states = self.entries(), latest_view(self.root, self.settings.name, self.spark), self._states()
        if view is None or (states and files.modified(self.spark, view) < states[-1].modified):
            return entries
        edited = store(sheet.read_base(sheet.read_sheet(self.spark, view)), "view")
        if not state.same_base(entries, edited):
            self.commit(edited)
            return self.entries()
        return entries

    def export(self, run_date: str) -> str | None:
        entries = self.entries()
        if entries.isEmpty():
            return None
        path = f"{self.root}/{self.settings.name}_{run_date}.xlsx"
        sheet.write_view(sheet.base_view(entries), path)
        return path


def _staging(base: Base, kind: str, h: str) -> str:
    """Where a file's outcomes are; a forced run starts a table of its own."""
    stem = PurePosixPath(base.settings.source).stem
    return f"{base.root}/{kind}/{stem}-{h[:8]}" + (f"-forced-{uuid.uuid4().hex[:8]}" if base.settings.force else "")


def tickets_to_base(spark: SparkSession, settings: Settings, provider: Provider | Model, run_date: str, retry: dict | None = None) -> dict[str, int]:
    """Scan, gate, rewrite, collapse, upsert, commit, export; a file of a known hash only retries failures."""
    base = Base(spark, settings)
    s, names, model = settings, list(settings.categories), base.model(provider, retry)
    entries = base.sync()
    h, source_file = file_hash(spark, s.source), PurePosixPath(s.source).name
    record = next((r for r in base.ledger() if r["hash"] == h), None)
    staging = _staging(base, "staging", h)
    rows = sheet.pairs(sheet.read_sheet(spark, s.source), list(s.question_columns), list(s.answer_columns), list(s.extra_columns), s.params).where("question <> '' and answer <> ''")
    before = None
    if record and not s.force:
        before, rejected = batch.split(batch.latest(batch.staged(spark, staging)), "ticket", source_file, run_date, names, s.params)
        if state.failed_rows(rejected).isEmpty():
            base.export(run_date)
            return {"updated": 0, "added": 0}
        before = store(before.select(F.explode("source_rows").alias("row")), "merged")
    accepted, rejected = batch.process_rows(rows, "ticket", model, staging, source_file, run_date, names, s.params)
    new = accepted.withColumn("ord", F.col("source_rows")[0].cast("long"))
    if before is not None:
        new = state.not_merged(new, before)
    new = store(new, "new")
    if new.isEmpty():
        base.export(run_date)
        return {"updated": 0, "added": 0}
    pairs = candidates.candidate_pairs(new, base.embeddings(new, model), params=s.params)
    new, cache = dedup.collapse_duplicates(new, pairs, base.known(), names, model, run_date, s.params)
    new = store(new, "collapsed")
    base.remember(cache)
    counts = _upsert(base, entries, new, model, run_date, {"file": source_file, "path": s.source, "hash": h}, record)
    base.export(run_date)
    return counts


def _upsert(base: Base, entries: DataFrame, new: DataFrame, model: Model, run_date: str, record: dict, earlier: dict | None) -> dict[str, int]:
    s = base.settings
    both = (base.embeddings(new, model), base.embeddings(entries, model)) if s.embeddings else None
    matches = candidates.candidate_matches(new, entries, both, params=s.params)
    merged, counts, cache = dedup.merge_into_base(entries, new, matches, base.known("match"), s.merge_strategy, list(s.categories), model, run_date, s.params)
    earlier = earlier or {"updated": 0, "added": 0}
    base.commit(store(merged, "merged"), record | {"processed_at": run_date, "updated": counts["updated"] + earlier["updated"], "added": counts["added"] + earlier["added"]})
    base.remember(cache, "match")
    return counts


def merge_base(spark: SparkSession, settings: Settings, provider: Provider | Model, run_date: str, retry: dict | None = None) -> dict[str, int]:
    """A reviewer's base merged into the living one, as it is; foreign categories become doubtful."""
    base = Base(spark, settings)
    entries = base.sync()
    h = file_hash(spark, settings.source)
    if any(r["hash"] == h for r in base.ledger()) and not settings.force:
        base.export(run_date)
        return {"updated": 0, "added": 0}
    new = store(validation.mark_foreign(sheet.read_base(sheet.read_sheet(spark, settings.source)), list(settings.categories)), "new")
    record = {"file": PurePosixPath(settings.source).name, "path": settings.source, "hash": h}
    counts = _upsert(base, entries, new, base.model(provider, retry), run_date, record, None)
    base.export(run_date)
    return counts


def repair_base(spark: SparkSession, settings: Settings, provider: Provider | Model, run_date: str, retry: dict | None = None) -> tuple[str, str]:
    """A sheet repaired row by row and collapsed, as two workbooks: repaired and rejected."""
    s, names = settings, list(settings.categories)
    base = Base(spark, s)
    model = base.model(provider, retry)
    rows = sheet.pairs(sheet.read_sheet(spark, s.source), list(s.question_columns), list(s.answer_columns), list(s.extra_columns), s.params)
    staging = _staging(base, "repairs/staging", file_hash(spark, s.source))
    accepted, rejected = batch.process_rows(rows, "repair", model, staging, PurePosixPath(s.source).name, run_date, names, s.params)
    new = store(accepted.withColumn("ord", F.col("source_rows")[0].cast("long")), "new")
    pairs = candidates.candidate_pairs(new, base.embeddings(new, model), params=s.params)
    entries, cache = dedup.collapse_duplicates(new, pairs, base.known(), names, model, run_date, s.params)
    good, bad = (f"{base.root}/repairs/{s.name}_{run_date}{x}.xlsx" for x in ("", "_rejected"))
    sheet.write_view(sheet.base_view(store(entries, "repaired")), good)
    base.remember(cache)
    sheet.write_view(sheet.rejected_view(rejected), bad, None)
    return good, bad


def dedupe_base(spark: SparkSession, settings: Settings, provider: Provider | Model, run_date: str, retry: dict | None = None) -> int:
    """The living base collapsed; the number of entries that went."""
    base = Base(spark, settings)
    entries, model = base.sync(), base.model(provider, retry)
    before = entries.count()
    pairs = candidates.base_candidates(entries, base.embeddings(entries, model), params=settings.params)
    kept, cache = dedup.collapse_duplicates(entries, pairs, base.known(), list(settings.categories), model, run_date, settings.params)
    base.commit(store(kept, "deduped"))
    base.remember(cache)
    base.export(run_date)
    return before - base.entries().count()
