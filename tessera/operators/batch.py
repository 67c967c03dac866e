"""Resumable row processing: every row goes to a worker once, its outcome to a staging table.

A worker maps a row to an outcome; an exception in one row is an ``unhandled_error`` of that row.
Outcomes are appended chunk by chunk as Parquet, so a run that ends early loses one chunk at most.
Rows that a staging table covers are skipped, but for failures. Links are masked by expressions
before the rows reach a worker; each row's outcome carries the calls made for it.

Cases: null questions and answers are empty to a model; a reply without its shape is a failed call;
an empty table gives empty results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import links
from tessera.operators import state, validation
from tessera.params import DEFAULTS, Params
from tessera.providers import CALLS, Model, Provider, Retry
from tessera.session import attach
from tessera.sources import files

OUTCOME = (
    "row_number int, source_columns map<string,string>, question string, answer string, topic string, filtered boolean, failed array<string>, "
    "reply struct<category:string,question:string,answer:string,reason:string,complete:boolean>, blocked string, error boolean, private boolean, " + CALLS
)
FIELDS = ["row_number", "source_columns", "question", "answer", "topic", "filtered", "failed", "reply", "blocked", "error", "private", "calls"]
REPLY = ["category", "question", "answer", "reason", "complete"]
Worker = Callable[[Provider, Retry, dict, Params], dict]


def _nothing(filtered: bool) -> dict:
    return {"filtered": filtered, "failed": [], "topic": "", "reply": None, "private": False}


def _asked(method: str, provider: Provider, retry: Retry, row: dict, params: Params) -> dict | None:
    """A reply on the masked texts, its links put back."""
    masked = {"question": row["masked"][0], "answer": row["masked"][1]}
    return links.ask(lambda hint: retry.call(method, lambda: getattr(provider, method)(masked, hint)), row["links"], params.link_attempts)


def ticket(provider: Provider, retry: Retry, row: dict, params: Params) -> dict:
    """Gate, then rewrite what passes, links masked."""
    verdict = retry.call("filter", lambda: provider.filter({"question": row["question"], "answer": row["answer"]}))
    if verdict is None:
        return _nothing(False)
    out = _nothing(True) | {"topic": verdict["topic"], "private": not verdict["no_private_data"]}
    out["failed"] = [f for f in validation.GATING_FLAGS if not verdict[f]]
    if len(out["failed"]) <= params.max_doubtful_flags:
        out["reply"] = _asked("rewrite", provider, retry, row, params)
    return out


def repair(provider: Provider, retry: Retry, row: dict, params: Params) -> dict:
    """Repair what has an answer; without one no model is asked."""
    out = _nothing(True)
    if (row["answer"] or "").strip():
        out["reply"] = _asked("repair", provider, retry, row, params)
    return out


def outcomes(pairs: DataFrame, worker: Worker, model: Model | Provider, params: Params = DEFAULTS, retry: dict | None = None) -> DataFrame:
    """One outcome a row, by ``mapInPandas``; retries and pauses are each task's own."""
    attach(pairs.sparkSession)
    model = Model.of(model, retry)
    provider, settings = model.provider, model.retry

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        calls = Retry(**settings)
        for batch in batches:
            out = []
            for r in batch.to_dict("records"):
                row = r | {"masked": list(r["masked"]), "links": list(r["links"])}
                try:
                    got, error = worker(provider, calls, row, params), False
                except Exception:
                    got, error = _nothing(False), True
                made = calls.taken()
                reply = got["reply"] and {k: got["reply"].get(k) for k in REPLY}
                blocked = next((c["caller"] for c in made if c["result"] == "blacklist"), None)
                out.append({**{k: r[k] for k in FIELDS[:4]}, **got, "reply": reply, "blocked": blocked, "error": error, "calls": made})
            yield pd.DataFrame(out, columns=FIELDS)

    m = links.mask_links(F.col("question"), F.col("answer"))
    rows = pairs.select("row_number", "source_columns", "question", "answer", m.alias("m")).select("row_number", "source_columns", "question", "answer", F.col("m.texts").alias("masked"), "m.links")
    return model.bounded(rows).mapInPandas(run, OUTCOME)


def split(done: DataFrame, kind: str, source_file: str, run_date: str, categories: list[str], params: Params = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """Accepted entries and rejected rows from outcomes of ``ticket`` or ``repair``."""
    source = F.concat(F.col("question"), F.lit("\n"), F.col("answer"))
    reply = F.col("reply")
    if kind == "repair":
        reason, doubt = validation.repair_reason(F.col("answer"), reply, categories, source, params), F.lit(None).cast("string")
    else:
        gate = validation.gate(F.col("failed"), params)
        reason = (
            F.when(~F.col("filtered"), F.lit("filter_failed")).when(gate["reason"].isNotNull(), gate["reason"]).when(reply.isNull(), F.lit("transform_failed"))
            .otherwise(validation.validate(reply["category"], reply["question"], reply["answer"], source, categories, None, params))
        )
        doubt = gate["doubtful"]
    reason = F.when(F.col("error"), F.lit("unhandled_error")).otherwise(reason)
    rated = done.withColumns({"why": validation.final_reason(reason, F.col("blocked")), "doubtful": doubt})
    good = rated.where("why is null").select("row_number", "reply.category", F.col("reply.question").alias("question"), F.col("reply.answer").alias("answer"), "source_columns", "doubtful")
    bad = rated.where("why is not null").select(
        F.col("row_number").alias("source_row"), F.col("why").alias("reason"), "topic", "question", "answer",
        F.col("reply.question").alias("model_question"), F.col("reply.answer").alias("model_answer"),
    )
    return validation.new_entries(good, source_file, run_date), bad


def process_rows(pairs: DataFrame, kind: str, model: Model | Provider, staging: str, source_file: str, run_date: str, categories: list[str], params: Params = DEFAULTS, retry: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected of all rows, old and new; staging holds outcomes, ``chunk_rows`` at a time.

    A chunk is committed when all its rows are done, so an early end costs the calls of one chunk.
    """
    spark = attach(pairs.sparkSession)
    model = Model.of(model, retry)
    worker = {"ticket": ticket, "repair": repair}[kind]
    left, run = pairs, 1
    if files.exists(spark, staging):
        before = staged(spark, staging)
        left = state.unfinished(pairs, *split(latest(before), kind, source_file, run_date, categories, params))
        run = 1 + (before.agg(F.max("run")).first()[0] or 0)
    chunks = -(-left.count() // params.chunk_rows)
    for k in range(chunks):
        part = left.where(F.pmod(F.xxhash64("row_number"), F.lit(chunks)) == k)
        outcomes(part, worker, model, params).withColumn("run", F.lit(run)).write.mode("append").parquet(staging)
    if not files.exists(spark, staging):
        return split(spark.createDataFrame([], OUTCOME), kind, source_file, run_date, categories, params)
    done = staged(spark, staging)
    model.note(done.where(F.col("run") == run))
    return split(latest(done), kind, source_file, run_date, categories, params)


def staged(spark, staging: str) -> DataFrame:
    """All outcomes of a staging table, with the number of their run."""
    return spark.read.schema(OUTCOME + ", run int").parquet(staging)


def latest(done: DataFrame) -> DataFrame:
    """The last run's outcome of each row."""
    names = [c for c in done.columns if c != "run"]
    return done.groupBy("row_number").agg(F.max_by(F.struct(*[c for c in names if c != "row_number"]), "run").alias("o")).select("row_number", "o.*").select(*names)
