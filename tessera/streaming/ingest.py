"""Incremental ingest: a file stream of entries upserted batch by batch, each batch once.

The stream reads new files only and stops when none is left (``availableNow``). A batch's id, its
stream's id and number, is in the ledger with the snapshot that holds it, so a batch that is delivered
again changes nothing. The stream's id comes from its checkpoint, so a new checkpoint is a new stream.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from tessera.operators import candidates, dedup
from tessera.plans.scenarios import ENTRY, Base
from tessera.providers import Model, Provider
from tessera.session import store


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a checkpoint for as long as it exists."""
    path = spark._jvm.org.apache.hadoop.fs.Path(checkpoint, "metadata")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def ingest(spark: SparkSession, base: Base, folder: str, checkpoint: str, provider: Provider | Model, run_date: str) -> int:
    """Entries from Parquet files in ``folder`` merged into the base; the number of batches merged now."""
    s, merged, model = base.settings, [], base.model(provider)

    def once(batch: DataFrame, number: int) -> None:
        name = f"batch-{stream_id(spark, checkpoint)}-{number}"
        if batch.isEmpty() or any(r["hash"] == name for r in base.ledger()):
            return
        new, entries = store(batch, "new"), base.entries()
        both = (base.embeddings(new, model), base.embeddings(entries, model)) if s.embeddings else None
        matches = candidates.candidate_matches(new, entries, both, params=s.params)
        rows, counts, cache = dedup.merge_into_base(entries, new, matches, base.known("match"), s.merge_strategy, list(s.categories), model, run_date, s.params)
        base.commit(store(rows, "merged"), {"file": name, "path": folder, "hash": name, "processed_at": run_date, **counts})
        base.remember(cache, "match")
        merged.append(number)

    stream = spark.readStream.schema(ENTRY).option("maxFilesPerTrigger", 100).parquet(folder)
    query = stream.writeStream.foreachBatch(once).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(merged)
