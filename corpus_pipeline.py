"""The corpus pipeline: toxic documents go, near-duplicates go, secrets are masked, sources are mixed, texts encoded.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of
documents, whatever else their input has. Every stage reads only the documents that its predecessor
kept. Rows are known by their id and a hash of their text, so ids that repeat do no harm.

Cases: null and empty texts are never toxic, are near copies of each other (one of them stays), hold
no secrets, and have no words, so the mix takes none of them. Null ids, languages and sources are
values like others. Ties: of near copies the row of the smallest id, then text hash, stays; rows that
are equal in both are one row from the second stage on. Very long texts are processed whole. An empty
table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, mixing, nearcopies, secrets, toxicity
from tessera.session import attach, forget, store, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
WORD = r"[^\x20\x09-\x0D]+"

#: No SQL: the first stage is a trained network.
ORACLE_SQL = None


def _row() -> F.Column:
    return F.struct("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; a text without words scores as the network does on none."""
    labels = table(attach(spark), sf_dir, "labels")
    net, prior = toxicity.fit(docs, labels, F.lit(True))
    scored = toxicity.score(docs, net, carry=tuple(COLUMNS[1:]), prior=prior)
    return scored.where(F.col("score") < 0.5).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (5-word Jaccard of 0.8 at least): the one with the smallest id.

    SimHash links that are verified come first, an exact filter finds what fingerprints miss.
    """
    keyed = docs.select(*COLUMNS, _row().alias("row"))
    found = nearcopies.near_copies(keyed, "row", "text")
    first = found.select("component_id").distinct()
    kept = keyed.join(first, keyed["row"].eqNullSafe(first["component_id"]), "left_semi")
    return kept.dropDuplicates(["row"]).select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked, but for widely copied examples; every document stays.

    Texts that hold no candidate do not move. A document is its own repository, its source the owner.
    """
    held = F.lit(False)
    for test in secrets.TESTS.values():
        held = held | F.coalesce(F.col("text"), F.lit("")).rlike(test)
    flagged = docs.select(*COLUMNS, _row().alias("row"), held.alias("held"))
    some = flagged.where("held")
    scanned = secrets.scan(some, "row", "text", "row", "source")
    live = F.filter("base", lambda s: ~secrets.copied(s))
    spans = scanned.select("row", F.concat(live, "owned").alias("spans")).where(F.size("spans") > 0).dropDuplicates(["row"])
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(secrets.masked(F.col("text"), F.col("spans")))
    changed = some.join(spans.withColumnRenamed("row", "r"), F.col("row").eqNullSafe(F.col("r")), "left").withColumn("text", text)
    changed = changed.withColumn("n_chars", F.when(F.col("spans").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return flagged.where("not held").select(*COLUMNS).unionByName(changed.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; one at a source's border gives its leading words as they stand."""
    labels = table(attach(spark), sf_dir, "labels")
    rows = mixing.sized(docs.select("doc_id", "text", "source", _row()["h"].alias("h")), labels, carry=("h",))
    taken = mixing.mix(rows, carry=("h",)).where("taken > 0")
    taken = taken.groupBy(F.struct("doc_id", "h").alias("r")).agg(F.sum("taken").alias("taken"), F.max("size").alias("size"))
    keyed = docs.select(*COLUMNS, _row().alias("row")).dropDuplicates(["row"])
    copies = F.floor(F.col("taken") / F.col("size")).cast("int")
    rest = (F.col("taken") % F.col("size")).cast("int")
    parts = F.concat(F.array_repeat(F.lit(0), copies), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")))
    dealt = keyed.join(taken, F.col("row").eqNullSafe(F.col("r"))).withColumn("words", F.explode(parts))
    long = lambda parts: F.aggregate(F.slice(parts, F.lit(1), F.col("words")), F.lit(0), lambda a, x: a + F.length(x))
    end = long(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))) + long(F.split("text", WORD, -1))
    dealt = dealt.withColumn("text", F.when(F.col("words") == 0, F.col("text")).otherwise(F.substring(F.col("text"), F.lit(1), end)))
    return dealt.withColumn("n_chars", F.when(F.col("words") == 0, F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text: doc_id, source, ids, n_tokens."""
    attach(spark)
    encoded = bpe.encode(docs, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"), carry=("source",))
    return encoded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = table(attach(spark), sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        kept = store(stage(spark, docs, sf_dir), "pipeline")
        if k:
            forget(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
