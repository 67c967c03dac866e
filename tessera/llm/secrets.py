"""Secret scans with corpus-wide ownership frequency, in DataFrame expressions only.

Base kinds are found by pattern: assignments to password-like names, access keys and long runs of
hexadecimal digits. A fourth kind of candidate is any run of 20 or more key characters that holds
both a digit and a letter and overlaps no base match. Every candidate's value is hashed, and the
hashes are aggregated over the corpus by distinct repositories and distinct owners. One rule
(:func:`copied`) tells a widely copied example from a live-looking credential: ``WIDE_OWNERS`` owners
or ``WIDE_REPOSITORIES`` repositories hold it. Base matches are always reported; of the fourth kind
those become spans (kind ``owned``) that one owner only holds and that are not widely copied.

Positions come from the gaps between matches: a text's matches of a pattern and the pieces that the
same pattern splits it into alternate, so running sums of their lengths are the offsets, in code
points. The scan reads each text once; what follows works on a narrow table of candidates in the
shared folder, keyed by a row number that the table itself stores. Only values that several
repositories hold have a row in the table of frequencies, so a value of one document joins nothing,
and values that very many rows hold meet their frequency by broadcast.

Cases: null and empty texts have no matches and empty digests (the hash of an empty string); a null
repository or owner counts as one of its own; rows that repeat count once as an owner, and each
gets its own result; ties of start are ordered by kind; an empty table gives an empty result;
columns beyond those named are not read, whatever their names. Very long texts are scanned whole;
the work grows with their length and their number of matches, in blocks of matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import cuts
from tessera.llm.simhash import spread
from tessera.session import attach, store

KINDS = ("assign", "access", "hex", "owned")
#: A base match fails if its value is shorter.
SHORTEST = {"assign": 12, "access": 18, "hex": 16}

#: Owners or repositories of a value that make it a widely copied example.
WIDE_OWNERS, WIDE_REPOSITORIES = 5, 50

#: The patterns of the base kinds.
PATTERNS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]+",
}
ASSIGNED = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
LONG_RUN = "[A-Za-z0-9+/_=-]{20,}"
#: Cheap tests, true for every text with a match of the kind.
TESTS = {
    "assign": "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]",
    "access": "AKIA[A-Z0-9]{14}",
    "hex": "[0-9a-f]{16}",
    "owned": "[A-Za-z0-9+/_=-]{20}",
}

SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def _matches(text: Column, kind: int, pattern: str, value, least: int) -> Column:
    """Spans of a pattern's matches whose value is long enough, with offsets in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def spans(v: Column) -> Column:
        ahead = F.zip_with(v["gaps"], v["found"], lambda g, m: F.length(g) + F.coalesce(F.length(m), F.lit(0)))
        starts = F.zip_with(cuts.offsets(ahead), v["gaps"], lambda at, g: at + F.length(g))  # one more than matches
        every = F.zip_with(v["found"], F.slice(starts, F.lit(1), F.size(v["found"])), lambda m, at: F.struct(at.alias("start"), F.lit(kind).alias("kind"), (at + F.length(m)).alias("end"), value(m).alias("value")))
        return F.filter(every, lambda s: F.length(s["value"]) >= least)

    return cuts.let(F.struct(found.alias("found"), gaps.alias("gaps")), spans)


def _empty() -> Column:
    return F.from_json(F.lit("[]"), SPAN)


def candidates(text: Column) -> dict[str, Column]:
    """Spans of each kind in a text; a cheap test keeps texts without a match from being cut up."""
    t = F.coalesce(text, F.lit(""))
    # shorter runs always fail, and never hold a longer one: the minimum can be part of the pattern
    patterns = PATTERNS | {"access": "AKIA[A-Z0-9]{14,}", "hex": "[0-9a-f]{16,}"}
    assigned = lambda m: F.regexp_replace(m, ASSIGNED, "")
    out = {}
    for k, kind in enumerate(KINDS[:3]):
        value = assigned if kind == "assign" else (lambda m: m)
        out[kind] = F.when(t.rlike(TESTS[kind]), _matches(t, k, patterns[kind], value, SHORTEST[kind])).otherwise(_empty())
    long = F.when(t.rlike(TESTS["owned"]), _matches(t, 3, LONG_RUN, lambda m: m, 20)).otherwise(_empty())
    out["owned"] = F.filter(long, lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]"))
    return out


def _joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", repository: str = "doc_id", owner: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row for each row: key, base, owned (spans with their values' hash, repositories and owners).

    ``base`` and ``owned`` are arrays of structs (start, kind, end, hash, repositories, owners);
    ``owned`` holds only values of one owner that overlap no base match.
    """
    attach(df.sparkSession)
    found = candidates(F.col(text))
    flat = df.select(F.col(key).alias("k"), F.col(repository).alias("repository"), F.col(owner).alias("owner"), *carry, *(c.alias(f"c_{n}") for n, c in found.items()))
    base = F.concat(*(F.col(f"c_{n}") for n in KINDS[:3]))
    flat = flat.withColumn("base", base)
    free = F.filter("c_owned", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    spans = F.transform(F.concat("base", free), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.sha2(s["value"], 256).alias("hash")))
    # no text from here on; the row number is stored with the rows
    narrow = store(flat.select(F.monotonically_increasing_id().alias("row"), "k", "repository", "owner", *carry, spans.alias("spans")), "secrets")
    each = narrow.where(F.size("spans") > 0).select("row", F.coalesce(F.col("repository").cast("string"), F.lit("\0")).alias("repository"), F.coalesce(F.col("owner").cast("string"), F.lit("\0")).alias("owner"), F.explode("spans").alias("s"))
    each = each.select("*", F.col("s.hash").alias("hash"))
    by_place = each.groupBy("hash", "owner", "repository").agg(F.count("*").alias("rows"))
    by_owner = by_place.groupBy("hash", "owner").agg(F.count("*").alias("repositories"), F.sum("rows").alias("rows"))
    frequency = by_owner.groupBy("hash").agg(F.sum("repositories").alias("repositories"), F.count("*").alias("owners"), F.sum("rows").alias("rows"))
    rated = spread(each.select("row", "s", "hash"), frequency, "hash")
    span = F.struct("s.start", "s.kind", "s.end", "hash", "repositories", "owners")
    rows = rated.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("rated"))
    out = narrow.join(rows, "row", "left").withColumn("rated", F.coalesce("rated", F.from_json(F.lit("[]"), rows.schema["rated"].dataType)))
    return out.select(
        F.col("k").alias(key), *carry,
        F.filter("rated", lambda s: s["kind"] < 3).alias("base"),
        F.filter("rated", lambda s: (s["kind"] == 3) & (s["owners"] == 1) & ~copied(s)).alias("owned"),
    )


def copied(span: Column) -> Column:
    """Whether a rated span's value is a widely copied example."""
    return (span["owners"] >= WIDE_OWNERS) | (span["repositories"] >= WIDE_REPOSITORIES)


def report(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_assign, n_access, n_hex, base_sha256, spans, n_owned, n_live, n_copied).

    ``n_copied`` counts base matches whose value is widely copied, ``n_live`` the others.
    """
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return scanned.select(
        key, count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "owned")).alias("spans"),
        F.size("owned").cast("long").alias("n_owned"),
        F.size(F.filter("base", lambda s: ~copied(s))).cast("long").alias("n_live"),
        F.size(F.filter("base", copied)).cast("long").alias("n_copied"),
    )


def masked(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with spans (they may overlap) replaced by ``mask``, one for each stretch that they cover."""

    def apart(sorted_spans: Column) -> Column:
        """Spans that start behind all earlier ones, as (start, end) with the end of their stretch."""
        zero = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

        def step(acc: Column, s: Column) -> Column:
            end = F.greatest(acc["end"], s["end"])
            n = F.size(acc["out"])
            last = F.element_at(acc["out"], -1)
            alone = F.concat(acc["out"], F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))
            longer = F.concat(F.slice(acc["out"], F.lit(1), n - 1), F.array(F.struct(last["start"].alias("start"), end.alias("end"))))
            return F.struct(end.alias("end"), F.when((n == 0) | (s["start"] >= acc["end"]), alone).otherwise(longer).alias("out"))

        return F.aggregate(sorted_spans, zero, step, lambda acc: acc["out"])

    def whole(v: Column) -> Column:
        # text before a stretch and the stretch itself, by turns, then the rest
        before = F.transform(v["c"], lambda s, i: F.array(s["start"] - F.when(i == 0, 0).otherwise(F.element_at(v["c"], F.greatest(i, F.lit(1)))["end"]), s["end"] - s["start"]))
        rest = F.length(v["t"]) - F.coalesce(F.try_element_at(v["c"], F.lit(-1))["end"], F.lit(0))
        parts = cuts.pieces(v["t"], F.concat(F.flatten(before), F.array(rest)))
        return F.array_join(F.transform(parts, lambda p, i: F.when(i % 2 == 1, F.lit(mask)).otherwise(p)), "")

    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    return cuts.let(F.struct(text.alias("t"), cuts.let(ordered, apart).alias("c")), whole)
