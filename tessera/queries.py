"""The queries of the knowledge-base operators and their SQL.

Each takes (spark, sf_dir) and gives a DataFrame; the tables stand in for the engine's own (see
FIXTURES.md): conversations for questions and answers, documents for entries, labels for gate flags,
events for call records, pages for links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import links
from tessera.functions import text as X
from tessera.operators import candidates, dedup, grouping, provenance, similarity, state, validation
from tessera.params import DEFAULTS
from tessera.providers import Blocked, Rules
from tessera.session import attach, store, table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its name, with its SQL if there is one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns with an id of their own."""
    t = table(attach(spark), sf_dir, "conversations")
    return t.withColumn("ord", F.col("conv_id") * 1000 + F.col("turn"))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries: a user turn and the assistant turn behind it."""
    t = table(attach(spark), sf_dir, "conversations")
    u = t.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    a = t.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    e = u.join(a, ["conv_id", "turn"])
    return e.select((F.col("conv_id") * 1000 + F.col("turn")).alias("ord"), "question", "answer", F.concat(F.lit("c"), F.col("turn") % 3).alias("category"), "conv_id", "turn")


# SQL pieces that several queries share
_NORM = r"trim(regexp_replace(regexp_replace(replace(lower({0}), 'ё', 'е'), '[^а-яёa-z0-9 ]+', ' ', 'g'), '\s+', ' ', 'g'))"
_GRAMS = "CASE WHEN length({0}) = 0 THEN [] WHEN length({0}) <= 3 THEN [{0}] ELSE list_distinct(list_transform(range(1, length({0}) - 1), lambda i: substr({0}, i, 3))) END"
_ORD = "conv_id * 1000 + turn"
_PAIRS = """e AS (
  SELECT u.conv_id * 1000 + u.turn AS ord, u.text AS question, a.text AS answer, 'c' || (u.turn % 3) AS category, u.conv_id, u.turn
  FROM conversations u JOIN conversations a ON u.conv_id = a.conv_id AND a.turn - 1 = u.turn
  WHERE u.role = 'user' AND a.role = 'assistant'
)"""


def _grams_of(source: str, id: str, text: str, cat: str, name: str) -> str:
    return f"""{name} AS (
  SELECT id, cat, {_GRAMS.format('n')} AS gs FROM (SELECT {id} AS id, {cat} AS cat, {_NORM.format(f"coalesce({text}, '')")} AS n FROM {source})
)"""


def _self_join(source: str, id: str, text: str, cat: str, same: float, cross: float, pre: str = "") -> str:
    return f"""
WITH {pre} {_grams_of(source, id, text, cat, 't')}, x AS (SELECT id, unnest(gs) AS g FROM t),
s AS (SELECT a.id AS i, b.id AS j, count(*) AS shared FROM x a JOIN x b ON a.g = b.g AND a.id < b.id GROUP BY 1, 2),
r AS (SELECT i, j, shared / (len(p.gs) + len(q.gs) - shared) AS similarity, p.cat IS NOT DISTINCT FROM q.cat AS same
  FROM s JOIN t p ON p.id = i JOIN t q ON q.id = j)
SELECT i, j, similarity FROM r WHERE similarity >= CASE WHEN same THEN {same} ELSE {cross} END
"""


@query(rf"""
SELECT doc_id, sha256({_NORM.format('text')}) AS normal_sha256, len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))::INT AS n_words
FROM documents
""")
def text_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised text and words of every document."""
    d = table(attach(spark), sf_dir, "documents")
    t = F.col("text")
    return d.select("doc_id", F.sha2(X.normalize(t), 256).alias("normal_sha256"), X.word_count(t).alias("n_words"))


@query(f"WITH {_grams_of('conversations', _ORD, 'text', 'NULL', 't')} SELECT id AS ord, len(gs)::INT AS n_trigrams FROM t")
def trigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct trigrams of every turn."""
    return _turns(spark, sf_dir).select("ord", F.size(X.trigrams(F.coalesce("text", F.lit("")))).alias("n_trigrams"))


@query(_self_join("conversations", _ORD, "text", "NULL", 0.32, 0.32))
def trigram_self_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similar turns."""
    return similarity.trigram_pairs(_turns(spark, sf_dir), "ord", "text", 0.32)


@query(_self_join("conversations", _ORD, "text", "role", 0.32, 0.55))
def trigram_self_join_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similar turns, with a higher threshold between roles."""
    return similarity.trigram_pairs(_turns(spark, sf_dir), "ord", "text", 0.32, 0.55, "role")


@query(rf"""
WITH {_grams_of("(SELECT conv_id * 1000 + turn AS i, text, role FROM conversations WHERE conv_id % 2 = 0)", "i", "text", "role", "n")},
{_grams_of("(SELECT conv_id * 1000 + turn AS i, text, role FROM conversations WHERE conv_id % 2 = 1)", "i", "text", "role", "b")},
x AS (SELECT id, unnest(gs) AS g FROM n), y AS (SELECT id, unnest(gs) AS g FROM b),
s AS (SELECT x.id AS new_id, y.id AS base_id, count(*) AS shared FROM x JOIN y ON x.g = y.g GROUP BY 1, 2),
r AS (SELECT new_id, base_id, shared / (len(p.gs) + len(q.gs) - shared) AS similarity, p.cat = q.cat AS same
  FROM s JOIN n p ON p.id = new_id JOIN b q ON q.id = base_id)
SELECT new_id, base_id, similarity FROM r WHERE similarity >= CASE WHEN same THEN 0.28 ELSE 0.50 END
""")
def trigram_cross_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of even conversations like turns of odd ones: a new table against a base."""
    t = _turns(spark, sf_dir)
    return similarity.trigram_matches(t.where("conv_id % 2 = 0"), t.where("conv_id % 2 = 1"), "ord", "text", 0.28, 0.50, "role")


_COSINE = "CASE WHEN list_dot_product(a.e, a.e) = 0 OR list_dot_product(b.e, b.e) = 0 THEN 0 ELSE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e)) / sqrt(list_dot_product(b.e, b.e)) END"


@query(rf"""
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
s AS (SELECT a.vec_id AS i, b.vec_id AS j, {_COSINE} AS c FROM v a JOIN v b ON a.vec_id <> b.vec_id),
k AS (SELECT i, j FROM s WHERE c >= 0.30 QUALIFY row_number() OVER (PARTITION BY i ORDER BY c DESC, j) <= 8)
SELECT DISTINCT least(i, j) AS i, greatest(i, j) AS j FROM k
""")
def neighbour_self_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of vectors of which one is among the other's eight nearest."""
    v = table(attach(spark), sf_dir, "embeddings")
    return similarity.neighbour_pairs(v, "vec_id", "embedding", 8, 0.30).select("i", "j")


@query(rf"""
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
s AS (SELECT a.vec_id AS new_id, b.vec_id AS base_id, {_COSINE} AS c FROM v a JOIN v b ON a.vec_id % 2 = 0 AND b.vec_id % 2 = 1)
SELECT new_id, base_id FROM s WHERE c >= 0.30 QUALIFY row_number() OVER (PARTITION BY new_id ORDER BY c DESC, base_id) <= 8
""")
def neighbour_cross_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For vectors of even id the eight nearest of odd id."""
    v = table(attach(spark), sf_dir, "embeddings")
    return similarity.neighbour_matches(v.where("vec_id % 2 = 0"), v.where("vec_id % 2 = 1"), "vec_id", "embedding", 8, 0.30).select("new_id", "base_id")


def _flagged(where: str, text: str, cat: str, same: float, cross: float) -> str:
    return _self_join("e", "ord", text, cat, same, cross).strip().replace("WITH  ", f"WITH {_PAIRS}, ", 1)


@query(rf"""
WITH q AS ({_flagged('', 'question', 'category', 0.32, 0.55)}), a AS ({_flagged('', 'answer', 'NULL', 0.78, 0.78)}),
u AS (SELECT i, j, true AS by_question, false AS by_answer FROM q UNION ALL SELECT i, j, false, true FROM a)
SELECT i, j, bool_or(by_question) AS by_question, bool_or(by_answer) AS by_answer, false AS by_embedding FROM u GROUP BY i, j
""")
def candidate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates among question-answer pairs, with the signals that found them."""
    return candidates.candidate_pairs(_pairs(spark, sf_dir))


@query(rf"""
WITH q AS ({_flagged('', 'question', 'NULL', 0.2, 0.2)})
SELECT i, j, true AS by_question, false AS by_answer, false AS by_embedding FROM q
""")
def base_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates for cleaning a base without embeddings: questions only, whatever the category."""
    return candidates.base_candidates(_pairs(spark, sf_dir))


@query(r"""
WITH s AS (SELECT page_id, 'see ' || url || '. Also ' || url || ', or http://x.test/' || page_id || '!' AS t FROM pages)
SELECT page_id, list_transform(regexp_extract_all(t, 'https?://[^\s«»"<>]+'), lambda l: regexp_replace(l, '[.,;:!?)]+$', '')) AS links FROM s
""")
def link_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of composed sentences, without the punctuation behind them."""
    p = table(attach(spark), sf_dir, "pages")
    t = F.concat(F.lit("see "), "url", F.lit(". Also "), "url", F.lit(", or http://x.test/"), F.col("page_id").cast("string"), F.lit("!"))
    return p.select("page_id", X.find_links(t).alias("links"))


@query(r"""
SELECT p.page_id, list_filter([p.url, coalesce(o.url, 'http://none.test/')], lambda l: NOT contains(p.url || ' x', l)) AS invented
FROM pages p LEFT JOIN pages o ON o.page_id = p.page_id + 1
""")
def invented_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of an answer (this page and the next) that its source (this page) does not hold."""
    p = table(attach(spark), sf_dir, "pages")
    o = p.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("other"))
    answer = F.concat("url", F.lit(" "), F.coalesce("other", F.lit("http://none.test/")))
    return p.join(o, "page_id", "left").select("page_id", X.invented_links(answer, F.concat("url", F.lit(" x"))).alias("invented"))


_DIGITS = "list_distinct(list_transform(regexp_extract_all({}, '[0-9]+'), lambda n: regexp_replace(n, '^0+([0-9])', '\\1')))"


@query(rf"""
WITH s AS (SELECT a.doc_id, coalesce(a.text, '') AS answer, coalesce(b.text, '') AS source FROM documents a LEFT JOIN documents b ON b.doc_id = a.doc_id + 1),
k AS (SELECT doc_id, regexp_extract_all(regexp_replace(answer, '(^|\n)[0-9]{{1,2}}[.)]\s+', '\1', 'g'), '[0-9]+') AS found, {_DIGITS.format('source')} AS known FROM s)
SELECT doc_id, len(list_filter(found, lambda n: NOT list_contains(known, regexp_replace(n, '^0+([0-9])', '\1'))
  AND NOT (length(n) = 4 AND n[1:2] = '20' AND list_contains(known, regexp_replace(n[3:4], '^0+([0-9])', '\1')))))::INT AS n_invented
FROM k
""")
def invented_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of each document that the next one does not have."""
    d = table(attach(spark), sf_dir, "documents")
    o = d.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("other"))
    found = X.invented_numbers(F.coalesce("text", F.lit("")), F.coalesce("other", F.lit("")))
    return d.join(o, "doc_id", "left").select("doc_id", F.size(found).alias("n_invented"))


@query(r"""
WITH g AS (SELECT doc_id, quality = 1 AS q, toxic = 0 AS t, quality = 1 AND toxic = 0 AS c FROM labels),
f AS (SELECT doc_id, list_filter([CASE WHEN q IS NOT TRUE THEN 'reusable_question' END, CASE WHEN t IS NOT TRUE THEN 'general_answer' END,
  CASE WHEN c IS NOT TRUE THEN 'complete_answer' END], lambda x: x IS NOT NULL) AS failed FROM g)
SELECT CASE WHEN len(failed) > 1 THEN 'filter:' || array_to_string(failed, ',') END AS reason, count(*) AS n FROM f GROUP BY 1
""")
def gate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the gate gives each reason; labels stand in for a model's flags."""
    l = table(attach(spark), sf_dir, "labels")
    q, t = F.col("quality") == 1, F.col("toxic") == 0
    failed = validation.failed_flags({"reusable_question": q, "general_answer": t, "complete_answer": q & t})
    return l.select(validation.gate(failed)["reason"].alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


_WORDS = r"len(list_filter(regexp_split_to_array({}, '\s+'), lambda w: w <> ''))"
_MARKERS_OFF = r"regexp_replace(regexp_replace({}, 'https?://[^\s«»\"<>]+', '.', 'g'), '(^|\n)[0-9]{{1,2}}[.)]\s+', '\1', 'g')"


@query(rf"""
WITH {_PAIRS}, x AS (
  SELECT ord, category, CASE WHEN ord % 11 = 3 THEN repeat('word ', 151) ELSE question END AS question, question || ' ' || answer AS source,
    CASE ord % 13 WHEN 1 THEN answer || ' see https://x.test/9, thanks' WHEN 4 THEN answer || ' [ссылка 3]' WHEN 6 THEN answer || ' within 98765 days' WHEN 8 THEN ' ' WHEN 10 THEN NULL ELSE answer END AS answer
  FROM e
), w AS (
  SELECT *, trim(question, e' \t\n\r') AS q, trim(answer, e' \t\n\r') AS a, list_transform(regexp_extract_all(answer, 'https?://[^\s«»"<>]+'), lambda l: regexp_replace(l, '[.,;:!?)]+$', '')) AS links,
    list_distinct(list_transform(regexp_extract_all(source, '[0-9]+'), lambda n: regexp_replace(n, '^0+([0-9])', '\1'))) AS known FROM x
), v AS (
  SELECT *, list_filter(links, lambda l: NOT contains(source, l)) AS wrong,
    list_filter(regexp_extract_all({_MARKERS_OFF.format('a')}, '[0-9]+'), lambda n: NOT list_contains(known, regexp_replace(n, '^0+([0-9])', '\1'))
      AND NOT (length(n) = 4 AND n[1:2] = '20' AND list_contains(known, regexp_replace(n[3:4], '^0+([0-9])', '\1')))) AS made_up FROM w
)
SELECT ord, CASE WHEN category NOT IN ('c0', 'c2') THEN 'unknown_category:' || category WHEN answer IS NULL THEN 'non_string_fields' WHEN q = '' OR a = '' THEN 'empty_fields'
  WHEN {_WORDS.format('q')} > 150 THEN 'question_too_long' WHEN {_WORDS.format('a')} > CASE WHEN ord % 3 = 0 THEN 30 ELSE 300 END THEN 'answer_too_long'
  WHEN len(wrong) > 0 THEN 'invented_links:' || array_to_string(wrong, ',') WHEN regexp_matches(q || ' ' || a, '(?i)\[\s*ссылк[а-яё]*[\s_-]*([0-9]+)\s*\]') THEN 'unknown_link_placeholder'
  WHEN len(made_up) > 0 THEN 'invented_numbers:' || array_to_string(made_up, ',') END AS reason FROM v
""")
def entry_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rule that each question-answer pair breaks; some answers have a link, a mark or a number of their own."""
    e, o = _pairs(spark, sf_dir), F.col("ord") % 13
    q = F.when(F.col("ord") % 11 == 3, F.repeat(F.lit("word "), F.lit(151))).otherwise(F.col("question"))
    add = lambda text: F.concat("answer", F.lit(text))
    a = (
        F.when(o == 1, add(" see https://x.test/9, thanks")).when(o == 4, add(" [ссылка 3]")).when(o == 6, add(" within 98765 days"))
        .when(o == 8, F.lit(" ")).when(o == 10, F.lit(None)).otherwise(F.col("answer"))
    )
    x = e.select("ord", "category", q.alias("question"), a.alias("answer"), F.concat("question", F.lit(" "), "answer").alias("source"))
    limit = F.when(F.col("ord") % 3 == 0, 30).otherwise(300)
    return x.select("ord", validation.validate(F.col("category"), F.col("question"), F.col("answer"), F.col("source"), ["c0", "c2"], limit).alias("reason"))


_GROUPED = """d AS (SELECT doc_id, md5(coalesce(text, '')) AS g, source, lang FROM documents)"""


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as entries; copies of a text are a group."""
    d = table(attach(spark), sf_dir, "documents")
    return d.select(
        "doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("g"), F.col("source").alias("source_file"), F.array(F.col("doc_id").cast("int")).alias("source_rows"),
        F.create_map(F.lit("lang"), "lang", F.lit("place"), F.concat("source", F.lit("| "), "lang")).alias("source_columns"),
        F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("doubt "), F.col("doc_id") % 3)).alias("doubtful"),
    )


@query(rf"""
WITH {_GROUPED}, f AS (SELECT g, source, min(doc_id) AS pl FROM d GROUP BY g, source), n AS (SELECT g, min(doc_id) AS first FROM d GROUP BY g),
s AS (SELECT g, string_agg(source, '; ' ORDER BY pl) AS source_file FROM f WHERE source <> '' GROUP BY g),
p AS (SELECT g, part, min((doc_id, k)) AS pl FROM (SELECT g, doc_id, 0 AS k, source AS part FROM d UNION ALL SELECT g, doc_id, 1, lang FROM d) GROUP BY g, part),
c AS (SELECT g, string_agg(part, '| ' ORDER BY pl) AS place FROM p GROUP BY g),
r AS (SELECT g, string_agg(DISTINCT doc_id::INT::VARCHAR, ',' ORDER BY doc_id::INT::VARCHAR) AS source_rows FROM d GROUP BY g),
x AS (SELECT g, doc_id % 3 AS m, min(doc_id) AS pl FROM d GROUP BY g, m),
y AS (SELECT g, CASE WHEN bool_and(m > 0) THEN string_agg('doubt ' || m, '; ' ORDER BY pl) END AS doubtful FROM x GROUP BY g)
SELECT first AS doc_id, source_file, place, source_rows, doubtful FROM n JOIN s USING (g) JOIN c USING (g) JOIN r USING (g) JOIN y USING (g)
""")
def provenance_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files, columns, rows and doubts of each group of copies."""
    e = _entries(spark, sf_dir)
    first = e.groupBy("g").agg(F.min("doc_id").alias("doc_id"))
    merged = first.join(provenance.merge_sources(e, "g", "doc_id"), "g").join(provenance.merge_columns(e, "g", "doc_id"), "g").join(provenance.merge_doubts(e, "g", "doc_id"), "g")
    rows = F.array_join(F.array_sort(F.transform("source_rows", lambda r: r.cast("string"))), ",")
    return merged.select("doc_id", "source_file", F.col("source_columns")["place"].alias("place"), rows.alias("source_rows"), "doubtful")


@query(r"""
SELECT a.doc_id, sha256(trim(a.text, e' \t\n\r')) AS hash FROM documents a
WHERE a.doc_id % 2 = 0 AND NOT EXISTS (SELECT 1 FROM documents b WHERE b.doc_id % 2 = 1 AND sha256(trim(b.text, e' \t\n\r')) = sha256(trim(a.text, e' \t\n\r')))
""")
def ledger_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even documents whose content hash no odd one has: what a ledger of the odd ones leaves to do."""
    d = table(attach(spark), sf_dir, "documents").select("doc_id", X.content_hash(F.col("text")).alias("hash"))
    done = d.where("doc_id % 2 = 1").select("hash")
    return state.cached(d.where("doc_id % 2 = 0"), state.pending(d.where("doc_id % 2 = 0"), done, ["hash"]), ["hash"]).select("doc_id", "hash")


@query(r"""
SELECT doc_id FROM documents d WHERE doc_id % 5 <> 0 AND NOT EXISTS (
  SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 0 AND l.toxic = 1)
""")
def resume_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows still to do: every fifth is accepted, labels give verdicts and failures."""
    d = table(attach(spark), sf_dir, "documents").select(F.col("doc_id").alias("row_number"))
    accepted = d.where("row_number % 5 = 0").select(F.array("row_number").alias("source_rows"))
    reason = F.when((F.col("quality") == 0) & (F.col("toxic") == 1), "filter:a,b").otherwise("filter_failed")
    rejected = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("source_row"), reason.alias("reason"))
    return state.unfinished(d, accepted, rejected).select(F.col("row_number").alias("doc_id"))


@query(r"""
SELECT DISTINCT md5(coalesce(text, '')) AS hash FROM documents WHERE doc_id % 3 = 0
  AND md5(coalesce(text, '')) NOT IN (SELECT md5(coalesce(text, '')) FROM documents WHERE doc_id % 3 <> 0)
""")
def removed_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes that every third document has and no other."""
    d = table(attach(spark), sf_dir, "documents").select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("hash"))
    return state.removed(d.where("doc_id % 3 = 0"), d.where("doc_id % 3 <> 0"))


@query(r"""
SELECT event_type AS caller, count(*) AS n, count(*) FILTER (event_id % 7 = 0) AS failed, count(*) FILTER (event_id % 11 = 0 AND event_id % 7 <> 0) AS limited,
  0::BIGINT AS blocked, round(avg(value), 6) AS avg_s, max(value) AS max_s, round(sum(value), 4) AS total_s FROM events GROUP BY 1
""")
def call_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls by caller; event types stand in for callers, values for seconds."""
    e = table(attach(spark), sf_dir, "events")
    result = F.when(F.col("event_id") % 7 == 0, "error: x").when(F.col("event_id") % 11 == 0, "429").otherwise("ok")
    s = state.call_summary(e.select(F.col("event_type").alias("caller"), F.col("value").alias("seconds"), result.alias("result")))
    return s.select("caller", "n", "failed", "limited", "blocked", F.round("avg_s", 6).alias("avg_s"), "max_s", F.round("total_s", 4).alias("total_s"))


@query(f"WITH {_PAIRS} SELECT ord, question, answer, category FROM e")
def pair_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant's turns behind them."""
    return _pairs(spark, sf_dir).select("ord", "question", "answer", "category")


def _edges(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Question-answer pairs, and as edges those whose questions are similar enough for a judge."""
    e, (same, cross) = _pairs(spark, sf_dir), DEFAULTS.dedup_question
    return e, store(similarity.trigram_pairs(e, "ord", "question", same, cross, "category").select("i", "j"), "edges")


def _greedy(name: str, edges: str) -> str:
    """SQL of greedy groups (member, representative) over edges (i, j): nodes in order of rank, each looking for a representative among its neighbours."""
    return f"""{name}_b AS (SELECT i AS a, j AS b FROM {edges} UNION SELECT j, i FROM {edges}),
{name}_n AS (SELECT ord, row_number() OVER (ORDER BY -length(answer), ord) AS k FROM e),
{name}_l AS MATERIALIZED (SELECT n.ord, n.k, coalesce(list(b.b) FILTER (b.b IS NOT NULL), []) AS near FROM {name}_n n LEFT JOIN {name}_b b ON b.a = n.ord GROUP BY 1, 2),
{name}_r AS (SELECT 0::BIGINT AS k, []::BIGINT[] AS heads UNION ALL
  SELECT l.k, CASE WHEN list_has_any(l.near, r.heads) THEN r.heads ELSE list_append(r.heads, l.ord) END FROM {name}_r r JOIN {name}_l l ON l.k = r.k + 1),
{name}_h AS (SELECT unnest(heads) AS head FROM {name}_r WHERE k = (SELECT count(*) FROM e)),
{name} AS (SELECT head AS member, head AS representative FROM {name}_h UNION ALL
  SELECT b.a, arg_min(b.b, n.k) FROM {name}_b b JOIN {name}_h h ON h.head = b.b JOIN {name}_n n ON n.ord = b.b WHERE b.a NOT IN (SELECT head FROM {name}_h) GROUP BY b.a)"""


def _missing(name: str, groups: str, edges: str) -> str:
    return f"""{name} AS (SELECT DISTINCT least(x.a, g.representative) AS i, greatest(x.a, g.representative) AS j
  FROM {groups}_b x JOIN {groups} g ON g.member = x.b JOIN {groups} o ON o.member = x.a
  WHERE g.representative <> x.a AND o.representative <> g.representative AND NOT EXISTS (SELECT 1 FROM {groups}_b y WHERE y.a = x.a AND y.b = g.representative))"""


_EDGES = _flagged('', 'question', 'category', *DEFAULTS.dedup_question)
_GROUPS = f"WITH RECURSIVE {_PAIRS}, q AS (SELECT i, j FROM ({_EDGES})), {_greedy('g', 'q')}"


@query(f"{_GROUPS} SELECT member, representative FROM g")
def representative_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy groups of question-answer pairs."""
    e, edges = _edges(spark, sf_dir)
    return grouping.representatives(e, edges)


@query(f"{_GROUPS}, {_missing('m', 'g', 'q')} SELECT i, j FROM m")
def missing_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs that greedy groups suggest but no edge joins."""
    e, edges = _edges(spark, sf_dir)
    return grouping.missing_pairs(grouping.representatives(e, edges), edges)


@query(f"""{_GROUPS}, x AS (SELECT b.a, b.b FROM g_b b JOIN g p ON p.member = b.a JOIN g o ON o.member = b.b WHERE p.representative = o.representative AND (b.a + b.b) % 2 = 0),
t AS (SELECT member AS a, member AS b FROM g UNION SELECT t.a, x.b FROM t JOIN x ON x.a = t.b)
SELECT member, representative, cluster FROM g JOIN (SELECT a, min(b) AS cluster FROM t GROUP BY a) ON a = member""")
def same_answer_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters inside greedy groups along edges of like answers; every second edge stands for one."""
    e, edges = _edges(spark, sf_dir)
    relation = F.when((F.col("i") + F.col("j")) % 2 == 0, "same").otherwise("alternatives")
    return grouping.same_clusters(grouping.representatives(e, edges), edges.withColumn("relation", relation))


def _assigned(matches: str) -> str:
    """SQL of the greedy assignment over (new_id, base_id): each new row in order takes the first base row that is free."""
    return f"""o AS MATERIALIZED (SELECT new_id, list(base_id ORDER BY base_id) AS bases, row_number() OVER (ORDER BY new_id) AS k FROM {matches} GROUP BY new_id),
a AS (SELECT 0::BIGINT AS k, NULL::BIGINT AS new_index, NULL::BIGINT AS base_index, []::BIGINT[] AS used UNION ALL
  SELECT k, new_id, f[1], CASE WHEN len(f) = 0 THEN used ELSE list_append(used, f[1]) END
  FROM (SELECT o.k, o.new_id, a.used, list_filter(o.bases, lambda b: NOT list_contains(a.used, b)) AS f FROM a JOIN o ON o.k = a.k + 1)),
s AS (SELECT new_index, base_index FROM a WHERE base_index IS NOT NULL)"""


@query(f"WITH RECURSIVE m AS ({ORACLE_SQL['trigram_cross_join']}), {_assigned('m')} SELECT new_index, base_index FROM s")
def one_to_one_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy one-to-one matches between turns of even and of odd conversations."""
    m = trigram_cross_join(spark, sf_dir)
    return grouping.one_to_one(m.select(F.col("new_id").alias("new_index"), F.col("base_id").alias("base_index")))


@query(r"""
WITH b AS (SELECT doc_id AS ord, md5(text) AS h FROM documents WHERE doc_id % 2 = 0), m AS (SELECT max(ord) AS last FROM b), a AS (SELECT min(doc_id) AS first FROM documents WHERE doc_id % 2 = 1)
SELECT ord, CASE WHEN ord % 10 = 0 THEN 'new' ELSE h END AS h FROM b
UNION ALL SELECT doc_id - first + last + 1, md5(text) FROM documents, m, a WHERE doc_id % 2 = 1
""")
def upsert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even documents with every tenth replaced, odd ones added behind."""
    d = table(attach(spark), sf_dir, "documents").select(F.col("doc_id").alias("ord"), F.md5("text").alias("h"))
    base = d.where("ord % 2 = 0")
    return state.upsert(base, base.where("ord % 10 = 0").withColumn("h", F.lit("new")), d.where("ord % 2 = 1")).select("ord", "h")


@query("\nUNION ALL ".join(
    f"""SELECT {k} AS position, '{c}' AS "column", '{t}' AS dtype, count(*) AS rows,
  (SELECT CASE WHEN length(v) > 80 THEN v[1:77] || '...' ELSE v END FROM (SELECT regexp_replace({c}::VARCHAR, '\\r\\n|\\r|\\n', ' ', 'g') AS v FROM documents WHERE {c} IS NOT NULL ORDER BY doc_id LIMIT 1)) AS sample FROM documents"""
    for k, (c, t) in enumerate((("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")))
))
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns, types, row counts and first values of documents."""
    return state.profile(table(attach(spark), sf_dir, "documents"), "doc_id")


# ---------------------------------------------------------------- rules, links and state, one query each


@query(r"""
SELECT doc_id, nullif(array_to_string(list_filter([CASE WHEN quality = 1 THEN NULL ELSE 'the question may concern one case only' END,
  CASE WHEN toxic = 0 THEN NULL ELSE 'the answer may concern one case only' END], lambda x: x IS NOT NULL), '; '), '') AS doubtful
FROM labels WHERE NOT (quality IS DISTINCT FROM 1 AND toxic IS DISTINCT FROM 0)
UNION ALL SELECT doc_id, NULL FROM labels WHERE quality IS DISTINCT FROM 1 AND toxic IS DISTINCT FROM 0
""")
def gate_doubts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reviewer reads of rows that fail one flag; rows that fail more are rejected, without a doubt."""
    l = table(attach(spark), sf_dir, "labels")
    failed = validation.failed_flags({"reusable_question": F.col("quality") == 1, "general_answer": F.col("toxic") == 0, "complete_answer": F.lit(True)})
    return l.select("doc_id", validation.gate(failed)["doubtful"].alias("doubtful"))


@query(rf"""
WITH {_PAIRS}, g AS (SELECT conv_id, category, arg_min(question, ord) AS question, list(answer ORDER BY ord) AS answers, string_agg(answer, ' ' ORDER BY ord) AS joined FROM e GROUP BY conv_id, category),
m AS (SELECT conv_id, category, v, question, answers, joined AS source, CASE WHEN conv_id % 3 = 0 THEN joined WHEN conv_id % 3 = 1 THEN 'x' ELSE answers[1] END AS answer
  FROM g, (VALUES (true), (false)) t(v)), w AS (SELECT *, {_WORDS.format('answer')} AS n FROM m)
SELECT conv_id, category, v AS variants, CASE WHEN category NOT IN ('c0', 'c2') THEN 'unknown_category:' || category WHEN question = '' OR trim(answer) = '' THEN 'empty_fields'
  WHEN {_WORDS.format('question')} > 150 THEN 'question_too_long' WHEN n > CASE WHEN v THEN greatest(500, 150 * len(answers)) ELSE 300 END THEN 'answer_too_long'
  WHEN v AND length(trim(answer, e' \t\n\r')) < list_max(list_transform(answers, lambda a: length(a))) THEN 'variants_answer_lost_details'
  WHEN NOT v AND length(trim(answer, e' \t\n\r')) < list_min(list_transform(answers, lambda a: length(a))) THEN 'merged_answer_lost_details' END AS reason FROM w
""")
def merge_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule that an entry made of a conversation's answers breaks: all of them joined, the first one, or next to nothing."""
    turns = F.sort_array(F.collect_list(F.struct("ord", "question", "answer")))
    g = _pairs(spark, sf_dir).groupBy("conv_id", "category").agg(turns.alias("t"))
    g = g.select("conv_id", "category", F.col("t")[0]["question"].alias("question"), F.transform("t", lambda x: x["answer"]).alias("answers"))
    joined, third = F.array_join("answers", " "), F.col("conv_id") % 3
    g = g.withColumn("answer", F.when(third == 0, joined).when(third == 1, F.lit("x")).otherwise(F.col("answers")[0]))
    one = lambda v: g.select("conv_id", "category", F.lit(v).alias("variants"), validation.merge_reason(F.col("category"), F.col("question"), F.col("answer"), F.col("answers"), ["c0", "c2"], v).alias("reason"))
    return one(True).unionByName(one(False))


@query(r"""
SELECT event_id, CASE WHEN event_id % 3 = 0 AND event_id % 4 = 0 THEN 'blacklist: rewrite' WHEN event_id % 3 = 0 THEN 'transform_failed' WHEN event_id % 3 = 1 THEN 'unhandled_error' ELSE 'filter:a,b' END AS reason
FROM events WHERE NOT (event_id % 3 = 1 AND event_id % 4 = 0) UNION ALL SELECT event_id, 'blacklist: rewrite' FROM events WHERE event_id % 3 = 1 AND event_id % 4 = 0
""")
def final_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures with a blocked call are verdicts; every fourth event's call counts as blocked."""
    e, m = table(attach(spark), sf_dir, "events"), F.col("event_id") % 3
    reason = F.when(m == 0, "transform_failed").when(m == 1, "unhandled_error").otherwise("filter:a,b")
    return e.select("event_id", validation.final_reason(reason, F.when(F.col("event_id") % 4 == 0, "rewrite")).alias("reason"))


@query(r"""
SELECT doc_id, CASE WHEN source IN ('web', 'books') OR coalesce(d, '') <> '' THEN nullif(d, '') ELSE 'the category is not of this domain' END AS doubtful
FROM (SELECT doc_id, source, CASE doc_id % 5 WHEN 0 THEN 'known' WHEN 1 THEN '' END AS d FROM documents)
""")
def foreign_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of other sources than two become doubtful unless they are."""
    five = F.col("doc_id") % 5
    d = table(attach(spark), sf_dir, "documents").select("doc_id", F.col("source").alias("category"), F.when(five == 0, "known").when(five == 1, "").alias("doubtful"))
    return validation.mark_foreign(d, ["web", "books"]).select("doc_id", "doubtful")


def _rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(attach(spark), sf_dir, "labels")
    reason = F.when(F.col("quality") == 1, "filter_failed").when(F.col("toxic") == 1, "filter:a,b").otherwise("unhandled_error")
    return l.select(F.col("doc_id").alias("source_row"), reason.alias("reason"))


_REASONS = "r AS (SELECT doc_id AS source_row, CASE WHEN quality = 1 THEN 'filter_failed' WHEN toxic = 1 THEN 'filter:a,b' ELSE 'unhandled_error' END AS reason FROM labels)"


@query(f"WITH {_REASONS} SELECT reason, count(*) AS n FROM r GROUP BY reason")
def reason_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons by frequency; labels stand in for rejected rows."""
    return state.reason_histogram(_rejected(spark, sf_dir))


@query(f"""WITH {_REASONS} SELECT (SELECT count(*) FROM documents) AS accepted, (SELECT count(*) FROM documents WHERE doc_id % 3 > 0) AS doubtful, count(*) FILTER (reason = 'filter:a,b') AS rejected,
  count(*) FILTER (reason <> 'filter:a,b') AS failed, (SELECT count(*) FROM documents) + count(*) AS total FROM r""")
def batch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a batch: documents accepted, some in doubt, labels rejected or failed."""
    return state.totals(_entries(spark, sf_dir), _rejected(spark, sf_dir))


@query("SELECT doc_id AS ord FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) OR NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id + 1)")
def not_merged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents standing for rows n and n + 1 of which one was not merged before; labels tell what was."""
    d = table(attach(spark), sf_dir, "documents").select(F.col("doc_id").alias("ord"), F.array(F.col("doc_id"), F.col("doc_id") + 1).alias("source_rows"))
    return state.not_merged(d, table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row"))).select("ord")


@query("SELECT page_id FROM pages p WHERE sha256(p.url) IN (SELECT sha256(url) FROM pages WHERE page_id % 3 = 0)")
def ledger_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose content hash the ledger has; pages stand in for files, every third is in the ledger."""
    p = table(attach(spark), sf_dir, "pages").select("page_id", F.sha2("url", 256).alias("hash"))
    return state.is_merged(p, p.where("page_id % 3 = 0").select("hash")).select("page_id")


_LINKED = "s AS (SELECT p.page_id, 'see ' || p.url || '. Also (' || coalesce(o.url, 'http://none.test') || '), and ' || p.url || '!' AS t, p.url AS u, coalesce(o.url, 'http://none.test') AS v FROM pages p LEFT JOIN pages o ON o.page_id = p.page_id + 1)"


def _linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(attach(spark), sf_dir, "pages")
    o = p.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("other"))
    v = F.coalesce("other", F.lit("http://none.test"))
    return p.join(o, "page_id", "left").select("page_id", F.concat(F.lit("see "), "url", F.lit(". Also ("), v, F.lit("), and "), "url", F.lit("!")).alias("t"), "url", v.alias("v"))


@query(f"WITH {_LINKED} SELECT page_id, 'see [ссылка-1]. Also ([ссылка-' || CASE WHEN u = v THEN 1 ELSE 2 END || ']), and [ссылка-1]!' AS masked, CASE WHEN u = v THEN [u] ELSE [u, v] END AS links FROM s")
def masked_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences with two pages' links masked by numbered marks."""
    m = _linked(spark, sf_dir).select("page_id", links.mask_links(F.col("t")).alias("m"))
    return m.select("page_id", F.col("m.texts")[0].alias("masked"), F.col("m.links").alias("links"))


@query(f"WITH {_LINKED} SELECT page_id, 'по ' || v || ', ' || u || ' и [ссылка-3]' AS text FROM s")
def unmasked_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks as a reply may spell them, back to links; an unknown one stays."""
    said = F.lit("по [Ссылке 2], [ ссылку_1 ] и [ссылка-3]")
    return _linked(spark, sf_dir).select("page_id", links.unmask_links(said, F.array("url", "v")).alias("text"))


@query(r"""
SELECT page_id, ['[Ссылке_' || page_id || ']', '[ ссылка ' || page_id % 7 || ' ]'] AS marks FROM pages
""")
def placeholders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks in a question and an answer, in any spelling."""
    p, n = table(attach(spark), sf_dir, "pages"), F.col("page_id").cast("string")
    q = F.concat(F.lit("по [Ссылке_"), n, F.lit("] и [ссылк]"))
    a = F.concat(F.lit("[ ссылка "), (F.col("page_id") % 7).cast("string"), F.lit(" ] [другое 1]"))
    return p.select("page_id", X.find_placeholders(q, a).alias("marks"))


@query("""
WITH a AS (SELECT md5(coalesce(text, '')) AS h, source FROM documents WHERE doc_id % 2 = 0), b AS (SELECT md5(coalesce(text, '')) AS h, source FROM documents WHERE doc_id % 2 = 1),
d AS (SELECT 'left' AS side, h, source FROM (SELECT h, source FROM a EXCEPT ALL SELECT h, source FROM b) UNION ALL SELECT 'right', h, source FROM (SELECT h, source FROM b EXCEPT ALL SELECT h, source FROM a))
SELECT side, count(*) AS n, count(DISTINCT h) AS texts FROM d GROUP BY side
""")
def base_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that one of two bases has more often than the other; both empty means equal bases."""
    d = table(attach(spark), sf_dir, "documents").select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("h"), "source")
    a, b = (state.canonical(d.where(f"doc_id % 2 = {k}").drop("doc_id")) for k in (0, 1))
    found = a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))
    return found.groupBy("side").agg(F.count("*").alias("n"), F.count_distinct(F.get_json_object("row", "$.h")).alias("texts"))


# ---------------------------------------------------------------- composite operators over a provider with fixed replies


class Fixed(Rules):
    """All pairs are ``relation``, no merge succeeds."""

    def __init__(self, relation: str):
        super().__init__(["c0", "c1", "c2"])
        self.relation = relation

    def judge(self, a: dict, b: dict) -> dict:
        return {"duplicate": True, "relation": self.relation, "reason": "fixed"}

    def match(self, new: dict, base: dict) -> dict:
        return self.judge(new, base)

    def merge(self, entries: list[dict], variants: bool, hint: str = "") -> None:
        raise Blocked()


def _whole(e: DataFrame) -> DataFrame:
    """Question-answer pairs with all columns of entries."""
    return e.select(
        "ord", "category", "question", "answer", F.concat(F.lit("f"), F.col("conv_id") % 5).alias("source_file"), F.array(F.col("ord").cast("int")).alias("source_rows"),
        F.create_map(F.lit("conv"), F.col("conv_id").cast("string")).alias("source_columns"), F.lit("2025-01-01").alias("updated_at"), F.lit(None).cast("string").alias("doubtful"),
    )


def _no_verdicts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], dedup.CACHE)


@query(rf"""{_GROUPS}, {_missing('m', 'g', 'q')}, q2 AS (SELECT i, j FROM q UNION SELECT i, j FROM m), {_greedy('h', 'q2')},
f AS (SELECT representative, conv_id % 5 AS f, min(ord) AS pl FROM h JOIN e ON ord = member GROUP BY 1, 2),
r AS (SELECT representative, min(member) AS first, string_agg(member::VARCHAR, ',' ORDER BY member) AS rows FROM h GROUP BY 1),
s AS (SELECT representative, string_agg('f' || f, '; ' ORDER BY pl) AS files FROM f GROUP BY 1)
SELECT row_number() OVER (ORDER BY first) - 1 AS ord, e.question, e.answer, files AS source_file, rows AS source_rows FROM r JOIN s USING (representative) JOIN e ON e.ord = representative""")
def collapsed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collapsing with a judge that calls all candidates the same and a model that merges none: the most detailed entry of each group, with all rows of the group."""
    e, edges = _edges(spark, sf_dir)
    out, _ = dedup.collapse_duplicates(_whole(e), edges, _no_verdicts(spark), ["c0", "c1", "c2"], Fixed("same"), "2026-01-01", retry={"attempts": 1})
    return out.select("ord", "question", "answer", "source_file", F.array_join(F.transform("source_rows", lambda r: r.cast("string")), ",").alias("source_rows"))


_CANDIDATE_MATCHES = rf"""{_PAIRS}, n AS (SELECT * FROM e WHERE conv_id % 2 = 0), b AS (SELECT * FROM e WHERE conv_id % 2 = 1),
{_grams_of('n', 'ord', 'question', 'category', 'nq')}, {_grams_of('b', 'ord', 'question', 'category', 'bq')}, {_grams_of('n', 'ord', 'answer', 'category', 'na')}, {_grams_of('b', 'ord', 'answer', 'category', 'ba')},
xq AS (SELECT x.id AS i, y.id AS j, count(*) AS c FROM (SELECT id, unnest(gs) AS g FROM nq) x JOIN (SELECT id, unnest(gs) AS g FROM bq) y ON x.g = y.g GROUP BY 1, 2),
xa AS (SELECT x.id AS i, y.id AS j, count(*) AS c FROM (SELECT id, unnest(gs) AS g FROM na) x JOIN (SELECT id, unnest(gs) AS g FROM ba) y ON x.g = y.g GROUP BY 1, 2),
v AS (SELECT ord, conv_id, embedding::DOUBLE[] AS e FROM e JOIN embeddings ON vec_id = (conv_id * 7 + turn) % 200),
k AS (SELECT i, j FROM (SELECT a.ord AS i, b.ord AS j, {_COSINE} AS c FROM v a JOIN v b ON a.conv_id % 2 = 0 AND b.conv_id % 2 = 1) WHERE c >= 0.8 - 1e-12 QUALIFY row_number() OVER (PARTITION BY i ORDER BY round(c, 9) DESC, j) <= 8),
u AS (SELECT i, j, true AS by_question, false AS by_answer, false AS by_embedding FROM xq JOIN nq p ON p.id = i JOIN bq q ON q.id = j WHERE c / (len(p.gs) + len(q.gs) - c) >= CASE WHEN p.cat = q.cat THEN 0.28 ELSE 0.50 END
  UNION ALL SELECT i, j, false, true, false FROM xa JOIN na p ON p.id = i JOIN ba q ON q.id = j WHERE c / (len(p.gs) + len(q.gs) - c) >= 0.75 UNION ALL SELECT i, j, false, false, true FROM k),
m AS (SELECT i AS new_id, j AS base_id, bool_or(by_question) AS by_question, bool_or(by_answer) AS by_answer, bool_or(by_embedding) AS by_embedding FROM u GROUP BY i, j)"""


def _matched(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs of even conversations, of odd ones, and their candidate matches by all three signals."""
    e = _pairs(spark, sf_dir)
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id"), "embedding")
    v = e.select("ord", "conv_id", ((F.col("conv_id") * 7 + F.col("turn")) % 200).alias("vec_id")).join(vectors, "vec_id").select("ord", "conv_id", "embedding")
    sides = [[x.where(f"conv_id % 2 = {k}") for k in (0, 1)] for x in (e, v)]
    return *sides[0], candidates.candidate_matches(*sides[0], tuple(sides[1]))


@query(f"WITH {_CANDIDATE_MATCHES} SELECT * FROM m")
def candidate_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate matches between pairs of even and of odd conversations, by question, answer and embedding."""
    return _matched(spark, sf_dir)[2]


@query(f"""WITH RECURSIVE {_CANDIDATE_MATCHES}, {_assigned('m')},
t AS (SELECT row_number() OVER (ORDER BY b.ord) - 1 AS ord, coalesce(n.question, b.question) AS question, coalesce(n.answer, b.answer) AS answer FROM b LEFT JOIN s ON s.base_index = b.ord LEFT JOIN n ON n.ord = s.new_index),
w AS (SELECT row_number() OVER (ORDER BY ord) - 1 + (SELECT count(*) FROM b) AS ord, question, answer FROM n WHERE ord NOT IN (SELECT new_index FROM s))
SELECT * FROM t UNION ALL SELECT * FROM w""")
def merged_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of even conversations merged into those of odd ones, every match a contradiction: the new one replaces."""
    new, base, matches = _matched(spark, sf_dir)
    out, _, _ = dedup.merge_into_base(_whole(base), _whole(new), matches, _no_verdicts(spark), "replace", ["c0", "c1", "c2"], Fixed("contradiction"), "2026-01-01", retry={"attempts": 1})
    return out.select("ord", "question", "answer")
