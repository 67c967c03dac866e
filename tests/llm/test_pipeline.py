import hashlib

import pytest

import corpus_pipeline as P
from tessera.session import store
from tests.llm.test_nearcopies import groups


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs.collect()]
    for _, stage in P.STAGES:
        docs = store(stage(spark, docs, sf), "test")
        out.append(docs.collect())
    return out


def test_order_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["toxicity", "simhash", "secrets", "mixing", "bpe"]
    for rows in stages[:-1]:
        assert rows[0].__fields__ == P.COLUMNS
    assert len(stages[0]) > len(stages[1]) > len(stages[2]) == len(stages[3])


def test_near_duplicates(stages):
    """One document a group of 5-word Jaccard >= 0.8, by brute force over what the stage was given."""
    assert {r.doc_id for r in stages[2]} == set(groups([(r.doc_id, r.text) for r in stages[1]]).values())


def test_clashing_columns(spark):
    """Extra columns, whatever their names, neither matter nor stay."""
    rows = [(k, f"some words of document {k} that nobody else has, token = abcdefghijkl{k}", "en", "ab"[k % 2], 60) for k in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    from unittest import mock

    with mock.patch.object(P, "table", lambda *_: labels):
        extra = docs.selectExpr("*", "'x' AS row", "1 AS spans", "2.5 AS score", "'y' AS k", "0 AS taken", "1 AS size", "true AS held", "'z' AS words", "1L AS component_id")
        for name, stage in P.STAGES:
            plain, odd = stage(spark, docs, ""), stage(spark, extra, "")
            assert plain.columns == odd.columns and sorted(map(str, plain.collect())) == sorted(map(str, odd.collect())), name


def test_border_keeps_its_line_breaks(spark):
    rows = [(k, "\n a  b\tc \n\n d e\n" * 9, "en", "ab"[k > 1], 144) for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    from unittest import mock

    with mock.patch.object(P, "table", lambda *_: spark.createDataFrame([], "doc_id long, quality int, toxic int")):
        got = P.mix_sources(spark, docs, "").collect()
    assert got and all(rows[0][1].startswith(r.text) and r.n_chars == len(r.text) for r in got)
    assert any(r.text != rows[0][1] for r in got)


def test_secrets_are_masked_only(stages):
    before, after = {r.doc_id: r for r in stages[2]}, {r.doc_id: r for r in stages[3]}
    assert before.keys() == after.keys()
    changed = [d for d in before if before[d].text != after[d].text]
    assert changed and all("[SECRET]" in after[d].text and after[d].n_chars == len(after[d].text) for d in changed)
    assert len(changed) < 0.1 * len(before)


def test_mix_takes_its_targets(spark, stages):
    sizes: dict = {}
    for r in stages[3]:
        sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").encode().split())
    got: dict = {}
    for r in stages[4]:
        got[r.source] = got.get(r.source, 0) + len(r.text.encode().split())
    total, names = sum(sizes.values()), sorted(sizes)
    target, free = {}, {n: i % 3 + 1 for i, n in enumerate(names)}
    while free:  # share, cap, share again
        left = total - sum(target.values())
        over = [n for n in free if left * free[n] / sum(free.values()) > 3 * sizes[n]]
        for n in over or list(free):
            if over:
                target[n] = 3 * sizes[n]
        if not over:
            target |= {n: left * w / sum(free.values()) for n, w in free.items()}
            break
        for n in over:
            del free[n]
    assert all(abs(got.get(n, 0) - target[n]) <= 1 for n in names)


def test_tokens(stages):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    key = lambda d, ids: (d, hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    expected = sorted(key(r.doc_id, library.encode(r.text, add_special_tokens=False).ids) for r in stages[4])
    assert sorted(key(r.doc_id, r.ids) for r in stages[5]) == expected


def test_odd_rows(spark, tmp_path):
    long = " ".join(f"word{k}" for k in range(400))
    rows = [(1, long, "en", "a", 9), (1, long, "en", "a", 9), (1, "other text of one id here", None, "a", None), (None, "no id but words enough", "en", None, 3), (3, None, "en", "b", 0), (4, "", "en", "b", 0), (5, "token = abcdefghijklmnop1 rest", "en", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = P.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} <= {1, None, 5} and got
    docs.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
