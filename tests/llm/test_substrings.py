import hashlib
import random

import numpy as np
import pytest

from tessera.llm import substrings as S

pytestmark = pytest.mark.usefixtures("small")


def brute(rows, window=S.WINDOW):
    """rows: (doc_id, text). Windows by word sequence, judged on the input."""
    first: dict = {}
    words = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in words:
        for i in range(len(w) - window + 1):
            seq = tuple(w[i : i + window])
            if seq not in first or (d, i) < first[seq]:
                first[seq] = (d, i)
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (d, i):
                gone[i : i + window] = [True] * window
        left = [x for x, g in zip(w, gone) if not g]
        out.append((d, len(w), sum(gone), hashlib.sha256(b" ".join(left)).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in S.digests(df).collect())


def made(seed: int, n: int = 60):
    """Documents that share passages, lines and whole texts."""
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["a", "bc", "déf", "Gh.", "x", "yz"]) + str(rnd.randrange(9))
    passages = [[word() for _ in range(rnd.choice([15, 19, 20, 21, 40, 90]))] for _ in range(8)]
    docs = []
    for d in range(n):
        w = []
        for _ in range(rnd.randrange(0, 5)):
            w += rnd.choice(passages) if rnd.random() < 0.6 else [word() for _ in range(rnd.randrange(30))]
        docs.append((d * 3 + 1, rnd.choice([" ", "\n", " \t"]).join(w)))
    docs += [(1000 + k, docs[k][1]) for k in range(0, n, 7)]
    docs.append((2000, "same " * 70))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = made(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(S.dedup(df)) == brute(rows)


def test_documents(spark, sf):
    from tessera.llm.queries import op10_substrings

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in op10_substrings(spark, sf).collect())
    assert got == brute(rows)
    assert any(r[2] for r in got)


def test_deliveries_and_compaction(spark, tmp_path):
    rows = made(5)
    index = S.Index(spark, f"file://{tmp_path}/index", most=2)
    got = []
    for k, (a, b) in enumerate(((0, 150), (150, 400), (400, 10_000))):
        part = spark.createDataFrame([r for r in rows if a <= r[0] < b], "doc_id long, text string")
        got += result(index.ingest(part, f"{k:04d}"))
        if k == 0:  # a delivery that is repeated gives the same
            assert result(index.ingest(part, f"{k:04d}")) == sorted(got)
    assert sorted(got) == brute(rows)
    before = {(r.anchor, bytes(r.own)) for r in index.history().collect()}
    assert len(index.runs()) == 3 and index.compact() == 1
    assert {(r.anchor, bytes(r.own)) for r in index.history().collect()} == before
    again = spark.createDataFrame([(9999, rows[3][1])], "doc_id long, text string")
    n = len(rows[3][1].split())
    assert [(r[1], r[2]) for r in result(index.ingest(again, "0009"))] == [(n, n if n >= S.WINDOW else 0)]


def test_repeats_after_compaction_and_names_out_of_text_order(spark, tmp_path):
    rows = made(5)
    index = S.Index(spark, f"file://{tmp_path}/index", most=1)
    parts = [spark.createDataFrame([r for r in rows if a <= r[0] < b], "doc_id long, text string") for a, b in ((0, 200), (200, 10_000))]
    got = [result(index.ingest(part, name)) for part, name in zip(parts, ("9", "10"))]
    assert sorted(got[0] + got[1]) == brute(rows)
    assert index.compact() == 1
    assert [result(index.ingest(part, name)) for part, name in zip(parts, ("9", "10"))] == got


def test_shard_runs():
    rnd = np.random.default_rng(1)
    shard, seen = S.Shard(), set()
    for _ in range(40):
        keys = rnd.integers(0, 3000, 200).astype(np.uint64)
        expected = []
        for k in keys.tolist():
            expected.append(k in seen)
            seen.add(k)
        assert shard.seen(keys, keys).tolist() == expected
    assert len(shard.runs) <= 12 and all((np.diff(r.astype(np.int64)) > 0).all() for r, _ in shard.runs)


def test_odd_rows(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(3, text, 1), (3, text, 2), (5, None, 1), (6, "", 1), (7, text + " z", 1), (8, "short text", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, first int")
    got = [(r[0], r[1], r[2]) for r in result(S.dedup(df))]
    assert got == [(3, 30, 0), (3, 30, 0), (5, 0, 0), (6, 0, 0), (7, 31, 30), (8, 2, 0)]
    assert S.dedup(df.limit(0)).count() == 0
    null = spark.createDataFrame([(None, text), (1, text)], "doc_id long, text string")
    assert sorted((r.n_words, r.n_removed) for r in S.dedup(null).collect()) == [(30, 0), (30, 30)]


def test_large_anchors_are_judged_window_by_window(spark):
    rows = made(7) + [(3000 + k, " ".join(["deep"] * (30 + k)) + f" end{k}") for k in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    marks = S.mark(S.windows(df, "doc_id", "text"), "doc_id", held=1)
    assert result(S.kept(df, "doc_id", "text", marks)) == brute(rows)


def test_full_runs_start_anew(spark, monkeypatch):
    monkeypatch.setattr(S, "SEEN", 50)
    rows = made(8)
    df = spark.createDataFrame(rows, "doc_id long, text string").orderBy("doc_id")
    assert result(S.dedup(df)) == brute(rows)


def test_tiers_and_another_session(spark, tmp_path):
    rows = made(9)
    path = f"file://{tmp_path}/index"
    index, got = S.Index(spark, path, fan=2), []
    for k, (a, b) in enumerate(((0, 60), (60, 90), (90, 120), (120, 150), (150, 10_000))):
        part = spark.createDataFrame([r for r in rows if a <= r[0] < b], "doc_id long, text string")
        got += result(index.ingest(part, str(k)))
    assert sorted(got) == brute(rows)
    runs = index.manifest()["runs"]
    assert len(runs) <= 3 and sorted(d for r in runs for d in r["deliveries"]) == [str(k) for k in range(len(got) and 5)]
    windows = index.history().select("anchor", "own")
    assert windows.count() == windows.distinct().count()  # a window is in one run only
    other = S.Index(spark.newSession(), path)
    assert {(r.anchor, bytes(r.own)) for r in other.history().collect()} == {(r.anchor, bytes(r.own)) for r in windows.collect()}
