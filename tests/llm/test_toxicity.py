import random

import numpy as np

from tessera.llm import toxicity as X


def made(n: int, seed: int):
    """Texts of invented words; toxic ones hold two or more words of a family by its beginning."""
    rnd = random.Random(seed)
    syllables = ["ba", "lo", "mi", "ten", "ur", "ka", "se", "dro"]
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randrange(1, 5)))
    out = []
    for _ in range(n):
        words = [word() for _ in range(rnd.randrange(5, 120))] + ["the", "of"]
        toxic = rnd.random() < 0.3
        if toxic:
            for _ in range(rnd.randrange(2, 6)):
                words.insert(rnd.randrange(len(words)), "zqux" + word())
        out.append((words, int(toxic)))
    return out


def test_learns_families_of_words():
    net = X.train(made(500, 1))
    test = made(300, 2)
    got = np.array(X.Scorer(net).scores([" ".join(w) for w, _ in test])) >= 0.5
    truth = np.array([y for _, y in test]) == 1
    assert (got == truth).mean() > 0.95


def test_convolution_against_loops():
    rnd = np.random.default_rng(3)
    net = X.fresh()
    for b in net.biases:
        b += rnd.normal(0, 0.3, len(b)).astype(np.float32)
    table = rnd.normal(0, 1, (50, X.DIM)).astype(np.float32)
    lengths = [0, 1, 2, 3, 7, 0, 40, 1]
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    ids = rnd.integers(0, 50, bounds[-1])
    got, at = X.convolve(net, table, ids, bounds, where=True)
    for t in range(len(lengths)):
        mine = ids[bounds[t] : bounds[t + 1]]
        expected = []
        for width, kernel, bias in zip(X.WIDTHS, net.kernels, net.biases):
            seen = [sum(table[mine[i + j]] @ kernel[j] for j in range(width)) + bias for i in range(len(mine) - width + 1)]
            expected += list(np.maximum(0, np.max(seen, axis=0))) if seen else [0.0] * X.FILTERS
        assert np.allclose(got[t], expected, atol=1e-4)
        assert all(bounds[t] <= p < bounds[t + 1] for p in at[t][at[t] >= 0])


def test_whole_texts_and_memory(monkeypatch):
    net = X.train(made(300, 4))
    mild = " ".join(made(1, 9)[0][0][:3])
    far = "balo " * 40_000 + "zquxmi zquxlo zquxur"
    assert X.Scorer(net).scores([far])[0] == X.Scorer(net).scores(["balo balo balo zquxmi zquxlo zquxur"])[0] > 0.5
    monkeypatch.setattr(X, "WORDS", 3)
    small = X.Scorer(net)
    assert [small.scores([t])[0] for t in (mild, far, mild)] == [X.Scorer(net).scores([t])[0] for t in (mild, far, mild)]


def test_table(spark):
    rows = made(200, 5)
    docs = spark.createDataFrame([(k, " ".join(w), "x") for k, (w, _) in enumerate(rows)] + [(900, None, "x"), (901, "", "x"), (None, "the", "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(k, 1, y) for k, (_, y) in enumerate(rows)] + [(0, 1, None), (5000, 0, 1), (None, 0, 1)], "doc_id long, quality int, toxic int")
    held = X.crc_of_id() % 5 == 0
    net, prior = X.fit(docs, labels, ~held)
    got = {r.doc_id: r.score for r in X.score(docs, net, prior=prior).collect()}
    assert len(got) == 203 and all(0 <= s <= 1 for s in got.values()) and got[900] == got[901]
    assert np.mean([(got[k] >= 0.5) == bool(y) for k, (_, y) in enumerate(rows)]) > 0.95
    again, _ = X.fit(docs.repartition(5), labels, ~held)
    assert {r.doc_id: r.score for r in X.score(docs, again).collect()} == got
    none, prior = X.fit(docs, labels.where("toxic = 0"), ~held)
    assert none is None and {r.score for r in X.score(docs, none, prior=prior).collect()} == {0.0}
    assert X.score(docs.limit(0), net).count() == 0


def test_held_out_documents(spark):
    from tessera.llm.queries import op9_toxicity

    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = op9_toxicity(spark, sf).where("held_out").join(labels, "doc_id").collect()
    toxic = [r for r in rows if r.toxic == 1]
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.predicted for r in clean) < 0.02 * len(clean)


def test_query_against_loops(spark, sf):
    """Scores of the query from the trained network by plain loops over words."""
    from tessera.llm.queries import op9_toxicity

    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    net, _ = X.fit(docs, labels, ~(X.crc_of_id() % 5 == 0))
    got = {r.doc_id: r for r in op9_toxicity(spark, sf).collect()}
    for r in docs.collect()[:60]:
        words = X.words_of(r.text or "")
        seen = [sum(net.vectors[p] for p in X.parts_of(w)) for w in words]
        features = []
        for width, kernel, bias in zip(X.WIDTHS, net.kernels, net.biases):
            shown = [sum(seen[i + j] @ kernel[j] for j in range(width)) + bias for i in range(len(seen) - width + 1)]
            features += list(np.maximum(0, np.max(shown, axis=0))) if shown else [0.0] * X.FILTERS
        votes: dict = {}
        for w in words:
            if w in net.marks:
                votes[net.marks[w]] = votes.get(net.marks[w], 0) + 1
        lang = max(sorted(votes), key=votes.get) if votes else -1
        z = (float(np.array(features) @ net.output) + net.offset - net.thresholds.get(lang, net.thresholds[-1])) * net.slope * 4
        assert abs(got[r.doc_id].score - 1 / (1 + np.exp(-np.clip(z, -30, 30)))) < 1e-3
        assert got[r.doc_id].predicted == int(got[r.doc_id].score >= 0.5)


def test_languages_come_from_the_sample():
    words = [["la", "casa", "x"], ["la", "mesa"], ["the", "house", "x"], ["the", "table"], ["ein", "haus", "x"], ["no", "label"]]
    marks = X.markers(words, ["es", "es", "en", "en", "de", None])
    assert marks["la"] == 2 and marks["the"] == 1 and marks["ein"] == 0 and "x" not in marks and "no" not in marks
    assert [X.language_of(w, marks) for w in (["the", "la", "the"], ["x"], [])] == [1, -1, -1]
    assert X.markers(words, []) == {}
