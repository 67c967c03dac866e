import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tessera.llm import language as L

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return L.fit(PATH, {"x": Counter(L.words_of("the cat sat on the mat and the cat sang")), "y": Counter(L.words_of("der hund und die katze der hund bellt"))})


def brute(model, word: str, l: int) -> float:
    """Sum over all segmentations, by enumeration."""
    v = L.pieces_of(PATH)
    place = {p: k for k, p in enumerate(v.pieces)}

    def total(rest: str) -> float:
        if not rest:
            return 1.0
        out = 0.0
        for k in range(1, min(v.widest, len(rest)) + 1):
            piece = place.get(rest[:k], v.unknown if k == 1 else None)
            if piece is not None:
                out += model.p[piece, l] * total(rest[k:])
        return out

    return math.log(total(word))


def test_forward_sums_all_segmentations(model):
    words = [L.START + w for w in ("the", "cats", "katze", "ßzqж", "a", "understanding")]
    got = model.word_scores(words)
    for k, w in enumerate(words):
        for l in range(2):
            assert got[k, l] == pytest.approx(brute(model, w, l), rel=1e-9)


def test_forward_and_backward_agree(model):
    words = [L.START + w for w in ("thecat", "hundes", "qqqqqq")]
    ids = L.pieces_of(PATH).lattice(words, 7)
    assert np.allclose(L.forward(ids, model.p)[7], L.backward(ids, model.p)[0])


def test_long_runs_and_memory(model, monkeypatch):
    text = "cat " * 50 + "y" * 500
    assert all(len(w) <= L.LONGEST for w in L.words_of(text)) and sum(map(len, L.words_of("y" * 500))) == 501
    whole = L.Predictor(model).predict([text, "der hund"])
    monkeypatch.setattr(L, "WORDS", 1)
    small = L.Predictor(model)
    assert [small.predict([t])[0] for t in (text, "der hund")] == whole


def test_held_out_documents(spark):
    from tessera.llm.queries import op6_language

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = op6_language(spark, sf).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) > 0.97 * len(rows)


def test_odd_rows(spark):
    rows = [(1, "the cat and the dog", "en", 1.0), (2, "der hund und die katze", "de", 1.0), (3, None, "en", 1.0), (4, "", None, 1.0), (5, "12 34 !", "de", 1.0), (None, "the dog", "en", 1.0), (1, "the cat and the dog", "en", 1.0), (6, "THE CAT", None, 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    model = L.train(df, F.lit(True), PATH)
    got = L.predict(df, model).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.lang_pred) for r in got} == {(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (None, "en"), (6, "en")}
    assert L.train(df.where("lang is null"), F.lit(True), PATH) is None
    assert {r.lang_pred for r in L.predict(df, None).collect()} == {"und"}
    assert L.predict(df.limit(0), model).count() == 0


def test_long_words_are_summed_whole(model):
    """Cuts only where no piece crosses, and the rescaled sums, against the plain sums."""
    v = L.pieces_of(PATH)
    words = [L.START + "thecatsatonthemat" * 4, L.START + "understanding" * 3 + "東京都" * 20 + "katze" * 5, L.START + "qжß" * 30]
    for w in words:
        total = np.log(L.forward(v.lattice([w], len(w)), model.p)[len(w), 0]) - len(w) * np.log(L.SCALE)
        assert model.long_score(w) == pytest.approx(total, rel=1e-9)
        parts = v.segments(w)
        assert "".join(parts) == w
        assert sum(model.word_scores([p])[0] for p in parts) == pytest.approx(total, rel=1e-9)
    assert len(v.segments(words[1])) > 40
    huge = "abc" * 5000
    assert np.isfinite(model.long_score(L.START + huge)).all() and L.Predictor(model).predict([huge])[0][0] in "xy"


def test_query_against_brute_force(spark, tmp_path):
    """Training and prediction in plain Python on a small table."""
    import zlib

    rows = [r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()][:60]
    spark.createDataFrame(rows).write.parquet(f"{tmp_path}/documents.parquet")
    from tessera.llm.queries import op6_language

    got = {r.doc_id: r for r in op6_language(spark, str(tmp_path)).collect()}
    v = L.pieces_of(PATH)
    place = {p: k for k, p in enumerate(v.pieces)}
    n = len(v.pieces)

    def edges(w):
        return [(i, i + k, place.get(w[i : i + k], v.unknown if k == 1 else None)) for i in range(len(w)) for k in range(1, min(v.widest, len(w) - i) + 1) if k == 1 or w[i : i + k] in place]

    def sums(w, p, back=False):
        at = [0.0] * (len(w) + 1)
        at[len(w) if back else 0] = 1.0
        for i, j, piece in sorted(edges(w), key=lambda e: -e[1] if back else e[0]):
            if back:
                at[i] += at[j] * p[piece]
            else:
                at[j] += at[i] * p[piece]
        return at

    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows}
    samples: dict = {}
    for r in rows:
        if r.lang is not None and not held[r.doc_id]:
            samples.setdefault(r.lang, Counter()).update(L.words_of(r.text or ""))
    names = sorted(k for k, c in samples.items() if c)
    sizes = [len(x) for x in v.pieces] + [1]
    first = [30.0**-s for s in sizes]
    first[n] = 1e-9
    p = {l: [x / sum(first) for x in first] for l in names}
    for _ in range(L.ROUNDS):
        counts = {l: np.zeros(n + 1) for l in names}
        for l in names:
            for w, m in samples[l].items():
                a, b = sums(w, p[l]), sums(w, p[l], True)
                for i, j, piece in edges(w):
                    counts[l][piece] += m * a[i] * p[l][piece] * b[j] / a[-1]
        pooled = sum(counts.values()) + 0.01
        pooled = pooled / pooled.sum()
        for l in names:
            new = (counts[l] + L.PRIOR * pooled) / (counts[l].sum() + L.PRIOR)
            new[n] = 1e-7
            p[l] = (new / new.sum()).tolist()
    for r in rows:
        words = [L.START + w for w in L.LETTERS.findall((r.text or "").lower())]
        assert got[r.doc_id].held_out == held[r.doc_id]
        if not words:
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        seen = Counter(words)
        totals = np.array([sum(m * math.log(sums(w, p[l])[-1]) for w, m in seen.items()) for l in names])
        share = np.exp(totals - totals.max())
        assert got[r.doc_id].lang_pred == names[int(share.argmax())]
        assert got[r.doc_id].score == pytest.approx(share.max() / share.sum(), rel=1e-6)
