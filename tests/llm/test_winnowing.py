import hashlib
import random

import numpy as np

from tessera.llm import winnowing as W


def brute_choice(text: str):
    """Chosen (position) by the definition, hashes by run of characters."""
    k = min(W.K, len(text))
    hashes = W.run_hashes(W.code_points(text)).tolist()
    assert len(hashes) == (len(text) - k + 1 if text else 0)
    w = min(W.WINDOW, len(hashes))
    chosen = []
    for i in range(len(hashes) - w + 1) if hashes else ():
        at = min(range(i, i + w), key=lambda j: (hashes[j], -j))
        if at not in chosen:
            chosen.append(at)
    return chosen, hashes


def test_choice_and_guarantee():
    rnd = random.Random(4)
    for n in (0, 1, 5, 15, 16, 17, 39, 40, 200, 1000):
        text = "".join(rnd.choice("abé🙂 ") for _ in range(n))
        chosen, hashes = brute_choice(text)
        got, at = W.winnow(W.code_points(text))
        assert at.tolist() == chosen and got.tolist() == [hashes[i] for i in chosen]
    same = W.run_hashes(W.code_points("ab" * 50)).tolist()
    assert len(set(same)) == 2
    for _ in range(50):  # a shared stretch of the guaranteed length
        shared = "".join(rnd.choice("abcdefgh ") for _ in range(W.K + W.WINDOW - 1))
        a, b = ("".join(rnd.choice("abcdefgh ") for _ in range(rnd.randrange(300))) for _ in range(2))
        x, y = W.winnow(W.code_points(a + shared + b))[0], W.winnow(W.code_points(b + shared + a))[0]
        assert set(x.tolist()) & set(y.tolist())


def expected(rows):
    order = sorted(((d is not None, d or 0, t or ""), d, t or "") for d, t in rows)
    out = []
    for i, (_, d, t) in enumerate(order):
        following = order[(i + 1) % len(order)][2]
        q = len(t) // 4
        new = t[: len(t) - q] + following[:q]
        fp = {x: W.digest(*W.winnow(W.code_points(x))) for x in (t, new)}
        s = {x: set(W.winnow(W.code_points(x))[0].tolist()) for x in (t, new, following)}
        like = lambda a, b: 1.0 if not a and not b else len(a & b) / len(a | b)
        out.append((d, len(t), hashlib.sha256(new.encode()).hexdigest(), fp[t], fp[new], like(s[t], s[new]), like(s[t], s[following])))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def got(df):
    return sorted((tuple(r)[:7] for r in W.compare_edited(df).collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def test_documents(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(docs) == expected(rows)
    monkeypatch.setattr(W, "RANGE_ROWS", 7)
    assert got(docs) == expected(rows)
    assert np.mean([r[5] for r in expected(rows)]) > 0.4


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(W, "RANGE_ROWS", 2)
    long = "x y z " * 30000
    rows = [(5, "some text here that goes on and on", 1), (5, "another text", 1), (7, None, 1), (9, "", 1), (11, "é" * 40, 1), (12, long, 2), (12, long, 2), (None, "no id", 1), (None, "a null id too", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, r int")
    assert got(df) == expected([r[:2] for r in rows])
    assert got(df.where("doc_id = 11")) == expected([(11, "é" * 40)])
    assert W.compare_edited(df.limit(0)).count() == 0
    assert W.fingerprints(df, "doc_id", "text").count() == len(rows)
