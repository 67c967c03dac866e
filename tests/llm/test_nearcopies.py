import random

import numpy as np
import pytest

import corpus_pipeline as P
from tessera.llm import nearcopies

pytestmark = pytest.mark.usefixtures("small")


def grams(text: str | None) -> set:
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def groups(rows: list[tuple[int, str | None]]) -> dict:
    """Smallest id of each component of all pairs of Jaccard >= 0.8, by brute force."""
    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if min(len(a), len(b)) * 5 >= max(len(a), len(b)) * 4 and 5 * len(a & b) >= 4 * len(a | b):
                root[find(i)] = find(j)
    least: dict = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(doc, least.get(find(i), doc))
    return {doc: least[find(i)] for i, (doc, _) in enumerate(rows)}


def planted() -> list[tuple[int, str | None]]:
    """Edited copies about the threshold, a dense group, a passage that many share, short and empty texts."""
    rnd = random.Random(3)
    fresh = lambda n: [f"w{rnd.randrange(5000)}" for _ in range(n)]
    texts: list = []
    for n in (40, 150, 300, 900):
        for share in (0.005, 0.01, 0.02, 0.025, 0.03, 0.04):
            base = fresh(n)
            texts += [base, [w if rnd.random() > share else f"x{rnd.randrange(5000)}" for w in base]]
    base, passage = fresh(120), fresh(30)
    texts += [[w if rnd.random() > 0.012 else f"x{rnd.randrange(5000)}" for w in base] for _ in range(60)]
    texts += [fresh(k) + passage for k in range(0, 60)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    return rows + [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "One  TWO"), (905, "one two three")]


def test_against_brute_force(spark):
    rows = planted()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in nearcopies.near_copies(df).collect()}
    assert got == groups(rows)
    assert nearcopies.near_copies(df.limit(0)).count() == 0


def test_sample_of_frequent_shingles_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(nearcopies, "SAMPLE", 1)
    rows = planted()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in nearcopies.near_copies(df).collect()} == groups(rows)


def test_prefix_and_bitmap():
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for n in range(1, 60):
        a = np.arange(n, dtype=np.uint64)
        assert len(nearcopies.prefix(a, *none)) == n - -(-4 * n // 5) + 1
    a, b = np.arange(0, 100, dtype=np.uint64), np.arange(7, 112, dtype=np.uint64)
    assert np.bitwise_count((nearcopies.bitmap(a) ^ nearcopies.bitmap(b)).view(np.uint64)).sum() <= 19


def test_stage_drops_edited_copies(spark):
    """The pipeline's stage keeps one document of each group, which fingerprints within 3 bits do not give."""
    rows = [(i, t, "en", "a", len(t or "")) for i, t in planted()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in P.drop_near_duplicates(spark, docs, "").collect()}
    assert kept == set(groups([r[:2] for r in rows]).values())
