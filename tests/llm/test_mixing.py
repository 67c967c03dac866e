import hashlib
import math
import random

from tessera.llm import mixing as M


def made(seed: int, n: int = 400):
    rnd = random.Random(seed)
    sources = ["a", "b", "c", "d", "é", None, "empty"]
    share = [200, 60, 30, 5, 3, 10, 4]
    rows = [(d, None if (s := rnd.choices(sources, share)[0]) == "empty" else " ".join("w" * rnd.randrange(1, 4) for _ in range(rnd.randrange(60))), s) for d in range(n)]
    return rows + [(5, "one two three", "a"), (5, "one two three", "a"), (None, "no id at all", "b")]


def brute(rows, quality):
    """(source, size, taken) sums and each row's size, source size and target, by the definition."""
    size = lambda t: len((t or "").encode().split())
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    own = {n: sum(size(t) for _, t, s in rows if s == n) for n in names}
    total, weight = sum(own.values()), {n: k % 3 + 1 for k, n in enumerate(names)}
    target, free = {}, list(names)
    while free:
        left, all_weight = total - sum(target.values()), sum(weight[n] for n in free)
        over = [n for n in free if left * weight[n] / all_weight > 3 * own[n]]
        if not over:
            target |= {n: left * weight[n] / all_weight for n in free}
            break
        target |= {n: 3.0 * own[n] for n in over}
        free = [n for n in free if n not in over]

    def key(d):
        u = (int(hashlib.md5(str(d if d is not None else "").encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
        return -math.log(u) / M.QUALITY.get(quality.get(d), 1.0)

    out = []
    for n in names:
        want = math.floor(target[n] + 0.5)
        epochs = want // own[n] if own[n] else 0
        left = want - epochs * own[n]
        for _, _, d, z in sorted((key(d), (d is not None, d or 0), d, size(t)) for d, t, s in rows if s == n):
            part = max(0, min(z, left))
            left -= part
            out.append((d, z, own[n], target[n], epochs * z + part))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def test_against_brute_force(spark, monkeypatch):
    for seed, bins in ((1, 2000), (2, 20)):
        monkeypatch.setattr(M, "BIN_ROWS", bins)
        rows, rnd = made(seed), random.Random(seed)
        quality = {d: rnd.randrange(2) for d in range(0, 400, 3)}
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
        labels = spark.createDataFrame([(d, q, 0) for d, q in quality.items()] + [(None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
        mixed = lambda df: sorted((tuple(r[c] for c in ("doc_id", "size", "source_size", "target", "taken")) for r in M.mix(M.sized(df, labels)).collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))  # noqa: E731, B023
        got, expected = mixed(docs), brute(rows, quality)
        assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in expected]
        assert all(math.isclose(a[3], b[3], rel_tol=1e-12) for a, b in zip(got, expected))
        assert mixed(docs.repartition(7)) == got  # reruns agree
        assert all(r[4] <= 3 * r[1] for r in got)


def test_quality_weighs(spark):
    rows = [(d, "ten words " * 5, "a" if d < 4000 else "bc"[d % 2]) for d in range(6000)]
    labels = spark.createDataFrame([(d, d % 2, 0) for d in range(4000)], "doc_id long, quality int, toxic int")
    got = M.mix(M.sized(spark.createDataFrame(rows, "doc_id long, text string, source string"), labels)).collect()
    partial = [r for r in got if r.source == "a"]  # weight 1 of 6: a quarter of an epoch
    good, bad = (sum(r.taken for r in partial if r.doc_id % 2 == q) for q in (1, 0))
    assert good + bad == 10_000 and good > 2 * bad


def test_odd_tables(spark):
    rows = [(1, None, None, 1.0, "x"), (2, "", None, 1.0, "x"), (3, "w " * 300_000, "a", 2.0, "y"), (4, "w", "a", 2.0, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, target double, bin string")
    got = {r.doc_id: (r.size, r.taken) for r in M.mix(M.sized(df)).collect()}
    assert got == {1: (0, 0), 2: (0, 0), 3: (300_000, 300_000), 4: (1, 1)}
    assert M.mix(M.sized(df.limit(0))).count() == 0
