import random

import numpy as np
import pytest
import xxhash

from tessera.llm import simhash

pytestmark = pytest.mark.usefixtures("small")


def brute(rows: list[tuple[int, str | None]]) -> dict:
    """Fingerprints bit by bit, all pairs, components by union."""
    fps = []
    for _, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = [w for w in "".join(" " if c in "\t\n\x0b\f\r" else c for c in low).split(" ") if w]
        grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                parent[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        least[r] = min(least.get(r, doc), doc)
    return {(rows[i][0], f"{fps[i]:016x}", least[find(i)]) for i in range(len(rows))}


def test_against_brute_force(spark, sf):
    from tessera.llm.queries import op2_simhash

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = op2_simhash(spark, sf).collect()
    assert len(got) == len(rows)
    assert {tuple(r) for r in got} == brute(rows)


def test_every_link_shares_a_key():
    rnd = np.random.default_rng(5)
    for _ in range(4000):
        a = int(rnd.integers(0, 1 << 63)) * 2 + int(rnd.integers(0, 2))
        b = a
        for bit in rnd.choice(64, int(rnd.integers(1, 4)), replace=False):
            b ^= 1 << int(bit)
        pair = np.array([a, b], np.uint64)
        keys = simhash.ring_keys(pair)
        same = np.flatnonzero(keys[:, 0] == keys[:, 1])
        assert any(simhash.linked(pair[:1] ^ pair[1:], int(k) // 2)[0] for k in same)


def test_dense_groups_and_chains(spark):
    rnd = random.Random(2)
    values = set()
    for _ in range(4):  # groups that spread three bits at a time
        at = rnd.getrandbits(64)
        for _ in range(150):
            values.add(at)
            for _ in range(rnd.randrange(1, 4)):
                at ^= 1 << rnd.randrange(64)
    values |= {rnd.getrandbits(64) for _ in range(200)} | {0, (1 << 64) - 1}
    values = sorted(values)
    df = spark.createDataFrame([(simhash.signed(v),) for v in values], "fp long")
    got = {r.node: r.root for r in simhash.components(simhash.links(df)).collect()}
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 3:
                parent[find(a)] = find(b)
    groups: dict[int, set] = {}
    for v in values:
        groups.setdefault(find(v), set()).add(simhash.signed(v))
    expected = {m: min(g) for g in groups.values() for m in g if m != min(g)}
    assert got == expected


def test_odd_rows(spark):
    rows = [(5, None, 1), (4, "", 1), (9, "  \n", 2), (7, "One two", 3), (7, "one  TWO", 3), (None, "one two", 4), (3, "word " * 30000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp long")
    got = simhash.near_duplicates(df).collect()
    assert sorted((r.doc_id or -1, r.component_id) for r in got) == [(-1, 7), (3, 3), (4, 4), (5, 4), (7, 7), (7, 7), (9, 4)]
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    one = simhash.near_duplicates(df.where("doc_id = 3")).collect()
    assert [r.component_id for r in one] == [3]


def test_large_keys_are_dealt_again(spark):
    """Fingerprints that all share keys, held by no task, link as others do."""
    rnd = random.Random(6)
    base = rnd.getrandbits(64)
    values = {base}
    while len(values) < 400:
        v = base
        for bit in rnd.sample(range(64), rnd.randrange(1, 6)):
            v ^= 1 << bit
        values.add(v)
    df = spark.createDataFrame([(simhash.signed(v),) for v in sorted(values)], "fp long")
    plain, again = ({tuple(r) for r in simhash.components(simhash.links(df, held=h)).collect()} for h in (simhash.HELD, 3))
    assert plain == again and plain


def test_hot_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT_ROWS", 3)
    rows = [(k, "the same words again and again" if k % 2 else f"other words {k} of its own kind") for k in range(60)] + [(None, None), (100, "")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, f"{r.fp % 2**64:016x}", r.component_id) for r in got), key=str) == sorted(brute_nulls(rows), key=str)


def brute_nulls(rows):
    """As brute, null ids ignored when the smallest is sought."""
    big = 1 << 60
    return {(None if d == big else d, fp, None if c == big else c) for d, fp, c in brute([(big if d is None else d, t) for d, t in rows])}
