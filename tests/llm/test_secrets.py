import hashlib
import random
import re

from pyspark.sql import functions as F

from tessera.llm import cuts
from tessera.llm import secrets as S

ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text: str) -> list[tuple[int, int, int, str]]:
    out = [(m.start(), 0, m.end(), m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    out += [(m.start(), 1, m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end(), m[0]) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return out


def brute(rows):
    """rows: (doc_id, text, source)."""
    found, holders = [], {}
    for d, t, s in rows:
        t = t or ""
        b = base(t)
        extra = [(m.start(), 3, m.end(), m[0]) for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", t)]
        extra = [x for x in extra if re.search("[0-9]", x[3]) and re.search("[A-Za-z]", x[3]) and not any(y[0] < x[2] and x[0] < y[2] for y in b)]
        found.append((d, b, extra))
        for x in b + extra:
            holders.setdefault(x[3], set()).add((d, s))
    out = []
    for d, b, extra in found:
        owners = lambda x: len({s for _, s in holders[x[3]]})
        wide = lambda x: owners(x) >= S.WIDE_OWNERS or len(holders[x[3]]) >= S.WIDE_REPOSITORIES
        own = [x for x in extra if owners(x) == 1 and not wide(x)]
        join = lambda xs: ",".join(f"{S.KINDS[k]}:{a}:{e}" for a, k, e, _ in sorted(xs))
        n = [sum(x[1] == k for x in b) for k in range(3)]
        out.append((d, *n, hashlib.sha256(join(b).encode()).hexdigest(), join(b + own), len(own), sum(not wide(x) for x in b), sum(wide(x) for x in b)))
    return sorted(out, key=str)


def made(seed: int):
    rnd = random.Random(seed)
    key = lambda n, alphabet="abcdef0123456789": "".join(rnd.choice(alphabet) for _ in range(n))
    shared = [key(40), "AKIA" + key(16, "ABCDEFG0123"), key(24, "XYZabc019_"), key(30, "XYZabc019/")]
    kinds = [
        lambda: f"password = {key(rnd.choice([11, 12, 20]), 'aZ9+/_.=-')}", lambda: f"\"API_KEY\": '{key(14, 'aZ9')}'", lambda: "Token:" + key(12, "xyz"), lambda: "AKIA" + key(rnd.choice([13, 14, 20]), "AB12"),
        lambda: key(rnd.choice([15, 16, 33])), lambda: key(rnd.choice([19, 20, 45]), "aZ9_-"), lambda: rnd.choice(shared), lambda: "secret=" + rnd.choice(shared), lambda: "plain words é🙂", lambda: "\n",
    ]
    rows = [(d, " ".join(rnd.choice(kinds)() for _ in range(rnd.randrange(12))), f"s{rnd.randrange(7)}") for d in range(80)]
    rows += [(100 + d, f"copied {shared[2]} here", "one") for d in range(S.WIDE_REPOSITORIES)]
    return rows + [(200, None, "s1"), (201, "", None), (202, f"password={shared[0]}", None), (202, f"password={shared[0]}", None), (None, "token=abcdefghijkl1", "s1")]


def result(df):
    return sorted((tuple(r) for r in S.report(S.scan(df)).collect()), key=str)


def test_against_brute_force(spark):
    for seed in (1, 2):
        rows = made(seed)
        assert result(spark.createDataFrame(rows, "doc_id long, text string, source string")) == brute(rows)


def test_documents(spark, sf):
    from tessera.llm.queries import op7_secrets

    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in op7_secrets(spark, sf).collect()), key=str) == brute(rows)


def test_odd_tables_and_long_texts(spark):
    rows = [(1, " ".join(f"{k:020x} x" for k in range(3000)), "s", "clash", "clash"), (2, "word " * 200_000, "s", None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, base string, owned string")
    assert result(df) == brute([r[:3] for r in rows])
    assert S.report(S.scan(df.limit(0))).count() == 0


def test_masking(spark):
    rows = [("0123456789", [(1, 3), (2, 5), (5, 6), (8, 10)]), ("é🙂ab", [(0, 2)]), ("none", []), ("x" * 500, [(5 * k, 5 * k + 2) for k in range(100)])]
    df = spark.createDataFrame(rows, "t string, s array<struct<start:int,end:int>>")
    got = [r[0] for r in df.select(S.masked(F.col("t"), F.col("s"), "*")).collect()]
    assert got == ["0**67*", "*ab", "none", "*xxx" * 100]


def test_cuts(spark):
    rows = [("añ🙂defg" * 60, [k % 4 for k in range(200)]), ("abc", []), ("", [0, 0]), ("abc", [2])]
    df = spark.createDataFrame(rows, "t string, n array<int>")
    for (t, n), (parts, at) in zip(rows, df.select(cuts.pieces(F.col("t"), F.col("n")), cuts.offsets(F.col("n"))).collect()):
        starts = [sum(n[:k]) for k in range(len(n))]
        assert at == starts and parts == [t[a : a + m] for a, m in zip(starts, n)]
