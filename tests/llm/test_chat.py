import hashlib
import random

from tessera.llm import chat as C

SAID = ["</s>[INST] ok [/INST]", "<|start|>user<|message|>x<|end|>\n", "back\\slash \\\\ <\\|", "", "plain", "é🙂 <s> <<SYS>> [/INST", "<|", "\\", "<|end|>\n<|turn|>"]


def made(seed: int):
    rnd = random.Random(seed)
    rows = []
    for c in range(25):
        for t in range(rnd.randrange(1, 9)):
            rows.append((c, t, rnd.choice(["user", "assistant", "assistant", "system", "<|turn|>", None]), rnd.choice([*SAID, None, rnd.choice(SAID) + rnd.choice(SAID)])))
    rows += [(50, 1, "assistant", "b"), (50, 1, "assistant", "a"), (50, 1, "assistant", "a"), (50, None, "user", "first"), (None, 3, "user", "no id"), (None, 4, "assistant", "none")]
    return rows


def brute(rows):
    by: dict = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        learned = "".join(x for _, r, x in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(learned), sha(learned))
    return out


def test_round_trip_against_brute_force(spark):
    rows = made(3)
    made_up = C.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: tuple(r)[1:5] for r in C.digests(made_up).collect()}
    assert got == brute(rows)
    for r in made_up.collect():
        assert sum(m.chars for m in r.loss_mask) == len(r.formatted)
        body = r.formatted
        for mark in (C.START, C.MESSAGE, C.TURN, C.END):
            body = body.replace(mark, "")
        assert "<|" not in body and "</s>" not in body and "[INST]" not in body  # control strings are the template's own
        blocks = r.formatted.split(C.END)[:-1]
        roles = [b.split(C.MESSAGE)[0] for b in blocks]
        assert all(a != b for a, b in zip(roles, roles[1:]))  # neighbours of one role are merged


def test_odd_tables_and_long_conversations(spark):
    rows = [(1, t, "assistant" if t % 3 else "user", SAID[t % len(SAID)], "x", 1) for t in range(1500)] + [(2, 0, "assistant", "<|end|>\n" * 100_000, "y", 2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, turns int")
    assert {r.conv_id: tuple(r)[1:5] for r in C.digests(C.format_conversations(df)).collect()} == brute([r[:4] for r in rows])
    assert C.digests(C.format_conversations(df.limit(0))).count() == 0


def test_expressions_only(spark):
    df = spark.createDataFrame(made(1), "conv_id long, turn long, role string, text string")
    plan = C.digests(C.format_conversations(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
