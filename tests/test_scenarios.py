import time

import pytest

from tessera import cli
from tessera.operators import state
from tessera.plans import scenarios as S
from tessera.providers import Blocked, RateLimited, Retry, Rules
from tessera.sources import sheet

pytestmark = pytest.mark.usefixtures("small")
FAST = {"attempts": 2, "pause": 0.0}
CATEGORIES = {"access": "Access", "forms": "Forms"}


class Counting(Rules):
    """Writes a line for each call, so calls of all workers can be counted."""

    def __init__(self, categories, path):
        super().__init__(categories)
        self.path = path

    def _note(self, what):
        with open(self.path, "a") as f:
            f.write(what + "\n")

    def filter(self, pair):
        self._note("filter")
        return super().filter(pair)

    def judge(self, a, b):
        self._note("judge")
        return super().judge(a, b)


ROWS = [
    ["how do I reset the password", "open the portal and press reset", "2024", "T1"],
    ["how do I reset the password please", "open the portal and press reset now", "2024", "T2"],
    ["where is the travel form", "on the page https://forms.example/t.", "2025", "T3"],
    ["my own laptop is broken", "only you can see this", "2025", "T4"],
    ["no answer here", "", "2025", "T5"],
    ["how long is the wait", "about three...", "2025", "T6"],
]


def workbook(path, rows=ROWS):
    sheet.write_cells(str(path), ["Question", "Answer", "Year", "Ticket"], rows)
    return str(path)


def settings(tmp_path, **more):
    return S.Settings(**({"name": "base", "output_dir": str(tmp_path), "categories": CATEGORIES, "source": workbook(tmp_path / "in.xlsx"), "question_columns": ("Question",), "answer_columns": ("Answer",), "extra_columns": ("Year", "Ticket", "Absent")} | more))


def test_workbook_round_trip(spark, tmp_path):
    path = tmp_path / "x.xlsx"
    sheet.write_cells(str(path), ["a", "b<c>"], [["1", None], ["é & \x07", "line\nline"]], [True, False])
    assert sheet.read_cells(str(path)) == [["a", "b<c>"], ["1", ""], ["é & ", "line\nline"]]
    df = sheet.read_sheet(spark, workbook(tmp_path / "y.xlsx"))
    rows = sheet.pairs(df, ["Question"], ["Answer"], ["Year", "Absent"]).orderBy("row_number").collect()
    assert [r.row_number for r in rows] == [2, 3, 4, 5, 6, 7] and rows[0].source_columns == {"Year": "2024"}
    with pytest.raises(ValueError, match="missing columns: Nope"):
        sheet.pairs(df, ["Nope"], ["Answer"])


def test_tickets_to_base(spark, tmp_path):
    s, log = settings(tmp_path), tmp_path / "calls"
    provider = Counting(list(CATEGORIES), str(log))
    first = S.tickets_to_base(spark, s, provider, "2026-01-01", FAST)
    base = S.Base(spark, s)
    rows = base.entries().collect()
    # T4 fails the gate, T5 has no answer, T1 and T2 are one, T6 is doubtful
    assert first == {"updated": 0, "added": 3} and len(rows) == 3
    merged = next(r for r in rows if "password" in r.question)
    assert merged.source_rows == [2, 3] and merged.source_columns["Ticket"] == "T1| T2" and merged.source_columns["Year"] == "2024"
    assert {r.doubtful is None for r in rows} == {True, False}
    assert any("https://forms.example/t" in r.answer for r in rows)
    assert len(base.ledger()) == 1
    before = log.read_text()
    assert S.tickets_to_base(spark, s, provider, "2026-01-01", FAST) == {"updated": 0, "added": 0}
    assert log.read_text() == before  # a file of a known hash asks nothing

    # the reviewer deletes a row; it stays deleted, and the view has all columns
    view = S.latest_view(base.root, "base")
    cells = sheet.read_cells(view)
    assert cells[0][:3] == ["Category", "Question", "Answer"] and {"Year", "Ticket"} <= set(cells[0])
    time.sleep(1.1)
    sheet.write_cells(view, cells[0], cells[1:-1])
    assert base.sync().count() == 2 and base.entries().count() == 2

    # a second file updates what it matches and adds the rest
    more = workbook(tmp_path / "more.xlsx", [["how do I reset the password", "open the portal and press reset today", "2026", "T9"], ["who signs the lease", "the office manager signs", "2026", "T10"]])
    again = S.tickets_to_base(spark, settings(tmp_path, source=more), provider, "2026-02-01", FAST)
    assert again["updated"] + again["added"] == 2
    for month in (3, 4, 5):  # places stay dense, however often a base is cleaned
        assert S.dedupe_base(spark, s, provider, f"2026-0{month}-01", FAST) == 0
        assert sorted(r.ord for r in base.entries().collect()) == list(range(base.entries().count()))
    # calls are noted, and a forced run asks again about a file that is known
    called = {r.caller: r.n for r in state.call_summary(base.calls()).collect()}
    assert called["filter"] == 7 and called["rewrite"] == 6 and called["judge"] >= 1
    n = log.read_text().count("filter")
    S.tickets_to_base(spark, settings(tmp_path, force=True), provider, "2026-06-01", FAST)
    assert log.read_text().count("filter") == n + 5


def test_repair(spark, tmp_path):
    good, bad = S.repair_base(spark, settings(tmp_path), Rules(list(CATEGORIES)), "2026-01-01", FAST)
    reasons = {r[1] for r in sheet.read_cells(bad)[1:]}
    assert reasons == {"empty_answer", "incomplete: it breaks off"} and len(sheet.read_cells(good)) > 2


def test_settings_and_cli(spark, tmp_path):
    source = workbook(tmp_path / "in.xlsx")
    toml = tmp_path / "s.toml"
    toml.write_text(f'name = "b"\noutput_dir = "{tmp_path}"\nsource = "{source}"\n[categories]\na = "A"\n')
    assert cli.main(["models", str(toml)]) == {"rules": "ok"}
    seen = cli.main(["inspect", str(toml)], spark=spark)
    assert [r["column"] for r in seen] == ["row_number", "Question", "Answer", "Year", "Ticket"]
    assert {r["sheet"] for r in seen} == {"Sheet1"} and seen[1]["sample"] == "how do I reset the password" and seen[1]["rows"] == 6
    for bad in ({"categories": {}}, {"merge_strategy": "x"}, {"source": "a.csv"}, {"name": "a b"}):
        with pytest.raises(ValueError):
            settings(tmp_path, **bad)
    toml.write_text('nope = 1\nname = "b"\noutput_dir = "x"\n[categories]\na = "A"\n')
    with pytest.raises(ValueError, match="unknown settings: nope"):
        S.load_settings(str(toml))


def test_retries():
    waits: list[float] = []
    retry = Retry(attempts=3, sleep=waits.append)
    replies = iter([RateLimited(), ValueError(), RateLimited(7.0), ValueError(), "x"])

    def call():
        r = next(replies)
        if isinstance(r, Exception):
            raise r
        return r

    assert retry.call("c", call) == "x"
    assert [c[2] for c in retry.calls] == ["429", "error: ValueError", "429", "error: ValueError", "ok"]
    assert 10 <= waits[0] <= 15 and waits[1] == 5.0 and 20 <= waits[2] <= 30 and waits[3] == 10.0
    waits.clear()
    replies = iter([RateLimited(70.0), "x", RateLimited(), "y"])
    assert [retry.call("c", call), retry.call("c", call)] == ["x", "y"]
    assert 70 <= waits[0] <= 105 and 10 <= waits[1] <= 15  # the server's wait, and a new start after a call went through
    assert Retry(sleep=waits.append).call("c", lambda: (_ for _ in ()).throw(Blocked())) is None


def test_state(spark):
    base = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "ord long, v string")
    out = state.upsert(base, spark.createDataFrame([(1, "B")], base.schema), spark.createDataFrame([(5, "x"), (6, "y")], base.schema))
    assert [tuple(r) for r in out.orderBy("ord").collect()] == [(0, "a"), (1, "B"), (2, "c"), (3, "x"), (4, "y")]
    assert state.same_base(base, base.orderBy("v", ascending=False)) and not state.same_base(base, base.union(base.limit(1)))
    pairs = spark.createDataFrame([(k,) for k in range(2, 8)], "row_number int")
    accepted = spark.createDataFrame([([2, 3],)], "source_rows array<int>")
    rejected = spark.createDataFrame([(4, "filter:x"), (5, "filter_failed"), (6, None), (7, "unhandled_error")], "source_row int, reason string")
    assert sorted(r[0] for r in state.unfinished(pairs, accepted, rejected).collect()) == [5, 7]
    assert sorted(r[0] for r in state.failed_rows(rejected).collect()) == [5, 7]
    ledger = spark.createDataFrame([("h1", 1), ("h2", 2)], "hash string, n int")
    assert sorted(tuple(r) for r in state.register(ledger, spark.createDataFrame([("h1", 9)], ledger.schema)).collect()) == [("h1", 9), ("h2", 2)]
    calls = spark.createDataFrame([("a", 1.0, "ok"), ("a", 3.0, "429"), ("b", 9.0, "error: X"), ("b", 1.0, "blacklist")], "caller string, seconds double, result string")
    assert [tuple(r) for r in state.call_summary(calls).collect()] == [("b", 2, 1, 0, 1, 5.0, 9.0, 10.0), ("a", 2, 0, 1, 0, 2.0, 3.0, 4.0)]
    assert [tuple(r) for r in state.reason_histogram(rejected.union(rejected.limit(1))).collect()][0] == ("filter:x", 2)
    assert tuple(state.totals(accepted.selectExpr("*", "'d' AS doubtful"), rejected).first()) == (1, 1, 2, 2, 5)
    assert [r.hash for r in state.is_merged(spark.createDataFrame([("h1",), ("h9",)], "hash string"), ledger).collect()] == ["h1"]
    placed = spark.createDataFrame([(k * 7919 % 1000, k) for k in range(1000)], "p long, v long").repartition(9)
    assert [(r.p, r.ord) for r in state.dense(placed, "p").orderBy("ord").collect()] == [(k, k) for k in range(1000)]
