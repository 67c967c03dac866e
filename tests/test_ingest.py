import pytest

from tessera.plans import scenarios as S
from tessera.providers import Rules
from tessera.streaming import ingest as I

pytestmark = pytest.mark.usefixtures("small")


def base_and_files(spark, tmp_path, monkeypatch, **more):
    """A base, two folders with an entry each, and a merge that only adds."""
    monkeypatch.setattr(I.dedup, "merge_into_base", lambda entries, new, matches, cache, *a: (entries.unionByName(new), {"updated": 0, "added": 1}, cache))
    base = S.Base(spark, S.Settings(name="base", output_dir=str(tmp_path), categories={"a": "A"}, **more))
    for k in (1, 2):
        row = (k, "a", f"question {k}", f"answer {k}", "f", [k], {}, "2026-01-01", "")
        spark.createDataFrame([row], S.ENTRY).coalesce(1).write.parquet(f"{tmp_path}/in{k}")
    return base


def test_a_second_stream_is_not_taken_for_a_replay(spark, tmp_path, monkeypatch):
    base = base_and_files(spark, tmp_path, monkeypatch)
    monkeypatch.setattr(I.candidates, "candidate_matches", lambda *a, **k: None)
    run = lambda k: I.ingest(spark, base, f"{tmp_path}/in{k}", f"{tmp_path}/check{k}", Rules({"a": "A"}), "2026-01-01")
    assert [run(1), run(1), run(2)] == [1, 0, 1]
    assert sorted(r.ord for r in base.entries().collect()) == [1, 2]
    # a batch that is delivered again: its commit is lost, the ledger has it
    for name in ("0", ".0.crc"):
        (tmp_path / "check2" / "commits" / name).unlink()
    assert run(2) == 0 and base.entries().count() == 2


def test_embeddings_reach_the_candidates(spark, tmp_path, monkeypatch):
    base = base_and_files(spark, tmp_path, monkeypatch, embeddings=True)
    given = []
    monkeypatch.setattr(I.candidates, "candidate_matches", lambda new, entries, embeddings=None, **k: given.append(embeddings and [e.count() for e in embeddings]))
    assert I.ingest(spark, base, f"{tmp_path}/in1", f"{tmp_path}/check1", Rules({"a": "A"}), "2026-01-01") == 1
    assert given == [[1, 0]]


def test_the_same_batch_twice_with_real_merges(spark, tmp_path):
    """Entries that match replace, others are added; a batch that comes again changes nothing."""
    provider = Rules(["a"])
    base = S.Base(spark, S.Settings(name="base", output_dir=str(tmp_path), categories={"a": "A"}, merge_strategy="replace"))
    first = [(0, "a", "how do I reset the password", "press reset", "f", [1], {}, "2025-01-01", None), (1, "a", "where is the form", "on the page", "f", [2], {}, "2025-01-01", None)]
    base.commit(spark.createDataFrame(first, S.ENTRY))
    more = [(5, "a", "how do I reset the password please", "press reset twice", "g", [7], {}, "2026-01-01", None), (6, "a", "who signs the lease", "the manager", "g", [8], {}, "2026-01-01", None)]
    spark.createDataFrame(more, S.ENTRY).coalesce(1).write.parquet(f"{tmp_path}/in")
    run = lambda: I.ingest(spark, base, f"{tmp_path}/in", f"{tmp_path}/check", provider, "2026-01-01")
    assert run() == 1
    rows = [(r.ord, r.answer, r.source_rows) for r in base.entries().orderBy("ord").collect()]
    assert rows == [(0, "press reset twice", [7]), (1, "on the page", [2]), (2, "the manager", [8])]
    for name in ("0", ".0.crc"):
        (tmp_path / "check" / "commits" / name).unlink()
    assert run() == 0 and [(r.ord, r.answer, r.source_rows) for r in base.entries().orderBy("ord").collect()] == rows
    assert base.ledger()[0]["updated"] == 1 and base.ledger()[0]["added"] == 1
