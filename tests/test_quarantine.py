"""Streamed rows and their rules: what is kept, quarantined and counted, also when a batch is handed on again."""

import json

import pytest

from goldleaf.sources import files
from goldleaf.streaming import ingest, quarantine

SCHEMA = "id int, n int"
RULES = {"has_id": "id IS NOT NULL", "positive": "n > 0"}
LANDED = {
    "1.json": [(1, 5), (None, 5), (2, None)],
    "2.json": [(None, -1), (3, 1), (3, 1)],
    "3.json": [],
    "4.json": [(4, 0)],
}


@pytest.fixture
def place(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    stream = files.stream_files(spark, str(landing), SCHEMA, "json", files_per_batch=1)

    def run(*names):
        for name in names:
            (landing / name).write_text("".join(json.dumps({"id": i, "n": n}) + "\n" for i, n in LANDED[name]))
        ingest.run_to_end(quarantine.append_checked(stream, lambda df: df, RULES, str(tmp_path / "out"), str(tmp_path / "ck")))

    return run, str(tmp_path / "out"), stream.schema


def state(spark, folder, schema, rows):
    good = rows(quarantine.good_rows(spark, folder, schema))
    bad = rows(quarantine.quarantined_rows(spark, folder, schema), "id", "n", quarantine.VIOLATED)
    counts = quarantine.rule_counts(spark, folder).groupBy("rule").sum("passed", "failed")
    return good, bad, rows(counts)


GOOD = [(1, 5), (3, 1), (3, 1)]
BAD = [(2, None, ["positive"]), (4, 0, ["positive"]), (None, -1, ["has_id", "positive"]), (None, 5, ["has_id"])]
COUNTS = [("has_id", 5, 2), ("positive", 4, 3)]


def test_good_rows_quarantine_and_counts(spark, place, rows):
    run, folder, schema = place
    run("1.json", "2.json")
    run("3.json", "4.json")
    found = state(spark, folder, schema, rows)
    run()  # nothing has landed
    assert found == state(spark, folder, schema, rows)
    assert found[0] == GOOD and sorted(map(str, found[1])) == sorted(map(str, BAD)) and found[2] == COUNTS


@pytest.mark.parametrize("step", ["write_rows", "write_counts"])
def test_a_batch_handed_on_again_changes_nothing(spark, place, rows, monkeypatch, step):
    """The driver is lost after a step of the second batch has been done; the next run is given that batch again."""
    run, folder, schema = place
    run("1.json")
    done = getattr(quarantine, step)

    def lost(*given):
        done(*given)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(quarantine, step, lost)
        with pytest.raises(Exception, match="driver lost"):
            run("2.json")
    run("3.json", "4.json")
    found = state(spark, folder, schema, rows)
    assert found[0] == GOOD and sorted(map(str, found[1])) == sorted(map(str, BAD)) and found[2] == COUNTS


def test_reserved_names(spark, tmp_path):
    stream = files.stream_files(spark, str(tmp_path), "id int, Verdict string", "json")
    with pytest.raises(ValueError, match="verdict"):
        quarantine.append_checked(stream, lambda df: df, RULES, str(tmp_path / "o"), str(tmp_path / "c"))
