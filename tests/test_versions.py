"""Stores that switch versions: a job killed between any two steps leaves the old rows."""

import os
from datetime import date

import pytest

from scoremill.schemas import MODEL, PREDICTIONS, PSI_RESULTS, SNAPSHOT
from scoremill.sources import reports, versions

JAN, FEB = date(2024, 1, 1), date(2024, 2, 1)
ODD = "m: 50%/a=b"


def predictions(spark, *rows):
    return spark.createDataFrame([("c", day, model, score) for model, day, score in rows], PREDICTIONS)


def stored(spark, root):
    return sorted((r[MODEL], r[SNAPSHOT], r["model_predictions"]) for r in reports.read_predictions(spark, root).collect())


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    root = str(tmp_path / "store")
    assert stored(spark, root) == []
    reports.write_predictions(predictions(spark, ("m", JAN, 0.1), ("m", FEB, 0.2), (ODD, JAN, 0.3)), root)
    reports.write_predictions(predictions(spark, ("m", FEB, 0.4)), root)
    assert stored(spark, root) == sorted([("m", JAN, 0.1), ("m", FEB, 0.4), (ODD, JAN, 0.3)])
    nothing = predictions(spark, ("m", FEB, 0.4)).limit(0)
    reports.write_predictions(nothing, root, [{MODEL: ODD, SNAPSHOT: JAN}, {MODEL: "unknown", SNAPSHOT: JAN}])
    assert stored(spark, root) == [("m", JAN, 0.1), ("m", FEB, 0.4)]
    assert versions.current(spark, root)[0] == 3


@pytest.mark.parametrize("step", ["before", "half written", "written", "listed", "renamed"])
def test_a_killed_writer_leaves_the_old_rows(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path / "store")
    reports.write_predictions(predictions(spark, ("m", JAN, 0.1), ("m", FEB, 0.2)), root)

    class Killed(BaseException):
        pass

    def die(*_):
        raise Killed

    write, put = versions._write, versions._Files.put

    def half(df, *rest):
        write(df.filter("model_predictions < 0.4"), *rest)
        raise Killed

    with monkeypatch.context() as patch:
        if step == "before":
            patch.setattr(versions, "_write", die)
        elif step == "half written":
            patch.setattr(versions, "_write", half)
        elif step == "written":
            patch.setattr(versions, "_switch", die)
        elif step == "listed":
            patch.setattr(versions._Files, "rename", die)
        else:
            patch.setattr(versions._Files, "put", lambda *a: (put(*a), die()))
        with pytest.raises(Killed):
            reports.write_predictions(predictions(spark, ("m", JAN, 0.3), ("m", FEB, 0.4)), root)
    old = [("m", JAN, 0.1), ("m", FEB, 0.2)]
    assert stored(spark, root) == old
    versions.sweep(spark, root, reports.BY_RUN, older_than=-60)
    assert stored(spark, root) == old
    reports.write_predictions(predictions(spark, ("m", JAN, 0.3), ("m", FEB, 0.4)), root)
    assert stored(spark, root) == [("m", JAN, 0.3), ("m", FEB, 0.4)]


def test_of_two_writers_none_is_lost(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    reports.write_predictions(predictions(spark, ("m", JAN, 0.1)), root)
    rename, raced = versions._Files.rename, []

    def slow(self, old, new):
        if not raced:
            raced.append(new)
            reports.write_predictions(predictions(spark, ("other", JAN, 0.7)), root)
        return rename(self, old, new)

    monkeypatch.setattr(versions._Files, "rename", slow)
    reports.write_predictions(predictions(spark, ("m", FEB, 0.2)), root)
    assert stored(spark, root) == [("m", JAN, 0.1), ("m", FEB, 0.2), ("other", JAN, 0.7)]
    assert versions.current(spark, root)[0] == 3


def test_sweep_keeps_what_recent_lists_name(spark, tmp_path):
    root = str(tmp_path / "store")
    for i in range(4):
        reports.write_predictions(predictions(spark, ("m", JAN, i / 10)), root)
    assert versions.sweep(spark, root, reports.BY_RUN) == []  # all are young
    earlier = versions.read(spark, root, PREDICTIONS, number=3)
    assert len(versions.sweep(spark, root, reports.BY_RUN, keep=2, older_than=-60)) == 2
    assert stored(spark, root) == [("m", JAN, 0.3)]
    assert [r["model_predictions"] for r in earlier.collect()] == [0.2]
    assert len(os.listdir(tmp_path / "store" / f"{MODEL}=m" / f"{SNAPSHOT}=2024-01-01")) == 2


def test_readers_see_one_version_while_another_is_written(spark, tmp_path):
    """Reading and rewriting the same partitions in one plan is safe: files are never touched."""
    root = str(tmp_path / "history")
    row = ("m", JAN, date(2023, 12, 1), "debt", 0.05, "Low")
    reports.write_psi_history(spark.createDataFrame([row], PSI_RESULTS), root)
    before = reports.read_psi_history(spark, root)
    reports.write_psi_history(spark.createDataFrame([(*row[:3], "income", 0.3, "High")], PSI_RESULTS), root)
    reports.write_psi_history(spark.createDataFrame([(*row[:4], 0.15, "Medium")], PSI_RESULTS), root)
    assert [r["psi_value"] for r in before.collect()] == [0.05]
    after = {r["feature_name"]: r["psi_value"] for r in reports.read_psi_history(spark, root).collect()}
    assert after == {"debt": 0.15, "income": 0.3}
