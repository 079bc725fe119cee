"""Copies that are run again."""

from __future__ import annotations

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerline import sources
from ledgerline.sources import incremental

COLUMNS = ["id", "text"]


@pytest.fixture
def places(tmp_path):
    (tmp_path / "source" / "deep").mkdir(parents=True)
    return tmp_path / "source", str(tmp_path / "target")


def put(path, text, at):
    path.write_text(text)
    os.utime(path, (at, at))


@pytest.fixture
def copy(spark, places):
    def run(**options):
        found = sources.copy_incremental(spark, str(places[0]), places[1], COLUMNS, **options).collect()
        return {Path(r.file).name: (r.status, r.n_rows) for r in found}

    return run


def test_runs_copy_what_is_new_or_changed(spark, places, copy, rows):
    source, target = places
    put(source / "a.csv", "id,text\n1,x\n2,\n", 1_000)
    put(source / "b b%[1].csv", 'id,text\n3,""\n', 1_000)
    put(source / "deep" / "a.csv2", "id,text\n9,z\n", 1_000)
    assert sorted(copy().values()) == [("new", 1), ("new", 1), ("new", 2)]
    first = [("1", "x"), ("2", None), ("3", ""), ("9", "z")]
    assert rows(sources.read_copied(spark, target, COLUMNS)) == rows(spark.createDataFrame(first, "id string, text string"))
    folders = set(Path(target, "data").glob("*/*"))
    again = copy()
    assert {s for s, _ in again.values()} == {"same"} and set(Path(target, "data").glob("*/*")) == folders
    put(source / "a.csv", "id,text\n2,\n1,x\n", 2_000)  # the same rows in another order
    put(source / "deep" / "a.csv2", "id,text\n", 2_000)  # no rows any more
    put(source / "c.csv", "id,text\n1,x\n1,x\n", 2_000)
    (source / "b b%[1].csv").unlink()
    done = copy()
    assert done.pop("a.csv") == ("touched", 2) and done.pop("a.csv2") == ("changed", 0) and done.pop("c.csv") == ("new", 2)
    assert set(done.values()) == {("vanished", 1)}
    now = [("1", "x"), ("1", "x"), ("1", "x"), ("2", None), ("3", "")]
    assert rows(sources.read_copied(spark, target, COLUMNS)) == rows(spark.createDataFrame(now, "id string, text string"))
    assert {s for s, _ in copy().values()} == {"same", "vanished"}


def test_a_run_that_fails_is_not_seen_and_can_be_repeated(spark, places, copy, rows, monkeypatch):
    source, target = places
    put(source / "a.csv", "id,text\n1,x\n", 1_000)
    copy()
    put(source / "a.csv", "id,text\n1,new\n", 2_000)
    real = incremental.merge_rows

    def broken(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(incremental, "merge_rows", broken)
    with pytest.raises(RuntimeError, match="lost"):
        copy()
    assert rows(sources.read_copied(spark, target, COLUMNS)) == [("1", "x")]
    monkeypatch.setattr(incremental, "merge_rows", real)
    assert copy() == {"a.csv": ("changed", 1)}
    assert rows(sources.read_copied(spark, target, COLUMNS)) == [("1", "new")]


def test_line_breaks_and_encoding(spark, places, copy, rows):
    source, target = places
    (source / "a.csv").write_bytes('id,text\n1,"é\nx"\n'.encode("latin-1"))
    options = {"encoding": "ISO-8859-1", "multi_line": True}
    copy(**options)
    assert rows(sources.read_copied(spark, target, COLUMNS, **options)) == [("1", "é\nx")]


def test_empty_source(spark, places, copy):
    assert copy() == {}
    assert sources.read_copied(spark, places[1], COLUMNS).select(F.count("*")).first()[0] == 0
