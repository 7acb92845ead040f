import glob
from datetime import datetime, timezone

import pytest

from tideline.sources.progress import SLOTS, ProgressStore
from tideline.specs import Progress, TableSpec

T = datetime(2024, 6, 15, 14, 30)


def files(folder):
    return glob.glob(f"{folder}/**/*.parquet", recursive=True)


def test_unknown_table_has_none(spark, folder):
    store = ProgressStore(spark, f"{folder}/p")
    assert store.get("t").is_zero and store.snapshot() == {}
    rows = store.load([TableSpec("t", "ts", "id")]).collect()
    assert [(r.table, r.ts, r.last_identifier) for r in rows] == [("t", None, None)]


def test_persisted_only_by_flush(spark, folder):
    store = ProgressStore(spark, f"{folder}/p")
    store.set("a", Progress(T, "x"))
    assert store.get("a") == Progress(T, "x") and ProgressStore(spark, f"{folder}/p").get("a").is_zero
    assert store.flush() == 1
    again = ProgressStore(spark, f"{folder}/p")
    assert again.get("a") == Progress(T, "x") and again.get("b").is_zero


def test_flush_without_change_writes_nothing(spark, folder):
    store = ProgressStore(spark, f"{folder}/p")
    store.set("a", Progress(T, "x"))
    store.flush()
    before = files(folder)
    assert store.flush() == 0
    store.set("a", Progress(T.replace(tzinfo=timezone.utc), "x"))
    assert store.flush() == 0 and files(folder) == before


def test_newest_version_counts_and_files_stay_few(spark, folder):
    store = ProgressStore(spark, f"{folder}/p")
    store.set("b", Progress(None, "only id"))
    for i in range(SLOTS + 3):
        store.set("a", Progress(T, f"{i}"))
        store.flush()
    assert ProgressStore(spark, f"{folder}/p").snapshot() == {
        "a": Progress(T, f"{SLOTS + 2}"),
        "b": Progress(None, "only id"),
    }
    assert len(files(folder)) == SLOTS + 1


def test_awkward_table_names(spark, folder):
    store = ProgressStore(spark, f"{folder}/p")
    names = ["007", "a/b=c", "x y"]
    for name in names:
        store.set(name, Progress(T, name))
    store.flush()
    assert ProgressStore(spark, f"{folder}/p").snapshot() == {n: Progress(T, n) for n in names}


def test_corrupt_store_is_an_error(spark, folder):
    store = ProgressStore(spark, f"{folder}/p")
    store.set("a", Progress(T, "x"))
    store.flush()
    with open(files(folder)[0], "wb") as out:
        out.write(b"not parquet")
    with pytest.raises(Exception):
        ProgressStore(spark, f"{folder}/p").get("a")
