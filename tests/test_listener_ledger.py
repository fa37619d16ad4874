import os

import pytest

from almanac.streaming import listener


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write("".join(f"{line}\n" for line in lines))


def run(spark, folder, files_per_trigger=2):
    stream = listener.listen_once(spark, f"{folder}/inbox", files_per_trigger=files_per_trigger)
    query = listener.hand_over(
        stream, f"{folder}/sink", f"{folder}/ledger", f"{folder}/archive", f"{folder}/checkpoint", every=None
    )
    query.awaitTermination()


def state(spark, folder):
    rows = sorted(r["value"] for r in spark.read.parquet(f"{folder}/sink").collect())
    ledger = sorted((r["file_name"], r["n"]) for r in spark.read.parquet(f"{folder}/ledger").collect())
    return rows, ledger, sorted(n for n in os.listdir(f"{folder}/archive") if n.endswith("txt")), os.listdir(f"{folder}/inbox")


EXPECTED = (["a1", "a2", "b1", "c1", "d 1"], [("a.txt", 2), ("b.txt", 1), ("c.txt", 1), ("d%20e.txt", 1)], ["a.txt", "b.txt", "c.txt", "d e.txt"])


def fill(folder):
    for name, lines in (("a.txt", ["a1", "a2"]), ("b.txt", ["b1"]), ("c.txt", ["c1"]), ("d e.txt", ["d 1"])):
        put(f"{folder}/inbox", name, lines)


def test_every_file_is_taken_and_moved(spark, folder):
    fill(folder)
    run(spark, folder)
    rows, ledger, archived, left = state(spark, folder)
    assert (rows, ledger, archived) == EXPECTED
    assert [n for n in left if not n.startswith(".")] == []
    put(f"{folder}/inbox", "f.txt", ["f1"])
    run(spark, folder)
    rows, ledger, archived, _ = state(spark, folder)
    assert rows == [*EXPECTED[0], "f1"] and ledger == [*EXPECTED[1], ("f.txt", 1)] and archived == [*EXPECTED[2], "f.txt"]


@pytest.mark.parametrize("moves_before_the_end", [0, 1, 2, 3])
def test_a_run_that_stops_anywhere_neither_repeats_nor_loses_a_file(spark, folder, monkeypatch, moves_before_the_end):
    fill(folder)
    moved, move = [], listener._move

    def failing(*arguments):
        if len(moved) == moves_before_the_end:
            raise RuntimeError("the machine is gone")
        moved.append(move(*arguments))
        if moves_before_the_end in (2, 3) and len(moved) == 2:
            # All files of the batch are moved, and the batch itself is not committed.
            raise RuntimeError("the machine is gone")

    monkeypatch.setattr(listener, "_move", failing)
    with pytest.raises(Exception, match="the machine is gone"):
        run(spark, folder)
    monkeypatch.setattr(listener, "_move", move)
    run(spark, folder)
    assert state(spark, folder)[:3] == EXPECTED


def test_a_run_that_stops_between_rows_and_ledger(spark, folder, monkeypatch):
    fill(folder)
    exists = listener._exists

    def stopped(spark, path):
        raise RuntimeError("the machine is gone")

    run_rows = listener.listen_once(spark, f"{folder}/inbox", files_per_trigger=2)
    monkeypatch.setattr(listener, "_exists", stopped)
    query = listener.hand_over(run_rows, f"{folder}/sink", f"{folder}/ledger", f"{folder}/archive", f"{folder}/checkpoint", every=None)
    with pytest.raises(Exception, match="the machine is gone"):
        query.awaitTermination()
    # Rows of the same batch that an earlier try has left behind.
    spark.createDataFrame([("a1", "old", "old")], run_rows.schema).write.parquet(f"{folder}/sink/batch=0")
    monkeypatch.setattr(listener, "_exists", exists)
    run(spark, folder)
    assert state(spark, folder)[:3] == EXPECTED
