import os
import random

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from clicklake.sources import snapshots as sn
from conftest import rows_of

SCHEMA = StructType().add("n", IntegerType()).add("day", StringType())


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def frame(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def held(spark, path, *wanted):
    return rows_of(sn.read_snapshot(spark, path, SCHEMA, wanted.__contains__ if wanted else None), "n", "day")


def files(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names if not f.startswith("."))


def test_nothing_shows_before_it_is_published(spark, path):
    assert held(spark, path) == [] and not sn.is_snapshot_table(spark, path)
    one = sn.stage(frame(spark, (1, "a"), (2, "b"), (3, None)), path, "day")
    assert one.rows == 3 and set(one.partitions) == {"a", "b", sn.NULL}
    assert rows_of(sn.read_staged(spark, one, SCHEMA), "n", "day") == [(1, "a"), (2, "b"), (3, None)]
    assert held(spark, path) == []
    sn.publish(spark, one)
    assert held(spark, path) == [(1, "a"), (2, "b"), (3, None)]
    assert held(spark, path, "b") == [(2, "b")]


def test_many_partitions_are_replaced_at_once(spark, path):
    sn.publish(spark, sn.stage(frame(spark, (1, "a"), (2, "b"), (3, "c")), path, "day"))
    two = sn.stage(frame(spark, (4, "a"), (5, "a")), path, "day")
    sn.publish(spark, two, ["a", "b"])
    assert held(spark, path) == [(3, "c"), (4, "a"), (5, "a")]
    sn.publish(spark, sn.stage(frame(spark), path, "day"), ["a", "c"])
    assert held(spark, path) == []


def test_a_dropped_commit_leaves_no_file(spark, path):
    sn.discard(spark, sn.stage(frame(spark, (1, "a")), path, "day"))
    assert not os.path.exists(path)
    sn.publish(spark, sn.stage(frame(spark, (1, "a")), path, "day"))
    before = files(path)
    sn.discard(spark, sn.stage(frame(spark, (2, "a")), path, "day"))
    assert files(path) == before


def test_a_second_writer_does_not_lose_the_first_ones_commit(spark, path, monkeypatch):
    sn.publish(spark, sn.stage(frame(spark, (1, "a")), path, "day"))
    mine, other = (sn.stage(frame(spark, (n, "a")), path, "day") for n in (2, 3))
    real, raced = sn.write_new, []

    def race(spark, target, text):
        if not raced:
            raced.append(target)
            sn.publish(spark, other)
        return real(spark, target, text)

    monkeypatch.setattr(sn, "write_new", race)
    sn.publish(spark, mine)
    assert held(spark, path) == [(1, "a"), (2, "a"), (3, "a")] and sn.current(spark, path).version == 3
    assert not [n for n in sn.names_in(spark, f"{path}/_versions") if n.startswith(".")]


def test_a_numbered_batch_lands_once_even_if_merged(spark, path):
    for number in range(4):
        batch = sn.stage(frame(spark, (number, "a")), path, "day", name=f"run_{number}")
        sn.publish(spark, batch, series=("run", number))
    assert sn.compact(spark, path, SCHEMA, most=2) == 3
    again = sn.stage(frame(spark, (3, "a")), path, "day", name="run_3b")
    sn.publish(spark, again, series=("run", 3))
    assert held(spark, path) == [(0, "a"), (1, "a"), (2, "a"), (3, "a")]
    sn.publish(spark, again, series=("other", 0))
    assert len(held(spark, path)) == 5


def test_merging_keeps_rows_and_what_came_meanwhile(spark, path, monkeypatch):
    for n in range(5):
        sn.publish(spark, sn.stage(frame(spark, (n, "a"), (n, "b" if n else "c")), path, "day"))
    rows = held(spark, path)
    late, real = sn.stage(frame(spark, (9, "a")), path, "day"), sn.stage

    def meanwhile(*args, **options):
        sn.publish(spark, late)
        return real(*args, **options)

    monkeypatch.setattr(sn, "stage", meanwhile)
    assert sn.compact(spark, path, SCHEMA, [F.col("n")], most=3) == 4 + 3
    snapshot = sn.current(spark, path)
    assert held(spark, path) == sorted([*rows, (9, "a")])
    assert [len(snapshot.commits(p)) for p in ("a", "b", "c")] == [2, 1, 1]
    monkeypatch.undo()
    assert sn.compact(spark, path, SCHEMA, most=1, wanted=["a"], merge=DataFrame.distinct) == 1


def test_expired_files_go_and_current_ones_stay(spark, path):
    for n in range(6):
        sn.publish(spark, sn.stage(frame(spark, (n, "a"), (n, f"own{n}")), path, "day"), ["a"])
    sn.stage(frame(spark, (99, "a")), path, "day")
    rows = held(spark, path)
    assert sn.expire(spark, path, kept=1) == 1  # every commit still has a partition of its own
    assert held(spark, path) == rows and sn.names_in(spark, f"{path}/_versions") == ["000000000006"]
    sn.publish(spark, sn.stage(frame(spark, (7, "a")), path, "day"), sn.current(spark, path).partitions)
    assert sn.expire(spark, path, kept=1) == 6
    assert held(spark, path) == [(7, "a")] and len(sn.names_in(spark, path)) == 2


def test_only_wanted_folders_are_listed(spark, path):
    for n in range(3):
        sn.publish(spark, sn.stage(frame(spark, (n, "a"), (n, "b")), path, "day"))
    snapshot = sn.current(spark, path)
    whole = sn.folders(path, snapshot, snapshot.entries)
    assert len(whole) == 3 and all("day=" not in f for f in whole)
    assert all(f.endswith("/day=b") for f in sn.folders(path, snapshot, {e for e in snapshot.entries if e[0] == "b"}))
    plan = sn.read_snapshot(spark, path, SCHEMA, {"b"}.__contains__)
    assert all("/day=b/" in f for f in plan.inputFiles()) and plan.count() == 3


@pytest.mark.parametrize("seed", [1, 2])
def test_random_writes_equal_a_dictionary(spark, path, seed):
    draw, truth = random.Random(seed), {}
    for n in range(14):
        days = draw.sample("abcd", draw.randrange(1, 4))
        batch = sn.stage(frame(spark, *[(n, d) for d in days]), path, "day")
        if draw.random() < 0.5:
            sn.publish(spark, batch)
        else:
            gone = draw.sample("abcd", 2)
            truth |= {d: [] for d in gone}
            sn.publish(spark, batch, gone)
        for d in days:
            truth[d] = [*truth.get(d, []), n]
        if draw.random() < 0.3:
            sn.compact(spark, path, SCHEMA, most=draw.randrange(1, 3))
            sn.expire(spark, path, kept=2)
        assert held(spark, path) == sorted(((n, d) for d, held in truth.items() for n in held), key=str)
