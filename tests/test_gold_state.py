"""Stored state of the aggregated layer: sessions kept up to date by bucket, distinct counts as sketches, sources that evolve."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from clicklake.operators.sessions import session_summary
from clicklake.operators.sketches import ERROR, distinct_counts, hourly_sketches, united
from clicklake.plans.bronze import land
from clicklake.plans.gold import SESSION_BUCKETS, build_sketches, bucket_of, read_sessions_table, read_sketches, update_sessions
from clicklake.plans.silver import rebuild_silver
from clicklake.sources.lake import Lake, read_silver, read_with_evolution, wider
from clicklake.sources.snapshots import current
from conftest import click, rows_of

D5 = date(2024, 1, 5)


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def load(spark, lake, rows, start, days=1):
    dates = land(spark, lake, rows, start, start + timedelta(days=days)).event_dates
    rebuild_silver(spark, lake, dates)
    return update_sessions(spark, lake, dates)


@pytest.mark.parametrize("seed", [1, 2])
def test_sessions_equal_a_full_rebuild_after_random_reloads(spark, clicks, lake, seed):
    draw = random.Random(seed)

    def some(key, day):
        kind = draw.choice(["page_view", "click", "purchase", "error"])
        at = f"2024-01-{day - draw.randrange(3):02} {draw.randrange(24):02}:00:00"
        return click(key, at, kind, user=key % 5, session=None if key % 11 == 0 else f"s{key % 7}", updated=f"2024-01-{day:02} 23:30:00")

    for _ in range(4):
        day = draw.randrange(5, 8)
        rows = clicks(*[some(draw.randrange(40), day) for _ in range(draw.randrange(1, 15))])
        load(spark, lake, rows, date(2024, 1, day))
        assert rows_of(read_sessions_table(spark, lake)) == rows_of(session_summary(read_silver(spark, lake)))


def test_only_touched_buckets_are_replaced(spark, clicks, lake):
    rows = [click(i, f"2024-01-05 10:{i:02}:00", session=f"s{i}") for i in range(40)]
    assert load(spark, lake, clicks(*rows), D5) == 40
    before = current(spark, lake.gold("session_buckets"))
    late = [click(100, "2024-01-06 00:10:00", session="s3"), click(101, "2024-01-07 00:10:00", session="new")]
    assert load(spark, lake, clicks(*late), date(2024, 1, 6), 2) == 2
    after = current(spark, lake.gold("session_buckets"))
    moved = {p for p in after.partitions if after.commits(p) != before.commits(p)}
    names = spark.createDataFrame([("s3",), ("new",)], "session_id string")
    assert moved == {str(r[0]) for r in names.select(bucket_of()).collect()} and len(moved) < SESSION_BUCKETS
    assert rows_of(read_sessions_table(spark, lake)) == rows_of(session_summary(read_silver(spark, lake)))
    assert update_sessions(spark, lake, []) == 0 == update_sessions(spark, lake, [date(2020, 1, 1)])


def test_sketches_add_up(spark, clicks, lake):
    rows = [click(i, f"2024-01-0{5 + i % 3} {i % 24:02}:00:00", user=i * 7919 % 3001) for i in range(6000)]
    land(spark, lake, clicks(*rows), D5, D5 + timedelta(days=3))
    rebuild_silver(spark, lake, [])
    assert len(build_sketches(spark, lake).dates) == 3
    silver, stored = read_silver(spark, lake), read_sketches(spark, lake)
    whole = distinct_counts(united(stored, F.lit(1).alias("all"))).first()
    assert whole["event_count"] == silver.count()
    exact = silver.select("user_id").distinct().count()
    assert abs(whole["users"] - exact) <= ERROR * exact
    by_day = united(stored, "date")
    assert distinct_counts(united(by_day, F.lit(1).alias("all"))).first()["users"] == whole["users"]
    one = hourly_sketches(silver.withColumns({"event_date": F.lit(D5), "event_timestamp": F.lit("2024-01-05").cast("timestamp")}))
    assert distinct_counts(united(one, F.lit(1).alias("all"))).first()["users"] == whole["users"]
    before = rows_of(distinct_counts(stored))
    build_sketches(spark, lake, [D5])
    assert rows_of(distinct_counts(read_sketches(spark, lake))) == before


def test_widened_types_and_added_columns_in_one_folder(spark, tmp_path):
    path = str(tmp_path / "source")
    spark.createDataFrame([(1, 1.5, "a")], "n int, x float, day string").write.partitionBy("day").mode("append").parquet(path)
    spark.createDataFrame([(2**40, 2.5, "b", "new")], "n long, x double, day string, more string").write.partitionBy("day").mode("append").parquet(path)
    spark.createDataFrame([(3, "a")], "n smallint, day string").write.partitionBy("day").mode("append").parquet(path)
    rows = read_with_evolution(spark, path)
    assert dict(rows.dtypes) == {"n": "bigint", "x": "double", "more": "string", "day": "string"}
    assert rows_of(rows, "n", "x", "day", "more") == [(1, 1.5, "a", None), (2**40, 2.5, "b", "new"), (3, None, "a", None)]
    spark.createDataFrame([("x", "a")], "n string, day string").write.partitionBy("day").mode("append").parquet(path)
    with pytest.raises(TypeError, match="n: no type holds both"):
        read_with_evolution(spark, path)


def test_wider_types(spark):
    types = {f.name: f.dataType for f in spark.createDataFrame([], "b byte, i int, l long, f float, d double, t date, m timestamp").schema}
    assert wider(types["b"], types["l"]) == types["l"] and wider(types["i"], types["d"]) == types["d"]
    assert wider(types["t"], types["m"]) == types["m"] and wider(types["f"], types["d"]) == types["d"]
    for one, other in (("l", "d"), ("i", "f"), ("i", "t")):
        with pytest.raises(TypeError):
            wider(types[one], types[other])
