from pyspark.sql import functions as F

from clicklake.operators.quality import bronze_suite, collect_summary, run_checks
from clicklake.schemas import CLICKS, DEVICE_TYPES, SESSIONS, SILVER_EVENT_TYPES, TRAFFIC_SOURCES
from clicklake.sources.samples import PAGES, generate, sample_clicks, sample_sessions
from conftest import rows_of


def test_any_partitioning_gives_the_same_rows(spark):
    for make in (sample_clicks, sample_sessions):
        assert rows_of(make(spark.range(0, 500, 1, 2))) == rows_of(make(spark.range(0, 500, 1, 7)))
    assert rows_of(sample_clicks(spark.range(50))) != rows_of(sample_clicks(spark.range(50), seed=7))


def test_samples_follow_the_rules(spark):
    clicks, sessions = generate(spark, 5_000, 300)
    assert clicks.schema.fieldNames() == CLICKS.fieldNames() and sessions.schema.fieldNames() == SESSIONS.fieldNames()
    assert collect_summary(run_checks(clicks, bronze_suite(), "bronze")).success
    row = clicks.agg(
        F.count_if(~F.col("event_type").isin(SILVER_EVENT_TYPES) | ~F.col("page_url").isin(PAGES)),
        F.count_if(F.col("created_at") != F.col("event_timestamp")),
        F.count_if(~(F.unix_timestamp("updated_at") - F.unix_timestamp("event_timestamp")).between(0, 3600)),
        F.count_if(~F.col("user_agent").rlike(r"^Mozilla/5\.0 \(\w+\) \w+/(8\d|9\d|1[01]\d|120)\.0$")),
        F.count_if(~F.col("ip_address").rlike(r"^(\d{1,3}\.){3}\d{1,3}$")),
        F.count_if(~F.col("user_id").between(1, 10_000)),
    ).first()
    assert tuple(row) == (0, 0, 0, 0, 0, 0)
    assert 0.25 < clicks.filter("referrer_url IS NULL").count() / 5_000 < 0.35
    bad = sessions.filter(
        ~F.col("traffic_source").isin(TRAFFIC_SOURCES)
        | ~F.col("device_type").isin(DEVICE_TYPES)
        | (F.col("bounce") != (F.col("page_views_count") == 1))
        | ~F.col("page_views_count").between(1, 50)
        | (F.col("duration_seconds").isNull() != F.col("ended_at").isNull())
        | ~F.col("started_at").between("2024-01-01", "2024-03-21")
    )
    assert bad.count() == 0


def test_clicks_lie_within_their_session(spark):
    clicks, sessions = generate(spark, 2_000, 100)
    joined = clicks.drop("user_id").join(sessions, "session_id")
    end = F.coalesce("ended_at", "started_at")
    assert joined.count() == 2_000
    assert joined.filter(~F.col("event_timestamp").between(F.col("started_at"), end)).count() == 0
    own = sample_clicks(spark.range(500), 100, session_user=True).join(sessions, ["session_id", "user_id"])
    assert own.count() == 500
