import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from clicklake.operators.metrics import METRICS, aggregate_metric, ranked_metric
from clicklake.operators.rebuild import refine
from clicklake.operators.sessions import conversion_funnel, funnel_times, session_summary
from conftest import click, day_of_clicks, rows_of, ts


@pytest.fixture(scope="module")
def silver(clicks):
    return refine(clicks(*day_of_clicks("2024-01-05", 60, 0), *day_of_clicks("2024-01-06", 30, 1000)))


def grouped(silver, *keys):
    groups = defaultdict(list)
    for row in silver.collect():
        groups[tuple(row[k] for k in keys)].append(row)
    return groups


def test_daily_metrics(silver):
    expected = [
        (*k, len(g), len({r.user_id for r in g}), len({r.session_id for r in g}), len({r.domain for r in g}))
        for k, g in grouped(silver, "event_date", "event_type").items()
    ]
    assert rows_of(
        aggregate_metric(silver, "daily_metrics"),
        "date", "event_type", "event_count", "unique_users", "unique_sessions", "unique_domains",
    ) == sorted(expected, key=str)


def test_user_summary_counts_and_average(clicks):
    at = ts("2024-01-05 10:00:00")
    df = refine(
        clicks(
            click(1, at, created=at - timedelta(seconds=4)),
            click(2, at, "click", created=at - timedelta(seconds=1), url="https://b/"),
        )
    )
    row = aggregate_metric(df, "user_summary").first()
    assert (row.total_events, row.sessions, row.event_types, row.domains_visited) == (2, 1, 2, 2)
    assert row.avg_session_duration_sec == 2.5


def test_null_values_are_not_counted_as_distinct(clicks):
    df = refine(clicks(click(1, "2024-01-05 10:00:00", url=None), click(2, "2024-01-05 10:00:00")))
    assert aggregate_metric(df, "daily_metrics").first().unique_domains == 1


def test_domain_ranking(silver):
    views = [r.page_views for r in ranked_metric(silver, "domain_metrics").collect()]
    assert views == sorted(views, reverse=True)


def test_every_metric_totals_all_events(silver):
    total = silver.count()
    for name, metric in METRICS.items():
        first = next(iter(metric.measures))
        assert aggregate_metric(silver, name).groupBy().sum(first).first()[0] == total


def test_hourly_metric_on_empty_input(silver):
    assert aggregate_metric(silver.limit(0), "hourly_metrics").count() == 0


def test_session_summary(clicks):
    df = refine(
        clicks(
            click(2, "2024-01-05 10:00:00", "page_view", user=8, agent="Mobile"),
            click(1, "2024-01-05 10:00:00", "click", user=7, agent="Tablet"),
            click(3, "2024-01-05 10:01:40", "scroll", user=9),
            click(4, "2024-01-06 10:00:00", "page_view", session="s2"),
            click(5, "2024-01-06 10:00:00", "page_view", session="s2"),
        )
    )
    first, second = session_summary(df).orderBy("session_id").collect()
    assert (first.user_id, first.device_type, first.duration_seconds, first.page_views_count, first.bounce) == (
        7, "tablet", 100, 1, True,
    )
    assert (second.duration_seconds, second.page_views_count, second.bounce) == (None, 2, False)
    assert first.started_at == ts("2024-01-05 10:00:00") and first.ended_at == ts("2024-01-05 10:01:40")


def brute_force_funnel(rows):
    out = {}
    by_session = defaultdict(list)
    for row in rows:
        by_session[row.session_id].append(row)
    for session, events in by_session.items():
        reached, after = [], datetime.min
        for step in ("page_view", "click", "purchase"):
            times = [e.event_timestamp for e in events if e.event_type == step and e.event_timestamp >= after]
            if not times:
                break
            after = min(times)
            reached.append(after)
        if reached:
            out[session] = tuple(reached + [None] * (3 - len(reached)))
    return out


@pytest.mark.parametrize("seed, span", [(1, 60), (2, 5000), (3, 3)])
def test_funnel_equals_brute_force(clicks, seed, span):
    """Random sessions, with equal timestamps."""
    rng = random.Random(seed)
    start = ts("2024-01-05 23:30:00")
    kinds = ["page_view", "click", "purchase", "scroll"]
    rows = [
        click(i, start + timedelta(seconds=rng.randrange(span)), rng.choice(kinds), session=f"s{rng.randrange(60)}")
        for i in range(300)
    ]
    silver = refine(clicks(*rows))
    found = {r[0]: tuple(r)[1:] for r in funnel_times(silver).collect()}
    assert found == brute_force_funnel(rows)

    per_day = defaultdict(lambda: [0, 0, 0])
    for times in found.values():
        for i, at in enumerate(times):
            per_day[times[0].date()][i] += at is not None
    expected = sorted(((d, *n) for d, n in per_day.items()), key=str)
    assert rows_of(conversion_funnel(silver), "date", "viewed", "clicked", "purchased") == expected


def test_funnel_needs_a_page_view(clicks):
    df = refine(clicks(click(1, "2024-01-05 10:00:00", "click"), click(2, "2024-01-05 10:00:00", "purchase")))
    assert conversion_funnel(df).count() == 0


def test_funnel_steps_are_partial_aggregates(silver):
    """No window of its own: what a session's rows are reduced by is combined before the exchange."""
    plan = funnel_times(silver)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min(at") >= 3
    assert all("row_number" in line for line in plan.splitlines() if "Window [" in line)
