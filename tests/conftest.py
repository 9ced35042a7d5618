import itertools
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Row

from clicklake.schemas import CLICKS
from clicklake.session import build_session

AGENT = "Mozilla/5.0 (Windows) Chrome/100.0"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "clicklake-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def ts(text):
    return datetime.fromisoformat(text)


def click(click_id, at, kind="page_view", *, user=1, session="s1", url="https://a.example.com/x", agent=AGENT,
          updated=None, created=None):
    at = ts(at) if isinstance(at, str) else at
    return Row(
        click_id=click_id, user_id=user, session_id=session, page_url=url, event_type=kind, event_timestamp=at,
        user_agent=agent, ip_address=None, referrer_url=None, created_at=created or at,
        updated_at=ts(updated) if updated else at,
    )


@pytest.fixture(scope="session")
def clicks(spark):
    def make(*rows):
        return spark.createDataFrame([tuple(r) for r in rows], CLICKS)

    return make


def rows_of(df, *columns):
    """Rows in an order that does not depend on the plan."""
    picked = df.select(*(columns or sorted(df.columns)))
    return sorted((tuple(r) for r in picked.collect()), key=str)


def day_of_clicks(day, count, first_id, users=5):
    """A fixed mix of valid and invalid clicks over one day."""
    kinds = itertools.cycle(["page_view", "click", "scroll", "purchase", "form_submit"])
    start = ts(day)
    return [
        click(
            first_id + i,
            start + timedelta(minutes=7 * i),
            next(kinds),
            user=None if i % 11 == 10 else i % users,
            session=f"s{i % users}_{day}",
        )
        for i in range(count)
    ]
