import pytest
from pyspark.sql import functions as F

from clicklake.functions.web import browser, device_type, enrich_clicks, url_domain, whole_seconds, zone_free
from conftest import click, ts


@pytest.mark.parametrize(
    "url, domain",
    [
        ("https://shop.example.com/cart", "shop.example.com"),
        ("http://a.b", "a.b"),
        ("https://u@h:80?x=1", "u@h:80?x=1"),
        ("nohost", ""),
        ("", ""),
        (None, None),
        ("x://one/y://two", "one"),
    ],
)
def test_domain(spark, url, domain):
    df = spark.createDataFrame([(url,)], "url string")
    assert df.select(url_domain(F.col("url"))).first()[0] == domain


@pytest.mark.parametrize(
    "agent, device, name",
    [
        ("Mozilla (iPhone) Mobile Safari", "mobile", "Safari"),
        ("Tablet Mobile", "mobile", "Other"),
        ("Android Tablet Firefox", "tablet", "Firefox"),
        ("iPhone Edge", "mobile", "Edge"),
        ("Android Chrome Edge", "mobile", "Chrome"),
        ("Safari Edge", "desktop", "Safari"),
        ("Firefox Chrome", "desktop", "Chrome"),
        ("mobile chrome", "desktop", "Other"),
        ("curl/8.0", "desktop", "Other"),
        ("", "desktop", "Other"),
        (None, "desktop", "Other"),
    ],
)
def test_agent_labels(spark, agent, device, name):
    df = spark.createDataFrame([(agent,)], "a string")
    assert tuple(df.select(device_type(F.col("a")), browser(F.col("a"))).first()) == (device, name)


@pytest.mark.parametrize(
    "later, earlier, seconds",
    [
        ("2024-01-01 00:00:01.000000", "2024-01-01 00:00:00.999999", 1),
        ("2024-01-01 00:00:01.999999", "2024-01-01 00:00:01.000000", 0),
        ("2024-01-01 00:00:00", "2024-01-01 00:00:10", -10),
        ("1969-12-31 23:59:58.500000", "1969-12-31 23:59:59.500000", -1),
    ],
)
def test_whole_seconds_floors_each_side(spark, later, earlier, seconds):
    df = spark.createDataFrame([(ts(later), ts(earlier))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(whole_seconds(F.col("a"), F.col("b"))).first()[0] == seconds


def test_enrich_and_zone_free(clicks):
    df = zone_free(enrich_clicks(clicks(click(1, "2024-01-31 23:59:59"))))
    row = df.first()
    assert (row.domain, row.device_type, row.browser, str(row.event_date)) == (
        "a.example.com", "desktop", "Chrome", "2024-01-31",
    )
    assert dict(df.dtypes)["event_timestamp"] == "timestamp_ntz"
    assert dict(df.dtypes)["event_date"] == "date"
