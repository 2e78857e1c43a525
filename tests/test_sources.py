from pyspark.sql import functions as F

from quillstream.operators.ids import partitions_for
from quillstream.sources import feed as FD
from quillstream.sources.tables import read_table
from tests.conftest import MEDIUM, SMALL


def _formatted(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_a_text_scan_is_not_shuffled(spark):
    plan = _formatted(read_table(spark, MEDIUM, "pages").select("html"))
    assert "Exchange" not in plan


def test_text_scan_keeps_pushdown(spark):
    pages = read_table(spark, MEDIUM, "pages").filter(F.col("page_id") < 10).select("page_id")
    plan = _formatted(pages)
    assert "PushedFilters: [IsNotNull(page_id), LessThan(page_id,10)]" in plan
    assert "ReadSchema: struct<page_id:bigint>" in plan


def test_partitions_for_has_floor(spark):
    df = spark.read.parquet(f"{SMALL}/events.parquet")
    assert partitions_for(df) >= int(spark.conf.get("spark.sql.shuffle.partitions"))


def _topic_feed(spark):
    ev = spark.read.parquet(f"{MEDIUM}/events.parquet").withColumnRenamed("event_type", "topic")
    return ev.withColumn("lang", F.expr("if(user_id % 3 = 0, 'de', 'en')")).withColumn("country", F.expr("if(user_id % 2 = 0, 'US', 'AT')"))


def test_topic_window_pushes_bounds_to_scan(spark):
    import datetime as dt

    ev = _topic_feed(spark)
    hi = dt.datetime(2024, 1, 20, 12)
    every = FD.topic_window(ev, "click", hi, 100, time_col="ts", tie_col="event_id")
    plan = _formatted(every)
    assert "GreaterThanOrEqual(ts,2024-01-16T08:00)" in plan and "LessThanOrEqual(ts,2024-01-20T12:00)" in plan
    rows = every.collect()
    assert len(rows) > 30 and {(r["lang"], r["country"]) for r in rows} == {("en", "US")}
    newest = FD.topic_window(ev, "click", hi, 100, time_col="ts", tie_col="event_id", limit=30)
    assert "TakeOrderedAndProject" in _formatted(newest)
    expected = sorted(rows, key=lambda r: (-r["ts"].timestamp(), r["event_id"]))[:30]
    assert [r["event_id"] for r in newest.collect()] == [r["event_id"] for r in expected]
    anywhere = FD.topic_window(ev, "click", hi, 100, time_col="ts", tie_col="event_id", lang=None, country=None)
    assert anywhere.count() > len(rows)


def test_topic_window_needs_the_columns_it_filters_on(spark):
    import datetime as dt

    import pytest

    with pytest.raises(ValueError, match="country"):
        FD.topic_window(_topic_feed(spark).drop("country"), "click", dt.datetime(2024, 1, 20), 10, time_col="ts")


def test_partitions_for_ignores_join_estimates(spark):
    feed = FD.feed_items(spark, MEDIUM)  # events x pages: the optimizer multiplies sizes
    assert partitions_for(feed) == int(spark.conf.get("spark.sql.shuffle.partitions"))
