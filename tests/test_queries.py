import pytest
from compare import database, spark_rows, sql_rows

from __spark_entry__ import entry, oracle_sql, queries
from stepwave.operators.ordered import MAX_GROUP_ROWS_SETTING
from stepwave.plans.catalogue import QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return database(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, connection, name):
    columns, rows = spark_rows(queries()[name](spark, sf_dir))
    expected_columns, expected = sql_rows(connection, oracle_sql()[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected
    assert rows


SLICED = [
    "local_maxima", "cycle_peaks_day_gap", "cycle_peaks_scoped", "cycle_strongest", "cycle_numbers", "segments",
    "group_counts", "resampled_vectors", "score_names", "inference_accepted", "inference_known_users",
    "inference_unknown_users", "inference_lists", "online_users", "session_points", "session_messages",
    "connection_messages", "session_export_rows",
    "live_front_after_stop", "decimate_nth", "throttle_gap",
]


@pytest.mark.parametrize("name", SLICED)
def test_query_with_large_groups_matches_sql(spark, sf_dir, connection, name):
    """The same queries with most users far above the group limit."""
    spark.conf.set(MAX_GROUP_ROWS_SETTING, "15")
    try:
        found = spark_rows(queries()[name](spark, sf_dir))
    finally:
        spark.conf.unset(MAX_GROUP_ROWS_SETTING)
    assert found == sql_rows(connection, oracle_sql()[name])


@pytest.mark.parametrize("name", ["cycle_peaks", "session_points", "resampled_vectors"])
def test_session_zone_does_not_matter(spark, sf_dir, connection, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = spark_rows(queries()[name](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == sql_rows(connection, oracle_sql()[name])


def test_entry(spark):
    rows = entry(spark)
    assert rows.columns == ["userID", "segment_no", "accX", "accY", "accZ"]
    assert {(len(r.accX), len(r.accY), len(r.accZ)) for r in rows.collect()} == {(128, 128, 128)}
