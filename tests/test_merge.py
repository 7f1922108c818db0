from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from orderloom.functions.scalar import stamp
from orderloom.operators import merge

OLD, NOW, LATER = datetime(2020, 1, 1), datetime(2024, 1, 1), datetime(2025, 1, 1)
TARGET = "k string, v string, updated_at timestamp_ntz"


def _target(spark, rows):
    return spark.createDataFrame([(k, v, OLD) for k, v in rows], TARGET)


def _source(spark, rows):
    return spark.createDataFrame(rows, "k string, v string")


def _rows(df):
    return sorted(map(tuple, df.select("k", "v", "updated_at").collect()), key=repr)


def test_cycle(spark):
    target = _target(spark, [("same", "a"), ("nulled", "b"), ("only_target", "c"), (None, "keyless")])
    source = _source(spark, [("same", "A"), ("nulled", None), ("new", "d"), (None, "keyless"), (None, "keyless")])
    assert _rows(merge.upsert(target, source, ["k"], run_ts=NOW)) == sorted(
        [
            ("same", "A", NOW),
            ("nulled", None, NOW),
            ("only_target", "c", OLD),
            ("new", "d", NOW),
            (None, "keyless", OLD),
            (None, "keyless", NOW),
            (None, "keyless", NOW),
        ],
        key=repr,
    )


def test_untouched_matches_keep_their_time(spark):
    merged = merge.upsert(_target(spark, [("a", "1")]), _source(spark, [("a", "2"), ("b", "3")]), ["k"], False, NOW)
    assert _rows(merged) == [("a", "2", OLD), ("b", "3", NOW)]


def test_duplicate_source_key_is_an_error_even_for_a_count(spark):
    merged = merge.upsert(_target(spark, []), _source(spark, [("a", "1"), ("a", "2")]), ["k"], run_ts=NOW)
    with pytest.raises(Exception, match="duplicate source key"):
        merged.count()


def test_latest_wins(spark):
    source = spark.createDataFrame(
        [("a", "old", OLD), ("a", "new", NOW), ("a", "mid", datetime(2022, 1, 1)), ("b", "x", OLD), ("b", "y", OLD)],
        "k string, v string, ingested_at timestamp_ntz",
    )
    merged = merge.upsert(_target(spark, []), source, ["k"], run_ts=NOW, on_duplicate="latest")
    assert _rows(merged) == [("a", "new", NOW), ("b", "y", NOW)]


def test_stamp_ignores_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        zoned = datetime(2024, 1, 1, 2, tzinfo=timezone(timedelta(hours=2)))
        assert spark.range(1).select(stamp(NOW), stamp(zoned)).first() == (NOW, NOW)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_unknown_duplicate_rule(spark):
    with pytest.raises(ValueError):
        merge.upsert(_target(spark, []), _source(spark, []), ["k"], on_duplicate="first")


def test_small_delivery_does_not_shuffle_the_target(spark, tmp_path):
    spark.range(100000).selectExpr("cast(id as string) k", "'v' v", "timestamp_ntz'2020-01-01' updated_at").write.parquet(
        str(tmp_path / "t")
    )
    target = spark.read.parquet(str(tmp_path / "t"))
    merged = merge.upsert(target, _source(spark, [("7", "x"), ("new", "y")]), ["k"], run_ts=NOW)
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert merged.count() == 100001 and merged.filter("v <> 'v'").count() == 2


keys = st.sampled_from("abcdef")
values = st.one_of(st.none(), st.sampled_from("xyz"))
tables = st.dictionaries(keys, values, max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(tables, tables)
def test_twice_is_once_but_for_the_time(spark, before, delivery):
    source = _source(spark, list(delivery.items()))
    once = merge.upsert(_target(spark, list(before.items())), source, ["k"], run_ts=NOW)
    twice = merge.upsert(once, source, ["k"], run_ts=LATER)
    assert {(k, v) for k, v, _ in _rows(once)} == set({**before, **delivery}.items())
    assert [r[:2] for r in _rows(once)] == [r[:2] for r in _rows(twice)]


def test_keyless_rows_all_stay_when_the_newest_wins(spark):
    rows = spark.createDataFrame(
        [("a", "old", 1), ("a", "new", 2), (None, "x", 1), (None, "y", 2)], "order_id string, order_status string, ingested_at int"
    )
    newest = merge.latest_per_key(rows, ["order_id"])
    assert sorted(map(tuple, newest.collect()), key=repr) == [("a", "new"), (None, "x"), (None, "y")]
