"""Ordered delivery: positions follow the order, and a broken order is noticed."""

import pytest

from orderloom.sources.ordered_files import read_ordered, write_ordered


@pytest.mark.parametrize("descending", [False, True])
def test_positions_follow_the_order(spark, tmp_path, descending):
    rows = [((i * 37) % 101, f"v{i % 7}") for i in range(101)] + [(None, "nothing")]
    df = spark.createDataFrame(rows, "k int, v string").repartition(5)
    write_ordered(df, str(tmp_path / "out"), ["k"], descending)
    got = [(r.position, r.k) for r in read_ordered(spark, str(tmp_path / "out")).orderBy("position").collect()]
    keys = sorted((k for k, _ in rows), key=lambda k: (k is not None, k or 0), reverse=descending)
    assert got == list(enumerate(keys))
    for file in (tmp_path / "out").glob("*.parquet"):
        own = [r.position for r in spark.read.parquet(str(file)).collect()]
        assert own == sorted(own)


def test_an_empty_frame_has_no_positions(spark, tmp_path):
    write_ordered(spark.createDataFrame([], "k int"), str(tmp_path / "out"), ["k"])
    assert read_ordered(spark, str(tmp_path / "out")).count() == 0


@pytest.mark.parametrize("positions", [[0, 1, 3], [0, 1, 1], [1, 2, 3]])
def test_a_broken_order_is_an_error(spark, tmp_path, positions):
    spark.createDataFrame([(p,) for p in positions], "position long").coalesce(1).write.parquet(str(tmp_path / "out"))
    with pytest.raises(RuntimeError, match="not in order"):
        read_ordered(spark, str(tmp_path / "out"))


def test_files_that_overlap_are_an_error(spark, tmp_path):
    for own in ([0, 2], [1, 3]):
        spark.createDataFrame([(p,) for p in own], "position long").coalesce(1).write.mode("append").parquet(str(tmp_path / "out"))
    with pytest.raises(RuntimeError, match="not in order"):
        read_ordered(spark, str(tmp_path / "out"))
