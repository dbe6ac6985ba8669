import pytest

from linesmith.sources import published
from linesmith.sources.published import Taken, commit, draft, publish, published_number, published_weeks, read_published, week_in_order
from .conftest import rows

SCHEMA = "season int, week int, game_id long, team_id long, pos int, note string"


def table(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_readers_see_old_or_new_weeks(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read_published(spark, path) is None and published_number(spark, path) == (0, None)
    assert publish(table(spark, (2024, 1, 1, 10, 0, "a"), (2024, 1, 1, 11, 1, "b"), (2024, 2, 2, 12, 0, "c")), path, "one")
    half = draft(table(spark, (2024, 2, 2, 12, 0, "new"), (2024, 3, 3, None, 0, "d")), path, "two")
    reader = read_published(spark, path)
    assert rows(reader, "week", "note") == [(1, "a"), (1, "b"), (2, "c")]
    assert commit(half) and not commit(half)
    assert rows(read_published(spark, path), "week", "note") == [(1, "a"), (1, "b"), (2, "new"), (3, "d")]
    assert rows(reader, "week", "note") == [(1, "a"), (1, "b"), (2, "c")]
    assert rows(read_published(spark, path, number=1), "note") == [("a",), ("b",), ("c",)]
    assert rows(read_published(spark, path, season=2024, week=2), "note") == [("new",)]
    assert read_published(spark, path, season=2023) is None
    assert rows(published_weeks(spark, path), "week", "batch", "rows", "games", "unknown_teams", "misses") == [
        (1, "one", 2, 1, 0, 0), (2, "two", 1, 1, 0, 0), (3, "two", 1, 1, 1, 0)]


def test_a_batch_is_published_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert publish(table(spark, (2024, 1, 1, 1, 0, "a")), path, "b1")
    assert not publish(table(spark, (2024, 1, 1, 1, 0, "other")), path, "b1")
    assert rows(read_published(spark, path), "note") == [("a",)]
    assert publish(table(spark, (2024, 1, 1, 1, 0, "other")), path)
    assert rows(read_published(spark, path), "note") == [("other",)]


def test_two_writers_and_an_unfinished_entry(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish(table(spark, (2024, 1, 1, 1, 0, "a")), path, "first")
    mine = draft(table(spark, (2024, 2, 2, 1, 0, "mine")), path, "mine")
    theirs = draft(table(spark, (2024, 3, 3, 1, 0, "theirs")), path, "theirs")
    claim, met = published._claim, []

    def slow(spark_, path_, number, name):
        if not met:  # the other writer is faster once
            met.append(number)
            assert commit(theirs)
        claim(spark_, path_, number, name)
    monkeypatch.setattr(published, "_claim", slow)
    assert commit(mine) and met == [2]
    assert rows(read_published(spark, path), "week", "note") == [(1, "a"), (2, "mine"), (3, "theirs")]
    with pytest.raises(Taken):
        claim(spark, path, 3, "x")
    (tmp_path / "t" / "log" / "000000000009").write_text("half-a-na")  # being written by someone
    assert published_number(spark, path)[0] == 3


def test_order_of_a_week_over_several_files(spark, tmp_path):
    path = str(tmp_path / "t")
    many = [(2024, 1, k, k % 7, (k * 37) % 500, "x" * (k % 90)) for k in range(500)] + [(2024, 2, 1, 1, 0, "y")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as if the week were large
    try:
        publish(table(spark, *many).repartition(7), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = published_weeks(spark, path).where("week = 1").first()["files"]
    assert len(files) > 1
    week = week_in_order(spark, path, 2024, 1)
    assert [r.pos for r in week.collect()] == list(range(500))
    plan = week._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan
    assert week_in_order(spark, path, 2024, 9) is None


def test_weeks_of_other_columns_and_types(spark, tmp_path):
    path = str(tmp_path / "t")
    base = "season int, week int, game_id long, team_id long, pos int"
    publish(spark.createDataFrame([(2024, 1, 1, 2, 0, 3.5)], base + ", `8_spread` double"), path)
    publish(spark.createDataFrame([(2024, 2, 1, 2, 0, 4.5)], base + ", `9_spread` double"), path)
    got = read_published(spark, path)
    assert rows(got, "week", "8_spread", "9_spread") == [(1, 3.5, None), (2, None, 4.5)]
    publish(spark.createDataFrame([(2024, 3, 1, 2, 0, "x")], base + ", `9_spread` string"), path)
    with pytest.raises(ValueError, match="9_spread"):
        read_published(spark, path)


def test_nothing_to_publish(spark, tmp_path):
    path = str(tmp_path / "t")
    assert publish(table(spark), path)
    assert read_published(spark, path) is None and published_weeks(spark, path).count() == 0
