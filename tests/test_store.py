import pytest

from linesmith.schema import weekly_schema
from linesmith import session
from linesmith.session import clear_scratch, scratch_folder, staged
from linesmith.sources.store import (append_new, has_rows, load_week, pending, preview,
                                     read_weekly, write_weekly)
from linesmith.sources.weekly_csv import read_weekly_csv, union_tables
from linesmith.streaming.ingest import capture_stream, ingest_available, merged
from .conftest import rows

SCHEMA = "season int, week int, game_id long, note string"


def table(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_write_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    report = write_weekly(table(spark, (2024, 1, 1, "a"), (2024, 2, 2, "b"), (2024, 2, 3, None)), path)
    assert (report.rows, report.columns, report.path) == (3, 4, path)
    write_weekly(table(spark, (2024, 2, 9, "new")), path)
    assert rows(read_weekly(spark, path), "week", "game_id") == [(1, 1), (2, 9)]


def test_routine_run_adds_only_new_weeks(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read_weekly(spark, path) is None
    first = table(spark, (2024, 1, 1, "old"))
    assert append_new(first, path).rows == 1
    again = table(spark, (2024, 1, 1, "changed"), (2024, 2, 5, "new"))
    assert rows(pending(again, read_weekly(spark, path)), "game_id") == [(5,)]
    assert append_new(again, path).rows == 1
    assert append_new(again, path).rows == 0
    assert rows(read_weekly(spark, path), "game_id", "note") == [(1, "old"), (5, "new")]


def test_point_load_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    write_weekly(table(spark, (2024, 1, 1, "a"), (2024, 2, 2, "b")), path)
    week = load_week(read_weekly(spark, path), 2024, 2)
    plan = week._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season" in plan
    assert rows(preview(week, ["game_id"])) == [(2,)]
    assert has_rows(week) and not has_rows(load_week(read_weekly(spark, path), 2024, 9))


def test_csv_sink_keeps_season_and_week_inside(spark, tmp_path):
    path = str(tmp_path / "csv")
    data = [(2024, 1, 1, None), (2024, 2, 2, 'x, "y"')]
    write_weekly(spark.createDataFrame(data, "season int, week int, game_id long, team string"), path, fmt="csv")
    write_weekly(spark.createDataFrame([(2024, 2, 3, "z")], "season int, week int, game_id long, team string"), path, fmt="csv")
    assert rows(read_weekly_csv(spark, path), "season", "week", "game_id", "team") == [(2024, 1, 1, None), (2024, 2, 3, "z")]
    files = list((tmp_path / "csv" / "season_folder=2024" / "week_folder=1").glob("*.csv"))
    assert [f.read_text().splitlines()[0] for f in files] == ["season,week,game_id,team"]


def test_weeks_of_other_books_keep_their_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    base = "game_id long, season int, week int"
    write_weekly(spark.createDataFrame([(1, 2024, 1, 3.5)], base + ", `8_spread` double"), path)
    append_new(spark.createDataFrame([(2, 2024, 2, 4.5, "x")], base + ", `9_spread` double, note string"), path)
    got = read_weekly(spark, path)
    assert got.columns == ["game_id", "season", "week", "8_spread", "9_spread", "note"]
    assert rows(got) == [(1, 2024, 1, 3.5, None, None), (2, 2024, 2, None, 4.5, "x")]
    with pytest.raises(ValueError, match="note"):
        write_weekly(spark.createDataFrame([(3, 2024, 3, 1)], base + ", note int"), path)


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_files_with_other_books_do_not_shift(spark, tmp_path):
    write(tmp_path / "2021", "week_1.csv", "game_id,team_id,season,week,team,8_spread,20_total\n"
          "1,10,2021,1,A,3.5,44\n\n1,11,2021,1,B,-3.5,\n")
    write(tmp_path / "2021", "week_2.csv", "game_id,team_id,season,week,team,8_spread,20_total\n"
          "2,10,2021,2,A,7,41\n")
    write(tmp_path / "2022", "week_1.csv", "game_id,team_id,season,week,team,9_spread,20_total\n"
          "3,12,2022,1,C,1.5,50\n")
    df = read_weekly_csv(spark, str(tmp_path))
    assert df.columns == ["game_id", "team_id", "season", "week", "team", "8_spread", "9_spread",
                          "20_total"]
    assert dict(df.dtypes)["season"] == "int" and dict(df.dtypes)["9_spread"] == "double"
    assert rows(df) == sorted([(1, 10, 2021, 1, "A", 3.5, None, 44.0),
                               (1, 11, 2021, 1, "B", -3.5, None, None),
                               (2, 10, 2021, 2, "A", 7.0, None, 41.0),
                               (3, 12, 2022, 1, "C", None, 1.5, 50.0)], key=repr)
    assert df.select("team").distinct().count() == 3


def test_cells_that_files_hold(spark, tmp_path):
    write(tmp_path, "week_1.csv", "\ufeffgame_id,team_id,season,week,team,rotation,8_spread\r\n"
          '1,1549.0,2021,1,"A, ""the"" team",nan,3.5\r\n9007199254740993,,2021,1.0,B,101.5,pk\r\n3,x,2021,1\r\n')
    df = read_weekly_csv(spark, str(tmp_path), misses="misses")
    assert rows(df) == sorted([(1, 1549, 2021, 1, 'A, "the" team', None, 3.5, 0), (9007199254740993, None, 2021, 1, "B", None, None, 2),
                               (3, None, 2021, 1, None, None, None, 1)], key=repr)


def test_no_files(spark, tmp_path):
    assert read_weekly_csv(spark, str(tmp_path)).count() == 0


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, 2)], "k int, a int")
    b = spark.createDataFrame([(3, "x")], "k int, b string")
    assert rows(union_tables([a, b])) == [(1, 2, None), (3, None, "x")]


def test_stream_sees_each_file_once_and_merges_a_week(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    def run():
        return ingest_available(spark, capture_stream(spark, source, SCHEMA), target, progress, keys=["game_id"])

    table(spark, (2024, 1, 1, "a"), (2024, 2, 2, "b"), (2024, 2, 3, "c")).coalesce(1).write.parquet(source)
    assert run() == 3 and run() == 0
    table(spark, (2024, 2, 3, "corrected"), (2024, 2, 4, "new")).coalesce(1).write.mode("append").parquet(source)
    assert run() == 3
    assert rows(read_weekly(spark, target), "week", "game_id", "note") == [
        (1, 1, "a"), (2, 2, "b"), (2, 3, "corrected"), (2, 4, "new")]


def test_an_older_copy_does_not_win(spark):
    stored = table(spark, (2024, 1, 1, "2"), (2024, 2, 9, "kept where it is"))
    fresh = table(spark, (2024, 1, 1, "1"), (2024, 1, 2, "1"))
    assert rows(merged(fresh, stored, ["game_id"], ["note"]), "game_id", "note") == [(1, "2"), (2, "1")]
    assert rows(merged(fresh, stored, ["game_id"], []), "game_id", "note") == [(1, "1"), (2, "1")]


class Session:
    """A session that only knows its settings and master."""

    def __init__(self, settings, master, folder=None):
        self.conf, self.sparkContext, self.master, self.folder = settings, self, master, folder

    def getCheckpointDir(self):
        return self.folder


def test_scratch_follows_the_session(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_made", [])
    shared = Session({"spark.checkpoint.dir": "hdfs://h/shared/"}, "yarn")
    assert scratch_folder(shared, "x").startswith("hdfs://h/shared/linesmith-x-")
    assert scratch_folder(shared, "x") != scratch_folder(shared, "x")
    assert scratch_folder(Session({}, "local[2]"), "x")
    assert scratch_folder(Session({}, "yarn", "hdfs://h/c"), "x").startswith("hdfs://h/c/linesmith-x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(Session({}, "yarn"), "x")
    df = staged(table(spark, (2024, 1, 1, None)), "t")
    assert rows(df) == [(2024, 1, 1, None)] and df.schema == table(spark).schema


def test_scratch_is_cleared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_made", [])
    monkeypatch.setattr(session, "shared_root", lambda _: f"file://{tmp_path}")
    staged(table(spark, (2024, 1, 1, None)), "t")
    assert len(list(tmp_path.iterdir())) == 1
    assert clear_scratch(spark) == 1 and not list(tmp_path.iterdir())


def test_types_follow_names():
    assert [f.dataType.simpleString() for f in weekly_schema(
        ["game_id", "score", "date", "8_total_odds", "total_dollar_pct"])] == [
        "bigint", "int", "string", "double", "double"]


def test_lines_carry_no_file_and_headers_no_lines(spark, tmp_path):
    """No array is exploded and no row holds a file: lines are joined with one short row per file."""
    write(tmp_path, "week_1.csv", "game_id,team_id,8_spread\n" + "".join(f"{k},{k},1.5\n" for k in range(3000)))
    write(tmp_path, "week_2.csv", "\n  \nteam_id,game_id,game_id,9_spread\n5,6,7,8\n")
    df = read_weekly_csv(spark, str(tmp_path))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "collect" not in plan
    assert df.count() == 3001 and rows(df.where("`9_spread` is not null"), "game_id", "team_id", "9_spread") == [(6, 5, 8.0)]


def test_a_file_read_in_blocks(spark, tmp_path):
    write(tmp_path, "week_1.csv", "game_id,team_id,team\n" + "".join(f'{k},{k},"a, {k}"\n' for k in range(20_000)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    try:
        got = read_weekly_csv(spark, str(tmp_path))
        assert got.count() == 20_000 and got.where("team = concat('a, ', game_id)").count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_state_keeps_the_newest_row_of_a_key(spark, tmp_path):
    from linesmith.streaming.ingest import newest_by_state, read_newest
    source, log, progress = (str(tmp_path / n) for n in ("in", "log", "progress"))
    schema = "game_id long, team_id long, version int, note string"

    def run(*data):
        spark.createDataFrame(list(data), schema).coalesce(1).write.mode("append").parquet(source)
        stream = capture_stream(spark, source, schema)
        return newest_by_state(stream, log, progress, ["game_id", "team_id"], ["version"])

    def now():
        kinds = spark.createDataFrame([], schema).schema
        return rows(read_newest(spark, log, kinds, ["game_id", "team_id"]))
    assert run((1, 10, 2, "a"), (1, 11, 2, "b"), (1, 10, 1, "older")) == 2
    assert run((1, 10, 3, "new"), (2, 12, 1, "c")) == 2
    run((1, 10, 1, "late"), (1, 11, 2, "b"), (1, 11, 2, "a"))
    assert now() == [(1, 10, 3, "new"), (1, 11, 2, "b"), (2, 12, 1, "c")]
