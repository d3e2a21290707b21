"""What the catalog keeps, and files of any header in one scan."""

import pytest
from pyspark.sql import functions as F

from test_files import CURRENT, LEGACY, raw, written  # noqa: F401
from velomet.operators.trip_marts import daily_trips
from velomet.operators.unify import owned_rows
from velomet.plans import standins
from velomet.plans.queries import QUERIES
from velomet.sources import catalog, named_views, trip_files, trip_lines


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture()
def db(spark, tmp_path):
    spark.sql(f"CREATE DATABASE kept LOCATION '{tmp_path}/kept'")
    yield "kept"
    spark.sql("DROP DATABASE kept CASCADE")


def test_views_outlive_their_session(spark, raw, tmp_path, db):  # noqa: F811
    folders = written(spark, raw, tmp_path)
    one, two = spark.newSession(), spark.newSession()
    tables = named_views.deploy_unified(one, f"{db}.trips_unified", folders, f"{db}.trips_")
    assert tables == [f"{db}.trips_legacy_nyc", f"{db}.trips_current_nyc", f"{db}.trips_current_jc"]
    named_views.deploy_view(one, f"{db}.daily_trips", named_views.daily_trips_sql(f"{db}.trips_unified"))
    built = catalog.unified_from_folders(spark, folders)
    assert two.table(f"{db}.trips_unified").dtypes == built.dtypes
    assert rows(two.table(f"{db}.trips_unified")) == rows(built)
    assert rows(two.table(f"{db}.daily_trips")) == rows(daily_trips(built))
    # The newer layout's cutover still reaches the files through two views.
    plan = two.table(f"{db}.daily_trips")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThanOrEqual(start_time,2021-02-01T00:00)") == 2
    # New files count once the table is registered again; a folder that has none leaves the view alone.
    spark.read.parquet(folders["NYC", "legacy"]).write.mode("append").parquet(folders["NYC", "legacy"] + "/start_month=2014-08")
    named_views.deploy_unified(one, f"{db}.trips_unified", folders, f"{db}.trips_")
    assert spark.newSession().table(f"{db}.trips_unified").count() == built.count() + 2
    with pytest.raises(catalog.NoSource):
        named_views.deploy_unified(one, f"{db}.trips_unified", {("NYC", "legacy"): str(tmp_path / "none")}, f"{db}.x_")
    assert spark.newSession().table(f"{db}.trips_unified").count() == built.count() + 2
    assert not named_views.register_external(one, f"{db}.none", str(tmp_path / "none"))


def test_canonical_trips_as_sql(spark, sf_dir, tmp_path, db):
    """The text of the view gives every column as the builder does."""
    for era, typed in (("legacy", standins.legacy_typed(spark, sf_dir)), ("current", standins.current_typed(spark, sf_dir))):
        typed.filter("region = 'NYC'").drop("region", "source_file").write.parquet(f"{tmp_path}/{era}")
    folders = {("NYC", era): f"{tmp_path}/{era}" for era in ("legacy", "current")}
    named_views.deploy_unified(spark, f"{db}.trips", folders, f"{db}.t_")
    want = catalog.unified_from_folders(spark, folders)
    got = spark.table(f"{db}.trips")
    assert got.dtypes == want.dtypes
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert owned_rows(got).count() > 100


def test_bucketed_tables_need_no_shuffle(spark, sf_dir):
    pivot = QUERIES["observation_pivot_bucketed"](spark, sf_dir)
    assert "Exchange" not in pivot._jdf.queryExecution().executedPlan().toString()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = QUERIES["daily_trips_weather_bucketed"](spark, sf_dir)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() > 1_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


# ---------------------------------------------------------------- one scan
def test_one_scan_equals_file_by_file(spark, raw):  # noqa: F811
    (raw / "blank.csv").write_text("\n1,2\n")
    (raw / "empty.csv").write_text("")
    (raw / "deep").mkdir()
    more = LEGACY.replace("Trip Duration", '"Trip (Duration)"').replace("Harbor Sq", '"Harbor ""Old"" Sq, N"')
    (raw / "deep" / "JC-201408-more.csv").write_text(more + "\n" + more.split("\n")[0] + "\n")
    paths = [str(p) for p in sorted(raw.rglob("*.csv"))]
    plan = trip_files.plan_files(spark, paths)
    planned = trip_lines.layouts(spark, str(raw))
    table = {r.source_file.rsplit("/", 1)[1]: r for r in planned[0].collect()}
    assert {n for n, r in table.items() if r.error} == {"notes.csv", "blank.csv"} == {p.rsplit("/", 1)[1] for p in plan.errors} - {"empty.csv"}
    assert table["blank.csv"].error == "no header" and table["notes.csv"].error == "no known layout has the columns a, b"
    for group in plan.groups:
        for path in group.paths:
            r = table[path.rsplit("/", 1)[1]]
            assert (r.era, r.names[: len(group.columns)]) == (group.era, list(group.columns))
    for era in ("legacy", "current"):
        got, want = trip_lines.typed_lines(spark, str(raw), era, planned), trip_files.typed_trips(spark, plan, era)
        assert got.dtypes == want.dtypes
        header = F.coalesce(F.col("start_station_name"), F.lit("")) != "Start Station Name"  # a repeated header is no trip
        assert rows(got) == rows(want.filter(header))
    assert trip_lines.broken_lines(spark, str(raw), planned).count() == 0


def test_line_breaks_are_set_aside(spark, tmp_path):
    broken = CURRENT.replace("Orchard Wk", '"Orchard\nWk"') + CURRENT.split("\n")[1].replace("42", "43") + "\n"
    (tmp_path / "202205.csv").write_text(broken)
    planned = trip_lines.layouts(spark, str(tmp_path))
    assert [r.ride_id for r in trip_lines.typed_lines(spark, str(tmp_path), "current", planned).collect()] == ["F00DF00D00000043"]
    assert sorted(r.line[:3] for r in trip_lines.broken_lines(spark, str(tmp_path), planned).collect()) == ["F00", 'Wk"']


def test_many_files_take_two_jobs(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"{i}.csv").write_text(CURRENT if i % 3 else LEGACY)
    planned = trip_lines.layouts(spark, str(tmp_path))
    both = [trip_lines.typed_lines(spark, str(tmp_path), era, planned).count() for era in ("legacy", "current")]
    assert both == [200, 200]
