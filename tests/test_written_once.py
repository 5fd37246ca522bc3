"""Tables that several steps read are worked out once."""

import pytest
from pyspark.sql import functions as F

from busgrid.operators import resolve
from busgrid.plans import gtfs, integrity
from busgrid.plans.convert import Options, timetable
from busgrid.plans.kept import KeptTables
from busgrid.session import work_folder
from busgrid.sources.tables import SalesTimetable


class Counting:
    """Staged tables that count how often they are asked for."""

    def __init__(self, staged):
        self.staged, self.asked = staged, []

    def __getattr__(self, name):
        self.asked.append(name)
        return getattr(self.staged, name)


def test_a_load_works_out_each_staged_table_once(spark, sf_dir, tmp_path):
    t = SalesTimetable(spark, sf_dir)
    load = t.loads(2, 4)[0]
    staged = Counting(load)
    kept = KeptTables(spark, str(tmp_path / "kept"), Options(keep_history=True))
    kept.add(staged, t.no_rejects, load.feed_order, 0)
    assert len(staged.asked) == len(set(staged.asked))
    assert kept.read("calls").count() > 0


@pytest.mark.parametrize("table", ["lines", "carriers", "stops", "trips", "time_codes", "calls"])
def test_rows_of_a_load_are_those_of_its_feeds(spark, sf_dir, table):
    t = SalesTimetable(spark, sf_dir)
    seqs = [{r[0] for r in getattr(f, table).select("feed_seq").distinct().collect()} for f in t.loads(2, 4)]
    assert [s - {0, 1, 2, 3, 4, 5, 6} for s in seqs] == [set()] * 3
    assert seqs[0] <= {0, 1} and seqs[1] <= {2, 3} and seqs[2] <= {4, 5, 6} and all(seqs)
    assert sum(getattr(f, table).count() for f in t.loads(2, 4)) == getattr(t, table).count()


def test_findings_work_out_a_table_once(spark):
    calls = spark.sparkContext.accumulator(0)
    columns = {name: gtfs.COLUMNS[name] for name in gtfs.COLUMNS}

    def row(name):
        return spark.range(1).select(*[F.lit("1").alias(c) for c in columns[name]])

    @F.udf("string")
    def counted(value):
        calls.add(1)
        return value

    tables = {name: row(name) for name in columns}
    tables["trips"] = tables["trips"].withColumn("trip_id", counted("trip_id"))
    assert integrity.findings(tables).count() == 0
    assert calls.value == 1


def test_exceptions_of_services_keep_text_and_type(spark):
    services = spark.sql(
        "select 's' service_id, array(date'2024-01-05') runs, array(date'2024-02-06') runs_not"
    )
    rows = {tuple(r) for r in gtfs.calendar_dates(services).collect()}
    assert rows == {("s", "20240105", 1), ("s", "20240206", 2)}


def test_items_are_read_and_joined_once_for_all_loads(spark, sf_dir):
    t = SalesTimetable(spark, sf_dir)
    for load in t.loads(2, 4):
        for table in ("calls", "time_codes", "stops"):
            plan = getattr(load, table)._jdf.queryExecution().optimizedPlan().toString()
            assert "l_linenumber" not in plan and "o_orderdate" not in plan
            # Feeds are folders: those of other loads are not read.
            scan = getattr(load, table)._jdf.queryExecution().executedPlan().toString()
            assert "PartitionFilters: [isnotnull(feed_seq" in scan


def test_calls_meet_their_trips_once(spark, sf_dir, monkeypatch):
    t = SalesTimetable(spark, sf_dir)
    load = t.loads(7)[0]
    told = []
    state = resolve.with_trip_state
    monkeypatch.setattr(resolve, "with_trip_state", lambda *a: told.append(1) or state(*a))
    made = timetable(load, t.no_rejects, load.feed_order, work_folder(spark, "t"), Options(keep_history=True))
    assert told == [1]
    for rows in (made.calls, made.located_calls, made.rejects):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert "l_orderkey" not in plan or rows is made.rejects
    usual = resolve.attached_calls(made.located_calls, made.trips)
    assert made.calls.columns == usual.columns
    assert made.calls.exceptAll(usual).count() == usual.exceptAll(made.calls).count() == 0


def test_codes_of_keys_with_null_parts_are_kept(spark):
    rows = spark.createDataFrame([("f", None, 1, "x"), ("f", "a", 1, "y"), ("f", "a", 2, "z")], "feed_id string, line_number string, trip_number int, v string")
    keys = rows.filter("v in ('x', 'y')").drop("v")
    found = resolve.of_keys(rows, keys, ["feed_id", "line_number", "trip_number"])
    assert sorted(r.v for r in found.collect()) == ["x", "y"]
