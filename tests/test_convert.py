import csv
import glob

import feedfiles as ff
import pytest
from pyspark.sql import functions as F

from busgrid import sinks
from busgrid.functions.keys import content_key
from busgrid.plans import integrity
from busgrid.plans.convert import TABLES, Options, append_feeds, convert, resolve_feeds
from busgrid.sources import feeds
from busgrid.plans.kept import KeptTables
from busgrid.streaming.arrivals import add_batch, land_new_zips, update_tables


def read_csv(folder):
    rows = []
    for part in sorted(glob.glob(f"{folder}/part-*.csv")):
        with open(part, encoding="utf-8", newline="") as f:
            rows += list(csv.DictReader(f))
    return rows


def key(spark, *parts):
    return spark.range(1).select(content_key(*[F.lit(p) for p in parts])).first()[0]


@pytest.mark.parametrize("version", ["1.9", "1.11"])
def test_one_feed_to_gtfs(spark, tmp_path, version):
    files = ff.feed(
        version,
        carriers=[{}, {"ico": "00000077", "name": "Jiný, s.r.o.", "www": ""}],
        lines=[{"vehicle": "E"}],
        trips=[{}, {"number": "2", "codes": ("2", "3")}],
        alternatives=[{"trip": "2", "ico": "77"}],
        calls=[
            {"departure": "2310"},
            {"tariff": "2", "stop": "2", "km": "5", "arrival": "<", "departure": "<"},
            {"tariff": "3", "stop": "2", "km": "9", "arrival": "0005"},
            {"trip": "2", "tariff": "3", "stop": "2", "km": "0", "departure": "0600"},
            {"trip": "2", "tariff": "2", "stop": "1", "km": "", "arrival": "", "departure": ""},
            {"trip": "2", "tariff": "1", "stop": "1", "km": "4", "arrival": "0610", "departure": "0611"},
        ],
        codes=[{"trip": "2", "kind": "4", "frm": "06012024"}],
    )
    ff.write_folder(tmp_path / "in", "a", files)
    result = convert(spark, str(tmp_path / "in"), str(tmp_path / "out"), tables_dir=str(tmp_path / "kept"))
    discr = "-1" if version == "1.9" else "1"
    route = key(spark, "a", "100001", discr)
    trip1, trip2 = key(spark, "a", "100001", discr, "1"), key(spark, "a", "100001", discr, "2")
    carrier = key(spark, "00012345", "Žlutý bus", "Ostrava")
    other = key(spark, "00000077", "Jiný, s.r.o.", "Ostrava")
    stop1 = key(spark, "Ostrava", "Poruba", "Vřesinská")
    stop2 = key(spark, "Ostrava", "Poruba", 'Hlavní, "u mostu"')

    out = {name: read_csv(tmp_path / "out" / f"{name}.txt") for name in (
        "agency", "calendar", "calendar_dates", "routes", "stop_times", "stops", "trips")}
    by = lambda name, k: {r[k]: r for r in out[name]}
    assert by("agency", "agency_id")[carrier] == {
        "agency_id": carrier, "agency_name": "Žlutý bus, Ostrava",
        "agency_url": "http://www.zluty.example", "agency_timezone": "Europe/Prague",
        "agency_lang": "cs", "agency_phone": "123", "agency_email": "info@zluty.example",
    }
    assert by("agency", "agency_id")[other]["agency_name"] == "Jiný, s.r.o., Ostrava"
    assert out["routes"] == [{
        "route_id": route, "agency_id": carrier, "route_short_name": "100001",
        "route_long_name": "Město - Vesnice", "route_type": "3" if version == "1.9" else "0",
    }]
    assert by("stops", "stop_id")[stop2]["stop_name"] == 'Ostrava,Poruba,Hlavní, "u mostu"'
    assert float(by("stops", "stop_id")[stop1]["stop_lat"]) == 0
    times = sorted((r["trip_id"], int(r["stop_sequence"]), r["arrival_time"], r["departure_time"], r["stop_id"]) for r in out["stop_times"])
    assert times == sorted([
        (trip1, 1, "23:10:00", "23:10:00", stop1),
        (trip1, 2, "24:05:00", "24:05:00", stop2),
        (trip2, 1, "06:00:00", "06:00:00", stop2),
        (trip2, 2, "06:10:00", "06:11:00", stop1),
    ])
    services = {r["trip_id"]: r["service_id"] for r in out["trips"]}
    assert {r["route_id"] for r in out["trips"]} == {route}
    week = by("calendar", "service_id")
    days = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
    assert [week[services[trip1]][d] for d in days] == list("1111100")
    assert [week[services[trip2]][d] for d in days] == list("0000011")
    assert (week[services[trip1]]["start_date"], week[services[trip1]]["end_date"]) == ("20240101", "20241231")
    dates = {(r["service_id"], r["date"], r["exception_type"]) for r in out["calendar_dates"]}
    # Working days leave out holidays from Monday to Friday.
    off = ["0101", "0329", "0401", "0501", "0508", "0705", "1028", "1224", "1225", "1226"]
    assert {d for s, d, t in dates if s == services[trip1]} == {"2024" + d for d in off}
    # Sundays and holidays gain those on other days; the excluded Saturday stays out.
    assert {(d, t) for s, d, t in dates if s == services[trip2]} == {
        ("2024" + d, "1") for d in [*off, "0706", "0928"]
    } | {("20240106", "2")}

    assert result.rejects.count() == 0
    assert {r.trip_number: r.carrier_key for r in result.trips.collect()} == {1: carrier, 2: other}
    kept = spark.read.parquet(str(tmp_path / "kept" / "calls"))
    assert kept.count() == 5
    assert integrity.findings(result.gtfs()).collect() == []

    wide = result.wide()
    assert len(wide.columns) == 25
    rows = wide.collect()
    assert [(r.trip_number, r.tariff_number, r.time, r.terminus) for r in rows] == [
        (1, 1, "23:10:00", "počáteční zastávka"),
        (1, 3, "00:05:00", "konečná zastávka"),
        (2, 3, "06:00:00", "počáteční zastávka"),
        (2, 1, "06:11:00", None),
        (2, 2, "00:00:00", "konečná zastávka"),
    ]
    assert {r.does_not_run for r in rows if r.trip_number == 2} == {"2024-01-06"}
    sinks.save_wide(wide, f"wide_{version.replace('.', '_')}")
    assert spark.table(f"wide_{version.replace('.', '_')}").count() == 5


def test_untimed_calls_are_left_out_at_load_for_one_version(spark, tmp_path):
    for version in ("1.10", "1.11"):
        ff.write_folder(tmp_path / "in", version, ff.feed(version, calls=[{"departure": "0800"}, {"tariff": "2", "stop": "2"}]))
    rows = feeds.land(feeds.read_rows(spark, str(tmp_path / "in")), str(tmp_path / "rows"))
    result = resolve_feeds(spark, rows)
    assert {r.feed_id: r["count"] for r in result.calls.groupBy("feed_id").count().collect()} == {"1.10": 1, "1.11": 2}


def test_history_keeps_one_current_version(spark, tmp_path):
    old = ff.feed(lines=[{"frm": "01012023", "to": "31122024", "name": "old"}])
    new = ff.feed(lines=[{"frm": "01062024", "to": "31122025", "name": "new"}])
    late = ff.feed(lines=[{"frm": "01012022", "to": "31122022", "name": "late"}])
    for name, files in (("1", old), ("2", new), ("3", late)):
        ff.write_folder(tmp_path / "in", name, files)
    rows = feeds.land(feeds.read_rows(spark, str(tmp_path / "in")), str(tmp_path / "rows"))
    result = resolve_feeds(spark, rows, Options(keep_history=True))
    lines = {r.line_name: r for r in result.lines.collect()}
    assert {n: (r.is_accepted, r.is_current, str(r.valid_to)) for n, r in lines.items()} == {
        "old": (True, False, "2024-06-01"),
        "new": (True, True, "2025-12-31"),
        "late": (False, False, "2022-12-31"),
    }
    assert {r.feed_id for r in result.trips.select("feed_id").collect()} == {"1", "2"}
    tables = result.gtfs()
    assert [r.route_long_name for r in tables["routes"].collect()] == ["new"]
    assert tables["trips"].count() == 1 and tables["stop_times"].count() == 2
    # The calendar of the ended version keeps the validity it was loaded with.
    assert {r.end_date for r in tables["calendar"].collect()} == {"20241231", "20251231"}
    order = spark.createDataFrame([("1", 3), ("2", 2), ("3", 1)], "feed_id string, feed_seq int")
    turned = resolve_feeds(spark, rows, Options(keep_history=True), order)
    assert {r.line_name: r.is_current for r in turned.lines.collect()} == {"old": False, "new": True, "late": False}


def test_unresolved_rows_are_reported(spark, tmp_path):
    files = ff.feed(
        lines=[{}, {"number": "100002", "ico": "99"}],
        trips=[{}, {"number": "2", "codes": ("8",)}, {"line": "100009"}],
        alternatives=[{"ico": "98"}],
        calls=[{"departure": "0800"}, {"stop": "9", "departure": "0801"}, {"trip": "7", "departure": "0802"}],
    )
    ff.write_folder(tmp_path / "in", "a", files)
    rows = feeds.land(feeds.read_rows(spark, str(tmp_path / "in")), str(tmp_path / "rows"))
    result = resolve_feeds(spark, rows)
    found = sorted((r.table, r.reason) for r in result.rejects.collect())
    assert found == [
        ("calls", "unknown stop"),
        ("calls", "unknown trip"),
        ("lines", "unknown carrier"),
        ("trip_carriers", "unknown carrier"),
        ("trips", "unknown fixed code"),
        ("trips", "unknown line"),
    ]
    assert result.calls.count() == 1


def test_arriving_zips_land_once_and_locations_match(spark, tmp_path):
    root, landing = tmp_path / "in", str(tmp_path / "landing")
    ff.write_zip(root, "a.zip", ff.feed())
    run = lambda: land_new_zips(spark, str(root), landing, str(tmp_path / "checkpoint")).awaitTermination()
    run()
    ff.write_zip(root, "b.zip", ff.feed(stops=[{"number": "7", "place": "Nová"}], calls=[]))
    run()
    run()
    rows = feeds.read_landed(spark, landing)
    whole = feeds.read_rows(spark, str(root))
    assert sorted(map(str, rows.collect())) == sorted(map(str, whole.select(*rows.columns).collect()))
    result = resolve_feeds(spark, rows, Options(by_number=True))
    places = tmp_path / "places.csv"
    places.write_text("1,49.8,18.2\n7,49.9,18.3\n", encoding="utf-8")
    from busgrid.sources.locations import read_locations

    located = result.gtfs(read_locations(spark, str(places), True), True)["stops"].collect()
    assert {r.stop_name.split(",")[2]: (r.stop_lat, r.stop_lon) for r in located} == {
        "Vřesinská": (49.8, 18.2), "Hlavní": (0.0, 0.0), "Nová": (49.9, 18.3),
    }


def test_no_row_is_lost_between_stages(spark, tmp_path):
    files = ff.feed(
        lines=[{"name": "old"}, {}, {"number": "100002", "ico": "9"}],
        trips=[{"codes": ("2",)}, {}, {"number": "2", "codes": ("9",)}, {"line": "100002", "number": "3"},
               {"line": "100003", "number": "4"}],
        calls=[
            {"departure": "0800"}, {"tariff": "2", "km": "5", "arrival": "0810"},
            {"trip": "2", "departure": "0900"}, {"line": "100002", "trip": "3", "departure": "0900"},
            {"line": "100003", "trip": "4", "departure": "0900"}, {"trip": "7", "departure": "1000"},
            {"tariff": "3", "km": "x", "arrival": "0900"},
        ],
        codes=[{"kind": "2", "frm": "24122024"}, {"trip": "8", "kind": "2", "frm": "24122024"}],
    )
    ff.write_folder(tmp_path / "in", "a", files)
    rows = feeds.land(feeds.read_rows(spark, str(tmp_path / "in")), str(tmp_path / "rows"))
    result = resolve_feeds(spark, rows)
    lost = {(r.table, r.reason): r["count"] for r in result.rejects.groupBy("table", "reason").count().collect()}
    assert lost == {
        ("lines", "repeated key"): 1,
        ("lines", "unknown carrier"): 1,
        ("trips", "repeated key"): 1,
        ("trips", "unknown fixed code"): 1,
        ("trips", "unknown line"): 2,
        ("calls", "rejected trip"): 3,
        ("calls", "unknown trip"): 1,
        ("calls", "missing or malformed value"): 1,
        ("time_codes", "unknown trip"): 1,
    }
    kept = {"lines": result.lines, "trips": result.trips, "calls": result.calls}
    staged = {r.table: r["count"] for r in rows.groupBy("table").count().collect()}
    for name, frame in kept.items():
        rejected = sum(n for (table, _), n in lost.items() if table == name)
        assert frame.count() + rejected == staged[name]


@pytest.mark.parametrize("keep_history", [False, True])
def test_appended_feeds_equal_a_load_of_all(spark, tmp_path, keep_history):
    feed = lambda year, **more: ff.feed(
        lines=[{"frm": f"0101{year}", "to": f"3112{year}"}, {"number": "100002"}],
        trips=[{}, {"line": "100002", "number": "5", "codes": ("3",)}],
        calls=[
            {"departure": "0800"}, {"tariff": "2", "stop": "2", "km": "5", "arrival": "0810"},
            {"line": "100002", "trip": "5", "departure": "0900"},
        ],
        codes=[{"kind": "2", "frm": "24122024"}],
        **more,
    )
    ff.write_folder(tmp_path / "in", "2024", feed(2024))
    first = feeds.land(feeds.read_rows(spark, str(tmp_path / "in")), str(tmp_path / "rows1"))
    ff.write_folder(tmp_path / "in", "2023", feed(2023, carriers=[{"www": "later"}, {"ico": "7", "name": "New"}]))
    ff.write_folder(tmp_path / "in", "2025", feed(2025, stops=[{"number": "2"}, {"number": "1", "place": "Jiná"}]))
    every = feeds.land(feeds.read_rows(spark, str(tmp_path / "in")), str(tmp_path / "rows2"))
    options = Options(keep_history=keep_history)
    sinks.keep_tables(resolve_feeds(spark, first, options).tables(), str(tmp_path / "kept"))
    kept = {name: spark.read.parquet(f"{tmp_path}/kept/{name}") for name in TABLES}
    found = append_feeds(spark, kept, every, options)
    want = resolve_feeds(spark, every, options, feed_order=found["feeds"]).tables()

    def rows(frame):
        # Line numbers tell the order of a file's rows; they depend on how files share tasks.
        columns = sorted(set(frame.columns) - {"line_no"})
        return sorted(map(str, frame.select(*columns).collect()))

    for name in TABLES:
        assert rows(found[name]) == rows(want[name]), name
    assert found["trips"].count() > kept["trips"].count()


def _arrivals(tmp_path, year, **more):
    return ff.feed(
        lines=[{"frm": f"0101{year}", "to": f"3112{year}"}, {"number": "100002"}],
        trips=[{}, {"line": "100002", "number": "5", "codes": ("3",)}],
        calls=[
            {"departure": "0800"}, {"tariff": "2", "stop": "2", "km": "5", "arrival": "0810"},
            {"line": "100002", "trip": "5", "departure": "0900"},
        ],
        codes=[{"kind": "2", "frm": "24122024"}],
        **more,
    )


def test_arriving_feeds_reach_the_kept_tables(spark, tmp_path):
    root, options = tmp_path / "in", Options(keep_history=True)
    kept = KeptTables(spark, str(tmp_path / "kept"), options)

    def run():
        update_tables(spark, str(root), kept, str(tmp_path / "checkpoint"), 2).awaitTermination()

    def rows(frame):
        columns = sorted(set(frame.columns) - {"line_no"})
        return sorted(map(str, frame.select(*columns).collect()))

    ff.write_zip(root, "2024.zip", _arrivals(tmp_path, 2024))
    ff.write_folder(root, "2025", _arrivals(tmp_path, 2025, stops=[{"number": "2"}, {"number": "1", "place": "Jiná"}]))
    run()
    later = _arrivals(tmp_path, 2023, carriers=[{"www": "later"}, {"ico": "7", "name": "New"}])
    inner = {"2022.zip": ff.zipped(later), "2026.zip": ff.zipped(_arrivals(tmp_path, 2026))}
    ff.write_zip(root, "more.zip", inner)
    run()
    run()
    whole = feeds.land(feeds.read_rows(spark, str(root)), str(tmp_path / "rows"))
    order = spark.createDataFrame(kept.read("feeds").collect(), "feed_id string, feed_seq long")
    tables = resolve_feeds(spark, whole, options, feed_order=order).tables()
    want = {name: rows(tables[name]) for name in TABLES}
    assert order.count() == 4
    for name in TABLES:
        assert rows(kept.read(name)) == want[name], name

    # A batch that runs again leaves the tables as they are.
    loads = [r[0] for r in spark.read.parquet(f"{tmp_path}/kept/feeds").select("load").distinct().collect()]
    paths = spark.createDataFrame([(f"file:{root}/more.zip",)], "path string")
    add_batch(paths, max(loads), str(root), kept)
    for name in TABLES:
        assert rows(kept.read(name)) == want[name], name


def test_only_buckets_of_arriving_lines_are_written_again(spark, tmp_path):
    root, options = tmp_path / "in", Options(keep_history=True)
    many = [{"number": f"{100001 + i}"} for i in range(30)]
    ff.write_folder(root / "a", "2024", ff.feed(lines=many, trips=[{"line": "100001"}], calls=[{}]))
    ff.write_folder(root / "b", "2025", ff.feed(lines=[{"frm": "01012025", "to": "31122025"}], trips=[{}], calls=[{}]))
    kept = KeptTables(spark, str(tmp_path / "kept"), options)
    files = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "kept/lines").rglob("*.parquet")}
    for load, part in enumerate(("a", "b")):
        landed = feeds.land(feeds.read_rows(spark, str(root / part)), str(tmp_path / f"rows{load}"))
        kept.add_rows(landed, load)
        if load == 0:
            before = files()
    after = files()
    changed = {p.parent.name for p in set(before) ^ set(after)}
    assert len(changed) == 1 and len({p.parent.name for p in before}) > 10
    found = {(r.line_number, str(r.valid_from)): r.is_current for r in kept.read("lines").collect()}
    assert found["100001", "2024-01-01"] is False and found["100001", "2025-01-01"] is True
    assert sum(found.values()) == 30 and len(found) == 31
