import glob

import feedfiles as ff
from pyspark.sql import functions as F

from busgrid import sinks
from busgrid.operators import identity, resolve
from busgrid.plans import gtfs, integrity
from busgrid.session import configure
from busgrid.sources import feeds
from busgrid.sources.locations import read_locations
from busgrid.sources.staging import Staged


def text_of(folder):
    return "".join(open(p, encoding="utf-8", newline="").read() for p in glob.glob(f"{folder}/part-*"))


def test_csv_quotes_only_where_needed(spark, tmp_path):
    rows = spark.createDataFrame(
        [("plain", "", None), ('say "hi"', "a,b", "two\nlines"), (" kept ", "číslo", "x")],
        "a string, b string, c string",
    )
    sinks.write_csv(rows.coalesce(1), str(tmp_path / "t"))
    assert text_of(tmp_path / "t") == (
        'a,b,c\nplain,,\n"say ""hi""","a,b","two\nlines"\n kept ,číslo,x\n'
    )


def test_tables_are_kept_by_partition(spark, tmp_path):
    rows = spark.createDataFrame([("f1", 1), ("f2", 2)], "feed_id string, n int")
    sinks.keep_tables({"calls": rows}, str(tmp_path), partition_by=["feed_id"])
    sinks.keep_tables({"calls": rows}, str(tmp_path), mode="append", partition_by=["feed_id"])
    assert spark.read.parquet(str(tmp_path / "calls")).filter("feed_id = 'f2'").count() == 2


def test_stop_posts_and_optional_times(spark, tmp_path):
    files = ff.feed(calls=[{"departure": "0800", "post": "3", "amin": "0755", "dmax": ""}])
    files["Oznacniky.txt"] = ff.record(["1", "3", "Nástupiště", "centrum", "B", "", ""]).encode("cp1250")
    ff.write_folder(tmp_path / "in", "a", files)
    rows = feeds.land(feeds.read_rows(spark, str(tmp_path / "in")), str(tmp_path / "rows"))
    staged = Staged(feeds.with_layout(rows)[0])
    post = staged.stop_posts.first()
    assert (post.stop_number, post.post_number, post.post_name, post.direction, post.stand) == (
        1, 3, "Nástupiště", "centrum", "B",
    )
    call = staged.calls.first()
    assert (call.post_number, call.arrival_min, call.departure_max) == (3, "0755", None)


def test_locations_by_name_keep_repeated_rows(spark, tmp_path):
    path = tmp_path / "places.csv"
    path.write_text('"Ostrava,Poruba,Vřesinská",49.8,18.2\n"Ostrava,Poruba,Vřesinská",50,19\n', encoding="utf-8")
    stops = spark.createDataFrame(
        [("k1", 1, "Ostrava", "Poruba", "Vřesinská"), ("k2", 2, "Brno", "", "")],
        "stop_key string, stop_number int, municipality string, district string, place string",
    )
    located = gtfs.stops(stops, read_locations(spark, str(path)))
    found = sorted((r.stop_id, r.stop_name, r.stop_lat, r.stop_lon) for r in located.collect())
    assert found == [
        ("k1", "Ostrava,Poruba,Vřesinská", 49.8, 18.2),
        ("k1", "Ostrava,Poruba,Vřesinská", 50.0, 19.0),
        ("k2", "Brno,,", 0.0, 0.0),
    ]


def test_first_and_last_rows(spark):
    rows = spark.createDataFrame(
        [("a", 2, 1, "A", "X", "s", 1), ("a", 1, 9, "A", "X", "s", 2), ("a", 1, 3, "A", "X", "s", 3)],
        "feed_id string, feed_seq int, line_no int, ico string, carrier_name string, seat string, n int",
    )
    assert [r.n for r in identity.carriers(rows).collect()] == [3]
    assert [r.n for r in identity.last_rows(rows, ["feed_id"]).collect()] == [2]


def test_company_numbers_compare_without_leading_zeros(spark):
    rows = spark.createDataFrame([("0012",), ("12",)], "ico string")
    assert resolve.with_company(rows).select("company").distinct().count() == 1


def test_route_types(spark):
    rows = spark.createDataFrame([("A",), ("E",), ("L",), ("M",), ("P",), ("T",), (None,)], "v string")
    found = [r.t for r in rows.select(gtfs.route_type(F.col("v")).alias("t")).collect()]
    assert found == [3, 0, 6, 1, 4, 3, 3]


def test_findings(spark):
    configure(spark)
    one = lambda ddl, *rows: spark.createDataFrame(list(rows), ddl)
    tables = {
        "agency": one("agency_id string", ("a",), ("a",)),
        "routes": one("route_id string, agency_id string", ("r", "b")),
        "stops": one("stop_id string", ("s",)),
        "trips": one("trip_id string, route_id string, service_id string", ("t", "r", "none")),
        "stop_times": one("trip_id string, stop_id string", ("t", "s")),
        "calendar": one("service_id string", ("x",)),
        "calendar_dates": one("service_id string", ("y",)),
    }
    assert {(r.check, r.key) for r in integrity.findings(tables).collect()} == {
        ("agency: repeated agency_id", "a"),
        ("routes: agency_id not in agency", "b"),
        ("trips: service without days", "none"),
    }
