from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fleetpulse.operators.silver import assign_site_ids
from fleetpulse.sources.feeds import read_fleet_feed, read_site_feed
from tests.helpers import plan, rows

SITE_HEADER = (
    "Time,temperature_2m,relativehumidity_2m,dewpoint_2m,windspeed_10m,"
    "windspeed_100m,winddirection_10m,winddirection_100m,windgusts_10m,Power"
)


def write(folder, name, *lines):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


def site(folder, name, power="0.5"):
    write(
        folder, name, SITE_HEADER, f"2021-01-01 12:00:00,1,2,3,4,5,6,7,8,{power}"
    )


def test_fleet_feed_types_follow_the_header(spark, tmp_path):
    header = "power_output,timestamp,turbine_id,wind_direction,wind_speed"
    write(tmp_path, "data_group_1.csv", header, "1.5,2021-01-01 00:00:00,7,90,5")
    write(tmp_path, "data_group_2.csv", header, "2.5,2021-01-01 00:10:00,8,91,6")
    write(tmp_path, "other.csv", header, "9,2021-01-01 00:10:00,9,9,9")
    feed = read_fleet_feed(spark, str(tmp_path))
    assert feed.dtypes == [
        ("power_output", "double"),
        ("timestamp", "timestamp"),
        ("turbine_id", "int"),
        ("wind_direction", "double"),
        ("wind_speed", "double"),
    ]
    assert rows(feed) == [
        (1.5, datetime(2021, 1, 1, 0, 0), 7, 90.0, 5.0),
        (2.5, datetime(2021, 1, 1, 0, 10), 8, 91.0, 6.0),
    ]


def test_unparseable_and_empty_values_are_null(spark, tmp_path):
    write(
        tmp_path,
        "data_group_1.csv",
        "timestamp,turbine_id,wind_speed,wind_direction,power_output",
        "yesterday,x,fast,,1.0",
    )
    feed = read_fleet_feed(spark, str(tmp_path))
    assert rows(feed) == [(None, None, None, None, 1.0)]


def test_undeclared_column_stays_text(spark, tmp_path):
    write(tmp_path, "data_group_1.csv", "turbine_id,note", "1,007")
    assert rows(read_fleet_feed(spark, str(tmp_path))) == [(1, "007")]


def test_files_are_matched_by_the_names_in_their_headers(spark, tmp_path):
    write(tmp_path, "data_group_1.csv", "turbine_id,wind_speed", "1,5")
    write(tmp_path, "data_group_2.csv", "wind_speed,turbine_id", "6,2")
    write(tmp_path, "data_group_3.csv", "note,turbine_id,wind_speed", "late,3,7")
    write(tmp_path, "data_group_4.csv", "")
    feed = read_fleet_feed(spark, str(tmp_path))
    assert rows(feed, "turbine_id", "wind_speed", "note") == [(1, 5.0, None), (2, 6.0, None), (3, 7.0, "late")]


def test_site_files_with_other_column_orders(spark, tmp_path):
    site(tmp_path, "Location1.csv")
    turned = ",".join(reversed(SITE_HEADER.split(",")))
    write(tmp_path, "location 2.csv", turned, "0.25,8,7,6,5,4,3,2,1,2021-01-01 13:00:00")
    write(tmp_path, "Location{3}.csv", turned, "bad,8,7,6,5,4,3,2,1,2021-01-01 13:00:00")
    feed = read_site_feed(spark, str(tmp_path), unreadable=True)
    name = F.regexp_extract("source_file", "([^/]+)$", 1)
    assert rows(feed, "Power", "temperature_2m", "windgusts_10m", F.col("unreadable_record").isNotNull()) == [
        (0.25, 1.0, 8.0, False), (0.5, 1.0, 8.0, False), (None, 1.0, 8.0, True),
    ]
    assert feed.select(name).distinct().count() == 3
    assert read_site_feed(spark, str(tmp_path)).columns == [*SITE_HEADER.split(","), "source_file"]


def test_files_without_a_declared_column_of_others_are_refused(spark, tmp_path):
    write(tmp_path, "data_group_1.csv", "turbine_id,wind_speed", "1,5")
    write(tmp_path, "data_group_2.csv", "turbine_id", "2")
    with pytest.raises(ValueError, match="CSV headers of .* have different columns: turbine_id and turbine_id, wind_speed"):
        read_fleet_feed(spark, str(tmp_path))


def test_equal_headers_are_one_scan(spark, tmp_path):
    for number in range(5):
        write(tmp_path, f"data_group_{number}.csv", "turbine_id,wind_speed", f"{number},5")
    text = plan(read_fleet_feed(spark, str(tmp_path)))
    assert text.count("Scan csv") == 2 and "Union" not in text  # once in the tree, once below


def test_unreadable_records_are_told(spark, tmp_path):
    lines = ["1,5,2", "x,5,2", "2,,2", "3,fast,2", "4,5", "5,6,7,8"]
    write(tmp_path, "data_group_1.csv", "turbine_id,wind_speed,power_output", *lines)
    feed = read_fleet_feed(spark, str(tmp_path), unreadable=True)
    found = rows(feed.cache(), "unreadable_record")
    assert found == [("3,fast,2",), ("4,5",), ("5,6,7,8",), ("x,5,2",), (None,), (None,)]


def test_only_read_columns_are_parsed(spark, tmp_path):
    write(tmp_path, "data_group_1.csv", "turbine_id,wind_speed,power_output", "1,5,2")
    feed = read_fleet_feed(spark, str(tmp_path)).select("wind_speed")
    assert "ReadSchema: struct<wind_speed:double>" in plan(feed)


def test_site_ids_come_from_file_names(spark, tmp_path):
    raw = tmp_path / "Location9"
    for name in ("Location2.csv", "Location12.csv", "LocationX.csv"):
        site(raw, name)
    feed = read_site_feed(spark, str(raw))
    assert feed.columns == SITE_HEADER.split(",") + ["source_file"]
    fleet = spark.createDataFrame([(4,), (3,), (None,)], "turbine_id int")
    numbered = assign_site_ids(feed, fleet)
    assert dict(numbered.dtypes)["turbine_id"] == "int"
    name = F.regexp_extract("source_file", "([^/]+)$", 1)
    assert rows(numbered, name, "turbine_id") == [
        ("Location12.csv", 16),
        ("Location2.csv", 6),
        ("LocationX.csv", None),
    ]


@pytest.mark.parametrize(
    ("path", "number"),
    [
        ("store:/raw/Location2.csv", 2),
        ("file:/raw/location3.csv", 3),
        ("/raw/LOCATION04.csv", 4),
        ("/raw/Location9/Location2.csv", 2),
        ("/raw/Location9/other.csv", None),
        ("/raw/LocationX.csv", None),
        ("/raw/Location7.csv/part-00000-a1b2.csv", 7),
        ("/raw/Location99999999999.csv", None),
        (None, None),
    ],
)
def test_site_number(spark, path, number):
    sites = spark.createDataFrame([(path,)], "source_file string")
    nobody = spark.createDataFrame([], "turbine_id int")
    assert rows(assign_site_ids(sites, nobody), "turbine_id") == [(number,)]


def test_site_files_are_found_in_any_case(spark, tmp_path):
    for name in ("Location1.csv", "location3.csv", "LOCATION5.csv", "other.csv"):
        site(tmp_path, name)
    nobody = spark.createDataFrame([], "turbine_id int")
    numbered = assign_site_ids(read_site_feed(spark, str(tmp_path)), nobody)
    assert rows(numbered.select("turbine_id").distinct()) == [(1,), (3,), (5,)]


def test_site_feed_written_by_spark(spark, tmp_path):
    site(tmp_path, "Location1.csv")
    spark.read.option("header", True).csv(f"{tmp_path}/Location1.csv").repartition(
        1
    ).write.option("header", True).csv(f"{tmp_path}/big/Location5.csv")
    feed = read_site_feed(spark, f"{tmp_path}/big")
    nobody = spark.createDataFrame([], "turbine_id int")
    assert rows(assign_site_ids(feed, nobody), "turbine_id", "Power") == [(5, 0.5)]


def test_offset_is_not_a_join(spark):
    sites = spark.createDataFrame([("/Location1.csv",)], "source_file string")
    fleet = spark.createDataFrame([(10,)], "turbine_id int")
    text = plan(assign_site_ids(sites, fleet))
    assert "Subquery" in text
    assert "Join" not in text
