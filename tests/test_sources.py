import pytest
from pyspark.sql import functions as F

from flowgauge.constants import RAW_TYPES
from flowgauge.session import shared_folder
from flowgauge.sources import raw, tables

HEADER = list(RAW_TYPES)
GOOD = dict(zip(HEADER, ["None", "288.28", "0.0", "0.0", "40", "Clouds", "scattered clouds", "2012-10-02 09:00:00", "5545"]))


def write(path, header, rows):
    path.write_text("\n".join([",".join(header)] + [",".join(r[c] for c in header) for r in rows]) + "\n")
    return str(path)


def test_columns_are_found_by_name(spark, tmp_path):
    ok, bad = raw.scan_raw(spark, write(tmp_path / "a.csv", HEADER[::-1], [GOOD]))
    row = ok.first()
    assert (row["temp"], row["traffic_volume"], row["holiday"], row["clouds_all"]) == (288.28, 5545, "None", 40)
    assert bad.count() == 0


def test_missing_column_is_an_error_and_extra_is_not(spark, tmp_path):
    with pytest.raises(ValueError, match="snow_1h"):
        raw.scan_raw(spark, write(tmp_path / "a.csv", [c for c in HEADER if c != "snow_1h"], [GOOD]))
    ok, _ = raw.scan_raw(spark, write(tmp_path / "b.csv", HEADER + ["note"], [{**GOOD, "note": "x"}]))
    assert ok.count() == 1


def test_empty_is_null_and_unparsable_goes_to_quarantine(spark, tmp_path):
    rows = [GOOD, {**GOOD, "temp": ""}, {**GOOD, "temp": "warm", "date_time": "soon"}]
    ok, bad = raw.scan_raw(spark, write(tmp_path / "a.csv", HEADER, rows))
    assert ok.count() == 2 and ok.where("temp IS NULL").count() == 1
    assert sorted(bad.first()["rejected"]) == ["date_time", "temp"]


def test_files_with_another_header_are_refused(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    write(folder / "a.csv", HEADER, [GOOD])
    write(folder / "b.csv", HEADER[::-1], [GOOD])
    with pytest.raises(Exception, match="(?i)header"):
        raw.scan_raw(spark, str(folder))[0].collect()


def test_reload_replaces(spark, raw_frame, tmp_path):
    for _ in range(2):
        assert tables.replace_table(raw_frame([{}, {}]), "reloaded", str(tmp_path / "t")) == 2
    assert spark.table("reloaded").count() == 2


def test_a_failed_load_leaves_the_old_rows(spark, raw_frame, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(raw_frame([{}, {}]), "kept", path)
    opened = spark.table("kept")
    broken = raw_frame([{}] * 50).repartition(5).withColumn("temp", F.when(F.col("ordinal") == 49, F.raise_error(F.lit("torn"))).otherwise(F.col("temp")))
    with pytest.raises(Exception, match="torn"):
        tables.replace_table(broken, "kept", path)
    assert spark.table("kept").count() == 2
    assert tables.replace_table(raw_frame([{}] * 3).withColumn("more", F.lit(1)), "kept", path) == 3
    assert spark.table("kept").count() == 3 and "more" in spark.table("kept").columns
    assert opened.count() == 2  # who had opened the old version reads it to the end


def test_a_run_written_again_replaces_only_itself(spark, tmp_path):
    path = str(tmp_path / "r")
    for run, value in (("a", 1.0), ("b", 2.0), ("b", 3.0)):
        for analysis in ("x", "y"):
            tables.append_results(tables.long_results(spark.range(1).select(F.lit(value).alias("m")), analysis, ["m"]), path, run)
    got = sorted((r["run"], r["analysis"], r["value"]) for r in spark.read.parquet(path).collect())
    assert got == [("a", "x", 1.0), ("a", "y", 1.0), ("b", "x", 3.0), ("b", "y", 3.0)]


def test_both_sides_of_a_scan_are_written_once(spark, tmp_path):
    rows = [GOOD, {**GOOD, "temp": "warm", "traffic_volume": "1e"}, {**GOOD, "clouds_all": ""}, {**GOOD, "date_time": "soon"}]
    path = write(tmp_path / "a.csv", HEADER, rows)
    with open(path, "a") as file:
        file.write("None,1.0\n" + ",".join(GOOD.values()) + ",extra\n\n")
    accepted, refused, counts = raw.split_scan(spark, path, str(tmp_path / "out"))
    assert counts == {"read": 6, "accepted": 2, "refused": 4, "line": 2, **dict.fromkeys(HEADER, 0), "temp": 1, "traffic_volume": 1, "date_time": 1}
    assert accepted.count() == 2 and accepted.where("clouds_all IS NULL").count() == 1 and not {"rejected", "cells", "refused"} & set(accepted.columns)
    why = {tuple(r["rejected"]): r["cells"] for r in refused.where("NOT array_contains(rejected, 'line')").collect()}
    assert why[("temp", "traffic_volume")]["temp"] == "warm" and why[("date_time",)]["date_time"] == "soon"
    torn = {r["cells"]["line"] for r in refused.where("array_contains(rejected, 'line')").collect()}
    assert torn == {"None,1.0", ",".join(GOOD.values()) + ",extra"}


def test_year_and_month_are_partitions(spark, raw_frame, tmp_path):
    path = str(tmp_path / "m")
    tables.write_by_month(raw_frame([{}, {"date_time": "2023-05-01 00:00:00"}]), path)
    read = tables.read_by_month(spark, path).where("year = 2023")
    assert read.count() == 1
    assert "PartitionFilters: [isnotnull(year" in read._jdf.queryExecution().executedPlan().toString()


def test_results_append(spark, tmp_path):
    path = str(tmp_path / "r")
    for _ in range(2):
        stats = spark.range(1).select(F.lit(1.5).alias("mean"), F.lit(2).alias("n"))
        tables.append_results(tables.long_results(stats, "demo", ["mean", "n"]), path)
    assert spark.read.parquet(path).where("metric = 'mean' AND value = 1.5").count() == 2


def test_the_folder_named_by_the_session_is_used(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_input_order_follows_the_file_names(spark, tmp_path):
    """Spark reads the larger file first; the first record is still that of the first file."""
    from flowgauge.constants import RAW_TYPES
    from flowgauge.operators.cleaning import keep_first
    from flowgauge.sources.raw import scan_raw

    names = list(RAW_TYPES)
    filled = {"date_time": "2018-01-01 00:00:00", "holiday": "None", "weather_main": "Clear", "weather_description": "sky"}
    line = lambda volume, **more: ",".join(str((filled | {"traffic_volume": volume} | more).get(n, 1)) for n in names)
    (tmp_path / "a.csv").write_text("\n".join([",".join(names), line(11)]))
    more = [line(22)] + [line(33, date_time=f"2018-01-{d:02d} 05:00:00") for d in range(2, 29)]
    (tmp_path / "b.csv").write_text("\n".join([",".join(names), *more]))
    accepted, _ = scan_raw(spark, str(tmp_path))
    first = keep_first(accepted).where("date_time = timestamp'2018-01-01 00:00:00'").collect()
    assert [r["traffic_volume"] for r in first] == [11]
    assert accepted.select("ordinal").distinct().count() == 29
