"""Readers and writers, each in a fresh folder."""

from datetime import date, datetime

from nightledger.sources import files, tables


def test_features_round_trip_with_null_text(spark, tmp_path):
    path = str(tmp_path / "features")
    frame = spark.createDataFrame([(1, None, date(2016, 4, 1)), (2, 0.5, None)], "orderid int, cityi double, ordd date")
    files.write_features(frame, path)
    raw = "".join(p.read_text() for p in (tmp_path / "features").glob("part-*.csv"))
    assert "NULL" in raw and "\t" in raw
    back = files.read_features(spark, path, "orderid int, cityi double, ordd date")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, frame.collect()))


def test_grid_log_appends(spark, tmp_path):
    path = str(tmp_path / "log")
    row = spark.createDataFrame([(5, 0.5, 0.5, 0.02, 0.196)], files.GRID_LOG)
    files.append_grid_log(row, path)
    files.append_grid_log(row, path)
    assert [tuple(r) for r in files.read_grid_log(spark, path).collect()] == [(5, 0.5, 0.5, 0.02, 0.196)] * 2


def test_tab_separated_grid_log(spark, tmp_path):
    (tmp_path / "old.txt").write_text("0.5\t0.6\t0.01\t0.19\n")
    assert [tuple(r) for r in files.read_grid_log(spark, str(tmp_path / "old.txt"), "\t", False).collect()] == [
        (0.5, 0.6, 0.01, 0.19)
    ]


def test_csv_export(spark, tmp_path):
    files.write_csv(spark.range(3), str(tmp_path / "x"))
    assert spark.read.option("header", True).csv(str(tmp_path / "x")).columns == ["id"]


def test_save_overwrites_and_prunes(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = [(1, date(2016, 3, n), datetime(2016, 3, n)) for n in (1, 2, 3)]
    frame = spark.createDataFrame(rows, "room int, d date, operatetime timestamp_ntz")
    for _ in range(2):
        tables.save(frame, path, partition_by=("d",))
    back = tables.read_table(spark, path)
    assert back.count() == 3
    picked = tables.scan_range(back, date(2016, 3, 1), date(2016, 3, 3))
    assert picked.count() == 2
    assert "PartitionFilters: [isnotnull(d" in picked._jdf.queryExecution().executedPlan().toString()
    assert tables.snapshot(back, date(2016, 3, 3)).count() == 1


def test_batch_scan(spark):
    frame = spark.createDataFrame([(date(2016, 3, 1), h) for h in (0, 2, 22)], "d date, hour int")
    assert tables.scan_batches(frame, date(2016, 3, 1), date(2016, 3, 1), 22).count() == 1
    assert tables.scan_batches(frame, date(2016, 3, 1), date(2016, 3, 1), 0, 0).count() == 1
