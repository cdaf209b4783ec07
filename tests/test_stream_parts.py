def test_a_year_in_several_files(spark, tmp_path):
    from stratus.streaming.yearly import keep_climatologies

    def add(y, *values):
        rows = [("tas", "historical", y, d, 0.0, 0.0, v) for d, v in enumerate(values, 1)]
        spark.createDataFrame(rows, "variable string, scenario string, year int, doy int, lat double, lon double, value double").repartition(len(rows)).write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        keep_climatologies(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), files_a_batch=1).awaitTermination()
        return {(r.year, r.doy): r.value for r in spark.read.parquet(str(tmp_path / "out")).collect()}

    add(2001, 1.0, 2.0, 3.0)
    add(2002, 7.0)
    assert run() == {(2001, 1): 1.0, (2001, 2): 2.0, (2001, 3): 3.0, (2002, 1): 7.0}
    add(2001, 3.0)
    assert run() == {(2001, 1): 2.0, (2001, 2): 2.0, (2001, 3): 3.0, (2002, 1): 7.0}
