"""Control plane, sources, sinks and the stream."""

import json
import struct

import pytest
from pyspark.sql import functions as F

from stratus.plans import config
from stratus.plans.manifest import Manifest
from stratus.plans.pipeline import HANDLERS, is_written, run
from stratus.sources import catalog, sinks


def pipeline(**over):
    return config.load({"id": "p", "stages": [{"id": "a"}, {"id": "b", "depends_on": ["a"]}, {"id": "c", "depends_on": ["b"]}]} | over, env={})


def test_levels_and_cycles():
    p = config.load({"id": "p", "stages": [{"id": "d", "depends_on": ["b", "c"]}, {"id": "b", "depends_on": ["a"]}, {"id": "c", "depends_on": ["a"]}, {"id": "a"}]}, env={})
    assert p.levels() == [["a"], ["b", "c"], ["d"]]
    with pytest.raises(ValueError, match="cycle"):
        config.load({"id": "p", "stages": [{"id": "a", "depends_on": ["b"]}, {"id": "b", "depends_on": ["a"]}]}, env={})


@pytest.mark.parametrize("stages", [[], [{"id": "a"}, {"id": "a"}], [{"id": "a", "depends_on": ["x"]}], [{"id": "a", "type": "odd"}], [{"id": "a", "dependencies": ["b"]}], [{"id": "a", "options": {"validators": ["odd"]}}]])
def test_bad_configurations(stages):
    with pytest.raises(ValueError):
        config.load({"id": "p", "stages": stages}, env={})


def test_environments_variables_profiles_and_warnings(tmp_path):
    raw = config.default() | {"environments": {"test": {"base_path": "/t", "memory_gb": 1.0}}, "profiles": {"short": ["metrics", "validation"]}}
    path = tmp_path / "c.json"
    path.write_text(json.dumps(raw))
    p = config.load(str(path), "test", env={"STRATUS_BASE_PATH": "/env", "STRATUS_CONTINUE_ON_STAGE_FAILURE": "true"})
    assert (p.base_path, p.continue_on_stage_failure, p.memory_gb) == ("/env", True, 1.0)
    assert p.profile("short").levels() == [["metrics"], ["validation"]]
    assert p.warnings() == []
    with pytest.raises(KeyError):
        config.load(raw, "nowhere", env={})
    off = config.load({"id": "p", "stages": [{"id": "a"}, {"id": "b", "enabled": False}]}, env={})
    assert [s.id for s in off.stages] == ["a"]
    assert len(config.load({"id": "p", "stages": [{"id": "a"}, {"id": "b"}]}, env={}).warnings()) == 4


def test_run_success_and_inputs(spark, tmp_path):
    seen = {}

    def build(spark, stage, inputs):
        seen[stage.id] = {k: v.count() for k, v in inputs.items()}
        return spark.range(len(inputs) + 1)

    paths = run(spark, pipeline(base_path=str(tmp_path)), {"custom": build})
    assert seen == {"a": {}, "b": {"a": 1}, "c": {"b": 2}}
    assert {k: spark.read.parquet(p).count() for k, p in paths.items()} == {"a": 1, "b": 2, "c": 2}
    with pytest.raises(ValueError, match="no handler"):
        run(spark, pipeline(), {})


@pytest.mark.parametrize("go_on", [False, True])
def test_a_failure_is_raised_and_resume_does_what_is_left(spark, tmp_path, go_on):
    broken, made = {"b"}, []

    def build(spark, stage, inputs):
        made.append(stage.id)
        if stage.id in broken:
            raise RuntimeError("no")
        return spark.range(1)

    stages = [{"id": "a"}, {"id": "b", "depends_on": ["a"]}, {"id": "c", "depends_on": ["b"]}, {"id": "d", "depends_on": ["a"], "optional_inputs": ["b"]}]
    p = pipeline(base_path=str(tmp_path), continue_on_stage_failure=go_on, stages=stages)
    with pytest.raises(RuntimeError, match="no"):
        run(spark, p, {"custom": build})
    assert made == (["a", "b", "d"] if go_on else ["a", "b"]) and is_written(spark, f"{tmp_path}/a") and not is_written(spark, f"{tmp_path}/b")
    broken.clear()
    made.clear()
    assert sorted(run(spark, p, {"custom": build}, resume=True)) == ["a", "b", "c", "d"]
    assert sorted(made) == (["b", "c"] if go_on else ["b", "c", "d"])


def test_whole_pipeline(spark, tmp_path):
    days = spark.range(30 * 4 * 4).select(F.lit("tas").alias("variable"), F.lit("historical").alias("scenario"), (F.col("id") / 16).cast("int").alias("y"), (F.col("id") % 4 + 0.5).cast("double").alias("lat"), (F.floor(F.col("id") / 4) % 4 + 240.5).cast("double").alias("lon"))
    days.select("variable", "scenario", (F.col("y") + 1980).cast("int").alias("year"), F.lit(1).alias("doy"), (F.col("lat") + 30).alias("lat"), "lon", (F.col("lat") + 280).alias("value")).write.parquet(str(tmp_path / "in"))
    spark.createDataFrame([("01001", 30.5, 240.5), ("01001", 31.5, 240.5)], "geoid string, lat double, lon double").write.parquet(str(tmp_path / "cells"))
    raw = {
        "id": "p",
        "base_path": str(tmp_path / "out"),
        "stages": [
            {"id": "means", "type": "means", "options": {"input": str(tmp_path / "in"), "region": "CONUS"}},
            {"id": "metrics", "type": "metrics", "depends_on": ["means"], "options": {"cell_county": str(tmp_path / "cells"), "variables": ["tas"]}},
            {"id": "validation", "type": "validation", "depends_on": ["metrics"], "options": {"validators": ["qaqc", "spatial"]}},
        ],
    }
    paths = run(spark, config.load(raw, env={}), HANDLERS)
    means = spark.read.parquet(paths["metrics"]).where("metric = 'mean_temp_c'")
    assert means.count() > 0 and means.first().value == pytest.approx(281.0 - 273.15)
    assert spark.read.parquet(paths["validation"]).where("severity = 'CRITICAL'").count() == 0


def test_manifest(spark, tmp_path):
    m = Manifest(spark, str(tmp_path / "m"))
    tasks = spark.createDataFrame([("means", r, "tas", "historical") for r in ("AK", "HI", "GU")], "stage string, region string, variable string, scenario string")
    m.register(tasks)
    m.record("means", "AK", "tas", "historical", "running")
    m.record("means", "AK", "tas", "historical", "completed", output="x")
    m.record("means", "HI", "tas", "historical", "failed", error="no")
    assert {r.region: r.status for r in m.tasks().collect()} == {"AK": "completed", "HI": "failed", "GU": "pending"}
    assert {r.region for r in m.pending("means").collect()} == {"HI", "GU"}
    m.discover(tasks.where("region = 'GU'").withColumn("output", F.lit("y")))
    assert {r.region for r in m.pending().collect()} == {"HI"}
    with pytest.raises(ValueError):
        m.record("means", "AK", "tas", "historical", "odd")


def normals(spark, value, years):
    return spark.createDataFrame([("tas", "AK", "historical", y, 1, value) for y in years], "variable string, region string, period_type string, target_year int, doy int, value double")


def test_writes_replace_only_their_partitions(spark, tmp_path):
    path = str(tmp_path / "n")
    sinks.write_normals(normals(spark, 1.0, (2000, 2001)), path)
    sinks.write_normals(normals(spark, 2.0, (2001,)), path)
    got = spark.read.parquet(path)
    assert {r.target_year: r.value for r in got.collect()} == {2000: 1.0, 2001: 2.0}
    planned = normals(spark, 0.0, (2001, 2002)).select(*sinks.NORMAL_KEYS)
    assert [r.target_year for r in sinks.only_missing(planned, sinks.existing_partitions(got)).collect()] == [2002]


def test_reports(spark, tmp_path):
    found = spark.createDataFrame([("qaqc", "WARNING", "c", "m<1>", {"n": "1"}), ("qaqc", "CRITICAL", "c", "bad", {})], "validator string, severity string, category string, message string, details map<string,string>")
    sinks.write_issues(found, str(tmp_path / "j"))
    sinks.write_issues(found, str(tmp_path / "c"), "csv")
    assert spark.read.json(str(tmp_path / "j")).count() == spark.read.csv(str(tmp_path / "c"), header=True).count() == 2
    rows = sinks.report_rows(found)
    assert [r["severity"] for r in rows] == ["CRITICAL", "WARNING"]
    assert "| CRITICAL |" in sinks.render_markdown(rows) and "m&lt;1&gt;" in sinks.render_html(rows)
    with pytest.raises(ValueError):
        sinks.write_issues(found, str(tmp_path / "x"), "pdf")
    assert sinks.output_path("/b/", "L2", "AK", "tas", name="f.csv") == "/b/L2_metrics/AK/tas/f.csv"


def test_csv_keeps_leading_zeros(spark, tmp_path):
    rows = spark.createDataFrame([("01001", 2000, "historical", 1.0)], "geoid string, year int, scenario string, mean_temp_c double")
    sinks.write_county_csv(rows, str(tmp_path / "a" / "b"))
    text = next((tmp_path / "a" / "b").glob("*.csv")).read_text()
    assert text.splitlines() == ["geoid,year,scenario,mean_temp_c", "01001,2000,historical,1.0"]
    full = "geoid,year,scenario,mean_temp_c,min_temp_c,max_temp_c,annual_precip_mm,precip_gt_50mm,precip_gt_100mm,pixel_count\n1001,2000,historical,1.0,0.0,2.0,,,,3\n"
    (tmp_path / "v" / "deep").mkdir(parents=True)
    (tmp_path / "v" / "deep" / "x.csv").write_text(full)
    r = catalog.validation_csv(spark, str(tmp_path / "v")).first()
    assert (r.geoid, r.annual_precip_mm, r.pixel_count) == ("01001", None, 3)


def classic_file(path, times=2, lat=(10.0, 20.0), lon=(1.0, 2.0, 3.0), fill=-999.0):
    """A CDF-1 file with one record variable."""

    def name(s):
        return struct.pack(">i", len(s)) + s.encode() + b"\0" * (-len(s) % 4)

    def attr(key, value):
        return name(key) + struct.pack(">iif", 5, 1, value)

    data = [[float(100 * t + 10 * i + j) for i in range(len(lat)) for j in range(len(lon))] for t in range(times)]
    data[0][0] = fill
    head = b"CDF\x01" + struct.pack(">i", times) + struct.pack(">ii", 10, 3) + name("time") + struct.pack(">i", 0) + name("lat") + struct.pack(">i", len(lat)) + name("lon") + struct.pack(">i", len(lon)) + struct.pack(">ii", 0, 0)
    specs = [("lat", [1], 6, 8 * len(lat)), ("lon", [2], 6, 8 * len(lon)), ("time", [0], 6, 8), ("tas", [0, 1, 2], 5, 4 * len(lat) * len(lon))]

    def variables(begins):
        out = struct.pack(">ii", 11, len(specs))
        for (n, dims, kind, size), begin in zip(specs, begins, strict=True):
            attrs = struct.pack(">ii", 12, 1) + attr("_FillValue", fill) if n == "tas" else struct.pack(">ii", 0, 0)
            out += name(n) + struct.pack(f">i{len(dims)}i", len(dims), *dims) + attrs + struct.pack(">iii", kind, size, begin)
        return out

    start = len(head) + len(variables([0] * 4))
    begins = [start, start + 8 * len(lat), start + 8 * (len(lat) + len(lon)), start + 8 * (len(lat) + len(lon)) + 8]
    body = struct.pack(f">{len(lat)}d", *lat) + struct.pack(f">{len(lon)}d", *lon)
    for t in range(times):
        body += struct.pack(">d", float(t)) + struct.pack(f">{len(data[t])}f", *data[t])
    path.write_bytes(head + variables(begins) + body)


def test_grid_source(spark, tmp_path):
    from stratus.sources.grid_source import GridSource

    classic_file(tmp_path / "a.nc")
    spark.dataSource.register(GridSource)
    df = spark.read.format("stratus_grid").load(str(tmp_path))
    got = {(r.time, r.lat, r.lon): r.value for r in df.collect()}
    assert len(got) == 12 and got[(0.0, 10.0, 1.0)] is None and got[(1.0, 20.0, 3.0)] == 112.0
    assert {r.variable for r in df.collect()} == {"tas"}
    (tmp_path / "b.nc").write_bytes(b"\x89HDF\r\n\x1a\n")
    with pytest.raises(Exception, match="file ends early"):
        spark.read.format("stratus_grid").load(str(tmp_path / "b.nc")).collect()


def test_listing_and_rates(spark, tmp_path):
    (tmp_path / "tas_day_NorESM2-LM_historical_r1i1p1f1_gn_1999.nc").write_bytes(b"x")
    (tmp_path / "tas_day_NorESM2-LM_historical_r1i1p1f1_gn_2000.nc").write_bytes(b"yy")
    files = catalog.list_files(spark, str(tmp_path))
    assert {(r.year, r.scenario) for r in files.collect()} == {(1999, "historical"), (2000, "historical")}
    assert catalog.available_years(files, "tas", "historical").first().last_year == 2000
    expected = files.select("path").union(spark.createDataFrame([("gone",)], "path string"))
    r = catalog.availability_rates(expected, files).first()
    assert (r.expected, r.existing, r.readable, r.passed) == (3, 2, 2, False)
    assert catalog.output_summary(files).first().small == 2


def test_checksums(spark, tmp_path):
    import hashlib

    from stratus.operators.contracts import file_checks

    (tmp_path / "f.nc").write_bytes(b"abc")
    files = spark.read.format("binaryFile").load(str(tmp_path))
    path = files.first().path
    c = spark.createDataFrame([("a", path, 3, hashlib.sha256(b"abc").hexdigest()), ("b", "gone", 3, "x")], "id string, path string, size bigint, checksum string")
    assert {r.id: (r.exists, r.size_ok, r.checksum_ok) for r in file_checks(c, files).collect()} == {"a": (True, True, True), "b": (False, False, False)}


def test_stream_of_yearly_files(spark, tmp_path):
    from stratus.streaming.yearly import keep_climatologies

    def year(y, v):
        spark.createDataFrame([("tas", "historical", y, 1, 0.0, 0.0, v), ("tas", "historical", y, 1, 0.0, 0.0, v + 2)], "variable string, scenario string, year int, doy int, lat double, lon double, value double").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    for y, v in ((2001, 1.0), (2002, 5.0)):
        year(y, v)
        keep_climatologies(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert {r.year: r.value for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {2001: 2.0, 2002: 6.0}


def test_command_line(tmp_path, capsys):
    from stratus.__main__ import main

    assert main(["create-config", str(tmp_path / "c.json")]) == 0
    assert main(["validate", "--config", str(tmp_path / "c.json")]) == 0
    assert main(["list-queries"]) == 0
    assert "climate_normal" in capsys.readouterr().out


def test_entry_without_the_text_operators():
    import __spark_entry__ as e

    assert "climate_normal" in e.queries() and set(e.oracle_sql()) <= set(e.queries())


def test_a_large_partition_is_written_by_several_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    from stratus.sources import sinks

    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    df = spark.range(3_000_000).select(F.lit("tas").alias("variable"), F.lit("CONUS").alias("region"), F.rand(1).alias("value"))
    sinks.write_normals(df, str(tmp_path / "out"), ("variable", "region"))
    assert len(list((tmp_path / "out/variable=tas/region=CONUS").glob("*.parquet"))) > 2
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3_000_000 and spark.conf.get(name) == before
