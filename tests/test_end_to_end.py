"""A generated drive through readers, all stages, the command line, and streams."""

import json
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracklake.__main__ import main
from tracklake.operators import roads
from tracklake.plans.config import Config, Paths, Stage, load
from tracklake.plans.pipeline import Pipeline, process_date_range
from tracklake.sources import readers, writers
from tracklake.sources.arrays import ArraySource, wide_counts
from tracklake.streaming.readings import flag_stream, minute_means, session_stream

DAY = date(2025, 7, 15)
START = datetime(2025, 7, 15, 18)


def csv(path, header, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *(",".join("" if v is None else str(v) for v in r) for r in rows)]) + "\n")


@pytest.fixture(scope="module")
def world(tmp_path_factory, spark):
    """Ten minutes: a car drives north at 10 m/s past one road while instruments run."""
    root = tmp_path_factory.mktemp("world")
    rows = []
    for s in range(600):
        at = (START + timedelta(seconds=s)).strftime("%Y-%m-%dT%H:%M:%SZ")
        if not 300 <= s < 304:  # a gap that is filled
            for p, v in (("latitude", 37.8 + s * 9e-5), ("longitude", -122.3), ("speed", 10.0), ("direction", 0.0)):
                rows.append((at, "gps", p, v, None))
        for i, p, v in (("EcoPhysics_NOX", "NO", 2.0), ("EcoPhysics_NOX", "NOx", 5.0), ("EcoPhysics_NOX", "NO2", 9.0), ("Aeris_CH4_C2H6", "CH4", 2.0 + (s % 2)), ("Licor_7200_CO2", "CO2MFd", 400.0)):
            rows.append((at, i, p, v, None))
        rows.append((at, "Aeris_CH4_C2H6", "Inlet_Number", 1.0 if 200 <= s < 300 else 0.0, None))
        rows.append((at, "CAPS_NO2", "Status", None, "99999" if s == 10 else "100"))
    csv(root / "raw" / readers.log_name(DAY), "sample_time,instrument,parameter,value,string", rows)
    csv(root / "ref/flags.csv", "instrument,parameter,range_start,range_end,condition,flag_value", [("CAPS_NO2", "Status", 0, 11000, "Warning", 2), ("Aeris_CH4_C2H6", "CH4", 0, 2.5, "Alarm", 4), ("Airmar", "Wall_Code", "NA", "NA", "x", 8)])
    csv(root / "ref/lags.csv", "month,Licor_7200_CO2,EcoPhysics_NOX", [("7/1/2025", 2, 3)])
    csv(root / "ref/fields.csv", "parameter_ucb,parameter,method,duration,unit,instrument", [("NO2", "no2", "m", 1, "ppb", "EcoPhysics_NOX"), ("CH4", "ch4", "m", 1, "ppb", "Aeris_CH4_C2H6"), ("CO2MFd", "co2", "m", 1, "ppm", "Licor_7200_CO2"), ("C6H7", "c6h7", "m", 1, "ppb", "Vocus-PTR-ToF")])
    csv(root / "ref/standards.csv", "cylinder_number,part_number,CH4_ppb,C6H7_ppb,C7H9_ppb", [("CYL", "p", 1900, 1000, 2000)])
    csv(root / "ref/peaks.csv", "index,species,description", [(2, "C7H9", "b"), (1, "C6H7", "a"), (3, "VarName1", "c")])
    csv(root / "ref/controls.csv", "index,name,description", [(0, "zero_valve", ""), (1, "cal_valve", ""), (2, "zero_flow", ""), (3, "cal_flow", "")])
    csv(root / "cal/gas.csv", "instrument,parameter,sample_time,slope,intercept", [("Aeris_CH4_C2H6", "CH4", "2025-07-01T00:00:00Z", 2.0, 0.0), ("Aeris_CH4_C2H6", "CH4", "2025-08-01T00:00:00Z", 2.0, 1000.0)])
    csv(root / "nox/nox.csv", "compound,date,instrument_d,slope,intercept", [("NO", "2025-07-01 00:00:00", "EcoPhysics_NOX", 1.0, 1.0)])
    ring = [[-122.4, 37.83], [-122.2, 37.83], [-122.2, 37.832], [-122.4, 37.832], [-122.4, 37.83]]
    (root / "ref/zone.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", "coordinates": [ring]}}]}))
    nodes = [{"type": "node", "id": i, "lat": 37.79 + i * 0.01, "lon": -122.3} for i in range(8)]
    way = {"type": "way", "id": 1, "nodes": list(range(8)), "tags": {"highway": "residential", "name": "North"}}
    (root / "map.json").write_text(json.dumps({"elements": [*nodes, way]}))
    roads.build_segments(readers.read_elements(spark, str(root / "map.json"))).write.parquet(str(root / "roads/cell.parquet"))
    (root / "vocus/20250715").mkdir(parents=True)
    n = 400  # 11:00 local time is 18:00 UTC: zero, then steps of 0, 2, 5 and 10
    control = np.zeros((n, 4))
    control[:, 2] = 500
    control[:100, 0] = 1
    for k, flow in enumerate((2, 5, 10)):
        control[100 + k * 100 : 200 + k * 100] = (1, 1, 500, flow)
    counts = np.stack([10 + control[:, 3] * 4, 5 + control[:, 3], np.ones(n)], axis=1) / 24990.0
    np.savez(root / "vocus/20250715/x20250715_110000_p.npz", PeakData_PeakData=counts.reshape(4, 100, 3), TimingData_BufTimes=np.arange(n, dtype=float).reshape(4, 100), TPS2_TwData=control.reshape(4, 100, 4))
    config = f"""
paths:
  gps_raw: {root}/raw
  logs_raw: {root}/raw
  gps_processed: {root}/out/gps
  roads_cache: {root}/roads
  vocus_h5_raw: {root}/vocus
  vocus_cps: {root}/out/cps
  vocus_cal_stats: {root}/out/stats
  cal_standards: {root}/ref/standards.csv
  CO_N2O_CH4_C2H6_CO2_cal: {root}/cal
  NO_NO2_NOx_O3_cal: {root}/nox
  peak_columns: {root}/ref/peaks.csv
  tps_columns: {root}/ref/controls.csv
  flags_file: {root}/ref/flags.csv
  lag_times: {root}/ref/lags.csv
  field_map: {root}/ref/fields.csv
  exclusion_poly: {root}/ref/zone.geojson
  output_l2: {root}/out/l2
  output_exchange: {root}/out/exchange
  output_targets: {root}/out/targets
config:
  org: van
  cal_cylinder_no: CYL
  output_types: [L1, L2a]
  target_instruments: [Aeris_CH4_C2H6]
  target_cylinders: [CYL]
"""
    (root / "config.yaml").write_text(config)
    return root


def test_all_stages(spark, world):
    paths, config = load((world / "config.yaml").read_text())
    pipeline = Pipeline(spark, paths, config)
    good = pipeline.run_batch([DAY])
    assert good, pipeline.results
    assert [tuple(r) for r in pipeline.summary().collect()] == [("2025-07-15", "OK", "OK", "OK", "OK")]
    track = spark.read.parquet(f"{world}/out/gps/gps_{DAY}.parquet")
    assert track.count() == 600
    row = track.filter(F.col("datetime") == F.lit("2025-07-15 18:05:02").cast("timestamp")).first()
    assert row.lat is None and row.lat_smooth == pytest.approx(37.8 + 302 * 9e-5, abs=1e-5) and row.rd_name == "North" and len(row.geometry) == 41
    assert track.filter("drive_pass is null").count() == 0 and track.agg(F.max("drive_pass")).first()[0] > 100
    cps = spark.read.parquet(f"{world}/out/cps/cps_{DAY}.parquet")
    assert cps.count() == 400 and cps.columns == ["date", "C6H7", "C7H9", "VarName1", "zero_valve", "cal_valve", "zero_flow", "cal_flow"]
    stats = {r.species: r for r in spark.read.csv(f"{world}/out/stats/calstats_{DAY}.csv", header=True, inferSchema=True).collect()}
    assert stats["C6H7"].slope == pytest.approx(4 / 2, rel=1e-6) and stats["C7H9"].slope == pytest.approx(0.25, rel=1e-6)
    zeros = spark.read.csv(f"{world}/out/stats/zeros_{DAY}.csv", header=True, inferSchema=True).collect()
    assert len(zeros) == 1 and zeros[0].C6H7 == pytest.approx(10)
    done = spark.read.parquet(f"{world}/out/l2/l2_{DAY}.parquet")
    assert done.groupBy("sample_time", "instrument", "parameter").count().filter("count > 1").isEmpty()
    no2 = done.filter("instrument = 'EcoPhysics_NOX' and parameter = 'NO2'")
    assert no2.count() == 597 and {r.value for r in no2.select("value").distinct().collect()} == {4.0}
    ch4 = done.filter("parameter = 'CH4'").agg(F.min("value"), F.max("value")).first()
    assert 0.7 < ch4[0] < 0.8 and 1.2 < ch4[1] < 1.3
    assert {r[0] for r in done.filter("parameter = 'CH4'").select("summary_flag").distinct().collect()} == {"0", "4"}
    l2 = spark.read.parquet(f"{world}/out/exchange/l2a_{DAY}_r1.parquet")
    assert {r[0] for r in l2.select("parameter").distinct().collect()} >= {"no2", "ch4", "co2", "c6h7"}
    assert l2.filter("latitude > 37.83001 and latitude < 37.83199").isEmpty() and l2.filter("vehicle_id <> 'van'").isEmpty()
    assert spark.read.parquet(f"{world}/out/exchange/l1_{DAY}_r1.parquet").count() > 0
    found = spark.read.parquet(f"{world}/out/targets/targets_{DAY}.parquet")
    assert found.filter("parameter = 'CH4'").count() == 61


def test_many_dates_in_one_plan(spark, world, tmp_path):
    """Dates of one plan are those of single runs; one without a log and one with a damaged log hold up no other."""
    (tmp_path / "raw").mkdir()
    text = (world / "raw" / readers.log_name(DAY)).read_text()
    dates = [DAY + timedelta(days=k) for k in range(5)]
    for k, day in enumerate(dates):
        if k != 3:
            (tmp_path / "raw" / readers.log_name(day)).write_text("damaged" if k == 1 else text.replace(str(DAY), str(day)).replace(",400.0,", f",{400.0 + k},"))
    yaml = (world / "config.yaml").read_text().replace(f"{world}/raw", f"{tmp_path}/raw")
    outs = {}
    for name in ("single", "together"):
        paths, config = load(yaml.replace(f"{world}/out", f"{tmp_path}/{name}"))
        pipeline = Pipeline(spark, paths, config)
        run = pipeline.run_together if name == "together" else pipeline.run_batch
        assert not run(dates, [Stage.GPS, Stage.INSTRUMENT])
        state = {(r.drive_date, r.gps, r.instrument) for r in pipeline.summary().collect()}
        assert state == {(str(d), *(("ERROR",) * 2 if k in (1, 3) else ("OK",) * 2)) for k, d in enumerate(dates)}
        outs[name] = {
            str(f.relative_to(tmp_path / name)): sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in map(lambda r: tuple(str(x) if not isinstance(x, float) else x for x in r), spark.read.parquet(str(f)).collect()))
            for f in (tmp_path / name).glob("*/*.parquet")
        }
    assert outs["single"].keys() == outs["together"].keys() and len(outs["single"]) >= 12
    for f, rows in outs["single"].items():
        assert rows == outs["together"][f], f
    assert any(r[3] == "600 rows" for r in pipeline.results)
    assert not list((tmp_path / "together").glob("*/_dates_*"))


def test_roads_from_map_elements(spark, world, tmp_path):
    """The GPS stage builds the cells that its cache lacks, once, and matches the track to them."""
    paths, config = load((world / "config.yaml").read_text().replace(f"roads_cache: {world}/roads", f"roads_cache: {tmp_path}/cells").replace(f"gps_processed: {world}/out/gps", f"gps_processed: {tmp_path}/gps"))
    asked = []

    def elements(cells):
        asked.append(cells)
        return readers.read_elements(spark, str(world / "map.json"))

    pipeline = Pipeline(spark, paths, config, elements=elements)
    for k in range(2):
        assert pipeline.run(DAY, [Stage.GPS]), pipeline.results
        assert asked == [[(37.7, -122.3), (37.8, -122.3)]]
        track = spark.read.parquet(f"{tmp_path}/gps/gps_{DAY}.parquet")
        assert track.count() == 600 and {r[0] for r in track.select("rd_name").distinct().collect()} == {"North"}
    assert tuple(pipeline.match_summary(DAY).first())[:3] == (600, 600, 100.0)
    config.use_cached_roads = False
    assert pipeline.run(DAY, [Stage.GPS]) and len(asked) == 2


def test_settings_from_elsewhere():
    with pytest.warns(UserWarning, match="generate_diagnostics"):
        paths, config = load("aliases: {raw_logs_there: logs_raw}\npaths: {raw_logs_there: /x}\nconfig: {generate_diagnostics: true, tof_extraction_freq: 1.5}\n")
    assert paths.logs_raw == "/x" and config.tof_extraction_freq == 1.5
    assert load("paths: {other: /y}", {"other": "field_map"})[0].field_map == "/y"


def test_command_line_and_policies(spark, world, capsys):
    config = str(world / "config.yaml")
    assert main(["2025-07-15", "-c", config, "-s", "gps", "--skip-existing", "-q"]) == 0
    assert main(["2025-07-14", "2025-07-15", "-c", config, "-s", "gps", "--skip-existing"]) == 1
    assert "2025-07-14 gps" in capsys.readouterr().err
    (world / "bad.yaml").write_text("paths: {}\nconfig: {}\n")
    assert main(["2025-07-15", "-c", str(world / "bad.yaml"), "-q"]) == 1
    with pytest.raises(TypeError):
        load("config: {nope: 1}")
    paths, conf = load((world / "config.yaml").read_text())
    with pytest.raises(ValueError):
        process_date_range(spark, DAY, DAY, Paths(), conf)
    stopped = Pipeline(spark, paths, conf)
    stopped.run_batch([date(2025, 7, 1), DAY], [Stage.GPS], stop_on_error=True)
    assert [r[2] for r in stopped.results] == ["ERROR"]
    assert Config(target_cylinders=["a"]).problems() and Config(min_cal_samples=60).problems()
    assert Paths(base_raw="/r", base_processed="/p").roads_cache == "/p/road_segments"


def test_readers(spark, world, tmp_path):
    csv(tmp_path / "wide.csv", "datetime,latitude,longitude,speed", [("2025-07-15 18:00:00", 37.8, -122.3, 3), ("2025-07-15 18:00:01", "NaN", -122.3, 3)])
    got = readers.read_gps(spark, str(tmp_path / "wide.csv")).collect()
    assert got[0].lat == 37.8 and got[0].direction is None and got[1].lat is None
    long = readers.read_gps(spark, f"{world}/raw/{readers.log_name(DAY)}")
    assert long.count() == 596
    assert {(r.instrument, r.lag_s) for r in readers.read_lags(spark, f"{world}/ref/lags.csv").collect()} == {("Licor_7200_CO2", 2), ("EcoPhysics_NOX", 3)}
    assert readers.read_rates(spark, "CC515288").count() == 15 and readers.read_rates(spark, "none").count() == 0
    csv(tmp_path / "rates.csv", "cylinder_number,species,names,ksens,mq", [("X", "C6H7", "n", "1.5e-9", 1), ("Y", "C6H7", "n", "2e-9", 1)])
    assert [r.ksens for r in readers.read_rates(spark, "X", str(tmp_path / "rates.csv")).collect()] == [1.5e-9]
    stats, zeros = readers.read_ion_calibrations(spark, [], [])
    assert stats.isEmpty() and zeros.isEmpty() and readers.read_gas_calibrations(spark, [], []).isEmpty()
    csv(tmp_path / "s.csv", "species,intercept,slope,date,ksens", [("C6H7", 1, 2.0, "2025-07-15T18:00:00.9Z", 2.5)])
    csv(tmp_path / "z.csv", "date,C6H7,C7H9,zero_flow,flag", [("2025-07-15T18:00:00Z", 1.0, 2.0, 500, 1)])
    stats, zeros = readers.read_ion_calibrations(spark, [str(tmp_path / "s.csv")], [str(tmp_path / "z.csv")])
    assert {(r.parameter, r.slope, r.intercept) for r in stats.collect()} == {("C6H7", 2.0, None), ("C7H9", 2.5, None)}
    assert zeros.count() == 2
    lines = {"type": "FeatureCollection", "features": [{"properties": {"rd_name": "A", "rd_type": "residential", "oneway": "true", "lat_30": "37.8", "lon_30": "-122.3", "rd_deg": "10"}, "geometry": {"type": "LineString", "coordinates": [[-122.3, 37.8], [-122.2, 37.9]]}}]}
    (tmp_path / "seg.geojson").write_text(json.dumps(lines))
    seg = roads.segment_table(readers.read_segments(spark, str(tmp_path / "seg.geojson"))).first()
    assert (seg.segment_id, seg.oneway, seg.center_lat, seg.end_lon) == (0, True, 37.8, -122.2)
    track = spark.createDataFrame([(37.8, -122.3), (37.9, -122.3)], "lat double, lon double")
    track.write.parquet(str(tmp_path / "t.parquet"))
    assert readers.read_box(spark, str(tmp_path / "t.parquet"), 37.7, -123, 37.9, -122).count() == 1
    writers.write_track(track, str(tmp_path / "t.csv"))
    assert spark.read.csv(str(tmp_path / "t.csv"), header=True).count() == 2
    assert not writers.write_if_any(track.limit(0), str(tmp_path / "none.parquet"))
    with pytest.raises(ValueError):
        readers.read_track(spark, "x.rds")
    assert "way" in roads.map_query(1, 2, 3, 4)


def test_arrays_pad_and_cut(spark, tmp_path):
    np.savez(tmp_path / "a20250101_000000_p.npz", PeakData_PeakData=np.ones((2, 5)), TimingData_BufTimes=np.arange(3.0), TPS2_TwData=np.arange(8.0).reshape(4, 2))
    spark.dataSource.register(ArraySource)
    read = lambda s: spark.read.format("arrays").option("stream", s).load(str(tmp_path))
    wide = wide_counts(read("peak"), read("control"), ["x"], 3, [(1, "c")]).orderBy("date").collect()
    assert [r.c for r in wide] == [1.0, 3.0, 5.0] and wide[0].Peak_2 == 24990.0 and wide[2].x is None


def test_streams(spark, tmp_path):
    kind = "sample_time timestamp, instrument string, parameter string, value double, string string"
    rows = [(START + timedelta(seconds=s), "A", "x", float(s), None) for s in (0, 30, 60, 91, 1000)]
    spark.createDataFrame(rows, kind).coalesce(1).write.parquet(str(tmp_path / "in"))
    limits = spark.createDataFrame([("A", "x", 0.0, 50.0, 2)], "instrument string, parameter string, range_start double, range_end double, flag_value int")
    source = lambda: spark.readStream.schema(kind).parquet(str(tmp_path / "in"))

    def drain(df, name):
        q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.table(name).collect()

    assert sorted(r.flag for r in drain(flag_stream(source(), limits), "flags")) == [0, 0, 2, 2, 2]
    assert sorted((r.mean_value, r.n) for r in drain(minute_means(source()), "means")) == [(15.0, 2), (75.5, 2)]
    assert sorted(r.n for r in drain(session_stream(source()), "sess")) == [1, 3]


def test_array_files_by_batches(spark, tmp_path, monkeypatch):
    """Both ways of reading give the same rows; times without counts have none, over batches of any size."""

    from tracklake.sources import arrays

    spark.dataSource.register(arrays.ArraySource)
    rng = np.random.default_rng(1)
    for k, (times, rows) in enumerate(((9000, 9000), (5000, 4500), (3, 10), (0, 5))):
        np.savez(tmp_path / f"x2025071{k}_110000_p.npz", PeakData_PeakData=rng.random((rows, 1, 3)), TimingData_BufTimes=np.arange(times, dtype=float), TPS2_TwData=rng.random((rows, 4)).astype("f4"))
    for stream in ("peak", "control"):
        shown = lambda df: sorted((r.file.split("/")[-1], r.row, r.offset_s, r.counts) for r in df.collect())
        a, b = shown(arrays.read_arrays(spark, str(tmp_path), stream)), shown(spark.read.format("arrays").option("stream", stream).load(str(tmp_path)))
        assert a == b and len(a) == (14003 if stream == "peak" else 13515)
        assert sum(r[3] is None for r in a) == (500 if stream == "peak" else 0)
        with np.load(tmp_path / "x20250711_110000_p.npz") as f:
            want = f["PeakData_PeakData"].reshape(-1, 3) if stream == "peak" else f["TPS2_TwData"]
        assert [r[3] for r in a if r[0] == "x20250711_110000_p.npz" and r[3]] == want.astype("f8").tolist()
