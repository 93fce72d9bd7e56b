"""Calibrations from a store against those from the whole history."""

import random
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tracklake.operators import calibration
from tracklake.plans.config import Stage, load
from tracklake.plans.pipeline import Pipeline
from tracklake.sources.calibration_store import CalibrationStore
from tests.test_end_to_end import DAY, csv, world  # noqa: F401

START = datetime(2025, 1, 1, tzinfo=timezone.utc)
ION = calibration.ION_INSTRUMENT
SLOPES = "instrument string, parameter string, sample_time timestamp, slope double, intercept double"
ZEROS = "instrument string, parameter string, sample_time timestamp, zero double"
RUN = ["day", "instrument", "parameter"]


def at(hours):
    return START + timedelta(hours=hours)


def history(rng, n=60, span=2000):
    """Slopes of some keys and zeros of others, with ties, keys of one point, and names without a slope."""
    slopes, zeros, sens = [], [], []
    for k in range(n):
        h = rng.choice([rng.randrange(span), 700, 701])
        slopes.append((rng.choice(["a", ION]), rng.choice(["C1H2", "C2H2", "N3"]), at(h), rng.choice([1.0, 2.0, 3.0]) + k, 0.5))
        zeros.append((ION, rng.choice(["C1H2", "C2H2", "C3H2", "C4H2"]), at(rng.randrange(span)), rng.random()))
        sens.append((ION, at(h), 10.0 + k))
    return [*slopes, ("a", "once", at(900), 7.0, None), ("a", None, at(1), 1.0, 1.0), (None, "C1H2", at(1), 1.0, 1.0)], sens, [*zeros, (ION, "C9H9", at(5), 4.0)]


def frames(spark, slopes, sens, zeros):
    return spark.createDataFrame(slopes, SLOPES), spark.createDataFrame(sens, "instrument string, sample_time timestamp, ksens double"), spark.createDataFrame(zeros, ZEROS)


def day_rows(spark, hours):
    names = [("a", "C1H2"), ("a", "once"), ("a", "never"), (ION, "C1H2"), (ION, "C2H2"), (ION, "C3H2"), (ION, "C4H2"), (ION, "C9H9"), (ION, None)]
    rows = [("d", i, p, at(hours) + timedelta(hours=k), float(k)) for i, p in names for k in range(0, 40, 3)]
    return spark.createDataFrame(rows, "day string, instrument string, parameter string, sample_time timestamp, value double")


def found(rows, slopes, sens, zeros):
    out = calibration.bracket_runs(rows, slopes, RUN, stand_ins=sens.withColumn("slope", F.col("ksens")), lacking=calibration.without_slope(slopes, zeros))
    out = calibration.with_zeros(out, zeros)
    return sorted((str(r.instrument), str(r.parameter), r.sample_time, r.slope, r.intercept, r.zero) for r in out.collect())


def test_days_are_as_from_the_whole_history(spark, tmp_path):
    """Before, inside and after the history, in a stretch without calibrations, whatever order they came in."""
    rng = random.Random(5)
    slopes, sens, zeros = history(rng)
    late = [(i, p, t + timedelta(hours=9000), s, c) for i, p, t, s, c in slopes[:9]]
    whole = frames(spark, slopes + late, sens, zeros)
    store = CalibrationStore(spark, str(tmp_path / "s"), bucket_s=5 * 86_400)
    mixed = rng.sample(slopes, len(slopes))
    for part in ((late, sens[:20], zeros[::2]), (mixed[:30], [], []), (mixed[30:], sens[20:], zeros[1::2])):
        store.put(*frames(spark, *part))
    assert len(store.buckets()) > 12
    for hours in (-500, 690, 1960, 5000, 11500):
        rows = day_rows(spark, hours)
        some = store.around(*rows.agg(F.min("sample_time"), F.max("sample_time")).first())
        assert found(rows, *some) == found(rows, *whole), hours
    assert all(df.collect() == [] for df in store.around(None, None))


def test_stand_ins_are_filled_species(spark):
    slopes, sens, zeros = frames(spark, *history(random.Random(8)))
    ions = slopes.filter(F.col("instrument") == ION)
    stats = ions.join(sens, ["instrument", "sample_time"])
    filled = calibration.fill_species(stats, zeros).withColumn("intercept", F.lit(None).cast("double"))
    rows = day_rows(spark, 800).filter(F.col("instrument") == ION)
    want = calibration.bracket_runs(rows, filled.select(slopes.columns), RUN)
    times = stats.select("instrument", "sample_time", F.col("ksens").alias("slope")).distinct()
    plain = stats.select(*slopes.columns[:4], F.lit(None).cast("double").alias("intercept"))
    got = calibration.bracket_runs(rows, plain, RUN, stand_ins=times, lacking=calibration.without_slope(ions, zeros))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.filter("slope >= 10").count() > 0


def test_files_read_do_not_grow_with_the_history(spark, tmp_path):
    """Two years of monthly buckets or two months: a day opens as many files."""
    read = []
    for months in (2, 24):
        store = CalibrationStore(spark, str(tmp_path / f"s{months}"))
        rows = [("a", "p", at(h), 1.0, 0.0) for h in range(0, months * 720, 48)]
        store.put(*frames(spark, rows, [], []))
        slopes, _, _ = store.around(at(800), at(820))
        read.append(len({f for f in slopes.inputFiles()}))
        assert len(store.buckets()) >= months
    assert read[0] == read[1] <= 3


def test_only_new_files_are_read(spark, tmp_path):
    calls = []

    def read(files):
        calls.append(sorted(Path(p).name for p in files["gas"]))
        rows = [("a", "p", at(float(line.split(",")[0])), float(line.split(",")[1]), 0.0) for p in files["gas"] for line in Path(p).read_text().split()[1:]]
        return frames(spark, rows, [], [])

    names = [tmp_path / f"g{k}.csv" for k in range(3)]
    for k, p in enumerate(names):
        csv(p, "h,slope", [(k * 1000, k + 1.0)])
    store, paths = CalibrationStore(spark, str(tmp_path / "s")), list(map(str, names))
    held = lambda: sorted(r.slope for r in store.around(at(-1), at(9999))[0].collect())
    assert store.absorb({"gas": paths[:2]}, read) == 2 and held() == [1.0, 2.0]
    assert store.absorb({"gas": paths[:2]}, read) == 0
    assert store.absorb({"gas": paths}, read) == 1 and calls[-1] == ["g2.csv"] and held() == [1.0, 2.0, 3.0]
    csv(names[1], "h,slope", [(1000, 22.5), (1001, 23.0)])
    assert store.absorb({"gas": paths}, read) == 3 and held() == [1.0, 3.0, 22.5, 23.0]
    assert store.absorb({"gas": paths[1:]}, read) == 2 and held() == [3.0, 22.5, 23.0]
    (tmp_path / "s/_renaming").touch()  # an update stopped here
    with pytest.raises(ValueError, match="incomplete"):
        store.around(at(0), at(1))
    assert store.absorb({"gas": paths}, read) == 3 and held() == [1.0, 3.0, 22.5, 23.0]
    assert store.absorb({"gas": []}, read) == 0 and store.buckets() == []
    assert not list((tmp_path / "s").glob("_*"))


def test_the_instrument_stage_through_the_store(spark, world, tmp_path):  # noqa: F811
    """A day's calibrated readings are the same with a store as without, also when it is there already."""
    text = (world / "config.yaml").read_text()
    paths, config = load(text.replace(f"{world}/out", f"{tmp_path}/plain"))
    assert Pipeline(spark, paths, config).run_batch([DAY])
    outs = []
    for name in ("plain", "stored", "again"):
        if name != "plain":
            moved = text.replace(f"{world}/out/l2", f"{tmp_path}/{name}/l2").replace(f"{world}/out/exchange", f"{tmp_path}/{name}/ex").replace(f"{world}/out/targets", f"{tmp_path}/{name}/t")
            moved = moved.replace(f"{world}/out", f"{tmp_path}/plain").replace("  output_l2:", f"  calibration_store: {tmp_path}/store\n  output_l2:")
            paths, config = load(moved)
            pipeline = Pipeline(spark, paths, config)
            assert pipeline.run_batch([DAY], [Stage.INSTRUMENT]), pipeline.results
        outs.append(sorted(map(str, spark.read.parquet(f"{tmp_path}/{name}/l2/l2_{DAY}.parquet").collect())))
    assert outs[0] == outs[1] == outs[2] and len(outs[0]) > 1000


def test_an_update_writes_its_files_in_many_tasks(spark, tmp_path):
    store = CalibrationStore(spark, str(tmp_path / "s"), bucket_s=86_400)
    rows = [("a", p, at(h), float(h), 0.0) for p in ("p", "q") for h in range(0, 2400, 12)]
    store.put(*frames(spark, rows[::2], [], []))
    store.put(*frames(spark, rows[1::2], [], []))
    for what in ("points", "edges"):
        files = list((tmp_path / "s" / what).glob("bucket=*/*.parquet"))
        assert len(files) == len(store.buckets()) == 100  # one for each bucket
        assert len({f.name.split("-")[1] for f in files}) > 4
    slopes, _, _ = store.around(at(1205), at(1206))
    assert sorted({r.sample_time for r in slopes.collect()}) == [at(h).replace(tzinfo=None) for h in (1176, 1188, 1200, 1212, 1224, 1236)]
