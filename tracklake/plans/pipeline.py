"""The staged pipeline over dates.

Stages hand over on disk.  A stage that fails is noted and later stages still
run; within a stage all work is Spark's.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tracklake.functions.clock import micros
from tracklake.functions.hexagons import hexagon_cells
from tracklake.functions.text import is_ion
from tracklake.operators import calibration, gps, output, quality, roads, targets
from tracklake.operators.matching import match_and_count
from tracklake.plans.config import Config, Paths, Stage, chosen
from tracklake.sources import readers, writers
from tracklake.sources.arrays import read_arrays, wide_counts
from tracklake.sources.calibration_store import CalibrationStore
from tracklake.sources.maps import RoadCache

#: Resolution of the hexagons that published readings name (fixed value).
EXCHANGE_HEXAGONS = 15
RESULTS = "drive_date string, stage string, status string, detail string"


def days(first: date, last: date) -> list[date]:
    return [first + timedelta(days=k) for k in range((last - first).days + 1)]


@dataclass
class Pipeline:
    """Stages for one date or many: ``run``, ``run_batch``, ``summary``."""

    spark: SparkSession
    paths: Paths
    config: Config
    skip_existing: bool = False
    #: Map elements of a list of cells, for roads that the cache lacks; by default map servers are asked.
    elements: Callable[[list[tuple[float, float]]], DataFrame] | None = None
    results: list[tuple[str, str, str, str | None]] = field(default_factory=list)

    # files

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return bool(fs.exists(p))

    def listed(self, pattern: str) -> list[str]:
        """Paths that match a pattern, in order."""
        fs, p = self._fs(pattern)
        return sorted(s.getPath().toString() for s in (fs.globStatus(p) or []))

    def validate(self, stages: list[Stage] | None = None) -> list[str]:
        out = self.config.problems()
        for name, there in self.paths.needed(stages).items():
            path = getattr(self.paths, name)
            if not path or (there and not self.exists(path)):
                out.append(f"{name}: {path or '(not set)'}")
        return out

    def out(self, stage: Stage, day: date | str) -> str:
        """What a stage writes for a date; its presence means it is done."""
        p = self.paths
        return {
            Stage.GPS: f"{p.gps_processed}/gps_{day}.parquet",
            Stage.ARRAYS: f"{p.vocus_cps}/cps_{day}.parquet",
            Stage.ION_CAL: f"{p.vocus_cal_stats}/calstats_{day}.csv",
            Stage.INSTRUMENT: f"{p.output_l2}/l2_{day}.parquet",
        }[stage]

    # stages

    def day_log(self, day: date) -> DataFrame:
        return readers.read_log(self.spark, f"{self.paths.gps_raw}/{readers.log_name(day)}").withColumn("drive_date", F.lit(str(day)))

    def tracks(self, long: DataFrame) -> DataFrame:
        """Matched tracks of the drives of a log."""
        c = self.config
        track = gps.process_track(long, ["drive_date"], c.kalman_process_noise, c.kalman_measurement_noise, c.kalman_max_displacement_m, c.max_interpolation_gap_s)
        segments = roads.without_service(self.road_segments(track))
        matched = match_and_count(track, segments, ["drive_date"], match_m=c.max_match_distance_m, angle_deg=c.max_match_angle_deg)
        return gps.format_track(matched, ["drive_date"])

    def gps_stage(self, day: date) -> None:
        writers.write_track(self.tracks(self.day_log(day)), self.out(Stage.GPS, day))

    def road_segments(self, track: DataFrame) -> DataFrame:
        """Segments near a track: from ready files where the folder holds such, else from the cache, whose missing cells are built."""
        c, folder = self.config, self.paths.roads_cache
        files = [f for f in self.listed(f"{folder}/*") if not f.rsplit("/", 1)[1].startswith(("cell_lat=", "_", "."))]
        if files and c.use_cached_roads:
            segments = readers.read_segments(self.spark, files)
            if "segment_id" not in segments.columns:
                segments = roads.segment_table(segments)
            return roads.in_box(segments, track)
        return RoadCache(self.spark, folder, c.segment_length_m, elements=self.elements, fresh=not c.use_cached_roads).segments(track)

    def arrays_stage(self, day: date) -> None:
        folder = f"{self.paths.vocus_h5_raw}/{day:%Y%m%d}"
        read = lambda s: read_arrays(self.spark, folder, s)
        names = readers.read_peak_names(self.spark, self.paths.peak_columns)
        controls = readers.read_control_columns(self.spark, self.paths.tps_columns)
        writers.write_cps(wide_counts(read("peak"), read("control"), names, len(names), controls, self.config.tof_extraction_freq), self.out(Stage.ARRAYS, day))

    def ion_cal_stage(self, day: date) -> None:
        c = self.config
        cps = readers.read_cps(self.spark, self.out(Stage.ARRAYS, day), c.calibration_zone).withColumn("drive_date", F.lit(str(day)))
        by = ["drive_date"]
        standards = readers.read_standards(self.spark, self.paths.cal_standards).filter((F.col("cylinder_number") == c.cal_cylinder_no) & (F.col("cal_concs") > 0))
        known = {r.species for r in standards.select("species").collect()}  # a cylinder's species
        species = [n for n in cps.columns if n in known]
        if species and calibration.varies(cps, by).first()["varies"]:
            how = {"tolerance": c.flow_tolerance, "zero_flow": c.zero_flow_thresh, "least": c.min_cal_samples, "window": c.cal_window_samples}
            steps = calibration.steps_table(cps, by, species, standards, c.cal_step_flows, **how)
            stats = calibration.fit_species(steps, by)
            rates = readers.read_rates(self.spark, c.cal_cylinder_no, self.paths.ksens_standards or None)
            stats = stats.join(calibration.sensitivity(stats, rates, by, c.default_k), by)
            writers.write_stats(stats.drop(*by), self.out(Stage.ION_CAL, day))
        numeric = [n for n, k in cps.dtypes if n not in ("date", "drive_date") and k in ("double", "float", "int", "bigint")]
        zeros = calibration.drive_zeros(cps, by, numeric, least=c.min_cal_samples, window=c.cal_window_samples)
        writers.write_stats(zeros.drop(*by), f"{self.paths.vocus_cal_stats}/zeros_{day}.csv")

    def day_readings(self, day: date, fields: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Readings and track of a date."""
        p, c, spark = self.paths, self.config, self.spark
        cps = self.out(Stage.ARRAYS, day)
        ions = [r.parameter_ucb for r in fields.filter(is_ion("parameter_ucb", c.ptr_prefixes)).select("parameter_ucb").distinct().collect()]
        rows = readers.read_day(spark, p.logs_raw, day)
        if self.exists(cps):
            wide = readers.read_cps(spark, cps, c.cps_zone)
            extra = [n for n in wide.columns if n in ions or n in targets.GATES]
            rows = rows.unionByName(readers.cps_long(wide, extra))
        track = readers.read_track(spark, self.out(Stage.GPS, day))
        return tuple(df.withColumn("drive_date", F.lit(str(day))) for df in (rows, track))

    def placed_readings(self, rows: DataFrame, track: DataFrame) -> DataFrame:
        """Readings with lags, flags and positions."""
        p, spark, by = self.paths, self.spark, ["drive_date"]
        rows = quality.apply_lags(rows, readers.read_lags(spark, p.lag_times))
        rows = quality.within_track(rows, track, by)
        rows = quality.flag_readings(rows, readers.read_thresholds(spark, p.flags_file), by)
        return quality.join_track(rows, track, by)

    def calibrations(self, track: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Slopes, sensitivities and zeros for readings on a track: from the store, which takes in new files, or, without one, from all files."""
        p, c, spark = self.paths, self.config, self.spark
        patterns = {"gas": f"{p.CO_N2O_CH4_C2H6_CO2_cal}/*.csv", "nox": f"{p.NO_NO2_NOx_O3_cal}/*.csv", "stats": f"{p.vocus_cal_stats}/calstats_*.csv", "zeros": f"{p.vocus_cal_stats}/zeros_*.csv"}
        files = {name: self.listed(pattern) for name, pattern in patterns.items()}

        def read(found: dict[str, list[str]]) -> tuple[DataFrame, DataFrame, DataFrame]:
            gas = readers.read_gas_calibrations(spark, found["gas"], found["nox"])
            ion, zeros = readers.read_ion_slopes(spark, found["stats"], found["zeros"], c.ptr_prefixes)
            slopes = ion.select("instrument", "parameter", "sample_time", "slope", F.lit(None).cast("double").alias("intercept"))
            return gas.unionByName(slopes), ion.select("instrument", "sample_time", "ksens").distinct(), zeros

        if not p.calibration_store:
            return read(files)
        store = CalibrationStore(spark, p.calibration_store)
        store.absorb(files, read)
        span = track.agg(F.min(micros("sample_time")), F.max(micros("sample_time"))).first()
        return store.around(*span)

    def calibrated_readings(self, placed: DataFrame, track: DataFrame) -> DataFrame:
        c, by = self.config, ["drive_date"]
        slopes, sensitivities, zeros = self.calibrations(track)
        carried = [n for n in placed.columns if n not in (*by, "sample_time", "instrument", "parameter", "value")]
        done = calibration.calibrate(placed, slopes, zeros, by, carried, c.ptr_prefixes, sensitivities)
        return output.round_columns(done, c.value_precision, c.coord_precision)

    def published(self, done: DataFrame, placed: DataFrame, fields: DataFrame, by: tuple[str, ...] = ()) -> dict[str, DataFrame]:
        """The tables that are published from calibrated readings, with the columns ``by``, by the pattern of their paths."""
        p, c, spark = self.paths, self.config, self.spark
        rings = readers.read_rings(spark, p.exclusion_poly) if p.exclusion_poly else None
        out = {}
        if "L2a" in c.output_types:
            out[f"{p.output_exchange}/l2a_{{day}}_{c.revision}.parquet"] = output.exchange_rows(done, fields, c.org, rings, hexagon_cells(EXCHANGE_HEXAGONS), by)
        if "L1" in c.output_types:
            out[f"{p.output_exchange}/l1_{{day}}_{c.revision}.parquet"] = output.raw_rows(placed, fields, by)
        return out

    def found_targets(self, done: DataFrame) -> DataFrame | None:
        p, c, spark = self.paths, self.config, self.spark
        if not c.target_instruments:
            return None
        want = targets.requested(spark, c.target_instruments, c.target_cylinders)
        return targets.find_targets(done, want, readers.read_standards(spark, p.cal_standards), ["drive_date"], c.vocus_target_flow, float(c.target_length))

    def instrument_stage(self, day: date) -> None:
        fields = readers.read_fields(self.spark, self.paths.field_map)
        rows, track = self.day_readings(day, fields)
        placed = self.placed_readings(rows, track)
        writers.write_table(self.calibrated_readings(placed, track), self.out(Stage.INSTRUMENT, day))
        done = self.spark.read.parquet(self.out(Stage.INSTRUMENT, day))
        for path, table in self.published(done, placed, fields).items():
            writers.write_table(table, path.format(day=day))
        if (found := self.found_targets(done)) is not None:
            writers.write_if_any(found, f"{self.paths.output_targets}/targets_{day}.parquet")

    # many dates in one plan

    def write_dates(self, df: DataFrame, path: str, dates: list[date], empty: bool = True) -> dict[date, int]:
        """Write a table of many dates in one job, each date to its own path (with ``{day}``); returns the dates' rows.

        A row's date is ``_day``, which is not written, else ``drive_date``.
        Dates are written side by side into one folder and then renamed, so a
        job that fails changes no date's output.  A date without rows has an
        empty table, or, if not ``empty``, none.
        """
        seen = Observation()
        keyed = df if "_day" in df.columns else df.withColumn("_day", F.col("drive_date"))
        counted = keyed.observe(seen, *(F.count_if(F.col("_day") == str(d)).alias(f"n{k}") for k, d in enumerate(dates)))
        staging = f"{path.rsplit('/', 1)[0]}/_dates_{uuid.uuid4().hex}"
        counted.write.partitionBy("_day").parquet(staging)
        rows = {d: seen.get[f"n{k}"] for k, d in enumerate(dates)}
        for d in dates:
            target = path.format(day=d)
            fs, p = self._fs(target)
            if rows[d]:
                fs.delete(p, True)
                if not fs.rename(self._fs(f"{staging}/_day={d}")[1], p):
                    raise OSError(f"{target} could not be put in place")
            elif empty:
                writers.write_table(df.limit(0).drop("_day"), target)
        fs, p = self._fs(staging)
        fs.delete(p, True)
        return rows

    def gps_dates(self, dates: list[date], logs: dict[date, DataFrame]) -> dict[date, int]:
        track = writers.with_line(self.tracks(_together([logs[d] for d in dates])))
        return self.write_dates(track, self.out(Stage.GPS, "{day}"), dates)

    def instrument_dates(self, dates: list[date], inputs: dict[date, tuple[DataFrame, DataFrame]]) -> dict[date, int]:
        fields = readers.read_fields(self.spark, self.paths.field_map)
        read, track = (_together([inputs[d][k] for d in dates]) for k in (0, 1))
        placed = self.placed_readings(read, track)
        rows = self.write_dates(self.calibrated_readings(placed, track), self.out(Stage.INSTRUMENT, "{day}"), dates)
        done = self.spark.read.parquet(*(self.out(Stage.INSTRUMENT, d) for d in dates))
        day = lambda df: df.withColumn("_day", F.col("drive_date"))
        for path, table in self.published(day(done), day(placed), fields, ("_day",)).items():
            self.write_dates(table, path, dates)
        if (found := self.found_targets(done)) is not None:
            self.write_dates(found, f"{self.paths.output_targets}/targets_{{day}}.parquet", dates, empty=False)
        return rows

    def run_together(self, dates: list[date], stages: list[Stage] | None = None) -> bool:
        """All chosen stages over many dates, with the dates as a key of one plan for each stage.

        The GPS and instrument stages run as one job over all dates; the array
        and calibration stages, whose rows meet by position in a date's files,
        run date by date before the instrument stage.  A date whose inputs can't
        be opened is told apart before the job and does not hold up the others;
        if the job itself fails, its dates run one by one, so that only bad ones
        stay without output.  Roads are matched in a plane about the mean
        latitude of all dates' roads.
        """
        if problems := self.validate(stages):
            raise ValueError("; ".join(problems))
        good = True
        fields = readers.read_fields(self.spark, self.paths.field_map) if Stage.INSTRUMENT in chosen(stages) else None
        joint = {Stage.GPS: (self.day_log, self.gps_dates), Stage.INSTRUMENT: (lambda d: self.day_readings(d, fields), self.instrument_dates)}
        for stage in chosen(stages):
            if stage not in joint:
                for day in dates:
                    good &= self.run(day, [stage])
                continue
            opened, (open_, work) = {}, joint[stage]
            for day in dates:
                if self.skip_existing and self.exists(self.out(stage, day)):
                    self.results.append((str(day), stage.value, "SKIPPED", None))
                    continue
                try:
                    opened[day] = open_(day)
                except Exception as why:  # noqa: BLE001  a date that can't be opened is a result
                    good = False
                    self.results.append((str(day), stage.value, "ERROR", str(why).split("\n")[0][:300]))
            if not opened:
                continue
            try:
                rows = work(list(opened), opened)
                self.results += [(str(d), stage.value, "OK", f"{n} rows") for d, n in rows.items()]
            except Exception:  # noqa: BLE001  one date's data may have stopped all
                for day in opened:
                    good &= self.run(day, [stage])
        return good

    # running

    def run(self, day: date, stages: list[Stage] | None = None) -> bool:
        """All chosen stages of a date; says whether none failed."""
        work = {Stage.GPS: self.gps_stage, Stage.ARRAYS: self.arrays_stage, Stage.ION_CAL: self.ion_cal_stage, Stage.INSTRUMENT: self.instrument_stage}
        good = True
        for stage in chosen(stages):
            if self.skip_existing and self.exists(self.out(stage, day)):
                self.results.append((str(day), stage.value, "SKIPPED", None))
                continue
            try:
                work[stage](day)
                self.results.append((str(day), stage.value, "OK", None))
            except Exception as why:  # noqa: BLE001  a stage's failure is a result
                good = False
                self.results.append((str(day), stage.value, "ERROR", str(why).split("\n")[0][:300]))
        return good

    def run_batch(self, dates: list[date], stages: list[Stage] | None = None, stop_on_error: bool = False) -> bool:
        if problems := self.validate(stages):
            raise ValueError("; ".join(problems))
        good = True
        for day in dates:
            good &= self.run(day, stages)
            if stop_on_error and not good:
                break
        return good

    def match_summary(self, day: date) -> DataFrame:
        """How much of a date's track found a road."""
        return gps.match_statistics(self.spark.read.parquet(self.out(Stage.GPS, day)).withColumn("segment_id", F.col("lat_30")))

    def summary(self) -> DataFrame:
        """A row for each date with the state of each stage."""
        done = self.spark.createDataFrame([(*r, k) for k, r in enumerate(self.results)], f"{RESULTS}, run long")
        return summarise(done)


def _together(days: list[DataFrame]) -> DataFrame:
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), days)


def summarise(results: DataFrame) -> DataFrame:
    """A row for each date; of several runs of a stage the last (by ``run``, where there is one) counts."""
    names = [s.value for s in chosen(None)]
    state = F.max_by("status", "run") if "run" in results.columns else F.max("status")
    wide = results.groupBy("drive_date").pivot("stage", names).agg(state)
    return wide.select("drive_date", *(F.coalesce(n, F.lit("-")).alias(n) for n in names)).orderBy("drive_date")


def process_date(spark: SparkSession, day: date, paths: Paths, config: Config, stages: list[Stage] | None = None) -> Pipeline:
    pipeline = Pipeline(spark, paths, config)
    pipeline.run_batch([day], stages)
    return pipeline


def process_date_range(spark: SparkSession, first: date, last: date, paths: Paths, config: Config, stages: list[Stage] | None = None) -> Pipeline:
    pipeline = Pipeline(spark, paths, config)
    pipeline.run_batch(days(first, last), stages)
    return pipeline
