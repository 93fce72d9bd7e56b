"""Calibration: standards, slopes, zeros, and applying them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklake.functions.clock import floor_second, mean_time, micros
from tracklake.functions.numbers import calibrated, line_at
from tracklake.functions.text import is_ion
from tracklake.operators.ordered import first_per, session_means, tail_rows
from tracklake.operators.small import small

#: Species left out of the sensitivity line (fixed values).
NOT_IN_LINE = ("CH5S", "CH5O", "C2H7O", "C10H23")
#: Gases whose intercepts are stored in thousandths, and the one without (fixed values).
SMALL_INTERCEPT, NO_INTERCEPT = ("CH4", "N2O", "CO2MFd"), "CO"
#: The instrument that measures ions (fixed value).
ION_INSTRUMENT = "Vocus-PTR-ToF"


def rma(y: str, x: str) -> tuple[Column, Column]:
    """Aggregates: slope and intercept of reduced major axis regression.

    An orthogonal fit whose errors are a fixed share of either standard
    deviation has this closed form: sign(cov) sd(y) / sd(x).  Pairs with a null
    or an infinite number are left out; fewer than two pairs, no spread in x, or
    no covariance give null; no spread in y gives slope 0.
    """
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    both = fine(a) & fine(b)
    a, b = F.when(both, a), F.when(both, b)
    sx, sy, cov = F.stddev_pop(a), F.stddev_pop(b), F.covar_pop(b, a)
    slope = F.when((F.count(a) < 2) | (sx == 0), F.lit(None)).when(sy == 0, F.lit(0.0)).when(cov != 0, F.signum(cov) * F.try_divide(sy, sx))
    return slope, F.avg(b) - slope * F.avg(a)


def step_means(cps: DataFrame, by: list[str], species: list[str], standards: DataFrame, step_flow: float, cal_valve: int, zero_valve: int,
               tolerance: float = 0.1, zero_flow: float = 450.0, least: int = 70, window: int = 60, order: list[str] | None = None) -> DataFrame:
    """Means of a calibration step for each species: of the last ``least`` matching rows the first ``window``.

    Fewer rows give none.  The concentration of the standard is diluted by the
    ratio of the flows in each row.
    """
    on = (
        (F.abs(F.col("cal_flow") - step_flow) < tolerance)
        & (F.col("cal_valve") == cal_valve) & (F.col("zero_valve") == zero_valve) & (F.col("zero_flow") > zero_flow)
    )
    rows = tail_rows(cps.filter(on), by, order or ["date"], least, window)
    long = rows.unpivot([*by, "date", "cal_flow", "zero_flow"], species, "species", "counts")
    joined = long.join(standards.select("species", "cal_concs"), "species")
    dil = F.col("cal_concs") * F.try_divide(F.col("cal_flow"), F.col("zero_flow"))
    return joined.groupBy(*by, "species").agg(
        F.avg("counts").alias("counts"), F.avg("cal_flow").alias("cal_flow"), F.avg("zero_flow").alias("zero_flow"),
        F.avg(dil).alias("cal_conc_dil"), mean_time("date").alias("date"),
    )


def steps_table(cps: DataFrame, by: list[str], species: list[str], standards: DataFrame, flows: list[float] = (0.0, 2.0, 5.0, 10.0), **how) -> DataFrame:
    """All calibration steps: the zero step has the calibration valve closed."""
    out = None
    for flow in flows:
        one = step_means(cps, by, species, standards, flow, 0 if flow == 0 else 1, 1, **how).withColumn("step_flow", F.lit(float(flow)))
        out = one if out is None else out.unionByName(one)
    return out


def fit_species(steps: DataFrame, by: list[str]) -> DataFrame:
    """Slope and intercept of counts on concentration for each species, at the drive's latest step time."""
    slope, intercept = rma("counts", "cal_conc_dil")
    lines = steps.groupBy(*by, "species").agg(intercept.alias("intercept"), slope.alias("slope"), F.max("date").alias("_date"))
    if not by:
        date = lines.agg(F.max("_date").alias("date"))
        return lines.drop("_date").crossJoin(F.broadcast(date))  # one row
    return lines.join(lines.groupBy(*by).agg(F.max("_date").alias("date")), by).drop("_date")


def sensitivity(stats: DataFrame, rates: DataFrame, by: list[str], default_k: float = 2.5) -> DataFrame:
    """For each drive the sensitivity at the default rate, from the line of slopes on rates (in 1e-9).

    Without two species to draw it through, the rate itself.
    """
    usable = ~F.col("species").isin(*NOT_IN_LINE) & F.col("slope").isNotNull()
    x = F.col("_k") * 1e9
    joined = stats.join(rates.select("species", F.col("ksens").alias("_k")), "species", "left")
    pair = usable & F.col("_k").isNotNull()
    y, x = F.when(pair, F.col("slope")), F.when(pair, x)
    line = F.when(F.count(x) >= 2, F.regr_slope(y, x) * default_k + F.regr_intercept(y, x))
    return joined.groupBy(*by).agg(F.coalesce(line, F.lit(default_k * 1e9)).alias("ksens"))


def varies(cps: DataFrame, by: list[str], least: float = 0.1) -> DataFrame:
    """Whether the calibration flow of a drive moved at all; one row is not enough to say it did not."""
    return cps.groupBy(*by).agg((F.coalesce(F.stddev_samp("cal_flow"), F.lit(float("inf"))) > least).alias("varies"))


def drive_zeros(cps: DataFrame, by: list[str], values: list[str], gap_s: float = 30.0, zero_flow: float = 400.0, least: int = 70, window: int = 60, order: list[str] | None = None) -> DataFrame:
    """Means over the tail of each zero: the zero valve open, the calibration valve closed, enough flow."""
    on = (F.col("zero_valve") == 1) & (F.col("cal_valve") == 0) & (F.col("zero_flow") > zero_flow)
    return session_means(cps.filter(on), by, "date", gap_s, least, window, values, order or ["date"])


def fill_species(stats: DataFrame, species: DataFrame) -> DataFrame:
    """Rows for species that have zeros but no slope anywhere: the sensitivity stands in at every time.

    ``species`` has one row for each name; both sides of the product are the
    distinct times and the missing names, a table of calibrations.
    """
    missing = species.select("parameter").distinct().join(stats.select("parameter").distinct(), "parameter", "left_anti")
    times = stats.select("instrument", "sample_time", "ksens").distinct()
    added = times.crossJoin(missing).select("instrument", "parameter", "sample_time", F.col("ksens").alias("slope"), "ksens")
    return stats.select("instrument", "parameter", "sample_time", "slope", "ksens").unionByName(added)


def without_slope(cals: DataFrame, zeros: DataFrame, time: str = "sample_time") -> DataFrame:
    """Names (instrument, parameter) that have zeros but no calibration at any time."""
    key = ["instrument", "parameter"]
    return zeros.select(*key).distinct().join(cals.filter(F.col(time).isNotNull()).select(*key).distinct(), key, "left_anti")


def bracket_runs(readings: DataFrame, cals: DataFrame, run: list[str], time: str = "sample_time", stand_ins: DataFrame | None = None, lacking: DataFrame | None = None) -> DataFrame:
    """Slope and intercept at each reading, on the line between the calibrations around its run.

    The bracket of a run (an instrument's parameter on a drive) is the last
    calibration strictly before its first reading and the first strictly after
    its last; those inside are ignored.  One side alone is constant; none is
    slope 1, intercept 0.  A null intercept counts as 0.

    ``stand_ins`` (instrument, time, slope) calibrate the parameters in
    ``lacking`` (instrument, parameter), all by the same rows: the runs ask for
    them, so they are not repeated for each name as in ``fill_species``.

    First and last times of the runs and the calibrations of a key are sorted
    together, and the calibration seen last is carried along, so runs and
    calibrations do not meet in pairs.
    """
    key, name = ["instrument", "_key"], F.concat(F.lit("="), "parameter")

    def points(df: DataFrame, named: Column) -> DataFrame:
        point = F.struct(micros(time).alias("t"), F.col("slope").cast("double").alias("s"), F.coalesce(F.col("intercept").cast("double"), F.lit(0.0)).alias("i"))
        there = df.filter(F.col(time).isNotNull() & F.col("instrument").isNotNull())
        return there.select("instrument", named.alias("_key"), micros(time).alias("_t"), F.lit("cal").alias("_what"), point.alias("_p")).filter("_key IS NOT NULL")

    known = points(cals, name)
    bounds = readings.groupBy(*run).agg(F.min(micros(time)).alias("low"), F.max(micros(time)).alias("high")).withColumn("_key", name)
    if stand_ins is not None and lacking is not None:
        known = known.unionByName(points(stand_ins.withColumn("intercept", F.lit(0.0)), F.lit("")))
        marked = lacking.select("instrument", "parameter").distinct().withColumn("_lacks", F.lit(True))
        bounds = bounds.join(marked, ["instrument", "parameter"], "left").withColumn("_key", F.when(F.col("_lacks"), F.lit("")).otherwise(F.col("_key")))
    asks = bounds.unpivot([*run, "_key"], ["low", "high"], "_what", "_t")
    both = asks.unionByName(known, allowMissingColumns=True).withColumn("_k", (F.col("_what") == "cal").cast("int"))
    running = lambda *order: Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before, after = running("_t", "_k", F.col("_p.s")), running(F.desc("_t"), "_k", F.desc("_p.s"))
    seen = both.withColumns({"_a": F.last("_p", True).over(before), "_b": F.last("_p", True).over(after)})
    around = seen.filter("_k = 0").groupBy(*run).agg(F.max(F.when(F.col("_what") == "low", F.col("_a"))).alias("_a"), F.max(F.when(F.col("_what") == "high", F.col("_b"))).alias("_b"))
    a, b, t = F.col("_a"), F.col("_b"), micros(time)
    none = a.isNull() & b.isNull()

    def between(field: str, default: float) -> Column:
        one = F.coalesce(a, b)[field]
        both = a.isNotNull() & b.isNotNull()
        return F.when(none, F.lit(default)).when(both, line_at(t, a["t"], a[field], b["t"], b[field])).otherwise(one)

    return readings.join(around, run, "left").withColumns({"slope": between("s", 1.0), "intercept": between("i", 0.0)}).drop("_a", "_b")


def intercept_units(df: DataFrame) -> DataFrame:
    """Intercepts in the units of the readings."""
    p = F.col("parameter")
    return df.withColumn("intercept", F.when(p.isin(*SMALL_INTERCEPT), F.col("intercept") / 1000).when(p == NO_INTERCEPT, F.lit(0.0)).otherwise(F.col("intercept")))


#: Seconds in a bucket of time in which readings meet the zeros around them.
ZERO_BUCKET_S = 86_400


def zero_lines(zeros: DataFrame, keys: list[str], time: str = "sample_time") -> DataFrame:
    """For each key the lines between neighbouring zeros: (t0, v0) to (t1, v1), and whether it is the first or the last.

    Keys with fewer than two zeros have none.
    """
    order = Window.partitionBy(*keys).orderBy("_t0", "_v0")
    points = zeros.filter(F.col(time).isNotNull()).select(*keys, micros(time).alias("_t0"), F.col("zero").cast("double").alias("_v0"))
    lines = points.withColumns({"_t1": F.lead("_t0").over(order), "_v1": F.lead("_v0").over(order), "_first": F.lag("_t0").over(order).isNull(), "_last": F.lead("_t0", 2).over(order).isNull()})
    return lines.filter("_t1 IS NOT NULL")


def add_zero(df: DataFrame, lines: DataFrame, keys: list[str], time: str, name: str = "zero", where: Column | None = None) -> DataFrame:
    """Add the value at each row's time of the line through the two zeros around it.

    Before the first zero and after the last the line goes on; a time equal to
    a zero's belongs to the line that ends there.  Without lines, where
    ``where`` does not hold, or where the result is not a finite number, it is 0.

    Lines are dealt to the time buckets that they touch, so readings meet them
    by key and bucket, and a reading sees only the lines of its bucket.  Those
    beyond a key's zeros take its first or last line, of which there is one
    each a key.
    """
    us = ZERO_BUCKET_S * 1_000_000
    line = ["_t0", "_v0", "_t1", "_v1"]
    ends = lines.groupBy(*keys).agg(*(F.max(F.when(F.col(f), F.struct(*line))).alias(f) for f in ("_first", "_last")))
    dealt = lines.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("_t0") / us), F.floor(F.col("_t1") / us))))
    dealt = dealt.select(*(F.col(k).alias(f"_l{i}") for i, k in enumerate(keys)), F.col("_bucket").alias("_lb"), *line, F.col("_first").alias("_f"))
    rows = df.join(small(ends), keys, "left").withColumns({"_t": micros(time), "_bucket": F.floor(micros(time) / us)})
    inside = F.col("_t").between(F.col("_first._t0"), F.col("_last._t1"))
    meets = (F.col("_bucket") == F.col("_lb")) & inside & (F.col("_t") <= F.col("_t1")) & ((F.col("_t") > F.col("_t0")) | F.col("_f"))
    for i, k in enumerate(keys):
        meets = (F.col(k) == F.col(f"_l{i}")) & meets
    rows = rows.join(dealt, meets, "left")
    at = lambda n: F.when(F.col("_t") < F.col("_first._t0"), F.col(f"_first.{n}")).when(F.col("_t") > F.col("_last._t1"), F.col(f"_last.{n}")).otherwise(F.col(n))
    value = line_at(F.col("_t"), *(at(n) for n in line))
    fine = ~F.isnan("_v") & (F.abs("_v") != float("inf")) & (F.lit(True) if where is None else where)
    valued = rows.withColumn("_v", value).withColumn(name, F.coalesce(F.when(fine, F.col("_v")), F.lit(0.0)))
    return valued.select(*df.columns, name)


def with_zeros(readings: DataFrame, zeros: DataFrame, time: str = "sample_time", letters: str = "HCOKSNV") -> DataFrame:
    """Add ``zero``: interpolated for ions of the ion instrument, 0 for all else."""
    keys = ["instrument", "parameter"]
    ion = (F.col("instrument") == ION_INSTRUMENT) & is_ion("parameter", letters)
    return add_zero(readings, zero_lines(zeros, keys, time), keys, time, where=ion)


def derived_difference(readings: DataFrame, by: list[str], instrument: str, minuend: str, subtrahend: str, name: str) -> DataFrame:
    """Rows of a derived parameter: the mean of one minus that of another at each time; null if either is missing."""
    rows = readings.filter((F.col("instrument") == instrument) & F.col("parameter").isin(minuend, subtrahend))
    mean = lambda p: F.avg(F.when(F.col("parameter") == p, F.col("value")))
    return rows.groupBy(*by, "instrument").agg((mean(minuend) - mean(subtrahend)).alias("value")).withColumn("parameter", F.lit(name)).filter("value is not null")


def calibrate(readings: DataFrame, cals: DataFrame, zeros: DataFrame, drive: list[str], carried: list[str], letters: str = "HCOKSNV", sensitivities: DataFrame | None = None) -> DataFrame:
    """Calibrated readings, with NO2 derived from calibrated NOx and NO, each (time, instrument, parameter) once.

    ``carried`` are columns of the moment (position, flags), which derived rows
    take from the first reading of their time.  ``sensitivities`` (instrument,
    time, ksens) stand in for parameters that have zeros but no slope.
    """
    run = [*drive, "instrument", "parameter"]
    stand = {} if sensitivities is None else {"stand_ins": sensitivities.withColumn("slope", F.col("ksens")), "lacking": without_slope(cals, zeros)}
    rows = with_zeros(intercept_units(bracket_runs(readings, cals, run, **stand)), zeros, letters=letters)
    rows = rows.withColumn("value", calibrated(F.col("value"), F.col("zero"), F.col("intercept"), F.col("slope"))).drop("slope", "intercept", "zero")
    moment = [*drive, "sample_time"]
    derived = derived_difference(rows, moment, "EcoPhysics_NOX", "NOx", "NO", "NO2")
    place = first_per(rows.filter("instrument = 'EcoPhysics_NOX'").select(*moment, *carried, "parameter"), moment, [F.col("parameter")]).drop("parameter")
    derived = derived.join(place, moment, "left")
    both = rows.withColumn("_k", F.lit(0)).unionByName(derived.withColumn("_k", F.lit(1)))
    return first_per(both, [*moment, "instrument", "parameter"], [F.col("_k"), F.col("value")]).drop("_k")


def long_zeros(zeros: DataFrame, letters: str = "HCOKSNV") -> DataFrame:
    """A wide table of zeros (date and ions) to rows of the ion instrument."""
    ions = [c for c in zeros.columns if c[:1] in letters and c not in ("V1",)]
    long = zeros.unpivot(["date"], ions, "parameter", "zero")
    return long.select(F.lit(ION_INSTRUMENT).alias("instrument"), "parameter", floor_second("date").alias("sample_time"), F.col("zero").cast("double").alias("zero"))
