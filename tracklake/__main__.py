"""``python -m tracklake 2025-07-15 [2025-07-20] --config config.yaml``: run stages for a date or a range."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from tracklake.plans.config import Stage, load
from tracklake.plans.pipeline import Pipeline, days
from tracklake.sources.readers import parse_day


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tracklake", description=__doc__)
    parser.add_argument("dates", nargs="+", help="a date, or the first and the last of a range (YYYY-MM-DD)")
    parser.add_argument("--config", "-c", required=True)
    parser.add_argument("--stages", "-s", nargs="+", choices=[s.value for s in Stage], default=["all"])
    parser.add_argument("--skip-existing", action="store_true")
    parser.add_argument("--stop-on-error", action="store_true")
    parser.add_argument("--together", action="store_true", help="all dates in one plan for each stage")
    parser.add_argument("--quiet", "-q", action="store_true")
    given = parser.parse_args(args)
    dates = [parse_day(d) for d in given.dates]
    if len(dates) == 2:
        dates = days(*dates)
    stages = [Stage(s) for s in given.stages]
    paths, config = load(Path(given.config).read_text(encoding="utf-8"))
    spark = SparkSession.builder.appName("tracklake").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    pipeline = Pipeline(spark, paths, config, skip_existing=given.skip_existing)
    if problems := pipeline.validate(stages):
        print("\n".join(problems), file=sys.stderr)
        return 1
    good = pipeline.run_together(dates, stages) if given.together else pipeline.run_batch(dates, stages, given.stop_on_error)
    if config.verbose and not given.quiet:
        pipeline.summary().show(len(dates), truncate=False)
        for day, stage, status, detail in pipeline.results:
            if status == "ERROR":
                print(f"{day} {stage}: {detail}", file=sys.stderr)
    return 0 if good else 1


if __name__ == "__main__":
    sys.exit(main())
