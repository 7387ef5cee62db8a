"""Command line: python -m lacunar.plans.cli -c run.yml [-p params.yml]."""

from __future__ import annotations

import argparse
import sys


def main(args: list[str] | None = None) -> int:
    from lacunar import config

    parser = argparse.ArgumentParser(description="Fill gaps of a gridded time series.")
    parser.add_argument("-c", "--config", required=True, help="YAML of a run, or SAMPLE to write sample_run.yml")
    parser.add_argument("-p", "--params", help="YAML of parameters, or SAMPLE to write sample_params.yml")
    parser.add_argument("--height", type=int, help="rows of the grid; else those of the mask")
    parser.add_argument("--width", type=int)
    got = parser.parse_args(args)
    samples = [(got.config, "sample_run.yml", ("paths", "limits", "job")), (got.params, "sample_params.yml", ("despeckle", "a1", "a2"))]
    wanted = [(name, parts) for given, name, parts in samples if given == "SAMPLE"]
    for name, parts in wanted:
        with open(name, "w", encoding="utf-8") as f:
            f.write(config.sample(parts))
    if wanted:
        return 1
    from pyspark.sql import SparkSession

    from lacunar.plans.pipeline import run

    run(SparkSession.builder.appName("lacunar").getOrCreate(), config.load(got.config, *([got.params] if got.params else [])), got.height, got.width)
    return 0


if __name__ == "__main__":
    sys.exit(main())
