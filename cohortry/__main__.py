"""Run the study on a survey extract: ``spark-submit ... -m cohortry CSV OUT_DIR``."""

from __future__ import annotations

import argparse

from cohortry.plans.study import run_survey
from cohortry.session import get_spark


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="cohortry", description=__doc__)
    parser.add_argument("csv", help="survey extract, CSV with a header")
    parser.add_argument("out_dir", help="folder for tables and reports")
    parser.add_argument("--labels", help="code labels, CSV (default: built in)")
    parser.add_argument("--bands", help="BMI bands, CSV (default: built in)")
    parser.add_argument("--master", help="Spark master, when not given by spark-submit")
    args = parser.parse_args(argv)
    paths = run_survey(get_spark(args.master), args.csv, args.out_dir, args.labels, args.bands)
    for name, path in paths.items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
