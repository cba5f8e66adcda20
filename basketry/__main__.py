"""Build everything from CSV files: ``python -m basketry RAW_FOLDER OUTPUT CUTOFF``."""

import argparse
import logging

from basketry.plans.build import run
from basketry.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="basketry", description=__doc__)
    parser.add_argument("raw_folder", help="folder with one CSV file per input table")
    parser.add_argument("output", help="folder for the wide sales table, by year")
    parser.add_argument("cutoff", help="first day without known sales, as YYYY-MM-DD")
    parser.add_argument("--master", help="Spark master; by default the one of the cluster")
    parser.add_argument(
        "--shuffled-bytes", type=int, help="size of the largest shuffle, about that of the sales"
    )
    chosen = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = build_session("basketry", chosen.master, chosen.shuffled_bytes)
    for row in run(spark, chosen.raw_folder, chosen.output, chosen.cutoff).toLocalIterator():
        logging.info("exported %s rows for %s", row["rows"], row["year"])
    spark.stop()


if __name__ == "__main__":
    main()
