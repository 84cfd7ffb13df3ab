"""Build the label tables: ``python -m daymark SOURCE TARGET [options]``.

SOURCE is a patient-day table, TARGET a folder or a catalog schema for the six
label tables; either may be a path (with a slash) or a catalog name.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from daymark.functions import criteria
from daymark.plans.tables import LabelTables, build_label_tables


def arguments(args: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="daymark", description=__doc__)
    parser.add_argument("source")
    parser.add_argument("target")
    parser.add_argument("--unique-days", action="store_true", help="no day repeats in a stay")
    parser.add_argument("--buckets", type=int, help="bucket the merged table (catalog only)")
    parser.add_argument("--keep-last", action="store_true", help="keep an existing JAAM set")
    parser.add_argument("--white-cell-unit", type=float, default=1.0, help="cells per microlitre")
    parser.add_argument("--pt-control", type=float, default=criteria.PT_CONTROL_SECONDS)
    return parser.parse_args(args)


def main(args: list[str] | None = None) -> None:
    given = arguments(args)
    build_label_tables(
        SparkSession.builder.appName("daymark").getOrCreate(),
        given.source,
        LabelTables.under(given.target),
        isth=criteria.isth(pt_control=given.pt_control),
        jaam=criteria.jaam(white_cell_unit=given.white_cell_unit),
        buckets=given.buckets,
        last_mode="ignore" if given.keep_last else "overwrite",
        unique_days=given.unique_days,
    )


if __name__ == "__main__":
    main()
