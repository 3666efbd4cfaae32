"""Command line: build a star schema, show its reports, export its snapshots.

    python -m tillstar build SOURCE ROOT     run the whole chain, show answers and checks
    python -m tillstar report ROOT           show answers and checks of an earlier build
    python -m tillstar export ROOT OUT       write the seven CSV snapshots
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame

from tillstar.functions import clock
from tillstar.operators import quality
from tillstar.plans import jobs
from tillstar.session import session, sized_shuffles
from tillstar.sinks.warehouse import Warehouse


def _parse(args: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tillstar", description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)
    build = commands.add_parser("build", help="extracts to stored tables")
    build.add_argument("source", help="folder with the three CSV extracts")
    build.add_argument("root", help="folder for the tables")
    build.add_argument("--zone", default=clock.LONDON, help="zone of the event times")
    build.add_argument("--on-duplicate", choices=["raise", "report"], default="raise")
    build.add_argument("--on-bad-row", choices=["raise", "report"], default="raise")
    build.add_argument(
        "--split",
        nargs="*",
        choices=["customers", "products", "orders"],
        default=[],
        help="extracts without line breaks in fields, whose files many tasks may share",
    )
    report = commands.add_parser("report", help="answers and quality checks")
    report.add_argument("root")
    export = commands.add_parser("export", help="CSV snapshots")
    export.add_argument("root")
    export.add_argument("out", help="folder for the snapshots")
    publish = commands.add_parser("publish", help="CSV snapshots, seen all at once")
    publish.add_argument("root")
    publish.add_argument("out", help="folder for the publications")
    return parser.parse_args(args)


def _show(answers: dict[str, DataFrame], checks: DataFrame) -> None:
    """Print every row of each frame, tab-separated, a partition at a time. The partitions of a
    report are few, as adaptive execution merges small ones."""
    for name, df in (answers | {"dq_summary": checks}).items():
        print(name)
        print("\t".join(df.columns))
        for row in df.toLocalIterator():
            print("\t".join("" if value is None else str(value) for value in row))


def main(args: list[str] | None = None) -> None:
    options = _parse(args)
    spark = session()
    if options.command == "build":
        built = jobs.build(
            spark,
            options.source,
            options.root,
            options.zone,
            options.on_duplicate,
            options.on_bad_row,
            split=[f"raw.{name}_raw" for name in options.split],
        )
        _show(built.analysis | {"stage_losses": built.losses}, built.quality)
        return
    tables = jobs.stored_tables(Warehouse(spark, options.root))
    if options.command == "report":
        with sized_shuffles(spark, f"{options.root}/core"):
            _show(jobs.analysis(tables), quality.dq_summary(tables))
    elif options.command == "publish":
        print(jobs.publish_snapshots(spark, tables, options.out))
    else:
        print("\n".join(jobs.export_snapshots(spark, tables, options.out)))


if __name__ == "__main__":
    main()
