"""The two recurring ledger jobs, each one run of a schedule.

    python -m edgeloom.plans.ledger_job count [--master MASTER]
    python -m edgeloom.plans.ledger_job sum [--master MASTER]
    python -m edgeloom.plans.ledger_job compact LOCATION [--master MASTER]

``count`` appends a 1 to the table ``counts``; ``sum`` appends the current total
to ``sums``, reading only what has landed since the last one (table ``marks``). Both create
the tables they use if absent. ``compact`` gathers the many small files of ``counts`` into
one at a new location.
"""

from __future__ import annotations

import argparse

from edgeloom.session import get_session
from edgeloom.sources import ledger

# --- Fixed values: table names. ---
COUNTS = "counts"
SUMS = "sums"
MARKS = "marks"
# ----------------------------------


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Append a count, or the total of all counts.")
    parser.add_argument("job", choices=["count", "sum", "compact"])
    parser.add_argument("location", nargs="?", help="new folder of the compacted table")
    parser.add_argument("--master")
    args = parser.parse_args(argv)
    spark = get_session(f"ledger {args.job}", master=args.master)
    ledger.create_counts(spark, COUNTS)
    if args.job == "count":
        ledger.append_count(spark, COUNTS)
    elif args.job == "compact":
        if not args.location:
            parser.error("compact needs a location")
        ledger.create_marks(spark, MARKS)
        ledger.compact(spark, COUNTS, args.location, marks=MARKS)
    else:
        ledger.create_sums(spark, SUMS)
        ledger.create_marks(spark, MARKS)
        ledger.append_total(spark, COUNTS, SUMS, MARKS)


if __name__ == "__main__":
    main()
