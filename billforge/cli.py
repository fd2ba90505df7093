"""Commands over a folder of tables: ``python -m billforge.cli NAME FOLDER [--out PATH] [--explain]``, or ``list``.

A name is that of a query, or one of the short commands below.
"""

from __future__ import annotations

import argparse

from billforge.plans import catalogue
from billforge.session import get_spark, ship

COMMANDS = {
    "import": "change_classification", "import-report": "import_counters", "update-computed": "bill_computed_fields", "session-report": "session_vote_report", "text-status": "text_status",
    "text-missing": "missing_text", "people-lint": "lint_person", "people-summarize": "person_summary", "people-duplicates": "duplicate_values", "people-retire": "retire_person",
    "committees-plan": "merge_plan", "committees-merge": "committee_merge", "relationships": "related_bill_resolve", "validate-bills": "validate_bill", "validate-votes": "validate_vote_event",
    "validate-events": "validate_event", "history": "p1_found", "orphans": "p2_report", "snapshot-changes": "p3_found", "normalise-times": "p4_found"}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("name")
    p.add_argument("folder", nargs="?")
    p.add_argument("--out", help="write parquet here instead of showing rows")
    p.add_argument("--rows", type=int, default=20)
    p.add_argument("--explain", action="store_true")
    a = p.parse_args(argv)
    queries = catalogue.queries()
    if a.name == "list":
        print("\n".join([*(f"{k} ({v})" for k, v in COMMANDS.items()), *queries]))
        return 0
    name = COMMANDS.get(a.name, a.name)
    if name not in queries or not a.folder:
        p.error("no such command, or no folder")
    spark = get_spark("*")
    ship(spark)
    df = queries[name](spark, a.folder)
    if a.explain:
        df.explain("formatted")
    elif a.out:
        df.write.mode("overwrite").parquet(a.out)
    else:
        df.show(a.rows, False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
