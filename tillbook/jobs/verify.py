"""Show what a table holds: counts, reports, snapshots, time travel, quality."""

from __future__ import annotations

from ..plans import quality, verification
from . import options


def main(arguments: list[str] | None = None) -> None:
    known = options.parser(__doc__)
    known.add_argument("--delete", action="store_true", help="also delete the refunded rows, for good")
    chosen = known.parse_args(arguments)
    spark = options.session("verify", chosen)
    for title, result in verification.sections(options.opened(spark, chosen), chosen.delete):
        print(f"\n-- {title}")
        if result is None:
            print("not run")
        else:
            result.show(truncate=False)
            for check, holds in _verdicts(title, result):
                print(f"{'PASS' if holds else 'FAIL'}: {check}")


def _verdicts(title: str, result) -> list[tuple[str, bool]]:
    """What a section says about the table: no refunded row after a delete, no row without an id or failed."""
    if title == "delete refunded":
        return [("no refunded rows are left", result.filter("checked = 'after'").first()["refunded"] == 0)]
    if title == "quality":
        found = result.first()
        return [(message, holds(found[rule])) for rule, holds, message in quality.RULES]
    return []


if __name__ == "__main__":
    main()
