"""Quality gate as a job: prints the record, or fails with the first rule that does not hold."""

from __future__ import annotations

from ..plans.quality import dq_report, gate
from . import options


def main(arguments: list[str] | None = None) -> dict:
    chosen = options.parser(__doc__).parse_args(arguments)
    spark = options.session("check", chosen)
    record = gate(dq_report(options.opened(spark, chosen).current())).first().asDict()
    print(record)
    return record


if __name__ == "__main__":
    main()
