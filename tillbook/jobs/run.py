"""Start ingest or find it running, wait until it has caught up, then judge the table.

Ends with the quality record, or fails with the first rule that does not hold. An ingest that runs in another
program is found by its signs of life in the journal; it is only waited for. With ``--keep`` an ingest that was
started here goes on afterwards.
"""

from __future__ import annotations

from contextlib import nullcontext

from ..plans.quality import dq_report, gate
from ..streaming.ingest import query_id, running_query
from ..streaming.journal import Journal
from ..streaming.waiting import settle, settle_elsewhere
from . import ingest, options


def main(arguments: list[str] | None = None) -> dict:
    known = ingest.parser(__doc__.splitlines()[0])
    known.add_argument("--timeout", type=float, default=600.0, help="seconds to wait")
    known.add_argument("--keep", action="store_true", help="leave an ingest that was started here running, and wait for its end")
    chosen = ingest.checked(known, known.parse_args(arguments))
    spark = options.session("run", chosen)
    journal = Journal(spark, chosen.journal) if chosen.journal else None
    source = {"location": chosen.location, "checkpoint": chosen.checkpoint} if chosen.source != "kafka" else {}

    known_id = query_id(spark, chosen.checkpoint)
    if journal and source and known_id and not running_query(spark, chosen.checkpoint) and journal.alive(known_id):
        print(f"found query {known_id} of another program")
        settle_elsewhere(spark, **source, timeout=chosen.timeout)
        return _judged(spark, chosen)
    with journal or nullcontext():
        running = running_query(spark, chosen.checkpoint)
        query = running or ingest.start(spark, chosen)
        print(f"{'found' if running else 'started'} query {query.id}")
        try:
            settle(query, chosen.timeout, **source)
            record = _judged(spark, chosen)
            if chosen.keep:
                query.awaitTermination()
            return record
        finally:
            if not running:
                query.stop()
                if journal:
                    journal.wait(query)


def _judged(spark, chosen) -> dict:
    record = gate(dq_report(ingest.stored(spark, chosen))).first().asDict()
    print(record)
    return record


if __name__ == "__main__":
    main()
