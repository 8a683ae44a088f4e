"""The programs, run in the test session."""

import shutil

import pytest

from test_events import payload
from test_streams import arrive, ids, one
from tillbook.jobs import check, ingest, run, verify
from tillbook.operators.versions import VersionedTable
from tillbook.plans.quality import DataQualityError
from tillbook.streaming.ingest import stored_events
from tillbook.schema import STORED
from tillbook.streaming import waiting
from tillbook.streaming.ingest import query_id
from tillbook.streaming.journal import Journal


@pytest.fixture
def arguments(folder):
    return ["--warehouse", folder]


def ingested(folder, arguments, *more):
    source = ["--source", "files", "--location", f"{folder}/landing", "--checkpoint", f"{folder}/cp"]
    ingest.main([*arguments, *source, "--trigger", "availableNow", *more])


def test_ingest_verify_check(spark, folder, arguments, capsys):
    arrive(folder, "a", one(1), one(2, payment_status="refunded"))
    ingested(folder, arguments)
    ingested(folder, arguments)
    assert ids(VersionedTable(spark, f"{folder}/db/pos_transactions", STORED).current()) == ["t1", "t2"]
    verify.main([*arguments, "--delete"])
    shown = capsys.readouterr().out
    assert "-- first snapshot\nnot run" in shown and "-- delete refunded" in shown
    assert check.main(arguments) == {"row_count": 1, "null_transaction_ids": 0, "failed_payments": 0}


def test_parquet_from_the_environment(spark, folder, arguments, monkeypatch):
    monkeypatch.setenv("WRITE_MODE", "parquet")
    arrive(folder, "a", one(1))
    ingested(folder, arguments)
    assert ids(stored_events(spark, f"{folder}/db/pos_transactions.parquet")) == ["t1"]


def test_unknown_sink_stops_the_program(spark, folder, arguments, monkeypatch):
    monkeypatch.setenv("WRITE_MODE", "csv")
    with pytest.raises(SystemExit) as stopped:
        ingested(folder, arguments)
    assert stopped.value.code != 0


def test_check_fails_on_an_empty_table(spark, folder, arguments):
    arrive(folder, "a", one(1, payment_status="failed"))
    ingested(folder, arguments)
    with pytest.raises(DataQualityError) as failed:
        check.main(arguments)
    assert failed.value.rule == "row_count"


@pytest.fixture
def run_arguments(folder, arguments):
    source = ["--source", "files", "--location", f"{folder}/landing", "--checkpoint", f"{folder}/cp"]
    return [*arguments, *source, "--journal", f"{folder}/journal", "--trigger", "1 second"]


@pytest.mark.parametrize("sink", ["versions", "parquet"])
def test_run_starts_waits_judges_and_stops(spark, folder, run_arguments, capsys, sink):
    arrive(folder, "a", one(1), one(2, payment_status="failed"))
    good = {"row_count": 1, "null_transaction_ids": 0, "failed_payments": 0}
    assert run.main([*run_arguments, "--sink", sink]) == good
    assert "started query" in capsys.readouterr().out and not spark.streams.active
    arrive(folder, "b", payload(transaction_id=None))
    shutil.move(f"{folder}/journal/alive", f"{folder}/earlier")  # the first run gave its last sign long ago
    with pytest.raises(DataQualityError):
        run.main([*run_arguments, "--sink", sink])
    assert not spark.streams.active
    rows = Journal(spark, f"{folder}/journal").rows()
    assert sorted((r["batch_id"], r["input_rows"]) for r in rows.collect()) == [(0, 2), (1, 1)]


def test_run_finds_an_ingest_of_this_program(spark, folder, run_arguments, capsys):
    arrive(folder, "a", one(1))
    chosen = ingest.parser("").parse_args(run_arguments)
    query = ingest.start(spark, chosen)
    try:
        assert run.main(run_arguments)["row_count"] == 1
        assert f"found query {query.id}" in capsys.readouterr().out and query.isActive
    finally:
        query.stop()


def test_run_finds_an_ingest_of_another_program(spark, folder, run_arguments, capsys):
    """It gives signs of life and has done its work; nothing is started here."""
    arrive(folder, "a", one(1))
    run.main(run_arguments)
    capsys.readouterr()
    journal, known = Journal(spark, f"{folder}/journal"), query_id(spark, f"{folder}/cp")
    assert journal.alive(known) and not journal.alive(known, within=0.0) and not journal.alive("someone")
    assert run.main(run_arguments)["row_count"] == 1
    assert "of another program" in capsys.readouterr().out and not spark.streams.active
    arrive(folder, "b", one(2))
    assert [path.rsplit("/", 1)[1] for path in waiting.files_behind(spark, f"{folder}/landing", f"{folder}/cp")] == ["b"]
    with pytest.raises(TimeoutError):
        run.main([*run_arguments, "--timeout", "0.5"])
