"""Registry of queries, each with the SQL that gives the same rows on the same tables."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillbook.functions.codec import clean, parse, unpack  # noqa: E402
from tillbook.operators.layout import read_by_layout, write_by_layout  # noqa: E402
from tillbook.operators.parts import whole, whole_once  # noqa: E402
from tillbook.operators.versions import VersionedTable  # noqa: E402
from tillbook.plans import quality, reports, verification  # noqa: E402
from tillbook.schema import CLEAN, STORED  # noqa: E402
from tillbook.session import pin, size_shuffles, workspace  # noqa: E402
from tillbook.sources.events import raw_source  # noqa: E402
from tillbook.sources.retail import feed, sales, table  # noqa: E402
from tillbook.streaming.ingest import AVAILABLE_NOW, rejects_of, start_ingest, stored_events  # noqa: E402
from tillbook.streaming.journal import Journal  # noqa: E402

try:
    import corpus_pipeline  # noqa: E402
    from tillbook.llm import registry as llm  # noqa: E402
except ImportError:  # the folder is absent, or a library that its operators need
    llm = None

Query = Callable[[SparkSession, str], DataFrame]

_RANGE = (datetime(1996, 3, 10), datetime(1997, 6, 20))
_RANGE_STORES = ["STORE-001", "STORE-003"]
_RATE = {"seconds": 60, "low": 0.02, "high": 0.1}
_DELAY = "1 day"
_PARTS = 3


# Files per micro-batch of a backlog: bounds what a failed batch repeats, not what is read.
_BATCH_FILES = 10_000

# -- frames the queries start from -------------------------------------------------------------


def _ready(spark: SparkSession, sf_dir: str) -> SparkSession:
    return size_shuffles(pin(spark), sf_dir)


def _clean_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(sales(_ready(spark, sf_dir), sf_dir))


def _parsed(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Tables to JSON events and back to flat rows, or to some of their columns; parts are added up."""
    needed = ("transaction_id", *(name for name in columns if name != "transaction_id"), "part", "parts") if columns else None
    found = whole_once(parse(feed(_ready(spark, sf_dir), sf_dir), columns=needed))
    return found.select(*columns) if columns else found


def _naive(rows: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the SQL side has them."""
    return rows.withColumn("transaction_timestamp", F.col("transaction_timestamp").cast("timestamp_ntz"))


# -- events ------------------------------------------------------------------------------------


def parse_flatten(spark, sf_dir):
    return _naive(_parsed(spark, sf_dir))


def clean_filter(spark, sf_dir):
    return _naive(clean(_parsed(spark, sf_dir)))


def item_count(spark, sf_dir):
    return _parsed(spark, sf_dir, "transaction_id", "item_count")


def events_to_revenue(spark, sf_dir):
    return reports.revenue_by_store(clean(_parsed(spark, sf_dir, "store_id", "total", "payment_status")))


def basket_totals(spark, sf_dir):
    return quality.reconcile(unpack(feed(_ready(spark, sf_dir), sf_dir)))


def amount_mismatch(spark, sf_dir):
    """The same check on events of which some have a total that is a cent too high, or none."""
    events = unpack(feed(_ready(spark, sf_dir), sf_dir))
    key = F.substring_index("transaction_id", "-", -1).cast("bigint")
    wrong = F.when(key % 11 == 0, F.col("total") + 0.01).when(key % 13 != 0, F.col("total"))
    return quality.reconcile(events.withColumn("total", wrong))


def encode_payload(spark, sf_dir):
    skus = F.transform("items", lambda item: item["sku"])
    units = F.aggregate("items", F.lit(0).cast("bigint"), lambda n, item: n + item["quantity"])
    read = unpack(feed(_ready(spark, sf_dir), sf_dir)).select(
        "transaction_id", "store_id", "register_id",
        F.col("timestamp").cast("timestamp").alias("transaction_timestamp"),
        "subtotal", "tax", "total", "payment_method", "payment_status", "customer_id",
        F.size("items").alias("item_count"),
        units.alias("units"),
        F.array_min(skus).alias("first_sku"),
        F.array_max(skus).alias("last_sku"), "part", "parts",
    )
    return _naive(whole_once(read, {"units": F.sum("units"), "first_sku": F.min("first_sku"), "last_sku": F.max("last_sku")}))


# -- reports -----------------------------------------------------------------------------------


def row_count(spark, sf_dir):
    return reports.row_count(_clean_sales(spark, sf_dir))


def latest_transactions(spark, sf_dir):
    """Which ones are newest is decided by the orders alone; only their lines are then added up."""
    order = table(_ready(spark, sf_dir), sf_dir, "orders")
    ranked = clean(sales(spark, sf_dir, *order.columns))
    newest = reports.newest(ranked).select(*order.columns)
    return _naive(reports.latest(sales(spark, sf_dir, orders=newest, few=True)))


def revenue_by_store(spark, sf_dir):
    return reports.revenue_by_store(_clean_sales(spark, sf_dir))


def txn_by_payment_method(spark, sf_dir):
    return reports.by_payment_method(_clean_sales(spark, sf_dir))


def dq_report(spark, sf_dir):
    return quality.dq_report(_clean_sales(spark, sf_dir))


def dq_report_unfiltered(spark, sf_dir):
    return quality.dq_report(sales(_ready(spark, sf_dir), sf_dir))


def rate_check(spark, sf_dir):
    return reports.rate_check(table(_ready(spark, sf_dir), sf_dir, "events"), **_RATE)


def rate_stream(spark, sf_dir):
    """The same from a running stream: only windows that the watermark has closed, each counted once."""
    folder = workspace(_ready(spark, sf_dir), "rates")
    events = table(spark, sf_dir, "events").select("ts")
    events.write.parquet(f"{folder}/landing")
    arriving = spark.readStream.schema(events.schema).parquet(f"{folder}/landing")
    counts = reports.windowed_counts(arriving, seconds=_RATE["seconds"], delay=_DELAY)
    query = counts.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint")
    query.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    rates = reports.rates_of_counts(spark.read.schema(counts.schema).parquet(f"{folder}/out"), **_RATE)
    return rates.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


# -- streams -----------------------------------------------------------------------------------


def _land(raw: DataFrame, folder: str, kind: str = "files", place: str = "") -> None:
    """Put events down where a stream picks them up: one per line of text, or as a table of values."""
    target = f"{folder}/landing{place}"
    if kind == "files":
        raw.select(F.col("value").cast("string")).write.mode("append").text(target)
    else:
        raw.write.mode("append").parquet(target)


def _ingest(spark: SparkSession, folder: str, sink: str, target: str, *, kind: str = "files", consumer: str = "ingest", mode: str = "strict", **source):
    raw = raw_source(spark, kind, source.pop("location", f"{folder}/landing"), per_batch=_BATCH_FILES, **source)
    return start_ingest(raw, sink, target, f"{folder}/{consumer}.checkpoint", trigger=AVAILABLE_NOW, mode=mode, layout=("store",))


def _settled(folder: str, query, consumer: str = "ingest"):
    quality.settle(query, location=f"{folder}/landing", checkpoint=f"{folder}/{consumer}.checkpoint")
    query.awaitTermination()  # of what is available now; there is an end
    return query


def _table(spark: SparkSession, folder: str) -> VersionedTable:
    return VersionedTable(spark, f"{folder}/table", STORED, ("store",))


def ingest_stream_parquet(spark, sf_dir):
    folder = workspace(_ready(spark, sf_dir), "parquet")
    _land(feed(spark, sf_dir), folder)
    _settled(folder, _ingest(spark, folder, "parquet", f"{folder}/out"))
    return _naive(whole(stored_events(spark, f"{folder}/out")))


def ingest_stream_append(spark, sf_dir):
    folder = workspace(_ready(spark, sf_dir), "append")
    stored = _table(spark, folder)
    _land(feed(spark, sf_dir), folder)
    _settled(folder, _ingest(spark, folder, "versions", stored.root))
    return _naive(stored.current())


def restart_resume(spark, sf_dir):
    """Half of the events, a restart without new ones, the other half: every row once."""
    folder = workspace(_ready(spark, sf_dir), "restart")
    stored = _table(spark, folder)
    for half in (0, None, 1):
        if half is not None:
            _land(feed(spark, sf_dir, where=F.col("o_orderkey") % 2 == half), folder)
        _settled(folder, _ingest(spark, folder, "versions", stored.root))
    return _naive(stored.current())


def two_consumers(spark, sf_dir):
    """Two queries read the same events, each at its own pace and into its own sink."""
    folder = workspace(_ready(spark, sf_dir), "consumers")
    _land(feed(spark, sf_dir), folder, "table")
    stored = _table(spark, folder)
    queries = {
        "archive": _ingest(spark, folder, "parquet", f"{folder}/out", kind="table", consumer="archive"),
        "table": _ingest(spark, folder, "versions", stored.root, kind="table", consumer="table"),
    }
    for consumer, query in queries.items():
        _settled(folder, query, consumer)
    rows = {"archive": whole(stored_events(spark, f"{folder}/out")), "table": stored.current()}
    counted = [
        received.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(consumer).alias("consumer"), "rows")
        for consumer, received in rows.items()
    ]
    return counted[0].unionByName(counted[1])


def quality_gate(spark, sf_dir):
    """Ingest what is there, then judge the table; raises if a rule does not hold."""
    folder = workspace(_ready(spark, sf_dir), "gate")
    stored = _table(spark, folder)
    _land(feed(spark, sf_dir), folder, "table")
    return quality.gated_run(
        lambda: _ingest(spark, folder, "versions", stored.root, kind="table"), stored.current,
        location=f"{folder}/landing", checkpoint=f"{folder}/ingest.checkpoint",
    )


def dq_stream(spark, sf_dir):
    """Input rows and quality counts of each micro-batch, observed while it was written and kept over restarts."""
    folder = workspace(_ready(spark, sf_dir), "journal")
    with Journal(spark, f"{folder}/journal") as journal:
        for part in range(_PARTS):
            _land(feed(spark, sf_dir, where=F.col("o_orderkey") % _PARTS == part), folder)
            query = _settled(folder, _ingest(spark, folder, "parquet", f"{folder}/out"))
            journal.wait(query)
    return journal.rows().select("batch_id", "input_rows", "row_count", "null_transaction_ids", "failed_payments")


def quarantined_events(spark, sf_dir):
    """Some events are cut off or have an impossible time: those are set aside with a reason, the rest is kept."""
    folder = workspace(_ready(spark, sf_dir), "quarantine")
    text = F.col("value").cast("string")
    number = F.regexp_extract(text, "TXN-([0-9]+)", 1).cast("bigint")
    spoilt = F.when(number % 17 == 0, F.substring_index(text, ",", 5)).when(number % 19 == 0, F.regexp_replace(text, '"timestamp":"[0-9]+', '"timestamp":"soon')).otherwise(text)
    _land(feed(spark, sf_dir).select(spoilt.cast("binary").alias("value")), folder)
    _settled(folder, _ingest(spark, folder, "parquet", f"{folder}/out", mode="quarantine"))
    aside = spark.read.schema("reason string, value binary").option("recursiveFileLookup", "true").parquet(
        rejects_of("parquet", f"{folder}/out", f"{folder}/ingest.checkpoint")
    )
    number = F.regexp_extract(F.col("value").cast("string"), "TXN-([0-9]+)", 0)
    kept = whole(stored_events(spark, f"{folder}/out")).select("transaction_id", F.lit("kept").alias("outcome"))
    return kept.unionByName(aside.select(number.alias("transaction_id"), F.col("reason").alias("outcome")).distinct())


def start_latest(spark, sf_dir):
    """A query that starts at the latest event leaves out what was there before its first start."""
    folder = workspace(_ready(spark, sf_dir), "latest")
    source = {"start": "latest", "checkpoint": f"{folder}/ingest.checkpoint"}
    for half in (0, 1):
        _land(feed(spark, sf_dir, where=F.col("o_orderkey") % 2 == half), folder)
        _settled(folder, _ingest(spark, folder, "parquet", f"{folder}/out", **source))
    return _naive(whole(stored_events(spark, f"{folder}/out")))


def lost_file(spark, sf_dir):
    """Files that vanish between the plan of a batch and its reading are tolerated if that was asked for."""
    folder = workspace(_ready(spark, sf_dir), "lost")
    for half in (0, 1):
        _land(feed(spark, sf_dir, where=F.col("o_orderkey") % 2 == half), folder, place=f"/half={half}")

    def fail(batch: DataFrame, batch_id: int) -> None:
        raise RuntimeError("the sink is down")

    source = {"location": f"{folder}/landing/half=*", "tolerate_loss": True}
    raw = raw_source(spark, "files", per_batch=_BATCH_FILES, **source)
    planned = raw.writeStream.foreachBatch(fail).option("checkpointLocation", f"{folder}/ingest.checkpoint").trigger(availableNow=True).start()
    try:
        planned.awaitTermination()
    except StreamingQueryException:
        pass  # the batch is planned and not committed
    spark.createDataFrame([], "value string").write.mode("overwrite").text(f"{folder}/landing/half=1")
    _ingest(spark, folder, "parquet", f"{folder}/out", **source).awaitTermination()
    return _naive(whole(stored_events(spark, f"{folder}/out")))


# -- layouts -----------------------------------------------------------------------------------


def days_by_store(spark, sf_dir):
    """Written with a directory per day and store; a range of days is read without opening the others."""
    folder = workspace(_ready(spark, sf_dir), "days")
    write_by_layout(_clean_sales(spark, sf_dir), f"{folder}/t", ("day", "store"))
    found = read_by_layout(spark, f"{folder}/t", CLEAN, ("day", "store"), *_RANGE, _RANGE_STORES)
    day = F.to_date("transaction_timestamp").alias("day")
    return found.groupBy(day, F.col("store_id").alias("store")).agg(F.count(F.lit(1)).alias("rows"), reports.rounded_sum(F.col("total")).alias("total"))


# -- versioned table ---------------------------------------------------------------------------


def _stored(spark: SparkSession, sf_dir: str, parts: int, layout: tuple[str, ...] = ("store",)) -> tuple[VersionedTable, Callable[[int], int]]:
    """A new table, and a function that appends the part of the transactions with a given number."""
    stored = VersionedTable(_ready(spark, sf_dir), f"{workspace(spark, 'table')}/t", layout=layout)

    def append(part: int, to: VersionedTable = stored) -> int:
        orders = table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % parts == part)
        return to.append(clean(sales(spark, sf_dir, orders=orders)))

    return stored, append


def _brief(rows: DataFrame) -> DataFrame:
    return rows.select("transaction_id", "total", "payment_status")


def table_scan_current(spark, sf_dir):
    stored, append = _stored(spark, sf_dir, 2)
    append(0)
    append(1)
    return _brief(stored.current())


def time_travel_first(spark, sf_dir):
    stored, append = _stored(spark, sf_dir, 2)
    append(0)
    append(1)
    return _naive(reports.first_rows(stored.as_of(stored.first_snapshot())))


def delete_refunded(spark, sf_dir):
    """Refunded rows go, except those appended afterwards."""
    stored, append = _stored(spark, sf_dir, 2)
    append(0)
    stored.delete_where(verification.REFUNDED)
    append(1)
    return _brief(stored.current())


def delete_check(spark, sf_dir):
    stored, append = _stored(spark, sf_dir, 1)
    append(0)
    return verification.delete_check(stored)


def update_status(spark, sf_dir):
    stored, append = _stored(spark, sf_dir, 2)
    append(0)
    stored.update_where(
        "payment_status = 'refunded' AND payment_method = 'cash'", {"payment_status": "'voided'", "total": "subtotal - total"}
    )
    append(1)
    return _brief(stored.current())


def rewrite_current(spark, sf_dir):
    """The same rows after the pending DELETE has been folded into new files."""
    stored, append = _stored(spark, sf_dir, 2)
    append(0)
    stored.delete_where(verification.REFUNDED)
    append(1)
    stored.rewrite()
    return _brief(stored.current())


def snapshots(spark, sf_dir):
    stored, append = _stored(spark, sf_dir, 2)
    append(0)
    append(1)
    stored.delete_where(verification.REFUNDED)
    stored.update_where("payment_method = 'cash'", {"payment_method": "'coins'"})
    return stored.snapshots().drop("committed_at", "parent_id")


def partition_layout(spark, sf_dir):
    stored, append = _stored(spark, sf_dir, 1, ("month", "store"))
    append(0)
    return stored.partitions().drop("files")


def pruned_scan(spark, sf_dir):
    stored, append = _stored(spark, sf_dir, 1, ("month", "store"))
    append(0)
    return _naive(stored.scan_between(*_RANGE, stores=_RANGE_STORES)).select(
        "transaction_id", "store_id", "transaction_timestamp", "total"
    )


def many_updates(spark, sf_dir):
    """Ten updates of every row; each reads what is current and adds its rows, so the cost is that of ten."""
    stored, _ = _stored(spark, sf_dir, 1)
    stored.append(_clean_sales(spark, sf_dir))  # by parts of the keys, rows without one would be left out
    for _ in range(10):
        stored.update_where("true", {"item_count": "item_count + 1"})
    return stored.current().select("transaction_id", "item_count")


def layout_change(spark, sf_dir):
    """Rows written under two layouts are read as one table."""
    stored, append = _stored(spark, sf_dir, 2)
    append(0)
    append(1, stored.with_layout(()))
    return _brief(stored.current())


_QUERIES: list[Query] = [
    parse_flatten, clean_filter, item_count, events_to_revenue, basket_totals, amount_mismatch, encode_payload,
    row_count, latest_transactions, revenue_by_store, txn_by_payment_method, dq_report, dq_report_unfiltered,
    rate_check, rate_stream, ingest_stream_parquet, ingest_stream_append, restart_resume, two_consumers, quality_gate,
    dq_stream, quarantined_events, start_latest, lost_file, days_by_store,
    table_scan_current, time_travel_first, delete_refunded, delete_check, update_status, rewrite_current,
    snapshots, partition_layout, pruned_scan, layout_change, many_updates,
]


def entry(spark: SparkSession) -> DataFrame:
    """From order tables through JSON events to revenue per store."""
    return events_to_revenue(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    own = {query.__name__: query for query in _QUERIES}
    return own if llm is None else own | llm.queries() | {"pipeline": corpus_pipeline.run}


# -- the same in SQL ---------------------------------------------------------------------------

_SALES = """
WITH lines AS (
    SELECT l_orderkey, CAST(floor(l_quantity) AS INTEGER) AS quantity,
           'SKU-' || lpad(CAST(p_partkey AS VARCHAR), greatest(5, length(CAST(p_partkey AS VARCHAR)))::INTEGER, '0') AS sku,
           CAST(p_retailprice AS DECIMAL(12,2)) AS price
    FROM lineitem JOIN part ON l_partkey = p_partkey
), baskets AS (
    SELECT l_orderkey, CAST(sum(quantity * price) AS DECIMAL(18,2)) AS amount, count(*) AS n,
           CAST(sum(quantity) AS BIGINT) AS units, min(sku) AS first_sku, max(sku) AS last_sku
    FROM lines GROUP BY l_orderkey
), amounts AS (
    SELECT o.*, n, units, first_sku, last_sku,
           coalesce(amount, CAST(0 AS DECIMAL(18,2))) AS sub,
           CAST(round(coalesce(amount, CAST(0 AS DECIMAL(18,2))) * CAST(0.07 AS DECIMAL(3,2)), 2) AS DECIMAL(18,2)) AS levy
    FROM orders o LEFT JOIN baskets ON o_orderkey = l_orderkey
), parsed AS (
    SELECT o_orderkey,
           'TXN-' || o_orderkey AS transaction_id,
           'STORE-00' || (o_custkey % 3 + 1) AS store_id,
           'REG-0' || (o_orderkey // 4 % 4 + 1) AS register_id,
           date_trunc('millisecond', o_orderdate + to_seconds(o_orderkey % 86400)) AS transaction_timestamp,
           CAST(sub AS DOUBLE) AS subtotal, CAST(levy AS DOUBLE) AS tax, CAST(sub + levy AS DOUBLE) AS total,
           ['credit_card', 'debit_card', 'cash', 'mobile_pay'][o_orderkey % 4 + 1] AS payment_method,
           CASE o_orderstatus WHEN 'O' THEN 'completed' WHEN 'P' THEN 'refunded' WHEN 'F' THEN 'failed' END AS payment_status,
           CASE WHEN o_orderkey % 10 < 7 THEN 'CUST-' || o_custkey END AS customer_id,
           CAST(coalesce(n, 0) AS INTEGER) AS item_count,
           coalesce(units, 0) AS units, first_sku, last_sku
    FROM amounts
), clean AS (
    SELECT * FROM parsed WHERE payment_status IN ('completed', 'refunded')
)
"""

_FLAT = """transaction_id, store_id, register_id, transaction_timestamp, subtotal, tax, total,
           payment_method, payment_status, customer_id, item_count"""

_REVENUE = """SELECT store_id, count(*) AS transactions,
    CAST(round(sum(CAST(total AS DECIMAL(38,4))), 2) AS DOUBLE) AS total_revenue,
    count(*) FILTER (total IS NOT NULL AND (isnan(total) OR abs(total) >= 1e11)) AS not_added FROM clean GROUP BY store_id"""

_DQ = """SELECT count(*) AS row_count, count(*) FILTER (transaction_id IS NULL) AS null_transaction_ids,
    count(*) FILTER (payment_status = 'failed') AS failed_payments FROM """

_BASKETS = """SELECT transaction_id, subtotal, tax, total,
    CAST(total * 100 AS DECIMAL(20,0)) = CAST(subtotal * 100 AS DECIMAL(20,0)) + CAST(tax * 100 AS DECIMAL(20,0)) AND {0} AS consistent FROM parsed"""

_DELETED = """SELECT transaction_id, total, payment_status FROM clean
    WHERE NOT (payment_status = 'refunded' AND o_orderkey % 2 = 0)"""


def oracle_sql() -> dict[str, str]:
    if llm is None:
        return _own_sql()
    more = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return _own_sql() | llm.oracle_sql() | more


def _own_sql() -> dict[str, str]:
    clean_rows = _SALES + f"SELECT {_FLAT} FROM clean"
    brief = _SALES + "SELECT transaction_id, total, payment_status FROM clean"
    return {
        "parse_flatten": _SALES + f"SELECT {_FLAT} FROM parsed",
        "clean_filter": clean_rows,
        "item_count": _SALES + "SELECT transaction_id, item_count FROM parsed",
        "events_to_revenue": _SALES + _REVENUE,
        "basket_totals": _SALES + _BASKETS.format("true"),
        "amount_mismatch": _SALES + _BASKETS.format("(o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0)"),
        "encode_payload": _SALES + f"SELECT {_FLAT}, units, first_sku, last_sku FROM parsed",
        "row_count": _SALES + "SELECT count(*) AS total_rows FROM clean",
        "latest_transactions": _SALES + """SELECT transaction_id, store_id, total, payment_status, transaction_timestamp
            FROM clean ORDER BY transaction_timestamp DESC NULLS LAST, transaction_id, store_id, payment_status, total LIMIT 5""",
        "revenue_by_store": _SALES + _REVENUE,
        "txn_by_payment_method": _SALES + "SELECT payment_method, count(*) AS cnt FROM clean GROUP BY payment_method",
        "dq_report": _SALES + _DQ + "clean",
        "dq_report_unfiltered": _SALES + _DQ + "parsed",
        "rate_check": f"""WITH counted AS (
                SELECT time_bucket(INTERVAL '{_RATE["seconds"]} seconds', ts) AS w, count(*) AS n FROM events GROUP BY ALL
            ), windows AS (
                SELECT unnest(generate_series(min(w), max(w), INTERVAL '{_RATE["seconds"]} seconds')) AS w FROM counted
            ), filled AS (
                SELECT windows.w AS window_start, coalesce(n, 0) AS events FROM windows LEFT JOIN counted ON counted.w = windows.w
            )
            SELECT window_start, events, events / {_RATE["seconds"]}.0::DOUBLE AS per_second,
            events / {_RATE["seconds"]}.0::DOUBLE BETWEEN {_RATE["low"]}::DOUBLE AND {_RATE["high"]}::DOUBLE AS in_range
            FROM filled""",
        "rate_stream": f"""WITH counted AS (
                SELECT time_bucket(INTERVAL '{_RATE["seconds"]} seconds', ts) AS w, count(*) AS n FROM events GROUP BY ALL
            ), closed AS (
                SELECT * FROM counted WHERE w + INTERVAL '{_RATE["seconds"]} seconds' <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL {_DELAY}
            ), windows AS (
                SELECT unnest(generate_series(min(w), max(w), INTERVAL '{_RATE["seconds"]} seconds')) AS w FROM closed
            ), filled AS (
                SELECT windows.w AS window_start, coalesce(n, 0) AS events FROM windows LEFT JOIN closed ON closed.w = windows.w
            )
            SELECT window_start, events, events / {_RATE["seconds"]}.0::DOUBLE AS per_second,
            events / {_RATE["seconds"]}.0::DOUBLE BETWEEN {_RATE["low"]}::DOUBLE AND {_RATE["high"]}::DOUBLE AS in_range
            FROM filled""",
        "dq_stream": _SALES + f"""SELECT o_orderkey % {_PARTS} AS batch_id, count(*) AS input_rows,
            count(*) FILTER (payment_status IN ('completed', 'refunded')) AS row_count,
            0::BIGINT AS null_transaction_ids, 0::BIGINT AS failed_payments FROM parsed GROUP BY 1""",
        "quarantined_events": _SALES + """SELECT transaction_id, CASE WHEN o_orderkey % 17 = 0 THEN 'malformed'
                WHEN o_orderkey % 19 = 0 THEN 'timestamp' ELSE 'kept' END AS outcome FROM parsed
            WHERE outcome <> 'kept' OR payment_status IN ('completed', 'refunded')""",
        "start_latest": _SALES + f"SELECT {_FLAT} FROM clean WHERE o_orderkey % 2 = 1",
        "lost_file": _SALES + f"SELECT {_FLAT} FROM clean WHERE o_orderkey % 2 = 0",
        "days_by_store": _SALES + f"""SELECT CAST(transaction_timestamp AS DATE) AS day, store_id AS store, count(*) AS rows,
                CAST(round(sum(CAST(total AS DECIMAL(38,4))), 2) AS DOUBLE) AS total FROM clean
            WHERE transaction_timestamp >= TIMESTAMP '{_RANGE[0]}' AND transaction_timestamp < TIMESTAMP '{_RANGE[1]}'
            AND store_id IN ('STORE-001', 'STORE-003') GROUP BY ALL""",
        "many_updates": _SALES + "SELECT transaction_id, CAST(item_count + 10 AS INTEGER) AS item_count FROM clean",
        "ingest_stream_parquet": clean_rows,
        "ingest_stream_append": clean_rows,
        "restart_resume": clean_rows,
        "two_consumers": _SALES + """SELECT consumer, count(*) AS rows FROM clean,
            (VALUES ('archive'), ('table')) AS c(consumer) GROUP BY consumer""",
        "quality_gate": _SALES + _DQ + "clean",
        "table_scan_current": brief,
        "time_travel_first": _SALES + """SELECT transaction_id, total, transaction_timestamp FROM clean
            WHERE o_orderkey % 2 = 0 ORDER BY transaction_id, transaction_timestamp, total LIMIT 5""",
        "delete_refunded": _SALES + _DELETED,
        "delete_check": _SALES + """SELECT 'before' AS checked, count(*) FILTER (payment_status = 'refunded') AS refunded FROM clean
            UNION ALL SELECT 'after', 0""",
        "update_status": _SALES + """SELECT transaction_id,
            CASE WHEN hit THEN subtotal - total ELSE total END AS total,
            CASE WHEN hit THEN 'voided' ELSE payment_status END AS payment_status
            FROM (SELECT *, payment_status = 'refunded' AND payment_method = 'cash' AND o_orderkey % 2 = 0 AS hit FROM clean)""",
        "rewrite_current": _SALES + _DELETED,
        "snapshots": _SALES + """, n AS (
                SELECT count(*) FILTER (o_orderkey % 2 = 0) AS a, count(*) FILTER (o_orderkey % 2 = 1) AS b,
                       count(*) FILTER (payment_status = 'refunded') AS d,
                       count(*) FILTER (payment_status = 'completed' AND payment_method = 'cash') AS u FROM clean)
            SELECT 1::BIGINT AS snapshot_id, 'append' AS operation, a AS added_records, 0::BIGINT AS deleted_records, a AS total_records FROM n
            UNION ALL SELECT 2, 'append', b, 0, a + b FROM n
            UNION ALL SELECT 3, 'delete', 0, d, a + b - d FROM n
            UNION ALL SELECT 4, 'update', u, u, a + b - d FROM n""",
        "partition_layout": _SALES + """SELECT CAST(date_trunc('month', transaction_timestamp) AS DATE) AS month,
            store_id AS store, count(*) AS rows FROM clean GROUP BY ALL""",
        "pruned_scan": _SALES + f"""SELECT transaction_id, store_id, transaction_timestamp, total FROM clean
            WHERE transaction_timestamp >= TIMESTAMP '{_RANGE[0]}' AND transaction_timestamp < TIMESTAMP '{_RANGE[1]}'
            AND store_id IN ('STORE-001', 'STORE-003')""",
        "layout_change": brief,
    }
