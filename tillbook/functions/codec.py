"""Raw JSON events to flat transactions and back. Every function takes a batch or a streaming frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schema import ITEM, ITEM_PRESENCE, KEPT_STATUSES, PARTS, STORED, TRANSACTION, transaction
from .money import as_money

_CORRUPT = "_corrupt_record"
MODES = ("strict", "quarantine")

# Flat columns made from a payload field of another name.
_SOURCE = {"transaction_timestamp": "timestamp", "item_count": "items"}


def encode(transactions: DataFrame) -> DataFrame:
    """Nested transactions to raw events: one ``value BINARY`` column of UTF-8 JSON, NULLs written out.

    Only parts of a transaction say so; rows without a ``part`` column or with a NULL in it are whole.
    """
    written = {"ignoreNullFields": "false"}
    text = F.to_json(F.struct(*TRANSACTION.fieldNames()), written)
    if "part" in transactions.columns:
        marked = F.to_json(F.struct(*TRANSACTION.fieldNames(), *PARTS.fieldNames()), written)
        text = F.when(F.col("part").isNull(), text).otherwise(marked)
    return transactions.select(text.cast("binary").alias("value"))


def unpack(
    raw: DataFrame,
    item: StructType = ITEM,
    keep: tuple[str, ...] = (),
    corrupt: bool = False,
    fields: tuple[str, ...] | None = None,
) -> DataFrame:
    """One row per event with the payload's fields as columns; all NULL when the text is no object.

    ``inline`` over a one-element array instead of ``select("d.*")``: a later filter cannot be pushed
    below it, so the text of a kept row is parsed once and not once more for the filter. Columns are not
    pruned through it either; ``fields`` names the ones to parse.
    """
    schema = StructType([*transaction(item).fields, *PARTS.fields])
    if fields is not None:
        schema = StructType([field for field in schema if field.name in fields])
    options = {}
    if corrupt:
        schema = StructType([*schema.fields, StructField(_CORRUPT, StringType(), True)])
        options = {"columnNameOfCorruptRecord": _CORRUPT}
    parsed = F.from_json(F.col("value").cast("string"), schema, options)
    return raw.select(*keep, F.inline(F.array(parsed)))


def parse(raw: DataFrame, mode: str = "strict", columns: tuple[str, ...] | None = None) -> DataFrame:
    """Raw events to the flat columns of ``STORED``, or some of them, before the status filter.

    ``strict`` casts the timestamp, so a malformed one on a kept row fails the job. ``quarantine``
    leaves such rows out here; ``rejects`` returns them.
    """
    columns = tuple(STORED.fieldNames()) if columns is None else columns
    if mode == "strict":
        events = unpack(raw, ITEM_PRESENCE, fields=tuple(_SOURCE.get(name, name) for name in columns))
        derived = {"transaction_timestamp": F.col("timestamp").cast("timestamp"), "item_count": F.size("items")}
        return events.select(*(derived.get(name, F.col(name)).alias(name) for name in columns))
    if mode == "quarantine":
        return sound(judged(raw)).select(*columns)
    raise ValueError(f"mode must be one of {MODES}, not {mode!r}")


def judged(raw: DataFrame) -> DataFrame:
    """Flat columns, the original ``value`` and ``reason``: NULL, or why the event is set aside.

    The corrupt-record column catches malformed text and wrongly typed fields but not a timestamp
    string that is no timestamp; that one needs its own test.
    """
    events = unpack(raw, keep=("value",), corrupt=True)
    flat = events.withColumns(
        {"transaction_timestamp": F.col("timestamp").try_cast("timestamp"), "item_count": F.size("items")}
    )
    bad_amount = F.lit(False)
    for name in ("subtotal", "tax", "total"):
        bad_amount = bad_amount | (F.col(name).isNotNull() & as_money(F.col(name)).isNull())
    reason = (
        F.when(F.col("value").isNull() | (F.length("value") == 0), "empty")
        .when(F.col(_CORRUPT).isNotNull(), "malformed")
        .when(F.col("timestamp").isNotNull() & F.col("transaction_timestamp").isNull(), "timestamp")
        .when(bad_amount, "amount")
    )
    return flat.withColumn("reason", reason).select(*STORED.fieldNames(), "value", "reason")


def sound(events: DataFrame) -> DataFrame:
    """The flat columns of the events that ``judged`` found nothing wrong with."""
    return events.filter(F.col("reason").isNull()).select(*STORED.fieldNames())


def rejects(events: DataFrame) -> DataFrame:
    """``reason, value`` of the events set aside by ``judged``."""
    return events.filter(F.col("reason").isNotNull()).select("reason", "value")


def clean(parsed: DataFrame) -> DataFrame:
    """Rows with an accepted payment status. Failed, unknown and NULL ones are dropped."""
    return parsed.filter(F.col("payment_status").isin(*KEPT_STATUSES))
