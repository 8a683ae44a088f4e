"""Schemas and fixed values of the sale-transaction data model."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TEXT, _INT, _REAL = StringType(), IntegerType(), DoubleType()


def _row(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


ITEM = _row(sku=_TEXT, name=_TEXT, category=_TEXT, quantity=_INT, unit_price=_REAL)

# A string field accepts any JSON value, so an element read with this schema is NULL, present or
# malformed exactly when it is with ITEM: enough to count items, and cheaper to parse.
ITEM_PRESENCE = _row(sku=_TEXT)


def transaction(item: StructType = ITEM) -> StructType:
    """Schema of one JSON payload, with the given item element type."""
    return _row(
        transaction_id=_TEXT,
        store_id=_TEXT,
        register_id=_TEXT,
        timestamp=_TEXT,
        items=ArrayType(item),
        subtotal=_REAL,
        tax=_REAL,
        total=_REAL,
        payment_method=_TEXT,
        payment_status=_TEXT,
        customer_id=_TEXT,
    )


TRANSACTION = transaction()

# An order too large for one message is sent as several events: ``part`` counts from 0 to ``parts`` - 1.
# Other events have neither field.
PARTS = _row(part=_INT, parts=_INT)

CLEAN = _row(
    transaction_id=_TEXT,
    store_id=_TEXT,
    register_id=_TEXT,
    transaction_timestamp=TimestampType(),
    subtotal=_REAL,
    tax=_REAL,
    total=_REAL,
    payment_method=_TEXT,
    payment_status=_TEXT,
    customer_id=_TEXT,
    item_count=_INT,
)

# What is stored of an event.
STORED = StructType([*CLEAN.fields, *PARTS.fields])

# Names, order and types of ITEM, transaction and CLEAN above; here topic name, payment methods, statuses and tax rate of the payload contract.
TOPIC = "raw_pos_transactions"
PAYMENT_METHODS = ("credit_card", "debit_card", "cash", "mobile_pay")
KEPT_STATUSES = ("completed", "refunded")
FAILED_STATUS = "failed"
TAX_RATE = "0.07"
