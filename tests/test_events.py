"""What happens to odd payloads: one case per line of the contract."""

import json
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillbook.functions.codec import clean, encode, judged, parse, rejects, sound, unpack
from tillbook.schema import ITEM, ITEM_PRESENCE, PARTS, STORED, TRANSACTION
from tillbook.operators.parts import whole, whole_once
from tillbook.session import pin

BASE = {
    "transaction_id": "t", "store_id": "STORE-001", "register_id": "REG-03", "timestamp": "2026-04-09T14:32:01.123Z",
    "items": [{"sku": "SKU-10042", "name": "Milk", "category": "Dairy", "quantity": 2, "unit_price": 4.99}],
    "subtotal": 9.98, "tax": 0.70, "total": 10.68,
    "payment_method": "credit_card", "payment_status": "completed", "customer_id": None,
}


def payload(**changes):
    record = {**BASE, **changes}
    return json.dumps({k: v for k, v in record.items() if v != "-absent-"})


def with_item(**changes):
    return payload(items=[{**BASE["items"][0], **changes}])


def raw(spark, *texts):
    return spark.createDataFrame(
        [(t.encode() if isinstance(t, str) else t,) for t in texts], "value binary"
    )


def kept(spark, text):
    rows = clean(parse(raw(pin(spark), text))).collect()
    assert len(rows) <= 1
    return rows[0] if rows else None


DROPPED = {
    "null": None,
    "empty": "",
    "not json": "not json",
    "scalar": "5",
    "truncated": payload()[:-1],
    "array": f"[{payload()}]",
    "wrong case": payload(payment_status="Completed"),
    "failed": payload(payment_status="failed"),
    "status null": payload(payment_status=None),
    "status missing": payload(payment_status="-absent-"),
    "status number": payload(payment_status=1),
    "failed and bad time": payload(payment_status="failed", timestamp="junk"),
}


@pytest.mark.parametrize("case", DROPPED)
def test_dropped(spark, case):
    assert kept(spark, DROPPED[case]) is None


KEPT = {
    "as it should be": (payload(), {"total": 10.68, "item_count": 1, "customer_id": None}),
    "refunded": (payload(payment_status="refunded"), {"payment_status": "refunded"}),
    "extra field": (payload(zzz=1), {"transaction_id": "t"}),
    "text amount": (payload(total="10.68"), {"total": None, "tax": 0.70}),
    "whole amount": (payload(total=10), {"total": 10.0}),
    "fractional quantity": (with_item(quantity=2.5), {"item_count": 1, "total": 10.68}),
    "large quantity": (with_item(quantity=99999999999), {"item_count": 1}),
    "items null": (payload(items=None), {"item_count": None}),
    "items missing": (payload(items="-absent-"), {"item_count": None}),
    "items object": (payload(items={}), {"item_count": None}),
    "items empty": (payload(items=[]), {"item_count": 0}),
    "number as id": (payload(transaction_id=5), {"transaction_id": "5"}),
    "id missing": (payload(transaction_id="-absent-"), {"transaction_id": None}),
    "id twice": (payload()[:-1] + ', "transaction_id": "u"}', {"transaction_id": "u"}),
    "status twice": (payload(payment_status="failed")[:-1] + ', "payment_status": "completed"}', {"payment_status": "completed"}),
    "two objects": (payload() + payload(transaction_id="u"), {"transaction_id": "t"}),
    "trailing text": (payload() + " junk", {"transaction_id": "t"}),
    "offset": (payload(timestamp="2026-04-09T14:32:01.123+02:00"), {"transaction_timestamp": datetime(2026, 4, 9, 12, 32, 1, 123000)}),
    "date only": (payload(timestamp="2026-04-09"), {"transaction_timestamp": datetime(2026, 4, 9)}),
    "time null": (payload(timestamp=None), {"transaction_timestamp": None}),
}


@pytest.mark.parametrize("case", KEPT)
def test_kept(spark, case):
    text, expected = KEPT[case]
    row = kept(spark, text).asDict()
    if "transaction_timestamp" in expected and row["transaction_timestamp"] is not None:
        row["transaction_timestamp"] = clean(parse(raw(spark, text))).select(
            F.col("transaction_timestamp").cast("timestamp_ntz")
        ).first()[0]
    assert {k: row[k] for k in expected} == expected


def test_nan_amount_is_kept(spark):
    row = kept(spark, payload().replace("10.68", "NaN"))
    assert row["total"] != row["total"]


@pytest.mark.parametrize("time", ["junk", "", "1700000000"])
def test_bad_time_fails_or_is_set_aside(spark, time):
    events = raw(pin(spark), payload(), payload(transaction_id="bad", timestamp=time))
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        clean(parse(events)).collect()
    assert [r["transaction_id"] for r in clean(parse(events, mode="quarantine")).collect()] == ["t"]
    assert [r["reason"] for r in rejects(judged(events)).collect()] == ["timestamp"]


def test_quarantine_splits_without_loss(spark):
    texts = [*DROPPED.values(), *(text for text, _ in KEPT.values()), payload().replace("10.68", "NaN"), payload(total=1e300)]
    events = judged(raw(pin(spark), *texts))
    reasons = {r["reason"] for r in rejects(events).collect()}
    assert reasons == {"empty", "malformed", "timestamp", "amount"}
    assert rejects(events).count() + sound(events).count() == len(texts)
    assert sound(events).columns == STORED.fieldNames()


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        parse(raw(spark, payload()), mode="loose")


def test_schema_of_clean_rows(spark):
    assert [(f.name, f.dataType) for f in clean(parse(raw(spark, payload()))).schema] == [(f.name, f.dataType) for f in STORED]


def test_encode_then_unpack_is_identity(spark):
    events = unpack(raw(spark, payload(), payload(items=[], customer_id="CUST-1")))
    again = unpack(encode(events))
    assert again.collect() == events.collect()
    assert again.columns == TRANSACTION.fieldNames() + PARTS.fieldNames()
    assert '"customer_id":null' in encode(events).first()["value"].decode()


_SCALAR = st.none() | st.booleans() | st.integers(-10**12, 10**12) | st.floats(allow_nan=True) | st.text(max_size=4)
_ELEMENT = st.dictionaries(st.sampled_from(ITEM.fieldNames() + ["other"]), _SCALAR | st.lists(_SCALAR, max_size=2), max_size=6)
_ITEMS = st.lists(_ELEMENT | _SCALAR | st.lists(_SCALAR, max_size=2), max_size=4) | _ELEMENT | _SCALAR


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_ITEMS, min_size=20, max_size=60))
def test_counting_items_needs_no_full_parse(spark, many):
    """The short item schema gives the same row as the full one, whatever is in the items."""
    events = raw(spark, *(payload(items=items) for items in many))
    count = F.size("items").alias("n")
    brief, full = (
        unpack(events, item).select(count, *(n for n in TRANSACTION.fieldNames() if n not in ("items", "total")),
                                    F.col("total").cast("string")).collect()
        for item in (ITEM_PRESENCE, ITEM)
    )
    assert brief == full


@pytest.mark.parametrize("columns", [("store_id", "total", "payment_status"), ("item_count",), ("transaction_id", "tax", "payment_status")])
def test_parsing_some_columns_gives_the_same_values(spark, columns):
    texts = [*DROPPED.values(), *(text for text, _ in KEPT.values()), payload(total=1e300), payload(tax=[1], items=[5])]
    events = raw(pin(spark), *texts)
    assert parse(events, columns=columns).collect() == parse(events).select(*columns).collect()


def test_text_of_a_kept_row_is_parsed_once(spark):
    plan = clean(parse(raw(spark, payload())))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_only_parts_of_a_transaction_say_so(spark):
    events = unpack(raw(spark, payload(), payload(transaction_id="p", part=1, parts=3)))
    written = [r["value"].decode() for r in encode(events).collect()]
    assert sorted('"part":1,"parts":3' in text for text in written) == [False, True]
    assert sum('"part' in text for text in written) == 1
    assert unpack(encode(events)).collect() == events.collect()


def test_a_part_number_that_is_none_makes_a_whole_event(spark):
    rows = parse(raw(spark, payload(part="x"), payload(part=5, parts=3), payload(part=-1, parts=3), payload(part=0, parts=0), payload(part=0)))
    assert whole(rows).count() == whole_once(rows).count() == 5
