"""Sale transactions derived from order tables.

An order is a basket, its lines are the items and the part table is the product catalogue. ``sales``
is the flat table that reports read; ``feed`` is the raw event stream that would have produced it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.codec import encode
from ..functions.money import MONEY, tax_on, tax_share
from ..functions.times import PAYLOAD_FORMAT
from ..schema import CLEAN, PARTS, PAYMENT_METHODS, TRANSACTION
from ..session import written

# An event is one message: 5,000 items are about 0.6 MB of JSON, below the usual 1 MiB limit of a
# broker. Orders with more lines are sent in parts.
PART_LINES = 5_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str, salted: bool = False) -> DataFrame:
    """Order lines with their product. No broadcast is forced: the catalogue grows with the data, so
    Spark decides by size, and a hot product is split by the skew join. ``salt`` spreads the lines of an
    order, equal ones too: it is made from their place in the scan, which a retry does not change."""
    salt = [F.xxhash64(F.monotonically_increasing_id()).alias("salt")] if salted else []
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", F.floor("l_quantity").cast("int").alias("quantity"), *salt
    )
    parts = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.expr("concat('SKU-', lpad(cast(p_partkey AS string), greatest(5, length(cast(p_partkey AS string))), '0'))").alias("sku"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("unit_price"),
        (F.col("p_retailprice").cast("decimal(12,2)") * 100).cast("bigint").alias("unit_cents"),
    )
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))


def _sums(lines: DataFrame) -> DataFrame:
    """Per order: amounts in whole cents and counts. All of it is combined before the shuffle, so an
    order with any number of lines is one row per map task. Unused columns are pruned."""
    return lines.groupBy("l_orderkey").agg(
        F.sum(F.col("unit_cents") * F.col("quantity")).alias("cents"),
        F.count(F.lit(1)).alias("lines"),
        F.sum("quantity").alias("units"),
        F.min("sku").alias("first_sku"),
        F.max("sku").alias("last_sku"),
    )


def _subtotal() -> Column:
    return (F.coalesce("cents", F.lit(0)).cast("decimal(20,0)") * F.expr("0.01BD")).cast(MONEY)


def _moment() -> Column:
    """Order date plus a second of the day taken from the key, in milliseconds like the payload."""
    seconds = F.make_dt_interval(secs=F.col("o_orderkey") % 86_400)
    return F.date_trunc("millisecond", F.col("o_orderdate") + seconds)


def _header() -> dict[str, Column]:
    """What an event says about an order besides its lines."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    status = (
        F.when(F.col("o_orderstatus") == "O", "completed")
        .when(F.col("o_orderstatus") == "P", "refunded")
        .when(F.col("o_orderstatus") == "F", "failed")
    )
    register = F.expr("o_orderkey div 4") % 4 + 1
    return {
        "transaction_id": F.concat(F.lit("TXN-"), key.cast("string")),
        "store_id": F.concat(F.lit("STORE-00"), (customer % 3 + 1).cast("string")),
        "register_id": F.concat(F.lit("REG-0"), register.cast("string")),
        "payment_method": F.element_at(F.array(*map(F.lit, PAYMENT_METHODS)), (key % 4 + 1).cast("int")),
        "payment_status": status,
        "customer_id": F.when(key % 10 < 7, F.concat(F.lit("CUST-"), customer.cast("string"))),
    }


def _amounts(subtotal: Column, whole: Column | None = None) -> dict[str, Column]:
    """Amounts of a transaction; where it is not ``whole``, its share of them."""
    tax = tax_on(subtotal)
    if whole is not None:
        tax = F.when(whole, tax.cast("decimal(24,4)")).otherwise(tax_share(subtotal))
    return {
        "subtotal": subtotal.cast("double"),
        "tax": tax.cast("double"),
        "total": (subtotal + tax).cast("double"),
    }


def sales(
    spark: SparkSession, sf_dir: str, *extra: str, orders: DataFrame | None = None, few: bool = False
) -> DataFrame:
    """The flat transactions of every status, without a detour through JSON. ``extra`` keeps columns
    of the order or of its line sums; ``orders`` replaces the order table, e.g. by a part of it. With
    ``few``, other orders' lines are dropped before the shuffle: their keys are written down first, so
    that Spark sends them to all executors only if they are small."""
    lines = _lines(spark, sf_dir)
    if orders is None:
        orders = table(spark, sf_dir, "orders")
    elif few:
        orders = written(orders, "few-orders")
        keys = orders.select(F.col("o_orderkey").alias("few_key")).distinct()
        lines = lines.join(keys, F.col("l_orderkey") == F.col("few_key"), "left_semi")
    sums = _sums(lines)
    joined = orders.join(sums, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    columns = _header() | _amounts(_subtotal()) | {
        "transaction_timestamp": _moment().cast("timestamp"),
        "item_count": F.coalesce("lines", F.lit(0)).cast("int"),
    }
    return joined.select(*(columns[name].alias(name) for name in CLEAN.fieldNames()), *extra)


def _large(lines: DataFrame) -> DataFrame:
    """Key and number of parts of the orders with more than PART_LINES lines.

    One pass over one column, counted before the shuffle. It is written down, so that joins with it are
    planned by its size.
    """
    counted = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines")).filter(F.col("lines") > PART_LINES)
    parts = F.ceil(F.col("lines") / F.lit(PART_LINES / 2)).cast("int")  # half full, as lines are dealt by a hash
    return written(counted.select(F.col("l_orderkey").alias("large_key"), parts.alias("n_parts")), "large-orders")


def feed(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    """Raw events of the orders that satisfy ``where``: one for an order, or several for a large one."""
    orders = table(spark, sf_dir, "orders")
    orders = orders if where is None else orders.filter(where)
    return encode(_transactions(orders, _lines(spark, sf_dir, salted=True), _large(table(spark, sf_dir, "lineitem"))))


def _transactions(orders: DataFrame, lines: DataFrame, large: DataFrame) -> DataFrame:
    """Nested transactions, or parts of them; the items are sorted because line numbers are not unique.

    Lines are grouped by order and part, so no row or task gathers a large order. Lists do not get smaller
    when they are combined before a shuffle, so the lines are moved first.
    """
    item = F.struct("sku", "name", "category", "quantity", "unit_price")
    dealt = lines.join(large, F.col("l_orderkey") == F.col("large_key"), "left").withColumn(
        "l_part", F.coalesce(F.pmod("salt", "n_parts").cast("int"), F.lit(0))
    )
    baskets = dealt.repartition("l_orderkey", "l_part").groupBy("l_orderkey", "l_part").agg(
        F.sum(F.col("unit_cents") * F.col("quantity")).alias("cents"),
        F.array_sort(F.collect_list(item)).alias("basket"),
    )
    every = F.sequence(F.lit(0), F.coalesce("n_parts", F.lit(1)) - 1)
    sent = orders.join(large, F.col("o_orderkey") == F.col("large_key"), "left").withColumn("o_part", F.explode(every))
    joined = sent.join(baskets, (F.col("o_orderkey") == F.col("l_orderkey")) & (F.col("o_part") == F.col("l_part")), "left")
    columns = _header() | _amounts(_subtotal(), F.col("n_parts").isNull()) | {
        "timestamp": F.date_format(_moment(), PAYLOAD_FORMAT),
        "items": F.coalesce("basket", F.array().cast(TRANSACTION["items"].dataType)),
        "part": F.when(F.col("n_parts").isNotNull(), F.col("o_part")),
        "parts": F.col("n_parts"),
    }
    return joined.select(*(columns[name].alias(name) for name in (*TRANSACTION.fieldNames(), *PARTS.fieldNames())))
