"""Shapes the given star-schema tables into the nine feeds of the pipeline.

Each feed holds deterministic dirt (missing keys, repeated keys, unknown states,
unreadable numbers and dates, re-deliveries), so every rule has rows to act on.
All rows of the underlying tables are used; ``load_no`` tells deliveries apart
and stands in for the ingest time and the file name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINEAGE = ("_InsertTimeStamp", "_source_file")
ROWS_PER_TASK = 250_000  # of tables with short rows, millions of which fit into one split of a file


class Tables(dict):
    """The given tables by name, each opened once."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        super().__init__()
        self.spark, self.folder = spark, sf_dir.rstrip("/")

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self[name]

    def spread(self, name: str) -> DataFrame:
        """The table with its rows spread over tasks by number. Its feed is deduplicated, which
        sorts all rows of a task before the shuffle, and splits of a file follow bytes."""
        table = self[name]
        tasks = -(-table.count() // ROWS_PER_TASK)
        return table.repartition(tasks, *table.columns) if tasks > 1 else table


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _every(column: str, n: int) -> Column:
    return F.col(column) % n == 0


def _blank_every(column: str, n: int) -> Column:
    """The column as text, NULL for every n-th key."""
    return F.when(~_every(column, n), _text(column))


def _deliveries(df: DataFrame, wanted: dict[int, Column | None]) -> DataFrame:
    """Repeat rows for further deliveries, where the delivery's condition holds."""
    repeated = df.withColumn("load_no", F.explode(F.array(*[F.lit(n) for n in wanted])))
    keep = F.lit(False)
    for number, condition in wanted.items():
        here = F.col("load_no") == number
        keep = keep | (here if condition is None else here & condition)
    return repeated.where(keep)


def _with_lineage(df: DataFrame, days: Column, ts: str = LINEAGE[0]) -> DataFrame:
    """Ingest time = 2024-01-01 plus ``days``; file name = the delivery."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    ingested = start + F.make_dt_interval(days=days)
    file = F.concat(F.lit("load_"), _text("load_no"))
    return df.withColumns({ts: ingested, LINEAGE[1]: file}).drop("load_no")


def orders(tables: Tables) -> DataFrame:
    """Orders in silver form."""
    priority = F.col("o_orderpriority")
    status = (
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .when(priority == "1-URGENT", "approved")
        .when(priority == "2-HIGH", "invoiced")
        .when(priority == "3-MEDIUM", "processing")
        .when(priority == "5-LOW", "canceled")
        .otherwise("lost")
    )
    placed = F.col("o_orderdate").cast("timestamp")

    def after(days: Column) -> Column:
        return placed + F.make_dt_interval(days=days.cast("int"))

    key = F.col("o_orderkey")
    return tables["orders"].select(
        _text("o_orderkey").alias("order_id"),
        _text("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        placed.alias("order_purchase_ts"),
        after(key % 3).alias("order_approved_ts"),
        F.when(F.col("o_orderstatus") != "P", after(key % 7)).alias("order_delivered_carrier_ts"),
        F.when(F.col("o_orderstatus") == "F", after(3 + key % 40)).alias("order_delivered_customer_ts"),
        after(F.lit(30)).alias("order_estimated_delivery_ts"),
    )


def orders_raw(tables: Tables) -> DataFrame:
    """Orders as delivered: text timestamps, missing ids and times, and a newer
    copy of every tenth order."""
    number = F.col("order_id").cast("bigint")
    delivered = _deliveries(orders(tables), {1: None, 2: number % 10 == 0})
    raw = delivered.select(
        F.when(number % 97 != 0, F.col("order_id")).alias("order_id"),
        "customer_id",
        F.when(F.col("load_no") == 2, "delivered").otherwise(F.col("order_status")).alias("order_status"),
        F.when(number % 89 != 0, _text("order_purchase_ts")).alias("order_purchase_timestamp"),
        _text("order_approved_ts").alias("order_approved_at"),
        _text("order_delivered_carrier_ts").alias("order_delivered_carrier_date"),
        _text("order_delivered_customer_ts").alias("order_delivered_customer_date"),
        _text("order_estimated_delivery_ts").alias("order_estimated_delivery_date"),
        "load_no",
    )
    return _with_lineage(raw, F.col("load_no"))


def order_items(tables: Tables) -> DataFrame:
    """Order lines; the line number repeats within an order for about a quarter.
    Amounts have up to four decimals, some prices are less than a cent."""
    return tables["lineitem"].select(
        _text("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        _text("l_partkey").alias("product_id"),
        _text("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").cast("timestamp").alias("shipping_limit_date"),
        F.when(F.col("l_quantity") == 1, 0.0)
        .when(F.col("l_quantity") == 2, 0.004)
        .otherwise(F.col("l_extendedprice") + F.col("l_linenumber") * 0.0001)
        .alias("price"),
        (F.col("l_quantity") * 0.2525).alias("freight_value"),
    )


def order_items_raw(tables: Tables) -> DataFrame:
    """As text, with every line number of three pieces written with a zero in front."""
    number = F.col("order_item_id").cast("string")
    three = F.col("freight_value") == 3 * F.lit(0.2525)
    once = order_items(tables).withColumn("order_item_id", F.when(three, F.concat(F.lit("0"), number)).otherwise(number))
    once = once.withColumn("load_no", F.lit(1))
    return _with_lineage(once, F.lit(1), "_ingest_time")


def order_payments(tables: Tables) -> DataFrame:
    """Every order pays once, every fourth twice; one payment type is unknown."""
    paid = tables["orders"].withColumn(
        "payment_sequential", F.explode(F.array(F.lit(1), F.lit(2)))
    )
    kind = F.col("o_orderpriority")
    first = F.col("payment_sequential") == 1
    return paid.where(first | _every("o_orderkey", 4)).select(
        _text("o_orderkey").alias("order_id"),
        "payment_sequential",
        F.when(kind == "1-URGENT", "credit_card")
        .when(kind == "2-HIGH", "boleto")
        .when(kind == "3-MEDIUM", "voucher")
        .when(kind == "5-LOW", "debit_card")
        .otherwise("cheque")
        .alias("payment_type"),
        (1 + F.col("o_orderkey") % 12).cast("int").alias("payment_installments"),
        F.when(first, F.col("o_totalprice"))
        .otherwise((F.col("o_orderkey") % 500).cast("double") + 0.0025)
        .alias("payment_value"),
    )


def order_payments_raw(tables: Tables) -> DataFrame:
    """The first payment of every sixth order is delivered again."""
    again = (F.col("order_id").cast("bigint") % 6 == 0) & (F.col("payment_sequential") == 1)
    raw = _deliveries(order_payments(tables), {1: None, 2: again})
    return _with_lineage(raw, F.col("load_no"))


def _stamp(days: Column, time: str) -> Column:
    day = F.date_add(F.lit("2000-01-01").cast("date"), days.cast("int"))
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(f" {time}"))


def order_reviews_raw(tables: Tables) -> DataFrame:
    """Scores 0-6 as text, unreadable and missing dates, missing ids, repeated keys."""
    raw = _deliveries(tables["documents"], {1: None, 2: _every("doc_id", 29)}).select(
        _blank_every("doc_id", 53).alias("review_id"),
        (F.col("doc_id") * 3).cast("string").alias("order_id"),
        (F.col("doc_id") % 7).cast("string").alias("review_score"),
        F.col("lang").alias("review_comment_title"),
        F.col("text").alias("review_comment_message"),
        F.when(_every("doc_id", 11), "17/10/2000")
        .when(~_every("doc_id", 13), _stamp(F.col("doc_id") % 700, "08:30:00"))
        .alias("review_creation_date"),
        F.when(_every("doc_id", 17), "soon")
        .when(~_every("doc_id", 5), _stamp(F.col("doc_id") % 700 + F.col("doc_id") % 9, "09:00:00"))
        .alias("review_answer_timestamp"),
        "load_no",
    )
    return _with_lineage(raw, F.lit(1))


def _placed(tables: Tables, name: str, nation_key: str) -> DataFrame:
    nation = tables["nation"].select("n_nationkey", "n_name", "n_regionkey")
    region = tables["region"].select("r_regionkey", "r_name")
    people = tables.spread(name)
    return people.join(nation, people[nation_key] == nation["n_nationkey"]).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )


def customers_raw(tables: Tables) -> DataFrame:
    """Delivery 2 comes a month later for every third customer, with a changed
    city for every second of them; delivery 3 repeats every fifth customer at the
    time of delivery 1, with another city for every tenth."""
    key = "c_custkey"
    placed = _deliveries(
        _placed(tables, "customer", "c_nationkey"), {1: None, 2: _every(key, 3), 3: _every(key, 5)}
    )
    number = F.col("load_no")
    city = (
        F.when((number == 2) & _every(key, 2), F.lower("n_name"))
        .when((number == 3) & _every(key, 10), F.initcap("n_name"))
        .otherwise(F.col("n_name"))
    )
    raw = placed.select(
        _blank_every(key, 103).alias("customer_id"),
        F.when(~_every(key, 101), F.expr(f"{key} div 2").cast("string")).alias("customer_unique_id"),
        _text("c_nationkey").alias("customer_zip_code_prefix"),
        city.alias("customer_city"),
        F.col("r_name").alias("customer_state"),
        "load_no",
    )
    return _with_lineage(raw, F.when(number == 2, 31).otherwise(0))


def sellers_raw(tables: Tables) -> DataFrame:
    """Delivery 2 repeats every second seller a month later."""
    placed = _deliveries(
        _placed(tables, "supplier", "s_nationkey"), {1: None, 2: _every("s_suppkey", 2)}
    )
    raw = placed.select(
        _blank_every("s_suppkey", 37).alias("seller_id"),
        _text("s_nationkey").alias("seller_zip_code_prefix"),
        F.when(F.col("load_no") == 2, F.lower("n_name")).otherwise(F.col("n_name")).alias("seller_city"),
        F.col("r_name").alias("seller_state"),
        "load_no",
    )
    return _with_lineage(raw, F.when(F.col("load_no") == 2, 31).otherwise(0))


def geolocation_raw(tables: Tables) -> DataFrame:
    """One reading per customer, so places repeat; every fifth zip code has two
    coordinates; some readings lack a coordinate."""
    nation = F.col("n_nationkey")
    placed = _placed(tables, "customer", "c_nationkey").withColumn("load_no", F.lit(1))
    lat = nation + F.when(nation % 5 == 0, F.col("c_custkey") % 2).otherwise(0)
    raw = placed.select(
        _text("n_nationkey").alias("geolocation_zip_code_prefix"),
        F.when(~_every("c_custkey", 41), lat.cast("double")).cast("string").alias("geolocation_lat"),
        (-nation).cast("double").cast("string").alias("geolocation_lng"),
        F.lower("n_name").alias("geolocation_city"),
        F.col("r_name").alias("geolocation_state"),
        "load_no",
    )
    return _with_lineage(raw, F.lit(1))


def products_raw(tables: Tables) -> DataFrame:
    """Delivery 2 comes a month later for every fourth product with another
    weight; delivery 3 repeats every tenth product at the time of delivery 1 with yet
    another; every 13th has no category; every 89th has an unreadable number."""
    key = "p_partkey"
    parts = _deliveries(tables.spread("part"), {1: None, 2: _every(key, 4), 3: _every(key, 10)})
    size = F.col("p_size")
    weight = size * 100 + F.when(F.col("load_no") > 1, F.col("load_no") - 1).otherwise(0)
    photos = F.when(_every(key, 89), "n/a").otherwise((F.col(key) % 6).cast("string"))
    raw = parts.select(
        _text(key).alias("product_id"),
        F.when(~_every(key, 13), F.lower("p_type")).alias("product_category_name"),
        F.length("p_name").cast("string").alias("product_name_lenght"),
        (size * 10).cast("string").alias("product_description_lenght"),
        photos.alias("product_photos_qty"),
        weight.cast("string").alias("product_weight_g"),
        size.cast("string").alias("product_length_cm"),
        (size + 1).cast("string").alias("product_height_cm"),
        (size + 2).cast("string").alias("product_width_cm"),
        "load_no",
    )
    return _with_lineage(raw, F.when(F.col("load_no") == 2, 31).otherwise(0))


def category_translation_raw(tables: Tables) -> DataFrame:
    """One row per product, so names repeat; ``promo`` has no English form and the
    second delivery renames ``small``."""
    parts = _deliveries(tables.spread("part"), {1: None, 2: _every("p_partkey", 2)})
    name = F.lower("p_type")
    changed = (F.col("load_no") == 2) & (name == "small")
    raw = parts.select(
        name.alias("product_category_name"),
        F.when(changed, "en_little")
        .when(name != "promo", F.concat(F.lit("en_"), name))
        .alias("product_category_name_english"),
        "load_no",
    )
    return _with_lineage(raw, F.col("load_no"))


def changes(tables: Tables) -> DataFrame:
    """Change rows with distinct event times. Batch 2 starts at 2024-01-15; every
    third user stays in batch 1, so some keys are never touched by batch 2."""
    late = (F.col("ts") >= F.lit("2024-01-15 00:00:00").cast("timestamp")) & ~_every("user_id", 3)
    return tables["events"].select(
        "user_id",
        "event_type",
        F.col("ts").cast("timestamp").alias("changed_at"),
        F.when(late, 2).otherwise(1).alias("batch_no"),
    )
