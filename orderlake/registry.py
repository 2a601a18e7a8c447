"""Every operator and pipeline as a query over the given tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame. Hash keys are
shown as the natural key they stand for, looked up in the dimension again, so
that another engine without this hash can be compared.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import cached_property, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from orderlake import feeds, session
from orderlake.feeds import Tables
from orderlake.functions.keys import record_hash
from orderlake.operators import dedup, quality, scd
from orderlake.operators.joins import resolve_keys_in_place
from orderlake.plans import business, dashboards, gold, warehouse
from orderlake.plans.silver import (
    category_translation,
    geolocation,
    order_items,
    order_payments,
    order_reviews,
    orders,
    people,
    products,
)
from orderlake.schemas import FEEDS as FEED_SCHEMAS
from orderlake.streaming import bronze, silver, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SLICE = "day"


def query(make: Query) -> Query:
    """Register under the function's name. Timestamps leave without a time zone,
    as they are stored in the given tables."""

    @wraps(make)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = make(session.prepare(spark), sf_dir)
        return df.withColumns(
            {
                f.name: F.col(f.name).cast("timestamp_ntz")
                for f in df.schema.fields
                if isinstance(f.dataType, TimestampType)
            }
        )

    QUERIES[make.__name__] = run
    return run


@dataclass(frozen=True)
class Lake:
    """Silver tables and dimensions as frames over the given tables."""

    spark: SparkSession
    sf_dir: str

    @cached_property
    def tables(self) -> Tables:
        return Tables(self.spark, self.sf_dir)

    def feed(self, name: str) -> DataFrame:
        return getattr(feeds, name)(self.tables)

    @cached_property
    def orders(self) -> DataFrame:
        return self.feed("orders")

    @cached_property
    def items(self) -> DataFrame:
        return self.feed("order_items")

    @cached_property
    def payments(self) -> DataFrame:
        return self.feed("order_payments")

    @cached_property
    def reviews(self) -> DataFrame:
        return order_reviews.transform(self.feed("order_reviews_raw")).valid

    @cached_property
    def customers(self) -> DataFrame:
        return people.transform(self.feed("customers_raw"), people.CUSTOMERS).valid

    @cached_property
    def sellers(self) -> DataFrame:
        return people.transform(self.feed("sellers_raw"), people.SELLERS).valid

    @cached_property
    def products(self) -> DataFrame:
        return products.transform(self.feed("products_raw")).valid

    @cached_property
    def translation(self) -> DataFrame:
        return category_translation.transform(self.feed("category_translation_raw")).valid

    @cached_property
    def geolocation(self) -> DataFrame:
        return geolocation.transform(self.feed("geolocation_raw")).valid

    @cached_property
    def dim_geolocation(self) -> DataFrame:
        return gold.dim_geolocation(self.geolocation)

    def dim_customer(self, one_per_place: bool = False) -> DataFrame:
        return gold.dim_customer(self.customers, self.dim_geolocation, one_per_place)

    def dim_seller(self, one_per_place: bool = False) -> DataFrame:
        return gold.dim_seller(self.sellers, self.dim_geolocation, one_per_place)

    @cached_property
    def dim_product(self) -> DataFrame:
        return gold.dim_product(self.products, self.translation)

    def fact_orders(self, one_per_place: bool = False) -> DataFrame:
        return gold.fact_orders(self.orders, self.dim_customer(one_per_place))

    def fact_order_items(self, one_per_place: bool = False) -> DataFrame:
        return gold.fact_order_items(
            self.items,
            self.fact_orders(one_per_place),
            self.dim_product,
            self.dim_seller(one_per_place),
        )


def _naturals(fact: DataFrame, dimensions: dict[str, DataFrame], buckets: int) -> DataFrame:
    """The natural key for the surrogate of each dimension; ``fact`` is stored by order. The frame
    is planned when it is read, so the setting stays; ``prepare`` takes it back for the next query."""
    lookups = [(df.select(f"{name}_key", f"{name}_id").distinct(), f"{name}_key", None) for name, df in dimensions.items()]
    keyed = resolve_keys_in_place(fact, lookups, "order_id", buckets)
    for name, value in session.IN_PLACE.items():
        fact.sparkSession.conf.set(name, value)
    return keyed.drop(*[f"{name}_key" for name in dimensions])


def _coordinates(dimension: DataFrame, places: DataFrame) -> DataFrame:
    known = places.select("geolocation_key", "geolocation_lat", "geolocation_lng")
    return dimension.join(known, "geolocation_key", "left").drop("geolocation_key")


def _delivery() -> Column:
    return F.substring_index("_source_file", "_", -1).cast("int").alias("load_no")


def _errors() -> Column:
    return quality.failed_names(quality.ERRORS).alias("errors")


def _warnings() -> Column:
    return quality.failed_names(quality.WARNINGS).alias("warnings")


# --- quality gates ---------------------------------------------------------


@query
def dq_orders_split(spark, sf_dir):
    checked = quality.apply(feeds.orders_raw(Tables(spark, sf_dir)), orders.SOURCE_RULES)
    return checked.select(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        _delivery(),
        _errors(),
        _warnings(),
    )


@query
def dq_orders_target(spark, sf_dir):
    valid = orders.transform(feeds.orders_raw(Tables(spark, sf_dir))).valid
    return valid.select(
        "order_id", "order_status", "order_approved_ts", "order_delivered_carrier_ts", _warnings()
    )


@query
def dq_items_split(spark, sf_dir):
    checked = quality.apply(feeds.order_items_raw(Tables(spark, sf_dir)), order_items.SOURCE_RULES)
    return checked.select("order_id", "order_item_id", "product_id", "seller_id", "price", _errors())


@query
def dq_payments_split(spark, sf_dir):
    result = order_payments.transform(feeds.order_payments_raw(Tables(spark, sf_dir)))
    columns = ["order_id", "payment_sequential", "payment_type"]
    return result.valid.select(*columns, _errors()).unionByName(
        result.target_invalid.select(*columns, _errors())
    )


@query
def reject_duplicates(spark, sf_dir):
    items = feeds.order_items(Tables(spark, sf_dir))
    _, repeated = dedup.reject_duplicates(items, ["order_id", "order_item_id"])
    return repeated.groupBy("order_id", "order_item_id").agg(
        F.count(F.lit(1)).alias("rows_of_key"), business.exact_sum(F.col("price")).alias("price")
    )


@query
def duplicate_keys(spark, sf_dir):
    return dedup.duplicate_keys(feeds.order_items(Tables(spark, sf_dir)), ["order_id", "order_item_id"])


@query
def reviews_valid(spark, sf_dir):
    return Lake(spark, sf_dir).reviews.drop("_source_file", "_InsertTimeStamp")


@query
def reviews_quarantine(spark, sf_dir):
    refused = order_reviews.transform(feeds.order_reviews_raw(Tables(spark, sf_dir))).source_invalid
    return refused.drop("_source_file", "_InsertTimeStamp")


@query
def customers_quarantine(spark, sf_dir):
    refused = people.transform(feeds.customers_raw(Tables(spark, sf_dir)), people.CUSTOMERS).source_invalid
    return refused.select(
        "customer_id", "customer_unique_id", "customer_city", _delivery(), _errors(), _warnings()
    )


@query
def products_quarantine(spark, sf_dir):
    refused = products.transform(feeds.products_raw(Tables(spark, sf_dir))).source_invalid
    return refused.select("product_id", "product_photos_qty", "product_weight_g", _errors(), _warnings())


@query
def payments_quarantine(spark, sf_dir):
    result = order_payments.transform(feeds.order_payments_raw(Tables(spark, sf_dir)))
    refused = result.source_invalid.unionByName(result.target_invalid, allowMissingColumns=True)
    return refused.select("order_id", "payment_sequential", "payment_type", "payment_value", _errors())


# --- deduplication ---------------------------------------------------------


@query
def items_latest(spark, sf_dir):
    items = feeds.order_items(Tables(spark, sf_dir))
    return dedup.latest(items, ["order_id", "order_item_id"], "shipping_limit_date")


@query
def geo_exact_dedup(spark, sf_dir):
    readings = feeds.geolocation_raw(Tables(spark, sf_dir))
    places = dedup.exact(readings, geolocation.COLUMNS, "_InsertTimeStamp").select(geolocation.COLUMNS)
    return places.withColumns({c: F.col(c).try_cast("double") for c in geolocation.TYPES})


@query
def customers_hash_dedup(spark, sf_dir):
    attributes = list(people.CUSTOMERS.attributes)
    raw = feeds.customers_raw(Tables(spark, sf_dir))
    distinct = dedup.by_hash(raw, "customer_id", attributes, "_InsertTimeStamp", null_skipping=True)
    return distinct.select(
        "customer_id",
        F.col("_InsertTimeStamp").alias("ingested"),
        record_hash(*attributes, null_skipping=True).alias("record_hash"),
    )


@query
def translation_dedup(spark, sf_dir):
    named = feeds.category_translation_raw(Tables(spark, sf_dir)).where(
        F.col("product_category_name_english").isNotNull()
    )
    latest = dedup.latest(named, [category_translation.KEY], "_InsertTimeStamp")
    return latest.select("product_category_name", "product_category_name_english")


# --- silver ----------------------------------------------------------------


@query
def silver_orders(spark, sf_dir):
    valid = orders.transform(feeds.orders_raw(Tables(spark, sf_dir))).valid
    return valid.drop("_source_file", "_InsertTimeStamp", quality.ERRORS, quality.WARNINGS)


@query
def silver_items(spark, sf_dir):
    valid = order_items.transform(feeds.order_items_raw(Tables(spark, sf_dir))).valid
    return valid.drop("_source_file", "_ingest_time", quality.ERRORS, quality.WARNINGS)


@query
def silver_payments(spark, sf_dir):
    valid = order_payments.transform(feeds.order_payments_raw(Tables(spark, sf_dir))).valid
    return valid.drop("_source_file", "_InsertTimeStamp", quality.ERRORS, quality.WARNINGS)


@query
def silver_geolocation(spark, sf_dir):
    return Lake(spark, sf_dir).geolocation.drop("_InsertTimeStamp")


@query
def silver_translation(spark, sf_dir):
    return Lake(spark, sf_dir).translation.drop("_InsertTimeStamp")


@query
def silver_customers(spark, sf_dir):
    return Lake(spark, sf_dir).customers


@query
def silver_sellers(spark, sf_dir):
    return Lake(spark, sf_dir).sellers


@query
def silver_products(spark, sf_dir):
    return Lake(spark, sf_dir).products.drop("_InsertTimeStamp")


@query
def silver_customers_collapsed(spark, sf_dir):
    raw = feeds.customers_raw(Tables(spark, sf_dir))
    return people.transform(raw, people.CUSTOMERS, keep_ties=False).valid


@query
def silver_items_quarantine(spark, sf_dir):
    result = order_items.transform(feeds.order_items_raw(Tables(spark, sf_dir)))
    columns = ["order_id", F.col("order_item_id").cast("string").alias("order_item_id"), "product_id", "seller_id", _errors()]
    source, target = result.source_invalid, result.target_invalid
    return source.select(*columns, F.lit("source").alias("gate")).unionByName(target.select(*columns, F.lit("target").alias("gate")))


@query
def silver_customers_keep_ties(spark, sf_dir):
    raw = feeds.customers_raw(Tables(spark, sf_dir))
    return people.transform(raw, people.CUSTOMERS, keep_ties=True).valid


@query
def silver_products_open_ended(spark, sf_dir):
    raw = feeds.products_raw(Tables(spark, sf_dir))
    return products.transform(raw, open_ended=True).valid.drop("_InsertTimeStamp", scd.TO)


# --- slowly changing dimensions -------------------------------------------


def _versions(changes: DataFrame) -> DataFrame:
    return scd.versions(changes, "user_id", "changed_at", ["event_type"], slice_by=SLICE)


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = feeds.changes(Tables(spark, sf_dir))
    first, second = (changes.where(F.col("batch_no") == n) for n in (1, 2))
    return scd.apply(_versions(first), _versions(second), "user_id")


@query
def scd2_versions(spark, sf_dir):
    return _versions(feeds.changes(Tables(spark, sf_dir)))


@query
def scd2_merge(spark, sf_dir):
    return _merged(spark, sf_dir)


@query
def scd2_active(spark, sf_dir):
    return scd.active(_merged(spark, sf_dir)).select("user_id", "event_type", scd.FROM)


@query
def scd2_open_ended(spark, sf_dir):
    changes = dedup.by_hash(feeds.changes(Tables(spark, sf_dir)), "user_id", ["event_type"], "changed_at")
    dated = scd.versions(changes, "user_id", "changed_at", ["event_type"], open_ended=True)
    return dated.drop(scd.TO)


@query
def scd2_changes_only(spark, sf_dir):
    changes = feeds.changes(Tables(spark, sf_dir))
    return scd.replay(changes, "user_id", "changed_at", ["event_type"], "batch_no", slice_by=SLICE, changed_only=True)


@query
def scd2_changes_merged(spark, sf_dir):
    """As ``scd2_changes_only``, with batch 2 merged into the stored result of batch 1."""
    stage = Stage(spark)
    changes = feeds.changes(Tables(spark, sf_dir))
    first, second = (_versions(changes.where(F.col("batch_no") == n)) for n in (1, 2))
    attributes = ["event_type"]
    sinks.write_table(scd.drop_unchanged(first.limit(0), first, "user_id", attributes, SLICE), stage.table("history"))
    target = spark.table(stage.table("history"))
    incoming = scd.drop_unchanged(scd.active(target), second, "user_id", attributes, SLICE)
    return scd.apply(target, incoming, "user_id")


@query
def scd2_rebuild(spark, sf_dir):
    """Batch 1 arrives after batch 2: its versions are late in the stored history."""
    stage = Stage(spark)
    late_first = feeds.changes(Tables(spark, sf_dir)).withColumn("arrival", -F.col("batch_no"))
    broken = scd.replay(late_first, "user_id", "changed_at", ["event_type"], "arrival", ["event_type"], SLICE)
    sinks.write_table(broken, stage.table("history"))
    touched = late_first.where("batch_no = 2")
    return scd.rebuild(spark.table(stage.table("history")), "user_id", touched, SLICE)


@query
def scd1_upsert(spark, sf_dir):
    changes = feeds.changes(Tables(spark, sf_dir))
    target, source = (
        dedup.latest(changes.where(F.col("batch_no") == n), ["user_id"], "changed_at") for n in (1, 2)
    )
    return scd.upsert(target, source, "user_id").drop("batch_no")


@query
def merge_general(spark, sf_dir):
    changes = feeds.changes(Tables(spark, sf_dir))

    def state(batch_no: int) -> DataFrame:
        return (
            changes.where(F.col("batch_no") == batch_no)
            .groupBy("user_id")
            .agg(
                F.max_by("event_type", "changed_at").alias("event_type"),
                F.max("changed_at").alias("changed_at"),
                F.count(F.lit(1)).alias("changes"),
            )
        )

    source = {c: F.col(f"source.{c}") for c in ("user_id", "event_type", "changed_at", "changes")}
    return scd.merge(
        state(1),
        state(2),
        ["user_id"],
        update={
            "event_type": source["event_type"],
            "changed_at": source["changed_at"],
            "changes": F.col("changes") + source["changes"],
        },
        insert={
            "user_id": source["user_id"],
            "event_type": source["event_type"],
            "changed_at": source["changed_at"],
            "changes": F.lit(0),
        },
        insert_when=source["event_type"] != "view",
        match_when=F.col("event_type") != "error",
    )


# --- gold ------------------------------------------------------------------


@query
def dim_date(spark, sf_dir):
    return gold.dim_date(feeds.orders(Tables(spark, sf_dir)))


@query
def dim_geolocation(spark, sf_dir):
    return Lake(spark, sf_dir).dim_geolocation.drop("geolocation_key")


@query
def dim_customer(spark, sf_dir):
    lake = Lake(spark, sf_dir)
    return _coordinates(lake.dim_customer(), lake.dim_geolocation).drop("customer_key")


@query
def dim_seller(spark, sf_dir):
    lake = Lake(spark, sf_dir)
    return _coordinates(lake.dim_seller(), lake.dim_geolocation).drop("seller_key")


@query
def dim_customer_one_per_place(spark, sf_dir):
    one = Lake(spark, sf_dir).dim_customer(one_per_place=True)
    placed = F.col("geolocation_key").isNotNull()
    return one.withColumn("has_place", placed).drop("customer_key", "geolocation_key")


@query
def dim_seller_one_per_place(spark, sf_dir):
    one = Lake(spark, sf_dir).dim_seller(one_per_place=True)
    placed = F.col("geolocation_key").isNotNull()
    return one.withColumn("has_place", placed).drop("seller_key", "geolocation_key")


@query
def dim_product(spark, sf_dir):
    return Lake(spark, sf_dir).dim_product.drop("product_key")


@query
def surrogate_key_bijection(spark, sf_dir):
    lake = Lake(spark, sf_dir)

    def counts(name: str, dimension: DataFrame, natural: list[str], surrogate: str) -> DataFrame:
        pairs = dimension.select(F.struct(*natural).alias("natural"), F.col(surrogate).alias("surrogate"))
        return pairs.agg(
            F.lit(name).alias("dimension"),
            F.count_distinct("natural").alias("naturals"),
            F.count_distinct("surrogate").alias("surrogates"),
        )

    return (
        counts("customer", lake.dim_customer(), ["customer_id"], "customer_key")
        .unionByName(counts("product", lake.dim_product, ["product_id"], "product_key"))
        .unionByName(counts("seller", lake.dim_seller(), ["seller_id"], "seller_key"))
        .unionByName(counts("geolocation", lake.dim_geolocation, gold.PLACE, "geolocation_key"))
    )


def _shown(dimension: DataFrame, surrogate: str, natural: str) -> DataFrame:
    """The dimension's keys with the natural key a surrogate stands for, looked up again, in the
    surrogate's place. The lookup is made on the dimension, so that a fact which resolves its
    keys here needs no second pass over its rows."""
    pairs = dimension.select(natural, surrogate)
    known = pairs.distinct().withColumnRenamed(natural, "_shown")
    return pairs.join(known, surrogate, "left").select(natural, F.col("_shown").alias(surrogate))


def _shown_orders(lake: Lake, one_per_place: bool = False) -> DataFrame:
    customers = _shown(lake.dim_customer(one_per_place), "customer_key", "customer_id")
    return gold.fact_orders(lake.orders, customers)


def _named(fact: DataFrame, naturals: dict[str, str]) -> DataFrame:
    """Shown keys behind the other columns, under the natural keys' names."""
    others = [c for c in fact.columns if c not in naturals]
    return fact.select(*others, *[F.col(shown).alias(name) for shown, name in naturals.items()])


CUSTOMER = {"customer_key": "customer_id"}


def _named_item_keys(lake: Lake, one_per_place: bool) -> DataFrame:
    fact = gold.fact_order_items(
        lake.items,
        _shown_orders(lake, one_per_place),
        _shown(lake.dim_product, "product_key", "product_id"),
        _shown(lake.dim_seller(one_per_place), "seller_key", "seller_id"),
    )
    return _named(fact, CUSTOMER | {"product_key": "product_id", "seller_key": "seller_id"})


@query
def fact_orders(spark, sf_dir):
    return _named(_shown_orders(Lake(spark, sf_dir)), CUSTOMER)


@query
def fact_orders_one_per_place(spark, sf_dir):
    return _named(_shown_orders(Lake(spark, sf_dir), one_per_place=True), CUSTOMER)


@query
def fact_order_items(spark, sf_dir):
    return _named_item_keys(Lake(spark, sf_dir), one_per_place=False)


@query
def fact_order_items_one_per_place(spark, sf_dir):
    return _named_item_keys(Lake(spark, sf_dir), one_per_place=True)


@query
def fact_payments(spark, sf_dir):
    lake = Lake(spark, sf_dir)
    return _named(gold.fact_payments(lake.payments, _shown_orders(lake)), CUSTOMER)


@query
def fact_reviews(spark, sf_dir):
    lake = Lake(spark, sf_dir)
    return _named(gold.fact_reviews(lake.reviews, _shown_orders(lake)), CUSTOMER)


# --- business views and dashboards ----------------------------------------


@query
def daily_revenue(spark, sf_dir):
    lake = Lake(spark, sf_dir)
    return business.daily_revenue(lake.orders, lake.payments)


@query
def product_performance(spark, sf_dir):
    lake = Lake(spark, sf_dir)
    return business.product_performance(
        lake.orders, lake.items, lake.payments, lake.reviews, lake.products, lake.translation
    )


@query
def sales_by_customer(spark, sf_dir):
    lake = Lake(spark, sf_dir)
    return business.sales_by_customer(lake.items, lake.orders)


@query
def active_customers_by_day(spark, sf_dir):
    lake = Lake(spark, sf_dir)
    return dashboards.active_customers_by_day(lake.orders, lake.customers)


@query
def monthly_revenue(spark, sf_dir):
    lake = Lake(spark, sf_dir)
    return dashboards.monthly_revenue(lake.orders, lake.payments)


@query
def top_categories(spark, sf_dir):
    lake = Lake(spark, sf_dir)
    return dashboards.top_categories(lake.items, lake.products)


@query
def top_sellers(spark, sf_dir):
    lake = Lake(spark, sf_dir)
    return dashboards.top_sellers(lake.items, lake.sellers)


# --- streams ---------------------------------------------------------------


class Stage:
    """A fresh folder and schema for one streaming run, on shared storage."""

    def __init__(self, spark: SparkSession) -> None:
        name = f"run_{uuid.uuid4().hex[:12]}"
        self.folder = f"{session.shared_folder(spark)}/{name}"
        self.schema = f"orderlake_{name}"
        sinks.ensure_schema(spark, self.schema, f"{self.folder}/tables")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def table(self, name: str) -> str:
        return f"{self.schema}.{name}"


def _ingest_orders(spark: SparkSession, sf_dir: str, stage: Stage) -> str:
    """All deliveries of the orders feed as CSV, then through the bronze stream."""
    delivered = feeds.orders_raw(Tables(spark, sf_dir)).select(FEED_SCHEMAS["orders"].schema.names)
    delivered.write.option("header", True).csv(stage.path("landing"))
    table = stage.table("bronze_orders")
    bronze.run_bronze(
        spark, "orders", stage.path("landing"), table, stage.path("bronze")
    ).awaitTermination()
    return table


@query
def bronze_ingest(spark, sf_dir):
    ingested = spark.table(_ingest_orders(spark, sf_dir, Stage(spark)))
    texts = {
        f.name: F.col(f.name).cast("string")
        for f in ingested.schema.fields
        if isinstance(f.dataType, TimestampType)
    }
    return ingested.withColumns(texts).drop("_InsertTimeStamp", "_source_file", "_corrupt_record")


def _ingest_text(spark: SparkSession, sf_dir: str, name: str, raw: str) -> DataFrame:
    """All deliveries of a text feed as CSV, through the bronze stream, and whether each
    row got the ingest time and file that a run adds."""
    stage, columns = Stage(spark), list(FEED_SCHEMAS[name].schema.names)
    getattr(feeds, raw)(Tables(spark, sf_dir)).select(columns).write.option("header", True).csv(stage.path("landing"))
    table = stage.table("bronze")
    bronze.run_bronze(spark, name, stage.path("landing"), table, stage.path("bronze")).awaitTermination()
    ingested = spark.table(table)
    known = F.col("_InsertTimeStamp").isNotNull() & F.col("_source_file").isNotNull()
    return ingested.select(*columns, known.alias("has_lineage"))


@query
def bronze_customers(spark, sf_dir):
    return _ingest_text(spark, sf_dir, "customers", "customers_raw")


@query
def bronze_sellers(spark, sf_dir):
    return _ingest_text(spark, sf_dir, "sellers", "sellers_raw")


@query
def bronze_geolocation(spark, sf_dir):
    return _ingest_text(spark, sf_dir, "geolocation", "geolocation_raw")


@query
def bronze_products(spark, sf_dir):
    return _ingest_text(spark, sf_dir, "products", "products_raw")


@query
def bronze_translation(spark, sf_dir):
    return _ingest_text(spark, sf_dir, "product_category_name", "category_translation_raw")


def _ingest_typed(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A typed feed as CSV, through the bronze stream; what did not fit its types is in ``unparsed``."""
    stage, feed = Stage(spark), FEED_SCHEMAS[name]
    df.select(feed.schema.names).write.option("header", True).option("escape", '"').csv(stage.path("landing"))
    table = stage.table("bronze")
    bronze.run_bronze(spark, name, stage.path("landing"), table, stage.path("bronze")).awaitTermination()
    ingested = spark.table(table)
    known = F.col(feed.ingest_column).isNotNull() & F.col("_source_file").isNotNull()
    return ingested.select(*feed.schema.names, known.alias("has_lineage"), F.col("_corrupt_record").alias("unparsed"))


@query
def bronze_items(spark, sf_dir):
    return _ingest_typed(spark, feeds.order_items(Tables(spark, sf_dir)), "order_items")


@query
def bronze_payments(spark, sf_dir):
    """Every eleventh order has an amount that is no number."""
    raw = feeds.order_payments_raw(Tables(spark, sf_dir))
    wrong = F.col("order_id").cast("bigint") % 11 == 0
    return _ingest_typed(
        spark, raw.withColumn("payment_value", F.when(wrong, "n/a").otherwise(F.col("payment_value").cast("string"))), "order_payments"
    )


@query
def bronze_reviews(spark, sf_dir):
    """Without the message, which may hold line ends that a line-based feed cannot."""
    raw = feeds.order_reviews_raw(Tables(spark, sf_dir))
    return _ingest_typed(spark, raw.withColumn("review_comment_message", F.lit("said")), "order_reviews")


@query
def bronze_inferred(spark, sf_dir):
    """All text, inferred types, and types pinned by the first delivery for a later one."""
    stage, tables = Stage(spark), Tables(spark, sf_dir)
    paid = feeds.order_payments(tables).select(FEED_SCHEMAS["order_payments"].schema.names)
    first = F.col("payment_sequential") == 1
    landing = stage.path("landing")
    paid.where(first).write.option("header", True).csv(landing)
    found = []
    for way, options in (("text", {"schema": None}), ("typed", {"schema": None, "schema_path": stage.path("pinned")})):
        feed = replace(FEED_SCHEMAS["order_payments"], typed=way == "typed")
        table = stage.table(way)
        bronze.run_bronze(spark, feed, landing, table, stage.path(f"ck_{way}"), **options).awaitTermination()
        if way == "typed":
            # a later file whose own types would be inferred otherwise
            paid.where(~first).withColumn("payment_value", F.floor("payment_value")).write.mode("append").option("header", True).csv(landing)
            bronze.run_bronze(spark, feed, landing, table, stage.path(f"ck_{way}"), **options).awaitTermination()
        rows = spark.table(table)
        for name in ("order_id", "payment_sequential", "payment_type", "payment_value"):
            kind = rows.schema[name].dataType.simpleString()
            found.append(rows.agg(F.lit(way).alias("way"), F.lit(name).alias("name"), F.lit(kind).alias("kind"), F.count(name).alias("known")))
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


@query
def bronze_by_header(spark, sf_dir):
    """Files of four layouts: as the feed, in another order with a surplus column, with a column
    less, and with rows of too many fields and one that equals the header."""
    stage = Stage(spark)
    columns = list(FEED_SCHEMAS["customers"].schema.names)
    raw = feeds.customers_raw(Tables(spark, sf_dir)).where("customer_id is not null").select(
        *[F.coalesce(c, F.lit("")).alias(c) for c in columns], F.expr("cast(customer_id as bigint) div 100").alias("file"),
        F.col("_source_file").alias("load"),
    )
    layout = F.col("file") % 4
    headers = [columns, [*reversed(columns), "load"], columns[:-1], columns]
    line, header = F.lit(None), F.lit(None)
    for n, names in enumerate(headers):
        fields = F.concat_ws(",", *names, *([F.lit("surplus")] if n == 3 else []))
        line, header = F.when(layout == n, fields).otherwise(line), F.when(layout == n, ",".join(names)).otherwise(header)
    files = raw.groupBy("file").agg(F.any_value(header).alias("header"), F.sort_array(F.collect_list(line)).alias("lines"))
    again = F.when(layout == 3, F.array("header")).otherwise(F.array().cast("array<string>"))
    text = F.array_join(F.concat(F.array("header"), "lines", again), "\n")
    files.select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(stage.path("landing"))
    table = stage.table("bronze")
    bronze.run_bronze_by_header(spark, "customers", stage.path("landing"), table, stage.path("ck")).awaitTermination()
    return spark.table(table).select(*columns, F.col("_rescued")["load"].alias("load"), F.col("_corrupt_record").alias("unparsed"))


@query
def stream_orders_to_silver(spark, sf_dir):
    stage = Stage(spark)
    source = _bronze_table(spark, feeds.orders_raw(Tables(spark, sf_dir)), stage, "orders_raw")
    silver.run_silver(spark, "orders", source, stage.path("silver"), stage.schema).awaitTermination()
    return spark.table(stage.table("orders")).drop(
        "_InsertTimeStamp", "_source_file", "batch_id", "processed_at"
    )


@query
def stream_customers_to_silver(spark, sf_dir):
    """Two deliveries in two runs of the stream: a type 2 merge across batches."""
    stage = Stage(spark)
    delivered = feeds.customers_raw(Tables(spark, sf_dir))
    later = F.col("_source_file") == "load_2"
    for part in (delivered.where(~later), delivered.where(later)):
        source = _bronze_table(spark, part, stage, "customers_raw")
        silver.run_silver(
            spark, "customers", source, stage.path("silver"), stage.schema
        ).awaitTermination()
    return spark.table(stage.table("customers"))


@query
def stream_translation_to_silver(spark, sf_dir):
    """Two deliveries in two runs of the stream: a type 1 merge across batches."""
    stage = Stage(spark)
    delivered = feeds.category_translation_raw(Tables(spark, sf_dir))
    for file in ("load_1", "load_2"):
        part = delivered.where(F.col("_source_file") == file)
        source = _bronze_table(spark, part, stage, "translation_raw")
        silver.run_silver(
            spark, "product_category_translation", source, stage.path("silver"), stage.schema
        ).awaitTermination()
    return spark.table(stage.table("product_category_translation")).drop("_InsertTimeStamp")


@query
def current_orders(spark, sf_dir):
    """Two deliveries appended by two batches, then the newest row per order."""
    stage = Stage(spark)
    delivered = feeds.orders_raw(Tables(spark, sf_dir))
    for file in ("load_1", "load_2"):
        part = delivered.where(F.col("_source_file") == file)
        source = _bronze_table(spark, part, stage, "orders_raw")
        silver.run_silver(spark, "orders", source, stage.path("silver"), stage.schema).awaitTermination()
    return silver.current(spark, "orders", stage.schema).drop("_InsertTimeStamp", "_source_file", "batch_id")


@query
def stream_customers_late(spark, sf_dir):
    """The later delivery comes first: the versions of the other one are late, and history
    that is already stored is rebuilt for their keys."""
    stage = Stage(spark)
    delivered = feeds.customers_raw(Tables(spark, sf_dir))
    later = F.col("_source_file") == "load_2"
    for part in (delivered.where(later), delivered.where(~later)):
        source = _bronze_table(spark, part, stage, "customers_raw")
        silver.run_silver(spark, "customers", source, stage.path("silver"), stage.schema).awaitTermination()
    return spark.table(stage.table("customers"))


@query
def stream_products_to_silver(spark, sf_dir):
    """Two deliveries in two runs: different records of one ingest time all stay."""
    stage = Stage(spark)
    delivered = feeds.products_raw(Tables(spark, sf_dir))
    later = F.col("_source_file") == "load_2"
    for part in (delivered.where(~later), delivered.where(later)):
        source = _bronze_table(spark, part, stage, "products_raw")
        silver.run_silver(spark, "products", source, stage.path("silver"), stage.schema).awaitTermination()
    return spark.table(stage.table("products")).drop("_InsertTimeStamp")


@query
def reprocess_orders(spark, sf_dir):
    """The feed is read a second time from the start: the new generation replaces the old one."""
    stage = Stage(spark)
    source = _bronze_table(spark, feeds.orders_raw(Tables(spark, sf_dir)), stage, "orders_raw")
    silver.run_silver(spark, "orders", source, stage.path("silver"), stage.schema).awaitTermination()
    silver.reprocess(spark, "orders", source, stage.path("silver"), stage.schema)
    return spark.table(stage.table("orders")).drop("_InsertTimeStamp", "_source_file", "batch_id", "processed_at")


@query
def quarantine_from_table(spark, sf_dir):
    """What the source gate refused, read back from its table."""
    stage = Stage(spark)
    source = _bronze_table(spark, feeds.orders_raw(Tables(spark, sf_dir)), stage, "orders_raw")
    silver.run_silver(spark, "orders", source, stage.path("silver"), stage.schema).awaitTermination()
    refused = spark.table(stage.table("orders_invalid_source"))
    return refused.select("order_id", "customer_id", "order_status", "order_purchase_timestamp", _delivery(), _errors(), _warnings())


@query
def batch_lineage(spark, sf_dir):
    """Two batches: how many batch numbers, processing times and rows each has."""
    stage = Stage(spark)
    delivered = feeds.orders_raw(Tables(spark, sf_dir))
    for file in ("load_1", "load_2"):
        source = _bronze_table(spark, delivered.where(F.col("_source_file") == file), stage, "orders_raw")
        silver.run_silver(spark, "orders", source, stage.path("silver"), stage.schema).awaitTermination()
    return spark.table(stage.table("orders")).groupBy("batch_id").agg(
        F.count_distinct("processed_at").alias("times"), F.count(F.lit(1)).alias("rows"),
        F.count_distinct("_source_file").alias("files"),
    )


@query
def empty_batch(spark, sf_dir):
    """A batch without rows between two others leaves the tables as they are."""
    stage = Stage(spark)
    raw, feed = feeds.orders_raw(Tables(spark, sf_dir)), silver.FEEDS["orders"]
    for number, part in enumerate((raw, raw.where(F.lit(False)))):
        silver.process_batch(feed, part, number, stage.schema)
    return spark.table(stage.table("orders")).groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"))


@query
def truncate_table(spark, sf_dir):
    """A derived table emptied, then written again."""
    stage = Stage(spark)
    paid = business.paid_per_order(feeds.order_payments(Tables(spark, sf_dir)), "paid")
    sinks.write_table(paid, stage.table("paid"))
    sinks.truncate(spark, stage.table("paid"))
    left = spark.table(stage.table("paid")).count()
    sinks.write_table(paid.withColumn("left_after_truncate", F.lit(left)), stage.table("paid"))
    return spark.table(stage.table("paid"))


def _silver_tables(spark: SparkSession, sf_dir: str, stage: Stage) -> int:
    """Silver as stored tables; what is joined by order is stored by order. Returns the
    number of buckets, which follows the longest of those tables."""
    lake = Lake(spark, sf_dir)
    buckets = sinks.bucket_count(*[lake.tables[name] for name in ("orders", "lineitem", "documents")])
    by_order = {"orders": lake.orders, "order_items": lake.items, "order_payments": lake.payments, "order_reviews": lake.reviews}
    for name, df in by_order.items():
        sinks.write_table(df, stage.table(name), buckets, "order_id")
    sinks.write_table(lake.products, stage.table("products"))
    sinks.write_table(lake.translation, stage.table("product_category_translation"))
    return buckets


@query
def gold_from_tables(spark, sf_dir):
    """The star schema built twice from stored silver tables; its item facts, read from storage."""
    stage, lake = Stage(spark), Lake(spark, sf_dir)
    buckets = _silver_tables(spark, sf_dir, stage)
    for name in ("customers", "sellers", "geolocation"):
        sinks.write_table(getattr(lake, name), stage.table(name))
    for _ in range(2):
        warehouse.build_gold(spark, stage.schema, stage.schema, buckets=buckets)
    dimensions = {name: spark.table(stage.table(f"dim_{name}")) for name in ("customer", "product", "seller")}
    return _naturals(spark.table(stage.table("fact_order_items")), dimensions, buckets)


def _business_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view of the catalog over stored tables, read in another session than made it."""
    stage = Stage(spark)
    _silver_tables(spark, sf_dir, stage)
    warehouse.register_views(spark, stage.schema, stage.schema)
    return session.prepare(spark.newSession()).table(stage.table(name))


@query
def view_daily_revenue(spark, sf_dir):
    return _business_view(spark, sf_dir, "v_daily_revenue_analytics")


@query
def view_product_performance(spark, sf_dir):
    return _business_view(spark, sf_dir, "product_performance")


@query
def view_sales_by_customer(spark, sf_dir):
    return _business_view(spark, sf_dir, "sales_by_customer")


def _bronze_table(spark: SparkSession, df: DataFrame, stage: Stage, name: str) -> str:
    table = stage.table(name)
    df.write.mode("append").format("parquet").saveAsTable(table)
    return table
