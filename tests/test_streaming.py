import time
import uuid
from dataclasses import replace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderlake import feeds, schemas, session
from orderlake.operators import joins
from orderlake.plans import business, gold, warehouse
from orderlake.sources.csv import csv_stream, resolve_schema
from orderlake.streaming import bronze, silver, sinks
from tests.helpers import rows, ts


@pytest.fixture
def stage(spark, tmp_path):
    class Stage:
        schema = f"t_{uuid.uuid4().hex[:8]}"

        def path(self, name):
            return str(tmp_path / name)

        def table(self, name):
            return f"{self.schema}.{name}"

        def drop_file(self, folder, name, text):
            target = tmp_path / folder
            target.mkdir(exist_ok=True)
            (target / name).write_text(text)

    made = Stage()
    sinks.ensure_schema(spark, made.schema, made.path("tables"))
    return made


def ingest(spark, stage, **options):
    query = bronze.run_bronze(
        spark, "sellers", stage.path("in"), stage.table("b"), stage.path("ck"), **options
    )
    query.awaitTermination()
    return spark.table(stage.table("b"))


HEADER = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"


def test_each_file_is_ingested_once(spark, stage):
    stage.drop_file("in", "a.csv", HEADER + "1,z,c,s\n2,z,c,s\n")
    assert ingest(spark, stage).count() == 2
    assert ingest(spark, stage).count() == 2
    stage.drop_file("in", "b.csv", HEADER + "3,z,c,s\n")
    got = ingest(spark, stage)
    assert rows(got, "seller_id") == [("1",), ("2",), ("3",)]
    assert got.columns[-2:] == ["_InsertTimeStamp", "_source_file"]
    assert got.where(F.col("_source_file").endswith("b.csv")).count() == 1
    assert got.select("_InsertTimeStamp").distinct().count() == 2


def test_all_feeds_have_their_lineage_column(spark):
    assert len(schemas.FEEDS) == 9
    assert schemas.FEEDS["order_items"].ingest_column == "_ingest_time"
    assert [f.name for f in schemas.FEEDS.values() if f.typed] == ["order_items", "order_payments", "order_reviews", "orders"]


def test_swapped_header_fails_instead_of_shifting_columns(spark, stage):
    stage.drop_file("in", "a.csv", "seller_zip_code_prefix,seller_id,seller_city,seller_state\nz,1,c,s\n")
    with pytest.raises(PySparkException):
        ingest(spark, stage)


def by_header(spark, stage):
    bronze.run_bronze_by_header(spark, "sellers", stage.path("in"), stage.table("h"), stage.path("ck")).awaitTermination()
    return spark.table(stage.table("h"))


def test_files_read_by_their_own_header(spark, stage):
    stage.drop_file("in", "a.csv", HEADER + '1,z,"big, city",s\n' + HEADER + "3,z,c\n4,z,c,s,more\n\n")
    stage.drop_file("in", "b.csv", "\ufeffseller_state,extra,seller_id, extra,\ns,x,2,y,\ns,,5,,z\n")
    stage.drop_file("in", "c.csv", 'seller_id,"a, b"\n6,"q, r"\n')
    stage.drop_file("in", "d.csv", "")
    by_header(spark, stage)
    got = by_header(spark, stage)
    # an empty name at the end of b.csv's header is no column: its rows have a field too many
    assert rows(got, "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state", "_rescued", "_corrupt_record") == [
        ("1", "z", "big, city", "s", None, None),
        ("2", None, None, "s", {"extra": "x", "extra#4": "y"}, "s,x,2,y,"),
        ("3", "z", "c", None, None, "3,z,c"),
        ("4", "z", "c", "s", None, "4,z,c,s,more"),
        ("5", None, None, "s", None, "s,,5,,z"),
        ("6", None, None, None, {"a, b": "q, r"}, None),
        ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state", None, None),
    ]
    assert got.where(F.col("_source_file").endswith("b.csv")).count() == 2
    assert got.where("_InsertTimeStamp is null").count() == 0


def test_any_number_of_layouts(spark, stage):
    for n in range(1100):
        stage.drop_file("in", f"{n}.csv", f"own{n},seller_id{',x' * (n % 5)}\nv{n},{n}{',0' * (n % 5)}\n")
    got = by_header(spark, stage)
    found = {r.seller_id: r._rescued for r in got.where("_corrupt_record is null").collect()}
    assert len(found) == 1100 and all(found[str(n)][f"own{n}"] == f"v{n}" for n in range(1100))
    assert found["4"] == {"own4": "v4", "x": "0", "x#4": "0", "x#5": "0", "x#6": "0"}


def test_inference_text_typed_and_pinned(spark, stage):
    stage.drop_file("in", "a.csv", "id,v\n1,2024-01-01 10:00:00\n")
    text = resolve_schema(spark, stage.path("in"))
    assert [f.dataType.simpleString() for f in text.fields] == ["string", "string"]
    typed = resolve_schema(spark, stage.path("in"), infer_types=True, schema_path=stage.path("pin"))
    assert [f.dataType.simpleString() for f in typed.fields] == ["int", "timestamp"]
    stage.drop_file("in", "b.csv", "id,v\nx,y\n")
    assert resolve_schema(spark, stage.path("in"), infer_types=True, schema_path=stage.path("pin")) == typed
    assert csv_stream(spark, stage.path("in"), schema_path=stage.path("pin")).schema.names == ["id", "v"]


SELLERS = "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string, _InsertTimeStamp timestamp, _source_file string"
T1, T2, T3 = ts("2024-01-01"), ts("2024-02-01"), ts("2024-03-01")


def sellers(spark, *data):
    return spark.createDataFrame([(k, "z", city, "S", t, "f") for k, city, t in data], SELLERS)


def test_a_replayed_batch_changes_nothing_in_a_versioned_table(spark, stage):
    feed, target = silver.FEEDS["sellers"], stage.table("sellers")
    batches = [
        sellers(spark, ("1", "a", T1), ("2", "a", T1), (None, "x", T1)),
        sellers(spark, ("1", "b", T2), ("3", "a", T2)),
        sellers(spark, ("1", "c", T3)),
    ]
    for number, batch in enumerate(batches):
        silver.process_batch(feed, batch, number, stage.schema)
        once = rows(spark.table(target))
        silver.process_batch(feed, batch, number, stage.schema)
        assert rows(spark.table(target)) == once
    assert rows(spark.table(target), "seller_id", "seller_city", "EffectiveTo", "IsActive") == [
        ("1", "a", T2, False),
        ("1", "b", T3, False),
        ("1", "c", None, True),
        ("2", "a", None, True),
        ("3", "a", None, True),
    ]
    assert spark.table(stage.table("sellers_source_invalid")).count() == 1
    versions = {(r.active, r.batch_id) for r in spark.table(f"{target}_g0_map").collect()}
    assert {batch for _, batch in versions} == {1, 2}
    held = {r[0] for r in spark.table(f"{target}_g0_active").select("version").distinct().collect()}
    assert held == {version for version, _ in versions}


def test_rows_that_change_nothing_can_be_kept_out_of_history(spark, stage):
    feed = replace(silver.FEEDS["sellers"], changed_only=True)
    batches = [
        sellers(spark, ("1", "a", T1), ("2", "a", T1)),
        sellers(spark, ("1", "a", T2), ("2", "b", T2)),
        sellers(spark, ("1", "a", T3)),
    ]
    for number, batch in enumerate(batches):
        silver.process_batch(feed, batch, number, stage.schema)
    got = rows(spark.table(stage.table("sellers")), "seller_id", "seller_city", "EffectiveFrom", "EffectiveTo")
    assert got == [("1", "a", T1, None), ("2", "a", T1, T2), ("2", "b", T2, None)]


def test_a_replayed_batch_changes_nothing_in_an_append_table(spark, stage, sf_dir):
    feed = silver.FEEDS["orders"]
    raw = feeds.orders_raw(feeds.Tables(spark, sf_dir))
    for number in (0, 0, 1, 1):
        silver.process_batch(feed, raw, number, stage.schema)
    table = spark.table(stage.table("orders"))
    per_batch = rows(table.groupBy("batch_id").count())
    assert per_batch[0][1] == per_batch[1][1] and [p[0] for p in per_batch] == [0, 1]
    assert "processed_at" in table.columns
    invalid = spark.table(stage.table("orders_invalid_source"))
    assert invalid.where("batch_id = 0").count() + per_batch[0][1] <= raw.count()


def test_type_1_table(spark, stage):
    feed = silver.FEEDS["product_category_translation"]
    schema = "product_category_name string, product_category_name_english string, _InsertTimeStamp timestamp, _source_file string"
    silver.process_batch(feed, spark.createDataFrame([("a", "x", T1, "f"), ("b", "y", T1, "f")], schema), 0, stage.schema)
    second = spark.createDataFrame([("a", "z", T2, "f"), (None, "y", T2, "f")], schema)
    for _ in range(2):
        silver.process_batch(feed, second, 1, stage.schema)
    got = spark.table(stage.table("product_category_translation"))
    assert rows(got, "product_category_name", "product_category_name_english") == [("a", "z"), ("b", "y")]


def test_reprocessing_replaces_what_readers_see(spark, stage):
    sellers(spark, ("1", "a", T1), (None, "x", T1)).write.saveAsTable(stage.table("raw"))

    def run():
        silver.run_silver(spark, "sellers", stage.table("raw"), stage.path("ck"), stage.schema).awaitTermination()
        return spark.table(stage.table("sellers"))

    assert run().count() == 1
    assert run().count() == 1
    sellers(spark, ("1", "b", T2)).write.mode("append").saveAsTable(stage.table("raw"))
    once = rows(run(), "seller_city", "EffectiveFrom", "EffectiveTo", "IsActive")
    assert [r[0] for r in once] == ["a", "b"]
    assert silver.reprocess(spark, "sellers", stage.table("raw"), stage.path("ck"), stage.schema) == 1
    assert rows(spark.table(stage.table("sellers")), "seller_city", "EffectiveFrom", "EffectiveTo", "IsActive") == once
    assert spark.table(stage.table("sellers_source_invalid")).count() == 1
    # later runs go on with the generation that is shown
    sellers(spark, ("2", "c", T3)).write.mode("append").saveAsTable(stage.table("raw"))
    assert run().count() == 3 and sinks.generation_of(spark, stage.table("sellers")) == 1


def versions(spark, *data):
    schema = "k string, v string, EffectiveFrom timestamp, EffectiveTo timestamp, IsActive boolean"
    return spark.createDataFrame([(k, v, start, None, True) for k, v, start in data], schema)


def test_untouched_buckets_keep_their_files(spark, stage):
    keys = [f"k{i}" for i in range(40)]
    target = stage.table("d")
    sinks.merge_versions(versions(spark, *[(k, "a", T1) for k in keys]), target, "k", 0, buckets=8)
    bucket = {r.k: r.bucket for r in spark.table(f"{target}_active").select("k", "bucket").collect()}

    def files():
        found = spark.table(f"{target}_active").select("bucket", "_metadata.file_path", "_metadata.file_modification_time").distinct()
        return {(r[0], r[1], r[2]) for r in found.collect()}

    before = files()
    sinks.merge_versions(versions(spark, ("k3", "b", T2)), target, "k", 1, buckets=8)
    after = files()
    assert {f for f in before if f[0] != bucket["k3"]} <= after
    assert {f[0] for f in after - before} == {bucket["k3"]}
    got = spark.table(target)
    assert got.count() == 41 and got.where("IsActive").count() == 40
    plan = spark.table(target)._jdf.queryExecution().optimizedPlan().toString()
    assert "_map" in plan or "active" in plan
    # the base of the last merge stays for a repeated batch, what is older goes
    sinks.merge_versions(versions(spark, ("k3", "c", T3)), target, "k", 2, buckets=8)
    sinks.merge_versions(versions(spark, ("k3", "c", T3)), target, "k", 2, buckets=8)
    held = spark.table(f"{target}_active").where(F.col("bucket") == bucket["k3"]).select("version").distinct()
    assert rows(held) == [(1,), (2,)]
    assert rows(spark.table(target).where("k = 'k3'"), "v", "EffectiveTo") == [("a", T2), ("b", T3), ("c", None)]


def test_late_versions_repair_stored_history(spark, stage):
    target = stage.table("late")
    T0 = ts("2023-12-01")
    batches = [
        [("a", "2", T2), ("b", "1", T1), ("c", "1", T1)],
        [("a", "3", T3), ("b", "3", T3)],
        [("a", "1", T1), ("b", "2", T2)],
        [("a", "0", T0)],
    ]
    for number, data in enumerate(batches):
        for _ in range(2):
            sinks.merge_versions(versions(spark, *data), target, "k", number, buckets=2)
    got = spark.table(target)
    assert rows(got, "k", "v", "EffectiveFrom", "EffectiveTo", "IsActive") == [
        ("a", "0", T0, T1, False), ("a", "1", T1, T2, False), ("a", "2", T2, T3, False), ("a", "3", T3, None, True),
        ("b", "1", T1, T2, False), ("b", "2", T2, T3, False), ("b", "3", T3, None, True),
        ("c", "1", T1, None, True),
    ]
    assert got.where("EffectiveTo < EffectiveFrom").count() == 0


def test_null_in_a_required_column_fails_the_write(spark, stage):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    with pytest.raises(PySparkException, match="NULL in column k"):
        sinks.append_batch(df, stage.table("n"), 0, not_null=("k",))
    sinks.append_batch(df.where("k is not null"), stage.table("n"), 0)
    kept = sinks.required(spark.table(stage.table("n")), stage.table("n"))
    assert [(f.name, f.nullable) for f in kept.schema.fields] == [("k", False), ("v", True), ("batch_id", True)]
    assert kept.count() == 1


def test_readers_see_a_derived_table_while_it_is_replaced(spark, stage):
    """Frames opened before, during and after a replacement all read whole tables."""
    target = stage.table("r")
    sinks.write_table(spark.range(100).withColumn("n", F.lit(0)), target)
    opened = spark.table(target)
    seen = []

    def watch(n):
        seen.append(spark.table(target).agg(F.count("*"), F.max("n")).first())
        return n

    for n in (1, 2):
        sinks.write_table(spark.range(100).withColumn("n", F.lit(watch(n))), target)
        watch(n)
        if n == 1:
            assert opened.count() == 100
    assert [tuple(s) for s in seen] == [(100, 0), (100, 1), (100, 1), (100, 2)]
    spark.range(3).write.saveAsTable(stage.table("plain"))
    with pytest.raises(ValueError):
        sinks.write_table(spark.range(1), stage.table("plain"))


def test_a_failed_replacement_leaves_the_table(spark, stage):
    target = stage.table("f")
    sinks.write_table(spark.range(5), target)
    with pytest.raises(PySparkException):
        sinks.write_table(spark.range(5).select(F.raise_error(F.lit("stop")).cast("bigint").alias("id")), target)
    assert spark.table(target).count() == 5
    sinks.write_table(spark.range(7), target)
    assert spark.table(target).count() == 7


def test_files_left_by_a_failed_write_are_passed_over(spark, stage, tmp_path):
    target = stage.table("late")
    sinks.write_table(spark.range(5), target)
    opened = spark.table(target)
    left = tmp_path / "tables" / "late_p1" / "_temporary"
    left.mkdir(parents=True)
    (left / "part-0").write_text("late")
    sinks.write_table(spark.range(7), target)
    assert spark.table(target).count() == 7 and opened.count() == 5
    for n in (8, 9):
        sinks.write_table(spark.range(n), target)
        assert spark.table(target).count() == n
    assert [n for n in range(5) if spark.catalog.tableExists(f"{target}_p{n}")] == [3, 4]
    assert (left / "part-0").read_text() == "late"


def test_item_facts_from_bucketed_tables_shuffle_nothing_for_the_order_join(spark, stage, sf_dir):
    tables = feeds.Tables(spark, sf_dir)
    sinks.write_table(feeds.order_items(tables), stage.table("items"), 4, "order_id")
    sinks.write_table(feeds.orders(tables).withColumn("customer_key", F.lit(1)), stage.table("fact_orders"), 4, "order_id")
    products = feeds.products_raw(tables).selectExpr("product_id", "1 product_key")
    sellers_of = feeds.sellers_raw(tables).selectExpr("seller_id", "1 seller_key")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = gold.fact_order_items(spark.table(stage.table("items")), spark.table(stage.table("fact_orders")), products, sellers_of)
        plan = fact._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert "Exchange hashpartitioning(product_id" in plan and "Exchange hashpartitioning(order_id" not in plan


def test_lines_of_bucketed_tables_stay_in_place_for_all_their_keys(spark, stage, sf_dir, monkeypatch):
    """No exchange carries whole lines, neither for the keys of the facts, nor for their write,
    nor for the natural keys shown again."""
    from orderlake import registry

    def carried(df):
        """Exchanges above a scan of prices."""
        plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
        depth = [next((i for i, c in enumerate(line) if c.isalpha()), 0) for line in plan]
        found = []
        for at in (n for n, line in enumerate(plan) if "Scan parquet" in line and "price" in line):
            above = depth[at]
            for n in range(at, -1, -1):
                if depth[n] < above:
                    above = depth[n]
                    found += [plan[n]] if "Exchange" in plan[n] else []
        return found

    monkeypatch.setattr(joins, "LOOKUP_ROWS", 0)
    lake = registry.Lake(spark, sf_dir)
    for name, key in (("items", "order_id"), ("dim_product", "product_id")):
        sinks.write_table(getattr(lake, name), stage.table(name), 4, key)
    sinks.write_table(lake.dim_seller(), stage.table("dim_seller"), 4, "seller_id")
    sinks.write_table(lake.fact_orders(), stage.table("fact_orders"), 4, "order_id")
    items, orders, products, sellers = (spark.table(stage.table(n)) for n in ("items", "fact_orders", "dim_product", "dim_seller"))
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    with session.using(spark, off | session.IN_PLACE):
        fact = gold.fact_order_items(items, orders, products, sellers, 4)
        assert not carried(fact) and not carried(fact.repartition(4, "order_id"))
        sinks.write_table(fact, stage.table("fact"), 4, "order_id")
        stored = spark.table(stage.table("fact"))
        assert not carried(registry._naturals(stored, {"product": products, "seller": sellers}, 4))
    with session.using(spark, off):
        plain = gold.fact_order_items(items, orders, products, sellers)
        assert carried(plain)
        assert rows(stored) == rows(plain)


def test_a_table_is_written_small_and_leaves_no_shuffle_files(spark, stage):
    def files():
        held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = [held.apply(n).getName() for n in range(held.size())]
        return {name for name in names if name.startswith("shuffle_")}

    before = files()
    sinks.write_table(spark.range(5000).selectExpr("id", "id % 9 k"), stage.table("tidy"), 4, "k")
    until = time.monotonic() + 20
    while files() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get(next(iter(sinks.TIDY)), "false") == "false"
    assert all(name.endswith(".zstd.parquet") for name in spark.table(stage.table("tidy")).inputFiles())


def test_tasks_hold_one_bucket_where_no_join_asks_for_it(spark, stage):
    rows_of = spark.range(4000).selectExpr("cast(id as string) order_id", "id % 3 k")
    sinks.write_table(rows_of, stage.table("items"), 16, "order_id")
    names = spark.createDataFrame([(0, "a"), (1, "b")], "k long, name string")
    keyed = spark.table(stage.table("items")).join(F.broadcast(names), "k", "left")
    assert keyed.rdd.getNumPartitions() == 16
    sinks.write_table(keyed, stage.table("fact"), 16, "order_id")
    assert spark.table(stage.table("fact")).count() == 4000


def test_short_rows_are_spread_over_tasks_by_number(spark, tmp_path, monkeypatch):
    parts = spark.range(1000).selectExpr("id p_partkey", "'n' p_name", "'t' p_type", "cast(id % 50 as int) p_size")
    parts.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(feeds, "ROWS_PER_TASK", 100)
    raw = feeds.products_raw(feeds.Tables(spark, str(tmp_path)))
    sizes = raw.where("_source_file = 'load_1'").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 1000 and len(sizes) == 10 and max(r["count"] for r in sizes) < 200


def test_views_of_the_catalog_equal_the_functions(spark, stage, sf_dir):
    from orderlake.registry import Lake

    lake = Lake(spark, sf_dir)
    names = {"orders": lake.orders, "order_items": lake.items, "order_payments": lake.payments, "order_reviews": lake.reviews,
             "products": lake.products, "product_category_translation": lake.translation}
    for name, df in names.items():
        sinks.write_table(df, stage.table(name))
    warehouse.register_views(spark, stage.schema, stage.schema)
    other = session.prepare(spark.newSession())
    expected = {
        "v_daily_revenue_analytics": business.daily_revenue(lake.orders, lake.payments),
        "sales_by_customer": business.sales_by_customer(lake.items, lake.orders),
        "product_performance": business.product_performance(
            lake.orders, lake.items, lake.payments, lake.reviews, lake.products, lake.translation
        ),
    }
    for name, df in expected.items():
        view = other.table(stage.table(name))
        assert sorted(view.columns) == sorted(df.columns)
        assert rows(view, *df.columns) == rows(df)


def test_empty_batches_write_nothing(spark, stage):
    silver.process_batch(silver.FEEDS["sellers"], sellers(spark).limit(0), 0, stage.schema)
    assert not spark.catalog.tableExists(stage.table("sellers"))


def test_truncate_is_available(spark, stage):
    sinks.write_table(sellers(spark, ("1", "a", T1)), stage.table("x"))
    sinks.truncate(spark, stage.table("x"))
    assert spark.table(stage.table("x")).count() == 0


RAW = {
    "customers": "customers_raw",
    "geolocation": "geolocation_raw",
    "order_items": "order_items_raw",
    "order_payments": "order_payments_raw",
    "order_reviews": "order_reviews_raw",
    "orders": "orders_raw",
    "product_category_translation": "category_translation_raw",
    "products": "products_raw",
    "sellers": "sellers_raw",
}


def test_all_layers_end_to_end(spark, stage, sf_dir):
    """Nine feeds into silver, then gold and the business views from the tables."""
    for name, raw in RAW.items():
        silver.process_batch(silver.FEEDS[name], getattr(feeds, raw)(feeds.Tables(spark, sf_dir)), 0, stage.schema)
        table = spark.table(stage.table(name))
        assert table.count() > 0
        assert not {"_errors", "_warnings"} & set(table.columns)
    built = warehouse.build_gold(spark, stage.schema, stage.schema, one_per_place=True, buckets=4)
    assert len(built) == 9 and all(spark.table(t).count() > 0 for t in built)
    orders = spark.table(stage.table("orders")).count()
    assert spark.table(stage.table("fact_orders")).count() == orders
    assert spark.table(stage.table("fact_order_items")).count() == spark.table(stage.table("order_items")).count()
    for view in warehouse.register_views(spark, stage.schema, stage.schema):
        assert spark.table(view).count() > 0


def test_bucketed_orders_are_not_shuffled_for_their_child_facts(spark, stage, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sinks.write_table(feeds.orders(feeds.Tables(spark, sf_dir)), stage.table("o"), 4, "order_id")
        joined = feeds.order_payments(feeds.Tables(spark, sf_dir)).join(spark.table(stage.table("o")), "order_id", "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_buckets_of_derived_tables_follow_the_rows(spark, stage, sf_dir, monkeypatch):
    from orderlake import registry

    assert sinks.bucket_count(spark.range(10), spark.range(2_000_001)) == 9
    monkeypatch.setattr(sinks, "ROWS_PER_BUCKET", 500)
    made = registry.Stage(spark)
    buckets = registry._silver_tables(spark, sf_dir, made)
    lines = feeds.Tables(spark, sf_dir)["lineitem"].count()
    assert buckets == -(-lines // 500) > 8
    for name in ("orders", "order_items", "order_payments", "order_reviews"):
        stored = spark.sql(f"DESCRIBE TABLE EXTENDED {made.table(name)}_p0").where("col_name = 'Num Buckets'").collect()
        assert [row.data_type for row in stored] == [str(buckets)]


def test_a_line_that_does_not_fit_is_quarantined_whole(spark, stage):
    header = "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
    stage.drop_file("in", "a.csv", header + "1,1,voucher,1,5.5\n2,1,voucher,1,a lot\n3,1,voucher,1,\n")
    bronze.run_bronze(
        spark, "order_payments", stage.path("in"), stage.table("b"), stage.path("ck")
    ).awaitTermination()
    silver.run_silver(
        spark, "order_payments", stage.table("b"), stage.path("sck"), stage.schema
    ).awaitTermination()
    assert rows(spark.table(stage.table("order_payments")), "order_id") == [("1",), ("3",)]
    refused = spark.table(stage.table("order_payments_invalid")).collect()
    assert [(r.order_id, r._corrupt_record, r._errors[0].name) for r in refused] == [
        ("2", "2,1,voucher,1,a lot", "line_parsed")
    ]


def test_current_rows_over_batches(spark, stage, sf_dir):
    raw = feeds.orders_raw(feeds.Tables(spark, sf_dir))
    for number in (0, 1):
        silver.process_batch(silver.FEEDS["orders"], raw, number, stage.schema)
    now = silver.current(spark, "orders", stage.schema)
    assert now.count() == now.select("order_id").distinct().count()
    assert now.select("batch_id").distinct().collect() == [(1,)]
