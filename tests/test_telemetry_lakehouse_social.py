import pytest
from pyspark.sql import functions as F

from reelpulse import schemas
from reelpulse.operators import lakehouse as lh
from reelpulse.operators import social as so
from reelpulse.operators import telemetry as tm

from conftest import plan_text, rows


@pytest.fixture(scope="module")
def dirty(spark):
    good = ("2024-01-01 20:00:00", "USER_1", "V1", "Drama", "Title", 30, "TV")
    data = [
        good, good,                                                     # exact duplicate
        ("2024-01-01 21:00:00", "", "V1", "Drama", "Title", 30, "TV"),   # missing user
        ("2024-01-01 21:00:00", "USER_2", "V1", "Drama", "", 30, "TV"),  # missing title
        ("2024-01-01 21:00:00", "USER_2", "V1", "Drama", "Title", 0, "TV"),
        ("2024-01-01 21:00:00", "USER_2", "V1", "Drama", "Title", -10, "TV"),
        ("CORRUPT_TIMESTAMP", "USER_2", "V1", "Drama", "Title", 30, "TV"),
        ("09/06/2026", "USER_2", "V1", "Drama", "Title", 30, "TV"),
        ("CORRUPT_TIMESTAMP", "", "V1", "Drama", "Title", 30, "TV"),     # dirty twice: counted once
        ("CORRUPT_TIMESTAMP", "", "V1", "Drama", "Title", 30, "TV"),     # ... and duplicated
        ("2024-01-01 23:00:00", "USER_3", "V2", "Comedy", "Other", 1439, "Mobile"),
        ("2024-01-01 23:30:00", "USER_3", "V2", "Comedy", "Other", 1440, "Mobile"),
    ]
    return spark.createDataFrame(data, schemas.TELEMETRY_RAW)


def test_funnel_matches_sequential_counts(spark, dirty):
    funnel = {r["step"]: r for r in tm.cleaning_funnel(dirty).collect()}
    dedup = dirty.dropDuplicates()
    info = dedup.filter((F.col("user_id") != "") & (F.col("video_title") != ""))
    pos = info.filter(F.col("watch_time_minutes") > 0)
    assert [funnel[s]["rows"] for s in tm.FUNNEL_STEPS] == [
        dirty.count(), dedup.count(), info.count(), pos.count(), tm.clean_telemetry(dirty).count()]
    assert sum(funnel[s]["removed"] for s in tm.FUNNEL_STEPS) + funnel["valid_timestamp"]["rows"] == funnel["raw"]["rows"]
    assert funnel["valid_timestamp"]["pct_of_raw"] == round(3 / 12 * 100, 2)


def test_funnel_is_one_scan(spark, tmp_path, dirty):
    dirty.write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    plan = plan_text(tm.cleaning_funnel(raw), "simple")
    assert plan.count("FileScan") == 1


def test_anomaly_threshold(spark, dirty):
    clean = tm.clean_telemetry(dirty)
    assert [r["watch_time_minutes"] for r in tm.anomalies(clean).collect()] == [1440]
    assert tm.anomalies(clean, user_id="USER_1").count() == 0
    assert [r["watch_time_minutes"] for r in tm.anomalies(clean, min_minutes=1000, n=10).collect()] == [1440, 1439]


def test_telemetry_reports(spark, dirty):
    clean = tm.clean_telemetry(dirty)
    assert rows(tm.top_users(clean)) == [("USER_1", 30), ("USER_3", 2879)]
    assert [tuple(r) for r in tm.trending_videos(clean).collect()] == [("Other", 2), ("Title", 1)]
    assert [tuple(r) for r in tm.activity_by_hour(clean).collect()] == [(23, 2), (20, 1)]
    stats = {r["genre"]: r for r in tm.genre_watch_stats(clean).collect()}
    assert (stats["Comedy"]["total"], stats["Comedy"]["average"], stats["Comedy"]["shortest"],
            stats["Comedy"]["longest"]) == (2879, 1439.5, 1439, 1440)


def test_silver_layers(spark):
    items = spark.createDataFrame(
        [("o1", "p1", "10.5", "1.0"), ("o1", "p2", "-1", "1.0"), ("o2", "p1", "0", "0"),
         ("o3", "p1", None, "1.0"), ("o4", "p1", "abc", "1.0"), ("o5", "p1", "2.0", "-0.5")],
        "order_id string, product_id string, price string, freight_value string",
    )
    assert rows(lh.silver_items(items, stamp=False)) == [("o1", "p1", 10.5, 1.0), ("o2", "p1", 0.0, 0.0)]
    products = spark.createDataFrame([("p1", None), ("p2", ""), ("p3", "toys")], "product_id string, product_category_name string")
    assert rows(lh.silver_products(products, stamp=False)) == [("p1", "unknown"), ("p2", ""), ("p3", "toys")]
    reviews = spark.createDataFrame([("r1", "o1", "4"), ("r2", "o2", "bad"), ("r3", "o3", None)],
                                    "review_id string, order_id string, review_score string")
    assert rows(lh.silver_reviews(reviews, stamp=False)) == [("r1", "o1", 4)]
    orders = spark.createDataFrame([("o1", "2024-01-01 10:00:00"), ("o1", "2024-01-01 10:00:00"), ("o2", "never")],
                                   "order_id string, order_purchase_timestamp string")
    so_ = lh.silver_orders(orders)
    assert so_.count() == 2 and "silver_processed_at" in so_.columns


def test_gold_review_fan_out_trap_t8(spark):
    reviews = spark.createDataFrame([("r1", "o1", 5), ("r2", "o2", 1)], "review_id string, order_id string, review_score int")
    items = spark.createDataFrame([("o1", "p1", 1.0, 0.0), ("o1", "p1", 1.0, 0.0), ("o2", "p2", 3.0, 0.0)],
                                  "order_id string, product_id string, price double, freight_value double")
    products = spark.createDataFrame([("p1", "toys"), ("p2", "toys")], "product_id string, product_category_name string")
    got = lh.product_satisfaction(reviews, items, products).first()
    assert (got["avg_customer_rating"], got["total_reviews_received"]) == (11 / 3, 3)   # 5, 5, 1
    perf = lh.category_performance(items, products).first()
    assert (perf["total_category_revenue"], perf["total_units_sold"]) == (5.0, 3)


def test_schema_lock(spark, tmp_path):
    from reelpulse.sources.io import SchemaLockError, write_layer

    df = spark.createDataFrame([("a", 1.0)], "id string, price double")
    write_layer(df, str(tmp_path), "silver", "items", lock_schema=True)
    write_layer(df, str(tmp_path), "silver", "items", lock_schema=True)
    with pytest.raises(SchemaLockError):
        write_layer(df.withColumn("x", F.lit(1)), str(tmp_path), "silver", "items", lock_schema=True)
    assert spark.read.parquet(str(tmp_path / "silver" / "items")).columns == ["id", "price"]


def test_csv_sources(spark, tmp_path):
    from reelpulse.sources.io import read_csv, read_raw_csv

    (tmp_path / "t.csv").write_text("timestamp,user_id,video_id,genre,video_title,watch_time_minutes,device_type\n"
                                    "2024-01-01 10:00:00,USER_1,V1,Drama,T,30,TV\n")
    raw = read_raw_csv(spark, str(tmp_path / "t.csv"))
    assert set(dict(raw.dtypes).values()) == {"string"}
    typed = read_csv(spark, str(tmp_path / "t.csv"), schemas.TELEMETRY_RAW)
    assert dict(typed.dtypes)["watch_time_minutes"] == "int"
    # inference makes the type depend on the data: a clean file infers a timestamp
    inferred = read_csv(spark, str(tmp_path / "t.csv"), infer=True)
    assert dict(inferred.dtypes)["timestamp"] == "timestamp"


def test_social_lookup_after_top_k_trap_t7(spark):
    feeds = spark.createDataFrame(
        [(1, "like")] * 5 + [(2, "view")] * 4 + [(3, "view")] * 3 + [(None, "share")] * 2 + [(5, "view")] + [(6, None)],
        "user_id long, action string",
    )
    users = spark.createDataFrame([(1, "A", "VN"), (1, "A2", "VN"), (None, "Ghost", "X"), (5, "E", "US")],
                                  "user_id int, name string, country string")
    got = rows(so.top_active_users_detail(feeds, users, 5))
    # user 2 and 3 are missing from users -> vanish; the duplicate user 1
    # yields two rows; the null user matches the null-keyed document
    assert got == [(1, "A", "VN", 5), (1, "A2", "VN", 5), (5, "E", "US", 1), (None, "Ghost", "X", 2)]
    assert rows(so.action_distribution(feeds)) == [("like", 5), ("share", 2), ("view", 8), (None, 1)]


def test_social_users_age(spark):
    raw = spark.createDataFrame([(1, "A", "F", "2000-06-30", "c", "VN"), (2, "B", "M", "30/06/2000", "c", "VN")],
                                schemas.SOCIAL_USERS_RAW)
    out = {r["user_id"]: r["age"] for r in so.load_social_users(raw, F.lit("2024-01-01").cast("date")).collect()}
    assert out == {1: 24, 2: None}
