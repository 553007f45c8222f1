"""Sources and sinks: staging append, CSV backup round trip, JDBC options,
table replace, catalog listing, streaming staging load."""
import tempfile

from pyspark.sql import functions as F

from helpers import same_rows
from reelhouse.sources import io
from reelhouse.streaming import stage_stream


def _tmp():
    return tempfile.mkdtemp(prefix="reelhouse-test-", dir="/tmp")


def test_stage_append_is_append_only(spark, wh):
    path = _tmp() + "/raw_content"
    io.stage_append(wh.raw.content, path)
    io.stage_append(wh.raw.content, path)
    back = spark.read.parquet(path)
    assert back.count() == 2 * wh.raw.content.count()
    assert "loaded_at" in back.columns and back.filter(F.col("loaded_at").isNull()).count() == 0


def test_csv_roundtrip(spark, wh):
    for table, df in [("raw_users", wh.raw.users), ("raw_subscriptions", wh.raw.subscriptions),
                      ("raw_content", wh.raw.content)]:
        path = _tmp() + "/" + table
        io.write_csv_backup(df, path)
        back = io.read_csv_backup(spark, table, path)
        assert back.schema == df.schema or [f.name for f in back.schema] == df.columns
        assert same_rows(back.collect(), df.collect())[0], table


def test_jdbc_options():
    o = io.jdbc_options("jdbc:mysql://db/warehouse", "raw_viewing_events", user="u", password="p")
    assert o["batchsize"] == "5000" and o["dbtable"] == "raw_viewing_events" and o["user"] == "u"


def test_replace_table_idempotent(spark, wh):
    loc = _tmp()
    for _ in range(2):
        io.replace_table(wh.dim_content, "reel_dim_content_t", path=loc + "/dim_content")
    assert spark.table("reel_dim_content_t").count() == wh.dim_content.count()
    names = {r["table_name"] for r in io.catalog_listing(spark).collect()}
    assert "reel_dim_content_t" in names
    spark.sql("DROP TABLE IF EXISTS reel_dim_content_t")


def test_streaming_stage_once(spark, wh):
    landing, staging, ck = _tmp(), _tmp() + "/out", _tmp() + "/ck"
    wh.raw.users.limit(40).write.mode("overwrite").parquet(landing + "/batch1")
    stage_stream(spark, "raw_users", landing + "/batch1", staging, checkpoint=ck)
    first = spark.read.parquet(staging).count()
    stage_stream(spark, "raw_users", landing + "/batch1", staging, checkpoint=ck)  # nothing new
    assert first == 40 and spark.read.parquet(staging).count() == 40


def test_build_warehouse_writes_partitioned_fact(spark, wh):
    out = _tmp()
    paths = io.build_warehouse(wh, out)
    fact = spark.read.parquet(paths["fact_viewing_events"])
    assert "ym" in fact.columns and fact.count() == wh.fve.count()
    plan = fact.filter(F.col("ym") == "2024-05")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_register_views_and_sql(spark, wh):
    names = wh.register_views()
    assert "mart_user_engagement" in names
    n = spark.sql("SELECT count(*) AS n FROM mart_user_engagement WHERE churn_risk = 'new'").first()["n"]
    assert n == wh.mart_user_engagement.filter(F.col("churn_risk") == "new").count()


def test_write_scores(spark, wh):
    out = _tmp()
    paths = io.write_scores(wh, out)
    recs = spark.read.parquet(paths["recommendations"])
    assert recs.count() > 0 and recs.groupBy("user_id").count().filter("count > 10").count() == 0
    assert spark.read.parquet(paths["dau_forecasts"]).count() > 0


def test_built_warehouse_answers_equal(spark, wh):
    from reelhouse.plans import analytics as A
    from reelhouse.plans.warehouse import BuiltWarehouse, conform
    out = _tmp()
    io.build_warehouse(wh, out)
    built = BuiltWarehouse(spark, out)
    for fn in (A.q2_churn_segments, A.q4_ltv_by_plan, A.q6_cohort_retention, A.q7_original_roi):
        assert same_rows(conform(fn(built)).collect(), conform(fn(wh)).collect())[0], fn.__name__
