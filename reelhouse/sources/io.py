"""Sources and sinks: staging appends with load time, CSV backup and
read-back with declared schemas, JDBC write options, table replace, catalog
listing, and a full warehouse build into a folder of Parquet tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import RAW_SCHEMAS

CSV_BACKUP_TABLES = ("raw_users", "raw_content", "raw_subscriptions", "raw_viewing_events")
JDBC_BATCH_SIZE = 5000


def stage_append(df: DataFrame, path: str) -> DataFrame:
    """Append rows to a staging table with their load time (append-only,
    never rewritten in place). Returns the rows as written."""
    staged = df.withColumn("loaded_at", F.current_timestamp())
    staged.write.mode("append").parquet(path)
    return staged


def write_csv_backup(df: DataFrame, path: str) -> None:
    """CSV with header, UTF-8 (Spark's default encoding)."""
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def read_csv_backup(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Read a CSV backup back with the declared raw schema (never inferred)."""
    return (spark.read.schema(RAW_SCHEMAS[table]).option("header", True)
            .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]").csv(path))


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 batch_size: int = JDBC_BATCH_SIZE) -> dict:
    """Options for ``df.write.format('jdbc')``: batched inserts (5,000 rows per
    batch, one transaction per partition)."""
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_size),
            "isolationLevel": "READ_COMMITTED"}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    return opts


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **kw) -> None:
    df.write.format("jdbc").options(**jdbc_options(url, table, **kw)).mode(mode).save()


def replace_table(df: DataFrame, name: str, path: str | None = None, partition_by=None) -> None:
    """Drop-and-recreate as one overwrite: the table is rebuilt from its
    query each run (idempotent)."""
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def catalog_listing(spark: SparkSession) -> DataFrame:
    """Tables and views of the current catalog with their descriptions."""
    rows = [(t.name, t.tableType, t.description, bool(t.isTemporary)) for t in spark.catalog.listTables()]
    return spark.createDataFrame(rows, "table_name string, table_type string, description string, "
                                       "is_temporary boolean")


def build_warehouse(wh, out_dir: str) -> dict[str, str]:
    """Build the warehouse layer by layer into ``out_dir`` (a shared folder on
    a cluster): raw staging tables first, then dimensions and facts computed
    from the written raw tables, then marts from the written dimensions and
    facts. Each layer reads the previous one back, so lineage is cut at every
    layer and no layer recomputes its inputs. The viewing fact is partitioned
    by month for partition pruning. Every table is a full overwrite, so a
    rerun after a failure is safe. Returns table -> path."""
    from ..plans.warehouse import Warehouse
    from .adapters import RawTables

    spark = wh.spark
    paths: dict[str, str] = {}

    def put(name: str, df: DataFrame, part: str | None = None) -> DataFrame:
        path = f"{out_dir.rstrip('/')}/{name}"
        w = (df.repartition(part) if part else df).write.mode("overwrite")
        if part:
            w = w.partitionBy(part)
        w.parquet(path)
        paths[name] = path
        return spark.read.parquet(path)

    raw = RawTables(users=put("raw_users", wh.raw.users),
                    subscriptions=put("raw_subscriptions", wh.raw.subscriptions),
                    content=put("raw_content", wh.raw.content),
                    viewing_events=put("raw_viewing_events", wh.raw.viewing_events))
    w2 = Warehouse(spark, raw=raw)
    for name in ("dim_date", "dim_device", "dim_users", "dim_content", "fact_subscriptions"):
        w2.__dict__[name] = put(name, getattr(w2, name))
    fact = put("fact_viewing_events",
               w2.fact_viewing_events.withColumn("ym", F.date_format("event_timestamp", "yyyy-MM")), "ym")
    w2.__dict__["fact_viewing_events"] = fact.drop("ym")
    w2.__dict__["fve"] = fact.drop("ym", "session_order").withColumn("event_date", F.to_date("event_timestamp"))
    w2.__dict__["events"] = w2.__dict__["fve"]
    for name in ("mart_user_engagement", "mart_content_performance", "mart_subscription_metrics"):
        put(name, getattr(w2, name))
    return paths


def write_scores(wh, out_dir: str) -> dict[str, str]:
    """Write model outputs back next to the warehouse tables: churn
    probabilities of the random forest for every user, per-series DAU forecasts and every
    user's top-10 recommendations (each a full overwrite)."""
    from ..plans import churn, forecast, recommend
    outputs = {"churn_predictions": churn.churn_rf(wh, everyone=True), "dau_forecasts": forecast.dau_forecast(wh),
               "recommendations": recommend.recommend_topn(wh)}
    paths = {}
    for name, df in outputs.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths
