"""Versioned datasets: storing real tables, and questions to a catalogue of events."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from campusgrid.operators import snapshots as S
from campusgrid.session import scratch_dir
from campusgrid.sources import sinks as K
from checks.registry import check
from checks.tables import CATALOGUE_SQL, ODD_SQL, RAW_SQL, catalogue, compared, odd_records, table

OLD, NEW, LAST = "20240101_230000", "20240102_010000", "20240301_120000"


def cat(query: str) -> str:
    return f"WITH {CATALOGUE_SQL} {query}"


def _store(spark, sf_dir) -> S.SnapshotStore:
    """Customers in three versions of growing width, parts and orders in one each."""
    store = S.SnapshotStore(spark, scratch_dir(spark))
    customer = table(spark, sf_dir, "customer")
    store.store(customer.select("c_custkey"), "crm", "customer", version=OLD)
    store.store(
        customer.select("c_custkey", "c_name"), "crm", "customer", {"from": "test"}, "csv", NEW
    )
    store.store(customer, "crm", "customer", version=LAST)
    store.store(table(spark, sf_dir, "orders"), "crm", "customer_orders", version=NEW)
    store.store(table(spark, sf_dir, "part"), "erp", "part", version=OLD)
    return store


STORED = f"""(
  SELECT 'crm' AS source, 'customer' AS dataset, '{OLD}' AS version, count(*) AS row_count,
    1 AS column_count, 'parquet' AS file_format FROM customer
  UNION ALL SELECT 'crm', 'customer', '{NEW}', count(*), 2, 'csv' FROM customer
  UNION ALL SELECT 'crm', 'customer', '{LAST}', count(*), 5, 'parquet' FROM customer
  UNION ALL SELECT 'crm', 'customer_orders', '{NEW}', count(*), 6, 'parquet' FROM orders
  UNION ALL SELECT 'erp', 'part', '{OLD}', count(*), 6, 'parquet' FROM part)"""


@check(
    "l1_store",
    f"""SELECT source, dataset, version, row_count, CAST(column_count AS INTEGER) AS column_count,
      file_format FROM {STORED}""",
)
def _(spark, sf_dir):
    return _store(spark, sf_dir).catalogue().select(
        "source", "dataset", "version", "row_count", "column_count", "file_format"
    )


@check("l1_text_version", f"WITH {RAW_SQL}, {ODD_SQL} SELECT * FROM odd")
def _(spark, sf_dir):
    store = S.SnapshotStore(spark, scratch_dir(spark))
    store.store(odd_records(spark, sf_dir), "landed", "odd", file_format="csv")
    return compared(store.load_latest("landed", "odd"))


@check(
    "l1_compacted",
    f"""SELECT source, dataset, version, row_count, true AS reachable FROM {STORED}
      UNION ALL SELECT 'erp', 'part', '{LAST}', count(*), true FROM part WHERE p_size > 25""",
)
def _(spark, sf_dir):
    """Every version is found and opened after the catalogue became one table, and later ones too."""
    store = _store(spark, sf_dir)
    store.compact_catalogue()
    store.store(table(spark, sf_dir, "part").filter("p_size > 25"), "erp", "part", version=LAST)
    opened = S.SnapshotStore(spark, store.root)
    listed = opened.catalogue().select("source", "dataset", "version", "row_count")
    parts = [
        opened.load_version(r.source, r.dataset, r.version)
        .agg((F.count(F.lit(1)) == r.row_count).alias("reachable"))
        .withColumn("_key", F.lit(f"{r.source}/{r.dataset}/{r.version}"))
        for r in listed.collect()
    ]
    sizes = reduce(DataFrame.unionByName, parts)
    return listed.join(sizes, F.concat_ws("/", "source", "dataset", "version") == F.col("_key")).drop("_key")


@check(
    "l11_same_content",
    f"""SELECT '{OLD}' AS version, 1 AS kept, count(*) AS row_count FROM orders
      UNION ALL SELECT '{NEW}', 1, count(*) FROM orders
      UNION ALL SELECT '{LAST}', 2, count(*) FROM orders WHERE o_orderstatus <> 'F'""",
)
def _(spark, sf_dir):
    """Equal rows in another order are kept once; `kept` numbers the places of the data."""
    store, rows = S.SnapshotStore(spark, scratch_dir(spark)), table(spark, sf_dir, "orders")
    for version, df in (
        (OLD, rows),
        (NEW, rows.orderBy(F.desc("o_totalprice"))),
        (LAST, rows.filter("o_orderstatus <> 'F'")),
    ):
        store.store(df, "erp", "orders", version=version, share=True)
    place = F.dense_rank().over(Window.partitionBy("source", "dataset").orderBy("first"))
    first = F.min("version").over(Window.partitionBy("location"))
    found = store.catalogue().withColumn("first", first).withColumn("kept", place)
    return found.select("version", "kept", "row_count")


@check("l2_load_latest", "SELECT * FROM customer")
def _(spark, sf_dir):
    return _store(spark, sf_dir).load_latest("crm", "customer")


@check("l3_load_version", "SELECT c_custkey, c_name FROM customer")
def _(spark, sf_dir):
    return _store(spark, sf_dir).load_version("crm", "customer", NEW)


@check("l4_load_as_of", "SELECT c_custkey FROM customer")
def _(spark, sf_dir):
    return _store(spark, sf_dir).load_as_of("crm", "customer", "20240102_005959")


@check(
    "l6_metadata",
    f"""SELECT '{NEW}' AS version, count(*) AS row_count, 'c_custkey,c_name' AS columns,
      'string' AS name_type, 'test' AS origin FROM customer""",
)
def _(spark, sf_dir):
    rows = S.metadata(_store(spark, sf_dir).catalogue(), "crm", "customer", NEW)
    return rows.select(
        "version",
        "row_count",
        F.concat_ws(",", "columns").alias("columns"),
        F.col("dtypes")["c_name"].alias("name_type"),
        F.col("params")["from"].alias("origin"),
    )


# --- a catalogue that grows with the events --------------------------------


@check(
    "l2_latest_versions",
    cat("""SELECT * FROM catalogue
      QUALIFY row_number() OVER (PARTITION BY source, dataset ORDER BY version DESC) = 1"""),
)
def _(spark, sf_dir):
    return S.latest_versions(catalogue(spark, sf_dir))


@check(
    "l4_versions_as_of",
    cat("""SELECT * FROM catalogue WHERE version <= '20240110_000000'
      QUALIFY row_number() OVER (PARTITION BY source, dataset ORDER BY version DESC) = 1"""),
)
def _(spark, sf_dir):
    return S.latest_versions(catalogue(spark, sf_dir), "20240110_000000")


@check("l5_sources", cat("SELECT DISTINCT source FROM catalogue"))
def _(spark, sf_dir):
    return S.sources(catalogue(spark, sf_dir))


@check(
    "l5_datasets",
    cat("""SELECT source, dataset, count(*) AS versions, max(version) AS latest
      FROM catalogue GROUP BY source, dataset"""),
)
def _(spark, sf_dir):
    return S.datasets(catalogue(spark, sf_dir))


@check(
    "l5_versions",
    cat("SELECT * FROM catalogue WHERE source = 'click' AND dataset = 'set_8'"),
)
def _(spark, sf_dir):
    return S.versions(catalogue(spark, sf_dir), "click", "set_8")


def _newest(n: int) -> str:
    return cat(f"""SELECT * FROM catalogue
      QUALIFY row_number() OVER (PARTITION BY source, dataset ORDER BY version DESC) <= {n}""")


@check("l7_newest_versions", _newest(3))
def _(spark, sf_dir):
    return S.newest(catalogue(spark, sf_dir), 3)


@check("l7_newest_2000", _newest(2000))
def _(spark, sf_dir):
    return S.newest(catalogue(spark, sf_dir), 2000)


@check(
    "l8_expired_by_count",
    cat("""SELECT * FROM catalogue
      QUALIFY row_number() OVER (PARTITION BY source, dataset ORDER BY version DESC) > 10"""),
)
def _(spark, sf_dir):
    return S.expired_by_count(catalogue(spark, sf_dir))


@check("l9_expired_by_age", cat("SELECT * FROM catalogue WHERE version < '20240115_000000'"))
def _(spark, sf_dir):
    now = datetime(2024, 4, 14, tzinfo=timezone.utc)
    return S.expired_by_age(catalogue(spark, sf_dir), 90, now)


@check(
    "l10_summary",
    cat("""SELECT count(DISTINCT source) AS total_sources,
      count(DISTINCT source || '/' || dataset) AS total_datasets,
      count(*) AS total_versions, max(version) AS latest_version FROM catalogue"""),
)
def _(spark, sf_dir):
    return S.summary(catalogue(spark, sf_dir))


@check(
    "f_stamp",
    cat("""SELECT version, strftime(strptime(left(version, 15), '%Y%m%d_%H%M%S'), '%Y-%m-%d %H:%M:%S') AS at,
      CAST(NULL AS VARCHAR) AS none FROM catalogue"""),
)
def _(spark, sf_dir):
    at = [F.date_format(S.as_stamp(c), "yyyy-MM-dd HH:mm:ss") for c in (F.col("version"), F.col("dataset"))]
    return catalogue(spark, sf_dir).select("version", at[0].alias("at"), at[1].alias("none"))


@check(
    "v15_latest_layers",
    """SELECT 'raw' AS layer, 'orders_20240301_120000.json' AS name, '2024-03-01 12:00:00' AS at,
      count(*) AS rows, 6 AS columns FROM orders WHERE o_orderkey % 2 = 0
      UNION ALL SELECT 'staging', 'orders_20240102_010000.csv', '2024-01-02 01:00:00', count(*), 2 FROM orders
      UNION ALL SELECT 'processed', 'clean_2024_03_02_000001.csv', '2024-03-02 00:00:01', count(*), 5 FROM customer""",
)
def _(spark, sf_dir):
    """Each layer holds an older table too, the raw one also a name that sorts behind all others."""
    root = scratch_dir(spark)
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    layers = {layer: f"{root}/{layer}" for layer in ("raw", "staging", "processed")}
    K.write_raw_json(orders, layers["raw"], "orders", OLD)
    K.write_raw_json(orders.filter("o_orderkey % 2 = 0"), layers["raw"], "orders", LAST)
    K.write_raw_json(orders, layers["raw"], "second", OLD)
    K.write_staging(orders.select("o_orderkey", "o_orderdate"), layers["staging"], "orders", NEW)
    K.write_staging(orders, layers["staging"], "orders", OLD)
    K.write_processed(customer, layers["processed"], "clean", "2024_03_02_000001")
    K.write_processed(customer.limit(1), layers["processed"], "clean", "2024_03_01_235959")
    report = S.latest_layer_report(spark, layers, {"staging": ".csv"})
    return report.withColumn("at", F.date_format("at", "yyyy-MM-dd HH:mm:ss"))
