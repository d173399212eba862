"""Survey joins, the sheet relationship, code tables, catalogue, archives, generated rows."""

from __future__ import annotations

import io
import sys
import zipfile

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campusgrid.operators import joins as J
from campusgrid.operators.commits import Files
from campusgrid.schema import REGION_LABELS, SAMPLE_INTEGERS, SAMPLE_STATES, SURVEYS
from campusgrid.session import scratch_dir
from campusgrid.sources import surveys as V
from checks.clean_checks import labels
from checks.registry import check
from checks.sql import inst
from checks.tables import SURVEYS_SQL, institutions, instructions, reimbursements, surveys, table
from checks.workbook_checks import sales

MERGED = f"""WITH {SURVEYS_SQL}
  SELECT UNITID, HD_INSTNM, HD_STABBR, IC_TUITION2, EFFY_EFYTOTLT, SFA_SCUGRAD
  FROM hd FULL JOIN ic USING (UNITID) FULL JOIN effy USING (UNITID) FULL JOIN sfa USING (UNITID)"""


@check("j1_merge_surveys", MERGED)
def _(spark, sf_dir):
    return J.merge_surveys(surveys(spark, sf_dir))


@check("j1_merge_unique_surveys", MERGED)
def _(spark, sf_dir):
    return J.merge_unique_surveys({**surveys(spark, sf_dir), "GR": None})


@check(
    "j1_merge_repeated_keys",
    """SELECT UNITID, l.price AS LI_price, o.status AS OD_status, c.name AS CU_name
      FROM (SELECT l_orderkey AS UNITID, l_extendedprice AS price FROM lineitem) l
      FULL JOIN (SELECT o_custkey AS UNITID, o_orderstatus AS status FROM orders) o USING (UNITID)
      FULL JOIN (SELECT c_custkey + 100 AS UNITID, c_name AS name FROM customer) c USING (UNITID)""",
)
def _(spark, sf_dir):
    lineitem, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    return J.merge_surveys(
        {
            "LI": lineitem.select(
                F.col("l_orderkey").alias("UNITID"), F.col("l_extendedprice").alias("price")
            ),
            "OD": orders.select(
                F.col("o_custkey").alias("UNITID"), F.col("o_orderstatus").alias("status")
            ),
            "CU": customer.select(
                (F.col("c_custkey") + 100).alias("UNITID"), F.col("c_name").alias("name")
            ),
        }
    )


HOT_ORDERS = """SELECT CASE WHEN o_custkey % 3 = 0 THEN 1 ELSE o_custkey END AS UNITID,
        o_orderstatus AS status FROM orders"""


@check(
    "j1_merge_hot_keys",
    f"""SELECT UNITID, o.status AS OD_status, c.segment AS CU_segment FROM ({HOT_ORDERS}) o
      FULL JOIN (SELECT c_custkey AS UNITID, c_mktsegment AS segment FROM customer) c USING (UNITID)""",
)
def _(spark, sf_dir):
    """A third of the orders share one key, with three distinct rows."""
    custkey = F.col("o_custkey")
    orders = table(spark, sf_dir, "orders").select(
        F.when(custkey % 3 == 0, 1).otherwise(custkey).alias("UNITID"),
        F.col("o_orderstatus").alias("status"),
    )
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("UNITID"), F.col("c_mktsegment").alias("segment")
    )
    return J.merge_surveys({"OD": orders, "CU": customer}, split_rows=1000)


@check(
    "j2_hot_ids",
    """SELECT id, l_orderkey, l_linenumber, coalesce(n, 0) AS related
      FROM (SELECT CASE WHEN l_suppkey % 3 = 0 THEN 1 WHEN l_suppkey % 7 <> 0 THEN l_suppkey END AS id,
          l_orderkey, l_linenumber FROM lineitem)
      LEFT JOIN (SELECT o_custkey AS id, count(*) AS n FROM orders GROUP BY ALL) USING (id)""",
)
def _(spark, sf_dir):
    """A third of the rows share one id, others have none."""
    suppkey = F.col("l_suppkey")
    rows = table(spark, sf_dir, "lineitem").select(
        F.when(suppkey % 3 == 0, 1).when(suppkey % 7 != 0, suppkey).alias("id"), "l_orderkey", "l_linenumber"
    )
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"))
    return J.add_related_count(rows, orders, "id", "related", split_rows=1000)


@check(
    "j2_related_counts",
    sales("""SELECT "Row ID", "Instruction ID", "Revenue", coalesce(n, 0) AS reimbursements
      FROM instructions
      LEFT JOIN (SELECT "Instruction ID", count(*) AS n FROM reimbursements GROUP BY ALL)
        USING ("Instruction ID")"""),
)
def _(spark, sf_dir):
    rows = instructions(spark, sf_dir, "Row ID", "Instruction ID", "Revenue")
    return J.add_related_count(
        rows, reimbursements(spark, sf_dir), "Instruction ID", "reimbursements"
    )


@check(
    "j3_region_lookup",
    inst(f"""SELECT school_id, region_id, {labels("region_id", REGION_LABELS)} AS region_label
      FROM inst"""),
)
def _(spark, sf_dir):
    df = institutions(spark, sf_dir, "school_id", "region_id")
    return J.add_label(df, F.col("region_id"), REGION_LABELS, "region_label")


CATALOGUE_ROWS = ", ".join(
    f"('{code}', '{name}', '{frequency}', {len(suffixes)})"
    for code, (name, _, frequency, suffixes) in SURVEYS.items()
)


@check(
    "s12_survey_catalogue",
    f"""WITH {SURVEYS_SQL},
      loaded AS (SELECT 'HD' AS code, count(*) AS rows FROM hd
        UNION ALL SELECT 'IC', count(*) FROM ic UNION ALL SELECT 'EFFY', count(*) FROM effy
        UNION ALL SELECT 'SFA', count(*) FROM sfa)
      SELECT code, name, frequency, CAST(suffixes AS INTEGER) AS suffixes,
        CAST(12 AS INTEGER) AS years, coalesce(rows, 0) AS rows
      FROM (VALUES {CATALOGUE_ROWS}) t(code, name, frequency, suffixes)
      LEFT JOIN loaded USING (code)""",
)
def _(spark, sf_dir):
    """The catalogue with the number of rows each survey has in the tables."""
    counts = None
    for code, df in surveys(spark, sf_dir).items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(code).alias("code"), "rows")
        counts = one if counts is None else counts.unionByName(one)
    known = V.survey_catalogue(spark).select(
        "code",
        "name",
        "frequency",
        F.size("suffixes").alias("suffixes"),
        F.size("years").alias("years"),
    )
    return known.join(counts, "code", "left").withColumn(
        "rows", F.coalesce("rows", F.lit(0))
    )


# --- archives --------------------------------------------------------------


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _zipped(batches):
    """One archive per batch of rows, dealt over two tables, some lines too long."""
    for batch in batches:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("readme.txt", "rows of one batch")
            for k, member in enumerate(("DATA.CSV", "more/second.csv")):
                own = batch[batch["c_custkey"] % 2 == k]
                wrong = "".join(f"{key},too,many,fields,{k}\n" for key in own["c_custkey"] if key % 50 == k)
                archive.writestr(member, (own.to_csv(index=False) + wrong).encode("latin-1"))
        yield pd.DataFrame({"content": [buffer.getvalue()]})


@check(
    "s11_zip_csv",
    f"""SELECT c_custkey, 'é ' || c_name AS c_name, c_acctbal, CAST(c_nationkey AS INTEGER)
      AS c_nationkey, NULL AS member, NULL AS reason, NULL AS text FROM customer
      UNION ALL SELECT NULL, NULL, NULL, NULL,
        CASE WHEN c_custkey % 2 = 0 THEN 'DATA.CSV' ELSE 'more/second.csv' END, '{V.TOO_LONG}',
        c_custkey || ',too,many,fields,' || c_custkey % 2 FROM customer WHERE c_custkey % 50 = c_custkey % 2""",
)
def _(spark, sf_dir):
    """Both outputs of one pass under each other: the rows, and the lines that are none."""
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("é "), "c_name").alias("c_name"), "c_acctbal", "c_nationkey"
    )
    archives = rows.mapInPandas(_zipped, "content binary")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    path = scratch_dir(spark)
    V.read_members(archives, schema).write.parquet(path)
    members = spark.read.parquet(path)
    rejects = V.rejects_of(members).select("member", "reason", "text")
    return V.rows_of(members).unionByName(rejects, allowMissingColumns=True)


def _packed(batches):
    """One archive per batch of rows."""
    for batch in batches:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("rows.csv", batch.to_csv(index=False))
        yield pd.DataFrame({"content": [buffer.getvalue()]})


@check(
    "j1_comprehensive",
    f"""WITH {SURVEYS_SQL}, log AS (
      SELECT 'HD' AS code, count(*) AS rows FROM hd UNION ALL SELECT 'IC', count(*) FROM ic
      UNION ALL SELECT 'EFFY', count(*) FROM effy UNION ALL SELECT 'SFA', count(*) FROM sfa
      UNION ALL SELECT 'GR', 0)
      SELECT UNITID, HD_INSTNM, HD_STABBR, IC_TUITION2, EFFY_EFYTOTLT, SFA_SCUGRAD, NULL AS code,
        NULL AS rows, NULL AS status
      FROM hd FULL JOIN ic USING (UNITID) FULL JOIN effy USING (UNITID) FULL JOIN sfa USING (UNITID)
      UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, code, rows,
        CASE WHEN rows = 0 THEN 'skipped' ELSE 'loaded' END FROM log""",
)
def _(spark, sf_dir):
    """The merged table, and the log under it. There is no archive of survey GR."""
    folder = scratch_dir(spark)
    files, schemas = Files(spark, folder), {}
    for code, df in surveys(spark, sf_dir).items():
        schemas[code] = df.schema
        archives = df.mapInPandas(_packed, "content binary")
        for k, row in enumerate(archives.toLocalIterator()):
            files.write(f"{folder}/{code}2023-{k:05d}.zip", bytes(row["content"]))
    loaded = V.load_comprehensive(spark, folder, 2023, schemas, ("HD", "IC", "EFFY", "SFA", "GR"))
    log = loaded.log.select("code", "rows", "status")
    return loaded.merged.unionByName(log, allowMissingColumns=True)


# --- generated rows --------------------------------------------------------


def draw(seed: int, name: str, low: int, high: int) -> str:
    digits = f"left(md5('{seed}|{name}|' || UNITID), 8)"
    return f"CAST(CAST('0x' || {digits} AS BIGINT) % {high - low} + {low} AS INTEGER)"


STATE_LIST = "[" + ", ".join(f"'{s}'" for s in SAMPLE_STATES) + "]"


def sample_sql(survey: str, year: int) -> str:
    seed = 42 + year
    numbers = ", ".join(
        f'{draw(seed, n, low, high)} AS "{n}"'
        for n, (low, high) in SAMPLE_INTEGERS[survey].items()
    )
    return f"""SELECT UNITID, 'Institution ' || UNITID AS "INSTNM",
      {STATE_LIST}[{draw(seed, "STABBR", 1, 11)}] AS "STABBR",
      {draw(seed, "CONTROL", 1, 4)} AS "CONTROL", {draw(seed, "ICLEVEL", 1, 4)} AS "ICLEVEL",
      {numbers}, CAST({year} AS INTEGER) AS "YEAR"
      FROM (SELECT p_partkey + 100000 AS UNITID FROM part)"""


def _part_keys(spark, sf_dir):
    return table(spark, sf_dir, "part").select((F.col("p_partkey") + 100000).alias("UNITID"))


@check("s13_sample_ic", sample_sql("IC", 2022))
def _(spark, sf_dir):
    return V.sample_survey(_part_keys(spark, sf_dir), "IC", 2022)


@check("s13_sample_effy", sample_sql("EFFY", 2023))
def _(spark, sf_dir):
    return V.sample_survey(_part_keys(spark, sf_dir), "EFFY", 2023)
