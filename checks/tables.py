"""Driver tables seen as institutions, raw records, surveys and sales sheets.

Each function takes the columns a query needs and joins only the tables those
come from. Lookup tables are joined without a hint: whether one is small enough
to broadcast is decided from its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from campusgrid.functions.classes import size_category
from campusgrid.functions.text import quoted
from campusgrid.schema import INSTITUTION

ALL = tuple(INSTITUTION.names)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _part(spark, sf_dir, df: DataFrame) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return df.join(part, df["l_partkey"] == part["p_partkey"], "left")


def _orders(spark, sf_dir, df: DataFrame) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return df.join(orders, df["l_orderkey"] == orders["o_orderkey"], "left")


def _supplier(spark, sf_dir, df: DataFrame) -> DataFrame:
    """Suppliers with their nation: joined to each other first, so that the large
    side moves once."""
    supplier = _nation(spark, sf_dir, table(spark, sf_dir, "supplier"), "s_nationkey")
    return df.join(supplier, df["l_suppkey"] == supplier["s_suppkey"], "left")


def _nation(spark, sf_dir, df: DataFrame, key: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return df.join(nation, df[key] == nation["n_nationkey"], "left")


def _clients(spark, sf_dir, df: DataFrame, region: bool) -> DataFrame:
    """Orders with their customer, its nation and region, joined small to large."""
    customer = _nation(spark, sf_dir, table(spark, sf_dir, "customer"), "c_nationkey")
    if region:
        regions = table(spark, sf_dir, "region")
        customer = customer.join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    orders = table(spark, sf_dir, "orders")
    orders = orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "left")
    return df.join(orders, df["l_orderkey"] == orders["o_orderkey"], "left")


def _four_places(col: Column) -> Column:
    """Rounded to four places with plain arithmetic; `round` goes through BigDecimal."""
    return F.floor(col * 10000 + 0.5) / F.lit(10000.0)


# --- institutions: one row per lineitem ------------------------------------


def institutions(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    columns = columns or ALL
    df = table(spark, sf_dir, "lineitem")
    if {"school_name", "earnings_10yr_median"} & set(columns):
        df = _part(spark, sf_dir, df)
    if "school_city" in columns:
        df = _orders(spark, sf_dir, df)
    if "school_state" in columns:
        df = _supplier(spark, sf_dir, df)
    line, flag, status = F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_linestatus")
    size = F.when(
        ~((flag == "R") & (line == 1)), F.floor(F.col("l_extendedprice") / 4).cast("double")
    )
    admission = F.when(flag != "A", _four_places(F.col("l_discount") * 10))
    completion = F.when(~((status == "O") & (line == 2)), _four_places(F.col("l_tax") * 12.5))
    expressions = {
        "school_id": F.col("l_orderkey") * 10 + line,
        "school_name": F.col("p_name") if "p_name" in df.columns else None,
        "school_city": F.col("o_orderpriority") if "o_orderpriority" in df.columns else None,
        "school_state": F.col("n_name") if "n_name" in df.columns else None,
        "school_zip": F.lpad((F.col("l_partkey") % 100000).cast("string"), 5, "0"),
        "school_url": F.concat(F.lit("www.inst"), F.col("l_suppkey").cast("string"), F.lit(".edu")),
        "latitude": 25 + F.col("l_quantity") * 0.5,
        "longitude": (-60 - F.col("l_suppkey") % 60).cast("double"),
        "ownership": F.when(line != 7, 1 + line % 3),
        "region_id": (F.col("l_suppkey") % 12).cast("int"),
        "locale": 11 + line,
        "operating": F.when(status == "O", 1).otherwise(0),
        "student_size": size,
        "grad_students": F.when(line > 4, F.floor(F.col("l_quantity") * 10).cast("double")),
        "size_category": size_category(size),
        "admission_rate": admission,
        "admission_rate_percentage": admission * 100,
        "completion_rate": completion,
        "completion_rate_percentage": completion * 100,
        "completion_rate_4yr": F.when(line % 3 == 0, _four_places(F.col("l_tax") * 10)),
        "tuition_in_state": F.when(line != 3, F.floor("l_extendedprice").cast("double")),
        "tuition_out_of_state": F.when(
            line != 3, F.floor(F.col("l_extendedprice") * (1 + F.col("l_tax"))).cast("double")
        ),
        "median_debt": F.when(F.col("l_quantity") == 1, 0.0).otherwise(F.col("l_quantity") * 1000),
        "earnings_10yr_median": F.floor(F.col("p_retailprice") * 50).cast("double")
        if "p_retailprice" in df.columns
        else None,
        "extracted_at": F.col("l_shipdate"),
        "source": F.lit("lineitem"),
    }
    return df.select(*[expressions[c].alias(c) for c in columns])


INSTITUTIONS_SQL = """
inst0 AS (
  SELECT l_orderkey * 10 + l_linenumber AS school_id,
    p_name AS school_name, o_orderpriority AS school_city, n_name AS school_state,
    lpad(CAST(l_partkey % 100000 AS VARCHAR), 5, '0') AS school_zip,
    'www.inst' || l_suppkey || '.edu' AS school_url,
    25 + l_quantity * 0.5 AS latitude,
    CAST(-60 - l_suppkey % 60 AS DOUBLE) AS longitude,
    CASE WHEN l_linenumber <> 7 THEN CAST(1 + l_linenumber % 3 AS INTEGER) END AS ownership,
    CAST(l_suppkey % 12 AS INTEGER) AS region_id,
    CAST(11 + l_linenumber AS INTEGER) AS locale,
    CAST(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS INTEGER) AS operating,
    CASE WHEN NOT (l_returnflag = 'R' AND l_linenumber = 1)
      THEN CAST(floor(l_extendedprice / 4) AS DOUBLE) END AS student_size,
    CASE WHEN l_linenumber > 4 THEN CAST(floor(l_quantity * 10) AS DOUBLE) END AS grad_students,
    CASE WHEN l_returnflag <> 'A' THEN floor((l_discount * 10) * 10000 + 0.5) / 10000 END AS admission_rate,
    CASE WHEN NOT (l_linestatus = 'O' AND l_linenumber = 2)
      THEN floor((l_tax * 12.5) * 10000 + 0.5) / 10000 END AS completion_rate,
    CASE WHEN l_linenumber % 3 = 0 THEN floor((l_tax * 10) * 10000 + 0.5) / 10000 END AS completion_rate_4yr,
    CASE WHEN l_linenumber <> 3 THEN CAST(floor(l_extendedprice) AS DOUBLE) END AS tuition_in_state,
    CASE WHEN l_linenumber <> 3
      THEN CAST(floor(l_extendedprice * (1 + l_tax)) AS DOUBLE) END AS tuition_out_of_state,
    CASE WHEN l_quantity = 1 THEN 0.0::DOUBLE ELSE l_quantity * 1000 END AS median_debt,
    CAST(floor(p_retailprice * 50) AS DOUBLE) AS earnings_10yr_median,
    l_shipdate AS extracted_at, 'lineitem' AS source
  FROM lineitem
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN nation ON s_nationkey = n_nationkey),
inst AS (
  SELECT *, admission_rate * 100 AS admission_rate_percentage,
    completion_rate * 100 AS completion_rate_percentage,
    CASE WHEN student_size < 5000 THEN 'small' WHEN student_size <= 15000 THEN 'medium'
      WHEN student_size > 15000 THEN 'large' END AS size_category
  FROM inst0)
"""

# --- raw records: the same rows with dirt in them --------------------------

RAW = (
    "school_id",
    "school_name",
    "school_state",
    "student_size",
    "admission_rate_overall",
    "completion_rate_overall",
)


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blanks around names, spelled-out nulls, numbers as odd text, rates out of range, NaN."""
    df = _supplier(spark, sf_dir, _part(spark, sf_dir, table(spark, sf_dir, "lineitem")))
    line, quantity = F.col("l_linenumber"), F.col("l_quantity")
    name = F.col("p_name")
    # Each value is built once between a prefix and a suffix, which keeps the
    # generated code small.
    lower = F.when(line == 2, 32).otherwise(0)
    state = F.concat(
        F.char(F.lit(ord("N")) + lower),
        F.char(65 + F.col("s_nationkey") + lower),
        F.when(quantity == 12, "X").when(line == 2, " ").otherwise(""),
    )
    size = F.concat(
        F.when(line == 7, "-").when(line == 5, " ").otherwise(""),
        F.floor(F.col("l_extendedprice") / 4).cast("string"),
        F.when(line == 4, "d").when(line == 5, " ").when(line == 6, ".0").otherwise(""),
    )
    return df.select(
        (F.col("l_orderkey") * 10 + line).alias("school_id"),
        F.when(quantity == 9, None)
        .when(quantity == 7, "nan")
        .when(line == 1, F.concat(F.lit(" "), name, F.lit("\t\n")))
        .otherwise(name)
        .alias("school_name"),
        F.when(quantity == 11, "None").otherwise(state).alias("school_state"),
        F.when(~((F.col("l_returnflag") == "R") & (line == 1)), size).alias("student_size"),
        F.when(quantity == 13, F.lit(float("nan")))
        .when(F.col("l_returnflag") != "A", _four_places(F.col("l_discount") * 12))
        .alias("admission_rate_overall"),
        _four_places(F.col("l_tax") * 12.5 - 0.1).alias("completion_rate_overall"),
    )


def odd_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw rows, with texts and stamps that text files easily lose."""
    key = F.col("school_id")
    note = (
        F.when(key % 5 == 0, "")
        .when(key % 5 == 1, None)
        .when(key % 5 == 2, 'a\r\nb\\N,"')
        .when(key % 5 == 3, "\\N")
        .otherwise(" \\n ")
    )
    seen = F.timestamp_micros(key * 1_000_003)
    return raw_records(spark, sf_dir).withColumns({"note": note, "seen": seen})


def compared(odd: DataFrame) -> DataFrame:
    """The odd rows as values that compare alike everywhere: NaN told by a column of its own,
    stamps in microseconds."""
    rate = F.col("admission_rate_overall")
    return odd.withColumns(
        {
            "not_a_number": F.coalesce(F.isnan(rate), F.lit(False)),
            "admission_rate_overall": F.when(~F.isnan(rate), rate),
            "seen": F.unix_micros("seen"),
        }
    )


# Outer blanks that occur in the raw rows.
SQL_BLANKS = "' ' || chr(9) || chr(10)"
SQL_NUMBER = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$'"

RAW_SQL = f"""
raw AS (
  SELECT l_orderkey * 10 + l_linenumber AS school_id,
    CASE WHEN l_quantity = 9 THEN NULL WHEN l_quantity = 7 THEN 'nan'
      WHEN l_linenumber = 1 THEN ' ' || p_name || chr(9) || chr(10) ELSE p_name END AS school_name,
    CASE WHEN l_quantity = 11 THEN 'None'
      WHEN l_quantity = 12 AND l_linenumber = 2 THEN lower('N' || chr(65 + s_nationkey)) || 'X'
      WHEN l_quantity = 12 THEN 'N' || chr(65 + s_nationkey) || 'X'
      WHEN l_linenumber = 2 THEN lower('N' || chr(65 + s_nationkey)) || ' '
      ELSE 'N' || chr(65 + s_nationkey) END AS school_state,
    CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN NULL
      WHEN l_linenumber = 4 THEN CAST(floor(l_extendedprice / 4) AS BIGINT) || 'd'
      WHEN l_linenumber = 5 THEN ' ' || CAST(floor(l_extendedprice / 4) AS BIGINT) || ' '
      WHEN l_linenumber = 6 THEN CAST(floor(l_extendedprice / 4) AS BIGINT) || '.0'
      WHEN l_linenumber = 7 THEN '-' || CAST(floor(l_extendedprice / 4) AS BIGINT)
      ELSE CAST(CAST(floor(l_extendedprice / 4) AS BIGINT) AS VARCHAR) END AS student_size,
    CASE WHEN l_quantity = 13 THEN 'NaN'::DOUBLE
      WHEN l_returnflag <> 'A' THEN floor((l_discount * 12) * 10000 + 0.5) / 10000 END AS admission_rate_overall,
    floor((l_tax * 12.5 - 0.1) * 10000 + 0.5) / 10000 AS completion_rate_overall
  FROM lineitem
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey),
coerced AS (
  SELECT school_id, school_name, school_state,
    CASE WHEN regexp_matches(trim(student_size, {SQL_BLANKS}), {SQL_NUMBER})
      THEN TRY_CAST(trim(student_size, {SQL_BLANKS}) AS DOUBLE) END AS student_size,
    CASE WHEN NOT isnan(admission_rate_overall) THEN admission_rate_overall END
      AS admission_rate_overall,
    completion_rate_overall
  FROM raw),
flagged AS (
  SELECT *, coalesce(admission_rate_overall < 0 OR admission_rate_overall > 1, FALSE)
    OR coalesce(completion_rate_overall < 0 OR completion_rate_overall > 1, FALSE)
    OR coalesce(student_size < 0, FALSE) AS out_of_range
  FROM coerced),
ranged AS (SELECT * EXCLUDE (out_of_range) FROM flagged WHERE NOT out_of_range),
unique_rows AS (
  SELECT * FROM ranged QUALIFY row_number() OVER (
    PARTITION BY school_name, school_state
    ORDER BY school_id, student_size NULLS FIRST, admission_rate_overall NULLS FIRST,
      completion_rate_overall NULLS FIRST, school_name NULLS FIRST, school_state NULLS FIRST) = 1)
"""

# --- surveys: suppliers and parts as institutions --------------------------


def surveys(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Four surveys whose keys only overlap in part."""
    part = table(spark, sf_dir, "part")
    supplier = table(spark, sf_dir, "supplier")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return {
        "HD": part.select(
            F.col("p_partkey").alias("UNITID"),
            F.col("p_name").alias("INSTNM"),
            F.col("p_brand").alias("STABBR"),
        ),
        "IC": customer.select(
            (F.col("c_custkey") * 2).alias("UNITID"), F.col("c_acctbal").alias("TUITION2")
        ),
        "EFFY": supplier.select(
            (F.col("s_suppkey") * 3 + 1).alias("UNITID"), F.col("s_nationkey").alias("EFYTOTLT")
        ),
        "SFA": nation.select(
            F.col("n_nationkey").cast("bigint").alias("UNITID"), F.col("n_name").alias("SCUGRAD")
        ),
    }


SURVEYS_SQL = """
hd AS (SELECT p_partkey AS UNITID, p_name AS HD_INSTNM, p_brand AS HD_STABBR FROM part),
ic AS (SELECT c_custkey * 2 AS UNITID, c_acctbal AS IC_TUITION2 FROM customer),
effy AS (SELECT s_suppkey * 3 + 1 AS UNITID, s_nationkey AS EFFY_EFYTOTLT FROM supplier),
sfa AS (SELECT CAST(n_nationkey AS BIGINT) AS UNITID, n_name AS SFA_SCUGRAD FROM nation)
"""

# --- sales sheets: lineitems as instructions -------------------------------


def instructions(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One instruction row per lineitem, joined with what the columns need."""
    df = table(spark, sf_dir, "lineitem")
    wanted = set(columns)
    everything = not columns
    if everything or wanted & {"Group", "Sub-Group", "Product Name"}:
        df = _part(spark, sf_dir, df)
    client = {"State or Province", "Postal Code", "Region", "Client Name", "Section", "Client ID"}
    if everything or wanted & client:
        df = _clients(spark, sf_dir, df, everything or "Region" in wanted)
    elif "Instruction Date" in wanted:
        df = _orders(spark, sf_dir, df)

    def has(name: str, make):
        return make() if name in df.columns else None

    expressions = {
        "Row ID": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        "Instruction ID": F.col("l_orderkey").cast("string"),
        "Instruction Date": has("o_orderdate", lambda: F.col("o_orderdate").cast("date")),
        "Transport Date": F.date_format("l_shipdate", "yyyyMMdd").cast("int"),
        "Transport Mode": F.col("l_linestatus"),
        "Client ID": has("c_custkey", lambda: F.col("c_custkey").cast("string")),
        "Client Name": has("c_name", lambda: F.col("c_name")),
        "Section": has("c_mktsegment", lambda: F.col("c_mktsegment")),
        "Nation": F.lit("United States"),
        "Town": F.concat(F.lit("Town, "), F.col("l_suppkey").cast("string")),
        "State or Province": has(
            "n_name",
            lambda: F.when(F.col("n_nationkey") % 5 == 0, F.concat(F.lit("New "), F.col("n_name")))
            .when(F.col("n_nationkey") != 7, F.col("n_name")),
        ),
        "Postal Code": has("c_custkey", lambda: (F.col("c_custkey") % 100000).cast("int")),
        "Region": has("r_name", lambda: F.col("r_name")),
        "Product ID": F.col("l_partkey").cast("string"),
        "Group": has(
            "p_type",
            lambda: F.when(F.col("p_type").isin("ECONOMY", "LARGE"), "Furniture")
            .when(F.col("p_type").isin("MEDIUM", "SMALL"), "Office Supplies")
            .otherwise("Technology"),
        ),
        "Sub-Group": has("p_brand", lambda: F.col("p_brand")),
        "Product Name": has("p_name", lambda: F.col("p_name")),
        "Revenue": F.col("l_extendedprice"),
        "Qty": F.col("l_quantity").cast("int"),
        "Reduction": F.col("l_discount"),
        "Turnover": F.col("l_extendedprice") * (1 - F.col("l_discount")),
    }
    return df.select(*[expressions[c].alias(c) for c in (columns or expressions)])


def reimbursements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reimbursement per returned lineitem; an instruction may have several."""
    returned = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    return returned.select(
        F.lit("Yes").alias("Reimbursed"), F.col("l_orderkey").cast("string").alias("Instruction ID")
    )


INSTRUCTIONS_SQL = """
instructions AS (
  SELECT l_orderkey * 10 + l_linenumber AS "Row ID",
    CAST(l_orderkey AS VARCHAR) AS "Instruction ID",
    CAST(o_orderdate AS DATE) AS "Instruction Date",
    CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS "Transport Date",
    l_linestatus AS "Transport Mode",
    CAST(c_custkey AS VARCHAR) AS "Client ID", c_name AS "Client Name", c_mktsegment AS "Section",
    'United States' AS "Nation", 'Town, ' || l_suppkey AS "Town",
    CASE WHEN n_nationkey % 5 = 0 THEN 'New ' || n_name WHEN n_nationkey <> 7 THEN n_name END
      AS "State or Province",
    CAST(c_custkey % 100000 AS INTEGER) AS "Postal Code", r_name AS "Region",
    CAST(l_partkey AS VARCHAR) AS "Product ID",
    CASE WHEN p_type IN ('ECONOMY', 'LARGE') THEN 'Furniture'
      WHEN p_type IN ('MEDIUM', 'SMALL') THEN 'Office Supplies' ELSE 'Technology' END AS "Group",
    p_brand AS "Sub-Group", p_name AS "Product Name", l_extendedprice AS "Revenue",
    CAST(l_quantity AS INTEGER) AS "Qty", l_discount AS "Reduction",
    l_extendedprice * (1 - l_discount) AS "Turnover"
  FROM lineitem
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey),
reimbursements AS (
  SELECT 'Yes' AS "Reimbursed", CAST(l_orderkey AS VARCHAR) AS "Instruction ID"
  FROM lineitem WHERE l_returnflag = 'R')
"""

# --- catalogue: events as stored versions ----------------------------------


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event seen as one stored version of a dataset."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("event_type").alias("source"),
        F.concat(F.lit("set_"), F.col("user_id").cast("string")).alias("dataset"),
        F.concat(
            F.date_format("ts", "yyyyMMdd_HHmmss"), F.lit("_"), F.col("event_id").cast("string")
        ).alias("version"),
        F.get_json_object("props", "$.k").cast("bigint").alias("row_count"),
    )


CATALOGUE_SQL = """
catalogue AS (
  SELECT event_type AS source, 'set_' || user_id AS dataset,
    strftime(ts, '%Y%m%d_%H%M%S') || '_' || event_id AS version,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS row_count
  FROM events)
"""


def api_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat records with dotted field names, all values typed."""
    df = institutions(
        spark,
        sf_dir,
        "school_id",
        "school_name",
        "school_state",
        "ownership",
        "region_id",
        "locale",
        "operating",
        "student_size",
        "admission_rate",
        "completion_rate",
        "tuition_in_state",
        "median_debt",
    )
    names = {
        "id": "school_id",
        "school.name": "school_name",
        "school.state": "school_state",
        "school.ownership": "ownership",
        "school.region_id": "region_id",
        "school.locale": "locale",
        "school.operating": "operating",
        "latest.student.size": "student_size",
        "latest.admissions.admission_rate.overall": "admission_rate",
        "latest.completion.rate_suppressed.overall": "completion_rate",
        "latest.cost.tuition.in_state": "tuition_in_state",
        "latest.aid.median_debt.completers.overall": "median_debt",
    }
    degree = (F.col("school_id") % 4 + 1).cast("int").alias("school.degrees_awarded.predominant")
    return df.select(*[quoted(column).alias(field) for field, column in names.items()], degree)

# `compared(odd_records())`; follows RAW_SQL.
ODD_SQL = r"""
odd AS (
  SELECT school_id, school_name, school_state, student_size, completion_rate_overall,
    coalesce(isnan(admission_rate_overall), false) AS not_a_number,
    CASE WHEN NOT isnan(admission_rate_overall) THEN admission_rate_overall END AS admission_rate_overall,
    CASE school_id % 5 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'a' || chr(13) || chr(10) || 'b\N,"'
      WHEN 3 THEN '\N' ELSE ' \n ' END AS note,
    school_id * 1000003 AS seen
  FROM raw)"""
