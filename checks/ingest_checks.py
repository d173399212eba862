"""Reading and writing: pages, record files, nested objects, presets, sinks, the staged run."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from campusgrid.plans.run import run

from campusgrid.session import scratch_dir
from campusgrid.sources import presets as P
from campusgrid.sources import records as R
from campusgrid.sources import sales as L
from campusgrid.sources import sinks as K
from checks.quality_checks import raw
from checks.registry import check
from checks.sql import inst
from checks.tables import INSTRUCTIONS_SQL, ODD_SQL, RAW_SQL, api_records, compared, instructions, odd_records, raw_records, table
from campusgrid.functions.text import quoted, without_prefixes
from campusgrid.schema import PRESETS

# --- pages and record files ------------------------------------------------


def _page_text(spark, sf_dir):
    """One page of JSON per order: two records, or null results for pending orders."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")

    def record(id_, size):
        return F.struct(
            id_.alias("id"),
            F.col("o_orderpriority").alias("school.name"),
            F.col("o_orderstatus").alias("school.state"),
            size.alias("latest.student.size"),
            (F.col("o_totalprice") / 1000000).alias("latest.admissions.admission_rate.overall"),
        )

    both = F.array(
        record(key * 2, F.floor("o_totalprice").cast("string")),
        record(key * 2 + 1, F.lit("n/a")),
    )
    page = F.struct(
        F.struct((key * 2).alias("total"), key.alias("page"), F.lit(100).alias("per_page")).alias(
            "metadata"
        ),
        F.when(F.col("o_orderstatus") != "P", both).alias("results"),
    )
    return orders.select(F.to_json(page, {"ignoreNullFields": "false"}).alias("value"))


PAGED = """
  FROM (SELECT *, unnest([0, 1]) AS i FROM orders WHERE o_orderstatus <> 'P')"""


@check(
    "s1_pages",
    f"""SELECT CAST(o_orderkey * 2 + i AS BIGINT) AS school_id, o_orderpriority AS school_name,
      o_orderstatus AS school_state,
      CASE WHEN i = 0 THEN CAST(floor(o_totalprice) AS BIGINT) END AS student_size,
      o_totalprice / 1000000 AS admission_rate_overall, 'pages' AS _source {PAGED}""",
)
def _(spark, sf_dir):
    records = R.page_records(_page_text(spark, sf_dir), "value")
    return R.records_to_table(records, "pages").select(
        "school_id",
        "school_name",
        "school_state",
        "student_size",
        "admission_rate_overall",
        "_source",
    )


def _landed(spark, sf_dir) -> str:
    """Customers as landed JSON: every line an array of one record."""
    path = f"{scratch_dir(spark)}/landed"
    record = F.struct(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("school.name"),
        F.col("c_mktsegment").alias("school.state"),
        F.col("c_acctbal").alias("latest.admissions.admission_rate.overall"),
    )
    lines = table(spark, sf_dir, "customer").select(F.to_json(F.array(record)).alias("value"))
    lines.write.text(path)
    return path


@check(
    "s2_record_files",
    """SELECT c_custkey AS school_id, c_name AS school_name, c_mktsegment AS school_state,
      c_acctbal AS admission_rate_overall FROM customer""",
)
def _(spark, sf_dir):
    records = R.read_records(spark, _landed(spark, sf_dir))
    return R.records_to_table(records, "files").select(
        "school_id", "school_name", "school_state", "admission_rate_overall"
    )


@check(
    "s3_records_to_table",
    raw(r"""SELECT school_id, school_name, school_state,
      CASE WHEN regexp_matches(trim(student_size, ' '), '^-?[0-9]+(\.0)?$')
        THEN CAST(CAST(trim(student_size, ' ') AS DOUBLE) AS BIGINT) END AS student_size,
      CASE WHEN NOT isnan(admission_rate_overall) THEN admission_rate_overall END
        AS admission_rate_overall,
      completion_rate_overall, 'raw' AS _source FROM raw"""),
)
def _(spark, sf_dir):
    names = {
        "school_id": "id",
        "school_name": "school.name",
        "school_state": "school.state",
        "student_size": "latest.student.size",
        "admission_rate_overall": "latest.admissions.admission_rate.overall",
        "completion_rate_overall": "latest.completion.rate_suppressed.overall",
    }
    records = raw_records(spark, sf_dir).withColumnsRenamed(names)
    return R.records_to_table(records, "raw").drop("_extracted_at")


@check(
    "u2_union_records",
    """SELECT c_custkey AS id, c_name AS name, CAST(NULL AS DOUBLE) AS balance FROM customer
      UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier""",
)
def _(spark, sf_dir):
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    return R.union_records(
        customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")),
        supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")),
    )


def _nested(spark, sf_dir):
    """Customers as nested objects, parsed from JSON text."""
    text = F.to_json(
        F.struct(
            F.col("c_custkey").alias("id"),
            F.struct(
                F.struct(F.col("c_name").alias("name")).alias("school"),
                F.struct(
                    F.struct(F.col("c_acctbal").alias("overall")).alias("admission_rate")
                ).alias("admissions"),
            ).alias("latest"),
            F.array(F.col("c_nationkey"), F.lit(1)).alias("codes"),
        )
    )
    schema = (
        "id bigint, latest struct<school: struct<name: string>, "
        "admissions: struct<admission_rate: struct<overall: double>>>, codes array<int>"
    )
    rows = table(spark, sf_dir, "customer").select(F.from_json(text, schema).alias("r"))
    return rows.select("r.*")


@check(
    "s4_flatten_mapping",
    """SELECT c_custkey AS school_id, c_name AS school_name, c_acctbal AS admission_rate_overall,
      CAST(NULL AS VARCHAR) AS school_city, 'none' AS school_state FROM customer""",
)
def _(spark, sf_dir):
    df = _nested(spark, sf_dir)
    flat = R.flatten_record(
        df,
        {
            "school_id": "id",
            "school_name": ("latest", "school", "name"),
            "admission_rate_overall": "latest.admissions.admission_rate.overall",
            "school_city": ("latest", "school", "city"),
        },
    )
    state = R.value_at(df.schema, "latest.school.state", default="none")
    return flat.withColumn("school_state", state)


@check(
    "s5_normalize",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS admissions_admission_rate_overall,
      [c_nationkey, 1] AS codes FROM customer""",
)
def _(spark, sf_dir):
    flat = R.normalize(_nested(spark, sf_dir))
    return R.short_names(flat)


@check(
    "s5_arrays",
    """SELECT o_orderkey AS id, o_orderstatus AS status, CAST(place AS INTEGER) AS lines_position,
      l_partkey AS lines_part, CAST(k AS INTEGER) AS lines_tags_position,
      CASE WHEN l_partkey IS NOT NULL THEN ['a', 'b'][k + 1] || l_linenumber END AS lines_tags
      FROM orders LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) - 1 AS place,
          unnest([0, 1]) AS k FROM lineitem) l ON l_orderkey = o_orderkey""",
)
def _(spark, sf_dir):
    """Orders with an array of their lines, each with an array of tags, parsed from JSON."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.struct(
            F.col("l_linenumber").alias("n"),
            F.col("l_partkey").alias("part"),
            F.array(*[F.concat(F.lit(t), F.col("l_linenumber").cast("string")) for t in "ab"]).alias("tags"),
        ).alias("line"),
    )
    packed = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    orders = table(spark, sf_dir, "orders").join(packed, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    text = F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), "lines"))
    schema = "id bigint, status string, lines array<struct<n: int, part: bigint, tags: array<string>>>"
    parsed = orders.select(F.from_json(text, schema).alias("r")).select("r.*")
    flat = R.normalize(parsed, "_", explode=("lines", "lines_tags"))
    return flat.drop("lines_n")


@check(
    "f_flatten",
    """SELECT l_orderkey AS id, flatten(list([l_partkey, l_suppkey] ORDER BY l_linenumber, l_partkey, l_suppkey)) AS parts
      FROM lineitem GROUP BY l_orderkey""",
)
def _(spark, sf_dir):
    """Per order a list of one list per line, flattened one level."""
    pair = F.struct("l_linenumber", F.array("l_partkey", "l_suppkey").alias("pair"))
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id"))
    nested = lines.agg(F.array_sort(F.collect_list(pair))["pair"].alias("parts"))
    return R.flatten_lists(nested, ["parts"])


@check(
    "s4_json_path",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
      'absent' AS other FROM events""",
)
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "k bigint").alias("props")
    )
    return events.select(
        "event_id",
        R.value_at(events.schema, "props.k").alias("k"),
        R.value_at(events.schema, "props.z", default="absent").alias("other"),
    )


# --- column groups, filters, presets ---------------------------------------

#: Columns of the institutions that the flat records hold, by field.
HELD = {
    "id": "school_id",
    "school.name": "school_name",
    "school.state": "school_state",
    "school.ownership": "ownership",
    "school.locale": "locale",
    "school.region_id": "region_id",
    "latest.student.size": "student_size",
    "latest.admissions.admission_rate.overall": "admission_rate",
    "latest.completion.rate_suppressed.overall": "completion_rate",
    "latest.cost.tuition.in_state": "tuition_in_state",
    "latest.aid.median_debt.completers.overall": "median_debt",
}
SQL_TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


def fields_sql(*groups: str) -> str:
    """The fields of some groups; those the records lack are typed nulls."""
    return ", ".join(
        f'{HELD.get(f) or f"CAST(NULL AS {SQL_TYPES[P.field_type(f)]})"} AS "{without_prefixes(f)}"'
        for f in P.group_fields(groups)
    )


@check("s6_field_groups", inst(f"SELECT {fields_sql()} FROM inst"))
def _(spark, sf_dir):
    return R.short_names(P.select_fields(api_records(spark, sf_dir)))


@check(
    "s7_row_filters",
    inst("""SELECT school_id AS id, student_size FROM inst
      WHERE school_state = 'NATION_3' AND ownership = 2 AND student_size >= 8000
        AND operating = 1 AND locale = 15 AND school_id % 4 + 1 = 3"""),
)
def _(spark, sf_dir):
    condition = P.row_filter(
        state="NATION_3",
        ownership=2,
        degree=3,
        min_size=8000,
        operating=True,
        equal={"school.locale": 15},
    )
    rows = api_records(spark, sf_dir).filter(condition)
    return R.short_names(rows.select("id", quoted("latest.student.size")))


def _preset(name: str, where: str, **filters) -> None:
    groups, _ = PRESETS[name]

    @check(f"s8_{name}", inst(f"SELECT {fields_sql(*groups)} FROM inst WHERE {where}"))
    def _(spark, sf_dir):
        return R.short_names(P.preset(api_records(spark, sf_dir), name, **filters))


_preset("all_institutions", "true")
_preset("public_universities", "ownership = 1")
_preset("private_nonprofit", "ownership = 2")
_preset("by_state", "school_state = 'NATION_4'", state="NATION_4")
_preset("enrollment_demographics", "true")
_preset("costs_and_aid", "true")
_preset("outcomes_and_earnings", "true")


@check(
    "s8_large_institutions",
    inst(f"SELECT {fields_sql()} FROM inst WHERE student_size >= 10000"),
)
def _(spark, sf_dir):
    return R.short_names(P.large_institutions(api_records(spark, sf_dir)))


@check(
    "s9_count_matching",
    inst("""SELECT count(*) AS matching FROM inst
      WHERE operating = 1 AND school_state = 'NATION_3'"""),
)
def _(spark, sf_dir):
    n = P.count_matching(api_records(spark, sf_dir), state="NATION_3")
    return spark.createDataFrame([(n,)], "matching bigint")


@check(
    "s10_first_pages",
    """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
      ORDER BY o_orderdate, o_orderkey LIMIT 200""",
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return P.first_pages(orders, ["o_orderdate", "o_orderkey"], pages=2)


ODD = f"WITH {RAW_SQL}, {ODD_SQL}"


@check("s14_read_table", f"{ODD} SELECT *, 2::BIGINT AS copies FROM odd")
def _(spark, sf_dir):
    """The same rows out of a Parquet and a text table, both by their ending."""
    rows = odd_records(spark, sf_dir)
    folder = scratch_dir(spark)
    rows.write.parquet(f"{folder}/odd.parquet")
    parquet = R.read_table(spark, f"{folder}/odd.parquet")
    text = R.read_table(spark, K.write_csv(parquet, f"{folder}/odd.csv"))
    both = compared(parquet.unionByName(text))
    return both.groupBy(*both.columns).agg(F.count(F.lit(1)).alias("copies"))


@check(
    "s15_sales_sheets",
    f"""WITH {INSTRUCTIONS_SQL} SELECT * REPLACE (CASE WHEN Qty = 1 THEN '' WHEN Qty <> 2
      THEN 'line' || chr(10) || "Product Name" END AS "Product Name") FROM instructions""",
)
def _(spark, sf_dir):
    """Product names empty, null and over two lines come back through the sheets' own reader."""
    name = quoted("Product Name")
    odd = F.when(F.col("Qty") == 1, "").when(F.col("Qty") != 2, F.concat(F.lit("line\n"), name))
    sheet = instructions(spark, sf_dir).withColumn("Product Name", odd)
    # An instruction is an order, so its hash also picks the orders of a portion before they are shuffled.
    path = K.write_csv(sheet, f"{scratch_dir(spark)}/instructions.csv", compressed=True, portion_by="Instruction ID")
    return L.read_instructions(spark, path)


# --- sinks -----------------------------------------------------------------


@check("k1_raw_json", f"{ODD} SELECT * FROM odd")
def _(spark, sf_dir):
    path = K.write_raw_json(odd_records(spark, sf_dir), scratch_dir(spark), "records")
    return compared(R.read_records(spark, path))


@check("k2_staging", f"{ODD} SELECT *, 2::BIGINT AS copies FROM odd")
def _(spark, sf_dir):
    """The same rows from the Parquet and the CSV copy."""
    parquet, text = K.write_staging(odd_records(spark, sf_dir), scratch_dir(spark), "odd")
    both = compared(R.read_table(spark, parquet).unionByName(R.read_table(spark, text)))
    return both.groupBy(*both.columns).agg(F.count(F.lit(1)).alias("copies"))


@check("k3_processed_csv", f"{ODD} SELECT * FROM odd")
def _(spark, sf_dir):
    path = K.write_processed(odd_records(spark, sf_dir), scratch_dir(spark))
    return compared(R.read_table(spark, path))


@check(
    "k4_load_append",
    """SELECT 'replace' AS mode, 0::BIGINT AS rows_before, count(*) AS rows_after,
      count(*) AS rows_inserted FROM supplier
      UNION ALL SELECT 'append', count(*), 2 * count(*), count(*) FROM supplier""",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier")
    name, path = f"suppliers_{uuid.uuid4().hex}", scratch_dir(spark)
    log = []
    for mode in ("replace", "append"):
        stats = K.load_table(rows, name, mode, path)
        log.append((mode, stats["rows_before"], stats["rows_after"], stats["rows_inserted"]))
    K.drop_table(spark, name)
    return spark.createDataFrame(
        log, "mode string, rows_before bigint, rows_after bigint, rows_inserted bigint"
    )


@check(
    "k5_for_database",
    """SELECT o_orderkey, CAST(o_orderdate AS VARCHAR) AS o_orderdate,
      o_orderstatus, o_totalprice FROM orders""",
)
def _(spark, sf_dir):
    return K.for_database(
        table(spark, sf_dir, "orders").select(
            "o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice"
        )
    )


@check(
    "k6_drop_and_count",
    "SELECT count(*) AS rows, 0::BIGINT AS rows_after_drop FROM customer",
)
def _(spark, sf_dir):
    name = f"customers_{uuid.uuid4().hex}"
    K.load_table(table(spark, sf_dir, "customer"), name, "fail", scratch_dir(spark))
    before = K.table_rows(spark, name)
    K.drop_table(spark, name)
    after = K.table_rows(spark, name)
    return spark.createDataFrame([(before, after)], "rows bigint, rows_after_drop bigint")


# --- the staged run --------------------------------------------------------


def stage(name: str, position: int, before: str, after: str) -> str:
    return f"""SELECT '{name}' AS stage, CAST({position} AS INTEGER) AS position,
      'success' AS status, CAST({before} AS BIGINT) AS records_in,
      CAST({after} AS BIGINT) AS records_out,
      CAST(greatest({before} - {after}, 0) AS BIGINT) AS removed,
      CASE WHEN {before} = 0 THEN 0.0::DOUBLE
        ELSE round(greatest({before} - {after}, 0) * 100.0 / {before}, 6)::DOUBLE END
        AS removed_percent"""


RAW_ROWS = "(SELECT count(*) FROM raw)"
VALID_ROWS = "(SELECT count(*) FROM unique_rows)"


@check(
    "v13_stage_counts",
    raw(
        " UNION ALL ".join(
            [
                stage("extract", 1, "0", RAW_ROWS),
                stage("validate", 2, RAW_ROWS, VALID_ROWS),
                stage("transform", 3, VALID_ROWS, VALID_ROWS),
                stage("load", 4, VALID_ROWS, VALID_ROWS),
            ]
        )
    ),
)
def _(spark, sf_dir):
    """Ids are unique after validation, so the transform finds no equal rows."""
    folder = scratch_dir(spark)
    name = f"institutions_{uuid.uuid4().hex}"
    log = run(
        raw_records(spark, sf_dir), folder, name, ["school_id"], table_path=f"{folder}/table"
    )
    K.drop_table(spark, name)
    return log.drop("batch", "seconds", "error")
