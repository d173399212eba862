"""Landed records to typed tables: pages, record files, nested objects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campusgrid.functions.classes import code_label
from campusgrid.functions.numbers import to_double, to_long
from campusgrid.functions.text import (
    field_column_name,
    quoted,
    repeated,
    without_prefixes,
)
from campusgrid.schema import (
    EXTENDED_FIELD_TO_COLUMN,
    EXTENDED_FLOAT_COLUMNS,
    EXTENDED_INTEGER_COLUMNS,
    FIELD_TO_COLUMN,
    FLOAT_COLUMNS,
    INTEGER_COLUMNS,
    OWNERSHIP_LABELS,
    PAGE,
    PRIORITY_COLUMNS,
    RECORD,
    REGION_LABELS,
    STRING_COLUMNS,
)
from campusgrid.sources import codec

# --- reading ---------------------------------------------------------------

#: CSV of other origin: quotes doubled, outer blanks kept.
FOREIGN_CSV = {k: codec.OPTIONS[k] for k in ("header", "escape", "ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace")}


def read_pages(spark: SparkSession, path: str, schema: T.StructType = PAGE) -> DataFrame:
    """Records of landed page files, one JSON document per file."""
    pages = spark.read.text(path, wholetext=True)
    return page_records(pages, "value", schema)


def page_records(pages: DataFrame, column: str, schema: T.StructType = PAGE) -> DataFrame:
    """Records of pages held as JSON text.

    `results: null` and `results: []` give no rows; a page without the key, or
    that is no JSON object, fails the job, and so does a record or a `results` of
    another shape, so that a broken page is not taken for the end of the data.
    """
    text = F.col(column)
    # Only the results are parsed, strictly: a broken record fails the job, odd metadata does not.
    wanted = T.StructType([schema["results"]])
    results = F.when(
        F.array_contains(F.json_object_keys(text), "results"),
        F.from_json(text, wanted, {"mode": "FAILFAST"})["results"],
    ).otherwise(F.raise_error(F.concat(F.lit("page without results: "), F.left(text, F.lit(200)))))
    return pages.select(F.explode(results).alias("record")).select("record.*")


def union_records(*parts: DataFrame) -> DataFrame:
    """Rows of several extracts under each other; columns one lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_records(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Records from JSON files: one record or one array per line.

    Without a schema, the types are those beside the data (`write_raw_json`), or else
    those of landed records. A pretty-printed array over many lines needs `multi_line`;
    such a file cannot be split, so land large dumps as lines.
    """
    own = None if schema else codec.read_schema(spark, path)
    options = codec.STAMPS if own else {}
    reader = spark.read.options(**options).schema(schema or own or RECORD)
    return reader.json(path, multiLine=multi_line, mode="FAILFAST")


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """A Parquet or CSV table, chosen by the ending of the path.

    Text that this library wrote comes back as it was, with its types; `schema` then picks
    columns of it by name. Give the schema for other large CSV input; without it the file
    is read once more to infer the types.
    """
    bare = path.rstrip("/")
    if bare.endswith(".parquet"):
        return spark.read.parquet(path)
    if bare.endswith(".csv"):
        if own := codec.read_schema(spark, path):
            rows = codec.read(spark, path, own)
            return rows.select(*map(quoted, schema.names)) if schema else rows
        reader = spark.read.options(**FOREIGN_CSV, multiLine=multi_line)
        return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
    raise ValueError(f"neither .parquet nor .csv: {path}")


# --- typing ----------------------------------------------------------------


def typed(
    df: DataFrame, integers: Sequence[str], floats: Sequence[str], strings: Sequence[str]
) -> DataFrame:
    """Cast the named columns that exist; bad numbers become null."""
    out = []
    for field in df.schema.fields:
        col = quoted(field.name)
        if field.name in integers:
            col = to_long(col, field.dataType)
        elif field.name in floats:
            col = to_double(col, field.dataType)
        elif field.name in strings:
            col = col.cast("string")
        out.append(col.alias(field.name))
    return df.select(*out)


def with_origin(df: DataFrame, source: str, extracted_at: Column | None = None) -> DataFrame:
    """Add when and from where the rows came."""
    stamp = F.current_timestamp() if extracted_at is None else extracted_at
    return df.withColumns({"_extracted_at": stamp, "_source": F.lit(source)})


def records_to_table(
    records: DataFrame,
    source: str,
    names: Mapping[str, str] = FIELD_TO_COLUMN,
    extracted_at: Column | None = None,
) -> DataFrame:
    """Flat records with dotted names to the typed table with column names."""
    renamed = [field_column_name(c, dict(names)) for c in records.columns]
    if twice := repeated(renamed):
        raise ValueError(f"columns share a name: {twice}")
    table = records.select(*[quoted(c).alias(n) for c, n in zip(records.columns, renamed)])
    table = typed(table, INTEGER_COLUMNS, FLOAT_COLUMNS, STRING_COLUMNS)
    return with_origin(table, source, extracted_at)


# --- nested objects --------------------------------------------------------


def find_field(schema: T.StructType, path: Sequence[str]) -> T.DataType | None:
    """Type at a path of struct fields, None when the path does not exist."""
    here: T.DataType = schema
    for key in path:
        if not isinstance(here, T.StructType) or key not in here.names:
            return None
        here = here[key].dataType
    return here


def value_at(
    schema: T.StructType, path: str | Sequence[str], default: Any = None, separator: str = "."
) -> Column:
    """The value at a path, or the default where it is absent or null.

    Text names a column of exactly that name if there is one (`"school.name"`
    in flat records), else a path into nested objects. A sequence of keys is
    always a path.
    """
    if isinstance(path, str):
        keys = [path] if path in schema.names else path.split(separator)
    else:
        keys = list(path)
    if find_field(schema, keys) is None:
        return F.lit(default)
    col = quoted(keys[0])
    for key in keys[1:]:
        col = col.getField(key)
    return col if default is None else F.coalesce(col, F.lit(default))


def flatten_record(
    df: DataFrame, mapping: Mapping[str, str | Sequence[str]], absent_type: str = "string"
) -> DataFrame:
    """One column per mapping entry (column -> path); absent paths give null columns."""
    out = []
    for name, path in mapping.items():
        col = value_at(df.schema, path)
        keys = [path] if isinstance(path, str) and path in df.columns else (
            path.split(".") if isinstance(path, str) else list(path)
        )
        if find_field(df.schema, keys) is None:
            col = col.cast(absent_type)
        out.append(col.alias(name))
    return df.select(*out)


def normalize(df: DataFrame, separator: str = ".", explode: Sequence[str] = ()) -> DataFrame:
    """Every nested struct field as its own column, named by its path.

    explode: paths of arrays, outer before inner ones. Each of their elements becomes a
    row, with its place (from 0) in the column `path` + separator + `position`; a row whose
    array is null or empty stays, with nulls. Structs inside become columns below the
    array's path. Other arrays stay as they are. Two arrays side by side multiply their
    elements.
    """
    for path in explode:
        df = _exploded(normalize(df, separator), path, separator)
    return _normalized(df, separator)


def _exploded(df: DataFrame, path: str, separator: str) -> DataFrame:
    if path not in df.columns or not isinstance(df.schema[path].dataType, T.ArrayType):
        raise ValueError(f"no array at {path}")
    position = f"{path}{separator}position"
    if position in df.columns:
        raise ValueError(f"paths share a name: {[position]}")
    others = [quoted(c) for c in df.columns if c != path]
    return df.select(*others, F.posexplode_outer(quoted(path)).alias(position, path))


def flatten_lists(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lists of lists in the named columns become one list each, one level down.

    Inner null lists count as empty; a null list stays null.
    """
    none = {c: df.schema[c].dataType for c in columns}
    if wrong := [c for c, t in none.items() if not (isinstance(t, T.ArrayType) and isinstance(t.elementType, T.ArrayType))]:
        raise ValueError(f"no lists of lists: {wrong}")
    return df.withColumns({c: F.flatten(F.filter(quoted(c), lambda inner: inner.isNotNull())) for c in columns})


def _normalized(df: DataFrame, separator: str) -> DataFrame:

    def leaves(struct: T.StructType, names: list[str], col: Column | None):
        for field in struct.fields:
            here = quoted(field.name) if col is None else col.getField(field.name)
            path = [*names, field.name]
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, path, here)
            else:
                yield separator.join(path), here

    found = list(leaves(df.schema, [], None))
    if twice := repeated(name for name, _ in found):
        raise ValueError(f"paths share a name: {twice}")
    return df.select(*[col.alias(name) for name, col in found])


def short_names(df: DataFrame) -> DataFrame:
    """Drop the `latest.` and `school.` prefixes and turn dots into underscores."""
    names = [without_prefixes(c) for c in df.columns]
    if twice := repeated(names):
        raise ValueError(f"columns share a name: {twice}")
    return df.select(*[quoted(c).alias(n) for c, n in zip(df.columns, names)])


def field_presence(df: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    """Per expected path: does the schema have it, how many rows hold a value.

    Where a path breaks off, `available` lists the keys at that level.
    """
    counters, rows = [F.count(F.lit(1)).alias("rows")], []
    for i, (name, path) in enumerate(paths.items()):
        keys = path.split(".")
        depth = len(keys)
        while depth and find_field(df.schema, keys[:depth]) is None:
            depth -= 1
        reached = find_field(df.schema, keys[:depth])
        exists = depth == len(keys)
        available = (
            sorted(reached.names) if not exists and isinstance(reached, T.StructType) else []
        )
        present = F.count(value_at(df.schema, keys)) if exists else F.lit(0).cast("bigint")
        counters.append(present.alias(f"present_{i}"))
        rows.append(
            F.struct(
                F.lit(name).alias("field"),
                F.lit(exists).alias("exists"),
                F.lit(".".join(keys[:depth])).alias("found_path"),
                F.lit(",".join(available)).alias("available"),
                F.col(f"present_{i}").alias("present_rows"),
                F.col("rows"),
            )
        )
    return df.agg(*counters).select(F.inline(F.array(*rows)))


# --- the wider record ------------------------------------------------------


def with_labels_and_sizes(df: DataFrame) -> DataFrame:
    """Ownership and region label, undergraduate size, tuition difference.

    Each is added where its inputs exist.
    """
    has = set(df.columns)
    new: dict[str, Column] = {}
    if "ownership" in has:
        new["ownership_label"] = code_label(F.col("ownership"), OWNERSHIP_LABELS)
    if "region_id" in has:
        new["region_label"] = code_label(F.col("region_id"), REGION_LABELS)
    if {"student_size", "grad_students"} <= has:
        new["undergrad_size"] = F.col("student_size") - F.coalesce("grad_students", F.lit(0))
    if {"tuition_in_state", "tuition_out_of_state"} <= has:
        new["tuition_difference"] = F.coalesce("tuition_out_of_state", F.lit(0)) - F.coalesce(
            "tuition_in_state", F.lit(0)
        )
    return df.withColumns(new) if new else df


def first_columns(df: DataFrame, names: Sequence[str] = PRIORITY_COLUMNS) -> DataFrame:
    """The named columns first, the others behind them in their order."""
    return df.select(*names, *[c for c in df.columns if c not in names])


def extended_table(
    records: DataFrame, source: str, extracted_at: Column | None = None
) -> DataFrame:
    """The 37-column table of the wider record."""
    mapping = {column: field for field, column in EXTENDED_FIELD_TO_COLUMN.items()}
    table = flatten_record(records, mapping)
    table = with_origin(table, source, extracted_at)
    table = typed(table, EXTENDED_INTEGER_COLUMNS, EXTENDED_FLOAT_COLUMNS, STRING_COLUMNS)
    table = table.withColumns(
        {c: F.when(F.col(c) != "None", F.col(c)) for c in STRING_COLUMNS if c in table.columns}
    )
    return first_columns(with_labels_and_sizes(table))
