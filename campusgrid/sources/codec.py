"""Text files that give back what was written: null, empty text, line ends, stamps, types.

A row is one line, whatever its cells hold, so that files can be split. In text cells
a backslash starts an escape; a null is a mark of its own, an empty text two quotes.
Compressed files can't be split, so they hold a bounded number of rows each.
The types lie beside the data, in `_schema`, which readers of data files pass over.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campusgrid.functions.text import quoted
from campusgrid.session import shuffles_freed

#: A null cell. Text can't look like it, since its backslashes are doubled.
NULL = r"\N"
#: What can't stand in a line as it is, and how it is written. The backslash comes first.
ESCAPES = (("\\", r"\\"), ("\n", r"\n"), ("\r", r"\r"), ("\0", r"\0"))

STAMPS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
OPTIONS = STAMPS | {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "nullValue": NULL,
}
#: At the fastest level sheets take about a quarter of the disk; the default level saves a fifth of that, and takes longer.
COMPRESSED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 500_000}
_NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)


def escaped(text: str) -> str:
    for plain, written in ESCAPES:
        text = text.replace(plain, written)
    return text


def _escape(col: Column) -> Column:
    for plain, written in ESCAPES:
        col = F.replace(col, F.lit(plain), F.lit(written))
    return col


def _unescape(col: Column) -> Column:
    """Each escape read once, from the left: doubled backslashes are put aside first."""
    aside = "\0"
    col = F.replace(col, F.lit("\\\\"), F.lit(aside))
    for plain, written in ESCAPES[1:]:
        # A zero character would be taken for the mark, so it comes last.
        if plain != aside:
            col = F.replace(col, F.lit(written), F.lit(plain))
    parts = F.split(col, aside, -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit(r"\0"), F.lit(aside))), "\\")


def _written(field: T.StructField) -> Column:
    col = quoted(field.name)
    kind = field.dataType
    if isinstance(kind, T.BinaryType):
        return F.base64(col)
    if isinstance(kind, _NESTED):
        return _escape(F.to_json(col, {**STAMPS, "ignoreNullFields": "false"}))
    if isinstance(kind, (T.StringType, T.VarcharType, T.CharType)):
        return _escape(col.cast("string"))
    return col


def _read(field: T.StructField, col: Column) -> Column:
    kind = field.dataType
    if isinstance(kind, T.BinaryType):
        return F.unbase64(col)
    if isinstance(kind, _NESTED):
        return F.from_json(_unescape(col), kind, {**STAMPS, "mode": "FAILFAST"})
    if isinstance(kind, (T.StringType, T.VarcharType, T.CharType)):
        return F.when(col.contains("\\"), _unescape(col)).otherwise(col)
    return col


def _plain_type(kind: T.DataType) -> T.DataType:
    """The type a cell has for the CSV reader."""
    text = (T.BinaryType, T.StringType, T.VarcharType, T.CharType, *_NESTED)
    return T.StringType() if isinstance(kind, text) else kind


def write_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """The types, beside the data. It is written last: data without it isn't whole."""
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(f"{path}/_schema")


def read_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The types that lie beside the data, None where there are none."""
    try:
        row = spark.read.text(f"{path.rstrip('/')}/_schema").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return T.StructType.fromJson(json.loads(row["value"])) if row else None


def _portions(df: DataFrame, column: str, n: int) -> list[DataFrame]:
    """Every row in one of n parts; rows without a value are in one part too."""
    share = F.pmod(F.xxhash64(quoted(column)), F.lit(n))
    return [df.filter(share == i) for i in range(n)]


def write(df: DataFrame, path: str, compressed: bool = False, portion_by: str | None = None, portions: int = 4) -> str:
    """Rows as lines of text in a new folder; an existing one is never touched.

    Binary cells are written as base64, nested ones as JSON. Columns keep their order;
    two of one name are an error, as in every Spark writer.

    portion_by: a column by whose hash the rows are written in portions, one after the other.
    What `df` shuffles then takes the disk of one portion at a time, if the filter on the
    column reaches its tables; these are read once per portion. `df` must give the same
    rows every time it runs.
    """
    cells = [_written(f).alias(escaped(f.name)) for f in df.schema.fields]
    options = OPTIONS | (COMPRESSED if compressed else {})
    with shuffles_freed(df.sparkSession):
        for i, part in enumerate([df] if portion_by is None else _portions(df, portion_by, portions)):
            part.select(*cells).write.mode("append" if i else "errorifexists").options(**options).csv(path)
    write_schema(df.sparkSession, path, df.schema)
    return path


def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """What `write` wrote. A line that doesn't fit the types fails the job.

    schema: known types, where a caller keeps them elsewhere.
    """
    schema = schema or read_schema(spark, path)
    if schema is None:
        raise ValueError(f"no types beside the data: {path}")
    cells = T.StructType([T.StructField(f"c{i}", _plain_type(f.dataType)) for i, f in enumerate(schema.fields)])
    rows = spark.read.options(**OPTIONS, mode="FAILFAST", enforceSchema=True).schema(cells).csv(path)
    return rows.select(*[_read(f, F.col(f"c{i}")).alias(f.name) for i, f in enumerate(schema.fields)])
