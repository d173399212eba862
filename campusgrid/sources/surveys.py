"""Survey tables: catalogue, archives, generated rows."""

from __future__ import annotations

import codecs
import csv
import io
import sys
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark import cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campusgrid.operators.joins import merge_surveys
from campusgrid.schema import (
    DEFAULT_SURVEYS,
    SAMPLE_INTEGERS,
    SAMPLE_RATES,
    SAMPLE_STATES,
    SURVEY_KEY,
    SURVEY_SCHEMAS,
    SURVEY_SEED,
    SURVEY_YEARS,
    SURVEYS,
)
from campusgrid.session import scratch_dir

CHUNK_ROWS = 10_000

# The archive reader travels to the workers by value: they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def survey_catalogue(spark: SparkSession) -> DataFrame:
    """One row per survey: code, name, description, frequency, file suffixes, years."""
    rows = [
        (code, name, description, frequency, list(suffixes), list(SURVEY_YEARS))
        for code, (name, description, frequency, suffixes) in SURVEYS.items()
    ]
    return spark.createDataFrame(
        rows,
        "code string, name string, description string, frequency string, "
        "suffixes array<string>, years array<int>",
    )


# --- archives --------------------------------------------------------------


#: Columns that say where a line comes from and why it is no row (null: it is one).
ORIGIN = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("member", T.StringType()),
        T.StructField("line", T.LongType()),
        T.StructField("reason", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
TOO_LONG = "too many fields"
#: Longest cell of an archived table, in characters.
CELL = 1 << 30


def _is_utf8(archive: zipfile.ZipFile, member: str) -> bool:
    decoder = codecs.getincrementaldecoder("utf-8")()
    with archive.open(member) as raw:
        try:
            while block := raw.read(1 << 20):
                decoder.decode(block)
            decoder.decode(b"", final=True)
        except UnicodeDecodeError:
            return False
    return True


def _members(content: bytes, names: list[str]) -> Iterator[tuple[str, int, str | None, list]]:
    """(member, line, reason, cells) of every line of every CSV in a ZIP; a rejected line has its own fields
    for cells. Latin-1 reads any bytes that are not UTF-8."""
    csv.field_size_limit(CELL)
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        for member in archive.namelist():
            if not member.lower().endswith(".csv"):
                continue
            encoding = "utf-8-sig" if _is_utf8(archive, member) else "latin-1"
            with archive.open(member) as raw:
                lines = csv.reader(io.TextIOWrapper(raw, encoding=encoding, newline=""))
                header = next((fields for fields in lines if fields), [])
                places = [header.index(name) if name in header else None for name in names]
                for fields in lines:
                    if not fields:
                        continue
                    if len(fields) > len(header):
                        yield member, lines.line_num, TOO_LONG, fields
                        continue
                    cells = [fields[at] if at is not None and at < len(fields) else None for at in places]
                    yield member, lines.line_num, None, [cell or None for cell in cells]


def read_members(archives: DataFrame, schema: T.StructType, content: str = "content", name: str | None = None) -> DataFrame:
    """Every line of every CSV in each archive: the columns of `schema` under `row`, cast to
    their types, and `origin`, with the reason of a line that is no row, and its text.

    One pass gives both: write it, then take `rows_of` and `rejects_of`. Archives spread over
    the tasks; within one, lines stream out in portions. Lines with too many fields are
    rejected, missing fields and absent columns are null, values that do not fit their type
    become null. An archive that can't be read fails the job. `name`: the column that
    names an archive.
    """
    names = schema.names
    text = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    arrow = pa.schema([*[(f"c{i}", pa.string()) for i in range(len(names))], ("archive", pa.string()), ("member", pa.string()), ("line", pa.int64()), ("reason", pa.string()), ("text", pa.string())])

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob, title in zip(batch.column(0), batch.column(1).to_pylist()):
                found: list[tuple] = []
                for member, line, reason, cells in _members(blob.as_py(), names):
                    own = cells if reason is None else [None] * len(names)
                    rejected = None if reason is None else ",".join(cells)
                    found.append((*own, title, member, line, reason, rejected))
                    if len(found) == CHUNK_ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), arrow)], schema=arrow)
                        found.clear()
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), arrow)], schema=arrow)

    title = F.col(name).cast("string") if name else F.lit(None).cast("string")
    source = archives.select(F.col(content), title.alias("title"))
    found = source.mapInArrow(lines, T.StructType([*text.fields, *ORIGIN.fields]))
    row = F.struct(*[F.col(f"c{i}").try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])
    return found.select(row.alias("row"), F.struct(*ORIGIN.names).alias("origin"))


def rows_of(members: DataFrame) -> DataFrame:
    return members.filter("origin.reason IS NULL").select("row.*")


def rejects_of(members: DataFrame) -> DataFrame:
    """(archive, member, line, reason, text) of the lines that are no rows."""
    return members.filter("origin.reason IS NOT NULL").select("origin.*")


def unzip_csv(archives: DataFrame, schema: T.StructType, content: str = "content") -> DataFrame:
    """Rows of all CSVs in each archive, as `read_members` reads them."""
    return rows_of(read_members(archives, schema, content))


def read_archives(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of all survey archives (`*.zip`) at a path."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    return unzip_csv(files, schema)


# --- several surveys at once -------------------------------------------------

LOG = "code string, year int, archives bigint, rows bigint, rejected bigint, status string, error string"


@dataclass
class Loaded:
    """What `load_comprehensive` gives: the merged table (None if no survey was read), one log
    row per survey, the rejected lines with their survey."""

    merged: DataFrame | None
    log: DataFrame
    rejects: DataFrame


def archive_names(code: str, year: int) -> list[str]:
    """Patterns of the names an archive of a survey may have: with and without an underscore,
    with each suffix that the catalogue knows for the survey, whole or in numbered parts."""
    suffixes = ("", *SURVEYS[code][3])
    return [f"{code}{suffix}{mark}{year}{part}.zip" for suffix in suffixes for mark in ("", "_") for part in ("", "-*")]


def load_comprehensive(
    spark: SparkSession,
    folder: str,
    year: int = max(SURVEY_YEARS),
    schemas: Mapping[str, T.StructType] | None = None,
    surveys: Sequence[str] = DEFAULT_SURVEYS,
) -> Loaded:
    """Reads the archives of several surveys in `folder` and merges them on the key.

    A survey is read with its own schema (`schemas`, else the library's), whole and by itself,
    into a table of the scratch folder. One that has no archive, can't be read or has no rows is left out and logged with
    the reason; the others go on. Names of surveys that the catalogue lacks are an error.
    The merged columns carry the survey's code in front. Without any survey `merged` is None.
    """
    schemas = SURVEY_SCHEMAS | dict(schemas or {})
    codes = [code.upper() for code in surveys]
    if unknown := [code for code in codes if code not in SURVEYS]:
        raise ValueError(f"unknown surveys: {unknown}; known: {sorted(SURVEYS)}")
    found: dict[str, DataFrame | None] = {}
    log, rejects = [], []
    for code in codes:
        archives = rows = rejected = 0
        status, error = "loaded", None
        try:
            files = spark.read.format("binaryFile").option("pathGlobFilter", "{" + ",".join(archive_names(code, year)) + "}").load(folder)
            path = scratch_dir(spark)
            read_members(files, schemas[code], name="path").write.parquet(path)
            members = spark.read.parquet(path)
            counts = members.agg(
                F.count_if(F.col("origin.reason").isNull()).alias("rows"),
                F.count("origin.reason").alias("rejected"),
                F.count_distinct("origin.archive").alias("archives"),
            ).first()
            archives, rows, rejected = counts["archives"], counts["rows"], counts["rejected"]
            if rejected:
                rejects.append(rejects_of(members).select(F.lit(code).alias("code"), "*"))
            if rows:
                found[code] = rows_of(members)
            else:
                status, error = "skipped", "no rows"
        except (PySparkException, Py4JError) as problem:
            status, error = "failed", str(problem)[:1000]
        log.append((code, year, archives, rows, rejected, status, error))
    lines = T.StructType([T.StructField("code", T.StringType()), *ORIGIN.fields])
    return Loaded(
        merge_surveys(found) if found else None,
        spark.createDataFrame(log, LOG),
        reduce(DataFrame.unionByName, rejects) if rejects else spark.createDataFrame([], lines),
    )


# --- generated rows --------------------------------------------------------


def _draw(seed: int, name: str) -> Column:
    """A number in 0..2^32-1 that depends on the key, the column and the seed only.

    Unlike `rand` it does not depend on the partition a row is in, so a task
    that is run again makes the same rows.
    """
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(name), F.col(SURVEY_KEY).cast("string"))
    return F.conv(F.left(F.md5(text), F.lit(8)), 16, 10).cast("bigint")


def _between(seed: int, name: str, low: int, high: int) -> Column:
    return (_draw(seed, name) % (high - low) + low).cast("int")


def sample_survey(keys: DataFrame, survey: str, year: int) -> DataFrame:
    """Made-up survey rows for development, one per row of `keys` (column `UNITID`).

    The columns and value ranges are those of the survey; an unknown survey gets
    the common columns only.
    """
    seed = SURVEY_SEED + year
    unit = F.col(SURVEY_KEY)
    state = F.element_at(
        F.array(*[F.lit(s) for s in SAMPLE_STATES]), _between(seed, "STABBR", 1, len(SAMPLE_STATES) + 1)
    )
    columns: dict[str, Column] = {
        "INSTNM": F.concat(F.lit("Institution "), unit.cast("string")),
        "STABBR": state,
        "CONTROL": _between(seed, "CONTROL", 1, 4),
        "ICLEVEL": _between(seed, "ICLEVEL", 1, 4),
    }
    if survey == "HD":
        columns["CITY"] = F.concat(F.lit("City "), unit.cast("string"))
        columns["ZIP"] = _between(seed, "ZIP", 10000, 99999).cast("string")
        columns["WEBADDR"] = F.concat(F.lit("www.inst"), unit.cast("string"), F.lit(".edu"))
    for name, (low, high) in SAMPLE_INTEGERS.get(survey, {}).items():
        columns[name] = _between(seed, name, low, high)
    for name, (low, high) in SAMPLE_RATES.get(survey, {}).items():
        thousandths = _between(seed, name, round(low * 1000), round(high * 1000))
        columns[name] = thousandths / F.lit(1000.0)
    columns["YEAR"] = F.lit(year)
    return keys.select(unit, *[c.alias(n) for n, c in columns.items()])


def sample_keys(spark: SparkSession, rows: int = 1000, first: int = 100_000) -> DataFrame:
    return spark.range(first, first + rows).select(F.col("id").alias(SURVEY_KEY))
