"""Immutable dataset versions with a catalogue.

Data lies at `{root}/{source}/{dataset}/_data/{version}-{unique}`, a folder that no reader
of the dataset's own folder sees. A commit to the log at `{root}/_catalogue` makes it a
version: one rename publishes the data and its catalogue row together. Catalogue
questions are functions over the catalogue DataFrame, so they work on any table of that form.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campusgrid.functions.text import quoted
from campusgrid.operators.commits import CommitLog, first_free
from campusgrid.operators.joins import skew_join
from campusgrid.schema import CATALOGUE
from campusgrid.sources import codec
from campusgrid.sources.records import read_records, read_table
from campusgrid.sources.sinks import stamp

DATASET = ("source", "dataset")
KEEP_VERSIONS = 10
KEEP_DAYS = 90
STAMP = "%Y%m%d_%H%M%S"
#: Lengths of a version's beginning by which versions are counted: days, hours, minutes, seconds.
STAMP_PARTS = (8, 11, 13, 15)
FORMATS = ("parquet", "csv")


# --- questions to the catalogue --------------------------------------------


def sources(catalogue: DataFrame) -> DataFrame:
    return catalogue.select("source").distinct()


def datasets(catalogue: DataFrame, source: str | None = None) -> DataFrame:
    """Every dataset with its number of versions and the latest one."""
    rows = catalogue.filter(F.col("source") == source) if source else catalogue
    return rows.groupBy(*DATASET).agg(
        F.count(F.lit(1)).alias("versions"), F.max("version").alias("latest")
    )


def latest_versions(catalogue: DataFrame, at: str | None = None) -> DataFrame:
    """The catalogue row of each dataset's latest version, or of the latest not after `at`.

    Versions compare by their whole stamp, date first.
    """
    rows = catalogue.filter(F.col("version") <= at) if at else catalogue
    newest = Window.partitionBy(*DATASET).orderBy(F.col("version").desc())
    return (
        rows.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def versions(catalogue: DataFrame, source: str, dataset: str) -> DataFrame:
    """All versions of a dataset, newest first."""
    return catalogue.filter(
        (F.col("source") == source) & (F.col("dataset") == dataset)
    ).orderBy(F.col("version").desc())


def count_versions(catalogue: DataFrame, source: str, dataset: str) -> int:
    return versions(catalogue, source, dataset).count()


def metadata(
    catalogue: DataFrame, source: str, dataset: str, version: str | None = None
) -> DataFrame:
    """The catalogue row of one version, the latest by default."""
    rows = catalogue.filter((F.col("source") == source) & (F.col("dataset") == dataset))
    return rows.filter(F.col("version") == version) if version else latest_versions(rows)


def nth_newest(catalogue: DataFrame, n: int) -> DataFrame:
    """(source, dataset, _cut): the n-th newest version of each dataset, or '' where it has
    fewer.

    Versions are counted by day first; the day with the n-th newest one is looked into by
    hour, and so on. Counts combine before the shuffle, and a task sorts the days, hours,
    minutes or seconds of a dataset, never its versions: only those of one second.
    """
    if n < 1:
        raise ValueError("n must be 1 or more")
    rows = catalogue.select(*DATASET, "version")
    inside, known = rows.withColumn("_left", F.lit(n).cast("bigint")), None
    newer = Window.partitionBy(*DATASET).orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)
    for length in (*STAMP_PARTS, None):
        part = F.substring("version", 1, length) if length else F.col("version")
        if known is not None:
            inside = rows.join(known, [*same, F.substring("version", 1, before) == F.col("_cut")])
        counts = inside.groupBy(*DATASET, part.alias("_part"), "_left").agg(F.count(F.lit(1)).alias("_n"))
        counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(newer), F.lit(0)))
        hit = counts.filter((F.col("_before") < F.col("_left")) & (F.col("_left") <= F.col("_before") + F.col("_n")))
        known = hit.select(
            *[F.col(c).alias(f"_{c}") for c in DATASET],
            F.col("_part").alias("_cut"),
            (F.col("_left") - F.col("_before")).alias("_left"),
        )
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in DATASET]
        before = length
    every = rows.select(*DATASET).distinct().join(known, same, "left")
    return every.select(*DATASET, F.coalesce("_cut", F.lit("")).alias("_cut"))


def newest(catalogue: DataFrame, n: int) -> DataFrame:
    """The newest n versions of each dataset; versions of a dataset are unique."""
    return skew_join(catalogue, nth_newest(catalogue, n), DATASET).filter(F.col("version") >= F.col("_cut")).drop("_cut")


def expired_by_count(catalogue: DataFrame, keep: int = KEEP_VERSIONS) -> DataFrame:
    """Versions behind the newest `keep` of their dataset.

    The oldest kept version of each dataset is the cut; older ones are expired. The
    cuts are few rows, the versions of one dataset may be many: those are dealt over tasks.
    """
    return skew_join(catalogue, nth_newest(catalogue, keep), DATASET).filter(F.col("version") < F.col("_cut")).drop("_cut")


def expired_by_age(
    catalogue: DataFrame, days: int = KEEP_DAYS, now: datetime | None = None
) -> DataFrame:
    """Versions older than the given number of days."""
    cut = (now or datetime.now(timezone.utc)) - timedelta(days=days)
    return catalogue.filter(F.col("version") < cut.strftime(STAMP))


def summary(catalogue: DataFrame) -> DataFrame:
    """Numbers of sources, datasets and versions, and the latest version, in one row."""
    per_dataset = catalogue.groupBy(*DATASET).agg(
        F.count(F.lit(1)).alias("versions"), F.max("version").alias("latest")
    )
    per_source = per_dataset.groupBy("source").agg(
        F.count(F.lit(1)).alias("datasets"),
        F.sum("versions").alias("versions"),
        F.max("latest").alias("latest"),
    )
    return per_source.agg(
        F.count(F.lit(1)).alias("total_sources"),
        F.coalesce(F.sum("datasets"), F.lit(0)).alias("total_datasets"),
        F.coalesce(F.sum("versions"), F.lit(0)).alias("total_versions"),
        F.max("latest").alias("latest_version"),
    )


def layer_report(spark: SparkSession, layers: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of the latest table of each layer, as one table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(layer).alias("layer"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        for layer, df in layers.items()
    ]
    if not parts:
        return spark.createDataFrame([], "layer string, rows bigint, columns int")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# --- layers of files --------------------------------------------------------

#: Stamps in names of written tables: those of raw and staged ones, and of processed ones.
NAME_STAMPS = (r"(\d{8}_\d{6})", r"(\d{4}_\d{2}_\d{2}_\d{6})")


def name_stamp(name: Column) -> Column:
    """The stamp in the name of a written table as timestamp, null if it has none."""
    compact, dashed = [F.regexp_extract(name, pattern, 1) for pattern in NAME_STAMPS]
    return F.coalesce(as_stamp(compact), F.try_to_timestamp(dashed, F.lit("yyyy_MM_dd_HHmmss")))


def layer_files(spark: SparkSession, layers: Mapping[str, str]) -> DataFrame:
    """The tables in each layer's folder (layer -> folder), from a listing of the files:
    (layer, name, at, files, bytes).

    A table is what lies right in the folder: a file, or a folder of files. Only names and
    sizes are read. Hidden files don't count; a layer without files has no rows.
    """
    parts = []
    for layer, folder in layers.items():
        root = folder.rstrip("/")
        try:
            files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        # The listing gives whole addresses; what is below the layer's last folder counts.
        below = F.substring_index(F.col("path"), f"/{root.rsplit('/', 1)[-1]}/", -1)
        parts.append(files.select(F.lit(layer).alias("layer"), F.substring_index(below, "/", 1).alias("name"), "length"))
    if not parts:
        return spark.createDataFrame([], "layer string, name string, at timestamp, files bigint, bytes bigint")
    tables = reduce(DataFrame.unionByName, parts).groupBy("layer", "name")
    tables = tables.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    return tables.select("layer", "name", name_stamp(F.col("name")).alias("at"), "files", "bytes")


def latest_files(spark: SparkSession, layers: Mapping[str, str], ending: str = "") -> DataFrame:
    """The newest table of each layer by the stamp in its name, ties by name. Names without
    a stamp don't count, nor those with another ending."""
    stamped = layer_files(spark, layers).filter(F.col("at").isNotNull() & F.col("name").endswith(ending))
    newest_one = F.max_by(F.struct("name", "at", "files", "bytes"), F.struct("at", "name")).alias("newest")
    return stamped.groupBy("layer").agg(newest_one).select("layer", "newest.*")


def latest_layer_report(spark: SparkSession, layers: Mapping[str, str], endings: Mapping[str, str] | None = None) -> DataFrame:
    """The newest table of each layer with its rows and columns: (layer, name, at, rows, columns).

    layers: layer -> folder. endings: layer -> the ending its tables have (`.json`,
    `.csv`, `.parquet`); without one any of these counts. The driver learns one name per layer.
    """
    endings = endings or {}
    parts = []
    for layer, folder in layers.items():
        for row in latest_files(spark, {layer: folder}, endings.get(layer, "")).collect():
            path = f"{folder.rstrip('/')}/{row['name']}"
            df = read_records(spark, path) if path.endswith(".json") else read_table(spark, path)
            one = layer_report(spark, {layer: df})
            parts.append(one.select("layer", F.lit(row["name"]).alias("name"), name_stamp(F.lit(row["name"])).alias("at"), "rows", "columns"))
    if not parts:
        return spark.createDataFrame([], "layer string, name string, at timestamp, rows bigint, columns int")
    return reduce(DataFrame.unionByName, parts)


# --- the store -------------------------------------------------------------

#: What the log holds beside the catalogue's columns: where the data lies below the root,
#: and a fingerprint of its rows, if asked for.
ENTRY = T.StructType([*CATALOGUE.fields, T.StructField("location", T.StringType()), T.StructField("content", T.StringType())])


def _hashable(kind: T.DataType, col: Column) -> Column:
    """The value without maps, which have no order of their own."""
    if isinstance(kind, T.MapType):
        return F.array_sort(F.transform(F.map_entries(col), lambda e: F.to_json(F.struct(e.alias("e")))))
    if isinstance(kind, (T.StructType, T.ArrayType)) and "map<" in kind.simpleString():
        return F.to_json(F.struct(col.alias("v")))
    return col


def content_hash(df: DataFrame) -> Column:
    """An aggregate over the rows of `df` that doesn't depend on their order: a fingerprint
    of the columns, the number of rows, and the sums of two 64-bit hashes per row.

    Sums are taken over thirds of each hash, which can't overflow below 2**41 rows.
    """
    cells = [F.coalesce(_hashable(f.dataType, quoted(f.name)).cast("string"), F.lit("")) for f in df.schema.fields]
    nulls = F.concat(*[quoted(c).isNull().cast("int").cast("string") for c in df.columns]) if df.columns else F.lit("")
    sums = []
    for seed in ("a", "b"):
        one = F.xxhash64(F.lit(seed), nulls, *cells)
        for shift, bits in ((0, 21), (21, 21), (42, 22)):
            sums.append(F.coalesce(F.sum(F.shiftrightunsigned(one, shift).bitwiseAND((1 << bits) - 1)), F.lit(0)).cast("string"))
    return F.sha2(F.concat_ws(" ", F.lit(df.schema.json()), F.count(F.lit(1)).cast("string"), *sums), 256)


class SnapshotStore:
    """Writes versions and reads them back."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/_catalogue", ENTRY)

    def catalogue(self) -> DataFrame:
        """One row per version, from the newest checkpoint and the commits behind it."""
        return self.log.entries()

    def store(
        self,
        df: DataFrame,
        source: str,
        dataset: str,
        params: Mapping[str, str] | None = None,
        file_format: str = "parquet",
        version: str | None = None,
        share: bool = False,
    ) -> str:
        """Write a new version and publish it with its catalogue row; the version's name.

        A version named by the caller must not exist. One named by the clock gets a number
        behind it where another writer has the same second. The row count is read back
        from the written files, so it is what a reader will find. With `share`, the content
        is compared with that of the dataset's other versions, and equal content is kept
        once. A job that ends before it has published leaves a hidden folder, no version.
        """
        if file_format not in FORMATS:
            raise ValueError(f"unsupported format: {file_format}")
        wanted = version or stamp(STAMP)
        if version:
            self._refuse_known(self.catalogue(), source, dataset, version)
        own = f"{source}/{dataset}/_data/{wanted}-{uuid.uuid4().hex}"
        path = f"{self.root}/{own}"
        if file_format == "csv":
            codec.write(df, path)
        else:
            df.write.mode("errorifexists").parquet(path)
        written = self._read(path, file_format)
        content = written.agg(content_hash(written).alias("content")).first()["content"] if share else None
        rows = written.count()
        done: dict[str, str] = {}

        def entry(known: DataFrame) -> dict[str, object]:
            same = known.filter((F.col("source") == source) & (F.col("dataset") == dataset))
            if version:
                self._refuse_known(known, source, dataset, version)
                name = version
            else:
                near = same.filter(F.col("version").startswith(wanted)).select("version")
                name = first_free(wanted, [r["version"] for r in near.collect()])
            equal = same.filter((F.col("content") == content) & (F.col("file_format") == file_format)).first() if content else None
            done.update(name=name, location=equal["location"] if equal else own)
            return {
                "source": source,
                "dataset": dataset,
                "version": name,
                "row_count": rows,
                "column_count": len(df.columns),
                "columns": df.columns,
                "dtypes": dict(df.dtypes),
                "created_at": datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ"),
                "file_format": file_format,
                "params": {k: str(v) for k, v in (params or {}).items()},
                "location": done["location"],
                "content": content,
            }

        try:
            self.log.publish(entry)
        except FileExistsError:
            self.log.files.delete(path)
            raise
        if done["location"] != own:
            self.log.files.delete(path)
        return done["name"]

    @staticmethod
    def _refuse_known(catalogue: DataFrame, source: str, dataset: str, version: str) -> None:
        if not metadata(catalogue, source, dataset, version).isEmpty():
            raise FileExistsError(f"version already exists: {source}/{dataset}/{version}")

    def _read(self, path: str, file_format: str) -> DataFrame:
        return codec.read(self.spark, path) if file_format == "csv" else self.spark.read.parquet(path)

    def _load(self, found: DataFrame) -> DataFrame | None:
        """The data of the single catalogue row; the driver fetches that one row only."""
        row = found.first()
        return None if row is None else self._read(f"{self.root}/{row['location']}", row["file_format"])

    def load_latest(self, source: str, dataset: str) -> DataFrame | None:
        return self._load(metadata(self.catalogue(), source, dataset))

    def load_version(self, source: str, dataset: str, version: str) -> DataFrame | None:
        return self._load(metadata(self.catalogue(), source, dataset, version))

    def load_as_of(self, source: str, dataset: str, at: str) -> DataFrame | None:
        """The version that was the latest at the given stamp."""
        rows = versions(self.catalogue(), source, dataset)
        return self._load(latest_versions(rows, at))

    def unpublished(self, source: str, dataset: str) -> list[str]:
        """Folders of a dataset that no version names: those of writers that are at it or ended early."""
        folder = f"{source}/{dataset}/_data"
        named = versions(self.catalogue(), source, dataset).select("location")
        found = [(f"{folder}/{name}",) for name in self.log.files.names(f"{self.root}/{folder}")]
        listed = self.spark.createDataFrame(found, "location string")
        return sorted(row["location"] for row in listed.join(named, "location", "left_anti").collect())

    def compact_catalogue(self) -> int:
        """Write the catalogue as one table, which the store opens from then on. No version is left out."""
        return self.log.checkpoint()


def as_stamp(col: Column) -> Column:
    """A version stamp as timestamp, whatever follows its seconds; null if it is none."""
    return F.try_to_timestamp(F.substring(col, 1, 15), F.lit("yyyyMMdd_HHmmss"))
