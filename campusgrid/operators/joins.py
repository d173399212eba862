"""Joins: survey chains, sheets at query grain, code tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campusgrid.functions.text import quoted
from campusgrid.operators.clean import prefix_columns
from campusgrid.schema import SURVEY_KEY


SPLIT_ROWS = 1_000_000


def _rows_per_key(surveys: Sequence[DataFrame], key: str) -> DataFrame:
    """Per key the rows each survey has (`_n0`, `_n1`, ...) and the largest of them (`_most`).

    Null keys of different surveys are different keys: `_origin` tells them apart.
    """
    keys = [df.select(F.col(key), "_origin", F.lit(i).alias("_from")) for i, df in enumerate(surveys)]
    per_survey = [
        F.count(F.when(F.col("_from") == i, 1)).alias(f"_n{i}") for i in range(len(keys))
    ]
    counts = reduce(DataFrame.unionByName, keys).groupBy(key, "_origin").agg(*per_survey)
    return counts.withColumn("_most", F.greatest(*[F.col(f"_n{i}") for i in range(len(keys))]))


def _with_missing_keys(df: DataFrame, i: int, counts: DataFrame, key: str) -> DataFrame:
    """Survey i plus one empty row for every key that only others have.

    `_most` is never 0. Naming it makes every use of the counts need the same
    columns, so that their shuffle runs once and is reused.
    """
    missing = counts.filter((F.col("_most") > 0) & (F.col(f"_n{i}") == 0)).select(key, "_origin")
    return df.unionByName(missing, allowMissingColumns=True)


def _is_hot(key: str) -> Column:
    return F.col(key).eqNullSafe(F.col("_hot")) & (F.col("_origin") == F.col("_hot_origin"))


def _repeated(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """The rows, those of hot keys once per share."""
    shares = F.when(F.col("_parts").isNull(), F.array(F.lit(0))).otherwise(
        F.sequence(F.lit(0), F.col("_parts") - 1)
    )
    marked = df.join(F.broadcast(hot), _is_hot(key), "left")
    return marked.select(*map(quoted, df.columns), F.explode(shares).alias("_salt"), F.lit(1).cast("bigint").alias("_copies"))


def _dealt(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """The rows of hot keys dealt over the shares.

    Equal rows collapse to one with its number of `_copies`, which are dealt in turn, from a
    share that follows from the content; so a task that runs again deals alike. Rows with
    maps cannot be grouped: there the content alone names the share.
    """
    rows = df.join(F.broadcast(hot), _is_hot(key))
    plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    if len(plain) == len(df.columns):
        rows = rows.groupBy(*map(quoted, df.columns), "_parts").agg(F.count("*").alias("_n"))
    else:
        rows = rows.withColumn("_n", F.lit(1).cast("bigint"))
    turns = F.sequence(F.lit(0), F.least(F.col("_n"), F.col("_parts")).cast("int") - 1)
    start = F.xxhash64(*map(quoted, plain))
    copies = F.floor((F.col("_n") + F.col("_parts") - 1 - F.col("_turn")) / F.col("_parts"))
    return rows.withColumn("_turn", F.explode(turns)).select(
        *map(quoted, df.columns),
        F.pmod(F.pmod(start, F.col("_parts")) + F.col("_turn"), F.col("_parts")).cast("int").alias("_salt"),
        copies.cast("bigint").alias("_copies"),
    )


def merge_surveys(
    surveys: Mapping[str, DataFrame | None], key: str = SURVEY_KEY, split_rows: int = SPLIT_ROWS
) -> DataFrame:
    """Full outer join of any number of surveys on the key, columns prefixed by survey code.

    A survey given as None is skipped. Keys are compared by plain equality: a key with m
    rows in one survey and n in another gives m * n rows, and a row without a key
    matches none.

    A chain of full outer joins would shuffle the growing result again at every
    step and keep a hot key in one task. So the rows per key are counted first,
    over the key columns alone. Every survey then gets an empty row for each key
    it lacks, which makes plain inner joins give the same rows: each survey is read and
    shuffled once, and the result keeps its partitioning from join to join.

    The counts also tell which keys have more than `split_rows` rows in a survey. Only if
    there are any, the survey with most rows of such a key deals them over several tasks,
    and the others repeat theirs. The broadcast list of such keys has at most one entry
    per `split_rows` input rows.
    """
    present = {
        code: prefix_columns(df, code, [key]) for code, df in surveys.items() if df is not None
    }
    if not present:
        raise ValueError("no survey to merge")
    if len(present) == 1:
        return next(iter(present.values()))
    marked = [
        df.withColumn("_origin", F.when(F.col(key).isNull(), i).otherwise(-1))
        for i, df in enumerate(present.values())
    ]
    counts = _rows_per_key(marked, key)
    largest = F.coalesce(
        *[F.when(F.col(f"_n{i}") == F.col("_most"), i) for i in range(len(present))]
    )
    hot = counts.filter(F.col("_most") > split_rows).select(
        F.col(key).alias("_hot"),
        F.col("_origin").alias("_hot_origin"),
        F.ceil(F.col("_most") / split_rows).cast("int").alias("_parts"),
        largest.alias("_largest"),
    )
    dealers = {row["_largest"] for row in hot.select("_largest").distinct().collect()}
    same = [key, "_origin", *(["_salt"] if dealers else [])]
    merged = None
    for i, df in enumerate(marked):
        right = _with_missing_keys(df, i, counts, key)
        if dealers:
            own = hot.filter(F.col("_largest") == i)
            others = _repeated(right.join(F.broadcast(own), _is_hot(key), "left_anti") if i in dealers else right, hot, key)
            right = others.union(_dealt(right, own, key)) if i in dealers else others
        if merged is None:
            merged = right
            continue
        right = right.withColumnsRenamed({c: f"_other{c}" for c in [*same, "_copies"]})
        merged = merged.join(right, [quoted(c).eqNullSafe(quoted(f"_other{c}")) for c in same])
        if dealers:
            merged = merged.withColumn("_copies", F.col("_copies") * F.col("_other_copies"))
        merged = merged.drop(*[f"_other{c}" for c in [*same, "_copies"]])
    if dealers:
        # Only the survey that deals a key has copies, at most about `split_rows` per share.
        copy = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))
        merged = merged.withColumn("_copy", copy).drop("_salt", "_copies", "_copy")
    return merged.drop("_origin")


def merge_unique_surveys(
    surveys: Mapping[str, DataFrame | None], key: str = SURVEY_KEY
) -> DataFrame:
    """`merge_surveys` for surveys with one row per key: one shuffle for all of them.

    The rows are stacked and gathered by key. A key that repeats within a
    survey fails the job instead of losing a row. A row without a key matches none.
    """
    present = {
        code: prefix_columns(df, code, [key]) for code, df in surveys.items() if df is not None
    }
    if not present:
        raise ValueError("no survey to merge")
    tagged = [
        df.select(
            F.col(key),
            F.struct(*[quoted(c) for c in df.columns if c != key]).alias(code),
        )
        for code, df in present.items()
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    once = stacked.groupBy(key).agg(
        *[F.first(F.col(c), ignorenulls=True).alias(c) for c in present],
        *[F.count(F.col(c)).alias(f"_rows_{c}") for c in present],
    )
    most = F.greatest(F.lit(0), *[F.col(f"_rows_{c}") for c in present])
    # A filter, since a column nobody reads would be pruned together with the check.
    unique = F.when(most <= 1, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("key repeats within a survey: "), F.col(key).cast("string")))
    )
    return once.filter(unique).select(key, *[F.col(f"{c}.*") for c in present])


def count_related(
    rows: DataFrame, related: DataFrame, on: str, by: list[str], name: str = "related", split_rows: int = SPLIT_ROWS
) -> DataFrame:
    """Rows of `related` that belong to each group of `rows`, each counted once per group.

    Both sides are collapsed before they meet: `related` to a count per id,
    `rows` to the distinct (id, group) pairs. So neither repeated ids nor many
    rows per id multiply. An id with very many groups is dealt over tasks. Null ids have no
    related rows.
    """
    counts = related.filter(quoted(on).isNotNull()).groupBy(quoted(on)).agg(F.count(F.lit(1)).alias("_n"))
    pairs = rows.select(quoted(on), *[quoted(c) for c in by]).distinct()
    return (
        skew_join(pairs, counts, [on], "left", split_rows)
        .groupBy(*[quoted(c) for c in by])
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(name))
    )


def add_related_count(
    rows: DataFrame, related: DataFrame, on: str, name: str = "related", split_rows: int = SPLIT_ROWS
) -> DataFrame:
    """Each row with the number of `related` rows of its id, 0 when there is none.

    Rows of null ids stay out of the join. Ids with more than `split_rows` rows stay where
    they are: their counts, at most one per `split_rows` rows, are broadcast.
    """
    given, own = rows.filter(quoted(on).isNotNull()), [c for c in rows.columns if c != on]
    counts = related.groupBy(quoted(on).alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
    hot = given.groupBy(quoted(on).alias("_hot")).agg(F.count(F.lit(1)).alias("_rows"))
    hot = hot.filter(F.col("_rows") > split_rows).select("_hot")
    hot_counts = hot.join(counts, F.col("_hot") == F.col("_id"), "left").select("_hot", "_n")
    none = rows.filter(quoted(on).isNull()).withColumn("_n", F.lit(None).cast("bigint"))
    large = given.join(F.broadcast(hot_counts), quoted(on) == F.col("_hot"))
    small = given.join(F.broadcast(hot), quoted(on) == F.col("_hot"), "left_anti")
    small = small.join(counts, quoted(on) == F.col("_id"), "left")
    columns = [*map(quoted, [on, *own]), F.coalesce("_n", F.lit(0)).alias(name)]
    return reduce(DataFrame.union, [part.select(*columns) for part in (small, large, none)])


def skew_join(
    rows: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner", split_rows: int = SPLIT_ROWS
) -> DataFrame:
    """`rows` with the columns of `small`, which has one row per key, where the keys are equal
    (null keys too).

    The rows per key are counted first, combined before the shuffle. A key with more than
    `split_rows` rows is dealt over as many shares as that takes, by the content of its
    rows, so that a task that runs again deals alike; `small` repeats its row of that key
    once per share. Adaptive execution can't do this where the rows come out of an
    aggregate, or where a key stays below its size limits. The broadcast list of such
    keys has at most one entry per `split_rows` rows.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join: {how}")
    keys = list(keys)
    counts = rows.groupBy(*[quoted(k).alias(f"_h{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("_rows"))
    hot = counts.filter(F.col("_rows") > split_rows)
    parts = F.ceil(F.col("_rows") / split_rows).cast("int").alias("_parts")
    hot = F.broadcast(hot.select(*[f"_h{i}" for i in range(len(keys))], parts))
    is_hot = reduce(Column.__and__, [quoted(k).eqNullSafe(F.col(f"_h{i}")) for i, k in enumerate(keys)])
    plain = [quoted(f.name) for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
    share = F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*plain), F.col("_parts"))).cast("int")
    dealt = rows.join(hot, is_hot, "left").select(*map(quoted, rows.columns), share.alias("_share"))
    added = [c for c in small.columns if c not in keys]
    shares = F.when(F.col("_parts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("_parts") - 1))
    replicas = small.join(hot, is_hot, "left").select(
        *[quoted(k).alias(f"_k{i}") for i, k in enumerate(keys)], *map(quoted, added), F.explode(shares).alias("_replica")
    )
    same = reduce(Column.__and__, [quoted(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    joined = dealt.join(replicas, same & (F.col("_share") == F.col("_replica")), how)
    return joined.select(*map(quoted, rows.columns), *map(quoted, added))


def code_table(spark: SparkSession, labels: Mapping[int, str]) -> DataFrame:
    """A code dictionary as a table (code, label)."""
    return spark.createDataFrame(sorted(labels.items()), "code int, label string")


def add_label(df: DataFrame, code: Column, labels: Mapping[int, str], name: str) -> DataFrame:
    """Look a code up in its table; unknown codes give null.

    The table has one row per dictionary entry, so broadcasting it is bounded by
    the dictionary, whatever the size of `df`.
    """
    table = code_table(df.sparkSession, labels).select(
        F.col("code").alias("_code"), F.col("label").alias(name)
    )
    return df.join(F.broadcast(table), code == F.col("_code"), "left").drop("_code")
