from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from campusgrid.operators import commits
from campusgrid.operators import snapshots as S
from campusgrid.operators.joins import skew_join
from campusgrid.plans.run import RunFailed, batch_id, run, run_summary
from campusgrid.sources import sinks as K

LOADED = (
    "school_name string, school_state string, student_size bigint, "
    "admission_rate double, completion_rate double"
)
SAMPLE = [("Test University", "CA", 10000, 0.75, 0.65), ("Sample College", "NY", 5000, 0.85, 0.70)]


@pytest.fixture
def store(spark, tmp_path):
    return S.SnapshotStore(spark, str(tmp_path / "lake"))


def test_latest_compares_the_whole_stamp(spark, store):
    store.store(spark.range(1), "a", "d", version="20240101_230000")
    store.store(spark.range(2), "a", "d", version="20240102_010000")
    store.store(spark.range(9), "a", "d_more", version="20250101_000000")
    assert store.load_latest("a", "d").count() == 2
    assert store.load_version("a", "d", "20240101_230000").count() == 1
    assert store.load_as_of("a", "d", "20240102_000000").count() == 1
    assert store.load_as_of("a", "d", "20230101_000000") is None
    assert store.load_version("a", "d", "20200101_000000") is None
    assert store.load_latest("a", "none") is None
    listed = [r.version for r in S.versions(store.catalogue(), "a", "d").collect()]
    assert listed == ["20240102_010000", "20240101_230000"]
    assert S.count_versions(store.catalogue(), "a", "d") == 2


def test_versions_are_never_replaced(spark, store):
    store.store(spark.range(1), "a", "d", version="20240101_000000")
    with pytest.raises(FileExistsError, match="already exists"):
        store.store(spark.range(2), "a", "d", version="20240101_000000")
    assert store.load_latest("a", "d").count() == 1
    assert store.unpublished("a", "d") == []
    with pytest.raises(ValueError):
        store.store(spark.range(1), "a", "d", file_format="xlsx")


def test_csv_version_keeps_types_and_text(spark, store):
    df = spark.createDataFrame([("007", 1.5, " x\ny "), (None, None, "b, \"c\"")], "a string, b double, c string")
    store.store(df, "a", "d", {"why": "test"}, "csv", "20240101_000000")
    back = store.load_latest("a", "d")
    assert back.dtypes == df.dtypes
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    row = S.metadata(store.catalogue(), "a", "d").first()
    assert (row.row_count, row.column_count, row.file_format) == (2, 3, "csv")
    assert (row["columns"], row.params, row.dtypes["b"]) == (
        ["a", "b", "c"],
        {"why": "test"},
        "double",
    )


def test_empty_catalogue(store):
    assert store.catalogue().count() == 0
    assert tuple(S.summary(store.catalogue()).first()) == (0, 0, 0, None)


def test_compact(spark, store):
    for i in range(4):
        store.store(spark.range(i), "a", "d", version=f"2024010{i + 1}_000000")
    before = store.catalogue().orderBy("version").collect()
    assert store.compact_catalogue() == 3
    store.store(spark.range(9), "a", "d", version="20240105_000000")
    opened = S.SnapshotStore(spark, store.root)
    assert opened.log.checkpointed() == 3
    assert opened.catalogue().orderBy("version").collect()[:4] == before
    sizes = [opened.load_version("a", "d", f"2024010{i}_000000").count() for i in range(1, 6)]
    assert sizes == [0, 1, 2, 3, 9]


def test_a_checkpoint_is_written_on_the_way(spark, store, monkeypatch):
    monkeypatch.setattr(commits, "CHECKPOINT_EVERY", 3)
    monkeypatch.setattr(commits, "GROUP", 2)
    for i in range(7):
        store.store(spark.range(1), "a", "d", version=f"2024010{i + 1}_000000")
    assert store.log.checkpointed() >= 3
    listed = [r["commit"] for r in store.catalogue().orderBy("version").collect()]
    assert listed == list(range(7))


def test_two_stores_in_one_second(spark, store, monkeypatch):
    monkeypatch.setattr(S, "stamp", lambda pattern: "20240101_000000")
    names = [store.store(spark.range(k), "a", "d") for k in (1, 2, 3)]
    assert names == ["20240101_000000", "20240101_000000_0001", "20240101_000000_0002"]
    assert store.load_latest("a", "d").count() == 3
    assert store.load_as_of("a", "d", "20240101_000000_0001").count() == 2
    at = store.catalogue().select(S.as_stamp(F.col("version")).cast("string").alias("at")).distinct().collect()
    assert [r["at"] for r in at] == ["2024-01-01 00:00:00"]


def test_stores_at_the_same_time_all_succeed(spark, tmp_path):
    root = str(tmp_path / "lake")
    with ThreadPoolExecutor(6) as pool:
        names = list(pool.map(lambda k: S.SnapshotStore(spark, root).store(spark.range(k), "a", "d"), range(6)))
    found = S.SnapshotStore(spark, root).catalogue().collect()
    assert sorted(r["commit"] for r in found) == list(range(6))
    assert len(set(names)) == 6 and sorted(r["row_count"] for r in found) == list(range(6))


@pytest.mark.parametrize("local", [True, False])
def test_publishing_never_replaces(spark, tmp_path, local):
    files = commits.Files(spark, str(tmp_path))
    files._local = local
    for k in range(2):
        files.write(f"{tmp_path}/own{k}", f"text {k}")
    files.publish(f"{tmp_path}/own0", f"{tmp_path}/deep/0.json")
    with pytest.raises(commits.Taken):
        files.publish(f"{tmp_path}/own1", f"{tmp_path}/deep/0.json")
    assert (tmp_path / "deep" / "0.json").read_text() == "text 0"
    for k in range(2):
        spark.range(k + 1).write.parquet(f"{tmp_path}/table{k}")
    files.publish(f"{tmp_path}/table0", f"{tmp_path}/deep/table")
    with pytest.raises(commits.Taken):
        files.publish(f"{tmp_path}/table1", f"{tmp_path}/deep/table")
    assert spark.read.parquet(f"{tmp_path}/deep/table").count() == 1


def test_a_loser_of_a_race_tries_the_next_number(spark, store):
    first = S.SnapshotStore(spark, store.root)
    real, calls = store.log.files.publish, []

    def slow(source, target):
        if not calls:
            calls.append(first.store(spark.range(5), "a", "d", version="20240101_000000"))
        real(source, target)

    store.log.files.publish = slow
    with pytest.raises(FileExistsError):
        store.store(spark.range(1), "a", "d", version="20240101_000000")
    calls.clear()
    first.store = lambda *a, **k: None
    store.store(spark.range(1), "a", "d", version="20240102_000000")
    assert [r["commit"] for r in store.catalogue().orderBy("commit").collect()] == [0, 1]


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_a_failure_before_the_commit_leaves_no_version(spark, store, monkeypatch, file_format):
    def broken(make):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(store.log, "publish", broken)
        with pytest.raises(RuntimeError):
            store.store(spark.range(3), "a", "d", file_format=file_format, version="20240101_000000")
    assert store.catalogue().count() == 0 and store.load_latest("a", "d") is None
    assert len(store.unpublished("a", "d")) == 1
    store.store(spark.range(2), "a", "d", file_format=file_format, version="20240101_000000")
    assert store.load_latest("a", "d").count() == 2
    assert len(store.unpublished("a", "d")) == 1


def test_equal_content_is_kept_once(spark, store):
    df = spark.createDataFrame([(1, "", {"k": 1, "j": 2}), (1, None, None), (1, None, None)], "a int, b string, m map<string,int>")
    turned = spark.createDataFrame([(1, None, None), (1, "", {"j": 2, "k": 1}), (1, None, None)], df.schema)
    for day, rows in enumerate([df, turned.repartition(3), df.limit(2), df.withColumnRenamed("b", "c")]):
        store.store(rows, "a", "d", version=f"2024010{day + 1}_000000", share=True)
    found = store.catalogue().orderBy("version").collect()
    places = [r["location"] for r in found]
    assert places[0] == places[1] and len(set(places)) == 3
    assert store.load_version("a", "d", "20240102_000000").count() == 3
    assert store.unpublished("a", "d") == []


def listing(spark):
    rows = [("s", f"d{k}", f"202401{day:02d}_120000") for k in range(2) for day in range(1, 16)]
    rows += [("t", "hot", f"2024{m:02d}01_{s:06d}") for m in range(1, 13) for s in range(0, 50)]
    return spark.createDataFrame(rows, "source string, dataset string, version string")


def test_retention(spark):
    catalogue = listing(spark)
    total = catalogue.count()
    kept, gone = S.newest(catalogue, 10), S.expired_by_count(catalogue, 10)
    assert kept.count() == 30
    assert gone.count() == total - 30
    assert kept.intersect(gone).count() == 0
    now = datetime(2024, 7, 1, tzinfo=timezone.utc)
    old = [r.version for r in S.expired_by_age(catalogue, 90, now).collect()]
    assert old and max(old) < "20240402_000000"
    assert S.expired_by_count(catalogue, 10_000).count() == 0


@pytest.mark.parametrize("n", [1, 15, 51, 600, 2000])
def test_newest_of_any_number(spark, n):
    rows = [tuple(r) for r in listing(spark).collect()]
    rows += [("u", None, f"20240101_0000{k % 3:02d}_{k:04d}") for k in range(90)] + [(None, "x", "20240101")]
    want = []
    for key in {r[:2] for r in rows}:
        want += sorted([r for r in rows if r[:2] == key], key=lambda r: r[2])[-n:]
    df = spark.createDataFrame(rows, "source string, dataset string, version string")
    assert sorted(map(tuple, S.newest(df, n).collect()), key=str) == sorted(want, key=str)
    gone = sorted(map(tuple, S.expired_by_count(df, n).collect()), key=str)
    assert gone == sorted(set(rows) - set(want), key=str)


def test_catalogue_questions(spark, rows_of):
    catalogue = listing(spark)
    assert rows_of(S.sources(catalogue)) == [("s",), ("t",)]
    assert rows_of(S.datasets(catalogue, "s")) == [
        ("s", "d0", 15, "20240115_120000"),
        ("s", "d1", 15, "20240115_120000"),
    ]
    assert tuple(S.summary(catalogue).first()) == (2, 3, 630, "20241201_000049")


# --- table load ------------------------------------------------------------


def test_load_modes(spark, tmp_path):
    df = spark.createDataFrame(SAMPLE, LOADED)
    path = str(tmp_path / "t")
    assert K.load_table(df, "loads", "replace", path)["rows_inserted"] == 2
    stats = K.load_table(df, "loads", "append", path)
    assert (stats["rows_before"], stats["rows_after"], stats["rows_inserted"]) == (2, 4, 2)
    with pytest.raises(K.LoadError, match="exists"):
        K.load_table(df, "loads", "fail", path)
    with pytest.raises(K.LoadError, match="no rows"):
        K.load_table(df.limit(0), "loads", "replace", path)
    assert K.table_rows(spark, "loads") == 4
    assert K.load_table(df, "loads", "replace", path)["rows_after"] == 2
    K.drop_table(spark, "loads")
    assert K.table_rows(spark, "loads") == 0
    with pytest.raises(ValueError):
        K.load_table(df, "loads", "upsert")


def test_partitioned_table(spark, tmp_path):
    df = spark.createDataFrame(SAMPLE, LOADED)
    K.load_table(df, "by_state", "replace", str(tmp_path / "p"), ("school_state",))
    plan = spark.table("by_state").filter("school_state = 'CA'")
    assert plan.count() == 1
    assert len(plan.inputFiles()) == 1
    K.drop_table(spark, "by_state")


def test_types_for_a_database(spark):
    df = spark.sql(
        "SELECT 1 AS i, TIMESTAMP '2024-01-02 03:04:05' AS t, DATE '2024-01-02' AS d, "
        "CAST('NaN' AS DOUBLE) AS n, 'x' AS s, CAST(NULL AS BIGINT) AS b"
    )
    out = K.for_database(df)
    assert dict(out.dtypes) == {
        "i": "int",
        "t": "string",
        "d": "string",
        "n": "double",
        "s": "string",
        "b": "bigint",
    }
    assert tuple(out.first()) == (1, "2024-01-02 03:04:05", "2024-01-02", None, "x", None)


def test_raw_json_keeps_nulls_and_is_not_replaced(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], "id int, `school.name` string")
    path = K.write_raw_json(df, str(tmp_path), "raw", "20240101_000000")
    assert spark.read.text(path).first().value == '{"id":1,"school.name":null}'
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        K.write_raw_json(df, str(tmp_path), "raw", "20240101_000000")


def test_staging_and_processed(spark, tmp_path):
    df = spark.createDataFrame(SAMPLE, LOADED)
    parquet, text = K.write_staging(df, str(tmp_path), "s", "1")
    assert spark.read.parquet(parquet).exceptAll(df).count() == 0
    assert spark.read.csv(text, df.schema, header=True).exceptAll(df).count() == 0
    assert K.write_processed(df, str(tmp_path), at="2024_01_02_030405").endswith(
        "processed_2024_01_02_030405.csv"
    )


# --- the staged run --------------------------------------------------------

RAW = LOADED.replace("_rate", "_rate").replace("admission_rate", "admission_rate_overall").replace(
    "completion_rate", "completion_rate_overall"
)


def test_run(spark, tmp_path):
    rows = SAMPLE + [SAMPLE[0], (" Bad ", "tx", -5, 0.1, 0.2), (" Good ", "tx", 7, 0.1, 0.2)]
    df = spark.createDataFrame(rows, RAW)
    log = run(df, str(tmp_path / "w"), "run_table", ["student_size"], table_path=str(tmp_path / "t"))
    got = [
        (r.stage, r.status, r.records_in, r.records_out, r.removed)
        for r in log.orderBy("position").collect()
    ]
    assert got == [
        ("extract", "success", 0, 5, 0),
        ("validate", "success", 5, 3, 2),
        ("transform", "success", 3, 3, 0),
        ("load", "success", 3, 3, 0),
    ]
    loaded = {r.school_name: r.school_state for r in spark.table("run_table").collect()}
    assert loaded == {"Test University": "CA", "Sample College": "NY", "Good": "TX"}
    total = run_summary(log).first()
    assert (total.status, total.extracted, total.loaded, total.failed_stage) == ("success", 5, 3, None)
    K.drop_table(spark, "run_table")


def test_run_stops_at_the_first_failure(spark, tmp_path):
    with pytest.raises(RunFailed, match="validate") as failure:
        run(spark.range(3), str(tmp_path), "never")
    log = failure.value.log
    rows = log.orderBy("position").collect()
    assert [(r.stage, r.status) for r in rows] == [("extract", "success"), ("validate", "failed")]
    assert "school_name" in rows[1].error
    assert run_summary(log).first().failed_stage == "validate"
    assert not spark.catalog.tableExists("never")


def test_run_on_nothing(spark, tmp_path):
    with pytest.raises(RunFailed, match="no rows") as failure:
        run(spark.createDataFrame([], RAW), str(tmp_path), "never")
    rows = failure.value.log.orderBy("position").collect()
    assert [(r.stage, r.status) for r in rows] == [("extract", "success"), ("validate", "failed")]
    assert "no rows" in rows[1].error


def test_batch_id():
    assert len(batch_id()) == len("20240101_000000_abcdef")
    assert batch_id() != batch_id()


# --- layers ------------------------------------------------------------------


def test_newest_table_of_each_layer(spark, tmp_path):
    raw, staging = tmp_path / "raw", tmp_path / "staging"
    raw.mkdir()
    (raw / "college_20240101_000000.json").write_text('{"id": 1}\n')
    (raw / "zzz_notes.json").write_text("{}\n")
    (raw / ".hidden_20300101_000000.json").write_text("{}\n")
    K.write_raw_json(spark.range(3).selectExpr("id AS `school.size`", "'x' AS name"), str(raw), "a", "20240102_000000")
    K.write_staging(spark.range(4), str(staging), "s", "20240101_000000")
    layers = {"raw": f"{raw}/", "staging": str(staging), "processed": str(tmp_path / "none")}
    listed = {(r["layer"], r["name"]): (str(r["at"]), r["files"]) for r in S.layer_files(spark, layers).collect()}
    assert listed["raw", "zzz_notes.json"] == ("None", 1)
    assert ("raw", ".hidden_20300101_000000.json") not in listed and len(listed) == 5
    report = {r["layer"]: tuple(r)[1:] for r in S.latest_layer_report(spark, layers, {"staging": ".parquet"}).collect()}
    at = datetime(2024, 1, 2)
    assert report == {
        "raw": ("a_20240102_000000.json", at, 3, 2),
        "staging": ("s_20240101_000000.parquet", datetime(2024, 1, 1), 4, 1),
    }
    assert S.latest_layer_report(spark, {"x": str(tmp_path / "none")}).count() == 0


def test_stamps(spark):
    names = ["a_20240102_030405.json", "p_2024_01_02_030405.csv", "20241399_000000", "none", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r["at"] for r in df.select(S.name_stamp(F.col("n")).alias("at")).collect()]
    assert got == [datetime(2024, 1, 2, 3, 4, 5)] * 2 + [None] * 3


def test_skewed_keys_are_dealt(spark, rows_of):
    rows = spark.range(5000).selectExpr("IF(id % 10 < 7, 1, IF(id % 10 = 9, NULL, id)) AS k", "id AS v")
    small = spark.createDataFrame([(1, "hot"), (None, "none"), (8, "one")], "k bigint, w string")
    for how in ("inner", "left"):
        out = skew_join(rows, small, ["k"], how, split_rows=200)
        plain = rows.join(small.withColumnRenamed("k", "j"), F.col("k").eqNullSafe(F.col("j")), how).drop("j")
        assert rows_of(out) == rows_of(plain)
    kept = {name: spark.conf.get(name) for name in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for name, value in zip(kept, ("40", "false", "-1")):
            spark.conf.set(name, value)
        dealt = skew_join(rows, small, ["k"], split_rows=200)
        sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 4001 and max(sizes) < 1000  # 3500 rows share one key
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
