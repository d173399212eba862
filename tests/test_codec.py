from __future__ import annotations

import datetime
import decimal
import gzip
import re
import time
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from campusgrid.session import FREE_SHUFFLES
from campusgrid.sources import codec
from campusgrid.sources import records as R
from campusgrid.sources import sinks as K
from checks import load_all
from checks.registry import QUERIES
from checks.tables import instructions

TEXTS = [
    None, "", " ", "\\", "\\N", "\\\\N", "\\n", "a\nb", "a\r\nb", "\r", "\0", "\\0", "\\\0", '"', '""', ",", ' "x", ', "#", "é中😀",
    "\ufeff", "null", "NaN", "\t x \t", "\u2028", "\x85", "x" * 50_000, "\\\\\\n\n\\",
]


def test_text_cells_come_back(spark, tmp_path):
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(TEXTS)], "i int, text string, `a\n\"b\\` string")
    path = K.write_csv(df.repartition(3), str(tmp_path / "t.csv"))
    back = R.read_table(spark, path)
    assert back.schema == df.schema
    assert [tuple(r) for r in back.orderBy("i").collect()] == [(i, t, t) for i, t in enumerate(TEXTS)]
    # One line per row and one header line per file: the files can be split.
    files = [f for f in (tmp_path / "t.csv").iterdir() if f.name.startswith("part")]
    lines = sum(len(f.read_bytes().split(b"\n")) - 1 for f in files)
    assert lines == len(TEXTS) + len(files)


def test_every_type_comes_back(spark, tmp_path):
    schema = (
        "b boolean, y tinyint, s smallint, i int, l bigint, f float, d double, m decimal(38,9), t timestamp, n timestamp_ntz, "
        "a date, x binary, r array<string>, p map<string,int>, c struct<u:string,v:timestamp>"
    )
    at = datetime.datetime(2024, 1, 2, 3, 4, 5, 123456)
    rows = [
        (True, 1, -2, 3, 2**63 - 1, 0.1, 1e-300, decimal.Decimal("123456789.123456789"), at, at, at.date(), b"\x00\xff\n", ["", None, "a\nb"], {"k": None}, ("", at)),
        (False, 0, 0, 0, -(2**63), float("inf"), float("-inf"), decimal.Decimal(0), at.replace(microsecond=1), at.replace(microsecond=0), datetime.date(1, 1, 1), b"", [], {}, (None, None)),
        (None,) * 15,
    ]
    df = spark.createDataFrame(rows, schema)
    back = codec.read(spark, codec.write(df, str(tmp_path / "t.csv")))
    assert back.schema == df.schema
    key = str
    assert sorted(map(key, back.collect())) == sorted(map(key, df.collect()))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("\\nr0N\n\r\0\",ab é"), max_size=12)), min_size=1, max_size=60))
def test_any_text_comes_back(spark, tmp_path_factory, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    path = codec.write(df, str(tmp_path_factory.mktemp("any") / "t.csv"))
    assert [r["t"] for r in codec.read(spark, path).orderBy("i").collect()] == texts


def test_raw_json_comes_back(spark, tmp_path):
    at = datetime.datetime(2024, 1, 2, 3, 4, 5, 123456)
    df = spark.createDataFrame([(1, "", "a\nb", at), (2, None, "\\N", None)], "id int, `school.name` string, t string, at timestamp")
    path = K.write_raw_json(df, str(tmp_path), "raw")
    back = R.read_records(spark, path)
    assert back.schema == df.schema and back.orderBy("id").collect() == df.orderBy("id").collect()


def test_data_without_types_is_refused(spark, tmp_path):
    (tmp_path / "other.csv").mkdir()
    with pytest.raises(ValueError, match="no types"):
        codec.read(spark, str(tmp_path / "other.csv"))


def test_a_broken_line_fails(spark, tmp_path):
    path = codec.write(spark.createDataFrame([(1, 2)], "a int, b int"), str(tmp_path / "t.csv"))
    (tmp_path / "t.csv" / "part-x.csv").write_text("a,b\n1,x\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        codec.read(spark, path).collect()


def test_empty_tables_and_picked_columns(spark, tmp_path):
    df = spark.createDataFrame([], "a int, b string")
    assert R.read_table(spark, K.write_csv(df, str(tmp_path / "e.csv"))).schema == df.schema
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    path = K.write_csv(df, str(tmp_path / "p.csv"))
    assert R.read_table(spark, path, df.select("b").schema).collect() == [("x",)]


def _shuffle_files(spark) -> set[str]:
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {str(f) for folder in folders for f in Path(folder).rglob("shuffle_*.data")}


def test_compressed_files_hold_few_rows_each(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(codec.COMPRESSED, "maxRecordsPerFile", 10)
    df = spark.createDataFrame([(i, t) for i in range(2) for t in TEXTS], "i int, t string").coalesce(1)
    path = K.write_csv(df, str(tmp_path / "t.csv"), compressed=True)
    files = [f for f in Path(path).iterdir() if f.name.startswith("part")]
    assert len(files) == -(-2 * len(TEXTS) // 10) and all(f.name.endswith(".csv.gz") for f in files)
    assert all(len(gzip.decompress(f.read_bytes()).split(b"\n")) <= 12 for f in files)
    assert sorted(map(str, R.read_table(spark, path).collect())) == sorted(map(str, df.collect()))


def test_portions_make_the_whole_table(spark, tmp_path):
    """Keys null, repeated, and one with most of the rows."""
    rows = [(None if i % 7 == 0 else "hot" if i % 3 else str(i // 2), i % 20) for i in range(400)]
    left = spark.createDataFrame(rows, "k string, v int")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), (None, 3)] + [(str(i), i) for i in range(0, 200, 2)], "j string, w int")
    df = left.join(right.hint("merge"), left["k"] == right["j"], "left")
    path = K.write_csv(df, str(tmp_path / "t.csv"), portion_by="k")
    assert sorted(map(str, R.read_table(spark, path).collect())) == sorted(map(str, df.collect()))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        K.write_csv(df, path, portion_by="k")


def test_a_portion_of_a_sheet_takes_its_own_lines_and_orders(spark):
    sheet = instructions(spark, "/root/testdata/sf0.001")
    portions = codec._portions(sheet, "Instruction ID", 4)
    assert sum(p.count() for p in portions) == sheet.count()
    for portion in portions:
        text = portion._jdf.queryExecution().optimizedPlan().toString()
        for key in ("l_orderkey", "o_orderkey"):
            assert re.search(rf"Filter .*xxhash64\(cast\({key}#", text)


def test_a_written_table_leaves_no_shuffle_files(spark, tmp_path):
    before, setting = _shuffle_files(spark), spark.conf.get(FREE_SHUFFLES)
    df = spark.range(1000).repartition(3, "id").groupBy("id").count()
    K.write_csv(df, str(tmp_path / "t.csv"))
    for _ in range(100):  # they are deleted in the background
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(FREE_SHUFFLES) == setting


def test_sheets_take_less_disk_than_plain_text(spark, tmp_path):
    load_all()
    df = QUERIES["s15_sales_sheets"](spark, "/root/testdata/sf0.001")
    files = [f.removeprefix("file:") for f in df.inputFiles()]
    plain = K.write_csv(df, str(tmp_path / "plain.csv"))
    assert df.count() == R.read_table(spark, plain).count() > 0
    size = sum(f.stat().st_size for f in Path(plain).glob("part*"))
    assert sum(Path(f).stat().st_size for f in files) < size / 2
