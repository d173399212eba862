from __future__ import annotations

import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campusgrid.schema import SAMPLE_INTEGERS, SAMPLE_RATES, SAMPLE_STATES
from campusgrid.sources import surveys as V

SCHEMA = T.StructType(
    [
        T.StructField("UNITID", T.LongType()),
        T.StructField("INSTNM", T.StringType()),
        T.StructField("RATE", T.DoubleType()),
    ]
)


def test_catalogue(spark):
    rows = {r.code: r for r in V.survey_catalogue(spark).collect()}
    assert len(rows) == 13
    assert rows["AL"].frequency == "biennial"
    assert rows["F"].suffixes == ["1A", "2", "3"]
    assert (rows["HD"].years[0], rows["HD"].years[-1]) == (2012, 2023)


def archive(path, name, content, extra=()):
    with zipfile.ZipFile(path, "w") as out:
        for other, text in extra:
            out.writestr(other, text)
        out.writestr(name, content)


def test_archives(spark, tmp_path):
    archive(
        tmp_path / "a.zip",
        "hd2022.csv",
        "UNITID,INSTNM,RATE\n1,Université,0.5\n2,\"B, C\",x\n3,D,1,2,3\n\n4,NA,\n5\n".encode(),
        [("readme.txt", "first")],
    )
    archive(
        tmp_path / "b.ZIP".replace("ZIP", "zip"),
        "HD.CSV",
        "INSTNM,UNITID\nPeña,9\n".encode("latin-1"),
    )
    archive(tmp_path / "c.zip", "notes.txt", "no table here")
    rows = sorted(tuple(r) for r in V.read_archives(spark, str(tmp_path), SCHEMA).collect())
    assert rows == [
        (1, "Université", 0.5),
        (2, "B, C", None),
        (4, "NA", None),
        (5, None, None),
        (9, "Peña", None),
    ]


def test_every_member_and_its_rejected_lines(spark, tmp_path):
    archive(
        tmp_path / "a.zip",
        "two.csv",
        "\ufeffUNITID,INSTNM\n2,\"over\ntwo lines\"\n3,x,y\n".encode(),
        [("one.CSV", "INSTNM,UNITID,RATE\na,1,0.5\nb,c,d,e\n"), ("empty.csv", "")],
    )
    files = spark.read.format("binaryFile").load(str(tmp_path / "a.zip"))
    path = str(tmp_path / "members")
    V.read_members(files, SCHEMA, name="path").write.parquet(path)
    members = spark.read.parquet(path)
    assert sorted(map(tuple, V.rows_of(members).collect())) == [(1, "a", 0.5), (2, "over\ntwo lines", None)]
    rejects = [tuple(r)[1:] for r in V.rejects_of(members).orderBy("member").collect()]
    assert rejects == [("one.CSV", 3, V.TOO_LONG, "b,c,d,e"), ("two.csv", 4, V.TOO_LONG, "3,x,y")]
    assert V.rejects_of(members).first()["archive"].endswith("a.zip")


def test_comprehensive_load(spark, tmp_path):
    archive(tmp_path / "HD2022.zip", "hd.csv", "UNITID,INSTNM,extra\n1,One,9\n2,Two,9\n2,b,c,d\n")
    archive(tmp_path / "IC_2022.zip", "ic.csv", "UNITID,TUITION2\n2,500\n3,x\n")
    archive(tmp_path / "EFFY2022.zip", "effy.csv", "UNITID,EFYTOTLT\n")
    (tmp_path / "SFA2022.zip").write_bytes(b"no archive")
    archive(tmp_path / "EFA2022.zip", "ef.csv", "UNITID\n1\n")
    archive(tmp_path / "EFB2022.zip", "ef.csv", "UNITID\n4\n")
    loaded = V.load_comprehensive(spark, str(tmp_path), 2022, surveys=("hd", "IC", "EFFY", "SFA", "GR", "EF"))
    log = {r["code"]: (r["archives"], r["rows"], r["rejected"], r["status"]) for r in loaded.log.collect()}
    assert log == {
        "HD": (1, 2, 1, "loaded"),
        "IC": (1, 2, 0, "loaded"),
        "EFFY": (0, 0, 0, "skipped"),
        "SFA": (0, 0, 0, "failed"),
        "GR": (0, 0, 0, "skipped"),
        "EF": (2, 2, 0, "loaded"),
    }
    rows = {r["UNITID"]: (r["HD_INSTNM"], r["IC_TUITION2"]) for r in loaded.merged.collect()}
    assert rows == {1: ("One", None), 2: ("Two", 500), 3: (None, None), 4: (None, None)}
    assert [tuple(r)[0:3:2] for r in loaded.rejects.collect()] == [("HD", "hd.csv")]
    nothing = V.load_comprehensive(spark, str(tmp_path), 2012)
    assert nothing.merged is None and nothing.rejects.count() == 0
    assert {r["status"] for r in nothing.log.collect()} == {"skipped"}
    with pytest.raises(ValueError, match="unknown"):
        V.load_comprehensive(spark, str(tmp_path), 2022, surveys=("HD", "XX"))


def test_archive_of_many_chunks(spark, tmp_path):
    lines = "\n".join(f"{i},name {i},{i / 8}" for i in range(25_001))
    archive(tmp_path / "big.zip", "t.csv", f"UNITID,INSTNM,RATE\n{lines}\n")
    out = V.read_archives(spark, str(tmp_path), SCHEMA)
    total = out.agg(F.count("*"), F.sum("UNITID"), F.countDistinct("INSTNM")).first()
    assert tuple(total) == (25_001, 25_000 * 25_001 // 2, 25_001)


def test_sample_rows(spark):
    keys = V.sample_keys(spark, 500)
    for survey in ("HD", "IC", "EF", "EFFY", "SFA", "GR", "ADM"):
        out = V.sample_survey(keys, survey, 2022)
        assert out.count() == 500
        assert out.columns[:5] == ["UNITID", "INSTNM", "STABBR", "CONTROL", "ICLEVEL"]
        assert out.columns[-1] == "YEAR"
        limits = SAMPLE_INTEGERS.get(survey, {}) | SAMPLE_RATES.get(survey, {})
        for name, (low, high) in limits.items():
            got = out.agg(F.min(name), F.max(name)).first()
            assert low <= got[0] <= got[1] < high
    states = {r.STABBR for r in V.sample_survey(keys, "HD", 2022).collect()}
    assert states == set(SAMPLE_STATES)


def test_sample_rows_are_repeatable(spark):
    keys = V.sample_keys(spark, 300)
    once = V.sample_survey(keys, "GR", 2020)
    again = V.sample_survey(keys.repartition(5), "GR", 2020)
    assert once.exceptAll(again).count() == 0
    other = V.sample_survey(keys, "GR", 2021)
    assert once.drop("YEAR").exceptAll(other.drop("YEAR")).count() == 300


def test_sample_columns(spark):
    keys = V.sample_keys(spark, 1)
    assert set(V.sample_survey(keys, "HD", 2020).columns) >= {"CITY", "ZIP", "OBEREG", "WEBADDR", "SECTOR", "HLOFFER"}
    assert len(V.sample_survey(keys, "SFA", 2020).columns) == 13
