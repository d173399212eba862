"""Line templates and what the stages of the pipeline do with odd tables."""

from __future__ import annotations

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from campusgrid.llm import lines, similar
from campusgrid.llm.queries import ORACLES, QUERIES
from checks import compare

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside.
CLASHING = ("_id", "_key", "_hit", "_lines", "_mark", "_one", "_text", "_again", "n_lines", "n_dropped", "c0", "c1", "line", "set_id")


def docs(spark, texts, ids=None):
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
def test_query_agrees_with_sql(spark, monkeypatch, folder):
    monkeypatch.setitem(compare.QUERIES, "op8", QUERIES["op8_line_templates"])
    monkeypatch.setitem(compare.ORACLES, "op8", ORACLES["op8_line_templates"])
    assert compare.difference(spark, folder, "op8")[0] is None


NAMES = ["Ann", "Bob", "Cleo", "Dan", "Eve", "Finn", "Gus", "Hal", "Ivy", "Joe"]


def test_a_leaf_holds_several_templates(spark):
    one = [f"own text number {w} of one\nplease note that user {n} wrote all of this" for w, n in zip("abcdefghij", NAMES)]
    two = [f"other words {w} here\nplease note that user {n} owns none of them" for w, n in zip("klmnopqrst", NAMES)]
    kept = {r["doc_id"]: r["text"] for r in lines.drop_recurring(docs(spark, one + two)).collect()}
    assert all("note" not in text for text in kept.values())
    assert kept[0] == "own text number a of one"
    few = lines.drop_recurring(docs(spark, one[:9] + two[:9])).collect()
    assert all(r["n_dropped"] == 0 for r in few)


def test_copies_alone_are_no_template(spark):
    text = "some line of prose\nand another one"
    out = lines.drop_recurring(docs(spark, [text] * 30 + [text + " more"] * 30)).collect()
    assert all(r["n_dropped"] == 0 for r in out)


def test_very_long_text_of_recurring_lines(spark):
    shared = [f"the menu {k}x goes here" for k in range(3)]
    long = "\n".join(shared * 20_000 + ["its own end"])
    texts = [long] + [f"{shared[k % 3]}\nprose {w} by itself" for k, w in enumerate("abcdefghijklmnop")]
    out = lines.drop_recurring(docs(spark, texts)).orderBy("doc_id").first()
    assert (out["text"], out["n_lines"], out["n_dropped"]) == ("its own end", 60_001, 60_000)


def odd(spark):
    texts = [None, "", " ", "\n", None, "same text of five words or more", "same text of five words or more", "x" * 3000, "é 中文 😀"]
    rows = docs(spark, texts, [5, None, 3, 4, 5, 7, 8, 9, None])
    rows = rows.unionByName(rows.limit(3))
    return rows.withColumns({name: F.lit(f"own {name}") for name in CLASHING})


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[:-1]], ids=lambda s: s.__name__)
def test_stages_keep_columns_of_any_name(spark, stage):
    df = odd(spark)
    out = stage(spark, df, SMALL)
    assert out.columns == df.columns
    for row in out.collect():
        assert all(row[name] == f"own {name}" for name in CLASHING)
    empty = stage(spark, df.limit(0), SMALL)
    assert empty.columns == df.columns and empty.count() == 0


def test_last_stage_on_odd_and_empty_tables(spark):
    stage = corpus_pipeline.STAGES[-1][1]
    df = odd(spark)
    out = stage(spark, df, SMALL)
    assert out.count() == df.count() and out.filter("n_tokens = 0").count() == df.filter("coalesce(text, '') = ''").count()
    assert stage(spark, df.limit(0), SMALL).count() == 0


def test_near_duplicates_of_odd_rows(spark):
    df = odd(spark)
    kept = similar.drop_near_duplicates(df).collect()
    assert sum(r["text"] == "same text of five words or more" for r in kept) == 1
    blank = [r for r in kept if not (r["text"] or "").strip()]
    assert len(blank) == df.filter("coalesce(trim(both ' \n' from text), '') = ''").count()


def test_stages_without_labels_or_items(spark, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    df = odd(spark)
    for stage in (corpus_pipeline.good_quality, corpus_pipeline.without_benchmarks):
        assert stage(spark, df, str(tmp_path)).count() == df.count()
