"""Substring dedup on a De Bruijn graph of word k-mers.

The edges of the graph are the windows of k words. Neighbouring windows of a document
whose smallest m-gram is the same form a path. A path that reads the same wherever
its m-gram occurs doesn't branch: it is shuffled as one unit and compared as a whole.
Where documents branch off, the paths are taken apart again and their edges compared
one by one. The coordinates of paths and edges in their documents then give the
repeated spans, of any length.

A path is known by 128 bits: the fingerprint of its m-gram and that of all its words.
An edge has two fingerprints as well. A text is known by its document and 64 bits of its
own, so that rows of one id are told apart; rows with the same id and text are one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campusgrid.llm.common import written
from campusgrid.llm.hashing import BLANK_SEPARATED, Words, chunks, mixed, signed

WINDOW = 13
GRAM = 5
_LAST = np.int64(2**63 - 1)
_BASE = 0xC2B2AE3D27D4EB4F | 1
_SALT = np.uint64(0x165667B19E3779F9)

#: doc: id (null: the greatest); mark: fingerprint of the text; place: word index << 32 |
#: windows. Covered rows are known to repeat an earlier document.
PATHS = "key bigint, content bigint, doc bigint, mark bigint, place bigint, covered boolean"


def _mark(text: Column) -> Column:
    """Fingerprint that tells apart texts of one id."""
    return F.xxhash64(text)


def _new(*columns: np.ndarray) -> np.ndarray:
    """Rows of sorted columns that differ from the row before."""
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return new


def _firsts(doc: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Rows that hold a text of a document for the first time."""
    order = np.lexsort((mark, doc))
    first = np.zeros(len(doc), dtype=bool)
    first[order] = _new(doc[order], mark[order])
    return first


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    made = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        powers = np.full(n + 1, base, dtype=np.uint64)
        powers[0] = 1
        made.append(np.multiply.accumulate(powers))
    return made[0], made[1]


def _paths(words: Words, size: int) -> tuple[np.ndarray, ...]:
    """text, word index in it, windows, m-gram and content of each path."""
    n = len(words.hashes) - size + 1
    if n <= 0:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(3)) + tuple(np.zeros(0, dtype=np.uint64) for _ in range(2))
    gram = min(GRAM, size)
    grams, _ = words.windows(gram)
    inner = size - gram + 1
    least = grams[:n].copy()
    at = np.arange(n)
    for j in range(1, inner):
        smaller = grams[j : n + j] < least
        least = np.where(smaller, grams[j : n + j], least)
        at = np.where(smaller, np.arange(j, n + j), at)
    owner = words.owner[:n]
    inside = np.arange(n) + size <= words.first[1:][owner]
    # A path ends where the smallest m-gram or the text changes.
    first = inside.copy()
    first[1:] &= ~(inside[:-1] & (at[1:] == at[:-1]) & (owner[1:] == owner[:-1]))
    starts = np.flatnonzero(first)
    counts = np.diff(np.append(starts, n))
    # Windows that reach over the end of a text follow the last path of that text.
    valid = np.concatenate([[0], np.cumsum(inside)])
    counts = valid[starts + counts] - valid[starts]
    up, down = _powers(len(words.hashes))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(words.hashes * up[:-1])])
    ends = starts + counts + size - 1
    content = (sums[ends] - sums[starts]) * down[starts]
    content = mixed(content + counts.astype(np.uint64) * _SALT + (at[starts] - starts).astype(np.uint64))
    return owner[starts], starts - words.first[owner[starts]], counts, least[starts], content


def paths(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """The paths of all documents (doc, mark, text).

    Of equal paths in one batch only those of the smallest document are open; the others
    are covered already, and a text that a document has several times gives its paths once.
    So a hot path costs a row per batch, not per copy.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column(0).to_numpy(zero_copy_only=False)
            mark = batch.column(1).to_numpy(zero_copy_only=False)
            first = _firsts(doc, mark)
            found = []
            for begin, words in chunks(batch.column(2), False, BLANK_SEPARATED):
                text, at, windows, key, content = _paths(words, size)
                text = text + begin
                once = first[text]
                text, place = text[once], ((at << 32) | windows)[once]
                found.append((signed(key[once]), signed(content[once]), doc[text], mark[text], place))
            if not found:
                continue
            key, content, ids, texts, place = (np.concatenate(c) for c in zip(*found))
            order = np.lexsort((ids, content, key))
            key, content, ids, texts, place = key[order], content[order], ids[order], texts[order], place[order]
            least = ids[np.maximum.accumulate(np.where(_new(key, content), np.arange(len(key)), 0))]
            covered = ids > least
            spread = signed(mixed(ids.view(np.uint64) * _SALT + texts.view(np.uint64) + place.view(np.uint64)))
            columns = [np.where(covered, spread, key), content, ids, texts, place, covered]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "content", "doc", "mark", "place", "covered"])

    return docs.select("doc", "mark", "text").mapInArrow(run, PATHS)


def _marks(found: DataFrame) -> DataFrame:
    """Per text of a document: places of covered paths, and of paths whose edges must be
    compared, each once however often the document has the text."""
    path, group = Window.partitionBy("key", "content"), Window.partitionBy("key")
    judged = found.repartition("key").select(
        "doc",
        "mark",
        "place",
        (F.col("covered") | (F.col("doc") > F.min("doc").over(path))).alias("repeated"),
        (F.min("content").over(group) < F.max("content").over(group)).alias("branches"),
    )
    known = judged.filter(F.col("repeated") | F.col("branches"))
    return known.groupBy("doc", "mark").agg(
        F.collect_set(F.when(F.col("repeated"), F.col("place"))).alias("covered"),
        F.collect_set(F.when(~F.col("repeated"), F.col("place"))).alias("open"),
    )


def _edges(docs: DataFrame, marks: DataFrame, size: int) -> DataFrame:
    """Per document: word indexes of single windows that an earlier document has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column(0).to_numpy(zero_copy_only=False)
            mark = batch.column(1).to_numpy(zero_copy_only=False)
            wanted = batch.column(3).to_pylist()
            first = _firsts(doc, mark)
            for begin, words in chunks(batch.column(2), False, BLANK_SEPARATED):
                edge, _ = words.windows(size)
                other = mixed(words.windows(size - 1)[0][: len(edge)] ^ _SALT)
                for t in range(len(words.first) - 1):
                    places = np.array(wanted[begin + t], dtype=np.int64)
                    if not first[begin + t] or not len(places):
                        continue
                    counts = places & 255
                    at = np.repeat((places >> 32) - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
                    where = words.first[t] + at
                    same = np.full(len(at), doc[begin + t])
                    columns = [signed(edge[where]), signed(other[where]), same, np.full(len(at), mark[begin + t]), at]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["edge", "other", "doc", "mark", "at"])

    texts = docs.join(marks.filter(F.size("open") > 0).select("doc", "mark", "open"), ["doc", "mark"])
    edges = texts.select("doc", "mark", "text", "open").mapInArrow(
        run, "edge bigint, other bigint, doc bigint, mark bigint, at bigint"
    )
    same = Window.partitionBy("edge", "other")
    judged = edges.select("doc", "mark", "at", (F.col("doc") > F.min("doc").over(same)).alias("repeated"))
    return judged.filter("repeated").groupBy("doc", "mark").agg(F.collect_set("at").alias("edges"))


def remove_repeats(docs: DataFrame, size: int = WINDOW, digests: bool = False) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, spans (word from, word to) that repeat a
    window of a document with a smaller id, and kept (the other words joined by single
    blanks); with `digests`, kept_sha256 instead of spans and kept.

    Null texts have no words. Documents of equal id don't count as earlier than each
    other, documents without id come after all others. Other columns are ignored.
    """
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(int(_LAST))).alias("doc"),
        _mark(F.coalesce("text", F.lit(""))).alias("mark"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    marks = written(_marks(paths(rows, size)))
    edges = _edges(rows, marks, size)
    spans = marks.select("doc", "mark", "covered").join(edges, ["doc", "mark"], "left")
    texts = rows.join(spans, ["doc", "mark"], "left").select("doc", "text", "covered", "edges")
    outputs = {"kept_sha256": pa.string()} if digests else {"spans": pa.list_(pa.list_(pa.int64())), "kept": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, text, covered, single = (c.to_pylist() for c in batch.columns)
            made: list[list] = [[] for _ in range(3 + len(outputs))]
            for i in range(len(doc)):
                words = text[i].encode().split()
                change = np.zeros(len(words) + 1, dtype=np.int64)
                places = np.array(covered[i] or (), dtype=np.int64)
                np.add.at(change, places >> 32, 1)
                np.add.at(change, (places >> 32) + (places & 255) + size - 1, -1)
                at = np.array(single[i] or (), dtype=np.int64)
                np.add.at(change, at, 1)
                np.add.at(change, at + size, -1)
                gone = np.cumsum(change[:-1]) > 0
                kept = words if not gone.any() else [w for w, g in zip(words, gone.tolist()) if not g]
                text_kept = b" ".join(kept)
                made[0].append(None if doc[i] == _LAST else doc[i])
                made[1].append(len(words))
                made[2].append(len(words) - len(kept))
                if digests:
                    made[3].append(hashlib.sha256(text_kept).hexdigest())
                else:
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                    made[3].append(edge.reshape(-1, 2).tolist())
                    made[4].append(text_kept.decode())
            kinds = [pa.int64(), pa.int64(), pa.int64(), *outputs.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(m, k) for m, k in zip(made, kinds)], names=["doc_id", "n_words", "n_removed", *outputs]
            )

    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "n_words", "n_removed")])
    for name in outputs:
        schema = schema.add(name, T.ArrayType(T.ArrayType(T.LongType())) if name == "spans" else T.StringType())
    return texts.mapInArrow(run, schema)
