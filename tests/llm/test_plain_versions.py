"""Registered outputs beside versions that compare everything with everything."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np

from campusgrid.llm import quality
from campusgrid.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORDS.findall(folded)


def test_contamination_digests(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    windows = defaultdict(set)
    for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        words = words_of(r["text"])
        for i in range(max(1, len(words) - 9) if words else 0):
            windows[tuple(words[i : i + 10])].add(str(r["item_id"]))
    sizes = sorted({len(w) for w in windows})
    want = {}
    for doc_id, text in docs:
        words, hit, items = words_of(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if found := windows.get(tuple(words[i : i + size])):
                    hit.update(range(i, i + size))
                    items |= found
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        want[doc_id] = (len(words), len(hit), len(items), digest, bool(hit))
    rows = QUERIES["op5_decontamination"](spark, SMALL).collect()
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows}
    assert got == want and any(v[4] for v in want.values())


def test_quality_model_equals_a_plain_fit(spark):
    """Ridge by one matrix over all rows, levels by trying every pair of neighbours."""
    generator = np.random.default_rng(5)
    n, width = 240, len(quality.STATISTICS)
    stats = generator.normal(size=(n, width)) * np.arange(1, width + 1)
    label = (stats[:, 0] + generator.normal(size=n) * 0.3 > 0).astype(int)
    calibrate = np.arange(n) % 4 == 0
    rows = [([float(x) for x in s], int(y), bool(c)) for s, y, c in zip(stats, label, calibrate)]
    df = spark.createDataFrame(rows, "stats array<double>, label int, calibrate boolean").repartition(5)
    model = quality.fit(df)
    plain = quality.QualityModel(stats.mean(axis=0), stats.std(axis=0))
    z = plain.features(stats[~calibrate])
    penalty = np.diag([quality.RIDGE] * quality.FEATURES + [1e-6])
    plain.weights = np.linalg.solve(z.T @ z + penalty, z.T @ label[~calibrate])
    assert np.allclose(model.raw(stats), plain.raw(stats), atol=1e-6)
    counts, sums = np.array([3, 1, 2, 4, 1]), np.array([1, 1, 0, 3, 1])
    levels = [*map(float, sums / counts)]
    weights = [*map(float, counts)]
    blocks = [[v, w, 1] for v, w in zip(levels, weights)]
    at = 0
    while at < len(blocks) - 1:
        if blocks[at][0] >= blocks[at + 1][0]:
            a, b = blocks[at], blocks.pop(at + 1)
            blocks[at] = [(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]]
            at = max(0, at - 1)
        else:
            at += 1
    assert np.allclose(quality.pooled(counts, sums), [v for v, _, k in blocks for _ in range(k)])
