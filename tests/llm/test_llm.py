"""Small cases, each beside a plain version or a round trip."""

from __future__ import annotations

import hashlib
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from campusgrid.llm import bpe, brown, chat, decontaminate, language, lines, quality, repeats, similar, spotsigs
from campusgrid.llm.hashing import BLANK_SEPARATED, chunks
from campusgrid.llm.queries import ORACLES, QUERIES
from checks import compare

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def docs(spark, texts, ids=None):
    ids = ids if ids is not None else range(len(texts))
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS)


ODD = [None, "", " ", "\n\n", "one", "one", "word " * 3000, "x" * 5000, "é'll\t½ 12  ab\n 中文😀"]


def texts_of(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_bpe_equals_the_public_library(spark):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    df = docs(spark, ODD).unionByName(texts_of(spark))
    out = bpe.encode(df, RANKS, public_tokenizers.PATTERN, ("ids", "decoded"), ("text",))
    for row in out.collect():
        text = row["text"] or ""
        assert row["ids"] == library.encode_ordinary(text) and row["decoded"] == text.encode()
    again = bpe.decode(out.drop("decoded"), RANKS).first()
    assert again["decoded"] == (again["text"] or "").encode()


def test_bpe_appends_and_edits():
    vocabulary = bpe.Vocabulary(RANKS)
    grown = bpe.PrefixEncoder(vocabulary, b"the thing")
    grown.append(b"ness of it")
    assert grown.ids() == bpe.PrefixEncoder(vocabulary, b"the thingness of it").ids()
    grown.replace(4, 9, b"real")
    assert grown.ids() == bpe.PrefixEncoder(vocabulary, b"the realness of it").ids()


def test_bpe_edits_look_at_few_prefixes():
    vocabulary = bpe.Vocabulary(RANKS)
    pick = random.Random(6)
    text = bytes(pick.choice(b"abcdefgh etnsr") for _ in range(4000)).replace(b" ", b"") + b"e" * 300
    own = bpe.PrefixEncoder(vocabulary, text)
    for case in range(60):
        start = pick.randrange(len(own.data) + 1)
        end = min(len(own.data), start + pick.choice([0, 1, 5, 40]))
        new = bytes(pick.choice(b"etaoin") for _ in range(pick.choice([0, 1, 3, 30])))
        looked = []
        vocabulary.finder = lambda real=vocabulary._finder: Counted(real, looked)
        own.replace(start, end, new)
        del vocabulary.finder
        whole = bpe.PrefixEncoder(vocabulary, own.data)
        assert own.last == whole.last and own.ids() == whole.ids()
        if start < 3500:
            assert max(looked) < len(new) + 12 * vocabulary.longest + 300


class Counted:
    """An automaton that tells how far it was read."""

    def __init__(self, real, looked):
        self.real, self.looked = real, looked

    def iter(self, text):
        for at, found in self.real.iter(text):
            self.looked.append(at)
            yield at, found


def test_bpe_codes_pieces_of_one_length_at_once():
    vocabulary = bpe.Vocabulary(RANKS)
    batch = bpe.BatchEncoder(vocabulary)
    pick = random.Random(5)
    for size in (2, 3, 7, 12, 32):
        pieces = [bytes(pick.choice(b" aehinorst'\xc3\xa9\xff") for _ in range(size)) for _ in range(200)]
        pieces += [(b" thththandoninghe" * 2)[i : i + size] for i in range(3)]
        pieces = [p for p in pieces if p not in RANKS]
        assert batch.ids(pieces) == [bpe.PrefixEncoder(vocabulary, p).ids() for p in pieces]
    few = bpe.BatchEncoder(bpe.Vocabulary({b"a": 0, b"b": 1, b"ab": 2}))
    assert few.ids([b"aba", b"bab"]) == [[2, 0], [1, 2]]
    with pytest.raises(ValueError, match="lacks a byte"):
        few.ids([b"abc"])


def test_bpe_prepares_the_new_words_of_many_texts(monkeypatch):
    pick = random.Random(6)
    word = lambda: "".join(pick.choice("abehin\té.,1 ") for _ in range(pick.randrange(12)))
    texts = [" ".join(word() for _ in range(40)) for _ in range(60)]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    expected = [" ".join(map(str, library.encode_ordinary(t))).encode() for t in texts]
    for held in (bpe.CACHE_BYTES, 30_000):
        monkeypatch.setattr(bpe, "CACHE_BYTES", held)
        coder = bpe.Coder(RANKS, public_tokenizers.PATTERN)
        coder.prepare(texts)
        assert [b" ".join(coder.coded(t)) for t in texts] == expected
    monkeypatch.undo()
    coder = bpe.Coder(RANKS, public_tokenizers.PATTERN)
    plain = "one " + " ".join(f"{'abeh' * (i % 3)}{i}x,y" for i in range(300))
    coder.prepare([plain])
    assert len(coder._tails) == 300  # before any is asked for
    assert b" ".join(coder.coded(plain)) == " ".join(map(str, library.encode_ordinary(plain))).encode()


def test_word_arrays_take_little_memory():
    texts = pa.array(["one two three fifteen " * 200] * 2000)
    tracemalloc.start()
    try:
        found = [len(words.hashes) for _, words in chunks(texts, True, BLANK_SEPARATED)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(found) == 2000 * 800 and peak < 50_000_000


def test_bpe_caches_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 60_000)
    coder = bpe.Coder(RANKS, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    text = " ".join(f"word{i % 700} x{i}y" for i in range(3000))
    assert [int(i) for part in coder.coded(text) for i in part.split()] == library.encode_ordinary(text)
    held = [c._held for c in (coder._pieces, coder._heads, coder._tails)]
    assert sum(2 * h for h in held) <= 60_000 and len(coder._tails) + len(coder._tails._older) < 200


def test_bpe_codes_long_texts_in_sections(spark, monkeypatch):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    pick = random.Random(8)
    monkeypatch.setattr(bpe, "SECTION", 40)
    coder = bpe.Coder(RANKS, public_tokenizers.PATTERN)
    for _ in range(200):
        text = "".join(pick.choice(["a", "Bc", " ", "  ", "\n", " \n", "'s", "12", "\u3000", "é", ". "]) for _ in range(pick.choice([1, 30, 300])))
        assert b" ".join(coder.coded(text)) == " ".join(map(str, library.encode_ordinary(text))).encode()
        assert b"".join(map(coder.decode, coder.coded(text))).decode() == text
    row = bpe.encode(docs(spark, ["word " * 600_000]), RANKS, public_tokenizers.PATTERN, ("n_tokens", "ids_sha256", "decoded_sha256")).first()
    ids = library.encode_ordinary("word " * 600_000)
    assert row["n_tokens"] == len(ids) and row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert row["decoded_sha256"] == hashlib.sha256(b"word " * 600_000).hexdigest()


def plain_repeats(rows):
    first = {}
    for i, w in rows:
        for k in range(len(w) - 12):
            first[tuple(w[k : k + 13])] = min(first.get(tuple(w[k : k + 13]), i), i)
    for i, w in rows:
        gone = set()
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < i:
                gone.update(range(k, k + 13))
        yield i, (len(w), len(gone), hashlib.sha256(b" ".join(x for j, x in enumerate(w) if j not in gone)).hexdigest())


def test_repeats_equal_a_plain_version(spark):
    shared = [f"w{i}" for i in range(40)]
    made = [" ".join(shared), " ".join(["a"] + shared[5:30] + ["b"]), " ".join(shared[:13]), " ".join(shared[:12]), "z " * 60, "z " * 30]
    df = texts_of(spark).select("doc_id", "text").unionByName(docs(spark, made + ODD, range(10_000, 10_100)).select("doc_id", "text"))
    want = dict(plain_repeats([(r["doc_id"], (r["text"] or "").encode().split()) for r in df.collect()]))
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in repeats.remove_repeats(df, digests=True).collect()}
    assert got == want
    spans = repeats.remove_repeats(docs(spark, made[:2]))
    assert [r["spans"] for r in spans.orderBy("doc_id").collect()] == [[], [[1, 26]]]


def test_repeats_tell_apart_texts_of_one_id(spark):
    shared = " ".join(f"w{i}" for i in range(13))
    own = F.concat_ws(" ", *[F.concat(F.lit(f"v{k}x"), F.col("id").cast("string")) for k in range(13)])
    ids = spark.range(20_000)
    made = ids.select(F.concat(F.lit(shared + " x"), F.col("id").cast("string")).alias("text"))
    made = made.unionByName(ids.select(own.alias("text"))).withColumn("digits", F.pmod(F.xxhash64("text"), F.lit(1 << 24)))
    both = made.groupBy("digits").agg(F.collect_list("text").alias("t"), F.count_if(F.col("text").startswith("w0 ")).alias("n"))
    alike = both.filter("n = 1 AND size(t) = 2").first()["t"]
    out = repeats.remove_repeats(docs(spark, [shared, *alike], [1, 2, 2])).collect()
    assert sorted(r["n_removed"] for r in out) == [0, 0, 13]


def test_repeats_gather_a_text_of_one_id_once(spark):
    shared = [f"w{i}" for i in range(40)]
    later = [" ".join(["a", *shared[5:30], "b"])] * 30
    df = docs(spark, [" ".join(shared), *later], [1, *[None] * 30]).repartition(7)
    rows = df.select(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc"), repeats._mark(F.col("text")).alias("mark"), "text")
    marks = repeats._marks(repeats.paths(rows)).filter(F.col("doc") > 1).collect()
    assert len(marks) == 1 and len(marks[0]["covered"]) + len(marks[0]["open"]) <= 15
    assert [r["n_removed"] for r in repeats.remove_repeats(df).collect() if r["doc_id"] is None] == [25] * 30


def plain_components(rows):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    lists = defaultdict(list)
    for i in sorted(sets):
        for j, common in Counter(j for s in sets[i] for j in lists[s]).items():
            if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for s in sets[i]:
            lists[s].append(i)
    return {i: (len(sets[i]), root(i)) for i in sets}


def test_near_duplicates_equal_a_plain_version(spark):
    base = [f"b{i}" for i in range(120)]
    made = []
    for k in range(40):  # a family at the threshold, linked through its members
        copy = list(base)
        for j in range(k % 5):
            copy[(37 * k + 29 * j) % 120] = f"e{k}-{j}"
        made.append(" ".join(copy))
    df = texts_of(spark).select("doc_id", "text").unionByName(docs(spark, made + ODD, range(10_000, 10_100)).select("doc_id", "text"))
    want = plain_components([(r["doc_id"], r["text"]) for r in df.collect()])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in similar.near_duplicates(df).collect()}
    assert got == want
    kept = similar.drop_near_duplicates(df)
    worded = {r["doc_id"] for r in kept.collect() if want[r["doc_id"]][0]}
    assert worded == {c for n, c in want.values() if n}


def test_near_duplicates_by_the_join_beyond_the_broadcast(spark):
    pairs = spark.createDataFrame([(1, 2)], "a bigint, b bigint")
    df = docs(spark, ["a b c d e f"])
    sets = similar.document_sets(df.select("doc_id", "text"), 5).first()
    own = spark.createDataFrame([(sets["set_id"], sets["set_id"])], "a bigint, b bigint")
    assert similar.verified(own.union(pairs), df, 5, 80, picked=0).count() == 1


@pytest.mark.parametrize("bits", [64, 1 << 16])
def test_near_duplicates_broadcast_no_ids(spark, monkeypatch, bits):
    sent, context = [], type(spark.sparkContext)
    real = context.broadcast
    monkeypatch.setattr(context, "broadcast", lambda self, value: sent.append(value) or real(self, value))
    df = docs(spark, [f"a{i} b{i} c d e f{i}" for i in range(300)]).select("doc_id", "text")
    ids = [r["set_id"] for r in similar.document_sets(df, 5).collect()]
    sent.clear()
    for n in (3, 300):
        pairs = spark.createDataFrame([(i, i) for i in ids[:n]], "a bigint, b bigint")
        assert similar.verified(pairs, df, 5, 80, picked=bits).count() == n
    assert [len(v) for v in sent] == [bits // 64] * 2


@pytest.mark.parametrize("most", [500_000, 7])
def test_contamination_equals_a_plain_version(spark, most):
    item = " ".join(f"i{k}" for k in range(14))
    items = spark.createDataFrame([(1, item), (2, "Short One"), (None, item.upper()), (3, None), (1, item)], "item_id bigint, text string")
    texts = [item, "x " + item[:26] + " y", "so short, ONE!", "short two", *ODD]
    got = decontaminate.find_contamination(docs(spark, texts), items, max_windows=most).orderBy("doc_id").collect()
    assert [r["hit_items"] for r in got[:4]] == [["1", "null"], [], ["2"], []]
    assert [r["hit_spans"] for r in got[:4]] == [[[0, 14]], [], [[1, 3]], []]
    assert all(not r["hit_spans"] for r in got[4:])
    assert decontaminate.drop_contaminated(docs(spark, texts), items).count() == len(texts) - 2
    clean = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(docs(spark, texts), items).collect()}
    assert clean[0] == "" and clean[2] == "so " and clean[3] == "short two"


def test_language_of_held_out_texts(spark):
    df = texts_of(spark).withColumn("held", F.col("doc_id") % 4 == 2)
    found = language.identify(df, language.train(df.filter("NOT held")), ("doc_id", "lang", "held")).filter("held")
    assert found.filter("lang = lang_pred").count() >= 0.95 * found.count()
    odd = language.identify(docs(spark, ODD), language.train(df), ("doc_id",)).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in odd[:4]] == ["und"] * 4 and all(0 <= r["score"] <= 1 for r in odd)
    nothing = language.identify(docs(spark, ["word"]), language.train(df.limit(0)), ("doc_id",)).first()
    assert (nothing["lang_pred"], nothing["score"]) == ("und", 0.0)


def test_class_scores_beat_unigrams(spark):
    df = texts_of(spark).withColumn("held", F.col("doc_id") % 5 == 1)
    model = brown.train(df.filter("NOT held"), unit_words=300, broadcast_words=400, k=12)
    found = brown.score(df, model, ("doc_id", "held", "text"))
    train = Counter()
    for r in df.filter("NOT held").collect():
        train.update((r["text"] or "").encode().lower().split() + [None])
    total, kinds = sum(train.values()), len(train)
    import math

    for r in found.collect():
        tokens = (r["text"] or "").encode().lower().split() + [None]
        base = sum(math.log10((train[t] + 0.5) / (total + 0.5 * (kinds + 1))) for t in tokens)
        assert r["n_tokens"] == len(tokens) and r["n_known"] == sum(train[t] > 0 for t in tokens)
        assert r["train_tokens"] == total and abs(r["base_score"] - base) < 1e-6
    sums = found.filter("held").agg(F.sum("base_score"), F.sum("score")).first()
    assert sums[1] > sums[0]
    assert brown.score(docs(spark, ODD), model, ("doc_id",)).filter("n_tokens >= 1 AND score < 0").count() == len(ODD)


def test_every_word_has_its_own_class(spark):
    """Words that end alike and are no units of the exchange are told apart by their neighbours."""
    texts = [f"the n{i % 40}ab will v{i * 7 % 40}ab . the dog will run . the cat will sit ." for i in range(400)]
    model = brown.train(docs(spark, texts), unit_words=7, broadcast_words=0, k=6)
    placed = model["counts"].collect()
    fingerprint = {name: next(chunks(pa.array([name]), True, BLANK_SEPARATED))[1].hashes.view("int64")[0] for i in range(40) for name in (f"n{i}ab", f"v{i}ab")}
    names = {word: name for name, word in fingerprint.items()}
    assert sorted((names[r["word"]], r["n"]) for r in placed) == sorted((name, 10) for name in fingerprint)
    kinds = {names[r["word"]][0]: set() for r in placed}
    for r in placed:
        kinds[names[r["word"]][0]].add(r["cls"])
    assert len(kinds["n"]) == len(kinds["v"]) == 1 and kinds["n"] != kinds["v"]

    rows = docs(spark, ["the n1ab will v2ab .", "the v1ab will n2ab .", "n1ab v2ab zzzz n3ab", "", None, "zzzz", *texts[:20]])
    joined = {r["doc_id"]: r for r in brown.score(rows, model, ("doc_id",)).collect()}
    assert joined[0]["score"] > joined[1]["score"] + 0.5
    broadcast = brown.train(docs(spark, texts), unit_words=7, k=6)
    for r in brown.score(rows, broadcast, ("doc_id",)).collect():
        other = joined[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"]) == (other["n_tokens"], other["n_known"])
        assert abs(r["score"] - other["score"]) < 1e-9 and abs(r["base_score"] - other["base_score"]) < 1e-9

    # All words and one unknown word per group sum to one in their class, classes behind each class too.
    m = broadcast["parameters"]
    words = np.bincount(m["known_classes"], m["known_counts"] + 0.5 * (m["known_counts"] > 0), 6)
    whole = words + 0.5 * np.bincount(m["group_classes"], minlength=6)
    assert np.allclose(whole[whole > 0], 10 ** m["class_scale"][whole > 0])
    assert np.allclose((10 ** m["follow"]).sum(1), 1)
    # The class bigrams are those of the tokens with their own classes.
    of = dict(zip(m["known"].tolist(), m["known_classes"].tolist()))
    tokens = [chunk[1].hashes.view("int64").tolist() for t in texts for chunk in chunks(pa.array([t]), True, BLANK_SEPARATED)]
    line = [of[-1]] + [of[w] for t in tokens for w in [*t, -1]]
    grid = np.zeros((6, 6))
    np.add.at(grid, (line[:-1], line[1:]), 1)
    for own in (m, model["parameters"]):
        assert np.allclose(10 ** own["follow"], brown._follow(grid, np.bincount(line[1:], minlength=6)))


def test_quality_of_held_out_texts(spark):
    df = texts_of(spark).withColumn("fold", (F.col("doc_id") % 4).cast("int"))
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = quality.train(df, labels)
    scored = quality.score(quality.document_statistics(df, ("doc_id", "fold")), model, ("doc_id", "fold"))
    held = scored.filter("fold = 2").join(labels, "doc_id").select(((F.col("score") >= 0.5).cast("int") == F.col("quality")).alias("ok"))
    assert held.filter("ok").count() >= 0.85 * held.count()
    none = quality.train(df, labels.limit(0))
    assert {r["score"] for r in quality.score(quality.document_statistics(docs(spark, ODD), ("doc_id",)), none, ("doc_id",)).collect()} == {1.0}


def test_fingerprints(spark):
    rows = texts_of(spark).select("doc_id", "text").unionByName(docs(spark, ODD, range(10_000, 10_100)).select("doc_id", "text"))
    order = sorted(((r["doc_id"], r["text"] or "") for r in rows.collect()), reverse=True)
    got = {r["doc_id"]: r for r in spotsigs.fingerprints(rows).collect()}
    assert len(got) == len(order)
    for (i, text), (_, following) in zip(order, order[1:] + order[:1]):
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        assert got[i]["n_chars"] == len(text)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i]["near_next"] <= 1 and (got[i]["near_edited"] == 1) >= (edited == text)
    assert len({got[i]["fingerprint"] for i, t in order if t == "one"}) == 1


def test_similar_fingerprints_equal_a_plain_version(spark):
    sets = [(i, sorted({(7 * k) % 50 for k in range(i % 6, 30 + i % 9)})) for i in range(40)]
    got = {(r["left"], r["right"]) for r in spotsigs.similar_pairs(spark.createDataFrame(sets, "id bigint, signatures array<int>")).collect()}
    first = {}
    for i, s in sets:
        first.setdefault(tuple(s), i)
    want = {
        (i, j)
        for a, i in first.items()
        for b, j in first.items()
        if i < j and len(set(a) & set(b)) >= 0.8 * len(set(a) | set(b))
    }
    assert got == want


def test_lines_keep_copies_and_odd_texts(spark):
    texts = [f"own line {chr(97 + i) * 9}\nseen {i} times in all of them\nother {chr(98 + i) * 8} end" for i in range(12)]
    out = lines.drop_recurring(docs(spark, texts + ODD)).orderBy("doc_id").collect()
    assert all(r["n_dropped"] == 1 and "seen" not in r["text"] for r in out[:12])
    assert [r["text"] for r in out[12:]] == ODD
    copies = lines.drop_recurring(docs(spark, ["a b c d e\nf g h i j"] * 12)).collect()
    assert all(r["n_dropped"] == 0 for r in copies)


def test_lines_go_from_pages_that_are_mostly_boilerplate(spark):
    shared = "log in here or there now\nread all of our many terms\nshare this page with your friends"
    texts = [f"{shared}\nown {chr(97 + i) * 9}" for i in range(12)] + [shared] + ["all of this is one long copy\nand so is this other line"] * 12
    out = lines.drop_recurring(docs(spark, texts)).orderBy("doc_id").collect()
    assert [r["text"] for r in out[:13]] == [f"own {chr(97 + i) * 9}" for i in range(12)] + [""]
    assert [r["n_dropped"] for r in out] == [3] * 13 + [0] * 12


def test_lines_of_a_template_go_beside_a_foreign_line(spark):
    foreign = "see the full list as one more such line was here"
    texts = [f"own {chr(97 + i) * 9}\nsee the full list of all our {chr(97 + i) * 5} in the shop\nand {chr(98 + i) * 7}" for i in range(12)]
    out = lines.drop_recurring(docs(spark, [*texts, f"first\n{foreign}\nlast"])).orderBy("doc_id").collect()
    assert [r["n_dropped"] for r in out] == [1] * 12 + [0]
    assert "see the" not in out[0]["text"] and foreign in out[12]["text"]


def test_perspectives_of_odd_turns(spark):
    rows = [(1, 0, "ann", "hi"), (1, 1, "bob", None), (1, 1, "bob", None), (1, None, None, "<|im_end|>"), (2, 0, "system", "x"), (None, 0, "eve", "")]
    got = chat.rotate(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()
    assert {(r["conv_id"], r["part"], r["speaker"]) for r in got} == {
        (1, p, s) for p in (0, -1) for s in ("ann", "bob", "unknown")
    } | {(None, 0, "eve")}
    ann = next(r for r in got if r["speaker"] == "ann" and r["part"] == 0)
    start, end = map(int, ann["trained"].split("-"))
    assert ann["text"][start:end] == "hi<|im_end|>" and ann["n_turns"] == 2


def test_perspectives_of_a_conversation_with_few_turn_numbers(spark):
    rows = [(None, i % 8, "ann" if i % 3 else "bob", f"t{i}") for i in range(1000)] * 2
    rows += [(None, None, "ann", f"n{i}") for i in range(250)]
    rows += [(2, 150, "eve", "x"), (2, None, "eve", "y")] + [(3, 1, "eve", "again")] * 300
    made = chat.rotate(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5), 100)
    got = made.collect()
    assert max(r["n_turns"] for r in got) == 100
    assert {(r["conv_id"], r["part"]) for r in got if r["conv_id"]} == {(2, 1), (2, -1), (3, 0)}
    ann = {r["part"]: r for r in got if r["conv_id"] is None and r["speaker"] == "ann"}
    assert sorted(ann) == [-3, -2, -1, *range(10)]
    texts = [line for part in [*range(10), -1, -2, -3] for line in ann[part]["text"].split("\n")[1::2]]
    want = sorted({(t is None, t or 0, who, text) for c, t, who, text in rows if c is None})
    assert texts == [text + chat.END for *_, text in want]
    for row in ann.values():
        spans = [tuple(map(int, s.split("-"))) for s in row["trained"].split(",") if s]
        assert len(spans) == row["n_trained"] and all(row["text"][:a].endswith("assistant\n") for a, _ in spans)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name, monkeypatch):
    monkeypatch.setattr(compare, "QUERIES", QUERIES)
    monkeypatch.setattr(compare, "ORACLES", ORACLES)
    assert compare.difference(spark, SMALL, name)[0] is None


def test_empty_tables(spark):
    none = docs(spark, [])
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert bpe.encode(none, RANKS, public_tokenizers.PATTERN).count() == 0
    assert decontaminate.find_contamination(none, items).count() == 0
    assert lines.drop_recurring(none).count() == 0
    assert spotsigs.fingerprints(none).count() == 0
    assert repeats.remove_repeats(none).count() == 0
    assert similar.near_duplicates(none).count() == 0
    assert brown.score(none, brown.train(none), ("doc_id",)).count() == 0
    assert quality.document_statistics(none, ("doc_id",)).count() == 0


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SMALL)
    total = texts_of(spark).count()
    assert 0.5 * total < out.count() < total and out.select("doc_id").distinct().count() == out.count()


def test_quality_stage_sends_texts_to_python_once(spark):
    """One Python step per task, scores as those of the two steps, columns of any name."""
    import corpus_pipeline

    df = docs(spark, [*ODD, *[r["text"] for r in texts_of(spark).collect()]]).withColumn("a.b", F.lit(1))
    stage = corpus_pipeline.good_quality(spark, df, SMALL)
    plan = stage._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "MapInArrow" not in plan
    model = quality.train(df.withColumn("fold", F.col("doc_id") % 4), spark.read.parquet(f"{SMALL}/labels.parquet"))
    two = quality.score(quality.document_statistics(df, ("doc_id", "text")), model, ("doc_id", "text"))
    one = quality.score_texts(df, model).select("doc_id", "text", "score")
    assert stage.columns == df.columns
    rows = lambda found: sorted(([str(r[0]), str(r[1]), r[2]] for r in found.collect()))
    for a, b in zip(rows(one), rows(two), strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-9


@pytest.mark.parametrize("most", [10**6, 2])
def test_decontamination_stage_sends_texts_to_python_once(spark, most):
    """The text alone, one boolean back; rows and columns of any name stay, item blocks too."""
    item = "one two three four five six seven eight nine ten eleven"
    items = spark.createDataFrame([("x", item), ("y", "short one")], "item_id string, text string")
    texts = [None, "", f"a {item} b", "clean words only", "SHORT, one!", f"a {item} b", "clean words only"]
    df = docs(spark, texts).withColumn("a.b", F.col("text"))
    found = decontaminate.drop_contaminated(df, items, max_windows=most)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "MapInArrow" not in plan
    assert found.columns == df.columns
    got = sorted((r["doc_id"], r["text"], r["a.b"]) for r in found.collect())
    at = [r["doc_id"] for r in df.orderBy("doc_id").collect()]
    assert got == [(at[i], texts[i], texts[i]) for i in (0, 1, 3, 6)]


def test_bpe_caches_go_with_their_coder():
    """Without waiting for the collector of cycles: a worker that does other work is free of them."""
    import gc
    import weakref

    gc.disable()
    try:
        coder = bpe.Coder(RANKS, public_tokenizers.PATTERN)
        assert b" ".join(coder.coded("caches hold words, caches go"))
        gone = weakref.ref(coder)
        del coder
        assert gone() is None
    finally:
        gc.enable()
