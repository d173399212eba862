"""Quality rules, structure repair and the prefix trie, each beside a plain version."""

from __future__ import annotations

import functools
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from campusgrid.llm import hashing, repair, rules, trie
from campusgrid.llm.queries import ORACLES, QUERIES
from checks import compare

SMALL = "/root/testdata/sf0.001"
TURNS = "conv_id bigint, turn bigint, role string, text string"


# --- conversation structure repair ---------------------------------------------------


def plain_damage(rows):
    """{conv_id: rows after damage in order}, of (conv_id, turn, role, text)."""
    found = {}
    for conv, turn, role, text in rows:
        own = found.setdefault(conv, [])
        role, text = [" " if x is None else x for x in (role, text)]
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for own in found.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return found


def plain_repair(rows):
    """The report of one conversation's rows (turn, role, text), by another search: the
    best rest of the audit per row and state, as texts."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)

    @functools.cache
    def best(i, state, inserted):
        """(cost, audit) of the cheapest way to end."""
        ways = []
        if i == len(rows) and state in "-a":
            ways.append((0, ""))
        follows = "a" if state == "u" else "u"
        if inserted < 2:
            cost, rest = best(i, follows, inserted + 1)
            ways.append((cost + 2, "I" + rest))
        if i < len(rows):
            cost, rest = best(i + 1, state, 0)
            ways.append((cost + 3, "D" + rest))
            if faults[i] not in ("blank", "duplicate"):
                extra = faults[i] == "truncated"
                cost, rest = best(i + 1, follows, 0)
                ways.append((cost + 2 + extra, "R" + rest))
                initial = rows[i][1][:1]
                if initial == follows or (initial == "s" and state == "-"):
                    cost, rest = best(i + 1, initial, 0)
                    ways.append((cost + extra, "K" + rest))
        return min(ways, default=(10**9, ""))

    cost, audit = best(0, "-", 0)
    state, left, out = "-", list(rows), []
    for letter in audit:
        role, text = ("", "") if letter == "I" else left.pop(0)[1:]
        if letter in "IR":
            role = "assistant" if state == "u" else "user"
        if letter != "D":
            out.append(f"{role}:{text}")
            state = role[0]
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
    counts = Counter(faults)
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest


def report_of(spark, rows):
    df = spark.createDataFrame(rows, TURNS)
    out = repair.repair(repair.damaged(df), "report").collect()
    return {r["conv_id"]: tuple(r)[1:] for r in out}


def odd_turns(seed, convs, longest):
    pick = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(pick.randint(1, longest)):
            role = pick.choice(["user", "assistant", "user", "assistant", "system", "umpire", "", "tool", None])
            text = pick.choice(["Yes.", "No", "Well!", " ", "", None, "a\nb?", f"{turn}.", f"{turn}", "é。", "long " * 50 + "."])
            rows.append((conv * 37 - 50, pick.choice([turn, turn, turn * 3, None, 2]), role, text))
    return rows


def test_repair_equals_a_plain_version(spark):
    rows = odd_turns(1, 150, 9) + odd_turns(2, 3, 120) + [(None, 1, "user", "Hi."), (None, None, None, None)]
    assert report_of(spark, rows) == {conv: plain_repair(own) for conv, own in plain_damage(rows).items()}


def test_repair_on_the_table_equals_a_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r)[1:] for r in QUERIES["op12_structure_repair"](spark, SMALL).collect()}
    assert got == {conv: plain_repair(own) for conv, own in plain_damage(rows).items()}


def test_search_decides_early_and_exactly():
    pick = random.Random(3)
    for case in range(300):
        rows = [(k, pick.choice("suax"), pick.choice(["a.", "b", f"{k}.", f"{k}!", ""])) for k in range(pick.choice([0, 1, 3, 40, 200]))]
        if case % 3 == 0:  # mostly in order
            rows = [(k, pick.choice("suax") if pick.random() < 0.05 else "ua"[k % 2], f"{k}.") for k in range(300)]
        now, letters = repair.Conversation(), []
        seen, most = set(), 0
        for turn, role, text in rows:
            fault = "blank" if not text else "duplicate" if (role, text) in seen else None if text[-1] in ".!?" else "truncated"
            seen.add((role, text))
            letters += [e for e, _, _ in now.row(turn, role, text, fault)]
            most = max(most, len(now.waiting))
        letters += [e for e, _, _ in now.finish()]
        assert (now.cost, "".join(letters)) == plain_repair(rows)[5:7]
        if case % 3 == 0:
            assert most < 60


def test_repair_gives_the_repaired_turns(spark):
    rows = [(7, 1, "system", "Be kind."), (7, 2, "user", "Hello."), (7, 3, "user", "Again?"), (7, 4, "assistant", "Well.")]
    df = spark.createDataFrame([(*r, 0) for r in rows], TURNS + ", copy int").withColumn("place", F.lit("x")).withColumn("fault", F.lit(1))
    out = repair.repaired(df).orderBy("place").collect()
    assert [(r["role"], r["text"]) for r in out] == [
        ("system", "Be kind."), ("user", "Hello."), ("assistant", ""), ("user", "Again?"), ("assistant", "Well.")
    ]
    assert repair.repair(df.limit(0), "report").collect() == []


def test_a_conversation_whose_rows_are_all_dropped_stays(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    empty = hashlib.sha256().hexdigest()
    assert report_of(spark, [(5, turn, "user", "Hi.")]) == {5: (0, 0, 0, 0, 0, 0, "", empty)}


# --- prefix trie -----------------------------------------------------------------------


def plain_trie(rows):
    """The nodes of the rebuilt conversations, by sets of whole prefixes."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            own[conv].append(((turn is not None, turn or 0), name, (role, text)))
    own = {c: [r for _, _, r in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        base = conv - int(np.fmod(conv, 100))
        made = tuple(own.get(base, [])[:h] + turns[h:])
        ends[made].append(conv)
        for d in range(len(made) + 1):
            members[made[:d]].append(conv)
    under, found = defaultdict(list), []
    for node in members:
        for d in range(len(node) + 1):
            under[node[:d]].append(node)
    kids = Counter(node[:-1] for node in members if node)
    for node, convs in members.items():
        joined = ",".join(map(str, sorted(ends[node])))
        found.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), kids[node],
            sum(kids[n] == 0 for n in under[node]), sum((len(members[n]) - 1) * len(n[-1][1]) for n in under[node] if n),
            hashlib.sha256(joined.encode()).hexdigest(),
        ))
    return sorted(found, key=str)


def tree_of(spark, rows, block=trie.BLOCK, task_rows=trie.TASK_ROWS):
    convs, turns = trie.rebuilt(spark.createDataFrame(rows, TURNS), task_rows)
    return sorted((tuple(r) for r in trie.trie(convs, turns, block).drop("node").collect()), key=str)


def few_turns(seed):
    pick = random.Random(seed)
    rows = [(None, 1, "user", "nobody"), (1_000_101, 0, "user", "only turn")]
    for conv in [0, 100, 200, 300, -100, *(pick.randrange(-250, 450) for _ in range(60))]:
        for turn in range(pick.choice([1, 2, 5, 9, 17])):
            rows.append((conv, pick.choice([turn, turn, None]), pick.choice(["user", "assistant", None]), pick.choice(["a", "b", None, "", "ä" * 40])))
    return rows


def test_trie_equals_a_plain_version(spark):
    rows = few_turns(4)
    assert tree_of(spark, rows) == plain_trie(rows)


@pytest.mark.parametrize("block", [1, 4, 8])
def test_trie_of_long_conversations_cut_in_blocks(spark, block):
    rows = few_turns(5) + [(c, t, "user", "same") for c in (500, 501, 507) for t in range(33)] + [(501, 40, "user", "more")]
    assert tree_of(spark, rows, block, task_rows=10) == plain_trie(rows)


def test_trie_of_nothing_and_of_other_columns(spark):
    assert tree_of(spark, []) == []
    df = spark.createDataFrame([(1, 0, "user", "x", 9, "n", b"u")], TURNS + ", pos int, name string, node binary")
    convs, turns = trie.rebuilt(df)
    assert [r["depth"] for r in trie.trie(convs, turns).orderBy("depth").collect()] in ([0, 1], [0])


def test_hashes_of_many_ends_are_joined_in_portions(spark, monkeypatch):
    monkeypatch.setattr(trie, "JOINED_BYTES", 20)
    ends = spark.range(-50, 3000).select(F.lit(b"n").alias("node"), F.col("id").alias("conv_id")).repartition(7)
    got = trie._joined_hashes(ends).collect()
    assert [r["ends"] for r in got] == [hashlib.sha256(",".join(map(str, range(-50, 3000))).encode()).hexdigest()]


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
def test_trie_query_agrees_with_sql(spark, monkeypatch, folder):
    monkeypatch.setitem(compare.QUERIES, "op11", QUERIES["op11_prefix_trie"])
    monkeypatch.setitem(compare.ORACLES, "op11", ORACLES["op11_prefix_trie"])
    found, rows = compare.difference(spark, folder, "op11")
    assert found is None and rows > 40


# --- quality rules ---------------------------------------------------------------------

BLANKS = re.compile("[^\x20\x09-\x0d]+")


def plain_rules(text):
    text = text or ""
    words = BLANKS.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    hit = {i + k for i, w in enumerate(windows) if w in twice for k in range(5)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if BLANKS.search(line):
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), repeated, len(hit), failed


ODD_TEXTS = [
    None, "", " \n\t", "a b c d e a b c d e", "x\nx\n x\n\n\nx", "é ß 中文 😀 | <b> # $ % & * x y z", "w " * 4000,
    "one two three four five six seven eight nine ten", "a\r\na\r\nb", "q" * 100_000, "line\x0bline\n" * 3, "1 2 3 4 5 6 1 2 3 4 5 7 8 9",
]


def plain_score(texts, trusted, text, buckets):
    """The mean log ratio of a text, n-grams hashed one by one."""

    def found(value):
        column = pa.array([value or ""])
        for _, words in hashing.chunks(column, False, hashing.BLANK_SEPARATED):
            singles = [int(h) for h in words.hashes]
            pairs = [int(h) for h, ok in zip(*words.windows(2)) if ok]
            return [int(hashing.mixed(np.array([h], dtype=np.uint64) ^ salt)[0]) % buckets for hs, salt in zip((singles, pairs), rules._NGRAM) for h in hs]

    corpus, target = Counter(), Counter()
    for value, known in zip(texts, trusted):
        corpus.update(found(value))
        if known:
            target.update(found(value))
    sizes = sum(corpus.values()), sum(target.values())
    total, own = 0.0, found(text)
    for b in own:
        share = (corpus[b] + 1) / (sizes[0] + buckets)
        total += np.log((target[b] + rules.PRIOR * buckets * share) / (sizes[1] + rules.PRIOR * buckets) / share)
    return total / max(1, len(own))


def test_rules_equal_a_plain_version(spark):
    texts = ODD_TEXTS + [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).collect()]
    rows = [(i if i else None, t, i, "z") for i, t in enumerate(texts)] * 2
    df = spark.createDataFrame(rows, "doc_id bigint, text string, score int, _text string").repartition(3)
    good = spark.createDataFrame([(k,) for k in (3, 3, 7, 20, 21, 22, None)], "doc_id bigint")
    model = rules.train(df, good, buckets=64)
    out = rules.judge(df, model, threshold=-0.05).collect()
    assert len(out) == len(rows)
    want = {}
    for i, text in enumerate(texts):
        score = plain_score(texts * 2, [k in (3, 7, 20, 21, 22) for k in range(len(texts))] * 2, text, 64)
        want[i or None] = (*plain_rules(text), score)
    for row in out:
        *counts, score = want[row["doc_id"]]
        assert tuple(row)[1:7] == tuple(counts)
        assert row["score"] == pytest.approx(score, abs=2e-6)
        assert row["kept"] == (not row["base_failed"] and row["score"] >= -0.05)
    kept = rules.keep(df, model, threshold=-0.05)
    assert kept.columns == df.columns and kept.count() == sum(r["kept"] for r in out)


def test_scores_do_not_depend_on_partitions(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "labels"))
    good = labels.filter("quality = 1")
    one = rules.judge(docs, rules.train(docs, good)).orderBy("doc_id").collect()
    dealt = docs.repartition(13)
    assert rules.judge(dealt, rules.train(dealt, good)).orderBy("doc_id").collect() == one


def test_rules_without_rows_or_trusted_documents(spark):
    df = spark.createDataFrame([(1, "a b c d e f g h i j k")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint")
    model = rules.train(df, none)
    assert [tuple(r)[-3:] for r in rules.judge(df, model).collect()] == [(False, 0.0, True)]
    empty = df.limit(0)
    assert rules.judge(empty, rules.train(empty, none)).collect() == []


def test_junk_goes_and_prose_stays(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").withColumnRenamed("doc_id", "_id")
    judged = QUERIES["op13_quality_rules"](spark, folder).join(labels, F.col("doc_id") == F.col("_id"))
    share = {r["quality"]: r["share"] for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[1] > 0.96 and share[0] < 0.05
