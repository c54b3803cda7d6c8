import random
from fractions import Fraction

import corpus_pipeline as cp
import numpy as np
import pytest

from waybill.llm import near_copies, simhash
from waybill.llm.common import components

DIR = "/root/testdata/sf0.01"


def grams(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def similar(x, y):
    return x == y or bool(x or y) and Fraction(len(x & y), len(x | y)) >= Fraction(4, 5)


def brute_kept(rows):
    sets, label = [grams(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if label[i] != label[j] and similar(sets[i], sets[j]):
                old, new = label[i], label[j]
                label = [new if c == old else c for c in label]
    best = {}
    for (d, _), c in zip(rows, label, strict=True):
        best[c] = min(best.get(c, d), d)
    return sorted(best.values())


def edited():
    rnd = random.Random(8)
    words, rows = [f"w{i}" for i in range(400)], [(0, None), (1, ""), (2, "one two"), (3, "One  two"), (4, "one two three")]
    for _ in range(12):
        base = [rnd.choice(words) for _ in range(rnd.choice([9, 60, 120]))]
        for _ in range(10):
            w = list(base)
            for _ in range(rnd.choice([0, 1, 2, 3, 5])):
                w[rnd.randrange(len(w))] = rnd.choice(words)
            rows.append((len(rows), " ".join(w)))
    return rows


@pytest.mark.parametrize("shuffled", [False, True])
def test_edits_against_brute_force(spark, monkeypatch, shuffled):
    if shuffled:
        monkeypatch.setattr(simhash, "MAX_BROADCAST_ROWS", -1)
        monkeypatch.setattr(near_copies, "SAMPLE", 20)
    rows = edited()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in near_copies.keep_one(spark, docs).collect()) == brute_kept(rows)


def test_stage_keeps_one_of_all_pairs_that_brute_force_finds(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    kept = sorted(r["doc_id"] for r in cp.drop_near_duplicates(spark, docs, DIR).collect())
    assert kept == brute_kept(rows)


def test_no_rows(spark):
    assert near_copies.keep_one(spark, spark.createDataFrame([], "doc_id long, text string")).collect() == []


def watched(monkeypatch):
    """What near_copies writes: (name, plan, rows) of each table."""
    found, write = [], near_copies.written

    def watch(spark, df, name):
        out = write(spark, df, name)
        found.append((name, df._jdf.queryExecution().optimizedPlan().toString(), out[0].count()))
        return out

    monkeypatch.setattr(near_copies, "written", watch)
    return found


def test_index_of_many_sets_moves_no_texts(spark, monkeypatch):
    monkeypatch.setattr(simhash, "MAX_BROADCAST_ROWS", -1)
    found = watched(monkeypatch)
    rows = edited() + [(1000 + i, t) for i, t in edited()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(r["doc_id"] for r in near_copies.keep_one(spark, docs).collect()) == brute_kept(rows)
    assert ["Join" in plan for name, plan, _ in found if name == "shared"] == [False]


def test_large_group_does_not_meet_in_all_pairs(spark, monkeypatch):
    rnd = random.Random(3)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(600):
        w = list(base)
        for at in rnd.sample(range(100), 1 + i % 2):
            w[at] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    found = watched(monkeypatch)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in near_copies.keep_one(spark, docs).collect()) == brute_kept(rows)
    tried = sum(n for name, _, n in found if name.endswith("-pairs"))
    assert tried < 600 * 18, tried


def test_similar_sets_share_a_first_part():
    rnd = np.random.default_rng(11)
    draw = lambda k: rnd.integers(0, 2**63, k, np.int64).astype(np.uint64) * np.uint64(2)
    for i in range(6000):
        n = int(rnd.integers(1, 70)) if i % 2 else int(rnd.choice([52, 208, 832]) * rnd.uniform(0.7, 1.3))
        x = draw(n)
        gone = int(rnd.integers(0, n // 5 + 1))
        y = np.r_[x[gone:], draw(int(rnd.integers(0, n // 4 + 1)))]
        x, y = np.unique(x), np.unique(y)
        both = len(np.intersect1d(x, y))
        if both * 5 < (len(x) + len(y) - both) * 4:
            continue
        if i % 3 == 0:  # few ranges hold any: all parts may be spoilt
            x, y = x >> np.uint64(3), y >> np.uint64(3)
        common = lambda s: (s % np.uint64(4) == 0).astype(np.int64)
        first = [near_copies._parts(s, common(s), near_copies.THRESHOLD) for s in (x, y)]
        assert len(np.intersect1d(*first)), (len(x), len(y), both)


def test_shingles_that_two_texts_share_by_chance_are_not_indexed(spark, monkeypatch):
    rnd = random.Random(5)
    rows = [[] for _ in range(200)]
    for k in range(40):  # each of a text's 40 passages of six words is in one other text
        order = list(range(200))
        rnd.shuffle(order)
        for i, d in enumerate(order):
            rows[d] += [f"p{k}x{i // 2}w{j}" for j in range(6)]
    rows = [(d, " ".join(w)) for d, w in enumerate(rows)]
    rows += [(200 + d, f"{rows[d][1]} more") for d in range(5)]
    found = watched(monkeypatch)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in near_copies.keep_one(spark, docs).collect()) == list(range(200))
    shared = [n for name, _, n in found if name == "shared"]
    assert shared[0] < 1500, shared


def test_few_links_are_one_task(spark):
    rnd = random.Random(2)
    links = [(rnd.randrange(-300, 300), rnd.randrange(-300, 300)) for _ in range(250)]
    edges = spark.createDataFrame(links, "a long, b long").repartition(3)
    few, rounds = ({(r.node, r.root) for r in components(spark, edges, n).collect()} for n in (250, 0))
    assert few == rounds and len(few) > 300
    assert components(spark, edges.where("a > 1000"), 10).collect() == []
