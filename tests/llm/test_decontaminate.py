import random
import re

import numpy as np

from waybill.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, size=10):
    windows = {}
    for name, text in items:
        w = tokens(text)
        n = min(size, len(w))
        if name is not None and n:
            for i in range(len(w) - n + 1):
                windows.setdefault(tuple(w[i : i + n]), set()).add(str(name))
    out = []
    for d, text in docs:
        w = tokens(text)
        hit, names = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    names |= found
        out.append((d, len(w), len(hit), tuple(sorted(names))))
    return sorted(out, key=str)


def fixture():
    rnd = random.Random(11)
    vocab = ["Ab", "c", "élan", "x1", "日本", "b'q", "Z"]
    draw = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, draw(rnd.choice([3, 9, 10, 11, 14, 30]))) for i in range(30)] + [(40, None), (41, "!!"), (None, "lost item words"), (7, draw(12)), (42, "a " * 40)]
    docs = [(i, draw(rnd.randrange(60))) for i in range(40)]
    for i in range(40, 100):
        part = tokens(rnd.choice([t for _, t in items if t]))
        a = rnd.randrange(max(1, len(part) - 9))
        docs.append((i, draw(rnd.randrange(9)) + " -- " + "\n".join(part[a : a + rnd.randrange(8, 16)]).upper() + ", " + draw(5)))
    return docs + [(1, None), (2, ""), (3, "same"), (3, "same"), (None, "a " * 12), (200, "a " * 20000)], items


def got(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, "clash", 1) for i, t in docs], "doc_id long, text string, items string, n_words int")
    b = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, doc_id string")
    rows = dc.find_contamination(spark, d, b, **kw).collect()
    return sorted(((r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), tuple(r["items"])) for r in rows), key=str)


def test_against_brute_force(spark):
    docs, items = fixture()
    assert got(spark, docs, items) == brute(docs, items)


def test_salted_joins_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(dc, "MAX_BROADCAST_KEYS", -1)
    monkeypatch.setattr(dc, "MAX_BROADCAST_ROWS", -1)
    docs, items = fixture()
    assert got(spark, docs, items) == brute(docs, items)


def test_one_plan_for_any_benchmark(spark):
    """A benchmark of 1.5 million words has the plan of a small one, and its common passage is found everywhere."""
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(3000)]
    passage = " ".join(rnd.choice(vocab) for _ in range(25))
    items = [(i, " ".join(rnd.choices(vocab, k=1000)) + " " + passage * (i % 2)) for i in range(1500)]
    docs = [(i, f"{i} before {passage} after" if i % 3 else f"{i} plain") for i in range(300)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    plans = []
    for some in (items[:2], items):
        b = spark.createDataFrame(some, "item_id long, text string")
        found = dc.find_contamination(spark, d, b)
        plans.append(found._jdf.queryExecution().executedPlan().toString().count("MapInArrow"))
        rows = found.collect()
        assert all(len(r["items"]) == len(some) // 2 * (r["doc_id"] % 3 > 0) for r in rows)
        assert all(sum(s["end"] - s["start"] for s in r["spans"]) == 25 * (r["doc_id"] % 3 > 0) for r in rows)
    assert plans[0] == plans[1]


def test_every_shared_span_leaves_a_common_fingerprint():
    rnd = np.random.default_rng(3)
    for _ in range(200):
        shared = rnd.integers(0, 4, 10).astype(np.uint64)
        texts = [np.r_[rnd.integers(0, 4, rnd.integers(0, 30)).astype(np.uint64), shared, rnd.integers(0, 4, rnd.integers(0, 30)).astype(np.uint64)] for _ in range(2)]
        a, b = (set(dc.gram_hashes(t, 5)[dc.winnow(t)].tolist()) for t in texts)
        assert a & b


def test_empty_tables(spark):
    docs, items = fixture()
    assert got(spark, [], items) == []
    assert got(spark, docs, []) == brute(docs, [])
