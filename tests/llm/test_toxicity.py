import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from waybill.llm import toxicity as tx


def test_block_max_search_is_exact():
    rnd = np.random.default_rng(4)
    vectors = []
    for i in range(500):
        terms = np.sort(rnd.choice(np.arange(8) + 8 * (i // 50), rnd.integers(1, 8), replace=False))
        raw = rnd.random(len(terms)) ** 2 + 0.01
        vectors.append((terms, raw / np.sqrt((raw * raw).sum())))
    dense = np.zeros((500, 90))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    index = tx.BlockMaxIndex(vectors, 90, block=16, common=20)
    assert 0 < len(index.matrix) < 90
    for q in range(100):
        terms = np.sort(rnd.choice(90, rnd.integers(1, 10), replace=False))
        weights = rnd.random(len(terms))
        without = q if q % 3 == 0 else -1
        near, at = next(index.nearest([(terms, weights)], 7, [without]))
        cosines = dense[:, terms] @ weights
        want = sorted((-round(c, 12), i) for i, c in enumerate(cosines) if c > 0 and i != without)[:7]
        assert near == pytest.approx([-c for c, _ in want])
        assert at.tolist() == [i for _, i in want]
    assert index.visited < 100 * index.blocks  # some blocks were never opened


def plain_scores(rows, labels, docs):
    """Scores by their definition, all cosines in dictionaries; ``rows`` are the labelled (name, text, label)."""
    words = lambda t: Counter(re.findall(r"[^\W\d_]+", (t or "").lower()))
    examples = {}
    for name, text, label in sorted((r for r in rows if words(r[1])), key=lambda r: -r[0]):
        examples[label, text] = name
    n_docs, sides = len(docs), [sum(r[2] == c for r in rows) for c in (0, 1)]
    have = [Counter(w for r in rows if r[2] == c for w in words(r[1])) for c in (0, 1)]
    df = Counter(w for d in docs for w in words(d))
    known = {w for _, t in examples for w in words(t)}
    scale = {}
    for w in known:
        odds = math.log((have[1][w] + 0.5) / (sides[1] + 1)) - math.log((have[0][w] + 0.5) / (sides[0] + 1))
        sure = odds / math.sqrt(1 / (have[1][w] + 0.5) + 1 / (have[0][w] + 0.5))
        scale[w] = (math.log((1 + n_docs) / (1 + df[w])) + 1) * (tx.FLOOR + max(0, sure))

    def unit(text):
        raw = {w: (1 + math.log(n)) * scale[w] for w, n in words(text).items() if w in scale}
        length = math.sqrt(sum(x * x for x in raw.values()))
        return {w: x / length for w, x in raw.items()}

    held = [(label, name, unit(text)) for (label, text), name in examples.items()]
    count = [sum(h[0] == c for h in held) for c in (0, 1)]
    share = [sides[c] / count[c] for c in (0, 1)]
    share = [s / max(share) for s in share]
    base = sides[1] / sum(sides)

    def vote(vector, without=None):
        near = sorted(((-sum(x * h[2].get(w, 0) for w, x in vector.items()), k) for k, h in enumerate(held) if k != without))[: tx.NEIGHBOURS]
        votes = [(c * c * share[held[k][0]], held[k][0]) for c, k in near if c < 0]
        return (sum(v for v, y in votes if y) + tx.PRIOR_VOTE * base) / (sum(v for v, _ in votes) + tx.PRIOR_VOTE)

    return lambda text: vote(unit(text)) if unit(text) else base


def test_scores_against_plain_ones(spark):
    rows = [(i, t, y) for i, t, y in corpus()[:150]]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, "unseen"), (901, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 4], "doc_id long, label int")
    model = tx.fit(spark, docs, labels)
    plain = plain_scores([r for r in rows if r[0] % 4], None, [t for _, t, _ in rows] + ["unseen", None])
    slope, offset = model.curve
    assert slope > 0
    for r in tx.score(spark, docs, model).collect():
        text = dict((i, t) for i, t, _ in rows).get(r["doc_id"], "unseen" if r["doc_id"] == 900 else None)
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-(slope * plain(text) + offset))), abs=1e-9)
        assert len(r["neighbours"]) == len(r["cosines"]) <= tx.NEIGHBOURS and r["cosines"] == sorted(r["cosines"], reverse=True)


def test_bounds_hold_and_all_terms_stay(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, label int")
    model = tx.fit(spark, docs, labels, max_examples=30)
    assert not model.vectors and model.index.n == 60
    assert sorted(Counter(model.labels.tolist()).items()) == [(0, 30), (1, 30)]
    texts = dict((i, t) for i, t, _ in rows)
    assert set(model.known) == {w for n in model.names for w in tx.words_of(texts[n])}
    fewer = tx.fit(spark, docs, labels, max_examples=30, max_entries=500)
    assert fewer.index.n and 0 < sum(len(t) for t, _ in fewer.vectors) <= 500


def corpus():
    rnd = random.Random(9)
    bad, clean = ["vilest", "grumox", "vilesten", "grumoxly"], [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    rows = []
    for i in range(600):
        words = [rnd.choice(clean) for _ in range(rnd.randrange(5, 60))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(2):
                words.insert(rnd.randrange(len(words)), rnd.choice(bad))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_held_out_accuracy_and_odd_rows(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "score") for i, t, _ in rows] + [(None, "vilest", ""), (9000, None, ""), (9001, "", ""), (3, "again " * 9000, "")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 5] + [(None, 1), (5, None), (7, 0), (7, 0)], "doc_id long, label int")
    model = tx.fit(spark, docs, labels)
    out = tx.score(spark, docs, model).collect()
    assert len(out) == len(rows) + 4
    truth = {i: y for i, _, y in rows if i % 5 == 0}
    wrong = [r for r in out if r["doc_id"] in truth and (r["score"] >= 0.5) != truth[r["doc_id"]]]
    assert not wrong
    blank = {r["score"] for r in out if r["doc_id"] in (9000, 9001)}
    assert len(blank) == 1 and blank.pop() < 0.5
    assert next(r for r in out if r["doc_id"] is None)["score"] > 0.5


def test_nothing_labelled_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, label int")
    assert [r["score"] for r in tx.score(spark, docs, tx.fit(spark, docs, none)).collect()] == [0.0]
    empty = docs.where("doc_id < 0")
    assert tx.score(spark, empty, tx.fit(spark, empty, none)).collect() == []


def test_query_contract(spark):
    out = tx.op3_toxicity(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "held_out", "score", "predicted", "neighbours", "cosines"]
    rows = out.collect()
    assert len(rows) == 200 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
