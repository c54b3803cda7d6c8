import random
import re
from collections import Counter

import numpy as np

from waybill.llm import quality_rules as qr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    n = Counter(windows)
    covered = {j for i, w in enumerate(windows) if n[w] > 1 for j in range(i, i + 5)}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)]


def texts():
    rnd = random.Random(6)
    out = [None, "", " \n\t", "a", "a b c d e", "a b c d e f", "x " * 50, "é日 \x85 \xa0x #|<>\x0b", "l one\nl one\n\n \nl one", "w " * 30000]
    for _ in range(60):
        vocab = ["ab", "c", "é", "|", "#x", "long"][: rnd.randrange(2, 7)]
        out.append("".join(rnd.choice(vocab) + rnd.choice([" ", "\n", "  ", "\t"]) for _ in range(rnd.randrange(80))))
    return out


def test_counts_against_brute_force():
    for t in texts():
        assert qr.statistics(t)[0] == brute(t), t


def labelled():
    rnd = random.Random(2)
    rows = []
    for i in range(900):
        words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 9))) for _ in range(rnd.randrange(60, 120))]
        bad = i % 15 == 0
        if bad:
            words = [w + rnd.choice("#|%") * rnd.randrange(1, 2 + i % 7) for w in words]
        rows.append((i, " ".join(words), int(not bad)))
    return rows


def test_forest_finds_bad_rows_and_keeps_good_ones(spark):
    rows = labelled()
    extra = [(2000 + i, t) for i, t in enumerate(texts())] + [(None, "no id"), (5, None)]
    docs = spark.createDataFrame([(i, t, 1, True) for i, t, _ in rows] + [(i, t, 2, None) for i, t in extra], "doc_id long, text string, n_words int, kept boolean")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 2] + [(None, 0), (3, None)], "doc_id long, good int")
    rules = qr.fit(spark, docs, labels)
    out = qr.judge(spark, docs, rules).collect()
    assert len(out) == len(rows) + len(extra)
    mine = {r["doc_id"]: r for r in out if r["doc_id"] is not None and r["doc_id"] < 900 and r["n_words"]}
    held = [(mine[i]["kept"], y) for i, _, y in rows if i % 2 == 0]
    assert np.mean([k for k, y in held if y]) > 0.97
    assert np.mean([not k for k, y in held if not y]) > 0.6
    texts_of = {(i, t): None for i, t, _ in rows} | {(i, t): None for i, t in extra}
    for i, t in texts_of:
        n = brute(t)
        assert any([r[c] for c in qr.COUNTS] == n and r["base_failed"] == (n[0] < 10 or 100 * n[4] > 20 * n[0]) for r in out if r["doc_id"] == i)
    again = qr.judge(spark, docs.repartition(5), qr.fit(spark, docs.repartition(3), labels)).collect()
    key = lambda r: str((r["doc_id"], r["n_words"], r["kept"], r["anomaly"]))
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_features_are_the_rules_statistics():
    counts, features = qr.statistics("ab cd ab ef gh\nab cd ab ef gh\n#x 12345678 zz")
    assert counts == [13, 32, 1, 1, 10]
    assert np.allclose(features, [1 / 32, 32 / 13, 1 / 3, 10 / 13, np.log(14), 7 / 13])
    assert len(features) == len(qr.FEATURES)


def plain_path(tree, row):
    """A tree walked node by node from the root."""
    feature, cut, left, right, length = tree
    at = 0
    while feature[at] >= 0:
        at = left[at] if row[feature[at]] < cut[at] else right[at]
    return length[at]


def test_path_lengths_threshold_and_verdicts_against_plain_ones(spark):
    rnd = np.random.default_rng(3)
    rows = np.r_[rnd.normal(size=(300, 6)), rnd.normal(size=(20, 6)) + [6, 0, 0, 0, 0, 0]]
    good = np.arange(320) < 300
    weights = qr.separation(rows, good)
    assert weights.argmax() == 0 and weights.min() >= qr.LEAST_WEIGHT
    forest = qr.IsolationForest(rows, trees=20, sample=64, weights=weights)
    used = [f for t in forest.trees for f in t[0] if f >= 0]
    assert len(used) > 200 and used.count(0) > 3 * max(used.count(f) for f in range(1, 6))
    harmonic = sum(1 / i for i in range(1, 64))
    norm = 2 * harmonic - 2 * 63 / 64
    scores = forest.score(rows)
    for row, score in zip(rows, scores, strict=True):
        mean = np.mean([plain_path(t, row) for t in forest.trees])
        assert abs(score - 2 ** (-mean / norm)) < 2e-3
    for t in forest.trees:  # a leaf's length is its depth and what its rows would still take
        feature, _, left, right, length = t
        depth = {0: 0}
        for i in range(len(feature)):
            if feature[i] >= 0:
                depth[int(left[i])] = depth[int(right[i])] = depth[i] + 1
            else:
                assert length[i] >= depth[i] and depth[i] <= forest.depth
    threshold = qr.calibrate(scores, good, 0.01, 10.0)
    gains = {}
    for s in scores[good]:
        if (scores[good] > s).mean() <= 0.01:
            gains[s] = (scores[~good] > s).mean() - 10 * (scores[good] > s).mean()
    assert gains[threshold] == max(gains.values())


def test_kept_is_the_base_rule_and_the_threshold(spark):
    docs = spark.createDataFrame([(i, t) for i, t, _ in labelled()], "doc_id long, text string")
    rules = qr.fit(spark, docs, spark.createDataFrame([(i, y) for i, _, y in labelled()], "doc_id long, good int"))
    for r in qr.judge(spark, docs, rules).collect():
        mean = np.mean([plain_path(t, r["features"]) for t in rules.forest.trees])
        assert abs(r["anomaly"] - 2 ** (-mean / rules.forest.expected(rules.forest.sample))) < 1e-9
        assert r["kept"] == (not r["base_failed"] and r["anomaly"] <= rules.threshold)


def test_no_labels_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, good int")
    assert [r["kept"] for r in qr.judge(spark, docs, qr.fit(spark, docs, none)).collect()] == [True]
    empty = docs.where("doc_id < 0")
    assert qr.judge(spark, empty, qr.fit(spark, empty, none)).collect() == []


def test_every_labelled_row_counts(spark):
    rnd = random.Random(4)
    rows = [(i, " ".join("".join(rnd.choice("abcd") for _ in range(rnd.randrange(1, 7))) + "#" * (i % 9 == 0 and rnd.random() < 0.4) for _ in range(12)), int(i % 9 > 0)) for i in range(21_000)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    rules = qr.fit(spark, docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, good int"))
    found = [(qr.statistics(t), y) for _, t, y in rows]
    found = [(f, y) for (c, f), y in found if not qr.base_failed(c[0], c[4])]
    values, good = np.array([f for f, _ in found]), np.array([y > 0 for _, y in found])
    assert len(values) > 20_000
    assert np.array_equal(rules.forest.weights, qr.separation(values, good))
    assert rules.threshold == qr.calibrate(rules.forest.score(values), good)
    assert len(rules.forest.trees) == qr.TREES and rules.forest.sample == qr.TREE_ROWS
