import random

import xxhash

from waybill.llm import simhash


def brute_print(text):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [b" ".join(w)] * bool(w)
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_classes(rows, max_bits=4):
    prints = [(d, brute_print(t)) for d, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= max_bits:
                parent[root(i)] = root(j)
    best = {}
    for i, (d, _) in enumerate(prints):
        if d is not None:
            best[root(i)] = min(best.get(root(i), d), d)
    return sorted((str(d), p, best.get(root(i))) for i, (d, p) in enumerate(prints))


def fixture_rows():
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    rows = [(1, None), (2, ""), (3, " \n "), (4, "One two"), (5, "one  TWO"), (5, "one  TWO"), (None, "null id here ok now"), (6, "x " * 4000)]
    n = 10
    for _ in range(12):
        base = [rnd.choice(vocab) for _ in range(rnd.choice([60, 200, 400]))]
        for _ in range(14):
            w = list(base)
            for _ in range(rnd.choice([0, 1, 2, 4])):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            rows.append((n, rnd.choice([" ", "\n"]).join(w)))
            n += 1
    return rows


def got(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], "doc_id long, text string, fp string, component_id string")
    out = simhash.near_duplicates(spark, df, **kw).collect()
    return sorted((str(r["doc_id"]), r["fp"] & (2**64 - 1), r["component_id"]) for r in out)


def test_against_brute_force(spark):
    rows = fixture_rows()
    assert got(spark, rows) == brute_classes(rows)


def test_hot_buckets_in_tiles(spark):
    rows = fixture_rows()
    assert got(spark, rows, bucket=4) == brute_classes(rows)


def test_dense_cluster_runs_through_blocks(spark):
    rnd = random.Random(3)
    base = rnd.getrandbits(64)
    prints = {base}
    while len(prints) < 700:
        prints.add(base ^ sum(1 << rnd.randrange(64) for _ in range(rnd.choice([1, 2, 3, 6]))) & (2**64 - 1))
    signed = sorted(p - 2**64 if p >> 63 else p for p in prints)
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    for bucket in (4096, 50):
        found = simhash.components(spark, simhash.links(spark, df, 4, bucket)).collect()
        roots = {r["node"]: r["root"] for r in found}
        label = {p: p for p in signed}
        changed = True
        while changed:
            changed = False
            for p in signed:
                low = min(label[q] for q in signed if ((p ^ q) & (2**64 - 1)).bit_count() <= 4)
                changed |= low != label[p]
                label[p] = low
        assert {p: roots.get(p, p) for p in signed} == label


def test_empty_table(spark):
    assert got(spark, []) == []
