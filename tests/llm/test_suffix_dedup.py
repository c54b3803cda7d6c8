import hashlib
import random
from collections import Counter

import numpy as np

from waybill.llm import suffix_dedup as sd


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    n = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if n[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def fixture():
    rnd = random.Random(13)
    draw = lambda n: "".join(rnd.choice("abcdefghié \n") for _ in range(n))
    shared = [draw(rnd.choice([60, 63, 64, 65, 80, 200, 500])) for _ in range(12)]
    texts = [None, "", "short", "a" * 300, "ab" * 200, "a" * 63, draw(64), "xyz" * 21 + "x"]
    for _ in range(70):
        t = draw(rnd.randrange(150))
        for _ in range(rnd.randrange(3)):
            p = rnd.choice(shared)
            a = rnd.randrange(max(1, len(p) // 2))
            t += p[a : a + rnd.randrange(40, 300)] + draw(rnd.randrange(60))
        texts.append(t)
    base = draw(700)
    for _ in range(25):  # near copies
        w = list(base)
        for _ in range(rnd.randrange(4)):
            w[rnd.randrange(len(w))] = rnd.choice("xyz")
        texts.append("".join(w))
    return texts + [texts[9]] * 3 + ["b" * 64, "q" + "b" * 64]


def shared(texts, also):
    """Whether each text has a string of so many bytes that another row has too."""
    rows = [{b[i : i + also] for i in range(len(b) - also + 1)} for b in ((t or "").encode() for t in texts)]
    n = Counter(w for r in rows for w in r)
    return [any(n[w] > 1 for w in r) for r in rows]


def want_of(texts, length=64, also=40):
    both = [(*x, y[1], y[2], z) for x, y, z in zip(brute(texts, length), brute(texts, also), shared(texts, also), strict=True)]
    return sorted((str(None if i == 4 else i // 2 * 2), *x) for i, x in enumerate(both))


def got(spark, texts, length=64, also=40, **kw):
    df = spark.createDataFrame([(None if i == 4 else i // 2 * 2, t, "x", i) for i, t in enumerate(texts)], "doc_id long, text string, spans string, n long")
    rows = sd.remove_repeats(spark, df, length=length, also=also, **kw).collect()
    total = lambda spans: sum(s["end"] - s["start"] for s in spans)
    return sorted((str(r["doc_id"]), r["n_bytes"], total(r["spans"]), len(r["spans"]), hashlib.sha256(bytes(r["kept"])).hexdigest(), total(r["repeats"]), len(r["repeats"]), r["elsewhere"]) for r in rows)


def test_against_brute_force(spark):
    texts = fixture()
    assert got(spark, texts) == want_of(texts)
    assert got(spark, texts, shard_contexts=2, chunk=300) == want_of(texts)
    assert got(spark, texts, also=64) == want_of(texts, also=64)
    assert got(spark, texts, length=24, also=16, shard_contexts=3, chunk=100) == want_of(texts, 24, 16)


def test_shuffled_joins_and_cut_texts_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(sd, "MAX_BROADCAST_BYTES", -1)
    texts = fixture()
    assert got(spark, texts) == want_of(texts)
    long = ["".join(random.Random(i // 2).choice("ab") for _ in range(6000)) + "z" * i for i in range(4)]
    monkeypatch.setattr(sd, "CHUNK_BYTES", 1000)
    assert got(spark, texts + long) == want_of(texts + long)


def test_very_long_texts(spark):
    """Texts beyond the length at which they are cut share a passage across the cut, at different places."""
    rnd = random.Random(6)
    draw = lambda n: "".join(rnd.choices("abcdefgh ", k=n))
    passage = draw(5000)
    first, second = (1 << 20) - 2500, 300_000
    texts = [draw(first) + passage + draw(1000), draw(second) + passage + draw(200_000), draw(1000)]
    rows = sorted(sd.remove_repeats(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect(), key=lambda r: r["doc_id"])
    for r, at in zip(rows, (first, second, None), strict=True):
        spans = [(s["start"], s["end"]) for s in r["spans"]]
        if at is None:
            assert not spans and not r["repeats"]
        else:  # a byte or two beside the passage can agree by chance
            assert len(spans) == 1 and at - 4 <= spans[0][0] <= at and at + 5000 <= spans[0][1] <= at + 5004
            assert bytes(r["kept"]) == (texts[r["doc_id"]][: spans[0][0]] + texts[r["doc_id"]][spans[0][1] :]).encode()


def test_orders_and_prefixes():
    rnd = random.Random(1)
    texts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(40, 60))) for _ in range(30)] + [b"a" * 45]
    count = np.array([len(t) - 9 + 1 for t in texts])
    number, start, found = sd.repeated_starts(texts, count, (9, 12))
    for length, (place, group) in zip((9, 12), found, strict=True):
        strings = [texts[number[i]][start[i] : start[i] + length] for i in place]
        assert sorted(strings) == strings and len(strings) == sum(len(t) - length + 1 for t in texts)
        assert [a == b for a, b in zip(strings, strings[1:], strict=False)] == (group[1:] == group[:-1]).tolist()


def test_merging_finds_strings_of_two_shards():
    import pyarrow as pa

    x, y, z = b"x", b"y", b"z"
    rows = [  # place's text or none, start, level, digest, the one text that has the string or none
        (x, 1, 1, 5, 5, x), (None, 2, 1, 5, 5, None), (x, 3, 0, 5, 6, x), (None, 4, 0, 6, 6, y), (x, 5, 0, 7, 1, x),
        (x, 6, 0, 7, 1, x), (y, 7, 0, 8, 1, y), (None, 8, 0, 8, 1, None), (y, 9, 0, 9, 1, y), (None, 10, 0, 9, 1, z),
    ]
    batches = []
    for a in range(0, len(rows), 3):
        part = rows[a : a + 3]
        columns = ([r[0] for r in part], [r[1] for r in part], [r[1] + 1 for r in part], *([r[i] for r in part] for i in (2, 3, 4, 5)))
        batches.append(pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, sd.FOUND.values(), strict=True)], list(sd.FOUND)))
    out = sorted(tuple(r.values()) for b in sd._merged(iter(batches)) for r in b.to_pylist())
    places = [(x, 1, 2, 1), (x, 5, 6, 0), (x, 6, 7, 0), (y, 7, 8, 0), (y, 9, 10, 0)]
    assert [r for r in out if r[3] != sd.ELSEWHERE] == places
    assert {r[0] for r in out if r[3] == sd.ELSEWHERE} == {y, z}  # x meets itself only
    assert list(sd._merged(iter([]))) == []


def test_contexts_depend_on_the_string_alone():
    rnd = np.random.default_rng(2)
    core = rnd.integers(97, 100, 600).astype(np.uint8).tobytes()
    keys = []
    for before in (b"", b"zz" * 50, b"q" * 333):
        first, end, key = sd.contexts(before + core + b"tail" * 30, 400)
        assert first[0] == 0 and (first[1:] == end[:-1]).all() and end[-1] == len(before) + len(core) + 120 - 400 + 1
        keys.append({int(k) for a, b, k in zip(first, end, key, strict=True) if a <= len(before) + 100 < b})
    assert keys[0] == keys[1] == keys[2]


def test_long_texts_are_cut(monkeypatch):
    monkeypatch.setattr(sd, "_PLACE", 10)
    text = bytes(random.Random(3).choice(b"abc") for _ in range(5000))
    first, end, _ = sd.contexts(text, 64)
    assert first[0] == 0 and (first[1:] == end[:-1]).all() and end[-1] == 5000 - 63


def test_empty(spark):
    assert got(spark, []) == []
