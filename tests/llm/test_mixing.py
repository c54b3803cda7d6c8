import math
import random

import pytest

from waybill.llm import mixing


def test_capped_shares():
    assert mixing.capped_shares([100, 100, 100], [3, 1, 2], 450) == pytest.approx([200, 250 / 3, 500 / 3])
    assert mixing.capped_shares([10, 1000], [1, 1], 500) == pytest.approx([20, 480])
    assert mixing.capped_shares([10, 10], [1, 1], 500) == [20, 20]
    assert mixing.capped_shares([0, 10], [3, 1], 15) == pytest.approx([0, 15])
    assert mixing.capped_shares([], [], 0) == []


def rows():
    rnd = random.Random(8)
    out = []
    for source, n, typical in (("a", 40, 30), ("b", 400, 20), (None, 60, 50), ("Z", 3, 5), ("é", 0, 1)):
        for _ in range(n):
            out.append((len(out), " ".join(["w"] * max(0, int(rnd.lognormvariate(math.log(typical), 1)))), source))
    out += [(7, None, "b"), (8, "", "b"), (9, "same text here", "b"), (9, "same text here", "b"), (None, "x\ty\nz", "a")]
    out += [(1000 + i, "five words are in here", "b") for i in range(300)]
    return out


def frame(spark, data):
    return spark.createDataFrame([(d, t, s, 1, "x") for d, t, s in data], "doc_id long, text string, source string, size int, target string")


@pytest.mark.parametrize("cell", [20_000, 16])
def test_targets_are_met(spark, cell):
    data = rows()
    out = mixing.mix(spark, frame(spark, data), cell=cell).collect()
    assert sorted(str((r["doc_id"], r["source"], r["size"])) for r in out) == sorted(str((d, s, len((t or "").split()))) for d, t, s in data)
    sizes = {}
    for d, t, s in data:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = mixing.capped_shares([sizes[s] for s in names], [[3, 1, 2][i % 3] for i in range(len(names))], 1.5 * sum(sizes.values()))
    for name, target in zip(names, targets, strict=True):
        mine = [r for r in out if r["source"] == name]
        assert {r["source_size"] for r in mine} == {sizes[name]} and mine[0]["target"] == pytest.approx(target)
        assert all(0 <= r["copies"] <= 2 and abs(r["copies"] - r["rate"]) < 1 + 1e-6 or r["size"] == 0 for r in mine)
        assert sum(r["rate"] * r["size"] for r in mine) == pytest.approx(target, rel=1e-6)
        assert abs(sum(r["copies"] * r["size"] for r in mine) - target) <= 10
        # exponential tilt: log rate is proportional to size below the cap
        slopes = [math.log(r["rate"]) / r["size"] for r in mine if r["size"] and 1e-6 < r["rate"] < 2 - 1e-9]
        assert not slopes or max(slopes) - min(slopes) < 1e-6
    again = mixing.mix(spark, frame(spark, data).repartition(7), cell=cell).collect()
    key = lambda r: str(tuple(r))
    assert sorted(out, key=key) == sorted(again, key=key)


def test_many_sources_and_a_very_long_text(spark):
    """Thousands of sources go through one small joined table a step; a text of half a million words is one document."""
    rnd = random.Random(4)
    data = [(i, "w " * rnd.randrange(1, 30), f"s{i % 2500:04d}") for i in range(20_000)] + [(20_000, "w " * 500_000, "long"), (20_001, "a b", "long")]
    out = mixing.mix(spark, frame(spark, data)).collect()
    assert len(out) == len(data)
    taken, target, size = {}, {}, {}
    for r in out:
        taken[r["source"]] = taken.get(r["source"], 0) + r["copies"] * r["size"]
        target[r["source"]], size[r["source"]] = r["target"], r["source_size"]
        assert r["copies"] <= 2
    assert size["long"] == 500_002 and abs(taken["long"] - target["long"]) <= 500_000
    assert all(abs(taken[s] - target[s]) <= 40 for s in target if s != "long")
    capped = mixing.capped_shares([size[s] for s in sorted(size)], [[3, 1, 2][i % 3] for i in range(len(size))], 1.5 * sum(size.values()))
    assert [target[s] for s in sorted(size)] == pytest.approx(capped)


def test_empty(spark):
    assert mixing.mix(spark, frame(spark, [])).collect() == []
