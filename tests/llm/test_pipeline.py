import struct
import zlib
from collections import Counter

import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_near_copies import brute_kept
from waybill.llm import mixing, simhash, token_records, toxicity

DIR = "/root/testdata/sf0.01"


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    rows = docs.collect()
    model = toxicity.learn(spark, docs, DIR)
    calm = [r for r, s in zip(rows, model.scores([r["text"] for r in rows]), strict=True) if s[0] < 0.5]
    stay = set(brute_kept([(r["doc_id"], r["text"]) for r in calm]))
    single = [r for r in calm if r["doc_id"] in stay]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    hits = {h[0]: h[2] for h in brute_hits([(r["doc_id"], r["text"]) for r in single], items)}
    clean = [r for r in single if not hits[r["doc_id"]]]
    assert len(rows) > len(calm) > len(single) > len(clean) > 0

    stage = docs
    for (_, f), want in zip(cp.STAGES[:3], (calm, single, clean), strict=True):
        stage = f(spark, stage, DIR)
        assert stage.columns == docs.columns
        assert sorted(map(tuple, stage.collect())) == sorted(map(tuple, want))
    stage = spark.createDataFrame(clean, docs.schema)
    copies = Counter({r["doc_id"]: r["copies"] for r in mixing.mix(spark, stage).collect()})
    mixed = cp.mix_sources(spark, stage, DIR)
    assert Counter(r["doc_id"] for r in mixed.collect()) == +copies
    texts = {r["doc_id"]: r["text"] for r in clean}
    t = Tokenizer.from_file(token_records.vocabulary_path())
    want, at = [], 0
    for d in sorted((+copies).elements()):
        ids = t.encode(texts[d], add_special_tokens=False).ids + [1]
        want.append((d, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    assert sorted(map(tuple, cp.write_tokens(spark, mixed, DIR).collect()), key=lambda r: r[1]) == want
    assert sorted(map(tuple, cp.run(spark, DIR).collect()), key=lambda r: r[1]) == want


@pytest.mark.parametrize("shuffled", [False, True])
def test_odd_rows(spark, monkeypatch, shuffled):
    if shuffled:
        for module, name in ((simhash, "MAX_BROADCAST_ROWS"), (mixing, "MAX_BROADCAST_ROWS"), (mixing, "MAX_BROADCAST_CELLS"), (toxicity, "MAX_BROADCAST_LABELS")):
            monkeypatch.setattr(module, name, -1)

    schema = spark.read.parquet(f"{DIR}/documents.parquet").schema
    odd = [(1, None, None, None, None), (1, None, None, None, None), (None, "a b c d e", "en", "s", 3), (2, "", "en", "s", 0), (3, "some words " * 40, "en", None, 9), (3, "some words " * 40, "en", None, 9)]
    docs = spark.createDataFrame(odd, schema)
    for i, name in enumerate(["score", "spans", "_fp", "copies", "__n", "a.b"]):
        docs = docs.withColumn(name, F.lit(i))
    columns = docs.columns
    for _, f in cp.STAGES[:-1]:
        docs = f(spark, docs, DIR)
        assert docs.columns == columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in docs.collect() if r["text"]) == [("3", "some words " * 40)] * sum(r["doc_id"] == 3 for r in docs.collect()) + [("None", "a b c d e")] * sum(r["doc_id"] is None for r in docs.collect())
    out = cp.write_tokens(spark, docs, DIR).collect()
    assert len(out) == docs.count()
    empty = spark.createDataFrame([], schema)
    for _, f in cp.STAGES:
        empty = f(spark, empty, DIR)
    assert empty.collect() == []
