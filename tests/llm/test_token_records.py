import random
import struct

import pytest
from tokenizers import Tokenizer

from waybill.llm import token_records as tr

VOCAB = tr.vocabulary_path()


def test_words_encode_like_whole_texts():
    t = Tokenizer.from_file(VOCAB)
    texts = ["", " ", "Hello, World! don't  STOP\n\n\tÉcole été ́x ﬁ ½", "a<|endoftext|>b <|startoftext|> c", "ΣΑΣ x y\x1cz\x85q ₂3", "İstanbul ẞ 日本語 😀😀 " + "x" * 500, "'s 's're 5'll", "a., b.. 3. é. c!. ., . , x\u0301. ½,"]
    rnd = random.Random(1)
    alphabet = "abzéÄ'sd ,.\t\n\v\f\r0́ ​<|>日Σ"
    texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(80))) for _ in range(800)]
    enc = tr.WordEncoder(VOCAB)
    for got, text in zip(enc.encode(texts), texts, strict=True):
        want = t.encode(text, add_special_tokens=False).ids
        assert list(struct.unpack(f"<{len(got) // 2}H", got)) == want, text


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_any_vocabulary(name):
    path = tr.vocabulary_path(name)
    t, enc = Tokenizer.from_file(path), tr.WordEncoder(path)
    assert enc.by_word == name.startswith("word")
    texts = ["The  Cat, sat.\nON it <|ENDOFTEXT|> <|endoftext|>", "\xc9COLE \xdf \u0130x \xb5 \u01c5 ", "don't Stop.", ""]
    for got, text in zip(enc.encode(texts), texts, strict=True):
        assert list(struct.unpack(f"<{len(got) // 2}H", got)) == t.encode(text, add_special_tokens=False).ids


def test_full_cache_stays_right(monkeypatch):
    monkeypatch.setattr(tr, "MAX_CACHED_WORDS", 3)
    enc = tr.WordEncoder(VOCAB)
    for text in ("one two three four five", "two six", "one"):
        assert enc.encode([text])[0] == tr.WordEncoder(VOCAB).encode([text])[0]


def test_round_trip(spark, tmp_path):
    rnd = random.Random(2)
    rows = [(i * 3 % 101, " ".join(rnd.choice(["ab", "Cd,", "é", "long"]) for _ in range(rnd.randrange(40)))) for i in range(101)]
    rows += [(7, None), (7, ""), (7, "again"), (None, "no id"), (200, "word " * 30000)]
    df = spark.createDataFrame([(d, t, "clash", 1) for d, t in rows], "doc_id long, text string, ids string, start int")
    out = tr.token_records(spark, df, VOCAB, f"file://{tmp_path}/r").collect()
    t = Tokenizer.from_file(VOCAB)
    want = [(d, struct.pack(f"<{len(x)}I", *x)) for d, text in rows for x in [t.encode(text or "", add_special_tokens=False).ids + [1]]]
    want.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1][::-1]))
    got = sorted(out, key=lambda r: r["start"])
    assert sorted(((r["doc_id"], bytes(r["ids"])) for r in got), key=lambda r: (r[0] is not None, r[0] or 0, r[1][::-1])) == want
    keys = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in got]
    assert keys == sorted(keys)
    at = 0
    for r in got:
        assert r["start"] == at
        at += len(r["ids"]) // 4
    shuffled = list(tr.read_shuffled(f"file://{tmp_path}/r", 5))
    assert sorted((str(d), x.tobytes()) for d, x in shuffled) == sorted((str(d), x) for d, x in want)


def test_damage_is_noticed():
    data = tr.frame(b"abcd")
    assert tr.unframe(data) == (b"abcd", len(data))
    for i in range(len(data)):
        bad = bytearray(data)
        bad[i] ^= 1
        with pytest.raises(tr.CorruptRecord):
            tr.unframe(bytes(bad))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert tr.token_records(spark, df, VOCAB).collect() == []


def test_many_files_are_read_by_few_tasks(spark, tmp_path):
    rows = [(i, f"word{i} " * (i % 9)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    manifest = tr.write_records(spark, docs, VOCAB, str(tmp_path), files=40)
    out = tr.read_records(spark, str(tmp_path))
    assert len(manifest) == 40 and out.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    got = out.collect()
    assert [r["doc_id"] for r in got] == list(range(300))
    assert [r["start"] for r in got][1:] == [sum(len(r["ids"]) // 4 for r in got[: i + 1]) for i in range(299)]
