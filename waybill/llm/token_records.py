"""Token ids in length-delimited binary records with a separate offset index.

A data file holds one record per document, in ascending id order: the payload's length (u64), the masked checksum
of that length (u32), the payload (ids as little-endian u16 or, for vocabularies beyond 65,536 ids, u32), the masked
checksum of the payload (u32). The index beside it holds one entry per record: byte offset (u64), number of ids (u64),
whether there is a document id (u8) and that id (i64); its last four bytes are a masked checksum of all entries. A
shuffled reader seeks to any record by its offset.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import file_system, shared_path, trimmed

#: Fixed value: what is added to a rotated checksum, so that a checksum of data that holds checksums stays useful.
MASK_DELTA = 0xA282EAD8
END_ID = 1
#: Words whose ids a Python worker keeps at most, some 250 bytes each; further words are encoded when they come.
MAX_CACHED_WORDS = 400_000
#: Texts encoded at once.
TOGETHER = 2048
#: Words up to this many characters are kept.
MAX_CACHED_CHARS = 40
#: Bytes of text that a file's records are made of, about; small tables have a file for each shuffle partition.
FILE_BYTES = 256 << 20
#: Bytes of record files that a task reads, about; small tables have two tasks for each core, or one for each file.
READ_BYTES = 32 << 20
ENTRY = np.dtype([("offset", "<u8"), ("n", "<u8"), ("known", "u1"), ("id", "<i8")])
VOCABULARY = "word_bpe_49k.json"


class CorruptRecord(ValueError):
    """A checksum or a length does not agree with the bytes read."""


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return head + struct.pack("<I", masked(head)) + payload + struct.pack("<I", masked(payload))


def unframe(data: bytes, offset: int = 0) -> tuple[bytes, int]:
    """(payload, offset of the next record); raises CorruptRecord."""
    head = data[offset : offset + 12]
    if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked(head[:8]):
        raise CorruptRecord(f"length of the record at {offset}")
    end = offset + 12 + struct.unpack("<Q", head[:8])[0]
    payload, check = data[offset + 12 : end], data[end : end + 4]
    if len(check) < 4 or struct.unpack("<I", check)[0] != masked(payload):
        raise CorruptRecord(f"payload of the record at {offset}")
    return payload, end + 4


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: str.split() cuts at these too, which these vocabularies do not count as white space.
NOT_SPACE = "\x1c\x1d\x1e\x1f"


class WordEncoder:
    """Ids of whole texts, word by word where no token of the vocabulary spans white space, else text by text.

    Ids of words are kept, so the library meets frequent ones once; the frequent words come early, so a full table
    stays as it is. Latin letters are asked for in lower case, many words at once, where the vocabulary ignores case;
    a final full stop or comma after an ASCII letter or digit is a token of its own.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        size = self.tokenizer.get_vocab_size()
        self.code = "H" if size <= 1 << 16 else "I"
        self.kept: dict[str, bytes] = {}
        ids = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        self.by_word = ids(" a.b\n\tcd, e  ") == ids("a.b") + ids("cd,") + ids("e") and ids("cd.") == ids("cd") + ids(".")
        self.folds = ids("A\xc9 b") == ids("a\xe9 b")
        self.last = np.zeros(size, bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.last[i] = token.endswith("</w>")

    def _ids_of(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words. Words of Latin letters are encoded together and cut at the tokens that end one."""
        out: dict[str, bytes] = {}
        plain = [w for w in words if w.isalpha() and (w.isascii() or max(w) < "\u0250")]
        size = np.dtype(f"u{array(self.code).itemsize}").itemsize
        for a in range(0, len(plain), 1000):
            part = plain[a : a + 1000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids)
            cuts = (np.flatnonzero(self.last[ids]) + 1) * size
            if len(cuts) == len(part) and cuts[-1] == len(ids) * size:
                data, start = ids.astype(f"<u{size}").tobytes(), 0
                for w, end in zip(part, cuts.tolist(), strict=True):
                    out[w] = data[start:end]
                    start = end
        rest = [w for w in words if w not in out]
        for w, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            out[w] = array(self.code, e.ids).tobytes()
        return out

    @staticmethod
    def words(text: str) -> list[str]:
        if any(c in text for c in NOT_SPACE):
            return re.split(r"[ \t\n\v\f\r]+", text)
        return text.split()

    def _known(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words, from those kept where they are."""
        kept = self.kept
        fresh = [w for w in words if w not in kept]
        if not fresh:
            return list(map(kept.__getitem__, words))
        stems, made_of = set(), {}
        for w in fresh:
            tail = ""
            stem = w
            if len(w) > 1 and w[-1] in ".," and w[-2].isascii() and w[-2].isalnum():
                stem, tail = w[:-1], w[-1]
                stems.add(tail)
            if self.folds and stem.isalpha() and (stem.isascii() or max(stem) < "\u0100"):
                stem = stem.lower()
            stems.add(stem)
            if stem != w:
                made_of[w] = (stem, tail)
        ids = self._ids_of([w for w in stems if w not in kept])
        tails = {t: ids.get(t) or kept.get(t) for t in ".,"}
        for w, (stem, tail) in made_of.items():
            x = ids.get(stem) or kept[stem]
            ids[w] = x + tails[tail] if tail else x
        room = MAX_CACHED_WORDS - len(kept)
        if room > 0:
            for w, x in ids.items():
                if len(w) <= MAX_CACHED_CHARS and room > 0:
                    kept[w] = x
                    room -= 1
        return [ids[w] if w in ids else kept[w] for w in words]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text, two or four bytes each as ``code`` says.

        Words are cut and told apart by Arrow, and the ids of all texts gathered at once from those of distinct words.
        """
        if not self.by_word:
            return [array(self.code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if any(c in t for t in texts for c in NOT_SPACE):
            split = pa.array([self.words(t) for t in texts], pa.list_(pa.string()))
        else:
            split = pc.utf8_split_whitespace(pa.array(texts, pa.string()))
        words = split.flatten().dictionary_encode()
        known = self._known(words.dictionary.to_pylist())
        size = np.dtype(f"u{array(self.code).itemsize}").itemsize
        blob = np.frombuffer(b"".join(known), f"<u{size}")
        count = np.fromiter(map(len, known), np.int32, len(known)) // size
        first = np.cumsum(count, dtype=np.int32) - count
        at = words.indices.to_numpy()
        counts = count[at]
        ends = np.cumsum(counts, dtype=np.int64)
        if len(ends) and ends[-1] >= 1 << 31 and len(texts) > 1:  # places have 31 bits
            return [x for t in texts for x in self.encode([t])]
        place = np.repeat((first[at] - (ends - counts)).astype(np.int32), counts)
        place += np.arange(len(place), dtype=np.int32)
        ids = blob[place]
        cuts = np.r_[0, ends][np.r_[0, np.cumsum(pc.list_value_length(split).to_numpy())]]
        return [ids[a:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def _text_bytes(texts: DataFrame) -> int:
    """Bytes of a column of texts, as the optimizer has them from the files' sizes; counted where it has no idea."""
    about = int(str(texts._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return about if about < 1 << 50 else texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def write_records(
    spark: SparkSession, docs: DataFrame, vocabulary: str, url: str, id_col: str = "doc_id", text_col: str = "text",
    end_id: int | None = END_ID, files: int | None = None,
) -> list[dict]:
    """Encode ``docs`` and write the records under ``url`` in ascending id order; returns the manifest, one entry per file.

    Rows without an id come first; rows that repeat an id are ordered by their texts. Texts are dealt out by ranges of
    (id, checksum of the text), so that each is encoded once, where it is written, and an id that many rows share has
    many tasks. A task writes under a name of its own attempt and the manifest names the attempts that counted, so a
    lost executor's files are never read. The manifest (one entry per file, not per document) is written last.
    """
    if not files:
        size = _text_bytes(docs.select(F.col(text_col).cast("string").alias("text")))
        files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES))
    docs = docs
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("check", F.crc32(F.col("text").cast("binary")))
    order = [F.col("id").asc_nulls_first(), F.col("check")]
    parts = rows.repartitionByRange(files, *order).sortWithinPartitions(*order, "text").select("id", "text")

    # A worker keeps a broadcast value from task to task of the jobs that name it, and so the words in it.
    kept = spark.sparkContext.broadcast({})

    def run(batches):
        import uuid

        from pyspark import TaskContext

        encoder = kept.value.get("encoder") or kept.value.setdefault("encoder", WordEncoder(vocabulary))
        end = b"" if end_id is None else array(encoder.code, [end_id]).tobytes()
        size = len(array(encoder.code, [0]).tobytes())
        fs, root = file_system(url)
        task = TaskContext.get()
        part = task.partitionId() if task else 0
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        fs.create_dir(root, recursive=True)
        entries, offset, ids = [], 0, 0
        with fs.open_output_stream(f"{root}/{name}.records") as out:
            for batch in batches:
                for a in range(0, batch.num_rows, TOGETHER):
                    keys = batch.column(0).slice(a, TOGETHER).to_pylist()
                    block = np.zeros(len(keys), ENTRY)
                    for i, payload in enumerate(encoder.encode(batch.column(1).slice(a, TOGETHER).to_pylist())):
                        payload += end
                        block[i] = (offset, len(payload) // size, keys[i] is not None, keys[i] or 0)
                        out.write(record := frame(payload))
                        offset += len(record)
                        ids += len(payload) // size
                    entries.append(block.tobytes())
        index = b"".join(entries)
        with fs.open_output_stream(f"{root}/{name}.index") as out:
            out.write(index + struct.pack("<I", masked(index)))
        row = [part, name, len(index) // ENTRY.itemsize, ids, offset, size]
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], ["part", "name", "records", "ids", "bytes", "size"])

    done = parts.mapInArrow(trimmed(run), "part long, name string, records long, ids long, bytes long, size long").collect()
    manifest, start = [], 0
    for r in sorted(done, key=lambda r: r["part"]):
        if r["records"]:
            manifest.append({k: r[k] for k in ("name", "records", "ids", "bytes", "size")} | {"start": start})
            start += r["ids"]
    fs, root = file_system(url)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def read_index(fs, path: str) -> np.ndarray:
    with fs.open_input_stream(path) as f:
        data = f.read()
    if len(data) < 4 or struct.unpack("<I", data[-4:])[0] != masked(data[:-4]):
        raise CorruptRecord(path)
    return np.frombuffer(data[:-4], ENTRY)


def read_records(spark: SparkSession, url: str, id_col: str = "doc_id") -> DataFrame:
    """``id_col, start, ids`` of every record under ``url``: ``start`` counts the ids of all records before it.

    ``ids`` is binary, little-endian u32 whatever the files hold.

    A task reads neighbouring files of about ``READ_BYTES``, record by record, as every task costs processes where its
    rows are written to a local disk. Every checksum is verified.
    """
    fs, root = file_system(url)
    with fs.open_input_stream(f"{root}/manifest.json") as f:
        manifest = json.loads(f.read())
    total = sum(m["bytes"] for m in manifest)
    tasks = min(len(manifest), max(2 * spark.sparkContext.defaultParallelism, -(-total // READ_BYTES)))
    groups: dict[int, list] = {}
    before = 0
    for m in manifest:
        groups.setdefault((before + m["bytes"] // 2) * tasks // total, []).append((m["name"], m["start"], m["size"]))
        before += m["bytes"]

    def run(batches):
        fs, root = file_system(url)
        for batch in batches:
            for name, start, size in (f for g in batch.column(0).to_pylist() for f in groups.get(g, ())):
                index = read_index(fs, f"{root}/{name}.index")
                ids = [int(k) if known else None for k, known in zip(index["id"], index["known"], strict=True)]
                starts = start + np.r_[0, np.cumsum(index["n"].astype(np.int64))[:-1]]
                with fs.open_input_stream(f"{root}/{name}.records") as f:
                    for a in range(0, len(index), 512):
                        block = index[a : a + 512]
                        data = f.read(int(block["n"].sum() * size + 16 * len(block)))
                        at, payloads = 0, []
                        for n in block["n"]:
                            payload, at = unframe(data, at)
                            if len(payload) != size * int(n):
                                raise CorruptRecord(f"{name}: a record's length differs from the index")
                            payloads.append(np.frombuffer(payload, f"<u{size}").astype("<u4").tobytes())
                        yield pa.RecordBatch.from_arrays([pa.array(ids[a : a + 512], pa.int64()), pa.array(starts[a : a + 512]), pa.array(payloads, pa.binary())], [id_col, "start", "ids"])

    return spark.range(0, tasks, 1, max(1, tasks)).mapInArrow(run, T.StructType([T.StructField(id_col, T.LongType()), T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType())]))


def read_shuffled(url: str, seed: int = 0):
    """Records of all files as (id, ids array) in an order drawn from ``seed``, by seeks through the indexes."""
    fs, root = file_system(url)
    with fs.open_input_stream(f"{root}/manifest.json") as f:
        manifest = json.loads(f.read())
    rnd = np.random.default_rng(seed)
    for m in rnd.permutation(len(manifest)):
        name, size = manifest[m]["name"], manifest[m]["size"]
        index = read_index(fs, f"{root}/{name}.index")
        with fs.open_input_file(f"{root}/{name}.records") as f:
            for i in rnd.permutation(len(index)):
                data = f.read_at(int(index["n"][i]) * size + 16, int(index["offset"][i]))
                yield (int(index["id"][i]) if index["known"][i] else None), np.frombuffer(unframe(data)[0], f"<u{size}").astype("<u4")


def token_records(spark: SparkSession, docs: DataFrame, vocabulary: str, url: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = END_ID) -> DataFrame:
    """Encode, write and read back: ``id_col, start, ids`` of every row of ``docs``, in the files' order.

    Null and empty texts have only the end id. Rows that repeat an id or a text are records each; equal ids are in the
    order of their texts' checksums, then texts, and rows without an id come first. An empty table gives an empty
    manifest and no rows. Other columns are not read, whatever their names.
    """
    url = url or shared_path(spark, "records")
    write_records(spark, docs, vocabulary, url, id_col, text_col, end_id)
    return read_records(spark, url, id_col)


def op4_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's record as read back; odd rows, ties and empty tables: see ``token_records``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    records = token_records(spark, docs, vocabulary_path())
    return records.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
