"""WARC archives: a writer with payload deduplication, and a Python data source that reads headers first.

``spark.read.format("waybill_warc").load(folder)`` reads any folder of ``.warc`` and ``.warc.gz`` files: a partition per
file, and per byte range where the writer's list names record boundaries. Predicates on the record type and on other
headers go into the reader: it parses a record's headers, seeks past the block where one fails, and decodes a payload
only of records that pass and only where payloads are wanted.
"""

from __future__ import annotations

import gzip
import io
import json
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, In, InputPartition, IsNotNull, StringContains, StringEndsWith, StringStartsWith

from .common import file_system, shared_path, staged

FORMAT = "waybill_warc"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
MIN_DEDUP_BYTES = 100
MAX_HEADER = 1 << 20
#: Output columns and the header each is read from; the last three are the writer's own.
HEADERS = {
    "record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To", "page_id": "X-Page-ID", "refers_to_page": "X-Refers-To-Page-ID",
    "payload_bytes": "X-Payload-Length",
}
NUMBERS = ("page_id", "refers_to_page", "payload_bytes")
SCHEMA = ", ".join(f"{c} {'long' if c in NUMBERS else 'string'}" for c in HEADERS) + ", payload binary"
#: Repeated digests up to this number (some 100 bytes each) are broadcast; more are joined by shuffle.
MAX_BROADCAST_DIGESTS = 200_000
#: Partitions are cut at record boundaries to about this many bytes; batches of rows hold about so many of payloads.
SPLIT_BYTES, BATCH_BYTES = 64 << 20, 4 << 20


class CorruptArchive(ValueError):
    """An archive's bytes are not a sequence of WARC records."""


def record(headers: dict[str, str | None], block: bytes) -> bytes:
    """A WARC/1.1 record; header values lose line ends, which would break the header block."""
    lines = [f"{k}: {' '.join(str(v).split(chr(10))).replace(chr(13), ' ')}" for k, v in headers.items() if v is not None]
    lines.append(f"Content-Length: {len(block)}")
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def http_block(payload: bytes) -> bytes:
    """An HTTP response whose body is the payload, compressed where that is shorter."""
    packed = gzip.compress(payload, 1, mtime=0)
    encoding = b"Content-Encoding: gzip\r\n" if len(packed) < len(payload) else b""
    body = packed if encoding else payload
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + encoding + b"Content-Length: %d\r\n\r\n" % len(body) + body


def _unchunked(body: bytes) -> bytes:
    """A body in chunks, joined; what follows a broken chunk is left out."""
    out, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            break
        if not size:
            break
        out.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size
    return b"".join(out)


def http_payload(block: bytes) -> bytes:
    """The body of an HTTP response, its chunks joined and gzip or deflate undone; other codings stay as they are."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = dict(x.lower().partition(b":")[::2] for x in head.split(b"\r\n")[1:])
    if b"chunked" in fields.get(b"transfer-encoding", b""):
        body = _unchunked(body)
    coding = fields.get(b"content-encoding", b"").strip()
    if coding in (b"gzip", b"x-gzip"):
        return gzip.decompress(body)
    return zlib.decompress(body) if coding == b"deflate" else body


def read_headers(f) -> dict[str, str] | None:
    """Headers (names in lower case) of the record at the stream's place, which is left at its block; None at the end."""
    while (line := f.readline(MAX_HEADER)) in (b"\r\n", b"\n"):  # what separates records
        pass
    if not line:
        return None
    if not line.startswith(b"WARC/1."):
        raise CorruptArchive(f"no record starts with {line[:40]!r}")
    out: dict[str, str] = {}
    name = ""
    while (line := f.readline(MAX_HEADER)) not in (b"\r\n", b"\n"):
        text = line.decode(errors="replace")
        if name and text[:1] in " \t":  # a folded value goes on
            out[name] += f" {text.strip()}"
            continue
        name, colon, value = text.partition(":")
        if not colon:
            raise CorruptArchive(f"not a header: {line[:40]!r}")
        name = name.strip().lower()
        out[name] = value.strip()
    return out


class Range(InputPartition):
    """Bytes ``start`` to ``end`` of a file; no end means all of it, which may be compressed."""

    def __init__(self, path: str, start: int = 0, end: int | None = None):
        self.path, self.start, self.end = path, start, end


class WarcScan(DataSourceReader):
    """Reads records whose type is one of ``types`` (any, unless given)."""

    def __init__(self, path: str, want_payload: bool, types: list[str] | None = None):
        self.path, self.want_payload = path, want_payload
        self.tests = [("In", "warc-type", types)] if types else []

    def _pushed(self, filters):
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in HEADERS and column not in NUMBERS and isinstance(f, EqualTo | EqualNullSafe | In | IsNotNull | StringStartsWith | StringEndsWith | StringContains):
                self.tests.append((type(f).__name__, HEADERS[column].lower(), getattr(f, "value", None)))
            else:
                yield f

    def passes(self, headers: dict[str, str]) -> bool:
        for kind, name, value in self.tests:
            have = headers.get(name)
            ok = {
                "EqualTo": lambda: have is not None and have == value,
                "EqualNullSafe": lambda: have == value,
                "In": lambda: have is not None and have in value,
                "IsNotNull": lambda: have is not None,
                "StringStartsWith": lambda: have is not None and have.startswith(value),
                "StringEndsWith": lambda: have is not None and have.endswith(value),
                "StringContains": lambda: have is not None and value in have,
            }[kind]()  # noqa: B023
            if not ok:
                return False
        return True

    def partitions(self):
        """What the writer's list names, one partition for every SPLIT_BYTES; without a list, every archive below the folder."""
        from pyarrow import fs as pafs

        fs, root = file_system(self.path)
        if fs.get_file_info(f"{root}/archives.json").type == pafs.FileType.File:
            with fs.open_input_stream(f"{root}/archives.json") as f:
                listed = json.loads(f.read())
            found = [Range(f"{root}/{x['name']}", a, b) for x in listed for a, b in zip(x["cuts"], x["cuts"][1:], strict=False)]
        else:
            info = fs.get_file_info(root)
            files = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(root, recursive=True))
            found = [Range(x.path) for x in sorted(files, key=lambda x: x.path) if x.is_file and x.path.endswith((".warc", ".warc.gz"))]
        return found or [Range("")]

    def _records(self, partition: Range):
        """(headers, the stream at the block) of each record."""
        fs, _ = file_system(self.path)
        with fs.open_input_file(partition.path) as raw:
            f = io.BufferedReader(pa.PythonFile(raw, mode="r") if not hasattr(raw, "readinto") else raw, 1 << 18)
            if partition.path.endswith(".gz"):
                f = io.BufferedReader(gzip.GzipFile(fileobj=f), 1 << 18)
            elif partition.start:
                f.seek(partition.start)
            while (partition.end is None or f.tell() < partition.end) and (headers := read_headers(f)) is not None:
                yield headers, f

    def read(self, partition):
        if not partition.path:
            return
        rows, held = [], 0
        for headers, f in self._records(partition):
            length = int(headers["content-length"])
            kind, payload = headers.get("warc-type"), None
            passed = self.passes(headers)
            if passed and self.want_payload and kind in ("response", "resource", "conversion"):
                block = f.read(length)
                if len(block) < length:
                    raise CorruptArchive(f"{partition.path}: a block ends early")
                http = kind == "response" and headers.get("content-type", "application/http").startswith("application/http")
                payload = http_payload(block) if http else block
                f.seek(4, io.SEEK_CUR)
            else:
                f.seek(length + 4, io.SEEK_CUR)
            if not passed:
                continue
            values = [headers.get(h.lower()) for h in HEADERS.values()]
            rows.append((*(int(v) if v and c in NUMBERS else v for c, v in zip(HEADERS, values, strict=True)), payload))
            held += len(payload or b"")
            if len(rows) >= 1000 or held >= BATCH_BYTES:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)


class WarcReader(WarcScan):
    def pushFilters(self, filters):
        """Takes predicates on text headers; the rest go back to Spark."""
        yield from self._pushed(filters)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [*(pa.int64() if c in NUMBERS else pa.string() for c in HEADERS), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [*HEADERS, "payload"])


class WarcSource(DataSource):
    """Options: ``path``, a folder or a file; ``payload``, whether payloads are decoded (``true`` unless given); ``types``,
    the record types to read, comma-joined (any unless given); ``pushdown``, whether Spark's own filters are taken too
    (``false`` unless given), which the session has to allow by ``spark.sql.python.filterPushdown.enabled``.
    """

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        kind = WarcReader if self.options.get("pushdown", "false") == "true" else WarcScan
        types = [x for x in self.options.get("types", "").split(",") if x]
        return kind(self.options["path"], self.options.get("payload", "true") == "true", types)


def read_warc(spark: SparkSession, url: str, payload: bool = True, types: list[str] | None = None) -> DataFrame:
    """Records below ``url``, one row each, in the columns of HEADERS and ``payload``.

    A header that a record lacks is null; ``payload`` is null for revisits and where none is wanted. Filters on text
    columns go into the reader where the session allows it (``spark.sql.python.filterPushdown.enabled``); ``types``
    always do. Records that repeat an id are rows each. A folder without archives gives an empty result.
    """
    spark.dataSource.register(WarcSource)
    allowed = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return spark.read.format(FORMAT).option("payload", str(payload).lower()).option("types", ",".join(types or [])).option("pushdown", allowed).load(url)


def response_id(page: int, digest: str) -> str:
    """The record id of the one response that revisits of a payload name."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{digest}')}>"


def write_warc(spark: SparkSession, pages: DataFrame, url: str, id_col: str = "page_id", html_col: str = "html", url_col: str = "url", min_bytes: int = MIN_DEDUP_BYTES) -> None:
    """One record per row of ``pages``, in archives under ``url``, which a list (``archives.json``) names last.

    Rows with the smallest id of those with equal payloads (``min_bytes`` at least) are responses, also where that id
    repeats; others are revisits that name it. Every record has an id of its own; revisits name the record of their
    response (WARC-Refers-To) unless it is one of several with the same page id. A null payload counts as empty, a null id
    never wins over another (a group of null ids only is all responses), a null url leaves out the header; an empty table
    gives an empty list. Other columns are not read. Tasks write under names of their attempts, so a lost executor's files
    are not listed.
    """
    body = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), body.alias("body"))
    rows = rows.withColumn("digest", F.sha2("body", 256))
    counts = rows.where(F.length("body") >= min_bytes).groupBy("digest", "id").agg(F.count("*").alias("n"))
    winner = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("w")
    repeated = counts.groupBy("digest").agg(winner, F.sum("n").alias("n")).where("n > 1")
    repeated = staged(spark, repeated.select("digest", F.col("w.id").alias("first"), (F.col("w.n") == 1).alias("single")), "digests")
    few = repeated.count() <= MAX_BROADCAST_DIGESTS
    joined = rows.join(F.broadcast(repeated) if few else repeated, "digest", "left")
    revisit = F.coalesce(~F.col("id").eqNullSafe(F.col("first")), F.lit(False)) & F.col("first").isNotNull()
    plan = joined.select("id", "url", "digest", F.length("body").cast("long").alias("size"), F.when(revisit, F.col("first")).alias("first"), F.coalesce("single", F.lit(False)).alias("single"), F.when(~revisit, F.col("body")).alias("body"))

    def run(batches):
        fs, root = file_system(url)
        fs.create_dir(root, recursive=True)
        own = uuid.uuid4()
        name, cuts, offset = f"{own.hex}.warc", [0], 0
        with fs.open_output_stream(f"{root}/{name}") as out:
            for batch in batches:
                for key, target, digest, size, first, single, payload in zip(*batch.columns, strict=True):
                    key, digest, first, single = key.as_py(), digest.as_py(), first.as_py(), single.as_py()
                    same = first is not None
                    head = {
                        "WARC-Type": "revisit" if same else "response", "WARC-Date": DATE, "WARC-Target-URI": target.as_py(),
                        "WARC-Record-ID": response_id(key, digest) if single and not same else f"<urn:uuid:{uuid.uuid5(own, str(offset))}>",
                        "WARC-Payload-Digest": f"sha256:{digest}", "X-Payload-Length": size.as_py(), "X-Page-ID": key,
                    }
                    if same:
                        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": response_id(first, digest) if single else None, "X-Refers-To-Page-ID": first}
                    data = record(head | {"Content-Type": "application/http; msgtype=response"}, b"" if same else http_block(payload.as_py()))
                    if offset - cuts[-1] >= SPLIT_BYTES:
                        cuts.append(offset)
                    out.write(data)
                    offset += len(data)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([[*cuts, offset]])], ["name", "cuts"])

    done = plan.mapInArrow(run, "name string, cuts array<long>").collect()
    fs, root = file_system(url)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/archives.json") as out:
        out.write(json.dumps([{"name": r["name"], "cuts": r["cuts"]} for r in sorted(done) if r["cuts"][-1]]).encode())


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, written and read back: of responses the stored payload is decoded, measured and hashed; a
    revisit, which has none, gives the length and digest that its headers have. Odd rows and empty tables: see ``write_warc``.
    """
    url = shared_path(spark, "warc")
    write_warc(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"), url)
    stored = F.col("record_type") == "response"
    return read_warc(spark, url).select(
        "page_id", F.when(stored, F.length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(stored, F.sha2("payload", 256)).otherwise(F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        "record_type", F.col("refers_to_page").alias("refers_to"),
    )


OP9_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), d AS (
  SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha256(body) AS payload_digest FROM p
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""
