"""Exact substring deduplication by suffix arrays of shards.

Every byte covered by a ``length``-byte string that also starts elsewhere is removed; repeats of a shorter length
(``also``) are reported beside. Each start of a string of the shorter length has an anchor, the place of the smallest
hash in the window after it, which depends on the string alone; so equal strings have equal anchors, and starts that
share an anchor form one context. Contexts whose anchors' keys occur once cannot repeat. Contexts that are equal as a
whole are settled by count. What is left goes to shards by anchor key: each shard sorts its suffixes by Larsson-Sadakane
refinement in numpy and takes common prefixes by Kasai's walk. Keys with many contexts have several shards; each sends
one row for every distinct string of its own, and strings of two shards are found by binary search among all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import remove, with_end, written_by_workers

LENGTH = 400
#: The shorter length; a passage of over 50 words is rarely shorter.
ALSO = 250
#: Bytes after an anchor that its key is made of, at most half the shorter length.
KEY_BYTES = 64
#: Contexts of one key in a shard, about, and bytes of contexts sorted at once.
SHARD_CONTEXTS = 2000
CHUNK_BYTES = 1 << 20
#: Tables up to this size, by their rows and the values in them, are broadcast to the texts; more are joined by shuffle.
MAX_BROADCAST_BYTES = 96 << 20
_PLACE = 20  # bits of a place in a text; longer texts are cut into overlapping parts
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _words(buffer) -> np.ndarray:
    """The 8 bytes at every place as a little-endian number."""
    data = np.frombuffer(buffer, np.uint8)
    return np.ndarray(len(data) - 7, "<u8", data, 0, (1,)).copy()


def contexts(text: bytes, length: int = ALSO) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first start, end of starts, anchor key) of each context of a text's ``length``-byte strings."""
    cut = (1 << _PLACE) - length
    if len(text) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(text) > cut + length:
        parts = [(a, contexts(text[a : a + cut + length - 1], length)) for a in range(0, len(text) - length + 1, cut)]
        return tuple(np.concatenate([x[i] + (np.int64(a) if i < 2 else np.uint64(0)) for a, x in parts]) for i in range(3))
    half = min(KEY_BYTES, length // 2)
    span = length - half + 1  # places an anchor may take after a start, so that its key is inside the string
    words = _words(text)
    hashed = words * _M1
    hashed ^= hashed >> np.uint64(32)
    hashed *= _M2
    starts = len(text) - length + 1
    places = starts + span - 1
    low = np.uint64((1 << _PLACE) - 1)
    key = (hashed[:places] & ~low) | np.arange(places, dtype=np.uint64)
    rows = np.r_[key, np.full(-places % span, 2**64 - 1, np.uint64)].reshape(-1, span)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    anchor = (np.minimum(behind[:starts], ahead[span - 1 : span - 1 + starts]) & low).astype(np.int64)
    first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    at = anchor[first]
    keys = np.zeros(len(at), np.uint64)
    for j in [*range(0, half - 8, 8), half - 8]:
        keys = (keys ^ words[at + j]) * _M1
        keys ^= keys >> np.uint64(29)
    return first, np.r_[first[1:], starts], keys


def _refined(rank: np.ndarray, at: np.ndarray, steps: list[int]) -> np.ndarray:
    """Ranks by more bytes: groups of equal rank are sorted by the ranks ``steps`` places on; others stay."""
    own = rank[at]
    counts = np.bincount(own)
    start = np.cumsum(counts) - counts
    out = start[own]
    many = np.flatnonzero(counts[own] > 1)
    bits = np.uint64(64 // (1 + len(steps)))
    key = own[many].astype(np.uint64)
    for step in steps:
        key = key << bits | rank[at[many] + step].astype(np.uint64)
    order = np.argsort(key)
    key = key[order]
    new = np.r_[True, key[1:] != key[:-1]]
    group = key >> bits * np.uint64(len(steps))
    head = np.r_[True, group[1:] != group[:-1]]
    place = np.arange(len(order))
    inside = np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(head, place, 0))
    out[many[order]] += inside
    return out


def suffix_order(text: np.ndarray, words: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank) of the suffixes at ``at`` by their first ``length`` bytes.

    Larsson-Sadakane refinement from 8 bytes on: a depth is two of the depth before, or three where three ranks fit in
    a key of 64 bits. Each depth ranks only those places that the next depth looks at.
    """
    parts = 3 if len(text) < 1 << 21 else 2
    depths = [length]
    while depths[-1] > 8:
        depths.append(max(8, -(-depths[-1] // parts)))
    depths = depths[::-1]
    steps = [[min(shallow * i, deep - shallow) for i in range(1, parts)] for shallow, deep in zip(depths, depths[1:], strict=False)]
    needed = [at]
    for ahead in steps[::-1]:
        mask = np.zeros(len(text), bool)
        mask[needed[-1]] = True
        for step in ahead:
            mask[needed[-1] + step] = True
        needed.append(np.flatnonzero(mask))
    needed = needed[::-1]
    rank = np.zeros(len(text), np.int64)
    rank[needed[0]] = np.unique(words[needed[0]].byteswap(), return_inverse=True)[1]
    for ahead, places in zip(steps, needed[1:], strict=True):
        rank[places] = _refined(rank, places, ahead)
    return np.argsort(rank[at], kind="stable"), rank[at]


def common_prefixes(words: np.ndarray, order: np.ndarray, at: np.ndarray, first: np.ndarray, count: np.ndarray, length: int) -> np.ndarray:
    """Bytes (``length`` at most) that each suffix of ``order`` shares with the one before it: Kasai's walk.

    Contexts walk in step, each over its own suffixes (``count`` from number ``first`` on). A suffix starts from its
    predecessor's prefix less one where the predecessor's neighbour goes on inside its context too.
    """
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    out = np.zeros(len(order), np.int64)
    known = np.zeros(len(first), np.int64)
    partner = np.full(len(first), -1)
    last = np.zeros(len(at), bool)
    last[first + count - 1] = True
    for step in range(int(count.max()) if len(count) else 0):
        live = np.flatnonzero(count > step)
        me = first[live] + step
        has = place[me] > 0
        live, me = live[has], me[has]
        other = order[place[me] - 1]
        before = partner[live]
        same = (before >= 0) & (other == before + 1) & ~last[before]
        carry = same | ((before >= 0) & ~last[before] & (known[live] < length))
        shared = np.where(carry, np.maximum(known[live] - 1, 0), 0)
        todo = np.flatnonzero(shared < length)
        while len(todo):
            x = np.minimum(shared[todo], length - 8)
            differ = words[at[me[todo]] + x] ^ words[at[other[todo]] + x]
            equal = differ == 0
            bit = np.where(equal, np.uint64(1), differ & (~differ + np.uint64(1)))
            shared[todo] = np.where(equal, x + 8, np.maximum(shared[todo], x + (np.log2(bit.astype(np.float64)).astype(np.int64) >> 3)))
            todo = todo[equal & (shared[todo] < length)]
        partner[:] = -1
        known[live], partner[live] = shared, other
        out[place[me]] = shared
    return out


def repeated_starts(texts: list[bytes], count: np.ndarray, lengths: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(context number, start, a (place, group) pair for each length) of the first ``count`` suffixes of these contexts.

    A pair lists the suffixes that have so many bytes, in suffix order, and numbers the groups of equal strings. All
    suffixes have the first, shorter length.
    """
    sizes = np.array([len(t) for t in texts])
    text = np.frombuffer(b"".join(texts) + bytes(lengths[-1] + 8), np.uint8)
    words = _words(text)
    base = np.cumsum(sizes) - sizes
    first = np.cumsum(count) - count
    number = np.repeat(np.arange(len(texts)), count)
    start = np.arange(len(number)) - first[number]
    order, _ = suffix_order(text, words, base[number] + start, lengths[-1])
    prefix = common_prefixes(words, order, base[number] + start, first, count, lengths[-1])
    out = []
    for length in lengths:
        whole = np.flatnonzero(sizes[number[order]] - start[order] >= length)  # others run on into the next context
        shared = np.minimum.reduceat(prefix[: whole[-1] + 1], np.r_[0, whole[:-1] + 1]) if len(whole) else np.zeros(0, np.int64)
        shared[:1] = 0
        out.append((order[whole], np.cumsum(shared < length)))
    return number, start, out


def _runs(flags: np.ndarray, number: np.ndarray) -> np.ndarray:
    """(from, to) of runs of set flags that stay in one context."""
    edge = np.r_[True, number[1:] != number[:-1]]
    set_ = np.flatnonzero(flags)
    if not len(set_):
        return np.zeros((0, 2), np.int64)
    new = np.r_[True, (np.diff(set_) > 1) | edge[set_[1:]]]
    return np.c_[set_[new], set_[np.r_[new[1:], True]] + 1]


FOUND = {"tid": pa.binary(), "start": pa.int64(), "end": pa.int64(), "level": pa.int32(), "d1": pa.int64(), "d2": pa.int64(), "owner": pa.binary()}
#: Level of rows that say of a text that another one has a string of the shorter length of it; 0 and 1 are the lengths.
ELSEWHERE = 2


def _shards(lengths: tuple[int, int], chunk: int):
    """Sorted stream of (akey, block, split, tid, first, count, ctx) -> runs of repeated starts, and strings to merge.

    A shard of a split key sends each distinct string once, under its digest: with its place where the shard has it
    only once, else without one, as its places are already known to repeat; and with its text where only one has it.
    """

    def batch(tid, start, end, level, d1=None, d2=None, owner=None):
        none = [None] * len(start)
        columns = (tid, start, end, [level] * len(start), *(none if c is None else c for c in (d1, d2, owner)))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, FOUND.values(), strict=True)], list(FOUND))

    def solve(rows: list[tuple]):
        number, start, found = repeated_starts([r[6] for r in rows], np.array([r[5] for r in rows], np.int64), lengths)
        where, split = np.array([r[4] for r in rows]), np.array([r[2] for r in rows])
        names: dict[bytes, int] = {}
        text = np.array([names.setdefault(r[3], len(names)) for r in rows])
        for level, (place, group) in enumerate(found):
            size = np.bincount(group, minlength=1)
            repeats = np.zeros(len(number), bool)
            repeats[place[size[group] > 1]] = True
            runs = _runs(repeats, number)
            at = number[runs[:, 0]]
            yield batch([rows[n][3] for n in at], where[at] + start[runs[:, 0]], where[at] + start[runs[:, 1] - 1] + 1, level)
            new = np.r_[True, group[1:] != group[:-1]] if len(group) else np.zeros(0, bool)
            own = text[number[place]]
            heads = np.flatnonzero(new)
            several = np.minimum.reduceat(own, heads) != np.maximum.reduceat(own, heads) if len(heads) else new
            if level == 0:
                shared = np.unique(own[several[np.cumsum(new) - 1]])
                tids = list(names)
                yield batch([tids[t] for t in shared], np.zeros(len(shared), np.int64), np.ones(len(shared), np.int64), ELSEWHERE)
            chosen = np.flatnonzero(split[number[place[heads]]])
            open_, many = place[heads[chosen]], several[chosen]
            alone = ~repeats
            for a in range(0, len(open_), 50_000):
                part = open_[a : a + 50_000]
                digests = [xxhash.xxh3_128_digest(rows[number[i]][6][start[i] : start[i] + lengths[level]], level) for i in part]
                both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                at = where[number[part]] + start[part]
                owner = [None if m else rows[number[i]][3] for i, m in zip(part, many[a : a + 50_000], strict=True)]
                yield batch([rows[number[i]][3] if alone[i] else None for i in part], at, at + 1, level, both[:, 0], both[:, 1], owner)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and size >= chunk and row[:2] != held[-1][:2]:
                    yield from solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[6])
        if held:
            yield from solve(held)

    return run


def _merged(batches):
    """Stream sorted by digest, a row for each shard that has the string -> places of strings that two shards have."""
    held = None
    for batch in with_end(batches):
        if batch is not None:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if not held.num_rows:
                continue
        if held is None or not held.num_rows:
            return
        d1, d2 = (held.column(c).to_numpy() for c in ("d1", "d2"))
        run = np.r_[0, np.cumsum((d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1]))]
        end = len(run) if batch is None else int(np.searchsorted(run, run[-1]))
        if end:
            run = run[:end]
            shards = np.searchsorted(run, run, "right") - np.searchsorted(run, run, "left")
            here = held.slice(0, end).combine_chunks()
            places = here.filter(pa.array(shards > 1)).filter(pc.field("tid").is_valid()).select(["tid", "start", "end", "level"])
            yield from places.combine_chunks().to_batches()
            code = here.column("owner").combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            heads = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
            several = np.minimum.reduceat(code, heads) != np.maximum.reduceat(code, heads)
            told = here.filter(pa.array(np.repeat(several, np.diff(np.r_[heads, end])))).filter(pc.field("owner").is_valid() & (pc.field("level") == 0))
            tids = told.column("owner").combine_chunks().unique()
            if len(tids):
                k = len(tids)
                yield pa.RecordBatch.from_arrays([tids, pa.array(np.zeros(k, np.int64)), pa.array(np.ones(k, np.int64)), pa.array(np.full(k, ELSEWHERE, np.int32))], ["tid", "start", "end", "level"])
            held = held.slice(end).combine_chunks()


def _union(runs: list[tuple[int, int]], reach: int = 0) -> list[int]:
    """Flat sorted bounds of the union of runs, ends moved on by ``reach``."""
    bounds: list[int] = []
    for a, b in sorted(runs):
        if bounds and a <= bounds[-1]:
            bounds[-1] = max(bounds[-1], b + reach)
        else:
            bounds += [a, b + reach]
    return bounds


def _cover(batches):
    """(tid, runs of starts) -> (tid, bounds of the union of starts at either length, whether another text has a string)."""
    for batch in batches:
        runs = batch.column(1)
        size, flat = pc.list_value_length(runs).to_numpy(zero_copy_only=False), runs.flatten()
        row = np.repeat(np.arange(len(size)), size)
        start, end, level = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("start", "end", "level"))
        out = []
        for n in (0, 1):
            mine = np.flatnonzero(level == n)
            mine = mine[np.lexsort((start[mine], row[mine]))]
            r, a, b = row[mine], start[mine], end[mine]
            base = r * (np.int64(1) << 40)  # beyond any text, so runs of two rows never touch
            far = np.maximum.accumulate(base + b) if len(mine) else b
            new = np.r_[True, (base + a)[1:] > far[:-1]] if len(mine) else np.zeros(0, bool)
            last = np.r_[new[1:], True] if len(mine) else new
            bounds = np.c_[a[new], (far - base)[last]].ravel()
            cuts = np.r_[0, np.cumsum(2 * np.bincount(r[new], minlength=len(size)))]
            out.append(pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(bounds)))
        elsewhere = np.bincount(row[level == ELSEWHERE], minlength=len(size)) > 0
        yield pa.RecordBatch.from_arrays([batch.column(0), *out, pa.array(elsewhere)], ["tid", "short", "long", "elsewhere"])


def _hinted(small: DataFrame, size: Column) -> DataFrame:
    """``small`` with a broadcast hint where its rows, of ``size`` bytes each, are few enough."""
    total = small.agg(F.sum(size.cast("long"))).first()[0] or 0
    return F.broadcast(small) if total <= MAX_BROADCAST_BYTES else small


def remove_repeats(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
    also: int = ALSO, shard_contexts: int = SHARD_CONTEXTS, chunk: int = CHUNK_BYTES,
) -> DataFrame:
    """``id_col, n_bytes, spans, repeats, elsewhere, kept`` for every row of ``docs``.

    ``spans`` are the removed (start, end) byte runs, ``kept`` the rest; ``repeats`` the runs covered by strings of
    ``also`` bytes (16 to ``length``) that start elsewhere too; ``elsewhere`` whether another row has one of these. Texts are taken as UTF-8 bytes; a null text is empty.
    Rows that repeat a text of so many bytes lose all of it, whatever their ids (also null ones); of such rows one (the
    smallest id) stands for all in the search. An empty table gives an empty result. Other columns are not read.
    """
    also = min(also, length)
    body = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), body.alias("body"))
    rows = rows.withColumn("tid", F.unhex(F.md5("body")))
    copies = rows.select("tid", "id").groupBy("tid").agg(F.count("*").alias("n"), F.min("id").alias("rep")).where("n > 1")
    copies, _ = written_by_workers(spark, copies, "copies")
    marked = rows.join(_hinted(copies, F.lit(64)), "tid", "left")
    # Of copies, the one that searches; rows that repeat both text and id search together.
    searching = marked.where((F.length("body") >= also) & (F.col("n").isNull() | F.col("id").eqNullSafe(F.col("rep"))))

    def anchored(batches):
        names = ["akey", "whole", "tid", "first", "count", "deep", "n"]

        def flush(held):
            counts = [len(h[0]) for h in held]
            owner = pa.array(np.repeat(np.arange(len(held)), counts))
            columns = [np.concatenate([h[i] for h in held]) for i in range(5)]
            tids, copies = pa.array([h[5] for h in held], pa.binary()).take(owner), pa.array([h[6] for h in held], pa.int64()).take(owner)
            return pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(columns[1]), tids, *(pa.array(c) for c in columns[2:]), copies], names)

        held, size = [], 0
        for batch in batches:
            for tid, text, n in zip(*batch.columns, strict=True):
                text = text.as_py()
                first, end, keys = contexts(text, also)
                view = memoryview(text)
                whole = np.fromiter((xxhash.xxh3_64_intdigest(view[a : b + length - 1], b - a) for a, b in zip(first.tolist(), end.tolist(), strict=True)), np.uint64, len(first))
                deep = np.clip(np.minimum(end, len(text) - length + 1) - first, 0, None)
                held.append((keys.view(np.int64), whole.view(np.int64), first, (end - first).astype(np.int32), deep.astype(np.int32), tid.as_py(), n.as_py() or 1))
                size += len(first)
                if size >= 20_000:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    anchors = "akey long, whole long, tid binary, first long, count int, deep int, n long"
    found, found_at = written_by_workers(spark, searching.select("tid", "body", "n"), "anchors", (anchored, anchors))
    kinds = found.groupBy("akey", "whole").agg(F.sum("n").alias("n"), F.min(F.struct("tid", "first", "count")).alias("one"), F.max("tid").alias("other"))
    kinds = kinds.withColumns({"many": F.col("n") > 1, "shared": F.col("one.tid") != F.col("other")}).drop("other")
    kinds, kinds_at = written_by_workers(spark, kinds, "contexts")
    keys = kinds.groupBy("akey").agg(F.count("*").alias("m")).where("m > 1")
    settled = found.join(kinds.where("many").select("akey", "whole", "shared"), ["akey", "whole"]).select("tid", "first", "count", "deep", "shared")
    settled, settled_at = written_by_workers(spark, settled, "settled")
    remove(spark, found_at)
    blocks = F.ceil(F.col("m") / shard_contexts).cast("long")
    pending = kinds.join(keys, "akey").select("akey", F.pmod("whole", blocks).alias("block"), (blocks > 1).alias("split"), F.col("one.tid").alias("tid"), F.col("one.first").alias("first"), F.col("one.count").alias("count"))
    pending, pending_at = written_by_workers(spark, pending, "pending")
    remove(spark, kinds_at)
    sent = searching.select("tid", "body").join(pending.hint("shuffle_hash"), "tid")
    bytes_ = F.expr(f"substring(body, cast(first + 1 as int), cast(count + {length - 1} as int))")
    sent = sent.select("akey", "block", "split", "tid", "first", F.col("count").cast("long").alias("count"), bytes_.alias("ctx"))
    shards = sent.repartition("akey", "block").sortWithinPartitions("akey", "block")
    kind = "tid binary, start long, end long, level int"
    starts, starts_at = written_by_workers(spark, shards, "starts", (_shards((also, length), chunk), f"{kind}, d1 long, d2 long, owner binary"))
    remove(spark, pending_at)
    open_ = starts.where("d1 is not null").repartition("d1", "d2").sortWithinPartitions("d1", "d2")
    level = lambda n, upto: settled.where(F.col(upto) > 0).select("tid", F.col("first").alias("start"), (F.col("first") + F.col(upto)).alias("end"), F.lit(n).alias("level"))
    every = level(0, "count").unionAll(level(1, "deep")).unionAll(starts.where("d1 is null").select("tid", "start", "end", "level")).unionAll(open_.mapInArrow(_merged, kind))
    zero, one = F.lit(0).cast("long").alias("start"), F.lit(1).cast("long").alias("end")
    every = every.unionAll(settled.where("shared").select("tid", zero, one, F.lit(ELSEWHERE).alias("level")).distinct())
    cover = every.groupBy("tid").agg(F.collect_list(F.struct("start", "end", "level")).alias("runs"))
    cover, _ = written_by_workers(spark, cover, "cover", (_cover, "tid binary, short array<long>, long array<long>, elsewhere boolean"))
    remove(spark, settled_at)
    remove(spark, starts_at)

    joined = marked.join(_hinted(cover, 96 + 8 * (F.size("short") + F.size("long"))), "tid", "left")
    n = F.length("body").cast("long")
    whole = lambda size, bounds: F.when(F.col("n").isNotNull() & (n >= size), F.array(F.lit(0).cast("long"), n - size + 1)).otherwise(F.col(bounds)).alias(bounds)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batches):
        for batch in batches:
            sizes, both, kept = [], ([], []), []
            for text, short, long in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                text = text.as_py()
                for out, bounds, size in zip(both, (long, short), (length, also), strict=True):
                    flat = _union(list(zip((bounds or [])[::2], (bounds or [])[1::2], strict=True)), size - 1)
                    out.append([{"start": a, "end": b} for a, b in zip(flat[::2], flat[1::2], strict=True)])
                at, parts = 0, []
                for s in both[0][-1]:
                    parts.append(text[at : s["start"]])
                    at = s["end"]
                sizes.append(len(text))
                kept.append(b"".join([*parts, text[at:]]))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), *(pa.array(x, span) for x in both), batch.column(4), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "n_bytes", "spans", "repeats", "elsewhere", "kept"])

    spans = "array<struct<start:bigint,end:bigint>>"
    elsewhere = F.coalesce("elsewhere", F.lit(False)) | (F.col("n").isNotNull() & (n >= also))
    made = joined.select("id", "body", whole(also, "short"), whole(length, "long"), elsewhere.alias("elsewhere"))
    kind = docs.schema[id_col].dataType.simpleString()
    return made.mapInArrow(cut, f"{id_col} {kind}, n_bytes long, spans {spans}, repeats {spans}, elsewhere boolean, kept binary")


def covered_bytes(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``remove_repeats`` removes of every document; ``n_repeated`` counts the bytes of its shorter repeats, and
    ``in_others`` says whether any of them is in another document.
    """
    out = remove_repeats(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(
        "doc_id", "n_bytes", covered_bytes(F.col("spans")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"), covered_bytes(F.col("repeats")).alias("n_repeated"), F.col("elsewhere").alias("in_others"),
    )
