"""Personal data: base patterns, and a skip-chain conditional random field that carries their labels across a document.

Nodes are tokens with a digit or an @. Neighbours in the text share chain potentials, and repeated or similar tokens,
however far apart, share skip potentials; both count agreement on an entity only, so two tokens that are nothing say
nothing of each other. A token inside a base span, or assigned to a name such as token or password, is clamped to its
kind. Loopy sum-product passing gives marginals, and tokens of a sure kind become spans beside the base ones. All
weights are fitted together by pseudo-likelihood on tokens of a bounded sample that the base patterns label.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Kinds in the order in which equal starts are listed; label 0 is none. Label 5, a secret, has no base pattern.
KINDS = ("email", "ip", "card", "phone")
SECRET = len(KINDS) + 1
LABELS = SECRET + 1
#: The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DIGIT = re.compile(r"[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
MARK = re.compile(r"[0-9@]")
#: What a secret is assigned to, and the secret: at least 16 characters, some of them digits.
ASSIGNED = re.compile(r"(?i)(?:token|key|secret|password|passwd)\s*[:=]\s*[\"']?([A-Za-z0-9+/_=-]{16,})")
#: Texts that the field is fitted on, at most, and tokens of each, drawn by hash over the whole text.
MAX_TEXTS, MAX_TOKENS = 3000, 200
#: What a kind's probability must be for a token to start a span, and for its neighbours to join it.
SURE, LIKELY = 0.9, 0.5
#: Characters that are not part of a token at its ends.
EDGE = ".,;:!?[]\"'#*$%&|<>"
ROUNDS = 10
#: Tokens are alike where their digits agree in this many last places at least (or letters and digits agree).
SIMILAR_DIGITS = 7
FEATURES = 15


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str):
    """EMAIL's leftmost non-overlapping matches, tried only where an @ follows the local part."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = EMAIL.match(text, start) if start < at else None
        if m:
            yield m.start(), m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, sorted."""
    out = [(a, 1, b) for a, b in _emails(text)]
    if DIGIT.search(text):
        if text.count(".") >= 3:
            out += [(m.start(), 2, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if len(m[0]) >= 12:
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 3, m.end()))
        if "+" in text:
            out += [(m.start(), 4, m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def secret_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, SECRET, end) of assigned secrets outside the base spans, sorted."""
    found = [m.span(1) for m in ASSIGNED.finditer(text) if DIGIT.search(m[1])] if "=" in text or ":" in text else []
    return [(a, SECRET, b) for a, b in found if not any(a < e and b > s for s, _, e in base)]


def unit_ok(kind: int, token: str) -> bool:
    """Whether a token alone is an entity of its kind, as the base pattern's check has it (a phone without its plus)."""
    digits = re.sub(r"[^0-9]", "", token)
    if kind == 3:
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == 4:
        return 7 <= len(digits) <= 15
    pattern = {1: EMAIL, 2: IP}.get(kind)
    return bool(pattern.fullmatch(token)) if pattern else len(token) >= 16


def _features(token: str, before: str) -> list[float]:
    digits = re.sub(r"[^0-9]", "", token)
    core = token.strip(EDGE + "()")
    long = len(core) >= 20 and core.isalnum() and not core.isdigit() and not core.isalpha()
    return [
        1.0, float("@" in core), float("@" in core and "." in core.partition("@")[2]), float(bool(IP.fullmatch(core))), float(core.count(".") == 3),
        float(token.startswith("+")), float(12 <= len(digits) <= 19), float(12 <= len(digits) <= 19 and luhn(digits)), float(core.isdigit()),
        float(5 <= len(digits) <= 11), float(len(digits) < 5), float("-" in core or "(" in token),
        float(long), float(long and re.fullmatch(r"[0-9a-fA-F]+", core) is not None), float(before.rstrip().endswith(("=", ":"))),
    ]


class Graph:
    """A document's nodes: spans, features, clamped labels (0 none, -1 free), chain and skip edges."""

    def __init__(self, text: str, known: list[tuple[int, int, int]]):
        self.spans, self.keys, self.clamped = [], [], []
        k = 0
        for m in WORD.finditer(text):
            if not MARK.search(m[0]):
                continue
            a, b = m.span()
            while k < len(known) and known[k][2] <= a:
                k += 1
            kind = next((n for s, n, e in known[k : k + 8] if s < b and e > a), 0)
            self.spans.append((a, b))
            self.clamped.append(kind or -1)
            self.keys.append(_key(m[0]))
        covered: dict[tuple, int] = defaultdict(int)
        k = 0
        for a, b in self.spans:
            while k < len(known) and known[k][2] <= a:
                k += 1
            for span in known[k : k + 8]:
                covered[span] += span[0] < b and span[2] > a
        self.tokens = len(self.spans)
        for s, kind, e in known:  # a base span is also one node: a later copy may be written together
            if covered[s, kind, e] > 1:
                self.spans.append((s, e))
                self.clamped.append(kind)
                self.keys.append(_key(text[s:e]))
        self.features = np.array([_features(text[a:b], text[max(0, a - 3) : a]) for a, b in self.spans]).reshape(-1, FEATURES)
        self.chain = [(i, i + 1) for i in range(self.tokens - 1) if self.spans[i + 1][0] - self.spans[i][1] == 1]
        groups: dict[str, list[int]] = defaultdict(list)
        for i, keys in enumerate(self.keys):
            for key in keys:
                groups[key].append(i)
        # each group is a path with its first clamped node as a hub, so edges number at most twice the members
        edges = set()
        for members in groups.values():
            hub = next((i for i in members if self.clamped[i] > 0), members[0])
            edges |= {(min(hub, i), max(hub, i)) for i in members if i != hub}
            edges |= set(zip(members, members[1:], strict=False))
        self.skip = sorted(edges)


def _key(token: str) -> list[str]:
    """What a token is compared by: all letters and digits in lower case, and its last digits."""
    plain = re.sub(r"[^0-9a-z@]", "", token.lower())
    digits = re.sub(r"[^0-9]", "", token)
    if "@" in plain:
        return [plain]
    out = [plain] if len(plain) >= 5 else []
    return out + ([f"#{digits[-SIMILAR_DIGITS:]}"] if len(digits) >= SIMILAR_DIGITS else [])


class Field:
    """Weights: unary (features by labels), and what agreement on each label weighs along chain and skip edges (none: 0)."""

    def __init__(self, unary: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.unary, self.chain, self.skip = unary, chain, skip

    def marginals(self, g: Graph, rounds: int = ROUNDS) -> np.ndarray:
        """Marginal label probabilities of each node by loopy sum-product, in log space."""
        n = len(g.spans)
        node = g.features @ self.unary
        for i, kind in enumerate(g.clamped):
            if kind > 0:
                node[i] = -50.0
                node[i, kind] = 0.0
        pairs = [*g.chain, *g.skip]
        if pairs:
            source = np.array([a for a, _ in pairs] + [b for _, b in pairs])
            target = np.array([b for _, b in pairs] + [a for a, _ in pairs])
            gain = np.expm1(np.array(([self.chain] * len(g.chain) + [self.skip] * len(g.skip)) * 2))
            back = np.r_[np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))]
            message = np.zeros((len(source), LABELS))
            for _ in range(rounds):
                total = node.copy()
                np.add.at(total, target, message)
                rest = total[source] - message[back]
                p = np.exp(rest - rest.max(axis=1, keepdims=True))
                # agreeing on a label weighs exp(w), all else 1: the sum over labels plus the gain of the own one
                new = np.log(p.sum(axis=1, keepdims=True) + gain * p)
                message = 0.5 * message + 0.5 * (new - new.max(axis=1, keepdims=True))
            node = node.copy()
            np.add.at(node, target, message)
        p = np.exp(node - node.max(axis=1, keepdims=True)) if n else node
        return p / p.sum(axis=1, keepdims=True) if n else p


def _units(text: str, kind: int, run: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Neighbouring tokens of one kind as spans of one entity each: from the left, the fewest that pass the kind's check."""
    out, i = [], 0
    while i < len(run):
        j = next((j for j in range(i, min(i + 6, len(run))) if unit_ok(kind, text[run[i][0] : run[j][1]])), None)
        if j is not None:
            out.append((run[i][0], kind, run[j][1]))
        i = i + 1 if j is None else j + 1
    return out


def find(text: str | None, field: Field) -> tuple[list, list, list]:
    """(base spans, spans that the field adds, secrets), as (start, kind number, end); secrets overlap no other span."""
    text = text or ""
    if not MARK.search(text):
        return [], [], []
    base = base_spans(text)
    secrets = secret_spans(text, base)
    g = Graph(text, sorted(base + secrets))
    free = [i for i in range(g.tokens) if g.clamped[i] < 0]
    if not free:
        return base, [], secrets
    p = field.marginals(g)
    runs: list[tuple[int, bool, list[tuple[int, int]]]] = []  # kind, whether any token is sure, tokens
    for i in free:
        kind = int(p[i].argmax())
        if not kind or p[i, kind] < LIKELY:
            continue
        a, b = g.spans[i]
        inner = text[a:b]
        a += len(inner) - len(inner.lstrip(EDGE))
        b -= len(inner) - len(inner.rstrip(EDGE))
        sure = bool(p[i, kind] >= SURE)
        if a < b and runs and runs[-1][0] == kind and a - runs[-1][2][-1][1] == 1:
            runs[-1] = (kind, runs[-1][1] or sure, [*runs[-1][2], (a, b)])
        elif a < b:
            runs.append((kind, sure, [(a, b)]))
    added = [s for kind, sure, run in runs if sure for s in _units(text, kind, run)]
    return base, [s for s in added if s[1] < SECRET], sorted(secrets + [s for s in added if s[1] == SECRET])


def fit_weights(x: np.ndarray, y: np.ndarray, chain: np.ndarray, skip: np.ndarray, steps: int = 400) -> Field:
    """Field of the largest pseudo-likelihood with a small ridge, by gradient steps of a fixed number: reruns agree.

    Row by row: features, label, and how many chain and skip neighbours have each label (label 0 counts for nothing).
    """
    u, w = np.zeros((x.shape[1], LABELS)), np.zeros((2, LABELS))
    beside = np.stack([chain, skip]).astype(float)
    beside[:, :, 0] = 0.0
    beside = np.minimum(beside, 2.0)  # a hub's many neighbours repeat each other
    hot = np.eye(LABELS)[y]
    for _ in range(steps):
        z = x @ u + (w[:, None, :] * beside).sum(axis=0)
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        u -= x.T @ (p - hot) / len(x) + 1e-4 * u
        w = np.maximum(0.0, w - (beside * (p - hot)).sum(axis=1) / len(x) - 1e-4 * w)
    return Field(u, *w)


def fit(spark: SparkSession, docs: DataFrame, text_col: str = "text", max_texts: int = MAX_TEXTS, max_tokens: int = MAX_TOKENS) -> Field:
    """Field from ``max_texts`` distinct texts at most that hold digits or an @, in order of their hashes.

    Graphs are built of whole texts; of a text with more than ``max_tokens`` tokens as many are drawn by hash, so that
    long ones carry no more than their share. Repeated texts count once, null and empty ones not at all; without any
    text all weights are zero and nothing is added.
    """
    rows = docs.select(F.col(text_col).cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))
    hashed = rows.select(F.xxhash64("text").alias("h"), "text")
    last = hashed.select("h").distinct().orderBy("h").limit(max_texts).agg(F.max("h")).first()[0]  # texts stay where they are

    def labelled(batches):
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text)
                g = Graph(text, sorted(base + secret_spans(text, base)))
                own = np.maximum(np.array(g.clamped, np.int64), 0)
                near = np.zeros((2, len(own), LABELS), np.int64)
                for kind, edges in enumerate((g.chain, g.skip)):
                    for a, b in edges:
                        near[kind, a, own[b]] += 1
                        near[kind, b, own[a]] += 1
                drawn = sorted(range(len(own)), key=lambda i: (zlib.crc32(f"{g.spans[i]}".encode()), i))[:max_tokens]
                out.append({"x": g.features[drawn].ravel().tolist(), "y": own[drawn].tolist(), "chain": near[0, drawn].ravel().tolist(), "skip": near[1, drawn].ravel().tolist()})
            kind = pa.struct([("x", pa.list_(pa.float64())), *((n, pa.list_(pa.int32())) for n in ("y", "chain", "skip"))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["h", "g"])

    chosen = hashed.where(F.col("h") <= F.lit(last)) if last is not None else hashed.limit(0)
    made = chosen.mapInArrow(labelled, "h long, g struct<x:array<double>,y:array<int>,chain:array<int>,skip:array<int>>")
    got = made.groupBy("h").agg(F.first("g").alias("g")).collect()
    got = [r["g"] for r in sorted(got, key=lambda r: r["h"])]
    flat = lambda name, width, kind: np.array([v for g in got for v in g[name]], kind).reshape(-1, width)
    x = flat("x", FEATURES, float)
    if not len(x):
        return Field(np.zeros((FEATURES, LABELS)), np.zeros(LABELS), np.zeros(LABELS))
    # Labels follow from a token's own looks, which a repeat need not share: each row counts again with its looks hidden.
    hidden = x * (np.arange(FEATURES) == 0)
    twice = lambda v: np.concatenate([v, v])
    return fit_weights(np.concatenate([x, hidden]), twice(flat("y", 1, int)[:, 0]), twice(flat("chain", LABELS, int)), twice(flat("skip", LABELS, int)))


def find_pii(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, base, added, secrets`` for every row: lists of (start, end, kind), sorted by start and kind.

    Offsets are code points, ends exclusive. Null and empty texts have no spans; rows that repeat an id or a text are
    answered each; equal starts are in the order of KINDS; an empty table gives an empty result. Other columns are
    not read.
    """
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
    names = [None, *KINDS, "secret"]
    columns = ["base", "added", "secrets"]

    def run(batches):
        for batch in batches:
            found = [find(t.as_py(), field) for t in batch.column(1)]
            lists = [[[{"start": a, "end": b, "kind": names[k]} for a, k, b in sides[i]] for sides in found] for i in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, span) for x in lists)], [id_col, *columns])

    kind = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("kind", T.StringType())]))
    return rows.mapInArrow(run, T.StructType([rows.schema[0], *(T.StructField(c, kind) for c in columns)]))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every document; ``n_found`` counts all of them and the secrets. Odd rows and empty tables: see ``find_pii``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find_pii(docs, fit(spark, docs))
    said = "array_join(transform({}, s -> concat(s.kind, ':', cast(s.start as string), ':', cast(s.end as string))), ',')"
    place = "case {}.kind when 'email' then 1 when 'ip' then 2 when 'card' then 3 else 4 end"
    order = f"a.start < b.start or a.start = b.start and {place.format('a')} < {place.format('b')}"
    by_start = f"array_sort(concat(base, added), (a, b) -> case when {order} then -1 else 1 end)"
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(F.expr(said.format("base")).cast("binary"), 256).alias("base_sha256"), F.expr(said.format(by_start)).alias("spans"),
        F.expr(said.format("secrets")).alias("secrets"), F.expr("cast(size(base) + size(added) + size(secrets) as long)").alias("n_found"),
    )
