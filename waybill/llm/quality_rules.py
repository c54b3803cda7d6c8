"""Quality rules: counts per document, and an isolation forest over their statistics.

Trees split a random feature at a random value; odd documents are isolated on short paths. A feature is drawn the more
often the better it tells the labelled classes apart (the squared greatest distance of their distributions), and never
left out. As the method has it, a tree grows on a few hundred rows, drawn from all labelled rows; the features' weights
and the score's threshold, which weighs bad labelled rows caught against a bounded share of good ones lost, come from all.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import remove, staged, written

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
TREES = 100
#: Rows that one tree grows on.
TREE_ROWS = 256
#: Share of good labelled rows that the threshold may reject, and what a share lost costs against bad rows caught.
MAX_GOOD_LOSS = 0.01
LOSS_COST = 10.0
SEED = 7
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: The forest's statistics: every count of the rules, made independent of length, and the length itself.
FEATURES = ["symbol_share", "word_length", "dup_line_share", "repeat_share", "log_words", "distinct_share"]
#: What a feature that tells nothing weighs when features are drawn.
LEAST_WEIGHT = 0.001


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """(the five counts, the forest's features) of a text; a null text is empty."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    lines = [x for x in raw.split(b"\n") if x.strip(b" \t\n\r\v\f")]
    n_dup = len(lines) - len(set(lines))
    continuation = sum(raw.count(bytes([c])) for c in range(0x80, 0xC0)) if not raw.isascii() else 0
    space = sum(raw.count(c) for c in (b" ", b"\t", b"\n", b"\v", b"\f", b"\r"))
    chars = len(raw) - continuation - space
    symbols = sum(raw.count(bytes([c])) for c in SYMBOLS)
    repeated = 0
    if n > WINDOW:
        numbers: dict[bytes, int] = {}
        at = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
        distinct = len(numbers)
        codes = at[: n - WINDOW + 1].copy()
        for k in range(1, WINDOW):
            # pairs (rank so far, next word) keep windows exact: ranks and numbers are below n
            codes = np.unique(codes * np.int64(distinct) + at[k : n - WINDOW + 1 + k], return_inverse=True)[1] if distinct > 1 else codes
        twice = np.bincount(codes)[codes] > 1
        edge = np.zeros(n + 1, np.int64)
        edge[: n - WINDOW + 1] += twice
        edge[WINDOW : n + 1] -= twice
        repeated = int((np.cumsum(edge)[:n] > 0).sum())
    distinct = len(set(words)) / max(1, n)
    features = [symbols / max(1, chars), min(chars / max(1, n), 40.0), n_dup / max(1, len(lines)), repeated / max(1, n), math.log1p(n), distinct]
    return [n, chars, symbols, n_dup, repeated], features


class IsolationForest:
    """Trees over ``rows``; ``weights`` are the chances of their columns to be split on (equal ones unless given)."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, sample: int = TREE_ROWS, seed: int = SEED, weights: np.ndarray | None = None):
        rnd = np.random.default_rng(seed)
        size = min(sample, len(rows))
        self._plant((rows[rnd.choice(len(rows), size, replace=False)] for _ in range(trees if len(rows) else 0)), size, rnd, rows.shape[1], weights)

    @classmethod
    def over(cls, drawn: list[np.ndarray], seed: int = SEED, weights: np.ndarray | None = None) -> IsolationForest:
        """One tree over each of ``drawn``, which have equally many rows."""
        made = cls.__new__(cls)
        made._plant(drawn, len(drawn[0]) if drawn else 0, np.random.default_rng(seed), len(FEATURES), weights)
        return made

    def _plant(self, drawn, size: int, rnd, columns: int, weights: np.ndarray | None) -> None:
        self.weights = np.ones(columns) if weights is None else weights
        self.sample = size
        self.depth = max(1, math.ceil(math.log2(max(2, size))))
        self.trees = [self._grow(rows, rnd) for rows in drawn]

    @staticmethod
    def expected(n: int) -> float:
        """Mean path length of an unsuccessful search among n rows."""
        return 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else float(n == 2)

    def _grow(self, rows: np.ndarray, rnd) -> tuple[np.ndarray, ...]:
        feature, cut, left, right, length = [], [], [], [], []

        def node(part: np.ndarray, depth: int) -> int:
            me = len(feature)
            for x, v in ((feature, -1), (cut, 0.0), (left, me), (right, me), (length, depth + self.expected(len(part)))):
                x.append(v)
            spread = np.flatnonzero(part.min(axis=0) < part.max(axis=0)) if len(part) > 1 and depth < self.depth else []
            if len(spread):
                f = int(rnd.choice(spread, p=self.weights[spread] / self.weights[spread].sum()))
                c = float(rnd.uniform(part[:, f].min(), part[:, f].max()))
                below = part[:, f] < c
                if below.any() and not below.all():
                    feature[me], cut[me] = f, c
                    left[me] = node(part[below], depth + 1)
                    right[me] = node(part[~below], depth + 1)
            return me

        node(rows, 0)
        return tuple(np.array(x) for x in (feature, cut, left, right, length))

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly of each row: 2 to the minus mean path length over its expectation; 0.5 without trees."""
        if not self.trees:
            return np.full(len(rows), 0.5)
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, cut, left, right, length in self.trees:
            at = np.zeros(len(rows), np.int64)
            for _ in range(self.depth + 1):
                f = feature[at]
                inner = f >= 0
                below = rows[every, np.maximum(f, 0)] < cut[at]
                at = np.where(inner, np.where(below, left[at], right[at]), at)
            total += length[at]
        return np.exp2(-total / len(self.trees) / max(self.expected(self.sample), 1e-9))


class Rules:
    """A forest and the score above which it rejects."""

    def __init__(self, forest: IsolationForest, threshold: float):
        self.forest, self.threshold = forest, threshold


def base_failed(n_words: int, n_repeat: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words


def separation(values: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Weight of each column: the squared greatest distance between the distributions of good and of bad rows."""
    out = np.full(values.shape[1], 1.0)
    if not good.any() or good.all():
        return out
    for k, column in enumerate(values.T):
        one, two, at = np.sort(column[good]), np.sort(column[~good]), np.unique(column)
        out[k] = np.abs(np.searchsorted(one, at, "right") / len(one) - np.searchsorted(two, at, "right") / len(two)).max() ** 2
    return out + LEAST_WEIGHT


def calibrate(scores: np.ndarray, good: np.ndarray, max_loss: float = MAX_GOOD_LOSS, cost: float = LOSS_COST) -> float:
    """The threshold of most bad rows caught less ``cost`` times the good rows lost, which ``max_loss`` bounds.

    Infinite without good and bad rows.
    """
    if not good.any() or good.all():
        return math.inf
    kept, caught = np.sort(scores[good]), np.sort(scores[~good])
    allowed = math.floor(max_loss * len(kept))
    steps = np.unique(kept[len(kept) - 1 - allowed :])
    recall = 1 - np.searchsorted(caught, steps, "right") / len(caught)
    loss = 1 - np.searchsorted(kept, steps, "right") / len(kept)
    return float(steps[np.argmax(recall - cost * loss)])


def _measured(rows: DataFrame) -> DataFrame:
    """The columns of ``rows`` before ``text``, the five counts, and ``features``."""
    lead = [f for f in rows.schema.fields if f.name != "text"]

    def run(batches):
        for batch in batches:
            found = [statistics(t.as_py()) for t in batch.column(len(lead))]
            counts = np.array([c for c, _ in found], np.int64).reshape(-1, len(COUNTS))
            columns = [pa.array(counts[:, i]) for i in range(len(COUNTS))]
            features = pa.array([f for _, f in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(lead)], *columns, features], [*(f.name for f in lead), *COUNTS, "features"])

    fields = [*lead, *(T.StructField(c, T.LongType()) for c in COUNTS), T.StructField("features", T.ArrayType(T.DoubleType()))]
    return rows.select(*(f.name for f in lead), F.col("text").cast("string").alias("text")).mapInArrow(run, T.StructType(fields))


def _ranked(spark: SparkSession, rows: DataFrame) -> tuple[DataFrame, str]:
    """Of ``rows`` (``k, value, good`` 0 or 1): each value with ``good``, and ``good_to`` and ``bad_to``, the rows of its k up to it.

    Values are dealt by range, counted on from the ranges before theirs, and read from the folder that is named with them.
    """
    counts = rows.groupBy("k", "value").agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad"))
    cut, path = written(spark, counts.repartitionByRange("k", "value").withColumn("part", F.spark_partition_id()), "ranks")
    before = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = cut.groupBy("k", "part").agg(F.sum("good").alias("g"), F.sum("bad").alias("b"))
    parts = parts.select("k", "part", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("g", "b")))
    to = Window.partitionBy("k", "part").orderBy("value")
    ranked = cut.join(F.broadcast(parts), ["k", "part"])
    return ranked.select("k", "value", "good", (F.sum("good").over(to) + F.col("g")).alias("good_to"), (F.sum("bad").over(to) + F.col("b")).alias("bad_to")), path


def _drawn(rows: DataFrame, n: int) -> list[np.ndarray]:
    """TREE_ROWS of the ``n`` ``rows`` (``h, features``) for each tree, those of the least hashes of h and the tree.

    Only rows whose hash is under twice the share that a tree takes come to the driver.
    """
    size = min(TREE_ROWS, n)
    odds = np.random.default_rng(SEED).integers(0, 2**64, TREES, np.uint64)
    bound = np.uint64(min(2**64 - 1, 2 * TREE_ROWS * 2**64 // max(1, n)))

    def run(batches):
        for batch in batches:
            h = batch.column(0).to_numpy().view(np.uint64)
            for tree, odd in enumerate(odds):
                key = h ^ odd
                for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                    key = (key ^ (key >> np.uint64(shift))) * np.uint64(by)
                key ^= key >> np.uint64(31)
                at = np.flatnonzero(key <= bound)
                if len(at):
                    # signed order is that of the unsigned key
                    signed = (key[at] ^ np.uint64(1 << 63)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), tree, np.int32)), pa.array(signed), batch.column(1).take(pa.array(at))], ["tree", "key", "features"])

    found: list[list] = [[] for _ in range(TREES)]
    for r in rows.mapInArrow(run, "tree int, key long, features array<double>").collect():
        found[r["tree"]].append((r["key"], r["features"]))
    if n and min(map(len, found)) < size:
        raise ValueError("too few rows drawn for a tree")
    return [np.array([f for _, f in sorted(x)[:size]], float) for x in found] if n else []


def learn(spark: SparkSession, measured: DataFrame, labels: DataFrame) -> Rules:
    """Rules from all labelled rows of ``measured`` (``doc_id, h``, the counts, ``features``); see ``fit``."""
    known = labels.where("doc_id is not null and good is not null").groupBy("doc_id").agg((F.min("good") != 0).cast("int").alias("good"))
    past = (F.col("n_words") >= MIN_WORDS) & (F.col("n_repeat_words") * 100 <= F.col("n_words") * MAX_REPEAT_PERCENT)
    rows = measured.where(past).select("doc_id", "h", "features").join(known, "doc_id")
    copy = F.row_number().over(Window.partitionBy("h").orderBy("features"))
    rows, path = written(spark, rows.select(F.xxhash64("h", copy).alias("h"), "good", "features"), "labelled")
    n, good = rows.agg(F.count("*"), F.coalesce(F.sum("good"), F.lit(0))).first()
    both = 0 < good < n
    weights = np.full(len(FEATURES), 1.0)
    if both:
        ranked, ranks = _ranked(spark, rows.select("good", F.posexplode("features").alias("k", "value")))
        apart = ranked.groupBy("k").agg(F.max(F.abs(F.col("good_to") / good - F.col("bad_to") / (n - good))).alias("d")).collect()
        weights = np.array([r["d"] for r in sorted(apart, key=lambda r: r["k"])]) ** 2 + LEAST_WEIGHT
        remove(spark, ranks)
    forest = IsolationForest.over(_drawn(rows.select("h", "features"), n), weights=weights)
    threshold = math.inf
    if both:

        def scored(batches):
            for batch in batches:
                scores = forest.score(np.array(batch.column(1).to_pylist(), float).reshape(-1, len(FEATURES)))
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(scores), np.int32)), pa.array(scores), batch.column(0)], ["k", "value", "good"])

        ranked, ranks = _ranked(spark, rows.select("good", "features").mapInArrow(scored, "k int, value double, good int"))
        steps = ranked.where(F.col("good") > 0).where(good - F.col("good_to") <= math.floor(MAX_GOOD_LOSS * good))
        gain = (1 - F.col("bad_to") / (n - good)) - LOSS_COST * (1 - F.col("good_to") / good)
        threshold = steps.orderBy(gain.desc(), "value").first()["value"]
        remove(spark, ranks)
    remove(spark, path)
    return Rules(forest, threshold)


def _named(docs: DataFrame) -> DataFrame:
    return _measured(docs.select("doc_id", F.xxhash64("doc_id", "text").alias("h"), "text"))


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Rules:
    """Rules from ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, good`` 0, 1 or null).

    Learns from every labelled row but base failures: weights as ``separation`` and the threshold as ``calibrate`` give
    them over all of these, and trees whose rows are drawn from all by hash. Null ids and labels teach nothing; an id that
    repeats among the labels counts once, as bad if any row says so; rows that repeat an id or a text are rows each.
    Without labels of both kinds, and with empty tables, nothing is rejected but base failures.
    """
    return learn(spark, _named(docs), labels)


def judge(spark: SparkSession, docs: DataFrame, rules: Rules) -> DataFrame:
    """``doc_id``, the five counts, ``features``, ``anomaly``, ``base_failed`` and ``kept`` for every row.

    Null and empty texts have no words and fail the base rules; rows that repeat an id or a text are judged each, alike;
    an anomaly equal to the threshold is kept; an empty table gives an empty result. Other columns are not read.
    """
    return _verdicts(_measured(docs.select("doc_id", "text")), rules)


def _verdicts(measured: DataFrame, rules: Rules) -> DataFrame:
    schema = T.StructType([*measured.schema.fields, T.StructField("anomaly", T.DoubleType()), T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())])

    def run(batches):
        for batch in batches:
            features = np.array(batch.column(6).values.to_numpy(), float).reshape(-1, len(FEATURES)) if batch.num_rows else np.zeros((0, len(FEATURES)))
            anomaly = rules.forest.score(features)
            failed = np.array([base_failed(*x) for x in zip(batch.column(1).to_pylist(), batch.column(5).to_pylist(), strict=True)], bool)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(anomaly), pa.array(failed), pa.array(~failed & (anomaly <= rules.threshold))], schema.names)

    return measured.mapInArrow(run, schema)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of every document, measured once; odd rows and empty tables: see ``fit`` and ``judge``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("good"))
    measured = staged(spark, _named(docs), "measured")
    return _verdicts(measured.drop("h"), learn(spark, measured, labels)).select("doc_id", *COUNTS, "base_failed", "kept")
