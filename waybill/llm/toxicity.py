"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are lower-case words; every word of every indexed example is one, and no word is left out for being rare or mild.
A term weighs its inverse document frequency over all documents times how surely labelled rows tell the classes apart by
it: the positive part of its smoothed log odds over their standard error, above a floor that every term keeps. Examples
of both classes are kept in an inverted index cut into blocks, each with its largest weight per term; a query opens
blocks by falling upper bound and stops where no block can hold a nearer example, so its neighbours are exact. Votes are
weighted by squared cosine and by the share of its class that an example stands for, drawn towards the base rate by a
prior vote, and calibrated by a logistic curve through the votes that examples get when they are left out.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import staged

WORDS = re.compile(r"[^\W\d_]+")
#: Labelled examples of each class that the index holds at most, and entries (an example's distinct words) of all.
MAX_EXAMPLES, MAX_ENTRIES = 1500, 2_000_000
#: Examples of each class whose votes, themselves left out, the curve is fitted on at most.
MAX_CALIBRATION = 500
#: What a term weighs whose odds are the same in both classes.
FLOOR = 0.05
BLOCK = 8
#: A term that more than one in so many examples has is a column of the index's matrix.
COMMON = 24
#: Documents that are multiplied with it at once.
TOGETHER = 64
NEIGHBOURS = 16
PRIOR_VOTE = 0.02
#: Labels up to this number (16 bytes each) are broadcast to the documents; more are joined by shuffle.
MAX_BROADCAST_LABELS = 2_000_000


def words_of(text: str | None) -> Counter:
    """Counts of a text's words in lower case."""
    return Counter(WORDS.findall((text or "").lower()))


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0] .. start[0] + size[0] - 1, start[1] .. and so on."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


class BlockMaxIndex:
    """Examples (terms and weights of unit length) and exact nearest-neighbour search over them.

    Terms that more than one in ``COMMON`` examples has are columns of a matrix, which many queries are multiplied with
    at once. The others have postings in runs, one for each block that a term occurs in, with the run's largest weight.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int, block: int = BLOCK, common: int = COMMON):
        self.n, self.block, self.blocks = len(vectors), block, -(-len(vectors) // block)
        term = np.concatenate([t for t, _ in vectors] or [np.zeros(0, np.int64)]).astype(np.int64)
        place = np.repeat(np.arange(len(vectors)), [len(t) for t, _ in vectors])
        weight = np.concatenate([w for _, w in vectors] or [np.zeros(0)])
        often = np.bincount(term, minlength=terms) * common > self.n
        self.column = np.where(often, np.cumsum(often) - 1, -1)
        self.matrix = np.zeros((int(often.sum()), self.blocks * block))
        dense = often[term]
        self.matrix[self.column[term[dense]], place[dense]] = weight[dense]
        order = np.lexsort((place, np.where(dense, terms, term)))[: int((~dense).sum())]
        term, self.place, self.weight = term[order], place[order].astype(np.int32), weight[order]
        run = term * max(1, self.blocks) + self.place // block
        self.run_start = np.flatnonzero(np.r_[True, run[1:] != run[:-1]] if len(run) else np.zeros(0, bool))
        self.run_size = np.diff(np.r_[self.run_start, len(run)])
        self.run_block = (self.place[self.run_start] // block).astype(np.int32)
        self.run_most = np.maximum.reduceat(self.weight, self.run_start) if len(run) else np.zeros(0)
        self.first = np.searchsorted(term[self.run_start], np.arange(terms + 1))
        self.visited = 0

    def nearest(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[int] | None = None):
        """For each query (cosines, places) of the k examples of highest positive cosine, ties by place.

        ``without`` names an example that a query leaves out. ``visited`` counts the blocks opened.
        """
        many = np.zeros((len(queries), len(self.matrix)))
        for q, (terms, weights) in enumerate(queries):
            column = self.column[terms]
            many[q, column[column >= 0]] = weights[column >= 0]
        many = many @ self.matrix
        for q, (terms, weights) in enumerate(queries):
            yield self._nearest(many[q], terms, weights, k, -1 if without is None else without[q])

    def _nearest(self, sums: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int, without: int):
        """``sums`` has what common terms give; postings are added block by block, by falling upper bound."""
        start, size = self.first[terms], self.first[terms + 1] - self.first[terms]
        runs, heavy = _spread(start, size), np.repeat(weights, size)
        block = self.run_block[runs]
        bound = sums.reshape(self.blocks, self.block).max(axis=1) + np.bincount(block, heavy * self.run_most[runs], self.blocks)
        queue = np.argsort(-bound, kind="stable")
        queue = queue[bound[queue] > 0]
        best, at, step = np.zeros(0), np.zeros(0, np.int64), max(2, self.blocks // 16)
        while len(queue):
            opened, queue = queue[:step], queue[step:]
            self.visited += len(opened)
            local = np.full(self.blocks, -1)
            local[opened] = np.arange(len(opened))
            mine = local[block] >= 0
            chosen = runs[mine]
            postings = _spread(self.run_start[chosen], self.run_size[chosen])
            place = self.place[postings]
            found = sums.reshape(self.blocks, self.block)[opened].ravel()
            added = np.repeat(heavy[mine], self.run_size[chosen]) * self.weight[postings]
            found += np.bincount(local[place // self.block] * self.block + place % self.block, added, len(found))
            places = (opened[:, None] * self.block + np.arange(self.block)).ravel()
            found[places == without] = 0.0
            least = best[-1] if len(best) == k else float(np.partition(found, -k)[-k]) if len(found) > k else 0.0
            some = np.flatnonzero(found >= least if least > 0 else found > 0)
            best, at = np.r_[best, found[some]], np.r_[at, places[some]]
            order = np.lexsort((at, -best))[:k]
            best, at = best[order], at[order]
            if len(best) == k:  # all blocks that may still hold a nearer example, at once
                queue = queue[bound[queue] >= best[-1] - 1e-9]
                step = len(queue)
        return best, at


class Model:
    """Vocabulary, weights, index, votes and curve. Plain values make one, so it travels to workers as plain values."""

    def __init__(self, known: dict[str, int], scale: np.ndarray, examples: tuple, share: tuple[float, float],
                 base_rate: float, curve=None, k: int = NEIGHBOURS, prior: float = PRIOR_VOTE):
        """``examples``: names, labels, cuts of the terms and counts that follow; ``share``: what a clean and a toxic one stand for."""
        self.made = (known, scale, examples, share, base_rate)
        self.known, self.scale, self.k, self.prior, self.base_rate = known, scale, k, prior, base_rate
        self._index, self.vectors = None, []
        self._build()
        self.curve = curve or self._calibrated()

    def _build(self) -> None:
        names, labels, cuts, terms, counts = self.made[2]
        vectors = [self._unit(terms[a:b], counts[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        heaviest = [int(t[np.argmax(w)]) for t, w in vectors]
        like = sorted(range(len(names)), key=lambda i: (labels[i], heaviest[i], i))  # like examples share blocks
        self.vectors = [vectors[i] for i in like]
        self.names, self.labels = [names[i] for i in like], np.array([labels[i] for i in like], np.int64)
        self.votes = np.array(self.made[3])[self.labels]
        self._index = BlockMaxIndex(self.vectors, len(self.known))

    def light(self) -> Model:
        """This model without its index, which comes back when it is asked for."""
        self._index, self.vectors = None, []
        return self

    @property
    def index(self) -> BlockMaxIndex:
        if self._index is None:
            self._build()
        return self._index

    def _unit(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(terms)
        raw = (1 + np.log(counts[order])) * self.scale[terms[order]]
        return terms[order], raw / math.sqrt(float((raw * raw).sum()))

    def _votes(self, vectors: list, without: list[int] | None = None):
        for near, at in self.index.nearest(vectors, self.k, without):
            votes = near * near * self.votes[at]
            toxic = float((votes * self.labels[at]).sum())
            yield (toxic + self.prior * self.base_rate) / (float(votes.sum()) + self.prior), near, at

    def _calibrated(self) -> tuple[float, float]:
        """(slope, offset) of the logistic curve from votes to probabilities, by Newton steps on a ridged likelihood."""
        sides = [np.flatnonzero(self.labels == label) for label in (0, 1)]
        chosen = [i for side in sides for i in side[:: -(-len(side) // MAX_CALIBRATION) or 1]]
        if not len(chosen) or self.labels.min() == self.labels.max():
            return 4.0, -2.0
        y = self.labels[chosen].astype(float)
        x = np.array([v for v, _, _ in self._votes([self.vectors[i] for i in chosen], chosen)]) - 0.5
        per = np.array([(self.votes * (self.labels == c)).sum() / (y == c).sum() for c in (0, 1)])[y.astype(int)]
        per = per / per.mean()
        a, b = 4.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-(a * x + b)))
            g = np.array([(per * (p - y) * x).sum() + 1e-2 * a, (per * (p - y)).sum()])
            v = per * np.maximum(p * (1 - p), 1e-9)
            h = np.array([[(v * x * x).sum() + 1e-2, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-9]])
            step = np.clip(np.linalg.solve(h, g), -2, 2)
            a, b = a - float(step[0]), b - float(step[1])
        a = max(a, 0.5)  # a higher vote never lowers a score
        return round(a, 9), round(b - a / 2, 9)

    def scores(self, texts: list[str | None]) -> list[tuple[float, list, list]]:
        """(score, names of the neighbours, their cosines) of each text."""
        if not len(self.names):
            return [(self.base_rate, [], [])] * len(texts)
        number, vectors = self.known.__getitem__, []
        for text in texts:
            words = words_of(text)
            both = words.keys() & self.known.keys()
            terms, counts = (np.fromiter(map(f, both), np.int64, len(both)) for f in (number, words.__getitem__))
            vectors.append(self._unit(terms, counts) if len(both) else None)
        votes = self._votes([v for v in vectors if v is not None])
        out = []
        for vector in vectors:
            vote, near, at = next(votes) if vector is not None else (self.base_rate, np.zeros(0), np.zeros(0, np.int64))
            z = min(max(self.curve[0] * vote + self.curve[1], -500.0), 500.0)
            out.append((round(1 / (1 + math.exp(-z)), 9), [self.names[i] for i in at], near.round(12).tolist()))
        return out


def term_scale(n: np.ndarray, toxic: np.ndarray, clean: np.ndarray, n_docs: int, n_toxic: int, n_clean: int) -> np.ndarray:
    """What each term weighs, from how many documents, toxic rows and clean rows it is in."""
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    sure = odds / np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    return (np.log((1 + n_docs) / (1 + n)) + 1) * (FLOOR + np.maximum(0.0, sure))


def _labelled(docs: DataFrame, labels: DataFrame, how: str) -> DataFrame:
    few = labels.count() <= MAX_BROADCAST_LABELS
    return docs.join(F.broadcast(labels) if few else labels, "doc_id", how)


def _examples(spark: SparkSession, marked: DataFrame, max_examples: int, max_entries: int) -> tuple[list[str], tuple]:
    """(words, the examples: names, labels, cuts, numbers of words, counts).

    Labelled texts with words, each distinct one once, in order of their hashes: ``max_examples`` of a class, less
    where they would have more than ``max_entries`` distinct words, counted text by text.
    """
    texts = marked.where(F.length("text") > 0).withColumn("h", F.xxhash64("text"))
    listed = texts.groupBy("label", "h").agg(F.min("doc_id").alias("name"))
    chosen = listed.where("label = 1").orderBy("h").limit(max_examples).unionAll(listed.where("label <> 1").orderBy("h").limit(max_examples))
    chosen = staged(spark, chosen, "examples")

    def counted(batches):
        for batch in batches:
            found = [words_of(t.as_py()) for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([list(f) for f in found], pa.list_(pa.string())), pa.array([list(f.values()) for f in found], pa.list_(pa.int64()))],
                ["label", "h", "name", "words", "counts"],
            )

    once = texts.select("label", "h", "doc_id", "text").join(F.broadcast(chosen), ["label", "h"])
    once = once.where(F.col("doc_id").eqNullSafe(F.col("name"))).select("label", "h", "name", "text")
    words, numbers = T.ArrayType(T.StringType()), T.ArrayType(T.LongType())
    schema = T.StructType([*(once.schema[c] for c in ("label", "h", "name")), T.StructField("words", words), T.StructField("counts", numbers)])
    made = once.mapInArrow(counted, schema).where(F.size("words") > 0).dropDuplicates(["label", "h"])
    made = staged(spark, made, "example-words")
    sizes = made.select("h", "label", F.size("words").alias("n")).toArrow().sort_by([("h", "ascending"), ("label", "ascending")])
    total = np.cumsum(sizes.column("n").to_numpy())
    if len(total) and total[-1] > max_entries:
        made = made.where(F.col("h") <= sizes.column("h")[max(0, int(np.searchsorted(total, max_entries, "right")) - 1)].as_py())
    table = made.toArrow().sort_by([("h", "ascending"), ("label", "ascending")]).combine_chunks()
    if not table.num_rows:
        return [], ([], np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    words = table.column("words").combine_chunks()
    cuts = np.r_[0, np.cumsum(pc.list_value_length(words).to_numpy())]
    flat = words.flatten().dictionary_encode()
    labels = (table.column("label").to_numpy() == 1).astype(np.int64)
    counts = table.column("counts").combine_chunks().flatten().to_numpy()
    return flat.dictionary.to_pylist(), (table.column("name").to_pylist(), labels, cuts, flat.indices.to_numpy().astype(np.int32), counts.astype(np.int32))


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, max_entries: int = MAX_ENTRIES) -> Model:
    """Model from ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, label`` 0, 1 or null).

    Null ids and labels teach nothing; an id that repeats among the labels counts once, as toxic if any row says so;
    labelled rows of equal texts are one example of a class, under their smallest id, but count one by one in odds,
    frequencies and rates. Texts without words are no examples. Without labelled rows, or with
    empty tables, every score is 0. Only the index is bounded (``max_examples`` of a class, ``max_entries`` words of all examples);
    frequencies cover all rows and odds all labelled ones.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    labels = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    labels = staged(spark, labels, "labels")
    words, examples = _examples(spark, _labelled(docs, labels, "inner"), max_examples, max_entries)
    known = {w: i for i, w in enumerate(words)}
    shared = spark.sparkContext.broadcast(known)

    def count(batches):
        known = shared.value
        tally, rows = np.zeros((len(known), 3), np.int64), np.zeros(3, np.int64)
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                both = known.keys() & set(WORDS.findall((text.as_py() or "").lower()))
                at = np.fromiter(map(known.__getitem__, both), np.int64, len(both))
                sides = [0] if label is None else [0, 1 if label == 1 else 2]
                for side in sides:
                    tally[at, side] += 1
                    rows[side] += 1
        at = np.flatnonzero(tally[:, 0])
        columns = [np.r_[-1, at], *(np.r_[rows[i], tally[at, i]] for i in range(3))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["term", "n", "toxic", "clean"])

    counted = _labelled(docs, labels, "left").select("text", "label").mapInArrow(count, "term long, n long, toxic long, clean long")
    sums = counted.groupBy("term").agg(*(F.sum(c).alias(c) for c in ("n", "toxic", "clean"))).toArrow()
    shared.unpersist()
    table = np.zeros((len(known) + 1, 3))
    for i, c in enumerate(("n", "toxic", "clean")):
        table[sums.column("term").to_numpy() + 1, i] = sums.column(c).to_numpy()
    (n_docs, n_toxic, n_clean), (n, toxic, clean) = table[0], table[1:].T
    if not n_toxic + n_clean:
        return Model({}, np.zeros(0), examples, (1.0, 1.0), 0.0)
    base_rate = float(n_toxic / (n_toxic + n_clean))
    held = np.bincount(examples[1], minlength=2)
    share = [float(m / max(1, h)) for m, h in zip((n_clean, n_toxic), held, strict=True)]
    scale = term_scale(n, toxic, clean, n_docs, n_toxic, n_clean)
    return Model(known, scale, examples, (share[0] / max(share), share[1] / max(share)), base_rate).light()


def score(spark: SparkSession, docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (``doc_id`` unless given) and ``score, neighbours, cosines`` for every row.

    ``neighbours`` are ids of labelled examples and ``cosines`` their nearness, nearest first, equal ones by the order
    of the index; both are empty where no word of an example occurs. Null and empty texts get the score of the base
    rate; rows that repeat an id or a text are scored each, alike; an empty table gives an empty result. Other columns
    are not read.
    """
    keep = keep or ["doc_id"]
    rows = docs.select(*[F.col(c) for c in keep], F.col("text").cast("string").alias("__text"))
    kind = docs.schema["doc_id"].dataType
    fields = [*rows.schema.fields[:-1], T.StructField("score", T.DoubleType()), T.StructField("neighbours", T.ArrayType(kind)), T.StructField("cosines", T.ArrayType(T.DoubleType()))]
    schema = T.StructType(fields)
    listed = to_arrow_type(T.ArrayType(kind))
    shared, curve = spark.sparkContext.broadcast({"made": model.made}), model.curve

    def run(batches):
        held = shared.value  # a worker keeps it from task to task, and so the model
        model = held.get("model") or held.setdefault("model", Model(*held["made"], curve=curve))
        for batch in batches:
            texts = batch.column(len(keep))
            scored = [x for a in range(0, len(texts), TOGETHER) for x in model.scores(texts.slice(a, TOGETHER).to_pylist())]
            names = pa.array([s[1] for s in scored], listed)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array([s[0] for s in scored], pa.float64()), names, pa.array([s[2] for s in scored], pa.list_(pa.float64()))], schema.names
            )

    return rows.mapInArrow(run, schema)


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def learn(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    """Model from the labels of ``sf_dir`` that are not held out, over the rows of ``docs`` that they mark."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    return fit(spark, docs, labels.select("doc_id", F.col("toxic").alias("label")))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every document, with its evidence: the nearest labelled examples and their cosines.

    Null and empty texts, ties, repeated rows and empty tables: see ``fit`` and ``score``.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = score(spark, docs, learn(spark, docs, sf_dir))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "neighbours", "cosines")
