"""Toxicity scores by non-negative positive-unlabelled learning.

Only toxic examples are confirmed; all other text counts as unlabelled, a mixture in which a share
``prior`` is toxic. The risk of a classifier is the prior times its loss on the positives, plus its
loss on the unlabelled taken as negatives, less the prior times its loss on the positives taken as
negatives. The latter difference can't be negative for a true risk, so where it falls below zero
the step goes against its gradient instead.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyflow.llm import common
from skyflow.plans.staging import staged

#: Bounds of the training sample, in texts: those whose id has the smallest hash.
POSITIVES = 2_000
UNLABELLED = 6_000
#: Features kept at most, those that tell positives from unlabelled text best, and how well at least.
FEATURES = 4_096
LEAST_Z = 4.0
#: Hashed words and beginnings of words. A document has a feature for each that occurs once, twice or
#: more in it, by ``LEVELS``.
BUCKETS = 1 << 22
PREFIXES = (4, 5, 6)
LEVELS = (1, 2, 4)
#: Documents a feature occurs in at least.
LEAST_DOCS = 3
EPOCHS = 300
LEARNING_RATE = 0.05
WEIGHT_DECAY = 1e-3
THRESHOLD = 0.3

HELD_OUT_FOLDS, HELD_OUT = 4, 2
CACHE_WORDS = 100_000


def hashes_of(word: bytes) -> tuple[int, ...]:
    """Hashes of a word: of the word, and of its beginnings where it is as long."""
    mask = BUCKETS - 1
    return (
        zlib.crc32(word) & mask,
        *(zlib.crc32(word[:n] + b"*") & mask for n in PREFIXES if len(word) >= n),
    )


def features_of(data: bytes, hashes=hashes_of) -> list[int]:
    """Distinct features of a text, in order."""
    counts: dict[int, int] = {}
    for word, n in Counter(data.translate(common.LOWER_WORDS).split()).items():
        for h in hashes(word):
            counts[h] = counts.get(h, 0) + n
    size = len(LEVELS)
    return sorted(h * size + i for h, n in counts.items() for i, level in enumerate(LEVELS) if n >= level)


@dataclass
class Model:
    """Weights of hashed features."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self._weight = dict(zip(self.features.tolist(), self.weights.tolist(), strict=True))
        self._hashes = {f // len(LEVELS) for f in self._weight}
        self._words: dict[bytes, tuple[int, ...]] = {}

    def _known(self, word: bytes) -> tuple[int, ...]:
        """Hashes of a word that some feature has."""
        found = self._words.get(word)
        if found is None:
            if len(self._words) >= CACHE_WORDS:
                self._words.clear()
            found = self._words[word] = tuple(h for h in hashes_of(word) if h in self._hashes)
        return found

    def forget(self) -> None:
        """Drop what was kept of words seen."""
        self._words.clear()

    def score(self, data: bytes) -> float:
        """Probability that a text is toxic."""
        weight = self._weight
        margin = self.bias + sum(weight.get(f, 0.0) for f in features_of(data, self._known))
        return float(1 / (1 + np.exp(-np.clip(margin, -500, 500))))


def _matrix(rows: list[np.ndarray], features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and column numbers of the features that occur."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    keep = np.isin(flat, features)
    return at[keep], np.searchsorted(features, flat[keep])


def choose_features(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """Features whose share of the positive documents exceeds that of the unlabelled ones most, for its variance."""
    names, p = np.unique(np.concatenate(positive), return_counts=True)
    u = np.zeros(len(names), np.int64)
    # Features no positive document has can't be chosen; some documents at a time, to save memory.
    for start in range(0, len(unlabelled), 500):
        found = np.concatenate(unlabelled[start : start + 500])
        at = np.minimum(np.searchsorted(names, found), max(0, len(names) - 1))
        u += np.bincount(at[names[at] == found], minlength=len(names)) if len(names) else 0
    a, b = len(positive), len(unlabelled)
    share = (p + u) / (a + b)
    z = (p / a - u / b) / np.sqrt(share * (1 - share) * (1 / a + 1 / b) + 1e-9)
    z[p + u < LEAST_DOCS] = -1
    order = np.lexsort((names, -z))[:FEATURES]
    return np.sort(names[order[z[order] > LEAST_Z]])


def distinct(rows: list[np.ndarray]) -> list[np.ndarray]:
    """The rows, each once; copies of a document say nothing new."""
    return list({row.tobytes(): row for row in rows}.values())


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Model | None:
    """A linear classifier from the feature sets of both samples; None without positives."""
    if not positive or not unlabelled:
        return None
    positive, unlabelled = distinct(positive), distinct(unlabelled)
    return train_on(choose_features(positive, unlabelled), positive, unlabelled, prior)


def train_on(features: np.ndarray, positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Model:
    """A linear classifier on the given features, from sets of which every row counts."""
    size = len(features)
    sides = [(*_matrix(rows, features), len(rows)) for rows in (positive, unlabelled)]
    w = np.zeros(size + 1)
    first, second = np.zeros(size + 1), np.zeros(size + 1)

    def margins(side) -> np.ndarray:
        rows, columns, count = side
        return np.bincount(rows, w[columns], minlength=count) + w[-1]

    def gradient(side, slopes: np.ndarray) -> np.ndarray:
        rows, columns, count = side
        return np.append(np.bincount(columns, slopes[rows], minlength=size), slopes.sum()) / count

    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    w[-1] = np.log(prior / (1 - prior))
    for epoch in range(1, EPOCHS + 1):
        zp, zu = margins(sides[0]), margins(sides[1])
        # Logistic loss: log(1 + exp(-z)) as a positive, log(1 + exp(z)) as a negative.
        negative_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        corrected = gradient(sides[1], sigmoid(zu)) - prior * gradient(sides[0], sigmoid(zp))
        if negative_risk >= 0:
            step = prior * gradient(sides[0], sigmoid(zp) - 1) + corrected
        else:
            step = -corrected
        step[:-1] += WEIGHT_DECAY * w[:-1]
        first = 0.9 * first + 0.1 * step
        second = 0.999 * second + 0.001 * step * step
        w -= LEARNING_RATE * (first / (1 - 0.9**epoch)) / (np.sqrt(second / (1 - 0.999**epoch)) + 1e-8)
    # A text without any feature is no likelier toxic than any text is, though few examples may leave
    # the corrected risk negative and the bias undetermined.
    return Model(features, w[:-1], float(min(w[-1], np.log(prior / (1 - prior)))))


def _sample(docs: DataFrame, ids: DataFrame, bound: int) -> DataFrame:
    """Rows (doc_id, digest): at most ``bound`` different texts, of the documents in ``ids`` with the smallest hash.

    However many rows an id has and however many texts, no more are taken.
    """
    few = ids.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    texts = docs.join(F.broadcast(few), "doc_id", "left_semi").select("doc_id", F.xxhash64("text").alias("digest"))
    return texts.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "digest").limit(bound)


def feature_sets(docs: DataFrame, positive: DataFrame, unlabelled: DataFrame) -> DataFrame:
    """Rows (found, p, u): the different feature sets of two samples, and 1 for each sample a set is in, else 0."""
    marked = positive.select("doc_id", "digest", F.lit(1).alias("p"), F.lit(0).alias("u")).union(
        unlabelled.select("doc_id", "digest", F.lit(0), F.lit(1))
    )
    # Bounded: POSITIVES and UNLABELLED rows.
    sampled = F.broadcast(marked.groupBy("doc_id", "digest").agg(F.max("p").alias("p"), F.max("u").alias("u")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            sets = [np.array(features_of(data), np.int32) for data in common.as_bytes(batch["text"])]
            found = pa.array(sets, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([found, batch["p"], batch["u"]], ["found", "p", "u"])

    texts = docs.withColumn("digest", F.xxhash64("text")).join(sampled, ["doc_id", "digest"]).select("text", "p", "u")
    sets = texts.mapInArrow(common.releasing(run), "found array<int>, p int, u int")
    return sets.groupBy("found").agg(F.max("p").alias("p"), F.max("u").alias("u"))


def best_features(sets: DataFrame, positives: int, unlabelled: int) -> np.ndarray:
    """What ``choose_features`` finds in the sets of ``feature_sets``, counted and ranked by Spark; at most FEATURES."""
    counts = sets.select(F.explode("found").alias("feature"), "p", "u").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    share = (F.col("p") + F.col("u")) / F.lit(positives + unlabelled)
    deviation = F.sqrt(share * (1 - share) * F.lit(1 / positives + 1 / unlabelled) + F.lit(1e-9))
    z = (F.col("p") / F.lit(positives) - F.col("u") / F.lit(unlabelled)) / deviation
    told = counts.filter((F.col("p") > 0) & (F.col("p") + F.col("u") >= LEAST_DOCS)).select("feature", z.alias("z"))
    best = told.filter(F.col("z") > LEAST_Z).orderBy(F.desc("z"), "feature").limit(FEATURES).collect()
    return np.sort(np.array([row["feature"] for row in best], np.int64))


def _chosen_columns(sets: DataFrame, features: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The positive and the unlabelled sets, each cut to ``features``, in an order that hangs on them alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            cut = []
            for row in range(batch.num_rows):
                found = batch["found"][row].values.to_numpy(zero_copy_only=False)
                cut.append(found[np.isin(found, features)].astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(cut, pa.binary()), batch["p"], batch["u"]], ["found", "p", "u"])

    # Bounded: POSITIVES and UNLABELLED rows of FEATURES numbers of four bytes at most.
    rows = sets.mapInArrow(common.releasing(run), "found binary, p int, u int").collect()
    sides = (sorted(bytes(row["found"]) for row in rows if row[side]) for side in ("p", "u"))
    positive, unlabelled = ([np.frombuffer(found, "<i4") for found in side] for side in sides)
    return positive, unlabelled


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model | None:
    """Train on documents outside the held-out fold: labelled toxic ones, and any as unlabelled.

    The prior is the toxic share of the labelled rows outside that fold. Null labels are none. Copies of a text
    count once. The sample's feature sets stay in the shared folder; the driver gets the chosen features of each.
    """
    texts = common.id_and_text(docs, id_col, text_col)
    learned = lambda df: df.filter(common.fold(F.col("doc_id"), HELD_OUT_FOLDS) != HELD_OUT)
    known = learned(labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").alias("label")))
    share = known.agg(F.avg((F.col("label") == 1).cast("double"))).first()[0]
    if not share:
        return None
    ids = learned(texts.select("doc_id"))
    toxic = known.filter("label = 1").select("doc_id")
    positive = _sample(texts, toxic.join(ids, "doc_id", "left_semi"), POSITIVES)
    sets = staged(feature_sets(texts, positive, _sample(texts, ids, UNLABELLED)), "toxicity-sets")
    positives, unlabelled = sets.agg(F.sum("p"), F.sum("u")).first()
    if not positives or not unlabelled:
        return None
    features = best_features(sets, positives, unlabelled)
    return train_on(features, *_chosen_columns(sets, features), min(max(share, 0.001), 0.999))


def _scored(df: DataFrame, model: Model | None, text_at: int, name: str) -> DataFrame:
    """``df`` with the score of its text as a last column."""
    names = [*df.columns, name]
    # Bounded: FEATURES weights.
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value
        for batch in common.slices(batches):
            scores = [scorer.score(data) if scorer else 0.0 for data in common.as_bytes(batch.column(text_at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names)
        if scorer:
            scorer.forget()

    return df.mapInArrow(common.releasing(run), df.withColumn(name, F.lit(0.0)).schema)


def score(docs: DataFrame, model: Model | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, score), one per row of ``docs``.

    Null and empty texts have the score of a text without words; without a model all scores are 0.
    Repeated rows get equal scores, null ids stay null, other columns are not read.
    """
    return _scored(common.id_and_text(docs, id_col, text_col), model, 1, "score").drop("text")


def without_toxic(docs: DataFrame, model: Model | None, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` whose text scores below ``threshold``, with all their columns."""
    name = f"_score_{len(docs.columns)}"
    return _scored(docs, model, docs.columns.index(text_col), name).filter(F.col(name) < threshold).drop(name)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: whether it was held out, score, and prediction."""
    held_out = F.coalesce(common.fold(F.col("doc_id"), HELD_OUT_FOLDS) == HELD_OUT, F.lit(False))
    return score(docs, fit(docs, labels)).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
