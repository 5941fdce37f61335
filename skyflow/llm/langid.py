"""Language identification with unigram models that sum over all segmentations.

A word is a sequence of pieces of a fixed public vocabulary. Each language has a probability for
each piece, and the probability of a word is the sum over all ways to cut it into pieces, which a
forward pass over its letters computes. The probabilities are estimated by expectation
maximisation: forward and backward passes give each piece's expected number of uses.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyflow.llm import common
from skyflow.plans.ordering import first_per_key
from skyflow.plans.staging import staged

#: Bound of the training sample, in documents of each language: those with the smallest hash of their id.
SAMPLE = 1_000
#: Parts in which the documents of a language are looked through for the sample.
SPREAD = 64
#: Distinct words of a language that are learned from, the most frequent ones.
SAMPLE_WORDS = 30_000
ROUNDS = 4
#: Expected uses that every piece of a language is given in addition.
SMOOTHING = 0.01
#: Probability of a character that is no piece.
UNKNOWN = 1e-7
#: Letters of a word; longer ones are taken in parts, so no longer piece is ever used.
LONGEST_WORD = 24

FOLDS, HELD_OUT = 5, 0
UNDETERMINED = "und"
CACHE_WORDS = 250_000

START = "▁"
_WORDS = re.compile(r"[^\W\d_]{1,%d}" % LONGEST_WORD)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased."""
    return _WORDS.findall(text.lower())


def has_letter(text: str, words: list[str]) -> bool:
    """Whether the text has a letter; some numerals are in words but are none."""
    return any(map(str.isalpha, words)) or any(map(str.isalpha, text))


class Pieces:
    """A vocabulary of pieces, found in many words at once by hashes of their characters."""

    SLOTS = 1 << 18

    def __init__(self, pieces: list[str]):
        self.size = len(pieces)
        self.longest = max(map(len, pieces), default=1)
        hashes = np.array([self._hash(p) for p in pieces], np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.numbers = hashes[order], order.astype(np.int32)
        self.seen = np.zeros(self.SLOTS, bool)
        self.seen[self._slot(self.hashes)] = True

    @staticmethod
    def _hash(piece: str) -> int:
        value = 0
        for c in piece:
            value = (value * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return value

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes ^ (hashes >> np.uint64(29))) % np.uint64(self.SLOTS)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of pieces, ``size`` where there is none."""
        found = np.full(len(hashes), self.size, np.int32)
        maybe = np.flatnonzero(self.seen[self._slot(hashes)])
        if len(maybe) and self.size:
            wanted = hashes[maybe]
            at = np.minimum(np.searchsorted(self.hashes, wanted), self.size - 1)
            found[maybe] = np.where(self.hashes[at] == wanted, self.numbers[at], self.size)
        return found

    def lattices(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(numbers of the words, pieces by word, start and length) for the words of each length."""
        marked = [START + w for w in words]
        lengths = np.array(list(map(len, marked)))
        for length in np.unique(lengths).tolist():
            which = np.flatnonzero(lengths == length)
            codes = np.array([marked[i] for i in which.tolist()], f"<U{length}").view(np.uint32).reshape(len(which), length)
            codes = codes.astype(np.uint64) + np.uint64(1)
            longest = min(length, self.longest)
            pieces = np.full((len(which), length, longest), self.size, np.int32)
            for start in range(length):
                value = np.zeros(len(which), np.uint64)
                for n in range(min(longest, length - start)):
                    value = value * _BASE + codes[:, start + n]
                    pieces[:, start, n] = self.find(value)
            yield which, pieces


def forward(pieces: np.ndarray, probability: np.ndarray) -> np.ndarray:
    """Probability, by word, place and language, of what stands before the place, over all segmentations.

    ``probability`` has a row per piece and a last one of zeros. A single character that is no
    piece has the probability ``UNKNOWN``.
    """
    words, length, longest = pieces.shape
    alpha = np.zeros((words, length + 1, probability.shape[1]))
    alpha[:, 0] = 1
    for start in range(length):
        for n in range(min(longest, length - start)):
            p = probability[pieces[:, start, n]]
            if n == 0:
                p = np.where((pieces[:, start, 0] == len(probability) - 1)[:, None], UNKNOWN, p)
            alpha[:, start + n + 1] += alpha[:, start] * p
    return alpha


def backward(pieces: np.ndarray, probability: np.ndarray) -> np.ndarray:
    """The same for what stands from the place on."""
    words, length, longest = pieces.shape
    beta = np.zeros((words, length + 1, probability.shape[1]))
    beta[:, length] = 1
    for start in range(length - 1, -1, -1):
        for n in range(min(longest, length - start)):
            p = probability[pieces[:, start, n]]
            if n == 0:
                p = np.where((pieces[:, start, 0] == len(probability) - 1)[:, None], UNKNOWN, p)
            beta[:, start] += beta[:, start + n + 1] * p
    return beta


@dataclass
class Model:
    """Piece probabilities by language."""

    languages: list[str]
    vocabulary: list[str]
    probability: np.ndarray
    prior: np.ndarray
    _cache: dict = field(default_factory=dict)

    def __getstate__(self):
        return self.languages, self.vocabulary, self.probability, self.prior

    def __setstate__(self, state):
        self.languages, self.vocabulary, self.probability, self.prior = state
        self._cache = {}

    def forget(self) -> None:
        """Drop what was kept of words seen."""
        self._cache.clear()

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        """Of each word in each language."""
        if "pieces" not in self._cache:
            self._cache |= {"pieces": Pieces(self.vocabulary), "numbers": {}, "rows": np.zeros((0, len(self.languages)))}
        numbers = self._cache["numbers"]
        if new := [w for w in {*words} if w not in numbers]:
            if len(numbers) + len(new) > CACHE_WORDS:
                numbers.clear()
                self._cache["rows"] = self._cache["rows"][:0]
                new = [*{*words}]
            rows = np.empty((len(new), len(self.languages)))
            for which, pieces in self._cache["pieces"].lattices(new):
                rows[which] = np.log(np.maximum(forward(pieces, self.probability)[:, -1], 1e-300))
            numbers.update(zip(new, range(len(numbers), len(numbers) + len(new)), strict=True))
            self._cache["rows"] = np.concatenate([self._cache["rows"], rows])
        return self._cache["rows"][np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))]

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and its posterior probability; undetermined with 0 for a text without letters."""
        words = list(map(words_of, texts))
        sizes = np.array(list(map(len, words)))
        logs = self.log_probabilities([w for ws in words for w in ws])
        sums = np.zeros((len(texts), len(self.languages)))
        np.add.at(sums, np.repeat(np.arange(len(texts)), sizes), logs)
        sums += np.log(self.prior)
        found = []
        for text, ws, row in zip(texts, words, sums, strict=True):
            if not self.languages or not has_letter(text, ws):
                found.append((UNDETERMINED, 0.0))
                continue
            share = np.exp(row - row.max())
            best = int(row.argmax())
            found.append((self.languages[best], float(share[best] / share.sum())))
        return found


def train(counts: dict[str, dict[str, int]], documents: dict[str, int], vocabulary: list[str]) -> Model:
    """Piece probabilities from each language's words and their counts; priors from documents."""
    languages = sorted(counts)
    pieces = Pieces(vocabulary)
    columns = []
    for language in languages:
        words = sorted(counts[language])
        weight = np.array([counts[language][w] for w in words], float)
        lattices = [*pieces.lattices(words)]
        p = np.full((len(vocabulary) + 1, 1), 1 / max(1, len(vocabulary)))
        p[-1] = 0
        for _ in range(ROUNDS):
            uses = np.full(len(vocabulary) + 1, SMOOTHING)
            for which, lattice in lattices:
                alpha, beta = forward(lattice, p)[:, :, 0], backward(lattice, p)[:, :, 0]
                scale = weight[which] / np.maximum(alpha[:, -1], 1e-300)
                for start in range(lattice.shape[1]):
                    for n in range(min(lattice.shape[2], lattice.shape[1] - start)):
                        used = lattice[:, start, n]
                        expected = alpha[:, start] * p[used, 0] * beta[:, start + n + 1] * scale
                        uses += np.bincount(used, expected, minlength=len(uses))
            uses[-1] = 0
            p = (uses / uses.sum())[:, None]
        columns.append(p)
    total = sum(documents.values())
    return Model(
        languages,
        vocabulary,
        np.concatenate(columns, axis=1) if columns else np.zeros((len(vocabulary) + 1, 0)),
        np.array([documents[x] / total for x in languages]),
    )


def read_vocabulary(path: str) -> list[str]:
    """Pieces of letters in a piece vocabulary, lower-cased, in order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i).lower() for i in range(model.get_piece_size()))
    fits = lambda p: p.removeprefix(START) == "" or p.removeprefix(START).isalpha()
    return sorted({p for p in pieces if p and len(p.removeprefix(START)) <= LONGEST_WORD and fits(p)})


def fit(docs: DataFrame, vocabulary: list[str], *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Train on documents with a language outside the held-out fold."""
    known = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        F.col(f"`{lang_col}`").alias("lang"),
    ).filter(F.col("lang").isNotNull() & (common.fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    documents = {row["lang"]: row["count"] for row in known.groupBy("lang").count().collect()}
    if not documents:
        return train({}, {}, vocabulary)
    # The same bounded number of ids for each language, all found in one pass; no text is ordered.
    by_hash = [F.xxhash64("doc_id").asc(), F.col("doc_id").asc()]
    # A language with a large share of the documents is cut to so many ids in parts first.
    part = F.pmod(F.xxhash64("doc_id", F.lit(0)), F.lit(SPREAD)).alias("part")
    few = first_per_key(known.select("lang", "doc_id", part).distinct(), ["lang", "part"], by_hash, SAMPLE)
    ids = staged(first_per_key(few, ["lang"], by_hash, SAMPLE).select("doc_id"), "language-ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            words = [words_of(text) for text in common.as_text(batch["text"])]
            lang = np.repeat(np.array(batch["lang"].to_pylist(), object), list(map(len, words)))
            flat = [w for ws in words for w in ws]
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(flat, pa.string())], ["lang", "word"])

    sample = known.join(F.broadcast(ids), "doc_id", "left_semi").select("lang", "text")
    tallies = sample.mapInArrow(common.releasing(run), "lang string, word string").groupBy("lang", "word").count()
    counts: dict[str, dict[str, int]] = {language: {} for language in documents}
    for row in first_per_key(tallies, ["lang"], [F.desc("count"), F.asc("word")], SAMPLE_WORDS).collect():
        counts[row["lang"]][row["word"]] = row["count"]
    return train(counts, documents, vocabulary)


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, lang_pred, score), one per row of ``docs``.

    Texts that are null or have no letter are ``und`` with score 0, as is every text if nothing was
    learned. Repeated rows get equal results, null ids stay null, other columns are not read.
    """
    # Bounded by the vocabulary and the number of languages.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in common.slices(batches):
            found = model.predict(common.as_text(batch["text"]))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )
        model.forget()

    return common.id_and_text(docs, id_col, text_col).mapInArrow(common.releasing(run), "doc_id long, lang_pred string, score double")


def report(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """One row per document: whether it was held out, predicted language, score."""
    held_out = F.coalesce(common.fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    found = predict(docs, fit(docs, read_vocabulary(vocabulary_path)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
