"""Byte-pair encoding and decoding with a tokenization automaton.

The automaton starts with one state and an arc for every byte. Each merge ``u v -> w`` adds a
gadget: the arc ``v`` leaves the state that ``u`` leads to, and every state with an arc ``u``
gets an arc ``w`` to where ``v`` led. What remains are exactly the token sequences that the
merges produce. States depend on the last token only, so a gadget is stored as one row
(left token, right token, rank), and the transition of a state on a token follows the rows.
Transitions that were used are kept in a table.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyflow.llm import common

# The split that byte-level tokenizers of this kind apply before merging.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: The same split for text of Latin letters, which ``re`` does faster, and what it must not be used for:
#: superscripts, fractions and separators that ``re`` classes otherwise, and everything beyond Latin.
LATIN_PATTERN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
NOT_LATIN = re.compile("[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbe\u0250-\U0010ffff]")
#: Words kept with their tokens in a task, and as many that were kept before.
CACHE_WORDS = 150_000
#: Transitions kept in a task.
CACHE_ARCS = 300_000


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Bytes that Latin-1 prints stand for themselves, the others for characters from 256 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class MergeAutomaton:
    """Deterministic automaton over tokens that accepts what the merges produce."""

    def __init__(self, labels: list[bytes], merges: list[tuple[int, int, int]], special: dict[str, int]):
        """``merges`` has (left, right, merged) token numbers in order of rank."""
        size = len(labels)
        self.labels = labels
        self.special = special
        self.left, self.right, self.rank = [-1] * size, [-1] * size, [-1] * size
        self.merge_rank: dict[tuple[int, int], int] = {}
        self._arcs: dict[int, bool] = {}
        special_ids = set(special.values())
        self.tokens = {label: i for i, label in enumerate(labels) if len(label) == 1 and i not in special_ids}
        for rank, (u, v, w) in enumerate(merges):
            path = not self._removed(u, v, rank)
            self.merge_rank.setdefault((u, v), rank)
            if path and self.rank[w] < 0:
                self.left[w], self.right[w], self.rank[w] = u, v, rank
                self.tokens[labels[w]] = w
        self.longest = max(map(len, self.tokens), default=0)
        self.lengths = list(map(len, labels))
        #: The longest token that a token starts with.
        self.shorter = [-1] * size
        for label, token in self.tokens.items():
            ends = range(len(label) - 1, 0, -1)
            self.shorter[token] = next((t for e in ends if (t := self.tokens.get(label[:e])) is not None), -1)
        self.words = _Words(self)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_arcs": {}, "words": None}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.words = _Words(self)

    def forget(self) -> None:
        """Drop the words and transitions kept."""
        self.words.clear()
        self.words.older = {}
        self._arcs.clear()

    def _removed(self, x: int, y: int, before: int) -> bool:
        """Whether state ``x`` has lost its arc ``y`` to a gadget of a rank under ``before``."""
        merge_rank, left, right, rank = self.merge_rank, self.left, self.right, self.rank
        while True:
            if merge_rank.get((x, y), before) < before:
                return True
            if rank[x] < 0 and rank[y] < 0:
                return False
            if x == y:
                x, y, before = right[x], left[y], rank[x]
            elif rank[x] > rank[y]:
                x, before = right[x], rank[x]
            else:
                y, before = left[y], rank[y] + 1

    def has_arc(self, state: int, token: int) -> bool:
        """Whether ``token`` may follow ``state``, the last token read."""
        key = state * len(self.labels) + token
        found = self._arcs.get(key)
        if found is None:
            if len(self._arcs) >= CACHE_ARCS:
                self._arcs.clear()
            found = self._arcs[key] = not self._removed(state, token, len(self.merge_rank))
        return found

    def _longest_at(self, word: bytes, start: int) -> int:
        """The longest token that stands at ``start``; single bytes are tokens, so there is one."""
        tokens, end = self.tokens, min(len(word), start + self.longest)
        while (token := tokens.get(word[start:end])) is None:
            end -= 1
        return token

    def encode_word(self, word: bytes) -> tuple[int, ...]:
        """Tokens of a word: a run over its bytes, the longest arcs first.

        A place is reached by one accepted sequence only, so a place from which no arc goes on is
        never tried again.
        """
        arcs, lengths, shorter, names = self._arcs, self.lengths, self.shorter, len(self.labels)
        size, found, dead, at, state = len(word), [], set(), 0, -1
        token = self._longest_at(word, 0) if word else -1
        while at < size:
            while token >= 0:
                if at + lengths[token] not in dead:
                    if state < 0:
                        break
                    allowed = arcs.get(state * names + token)
                    if self.has_arc(state, token) if allowed is None else allowed:
                        break
                token = shorter[token]
            if token >= 0:
                found.append(token)
                at += lengths[token]
                state = token
                token = self._longest_at(word, at) if at < size else -1
            else:
                dead.add(at)
                token = found.pop()
                at -= lengths[token]
                state = found[-1] if found else -1
                token = shorter[token]
        return tuple(found)

    def encode(self, text: str, split=regex.compile(SPLIT_PATTERN)) -> np.ndarray:
        """Tokens of a whole text; strings of special tokens are those tokens."""
        words, parts = self.words, [text]
        if not NOT_LATIN.search(text):
            split = LATIN_PATTERN
        if self.special:
            pattern = "(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")"
            parts = regex.split(pattern, text) if any(s in text for s in self.special) else parts
        pieces = []
        for part in parts:
            if part in self.special:
                pieces.append([self.special[part]])
            elif part:
                pieces.append(chain.from_iterable(map(words.__getitem__, split.findall(part))))
        return np.fromiter(chain.from_iterable(pieces), dtype=np.int32)

    def decode(self, ids: list[int]) -> str:
        """Text of tokens."""
        return emit(self.labels, ids)


def emit(labels: list[bytes], ids: list[int]) -> str:
    """The arc labels of tokens one after another; broken UTF-8 is replaced."""
    return b"".join(map(labels.__getitem__, ids)).decode("utf-8", "replace")


class _Words(dict):
    """Tokens of words seen in this task; of those not used for long, the tokens are forgotten."""

    def __init__(self, automaton: MergeAutomaton):
        self.automaton = automaton
        self.older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHE_WORDS:
            self.older = dict(self)
            self.clear()
        found = self.older.get(word) or self.automaton.encode_word(word.encode())
        self[word] = found
        return found


def read_tokenizer(path: str) -> tuple[list[bytes], list[tuple[int, int, int]], dict[str, int]]:
    """Labels, merges and special tokens of a byte-level tokenizer file."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    if spec.get("normalizer") or spec["pre_tokenizer"].get("add_prefix_space"):
        raise ValueError("the tokenizer normalizes text or adds spaces, which this operator does not")
    alphabet, vocab = byte_alphabet(), spec["model"]["vocab"]
    special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
    labels = [b""] * (max([*vocab.values(), *special.values()]) + 1)
    for token, i in vocab.items():
        labels[i] = bytes(alphabet[c] for c in token) if token not in special else token.encode()
    for token, i in special.items():
        labels[i] = token.encode()
    merges = []
    for merge in spec["model"]["merges"]:
        u, v = merge.split(" ") if isinstance(merge, str) else merge
        merges.append((vocab[u], vocab[v], vocab[u + v]))
    return labels, merges, special


def _broadcast_tokenizer(df: DataFrame, path: str):
    # Its size is that of the vocabulary, whatever the input.
    return df.sparkSession.sparkContext.broadcast(MergeAutomaton(*read_tokenizer(path)))


def encode(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False
) -> DataFrame:
    """Rows (doc_id, ids array<int>), one per row of ``docs``; with ``decoded`` also the text decoded from the ids.

    Null and empty texts have no tokens, repeated rows and ids stay as they are, a null id stays
    null, and other columns of ``docs`` are not read.
    """
    shared = _broadcast_tokenizer(docs, tokenizer_path)
    schema = "doc_id long, ids array<int>" + ", decoded string" * decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in common.slices(batches):
            found = [automaton.encode(text) for text in common.as_text(batch["text"])]
            offsets = np.cumsum([0, *map(len, found)], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found), pa.int32()))
            columns = [batch["doc_id"], ids]
            if decoded:
                columns.append(pa.array([automaton.decode(x.tolist()) for x in found], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][: len(columns)])
        automaton.forget()

    return common.id_and_text(docs, id_col, text_col).mapInArrow(common.releasing(run), schema)


def decode(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its tokens in column ``to``; null and empty lists give an empty text."""
    shared = _broadcast_tokenizer(encoded, tokenizer_path)
    schema = T.StructType([*encoded.schema.fields, T.StructField(to, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = shared.value.labels
        for batch in common.slices(batches):
            lists = batch[ids_col]
            ids = lists.flatten().to_numpy(zero_copy_only=False).tolist()
            ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).tolist()
            texts = [emit(labels, ids[start:end]) for start, end in zip([0, *ends], ends)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], schema.names)

    return encoded.mapInArrow(common.releasing(run), schema)


def digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per document: number of tokens, digest of the tokens, digest of the text decoded from them."""
    return encode(docs, tokenizer_path, decoded=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.transform("ids", lambda x: x.cast("string")), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
