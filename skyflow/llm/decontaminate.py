"""Benchmark decontamination with an FM-index of every training shard.

A shard is a run of documents inside a partition with about ``SHARD_WORDS`` words. Its words
become symbols: those of the benchmark's vocabulary are numbered, all others can occur in no
window, so a run of them is one separator, and a stretch between separators that is shorter than
the shortest window holds none and is left out. The shard's suffix array gives the Burrows-Wheeler
transform, kept as a wavelet matrix. All windows are searched backward at once; their occurrences
are located by steps to sampled suffix positions and merged into spans of words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyflow.llm import common

WINDOW = 10
SHARD_WORDS = 2_000_000
SAMPLE_STEP = 16
#: Pairs of a document and an item made at a time, with the items of one window more.
EXPANDED = 2_000_000
#: Benchmark text, in bytes, that is searched for in one pass; a larger benchmark takes several.
BLOCK_BYTES = 16 * 1024 * 1024

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling; zeros are separators, all different, in order of place."""
    size, separators = len(symbols), symbols == 0
    rank = symbols.astype(np.int64) + np.count_nonzero(separators)
    rank[separators] = np.arange(np.count_nonzero(separators))
    step = 1
    while True:
        after = np.zeros(size, np.int64)
        after[: size - step] = rank[step:] + 1 if step < size else 0
        key = rank * (int(rank.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.empty(size, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        if new[order[-1]] == size - 1:
            return order
        rank, step = new, step * 2


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit vector per bit of the symbols."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            ones = (symbols >> bit) & 1
            before = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(ones, out=before[1:])
            self.levels.append((bit, before, len(symbols) - int(before[-1])))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        first, places = np.zeros_like(places), places.copy()
        for bit, ones, zeros in self.levels:
            one = ((symbols >> bit) & 1).astype(bool)
            for at in (first, places):
                seen = ones[at]
                at[:] = np.where(one, zeros + seen, at - seen)
        return places - first


class FMIndex:
    """Backward search and location in a sequence of symbols, of which 0 separates stretches."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        """``symbols`` starts with a separator; ``alphabet`` is above every symbol."""
        order = suffix_array(symbols)
        self.size = len(symbols)
        self.bwt = symbols[order - 1].astype(np.int32)
        self.wavelet = WaveletMatrix(self.bwt, max(1, int(alphabet - 1).bit_length()))
        counts = np.bincount(symbols, minlength=alphabet)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        offset = np.arange(self.size) - np.maximum.accumulate(np.where(symbols == 0, np.arange(self.size), 0))
        # The first symbol of a stretch is sampled, so no walk crosses a separator.
        self.sampled = ((offset - 1) % SAMPLE_STEP == 0)[order]
        self.sample_rank = np.concatenate([[0], np.cumsum(self.sampled)])
        self.samples = order[self.sampled]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that start with the patterns, all of one length."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size, np.int64)
        for column in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[:, column]
            low = self.before[symbol] + self.wavelet.rank(symbol, low)
            high = self.before[symbol] + self.wavelet.rank(symbol, high)
            high = np.maximum(low, high)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the sequence of the suffixes in ``rows``."""
        rows, places = rows.copy(), np.zeros(len(rows), np.int64)
        open_, steps = np.arange(len(rows)), 0
        while len(open_):
            at = rows[open_]
            done = self.sampled[at]
            places[open_[done]] = self.samples[self.sample_rank[at[done]]] + steps
            open_, at = open_[~done], at[~done]
            symbol = self.bwt[at]
            rows[open_] = self.before[symbol] + self.wavelet.rank(symbol, at.astype(np.int64))
            steps += 1
        return places


class Windows:
    """The windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        words = [(name, text.translate(common.LOWER_WORDS).split()) for name, text in items]
        words = [(name, item) for name, item in words if item]
        self.names = sorted({name for name, _ in words})
        number = {name: i for i, name in enumerate(self.names)}
        self.symbols = {w: i for i, w in enumerate(sorted({w for _, item in words for w in item}), 1)}
        found: dict[tuple[int, ...], set[int]] = {}
        for name, item in words:
            ids = [self.symbols[w] for w in item]
            length = min(window, len(ids))
            for start in range(len(ids) - length + 1):
                found.setdefault(tuple(ids[start : start + length]), set()).add(number[name])
        self.shortest = min(map(len, found), default=0)
        self.by_length = []
        for length in sorted({len(x) for x in found}):
            chosen = [x for x in found if len(x) == length]
            sizes = [len(found[x]) for x in chosen]
            owners = np.array([i for x in chosen for i in sorted(found[x])], np.int64)
            patterns = np.array(chosen, np.int64)
            self.by_length.append((length, patterns, np.concatenate([[0], np.cumsum(sizes)]), owners))

    def stretches(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and their word numbers: stretches a window fits into, each after a separator."""
        known = np.concatenate([[False], ids != 0, [False]])
        edges = np.flatnonzero(known[1:] != known[:-1])
        starts, ends = edges[::2], edges[1::2]
        keep = ends - starts >= self.shortest
        starts, ends = starts[keep], ends[keep]
        lengths = ends - starts + 1
        first = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else np.zeros(0, np.int64)
        place = np.arange(int(lengths.sum())) - np.repeat(first, lengths) + np.repeat(starts, lengths) - 1
        symbols = ids[np.maximum(place, 0)].astype(np.int64)
        symbols[first] = 0
        return symbols, place

    def occurrences(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(length, first words, their pattern numbers, owners by pattern) for a shard's words."""
        symbols, place = self.stretches(ids)
        if not len(symbols):
            return
        index = FMIndex(symbols, len(self.symbols) + 1)
        for length, patterns, bounds, owners in self.by_length:
            low, high = index.search(patterns)
            counts = high - low
            which = np.repeat(np.arange(len(patterns)), counts)
            rows = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
            yield length, place[index.locate(rows)], which, (bounds, owners)


def _expand(which: np.ndarray, bounds: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each element of ``which`` all of its owners: index into ``which``, and owner."""
    sizes = bounds[which + 1] - bounds[which]
    at = np.repeat(np.arange(len(which)), sizes)
    offset = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return at, owners[bounds[which][at] + offset]


def _owned(docs: np.ndarray, which: np.ndarray, bounds: np.ndarray, owners: np.ndarray, names: int) -> list[np.ndarray]:
    """Documents and the items of their windows, as ``document * names + item``.

    A document counts once for a window, however often it has it; equal pairs are dropped part by part.
    """
    patterns = len(bounds) - 1
    docs, which = np.divmod(np.unique(docs * patterns + which), patterns)
    sums = np.cumsum(bounds[which + 1] - bounds[which])
    cuts = [0, *(np.flatnonzero(np.diff(sums // EXPANDED)) + 1).tolist(), len(which)]
    found = []
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        at, owner = _expand(which[i:j], bounds, owners)
        found.append(np.unique(docs[i:j][at] * names + owner))
    return found


def search_shard(windows: Windows, docs: list[np.ndarray]) -> list[tuple[list[tuple[int, int]], list[str]]]:
    """Per document the merged spans of hit words and the items found."""
    # A separator after each document, so that no window crosses documents.
    sizes = np.array([len(x) for x in docs])
    ends = np.cumsum(sizes + 1)
    firsts = ends - sizes - 1
    ids = np.zeros(int(ends[-1]), np.int64)
    for start, doc in zip(firsts, docs, strict=True):
        ids[start : start + len(doc)] = doc
    cover, found = np.zeros(len(ids) + 1, np.int32), []
    for length, words, which, (bounds, owners) in windows.occurrences(ids):
        np.add.at(cover, words, 1)
        np.add.at(cover, words + length, -1)
        found += _owned(np.searchsorted(ends, words, side="right"), which, bounds, owners, len(windows.names))
    hit = np.concatenate([[0], (np.cumsum(cover)[:-1] > 0).astype(np.int8), [0]])
    edges = np.flatnonzero(hit[1:] != hit[:-1])
    spans: list[list[tuple[int, int]]] = [[] for _ in docs]
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        doc = int(np.searchsorted(ends, start, side="right"))
        spans[doc].append((start - int(firsts[doc]), end - int(firsts[doc])))
    items: list[list[str]] = [[] for _ in docs]
    for pair in np.unique(np.concatenate(found)).tolist() if found else []:
        items[pair // len(windows.names)].append(windows.names[pair % len(windows.names)])
    return list(zip(spans, items, strict=True))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, with those that touch or overlap joined."""
    found: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if found and start <= found[-1][1]:
            found[-1] = (found[-1][0], max(end, found[-1][1]))
        else:
            found.append((start, end))
    return found


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[tuple[bool, list[tuple[str, bytes]]]]:
    """The items in blocks of about ``BLOCK_BYTES``, one at least, and whether a block is the last."""
    items = benchmark.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + total // BLOCK_BYTES
    for part in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part)
        yield part == parts - 1, [(row["item"], row["text"].encode()) for row in rows.toLocalIterator()]


def _search_pass(df: DataFrame, text_at: int, shared, window: int, cutting: bool) -> DataFrame:
    """``df`` with its last three columns (words, spans, items) extended by one block.

    With ``cutting`` those columns go, and the spans are cut out of the texts.
    """
    names = df.columns[:-3] if cutting else df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(shared.value, window)
        get, size = windows.symbols.get, 0
        waiting: list[tuple[pa.RecordBatch, list[np.ndarray]]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            docs = [doc for _, words in waiting for doc in words]
            found = iter(search_shard(windows, docs) if docs else [])
            for batch, words in waiting:
                *kept, _, spans, items = batch.columns
                both = [(next(found), s, i) for s, i in zip(spans.to_pylist(), items.to_pylist(), strict=True)]
                spans = [
                    [{"start": a, "end": b} for a, b in merged(new + [(x["start"], x["end"]) for x in old or ()])]
                    for (new, _), old, _ in both
                ]
                if cutting:
                    texts = batch.column(text_at).to_pylist()
                    kept[text_at] = pa.array([cut(t, x) if x else t for t, x in zip(texts, spans, strict=True)], pa.string())
                    yield pa.RecordBatch.from_arrays(kept, names)
                    continue
                items = [sorted({*new, *(old or ())}) for (_, new), _, old in both]
                yield pa.RecordBatch.from_arrays(
                    [
                        *kept,
                        pa.array([len(x) for x in words], pa.int64()),
                        pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                        pa.array(items, pa.list_(pa.string())),
                    ],
                    names,
                )

        for batch in common.slices(batches):
            words = []
            for text in common.as_bytes(batch.column(text_at)):
                parts = text.translate(common.LOWER_WORDS).split()
                words.append(np.fromiter(map(get, parts, repeat(0)), np.int32, len(parts)))
            waiting.append((batch, words))
            size += sum(map(len, words))
            if size >= SHARD_WORDS:
                yield from flush()
                waiting, size = [], 0
        yield from flush()

    return df.mapInArrow(common.releasing(run), df.select(*names).schema)


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    names: tuple[str, str, str] = ("n_words", "spans", "items"),
) -> DataFrame:
    """``docs`` with the number of words, the spans of words inside benchmark windows, and the items.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z is lower-cased. A window is
    ``window`` consecutive words of an item, or the whole item if it is shorter. Spans are merged
    and in order; items are the distinct ids, sorted as strings, a null id being the empty string.
    Null and empty texts have no words; repeated rows are searched like any other. Columns of
    ``docs`` are passed on; none may be called as one of ``names``.
    """
    return _passes(docs, benchmark, text_col, item_col, item_text_col, window, names, cutting=False)


def _passes(
    docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text_col: str, window: int, names: tuple, cutting: bool
) -> DataFrame:
    """A search pass over ``docs`` for each block of the benchmark; with ``cutting`` the last cuts."""
    if clash := {*names} & {*docs.columns}:
        raise ValueError(f"choose other names: {sorted(clash)}")
    context = docs.sparkSession.sparkContext
    found = docs.withColumns(
        {names[0]: F.lit(0).cast("long"), names[1]: F.lit(None).cast(SPANS), names[2]: F.lit(None).cast("array<string>")}
    )
    text_at = docs.columns.index(text_col)
    for last, block in _blocks(benchmark, item_col, item_text_col):
        # A block's size is bounded by BLOCK_BYTES and one item.
        found = _search_pass(found, text_at, context.broadcast(block), window, cutting and last)
    return found


_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cut(text: str, spans: list[dict]) -> str:
    """``text`` without the words in ``spans`` and what stands between them."""
    data, places = text.encode(), []
    places = [m.span() for m in _WORD.finditer(data)]
    kept, at = [], 0
    for span in spans:
        kept.append(data[at : places[span["start"]][0]])
        at = places[span["end"] - 1][1]
    return b"".join([*kept, data[at:]]).decode()


def remove_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """``docs`` with benchmark passages cut out of the texts; rows and columns stay as they are."""
    names = tuple(f"_passages_{len(docs.columns)}_{x}" for x in ("words", "spans", "items"))
    return _passes(docs, benchmark, text_col, item_col, item_text_col, window, names, cutting=True)


def report(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: words, hit words, items, digest of the items, whether any word is hit."""
    found = find_passages(common.id_and_text(docs, id_col, text_col), benchmark)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
