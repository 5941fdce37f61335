"""Removal of repeated passages with suffix trees of prefix groups.

Documents are dealt to shards, by id and text; many copies of a row go there as a few that stand
for them, and rows without id need no shard. A suffix of a document matters only down to ``WINDOW``
words, and only if some other document has the same window there; two filters, both exact, keep
other suffixes out: copies of a whole text are settled by its digest, and a window is passed on
only if the smallest hash among its shorter runs of words, its anchor, occurs in another document
too. What is left is split by prefixes of different lengths into groups of like size. A group's
suffixes in order, with the lengths of their common prefixes, are its suffix tree: runs of
neighbours that share ``WINDOW`` words or more are its deep internal nodes, the repeats. Each
node's smallest document goes back to the shards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyflow.llm import common

WINDOW = 13
#: Words of the runs whose smallest hash is a window's anchor.
ANCHOR = 7
#: Bytes of text of a shard, on average.
SHARD_BYTES = 8 * 1024 * 1024
#: Bytes a row has besides its text, when copies of a row are weighed.
ROW_BYTES = 64
#: Bytes of text whose suffixes, or anchors, make up a group on average; few of them get past the filters.
GROUP_BYTES = 64 * 1024 * 1024
#: Documents whose suffixes show where to split; bounds the work on the driver, decides nothing else.
SAMPLE_DOCS = 300
#: Words of a prefix at most.
LONGEST_PREFIX = 8

NO_ID = np.iinfo(np.int64).max
ANSWER = "shard int, kind int, keys binary, ids binary, first long"


@dataclass
class Shard:
    """The words of a shard's documents, one after another."""

    ids: np.ndarray
    words: list[list[bytes]]
    copied_from: np.ndarray
    hashes: np.ndarray
    doc: np.ndarray

    @classmethod
    def read(cls, texts: pa.Table, copies: dict[bytes, int], *, with_copies: bool) -> Shard:
        """``copies`` has the first id of texts that occur more than once.

        Of those, all but the first are left out of the hashes, and out of the words unless
        ``with_copies``; so are rows without id.
        """
        ids = np.array([NO_ID if i is None else i for i in texts["doc_id"].to_pylist()], np.int64)
        digests = texts["digest"].to_pylist()
        first = np.array([copies.get(d, NO_ID) for d in digests], np.int64)
        copied = (first < ids) & (ids != NO_ID)
        skipped = copied | (ids == NO_ID)
        words = [
            data.split() if with_copies or not skip else []
            for data, skip in zip(common.as_bytes(texts["text"].combine_chunks()), skipped.tolist(), strict=True)
        ]
        sizes = np.where(skipped, 0, np.array(list(map(len, words)), np.int64))
        digest = xxhash.xxh64_intdigest
        hashes = np.empty(int(sizes.sum()), np.uint64)
        at = 0
        for ws, size in zip(words, sizes.tolist(), strict=True):
            if size:
                hashes[at : at + size] = list(map(digest, ws))
                at += size
        return cls(ids, words, copied, hashes, np.repeat(np.arange(len(ids)), sizes))

    def runs(self, size: int) -> np.ndarray:
        """A hash of the ``size`` words from each word on; runs over the end of a document are meaningless."""
        count = max(0, len(self.hashes) - size + 1)
        found = np.zeros(count, np.uint64)
        for i in range(size):
            found *= np.uint64(0x9E3779B97F4A7C15)
            found += self.hashes[i : i + count]
        found ^= found >> np.uint64(31)
        found *= np.uint64(0xBF58476D1CE4E5B9)
        return found ^ (found >> np.uint64(29))

    def windows(self) -> np.ndarray:
        """Words at which a window starts that ends in the same document."""
        count = max(0, len(self.doc) - WINDOW + 1)
        return np.flatnonzero(self.doc[:count] == self.doc[WINDOW - 1 : WINDOW - 1 + count])

    def anchors(self, starts: np.ndarray) -> np.ndarray:
        """The anchor of each window."""
        runs = self.runs(ANCHOR)
        least = runs[starts]
        for i in range(1, WINDOW - ANCHOR + 1):
            least = np.minimum(least, runs[starts + i])
        return least


def _copies(rows: pa.Table) -> dict[bytes, int]:
    rows = rows.filter(pc.equal(rows["kind"], 0))
    return dict(zip(rows["keys"].to_pylist(), rows["first"].to_pylist(), strict=True))


def _blobs(rows: pa.Table, kind: int, column: str, dtype: str) -> np.ndarray:
    """All numbers that rows of a kind have in a column."""
    found = [np.frombuffer(x, dtype) for x in rows.filter(pc.equal(rows["kind"], kind))[column].to_pylist()]
    return np.concatenate(found) if found else np.zeros(0, dtype)


def _shard_number(left: pa.Table, right: pa.Table) -> int:
    return (left if left.num_rows else right)["shard"][0].as_py()


def _anchor_rows(texts: pa.Table, known: pa.Table, buckets: int) -> pa.Table:
    """A shard's distinct anchors, by bucket, and whether several of its documents have them."""
    shard = Shard.read(texts, _copies(known), with_copies=False)
    starts = shard.windows()
    anchors, doc = shard.anchors(starts), shard.doc[starts]
    fresh = np.ones(len(anchors), bool)
    fresh[1:] = (anchors[1:] != anchors[:-1]) | (doc[1:] != doc[:-1])
    anchors, doc = anchors[fresh], doc[fresh]
    order = np.lexsort((doc, anchors))
    anchors, doc = anchors[order], doc[order]
    first = np.ones(len(anchors), bool)
    first[1:] = anchors[1:] != anchors[:-1]
    again = np.zeros(len(anchors), bool)
    again[1:] = ~first[1:] & (doc[1:] != doc[:-1])
    begins = np.flatnonzero(first)
    several = np.logical_or.reduceat(again, begins) if len(begins) else again
    anchors = anchors[first]
    bucket = (anchors >> np.uint64(40)).astype(np.int64) * buckets >> 24
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    rows = [
        (b, _shard_number(texts, known), anchors[i:j].astype("<u8").tobytes(), several[i:j].tobytes())
        for b, (i, j) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
        if j > i
    ]
    names = ["bucket", "shard", "anchors", "several"]
    types = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)


def _answers(rows: list[tuple]) -> pa.Table:
    types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64()]
    return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], ["shard", "kind", "keys", "ids", "first"])


def _repeated_anchors(rows: pa.Table) -> pa.Table:
    """For each shard, those of its anchors in a bucket that another document has."""
    shards = rows["shard"].to_pylist()
    lists = [np.frombuffer(x, "<u8") for x in rows["anchors"].to_pylist()]
    anchors = np.concatenate(lists)
    several = np.concatenate([np.frombuffer(x, bool) for x in rows["several"].to_pylist()])
    order = np.argsort(anchors, kind="stable")
    ranked = anchors[order]
    begins = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    counts = np.diff(np.append(begins, len(ranked)))
    repeated = np.empty(len(anchors), bool)
    repeated[order] = np.repeat((counts > 1) | np.logical_or.reduceat(several[order], begins), counts)
    out, at = [], 0
    for shard, own in zip(shards, lists, strict=True):
        kept = own[repeated[at : at + len(own)]]
        at += len(own)
        if len(kept):
            out.append((shard, 1, kept.tobytes(), None, None))
    return _answers(out)


def _prefix_keys(symbols: np.ndarray) -> np.ndarray:
    """The first eight symbols of each suffix as one number that sorts like them."""
    return np.ascontiguousarray(symbols[:, :LONGEST_PREFIX]).view(">u8").reshape(-1).astype(np.uint64)


def _symbols(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A byte for each of the words of each window."""
    letters = (hashes >> np.uint64(56)).astype(np.uint8)
    return letters[starts[:, None] + np.arange(WINDOW)]


def split_prefixes(keys: np.ndarray, groups: int) -> np.ndarray:
    """Where groups begin: prefixes, extended by a word while too many sampled suffixes have them.

    A prefix stands for the smallest key it has; neighbouring small ones share a group.
    """
    keys = np.sort(keys)
    most = max(1, len(keys) // max(1, groups))
    begins, filled = [0], 0
    waiting = [(0, 0, len(keys), 0)]
    while waiting:
        depth, low, high, prefix = waiting.pop()
        if high - low <= most or depth == LONGEST_PREFIX:
            if filled and filled + high - low > most:
                begins.append(prefix)
                filled = 0
            filled += high - low
            continue
        shift = 8 * (LONGEST_PREFIX - 1 - depth)
        children = [prefix + (c << shift) for c in range(256)]
        cuts = np.searchsorted(keys, np.array(children, np.uint64)).tolist()
        bounds = [*cuts[1:], high]
        waiting += [(depth + 1, max(low, a), b, c) for c, a, b in reversed([*zip(children, cuts, bounds, strict=True)]) if b > a]
    return np.array(begins, np.uint64)


def _suffix_rows(texts: pa.Table, known: pa.Table, begins: np.ndarray) -> pa.Table:
    """A shard's distinct windows with repeated anchors, by prefix group: symbols, hash, smallest document."""
    shard = Shard.read(texts, _copies(known), with_copies=False)
    starts = shard.windows()
    repeated = _blobs(known, 1, "keys", "<u8")
    starts = starts[np.isin(shard.anchors(starts), repeated)] if len(starts) else starts
    marks, ids = shard.runs(WINDOW)[starts], shard.ids[shard.doc[starts]]
    order = np.lexsort((ids, marks))
    marks, ids, starts = marks[order], ids[order], starts[order]
    first = np.ones(len(marks), bool)
    first[1:] = marks[1:] != marks[:-1]
    at = np.flatnonzero(first)
    several = np.maximum.reduceat(ids, at) > ids[at] if len(at) else np.zeros(0, bool)
    symbols = _symbols(shard.hashes, starts[at])
    group = np.searchsorted(begins, _prefix_keys(symbols), side="right") - 1
    order = np.argsort(group, kind="stable")
    symbols, marks, ids, several, group = symbols[order], marks[at][order], ids[at][order], several[order], group[order]
    cuts = np.searchsorted(group, np.arange(len(begins) + 1))
    rows = [
        (g, _shard_number(texts, known), symbols[i:j].tobytes(), marks[i:j].astype("<u8").tobytes(), ids[i:j].astype("<i8").tobytes(), several[i:j].tobytes())
        for g, (i, j) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
        if j > i
    ]
    names = ["group", "shard", "symbols", "marks", "ids", "several"]
    types = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
    return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)


def deep_nodes(symbols: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and where the deep nodes of their tree begin; a single suffix counts as one."""
    tail = np.zeros((len(symbols), 8), np.uint8)
    tail[:, : WINDOW - LONGEST_PREFIX] = symbols[:, LONGEST_PREFIX:]
    order = np.lexsort((marks, tail.view(">u8").reshape(-1), _prefix_keys(symbols)))
    symbols, marks = symbols[order], marks[order]
    # Symbols are a byte of a word's hash; the window's hash tells apart words that share it.
    common_words = np.cumprod(symbols[1:] == symbols[:-1], axis=1, dtype=np.uint8).sum(axis=1)
    deep = (common_words >= WINDOW) & (marks[1:] == marks[:-1])
    return order, np.flatnonzero(np.concatenate([[True], ~deep]))


def _repeats(rows: pa.Table) -> pa.Table:
    """For each shard, its windows in a prefix group that start in a smaller document, with the smallest."""
    shards = rows["shard"].to_pylist()
    read = lambda column, dtype: np.concatenate([np.frombuffer(x, dtype) for x in rows[column].to_pylist()])
    symbols, marks = read("symbols", np.uint8).reshape(-1, WINDOW), read("marks", "<u8")
    ids, several = read("ids", "<i8"), read("several", bool)
    ends = np.cumsum([0, *(len(x) // 8 for x in rows["marks"].to_pylist())])
    order, begins = deep_nodes(symbols, marks)
    least = np.empty(len(ids), np.int64)
    sizes = np.diff(np.append(begins, len(ids)))
    least[order] = np.repeat(np.minimum.reduceat(ids[order], begins), sizes)
    wanted = (least < ids) | several
    out = []
    for number, shard in enumerate(shards):
        at = ends[number] + np.flatnonzero(wanted[ends[number] : ends[number + 1]])
        if len(at):
            out.append((shard, 2, marks[at].astype("<u8").tobytes(), least[at].astype("<i8").tobytes(), None))
    return _answers(out)


def _clean_rows(texts: pa.Table, known: pa.Table) -> pa.Table:
    """A shard's documents without the words that repeated windows cover."""
    shard = Shard.read(texts, _copies(known), with_copies=True)
    marks, least = _blobs(known, 2, "keys", "<u8"), _blobs(known, 2, "ids", "<i8")
    order = np.argsort(marks, kind="stable")
    marks, least = marks[order], least[order]
    starts = shard.windows()
    cover = np.zeros(len(shard.hashes) + 1, np.int32)
    if len(marks) and len(starts):
        own = shard.runs(WINDOW)[starts]
        at = np.minimum(np.searchsorted(marks, own), len(marks) - 1)
        hit = starts[(marks[at] == own) & (least[at] < shard.ids[shard.doc[starts]])]
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + WINDOW, -1)
    covered = np.cumsum(cover[:-1]) > 0
    ends = np.searchsorted(shard.doc, np.arange(len(shard.ids) + 1))
    kept, removed = [], []
    for i, words in enumerate(shard.words):
        if shard.copied_from[i]:
            gone = np.full(len(words), len(words) >= WINDOW)
        elif shard.ids[i] == NO_ID:
            gone = np.zeros(len(words), bool)
        else:
            gone = covered[ends[i] : ends[i + 1]]
        removed.append(int(gone.sum()))
        if removed[-1]:
            words = [words[j] for j in np.flatnonzero(~gone).tolist()]
        kept.append(b" ".join(words).decode())
    counts = pa.array([len(words) for words in shard.words], pa.int64())
    columns = [texts["doc_id"], counts, pa.array(removed, pa.int64()), pa.array(kept, pa.string()), texts["times"]]
    return pa.table(columns, ["doc_id", "n_words", "n_removed", "kept", "times"])


def _untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Result rows of documents that lose nothing."""
    for batch in common.slices(batches):
        words = [data.split() for data in common.as_bytes(batch["text"])]
        counts, kept = [len(ws) for ws in words], [b" ".join(ws).decode() for ws in words]
        columns = [batch["doc_id"], pa.array(counts, pa.int64()), pa.array([0] * len(words), pa.int64()), pa.array(kept, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept"])


def _merged_copies(texts: DataFrame) -> tuple[DataFrame, bool]:
    """``texts`` with columns times and part, and whether rows were merged.

    Copies of a row, of one id and text, that would weigh more than a shard become as many rows as
    they would fill shards; each has a part number and stands for ``times`` copies.
    """
    weight = F.count("*") * (F.max(F.octet_length("text")) + ROW_BYTES)
    sizes = texts.groupBy("doc_id", "digest").agg(F.count("*").alias("n"), weight.alias("weight"))
    # Bounded: each weighs more than a shard.
    hot = sizes.filter((F.col("n") > 1) & (F.col("weight") > SHARD_BYTES)).collect()
    alone = texts.select("doc_id", "text", "digest", F.lit(1).cast("long").alias("times"), F.lit(0).cast("long").alias("part"))
    if not hot:
        return alone, False
    parts = [(r["doc_id"], bytes(r["digest"]), r["n"], min(r["n"], 1 + r["weight"] // SHARD_BYTES)) for r in hot]
    known = F.broadcast(texts.sparkSession.createDataFrame(parts, "doc_id long, digest binary, n long, parts long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            keys = [*zip(batch["doc_id"].to_pylist(), batch["digest"].to_pylist(), strict=True)]
            fresh = [i for i, key in enumerate(keys) if not (key in seen or seen.add(key))]
            yield batch.take(pa.array(fresh, pa.int64()))

    copies = texts.join(known, ["doc_id", "digest"], "left_semi").select("doc_id", "text", "digest")
    once = copies.mapInArrow(run, "doc_id long, text string, digest binary").groupBy("doc_id", "digest").agg(F.min("text").alias("text"))
    dealt = once.join(known, ["doc_id", "digest"]).withColumn("part", F.explode(F.sequence(F.lit(1).cast("long"), "parts")))
    times = F.expr("n div parts + if(part <= n % parts, 1, 0)").alias("times")
    rest = alone.join(known, ["doc_id", "digest"], "left_anti").select(*alone.columns)
    return rest.union(dealt.select("doc_id", "text", "digest", times, "part")), True


def _by_group(df: DataFrame, column: str, parts: int, function, schema: str) -> DataFrame:
    """``function`` of the rows of each group; groups are numbered from 0 to ``parts`` and dealt one to a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [batch for batch in batches if batch.num_rows]
        if found:
            rows = pa.Table.from_batches(found)
            for group in pc.unique(rows[column]).to_pylist():
                yield from function(rows.filter(pc.equal(rows[column], group))).to_batches()

    return df.repartitionById(parts, F.col(column)).mapInArrow(common.releasing(run), schema)


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept), one per row of ``docs``.

    Words are runs of anything but white space. A window is ``WINDOW`` consecutive words; each word
    in a window whose words also start a window in a document with a smaller id is removed, judged
    on the input. ``kept`` is the rest, joined by spaces. Null and empty texts have no words, rows
    with one id are the same document, rows without id lose nothing and count for no other.
    """
    base = common.id_and_text(docs, id_col, text_col)
    total = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards, groups = 12 + total // SHARD_BYTES, 12 + total // GROUP_BYTES
    # Rows without id take no part in windows.
    nameless = base.filter("doc_id IS NULL").mapInArrow(common.releasing(_untouched), "doc_id long, n_words long, n_removed long, kept string")
    named = base.filter("doc_id IS NOT NULL").select("doc_id", "text", F.unhex(F.md5("text")).alias("digest"))
    texts, merged = _merged_copies(named)
    # Neither the rows of one id nor those of one text make a shard.
    shard = F.pmod(F.xxhash64("doc_id", "digest", "part"), F.lit(shards)).cast("int").alias("shard")
    texts = texts.select("doc_id", "text", "digest", "times", "part", shard)
    # One exchange of the texts, which the three passes over them share.
    dealt = texts.repartition(shards, "shard")

    firsts = texts.groupBy("digest", "shard").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    copied = firsts.groupBy("digest").agg(F.min("least").alias("first"), F.sum("n").alias("n")).filter("n > 1")
    copies = firsts.drop("n").join(copied, "digest").select(
        "shard", F.lit(0).alias("kind"), F.col("digest").alias("keys"), F.lit(None).cast("binary").alias("ids"), "first"
    )

    def passed(known: DataFrame, function, schema: str) -> DataFrame:
        # Columns of their own, as both sides come from one table.
        right = known.select(*[F.col(c).alias(c) for c in known.columns]).repartition(shards, "shard")
        return dealt.groupBy("shard").cogroup(right.groupBy("shard")).applyInArrow(function, schema)

    anchors = passed(copies, lambda a, b: _anchor_rows(a, b, groups), "bucket int, shard int, anchors binary, several binary")
    repeated = _by_group(anchors, "bucket", groups, _repeated_anchors, ANSWER)

    begins = _sampled_prefixes(texts, groups)
    suffixes = passed(
        repeated.union(copies),
        lambda a, b: _suffix_rows(a, b, begins),
        "group int, shard int, symbols binary, marks binary, ids binary, several binary",
    )
    repeats = _by_group(suffixes, "group", len(begins), _repeats, ANSWER)
    cleaned = passed(repeats.union(copies), _clean_rows, "doc_id long, n_words long, n_removed long, kept string, times long")
    if merged:
        cleaned = cleaned.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).drop("copy")
    return cleaned.drop("times").union(nameless)


def _sampled_prefixes(texts: DataFrame, groups: int) -> np.ndarray:
    """Where prefix groups begin, from the suffixes of ``SAMPLE_DOCS`` documents."""
    texts = texts.filter("part <= 1")
    ids = texts.select("doc_id", "digest").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "digest").limit(SAMPLE_DOCS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            shard = Shard.read(pa.Table.from_batches([batch]), {}, with_copies=False)
            starts = shard.windows()
            # A document shows its windows at even distances, a thousand at most.
            keys = _prefix_keys(_symbols(shard.hashes, starts[:: 1 + len(starts) // 1000]))
            yield pa.RecordBatch.from_arrays([pa.array([keys.astype("<u8").tobytes()], pa.binary())], ["keys"])

    rows = texts.join(F.broadcast(ids), ["doc_id", "digest"], "left_semi").mapInArrow(run, "keys binary").collect()
    keys = [np.frombuffer(row["keys"], "<u8") for row in rows]
    return split_prefixes(np.concatenate(keys) if keys else np.zeros(0, np.uint64), groups)


def report(docs: DataFrame, **columns) -> DataFrame:
    """One row per document: words, removed words, digest of the kept ones."""
    return remove_repeats(docs, **columns).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
