"""Near-duplicates by SimHash fingerprints, linked by segment popcounts.

A fingerprint is mapped to the popcounts of its segments. The Manhattan distance of two such points
is a lower bound of the Hamming distance, so fingerprints that differ in at most two bits lie within
two steps on the grid of points, and some grid cell is within one step of both. Each distinct
fingerprint is placed in the cells within one step, cells are joined, and pairs are verified exactly.
Cells that hold too many fingerprints for a join of all with all are split by exact midpoints: two
fingerprints differ in at most two bits if one can be reached from each by flipping one bit or none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyflow.llm import common
from skyflow.llm.components import connected
from skyflow.plans.staging import staged

SHINGLE = 3
SEED = 42
#: Differing bits up to which fingerprints link; the search by cells and midpoints is made for two.
MOST_BITS = 2
SEGMENTS, SEGMENT_BITS = 16, 4
#: Bits that a segment's popcount takes in the number of a cell.
POPCOUNT_BITS = 3
#: Fingerprints of a cell that are compared all with all; fuller cells are split by midpoints.
CELL_ROWS = 64


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of a text; 0 without words."""
    words = data.translate(common.LOWER).split()
    if not words:
        return 0
    size = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(b" ".join(s), SEED) for s in zip(*(words[i : len(words) - size + 1 + i] for i in range(size)))]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Rows (doc_id, bits), one per row of ``docs``; ``bits`` is the fingerprint as a signed number.

    Words are runs of anything but white space, A-Z lower-cased. A text with fewer words than a
    shingle is one shingle; null and empty texts have fingerprint 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            found = np.array([fingerprint(data, shingle) for data in common.as_bytes(batch["text"])], np.uint64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found.view(np.int64))], ["doc_id", "bits"])

    return common.id_and_text(docs, id_col, text_col).mapInArrow(common.releasing(run), "doc_id long, bits long")


def _popcount(bits: Column, segment: int) -> Column:
    mask = F.lit((1 << SEGMENT_BITS) - 1)
    return F.bit_count(F.shiftrightunsigned(bits, SEGMENT_BITS * segment).bitwiseAND(mask)).cast("long")


def cell_of(bits: Column) -> Column:
    """The popcounts of all segments in one number."""
    parts = [F.shiftleft(_popcount(bits, i), POPCOUNT_BITS * i) for i in range(SEGMENTS)]
    cell = parts[0]
    for part in parts[1:]:
        cell = cell + part
    return cell


def cells_near(bits: Column) -> Column:
    """The fingerprint's cell and those one step away, in which a popcount differs by one."""
    near = [F.lit(0).cast("long")]
    for i in range(SEGMENTS):
        step = F.lit(1 << (POPCOUNT_BITS * i)).cast("long")
        near.append(F.when(_popcount(bits, i) < SEGMENT_BITS, step))
        near.append(F.when(_popcount(bits, i) > 0, -step))
    return F.filter(F.array(*near), lambda step: step.isNotNull())


def links(distinct: DataFrame) -> DataFrame:
    """Pairs (u, v) of different fingerprints of column ``bits``; they connect what differs in two bits or fewer.

    Pairs found in cells are all there; of the fingerprints around one midpoint of a split cell,
    the smallest is linked with each other one.
    """
    centre = distinct.select("bits", cell_of(F.col("bits")).alias("centre"), F.explode(cells_near(F.col("bits"))).alias("step"))
    placed = centre.select((F.col("centre") + F.col("step")).alias("cell"), "bits", "centre")
    shared = placed.groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1")
    # Both sides are taken for no larger than the fingerprints they are exploded from.
    candidates = staged(placed.join(shared.hint("merge"), "cell"), "simhash-cells")

    small = candidates.filter(F.col("n") <= CELL_ROWS)
    a = small.select("cell", F.col("bits").alias("u"), F.col("centre").alias("cu"))
    b = small.select("cell", F.col("bits").alias("v"), F.col("centre").alias("cv"))
    # Of the cells a pair shares, one or two count, which depends on the pair only.
    once = F.when(F.col("cu") == F.col("cv"), F.col("cell") == F.col("cu")).otherwise(F.col("cell") != F.col("cv"))
    close = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= MOST_BITS
    pairs = a.join(b.hint("merge"), "cell").filter((F.col("u") < F.col("v")) & once & close).select("u", "v")

    crowded = candidates.filter(F.col("n") > CELL_ROWS).select("bits").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit((1 << i) - ((1 << 64) if i == 63 else 0)).cast("long") for i in range(64)])
    around = crowded.select("bits", F.explode(flips).alias("flip"))
    # A midpoint has 65 fingerprints around it at most.
    stars = (
        around.groupBy(F.col("bits").bitwiseXOR(F.col("flip")).alias("midpoint"))
        .agg(F.collect_list("bits").alias("members"))
        .filter(F.size("members") > 1)
        .select(F.array_min("members").alias("u"), F.explode("members").alias("v"))
        .filter("u < v")
    )
    return pairs.union(stars).distinct()


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Rows (doc_id, fingerprint, component_id), one per row of ``docs``.

    Documents link if their fingerprints differ in ``MOST_BITS`` bits or fewer; ``component_id`` is
    the smallest id reachable over links. Copies of a text share one fingerprint and are never
    paired. Repeated rows get equal results; rows with a null id get the component of their
    fingerprint, which is null if no row in it has an id.
    """
    rows = staged(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle), "simhash-rows")
    distinct = rows.groupBy("bits").agg(F.min("doc_id").alias("first_id"))
    labels = connected(links(distinct.select("bits")))
    classes = distinct.join(labels, distinct["bits"] == labels["node"], "left").select(
        "bits", "first_id", F.coalesce("component", "bits").alias("component")
    )
    firsts = classes.groupBy("component").agg(F.min("first_id").alias("component_id"))
    # Tables that grow with the documents are merged: stored, they take a fraction of what a broadcast of them takes on the driver.
    ids = classes.join(firsts.hint("merge"), "component").select(F.col("bits").alias("class_bits"), "component_id")
    hexadecimal = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    return rows.join(ids.hint("merge"), rows["bits"] == ids["class_bits"], "left").select(
        "doc_id", hexadecimal.alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose id is the smallest of their component, with all their columns.

    Rows without id all stay, as no other row can stand for them by its id.
    """
    found = near_duplicates(docs, id_col=id_col, text_col=text_col)
    first = found.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    kept = first.select(F.col("doc_id").alias("_kept_id"))
    number = F.col(f"`{id_col}`").cast("long")
    # Rows without id would all meet in one task of the join.
    named = docs.filter(number.isNotNull()).join(kept.hint("shuffle_hash"), number == F.col("_kept_id"), "left_semi")
    return named.union(docs.filter(number.isNull()))
