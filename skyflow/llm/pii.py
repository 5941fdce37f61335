"""Personal data: patterns, and candidates chosen by gradient-boosted trees.

Patterns with checks find e-mail addresses, IP addresses, payment cards and phone numbers. Looser
generators propose further spans, which may overlap. Trees, boosted on the proposals of all documents, score
them by format and context; a threshold per kind, calibrated on documents left out of the
training, selects those to redact. Everything runs as Spark expressions.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns. Quantifiers are possessive and starts are tied to where a run
# begins, which finds the same leftmost matches without trying every place of a long run.
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# Generators of candidates.
GENERATORS = {
    "contact": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++(?:@| ?[\[(]at[\])] ?){_LABEL}++(?:(?:\.| ?[\[(]dot[\])] ?){_LABEL}++)++",
    "number": r"(?:\G|(?<![0-9]))\+?[0-9](?:[ ().-]{0,2}+[0-9]){6,}+",
    "secret": r"(?:\G|(?<![A-Za-z0-9_]))[A-Za-z0-9_]{16,}+",
}
#: What a text must contain for a pattern to be tried.
NEEDED = {"email": "@", "ip": ".", "phone": "+"}
KINDS = [*BASE, *GENERATORS]

#: Characters before and after a candidate that are its context.
CONTEXT = 24
#: Context that confirms a secret in training; no feature sees it.
SECRET_CONTEXT = r"(?i)(?:key|token|secret|passw(?:or)?d|pwd|credential)s?[\"']?\s*[:=]\s*[\"']?$"
CONTEXT_WORDS = r"(?i)\b(?:call|phone|tel|fax|mobile|contact|mail|reach|card|visa|account|address|host|server|ip)\b"

TREES, DEPTH, BINS = 10, 3, 16
#: Share of confirmed candidates that a threshold must reach on the calibration part, which is every third document.
PRECISION = 0.95
SCORE_BINS = 50

#: Numbers that are summed together, and characters of the parts that long texts are cut from.
STRETCH = 256
PART = 1_024

SPAN = "struct<kind:string,start:bigint,end:bigint>"
MATCH = "struct<kind:string,start:bigint,end:bigint,match:string>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether digits pass the Luhn check."""
    places = F.sequence(F.lit(1), F.length(digits))

    def add(total: Column, place: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - place + 1, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(place % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(places, F.lit(0), add) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    """Whether a match of a base pattern passes its check."""
    size = F.length(_digits(match))
    if kind == "ip":
        plain = lambda part: F.regexp_replace(part, "^0+", "")
        small = lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255)
        return F.forall(F.split(match, r"\."), lambda part: small(plain(part)))
    if kind == "card":
        return F.when(size.between(13, 19), _luhn(_digits(match))).otherwise(False)
    if kind == "phone":
        return size.between(9, 15)
    return F.lit(True)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is evaluated once, however often it stands there."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(numbers: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Running sums, or what else ``join`` makes of 0 and the numbers, in time that grows with the numbers.

    An array that grows number by number is copied each time, so stretches of them are passed over alone first, and
    then moved by what the stretches before them come to.
    """
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("found"))
    state = lambda at, found, one: F.struct(at.alias("at"), F.concat(found, F.array(one)).alias("found"))

    def run(numbers: Column) -> Column:
        last = F.greatest(F.floor((F.size(numbers) - 1) / STRETCH), F.lit(0)).cast("int")
        add = lambda s, x: state(join(s["at"], x), s["found"], join(s["at"], x))
        stretch = lambda n: F.aggregate(F.slice(numbers, n * STRETCH + 1, F.lit(STRETCH)), begin, add)
        return _bound(F.transform(F.sequence(F.lit(0), last), stretch), moved)

    def moved(parts: Column) -> Column:
        before = F.aggregate(parts, begin, lambda s, p: state(join(s["at"], p["at"]), s["found"], s["at"]), lambda s: s["found"])
        return F.flatten(F.zip_with(parts, before, lambda p, at: F.transform(p["found"], lambda x: join(at, x))))

    return _bound(numbers, run)


def _reached(events: Column) -> Column:
    """For each event with an item, in order of (at, late): the greatest ``reach`` of the events before, and the item."""

    def run(events: Column) -> Column:
        reached = F.concat(F.array(F.lit(0).cast("long")), _running(F.transform(events, lambda e: e["reach"]), F.greatest))
        both = F.zip_with(events, reached, lambda e, reach: F.struct(reach.alias("reach"), e["item"].alias("item")))
        return F.filter(both, lambda x: x["item"].isNotNull())

    return _bound(F.sort_array(events), run)


def _event(at: Column, late: int, reach: Column, item: Column) -> Column:
    return F.struct(at.alias("at"), F.lit(late).alias("late"), reach.cast("long").alias("reach"), item.alias("item"))


def _parts(text: Column) -> Column:
    """A text in parts of ``PART`` characters, from which ``_cut`` takes some without a walk through all before."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PART}}}"), F.lit(0))


def _cut(parts: Column, start: Column, size: Column) -> Column:
    """``size`` characters from ``start``, counted from 0."""
    first = F.floor(start / PART).cast("int")
    some = F.slice(parts, first + 1, F.floor((start + size) / PART).cast("int") - first + 1)
    return F.substr(F.array_join(some, ""), (start % PART + 1).cast("int"), size.cast("int"))


def _found(text: Column, kind: str, pattern: str) -> Column:
    """Leftmost non-overlapping matches as structs of kind, start, end and match; characters from 0.

    The text between matches gives their places.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if needed := NEEDED.get(kind):
        matches = F.when(F.contains(text, F.lit(needed)), matches).otherwise(F.array().cast("array<string>"))

    def placed(matches: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
        sizes = F.zip_with(gaps, matches, lambda gap, match: (F.length(gap) + F.length(match)).cast("long"))
        one = lambda end, match: F.struct(F.lit(kind).alias("kind"), (end - F.length(match)).alias("start"), end.alias("end"), match.alias("match"))
        return F.zip_with(_running(sizes, lambda a, b: a + b), matches, one).cast(f"array<{MATCH}>")

    empty = F.array().cast(f"array<{MATCH}>")
    return _bound(matches, lambda found: F.when(F.size(found) > 0, placed(found)).otherwise(empty))


def _spans(found: Column) -> Column:
    plain = lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))
    return F.transform(found, plain)


def _with_base(docs: DataFrame, text: Column, names: list[str]) -> DataFrame:
    """``docs`` with base spans and candidates, as columns ``names``."""
    checked = lambda kind, p: F.filter(_found(text, kind, p), lambda x: _valid(kind, x["match"]))
    base = [checked(kind, p) for kind, p in BASE.items()]
    proposed = [_found(text, kind, p) for kind, p in GENERATORS.items()]
    return docs.select("*", F.concat(*map(_spans, base)).alias(names[0]), F.concat(*proposed).alias(names[1]))


def _before(parts: Column, candidate: Column) -> Column:
    """The context before a candidate."""
    return _cut(parts, F.greatest(candidate["start"] - CONTEXT, F.lit(0)), F.least(candidate["start"], F.lit(CONTEXT)))


def features_of(parts: Column, candidate: Column) -> list[Column]:
    """Format and context of a candidate in the text of which ``parts`` are the parts, as numbers."""
    match = candidate["match"]
    before, after = _before(parts, candidate), _cut(parts, candidate["end"], F.lit(CONTEXT))
    count = lambda pattern: F.length(F.regexp_replace(match, pattern, ""))
    number = lambda condition: F.when(condition, 1).otherwise(0)
    columns = [
        *[number(candidate["kind"] == kind) for kind in GENERATORS],
        F.length(match),
        count("[^0-9]"),
        count("[^a-z]"),
        count("[^A-Z]"),
        count("[^ ().-]"),
        count("[^.]"),
        F.array_max(F.transform(F.split(match, "[^0-9]+"), lambda x: F.length(x))),
        F.length(F.regexp_extract(match, "[A-Za-z0-9]*$", 0)),
        number(F.regexp_like(match, F.lit("^[0-9a-fA-F]+$"))),
        number(F.regexp_like(before, F.lit(CONTEXT_WORDS))),
        number(F.regexp_like(before, F.lit("[A-Za-z0-9]$"))),
        number(F.regexp_like(after, F.lit("^[A-Za-z0-9]"))),
        number(F.regexp_like(after, F.lit(r"^\.?[0-9]"))),
    ]
    return [column.cast("double") for column in columns]


@dataclass(frozen=True)
class Tree:
    """A node: a prediction, or a feature, its limit, and what is below on either side."""

    value: float = 0.0
    feature: int = -1
    limit: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def column(self, features: Column) -> Column:
        if self.low is None:
            return F.lit(self.value)
        inside = F.get(features, F.lit(self.feature)) <= self.limit
        return F.when(inside, self.low.column(features)).otherwise(self.high.column(features))


def read_trees(description: str) -> list[tuple[float, Tree]]:
    """Weights and trees of a fitted model, from its printed form."""
    trees, lines = [], [line.strip() for line in description.splitlines()]

    def node(at: int) -> tuple[Tree, int]:
        if found := re.match(r"Predict: (\S+)", lines[at]):
            return Tree(float(found[1])), at + 1
        feature, limit = re.match(r"If \(feature (\d+) <= (\S+)\)", lines[at]).groups()
        low, at = node(at + 1)
        high, at = node(at + 1)
        return Tree(0.0, int(feature), float(limit), low, high), at

    for at, line in enumerate(lines):
        if found := re.match(r"Tree \d+ \(weight (\S+)\):", line):
            trees.append((float(found[1]), node(at + 1)[0]))
    return trees


@dataclass(frozen=True)
class Model:
    """Boosted trees and the threshold of each kind of candidate."""

    trees: tuple[tuple[float, Tree], ...]
    thresholds: dict[str, float]

    def score(self, features: Column) -> Column:
        margin = F.lit(0.0)
        for weight, tree in self.trees:
            margin = margin + weight * tree.column(features)
        return 1 / (1 + F.exp(-2 * margin))


def _beside(base: Column, proposed: Column, position: str, late: tuple[int, int]) -> Column:
    """Candidates as ``item``, each with the farthest end of the base spans that begin before its ``position``.

    ``late`` orders base spans and candidates that stand at one place.
    """
    spans = F.transform(base, lambda b: _event(b["start"], late[0], b["end"], F.lit(None).cast(MATCH)))
    candidates = F.transform(proposed, lambda c: _event(c[position], late[1], F.lit(0), c.cast(MATCH)))
    return _reached(F.concat(spans, candidates))


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """Boost trees on the candidates of all documents; None where no kind can be learned.

    A candidate is confirmed if a base span overlaps it, a secret if what stands before it names one.
    The features see neither. Spark's learner takes the limits at which a feature may be split from some of the rows;
    which of them are used, what the leaves predict and the thresholds come from every row. Rows alike are one with a weight.
    """
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    found = _with_base(texts, F.col("text"), ["base", "proposed"])

    def examples(parts: Column) -> Column:
        # A base span overlaps a candidate if it begins before its end and ends after its start.
        def example(x: Column) -> Column:
            c = x["item"]
            named = F.regexp_like(_before(parts, c), F.lit(SECRET_CONTEXT))
            label = F.when(c["kind"] == "secret", named).otherwise(x["reach"] > c["start"])
            return F.struct(c["kind"].alias("kind"), c["start"].alias("start"), F.array(*features_of(parts, c)).alias("f"), label.cast("double").alias("label"))

        return F.transform(_beside(F.col("base"), F.col("proposed"), "end", (1, 0)), example)

    # From a plain explode a filter on the candidates would be inferred and run over all documents.
    rows = found.select("doc_id", F.explode_outer(_bound(_parts(F.col("text")), examples)).alias("c")).filter("c IS NOT NULL")
    left_out = (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("left_out")
    chosen = rows.groupBy(left_out, "c.kind", "c.label", "c.f").agg(F.count("*").alias("n")).persist()
    seen = {row["label"] for row in chosen.filter("NOT left_out").select("label").distinct().collect()}
    if seen != {0.0, 1.0}:
        chosen.unpersist()
        return None
    learner = GBTClassifier(featuresCol="v", weightCol="n", maxIter=TREES, maxDepth=DEPTH, maxBins=BINS, seed=7)
    fitted = learner.fit(chosen.filter("NOT left_out").select("label", "n", array_to_vector("f").alias("v")))
    model = Model(tuple(read_trees(fitted.toDebugString)), {})
    binned = F.floor(model.score(F.col("f")) * SCORE_BINS).cast("int").alias("bin")
    tallies = chosen.filter("left_out").groupBy("kind", binned).agg(F.sum("n").alias("n"), F.sum(F.col("label") * F.col("n")).alias("good")).collect()
    chosen.unpersist()
    thresholds = {}
    for kind in GENERATORS:
        n = good = 0
        for row in sorted((r for r in tallies if r["kind"] == kind), key=lambda r: -r["bin"]):
            n, good = n + row["n"], good + row["good"]
            if good >= PRECISION * n:
                thresholds[kind] = row["bin"] / SCORE_BINS
    return Model(model.trees, thresholds) if thresholds else None


def _selected(text: Column, base: Column, proposed: Column, model: Model) -> Column:
    """Spans of candidates that reach their threshold and that no base span covers, by kind and then start."""

    def chosen(parts: Column, c: Column) -> Column:
        needed = F.lit(2.0)
        for kind, threshold in model.thresholds.items():
            needed = F.when(c["kind"] == kind, F.lit(threshold)).otherwise(needed)
        return _bound(F.array(*features_of(parts, c)), model.score) >= needed

    # A base span covers a candidate if it begins there or before and ends there or after.
    free = F.filter(_beside(base, proposed, "start", (0, 1)), lambda x: x["reach"] < x["item"]["end"])
    fit = _bound(_parts(text), lambda parts: F.filter(F.transform(free, lambda x: x["item"]), lambda c: chosen(parts, c)))
    of_kind = lambda found, kind: F.filter(found, lambda c: c["kind"] == kind)
    by_kind = lambda found: F.concat(*[of_kind(found, kind) for kind in GENERATORS])
    some = F.when(F.size(proposed) > 0, _bound(fit, by_kind)).otherwise(F.array().cast(f"array<{MATCH}>"))
    return _spans(some)


def find(docs: DataFrame, model: Model | None, *, text_col: str = "text", names: tuple[str, str] = ("base", "spans")) -> DataFrame:
    """``docs`` with arrays of base spans and of all spans (kind, start, end), by kind and then start.

    Starts and ends count code points from 0, the end is exclusive. Null and empty texts have none;
    without a model the spans are the base ones. ``docs`` may not have columns called as ``names``.
    """
    if clash := {*names} & {*docs.columns}:
        raise ValueError(f"choose other names: {sorted(clash)}")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    hidden = f"_{names[0]}_proposed"
    found = _with_base(docs, text, [names[0], hidden])
    spans = F.col(names[0])
    if model:
        spans = F.concat(spans, _selected(text, F.col(names[0]), F.col(hidden), model))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns], names[0], spans.alias(names[1]))


def redact(docs: DataFrame, model: Model | None, *, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans leave no rest.

    A null text stays null; rows and columns stay as they are.
    """
    names = (f"_base_{len(docs.columns)}", f"_spans_{len(docs.columns)}")
    found = find(docs, model, text_col=text_col, names=names)
    text = F.col(f"`{text_col}`").cast("string")
    spans = F.transform(names[1], lambda s: _event(s["start"], 0, s["end"], s.cast(SPAN)))

    def replaced(parts: Column) -> Column:
        def piece(x: Column) -> Column:
            gap = _cut(parts, x["reach"], x["item"]["start"] - x["reach"])
            mark = F.concat(gap, F.lit("["), F.upper(x["item"]["kind"]), F.lit("]"))
            return F.when(x["item"]["start"] >= x["reach"], mark).otherwise("")

        end = F.array_max(F.transform(names[1], lambda s: s["end"]))
        pieces = F.array_join(F.transform(_reached(spans), piece), "")
        return F.concat(pieces, _cut(parts, end, F.length(text) - end))

    clean = F.when(F.size(names[1]) > 0, _bound(_parts(text), replaced)).otherwise(text)
    return found.select(*[clean.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: base counts by kind, digest of the base spans, and all spans as text."""
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    found = find(texts, fit(texts))
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    order = F.array(*[F.lit(k) for k in KINDS])
    by_kind = F.flatten(F.transform(order, lambda k: F.filter("spans", lambda s: s["kind"] == k)))
    return found.select(
        "doc_id",
        *map(count, BASE),
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(by_kind).alias("spans"),
    )
