"""Personal data by candidates and boosted trees.

Exact rules find the base spans, which always stand. Wider generators propose spans that may overlap: addresses written
around the at sign, numbers in groups, dotted or coloned numbers. Gradient-boosted trees score each candidate by its
format and the text around it. They learn from positive and unlabelled examples: spans of the exact rules are positive,
and what else the generators propose is unlabelled, not negative. Features leave out the marks the exact rules ask for
(country code and plus sign, spelling of at sign and dots, check digit), so that a candidate without them can look
like a span. A threshold per kind, set by the recall of spans of documents that were not learned from, selects what is
added.

Features are small bins. Trees tell how often spans take a combination of bins from combinations that occur at all,
each counted once: how many candidates share a format doesn't change the verdict on it, and weights are shares, so a
corpus twice over gives the same trees. What they learn from is one row per combination, counted over every document,
whose number the bins bound. Trees are scored as plain expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm.lines import running_sums
from sluiceway.llm.shared import let, staged

KINDS = ("email", "ip", "card", "phone")
# A match starts where the one before ended or where no longer match could have started, so that long runs are read once.
_LOCAL = r"[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What the generators propose, by the kind of span it would be.
WIDE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++\x20?(?:@|[\(\[]at[\)\]])\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[\(\[]dot[\)\]])\x20?[A-Za-z0-9-]++)*+",
    "ip": r"(?:\G|(?<![0-9A-Fa-f]))[0-9A-Fa-f]{1,4}+(?:[.:][0-9A-Fa-f]{1,4}+){3,7}+",
    "card": r"[0-9](?:[\x20./-]?[0-9]){11,20}+",
    "phone": r"[+(]?[0-9](?:[\x20().-]{0,2}[0-9]){6,14}+",
}
# At and above a kind's threshold are this share of its spans in documents held out, one in so many.
RECALL, HELD_OUT = 0.95, 5
# A side of a split has this share of all weight at least; SMOOTH is the weight that pulls leaves to 0.
ROUNDS, RATE, LEAVES_LEAST, SMOOTH = 30, 0.3, 0.001, 0.01


# Words in front of a candidate that name what it is.
NAMED = r"(?:tel|phone|call|mobile|fax|mail|card|visa|addr|contact|host|\bip\b)[^a-z]*$"


def spans_of(text: Column, pattern: str) -> Column:
    """Leftmost matches that don't overlap: structs of start, end (code points) and match, and the text on both sides.

    Text on a side reaches up to the far end of the next match there, so that long texts are not searched for it.
    """
    matches = F.regexp_extract_all(text, F.lit(f"({pattern})"), 1)

    def placed(both: Column) -> Column:
        gaps = both["gaps"]
        lengths = F.transform(both["matches"], lambda m, i: (F.length(m) + F.length(F.get(gaps, i))).cast("bigint"))
        return F.transform(
            F.arrays_zip(both["matches"].alias("match"), running_sums(lengths).alias("end")),
            lambda s, i: F.struct(
                (s["end"] - F.length(s["match"])).alias("start"),
                s["end"].alias("end"),
                s["match"].alias("match"),
                F.right(F.concat(F.coalesce(F.get(both["matches"], i - 1), F.lit("")), F.get(gaps, i)), F.lit(24)).alias("before"),
                F.left(F.concat(F.get(gaps, i + 1), F.coalesce(F.get(both["matches"], i + 1), F.lit(""))), F.lit(8)).alias("after"),
            ),
        )

    return let(F.struct(matches.alias("matches"), F.split(text, pattern, -1).alias("gaps")), placed)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Every second digit from the right doubled, their own digits added up: a multiple of 10."""
    return let(number, _luhn)


def _luhn(digits: Column) -> Column:
    each = F.transform(
        F.sequence(F.lit(1), F.length(digits)), lambda i: F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int") * (F.lit(2) - i % 2)
    )
    return F.aggregate(each, F.lit(0), lambda s, d: s + d - F.when(d > 9, 9).otherwise(0)) % 10 == 0


def fits(kind: str, match: Column) -> Column:
    """What an exact rule asks of its match."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(
            F.split(match, r"\."),
            lambda p: F.when(p.rlike("^0*[0-9]{1,3}$"), F.concat(F.lit("0"), F.ltrim(p, F.lit("0"))).try_cast("int") <= 255).otherwise(False),
        )
    digits = _digits(match)
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False)
    return F.length(digits).between(10, 15)


def _searched(text: Column, kind: str) -> Column:
    """Texts that can hold a span of the kind; others are not searched."""
    if kind == "email":
        return text.contains("@") | F.lower(text).rlike(r"[\(\[]at[\)\]]")
    return text.rlike("[0-9]")


def masked(kind: str, match: Column) -> Column:
    """A match without the marks that only the exact rule asks for."""
    if kind == "email":
        return F.regexp_replace(
            F.regexp_replace(match, r"\x20?(?:@|[\(\[]at[\)\]])\x20?", "@"), r"\x20?[\(\[]dot[\)\]]\x20?", "."
        )
    if kind == "phone":
        return F.regexp_replace(match, r"^\+(?:[0-9]{1,3}(?:[\x20.-]+|(?=\()))?", "")
    return match


def _bins(kind: str, s: Column) -> dict[str, Column]:
    """Features of a candidate: its format without the marks of the exact rule, and what is around it."""
    before, after = F.lower(s["before"]), s["after"]
    match = masked(kind, s["match"])
    digits = F.length(_digits(match))
    marks = F.length(match) - F.length(F.regexp_replace(match, "[^A-Za-z0-9]", ""))
    dots = F.length(match) - F.length(F.replace(match, F.lit("."), F.lit("")))
    # Of an address it tells little how many dots and digits it has; of a number they are its format.
    if kind == "email":
        digits, dots, marks = F.lit(0), F.when(match.rlike(r"@[^.]+\."), 1).otherwise(0), F.lit(0)
    return {
        "kind": F.lit(KINDS.index(kind)),
        "digits": F.least(digits, F.lit(20)),
        "marks": F.least(marks, F.lit(6)),
        "dots": F.least(dots, F.lit(4)),
        "open": F.when(match.contains("("), 1).otherwise(0),
        "blank": F.when(match.contains(" "), 1).otherwise(0),
        "left": F.when(before.rlike("[0-9A-Za-z]$"), 2).when(before.rlike(r"[.+(/:-]$"), 1).otherwise(0),
        "right": F.when(after.rlike("^[0-9A-Za-z]"), 2).when(after.rlike("^[/:-]"), 1).otherwise(0),
        "named": F.when(before.rlike(NAMED), 1).otherwise(0),
        "whole": F.when(fits("ip", match), 1).otherwise(0) if kind == "ip" else F.lit(1),
    }


FEATURES = ("kind", "digits", "marks", "dots", "open", "blank", "left", "right", "named", "whole")


def with_candidates(docs: DataFrame, text: str) -> DataFrame:
    """`docs` with columns `_base` (spans of the exact rules), `_wide` (candidates with features and a label), `_held`.

    The label of a candidate says that it is a span of an exact rule of its kind. `_held` marks texts held out.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    none = "array<struct<start:bigint,end:bigint,kind:int>>"
    rows = docs
    for nr, kind in enumerate(KINDS):
        found = F.filter(spans_of(body, BASE[kind]), lambda s: fits(kind, s["match"]))
        slim = F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(nr).alias("kind")))
        rows = rows.withColumn(f"_base_{kind}", F.when(_searched(body, kind), slim).otherwise(F.array().cast(none)))
    rows = rows.withColumn("_base", F.array_sort(F.concat(*[F.col(f"_base_{k}") for k in KINDS]), _in_order))
    wide = []
    for kind in KINDS:

        def described(s: Column, own: Column) -> Column:
            is_base = F.array_contains(own, F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(KINDS.index(kind)).alias("kind")))
            return F.struct(
                s["start"].alias("start"),
                s["end"].alias("end"),
                *[value.cast("int").alias(name) for name, value in _bins(kind, s).items()],
                is_base.alias("label"),
            )

        rows = rows.withColumn(
            f"_wide_{kind}", F.when(
                _searched(body, kind),
                let(F.col(f"_base_{kind}"), lambda own: F.transform(spans_of(body, WIDE[kind]), lambda s: described(s, own))),
            )
        )
        wide.append(F.coalesce(F.col(f"_wide_{kind}"), F.array()))
    held = F.crc32(body.cast("binary")) % HELD_OUT == 0
    return rows.withColumn("_wide", F.concat(*wide)).withColumn("_held", held).drop(*[f"_{p}_{k}" for p in ("base", "wide") for k in KINDS])


def _in_order(a: Column, b: Column) -> Column:
    """By start, then kind."""
    sign = lambda x: F.when(a[x] < b[x], -1).when(a[x] > b[x], 1)
    return F.coalesce(sign("start"), sign("kind"), sign("end"), F.lit(0))


@dataclass
class Tree:
    """A split at `feature` < `at`, and on each side a value or another split."""

    feature: str
    at: int
    below: Tree | float
    above: Tree | float

    def value(self, row) -> float:
        side = self.below if row[self.feature] < self.at else self.above
        return side.value(row) if isinstance(side, Tree) else side

    def expression(self, row: Column) -> Column:
        sides = [s.expression(row) if isinstance(s, Tree) else F.lit(float(s)) for s in (self.below, self.above)]
        return F.when(row[self.feature] < self.at, sides[0]).otherwise(sides[1])


@dataclass
class Model:
    trees: list[Tree]
    start: float
    thresholds: dict[int, float]

    def score(self, row: Column) -> Column:
        total = F.lit(self.start)
        for tree in self.trees:
            total = total + tree.expression(row)
        return total

    def accepts(self, row: Column) -> Column:
        least = F.lit(math.inf)
        for kind, value in self.thresholds.items():
            least = F.when(row["kind"] == kind, F.lit(value)).otherwise(least)
        return self.score(row) >= least


def _grow(cells: list[tuple], depth: int) -> Tree | float:
    """Tree over cells (row, gradient, hessian, weight) by the largest gain."""
    g, h = sum(c[1] for c in cells), sum(c[2] for c in cells)
    leaf = RATE * g / (h + SMOOTH)
    if not depth:
        return leaf
    best = (1e-6, None, None)
    for feature in FEATURES:
        totals: dict[int, list[float]] = {}
        for row, gradient, hessian, weight in cells:
            t = totals.setdefault(row[feature], [0.0, 0.0, 0.0])
            t[0] += gradient
            t[1] += hessian
            t[2] += weight
        below = [0.0, 0.0, 0.0]
        weight = sum(t[2] for t in totals.values())
        for value, following in zip(sorted(totals), sorted(totals)[1:]):
            below = [a + b for a, b in zip(below, totals[value])]
            if min(below[2], weight - below[2]) >= LEAVES_LEAST:
                right = (g - below[0]) ** 2 / (h - below[1] + SMOOTH)
                gain = below[0] ** 2 / (below[1] + SMOOTH) + right - g**2 / (h + SMOOTH)
                # A word that names the kind speaks for a candidate, also where the corpus has few.
                if feature == "named" and (g - below[0]) * below[1] < below[0] * (h - below[1]):
                    continue
                best = max(best, (gain, feature, following), key=lambda b: b[0])
    if best[1] is None:
        return leaf
    _, feature, at = best
    return Tree(
        feature,
        at,
        _grow([c for c in cells if c[0][feature] < at], depth - 1),
        _grow([c for c in cells if c[0][feature] >= at], depth - 1),
    )


def boosted(cells: list[tuple[dict, float, float]]) -> Model:
    """Trees and thresholds from cells: a combination of bins, and how many spans of learned and held out texts take it.

    A kind whose spans are all learned or all held out uses them for both; a kind without spans has no threshold.
    """
    own = {k: [c for c in cells if c[0]["kind"] == k] for k in range(len(KINDS))}
    rows: list[tuple[dict, float, float, float]] = []
    for kind in own.values():
        learned, held = sum(c[1] for c in kind), sum(c[2] for c in kind)
        if learned + held == 0:
            continue
        of_learned, of_held = 1 if learned else 2, 2 if held else 1
        for c in kind:
            # Shares of spans learned, of combinations, and of spans held out.
            rows.append((c[0], c[of_learned] / (learned or held), 1 / len(kind), c[of_held] / (held or learned)))
    total = sum(y + r for _, y, r, _ in rows)
    scores, trees = [0.0] * len(rows), []
    for _ in range(ROUNDS if rows else 0):
        chances = [1 / (1 + math.exp(-s)) for s in scores]
        steps = [(c, y - (y + r) * p, (y + r) * p * (1 - p), (y + r) / total) for (c, y, r, _), p in zip(rows, chances)]
        tree = _grow(steps, 3)
        if not isinstance(tree, Tree):
            break
        trees.append(tree)
        scores = [s + tree.value(c) for s, (c, *_) in zip(scores, rows)]
    thresholds = {}
    for kind in own:
        reached = 0.0
        for score, share in sorted(((s, h) for s, (c, _, _, h) in zip(scores, rows) if c["kind"] == kind), reverse=True):
            reached += share
            if reached >= RECALL - 1e-9:
                thresholds[kind] = score - 1e-6
                break
    return Model(trees, 0.0, thresholds)


def learn(found: DataFrame) -> Model:
    """Boost trees on the candidates of all rows of `found`, and set a threshold per kind.

    What comes to the driver is a count per combination of bins, not per candidate.
    """
    hit = F.col("c.label").cast("long")
    cells = (
        found.select("_held", F.explode("_wide").alias("c"))
        .groupBy(*[F.col(f"c.{f}").alias(f) for f in FEATURES])
        .agg(F.sum(F.when(F.col("_held"), 0).otherwise(hit)).alias("learned"), F.sum(F.when(F.col("_held"), hit).otherwise(0)).alias("held"))
        .collect()
    )
    return boosted([({f: c[f] for f in FEATURES}, c.learned, c.held) for c in sorted(cells)])


def _selected(model: Model) -> Column:
    """Base spans, and accepted candidates that overlap none of them nor an accepted one before."""
    accepted_first = F.filter("_wide", lambda c: model.accepts(c) & ~c["label"])
    free = lambda base, c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    accepted = let(F.col("_base"), lambda base: F.filter(accepted_first, lambda c: free(base, c)))
    accepted = F.transform(accepted, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind")))
    start = F.struct(F.lit(0).cast("bigint").alias("to"), F.array().cast("array<struct<start:bigint,end:bigint,kind:int>>").alias("all"))
    apart = F.aggregate(
        F.array_sort(accepted, _in_order),
        start,
        lambda s, c: F.when(
            c["start"] >= s["to"], F.struct(c["end"].alias("to"), F.concat(s["all"], F.array(c)).alias("all"))
        ).otherwise(s),
        lambda s: s["all"],
    )
    return F.array_sort(F.concat(F.col("_base"), apart), _in_order)


def pii_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (key, base, spans) per document: arrays of start, end and kind (its place in KINDS).

    Positions count code points, ends are exclusive. A NULL text is like an empty one and has no spans. Repeated rows
    get equal results; a NULL key stays NULL; other columns are ignored; an empty table gives an empty result. A kind
    without any span of its exact rule in the whole corpus gets none added, since nothing tells how its spans look there.
    A number written like the cards of the corpus is added although its check digit is wrong: it may be mistyped.
    """
    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = staged(with_candidates(slim, "text").select("key", "_base", "_wide", "_held"), "candidates")
    return found.select(F.col("key").alias(key), F.col("_base").alias("base"), _selected(learn(found)).alias("spans"))


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with every span of its texts replaced by its kind in brackets; of spans that overlap, the first names both."""
    model = learn(staged(with_candidates(docs.select(text), text).select("_base", "_wide", "_held"), "candidates"))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    body = F.col(text).cast("string")
    piece = lambda a, b: F.substring(body, (a + 1).cast("int"), (b - a).cast("int"))
    start = F.struct(F.lit(0).cast("bigint").alias("to"), F.array().cast("array<string>").alias("out"))
    clean = F.aggregate(
        F.col("_spans"),
        start,
        lambda s, x: F.when(
            x["start"] >= s["to"],
            F.struct(
                x["end"].alias("to"),
                F.concat(s["out"], F.array(piece(s["to"], x["start"]), F.get(names, x["kind"]))).alias("out"),
            ),
        ).otherwise(F.struct(F.greatest(s["to"], x["end"]).alias("to"), s["out"].alias("out"))),
        lambda s: F.concat(F.array_join(s["out"], ""), piece(s["to"], F.length(body).cast("bigint"))),
    )
    rows = with_candidates(docs, text).withColumn("_spans", _selected(model))
    return rows.withColumn(text, F.when(F.size("_spans") > 0, clean).otherwise(F.col(text))).select(*[F.col(f"`{c}`") for c in docs.columns])


def _digest(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    counts = [F.size(F.filter("base", lambda s: s["kind"] == nr)).cast("long").alias(f"n_{k}") for nr, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_digest("base"), 256).alias("base_sha256"), _digest("spans").alias("spans"))
