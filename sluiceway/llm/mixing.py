"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Documents of a source are dealt by hash into blocks of one size class each. A source's target fixes how many whole
copies of every block the mix takes and which blocks it takes once more. The resulting block quotas of all sources are
split over the output shards by a binary tree: at each node, how many blocks of each source go left is drawn from the
multivariate hypergeometric distribution, so quotas are met exactly at every node. Each source's blocks, in permuted
order, are then drawn by the shards without overlap, and every shard is shuffled by itself.

Blocks per source are bounded by size classes times `bins`, whatever the size of the source: what is held per source,
and per shard, doesn't grow with the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluiceway.llm.shared import let, staged, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
BINS = 64
SHARDS = 128
# Blocks up to which they are sent to every executor; beyond, documents and blocks are shuffled.
BROADCAST_BLOCKS = 200_000
SEED = 17


def _unit(*parts: Column) -> Column:
    """A fixed number between 0 and 1 for the given values."""
    return (F.xxhash64(F.lit(SEED), *parts).bitwiseAND(F.lit((1 << 52) - 1)) + F.lit(0.5)) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple, share: float, most: float) -> DataFrame:
    """Targets of sources (source, source_size): `share` of all words by weight, none above `most` times its source.

    What lies above is given to the others by weight again until none is above. In order of the weight at which a
    source is full, the level that this ends at is the first one which its own source doesn't fill.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"),
    )
    by_level = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    all_rows = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wanted = F.lit(share) * F.sum("source_size").over(all_rows)
    return (
        sizes.withColumn("weight", weight)
        .withColumn("cap", F.lit(most) * F.col("source_size"))
        .withColumn("full_at", F.col("cap") / F.col("weight"))
        .withColumn("level", (wanted - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
        .withColumn("level", F.max(F.when(F.col("full_at") >= F.col("level"), F.col("level"))).over(all_rows))
        .withColumn("target", F.coalesce(F.least("cap", F.col("level") * F.col("weight")), F.col("cap")))
        .select("source", "source_size", "weight", "target")
    )


def _blocks_taken_once_more(blocks: Column, part: Column) -> Column:
    """Of blocks (largest documents first, permuted within a class), those that keep the words taken nearest to `part`."""
    start = F.struct(
        F.lit(0.0).alias("seen"), F.lit(0.0).alias("took"), F.array().cast("array<boolean>").alias("takes")
    )

    def step(state: Column, block: Column) -> Column:
        words = block["words"].cast("double")
        seen = state["seen"] + words
        take = state["took"] + words / 2 <= part * seen
        return F.struct(
            seen.alias("seen"),
            (state["took"] + F.when(take, words).otherwise(0.0)).alias("took"),
            F.concat(state["takes"], F.array(take)).alias("takes"),
        )

    return F.aggregate(blocks, start, step, lambda state: state["takes"])


def _hypergeometric(total: Column, marked: Column, drawn: Column, unit: Column) -> Column:
    """How many of `marked` among `total` items are in a draw of `drawn`, by the inverse of the distribution at `unit`.

    Weights follow from the mode outwards by the ratio of neighbouring probabilities, so none overflows.
    """
    low = F.greatest(F.lit(0.0), drawn + marked - total)
    high = F.least(marked, drawn)
    likely = F.least(high, F.greatest(low, F.floor((drawn + 1) * (marked + 1) / (total + 2)).cast("double")))
    return let(likely, lambda mode: _walked(total, marked, drawn, unit, low, high, mode))


def _walked(
    total: Column, marked: Column, drawn: Column, unit: Column, low: Column, high: Column, mode: Column
) -> Column:
    rest = total - marked - drawn

    def down(w: Column, x: Column) -> Column:
        return w * x * (rest + x) / ((marked - x + 1) * (drawn - x + 1))

    def up(w: Column, x: Column) -> Column:
        return w * (marked - x) * (drawn - x) / ((x + 1) * (rest + x + 1))

    def steps(first: Column, last: Column) -> Column:
        return F.when(first <= last, F.sequence(first.cast("long"), last.cast("long"))).otherwise(
            F.array().cast("array<bigint>")
        )

    def walk(values: Column, at, state: Column, ratio, goal: Column) -> Column:
        """Adds weights along the values; keeps the first value at which the sum reaches the goal."""

        def step(s: Column, i: Column) -> Column:
            x = at(i)
            total_here = s["sum"] + s["w"]
            return F.struct(
                ratio(s["w"], x).alias("w"),
                total_here.alias("sum"),
                F.when(s["hit"].isNotNull(), s["hit"]).when(total_here >= goal, x).alias("hit"),
            )

        return F.aggregate(values, state, step)

    def state(w: Column, total_before: Column, hit: Column) -> Column:
        return F.struct(w.alias("w"), total_before.alias("sum"), hit.cast("double").alias("hit"))

    none = F.lit(None)
    below, above = steps(low, mode), steps(mode + 1, high)
    at_below, at_above = (lambda i: low + mode - i.cast("double")), (lambda i: i.cast("double"))
    first_above = up(F.lit(1.0), mode)

    def both(goal: Column) -> Column:
        first = walk(below, at_below, state(F.lit(1.0), F.lit(0.0), none), down, goal)
        return walk(above, at_above, state(first_above, first["sum"], first["hit"]), up, goal)

    whole = both(F.lit(float("inf")))["sum"]
    return let(unit * whole, lambda goal: F.coalesce(both(goal)["hit"], mode))


def split_quotas(root: DataFrame, shards: int) -> DataFrame:
    """Split a row (quotas array<double>) over shards: one row (shard, quotas) each, that add up to the root's."""
    nodes = root.select(F.lit(0).alias("lo"), F.lit(shards).alias("hi"), "quotas")
    for _ in range(max(shards - 1, 0).bit_length()):
        middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        total = F.aggregate("quotas", F.lit(0.0), lambda s, q: s + q)
        goes = F.round(total * (middle - F.col("lo")) / (F.col("hi") - F.col("lo")))
        start = F.struct(
            F.array().cast("array<double>").alias("left"), F.col("total").alias("rest"), F.col("goes").alias("open")
        )

        def step(s: Column, quota: Column) -> Column:
            x = _hypergeometric(s["rest"], quota, s["open"], _unit(F.col("lo"), F.col("hi"), F.size(s["left"])))
            return let(
                x,
                lambda d: F.struct(
                    F.concat(s["left"], F.array(d)).alias("left"),
                    (s["rest"] - quota).alias("rest"),
                    (s["open"] - d).alias("open"),
                ),
            )

        nodes = (
            nodes.withColumn("total", total)
            .withColumn("goes", goes)
            .withColumn("left", F.aggregate("quotas", start, step, lambda s: s["left"]))
            .select(
                F.explode(
                    F.when(F.col("hi") - F.col("lo") <= 1, F.array(F.struct("lo", "hi", "quotas"))).otherwise(
                        F.array(
                            F.struct(F.col("lo"), middle.alias("hi"), F.col("left").alias("quotas")),
                            F.struct(
                                middle.alias("lo"),
                                F.col("hi"),
                                F.zip_with("quotas", "left", lambda q, x: q - x).alias("quotas"),
                            ),
                        )
                    )
                ).alias("node")
            )
            .select("node.*")
        )
    return nodes.select(F.col("lo").alias("shard"), "quotas")


def _placed(docs: DataFrame, key: str, text: str, source: str, bins: int) -> DataFrame:
    """`docs` with source, words, hash of key and text, and the block (size class, bin) they lie in."""
    placed = docs.select(
        "*",
        F.col(source).cast("string").alias("_source"),
        word_count(F.col(text)).alias("_size"),
        F.xxhash64(F.lit(SEED), F.col(key), F.col(text)).alias("_print"),
    )
    size_class = F.when(F.col("_size") > 0, F.length(F.bin("_size"))).otherwise(0)
    return placed.select("*", size_class.alias("_class"), F.pmod("_print", F.lit(bins)).cast("int").alias("_bin"))


def _with_shards(rows: DataFrame, dealt: DataFrame) -> DataFrame:
    """Rows of `_placed` with the shards of their block's copies; the blocks are sent to every executor while few."""
    blocks = F.broadcast(dealt) if dealt.count() <= BROADCAST_BLOCKS else dealt
    return rows.join(
        blocks,
        F.col("_source").eqNullSafe(F.col("_of")) & (F.col("_class") == F.col("_in")) & (F.col("_bin") == F.col("_at")),
        "left",
    )


def mix_plan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    shards: int = SHARDS,
    bins: int = BINS,
) -> DataFrame:
    """What the mix takes: one row (key, source, size, source_size, target, taken, shards) per document.

    `size` counts words, `taken` is size times the copies taken, and `shards` holds the shard of every copy. A NULL text has no words and is like an empty one: taken 0, no shard. A NULL source is a
    source of its own, the last. A source without words has target 0. Repeated rows are equal in hash, so the mix takes
    them together. An empty table gives an empty plan. All draws come from hashes: reruns agree.
    """
    sizes, dealt, about = _deal(docs, key, text, source, weights, share, most, shards, bins)
    return (
        _with_shards(sizes, dealt)
        .join(about, F.col("_source").eqNullSafe(F.col("name")))
        .select(
            "key",
            F.col("_source").alias("source"),
            F.col("_size").alias("size"),
            "source_size",
            "target",
            (F.col("_size") * F.coalesce(F.size("_shards"), F.lit(0))).cast("long").alias("taken"),
            F.coalesce("_shards", F.array().cast("array<int>")).alias("shards"),
        )
    )


def _deal(
    docs: DataFrame,
    key: str,
    text: str,
    source: str,
    weights: tuple,
    share: float,
    most: float,
    shards: int,
    bins: int,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents without their texts, the shards of each block (_of, _in, _at, _shards), and each source's size and target."""
    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(source).alias("source"))
    sizes = staged(_placed(slim, "key", "text", "source", bins).drop("text", "source"), "sizes")
    named = sizes.select(*[F.col(f"_{c}").alias(c) for c in ("source", "size", "class", "bin")])
    blocks = named.groupBy("source", "class", "bin").agg(F.sum("size").alias("words"))
    block = F.struct(
        (-F.col("class")).alias("order"),
        F.xxhash64(F.lit(SEED), "source", "class", "bin").alias("place"),
        "class",
        "bin",
        "words",
    )
    per_source = blocks.groupBy("source").agg(
        F.sum("words").alias("source_size"), F.sort_array(F.collect_list(block)).alias("blocks")
    )
    per_source = staged(per_source, "sources")
    targets = staged(source_targets(per_source.select("source", "source_size"), weights, share, most), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    chosen = (
        per_source.drop("source_size")
        .join(targets, per_source["source"].eqNullSafe(targets["source"]))
        .select(targets["source"], "source_size", "target", "blocks", ratio.alias("ratio"))
        .withColumn("whole", F.floor("ratio").cast("int"))
        .withColumn("takes", _blocks_taken_once_more(F.col("blocks"), F.col("ratio") - F.col("whole")))
        .withColumn(
            "blocks",
            F.zip_with(
                "blocks",
                "takes",
                lambda b, t: F.struct(
                    b["class"].alias("class"),
                    b["bin"].alias("bin"),
                    F.when(b["words"] > 0, F.col("whole") + t.cast("int")).otherwise(0).alias("copies"),
                ),
            ),
        )
        .select("source", "source_size", "target", "blocks")
    )
    chosen = staged(chosen, "chosen")

    # Items are copies of blocks; a source's items are ranked in permuted order and drawn by the shards one after another.
    quotas = chosen.select(
        "source", F.aggregate("blocks", F.lit(0), lambda s, b: s + b["copies"]).cast("double").alias("quota")
    )
    root = quotas.agg(
        F.sort_array(F.collect_list(F.struct(F.col("source").isNull().alias("last"), "source", "quota"))).alias("all")
    ).select("all.source", F.col("all.quota").alias("quotas"))
    root = staged(root, "quotas")
    tree = split_quotas(root.select("quotas"), shards)
    order = root.select(F.posexplode("source").alias("nr", "source"))
    deals = (
        tree.select("shard", F.posexplode("quotas").alias("nr", "quota"))
        .groupBy("nr")
        .agg(F.sort_array(F.collect_list(F.struct("shard", "quota"))).alias("deal"))
        .select("nr", F.flatten(F.transform("deal", lambda d: F.array_repeat(d["shard"], d["quota"].cast("int")))).alias("deal"))
        .join(order, "nr")
        .select("source", "deal")
    )
    items = chosen.select("source", F.explode("blocks").alias("b")).select(
        "source", "b.*", F.explode(F.when(F.col("b.copies") > 0, F.sequence(F.lit(1), F.col("b.copies")))).alias("copy")
    )
    ranked = items.groupBy("source").agg(
        F.sort_array(
            F.collect_list(
                F.struct(F.xxhash64(F.lit(SEED + 1), "source", "class", "bin", "copy").alias("place"), "class", "bin")
            )
        ).alias("items")
    )
    dealt = (
        ranked.join(deals, ranked["source"].eqNullSafe(deals["source"]))
        .select(ranked["source"], F.explode(F.arrays_zip("items", "deal")).alias("item"))
        .groupBy("source", F.col("item.items.class").alias("class"), F.col("item.items.bin").alias("bin"))
        .agg(F.sort_array(F.collect_list("item.deal")).alias("shards"))
    )
    dealt = staged(dealt.select(F.col("source").alias("_of"), F.col("class").alias("_in"), F.col("bin").alias("_at"), F.col("shards").alias("_shards")), "dealt")
    return sizes, dealt, chosen.select(F.col("source").alias("name"), "source_size", "target")


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    shards: int = SHARDS,
    bins: int = BINS,
) -> DataFrame:
    """The mixed documents: a row with all columns per copy, and the columns `shard` and `copy` of the mix.

    Rows are dealt out by shard and shuffled by hash within each: the one shuffle that texts go through. A clashing
    column `shard` or `copy` of the input is replaced.
    """
    _, dealt, _ = _deal(docs, key, text, source, weights, share, most, shards, bins)
    rows = docs.drop("shard", "copy")
    copies = _with_shards(_placed(rows, key, text, source, bins), dealt).select(
        *[F.col(f"`{c}`") for c in rows.columns], "_print", F.posexplode("_shards").alias("copy", "shard")
    )
    return (
        copies.repartition(F.col("shard"))
        .sortWithinPartitions("shard", F.xxhash64(F.lit(SEED + 2), "_print", "copy"))
        .drop("_print")
    )


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_plan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return plan.select(F.col("key").alias("doc_id"), "source", "size", "source_size", "target", "taken", "shards")
