"""Prefix trie of conversations, built by the recursion of van Emde Boas.

Sequences of turns are cut at half their depth. The first halves make the upper trie; what follows each cut prefix makes
the lower tries below it; both are cut again in the same way. All pieces of one size are worked on at once, as rows: names
of pieces grow from turns to whole halves on the way up, cut prefixes are named on the way down, and then the totals of
lower tries are grafted onto the upper ones, small pieces first. There are as many rounds as the depth has binary digits,
and no row ever holds a whole conversation.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluiceway.llm.shared import staged

# Conversations of a family share the first turns of the one whose number FAMILY divides; at most MOST - 1 of them.
FAMILY, MOST = 5, 9
# Ends of a node that are hashed as one piece.
PIECE = 65_536
# A prefix with more than this share of all rows is looked up apart; there can't be more such prefixes than its inverse.
HEAVY = 1 / 1000


def head_of(conv: Column) -> Column:
    """How many turns a conversation takes from the first one of its family."""
    return (F.crc32(conv.cast("string").cast("binary")) % MOST).cast("long")


def turn_digest(role: Column, text: Column) -> Column:
    """128 bits that stand for a role and a text; the length of the role keeps the two apart."""
    return F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))


def _both(a: Column, b: Column) -> Column:
    return F.unhex(F.md5(F.concat(a, b)))


def ordered_turns(table: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Turns (conv, range, at, digest, bytes), where `at` rises within a conversation.

    Turns are ordered by number, NULL first, and then by digest. Rows are sorted by ranges, so that a conversation of any
    length is ordered by many tasks.
    """
    role_text, body = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = table.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        turn_digest(role_text, body).alias("digest"),
        F.octet_length(body).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("salt"),  # equal rows may fall into different ranges
    )
    order = [F.col("conv").asc(), F.col("turn").asc_nulls_first(), F.col("digest").asc(), F.col("salt").asc()]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return staged(
        rows.select("conv", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("at"), "digest", "bytes"), "turns"
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, depth, digest, bytes) and lengths (conv, length) of conversations rebuilt with the head of their family.

    The ranges of a conversation are counted apart and moved by what the ranges before hold.
    """
    ranges = staged(turns.groupBy("conv", "range").agg(F.min("at").alias("first"), F.count("*").alias("n")), "ranges")
    convs = ranges.groupBy("conv").agg(F.sum("n").alias("n"))
    own = convs.select("conv", "n", (F.col("conv") - F.col("conv") % FAMILY).alias("base"), head_of(F.col("conv")).alias("head"))
    bases = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    taken = F.least("head", F.coalesce("base_n", F.lit(0)))
    members = staged(
        own.join(bases, "base", "left").select(
            F.col("conv").alias("member"), "base", "head", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("head"), F.lit(0))).alias("length")
        ),
        "members",
    )
    # One row per range a conversation lies in, far fewer than its turns.
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = ranges.select("conv", F.col("range").alias("_range"), (before - F.col("first") + 1).alias("shift"))
    shifts = shifts.join(members, F.col("conv") == F.col("member")).select(F.col("member").alias("_conv"), "_range", "shift", "head", "taken")
    same = (F.col("conv") == F.col("_conv")) & (F.col("range") == F.col("_range"))
    placed = turns.join(shifts, same).select("conv", (F.col("at") + F.col("shift")).alias("pos"), "head", "taken", "digest", "bytes")
    tails = placed.where("pos > head").select("conv", (F.col("pos") - F.col("head") + F.col("taken")).alias("depth"), "digest", "bytes")
    first = placed.where((F.col("conv") % FAMILY == 0) & (F.col("pos") < MOST)).select(F.col("conv").alias("base"), "pos", "digest", "bytes")
    heads = first.join(members, "base").where(F.col("pos") <= F.col("taken"))
    heads = heads.select(F.col("member").alias("conv"), F.col("pos").alias("depth"), "digest", "bytes")
    return heads.union(tails), members.select(F.col("member").alias("conv"), "length")


def named_prefixes(turns: DataFrame, longest: int) -> DataFrame:
    """(conv, depth, prefix): a name for the first `depth` turns of every conversation, equal for equal turns.

    On the way up, pieces of 1, 2, 4, ... turns are named by their halves. On the way down, a piece is cut in the middle:
    the prefix that ends there is named by the prefix before the piece and by the name of the piece's upper half.
    """
    pieces = [turns.select("conv", (F.col("depth") - 1).alias("piece"), F.col("digest").alias("name"))]
    while 1 << len(pieces) <= longest:
        half = pieces[-1].groupBy("conv", F.floor(F.col("piece") / 2).alias("piece")).agg(
            F.max(F.when(F.col("piece") % 2 == 0, F.col("name"))).alias("left"),
            F.max(F.when(F.col("piece") % 2 == 1, F.col("name"))).alias("right"),
        )
        pieces.append(staged(half.where("right IS NOT NULL").select("conv", "piece", _both(F.col("left"), F.col("right")).alias("name")), "pieces"))
    named: list[DataFrame] = []
    for level in reversed(range(len(pieces))):
        size = 1 << level
        upper = pieces[level].where(F.col("piece") % 2 == 0).select(
            "conv", (F.col("piece") * size).alias("before"), ((F.col("piece") + 1) * size).alias("depth"), "name"
        )
        cut = upper.where("before = 0").select("conv", "depth", _both(F.lit(b""), F.col("name")).alias("prefix"))
        if named:
            above = reduce(DataFrame.union, named).select("conv", F.col("depth").alias("before"), "prefix")
            cut = cut.union(
                upper.join(above, ["conv", "before"]).select("conv", "depth", _both(F.col("prefix"), F.col("name")).alias("prefix"))
            )
        named.append(staged(cut, "prefixes"))
    return reduce(DataFrame.union, named)


def _classes(prefixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (node, depth, n_convs) named by their smallest conversation, and (conv, depth, node, n_convs) of all conversations."""
    found = prefixes.groupBy("depth", "prefix").agg(F.min("conv").alias("node"), F.count("*").alias("n_convs"))
    found = staged(found, "classes")
    rows = found.agg(F.coalesce(F.sum("n_convs"), F.lit(0))).first()[0]
    key = [F.col("depth").alias("_depth"), F.col("prefix").alias("_prefix"), "node", "n_convs"]
    heavy = F.col("n_convs") > HEAVY * rows
    same = (F.col("depth") == F.col("_depth")) & (F.col("prefix") == F.col("_prefix"))
    first = prefixes.join(F.broadcast(found.where(heavy).select(*key)), same, "left")  # 1,000 rows at most
    first = staged(first.select("conv", "depth", "prefix", "node", "n_convs"), "heavy")
    rest = first.where("node IS NULL").select("conv", "depth", "prefix").join(found.where(~heavy).select(*key), same)
    members = first.where("node IS NOT NULL").select("conv", "depth", "node", "n_convs").union(rest.select("conv", "depth", "node", "n_convs"))
    return found.select("node", "depth", "n_convs"), staged(members, "members")


def _grafted(nodes: DataFrame, members: DataFrame, deepest: int) -> DataFrame:
    """(node, depth, leaves, saved) with totals over subtrees, from rows with what each node has itself.

    Pieces of 2, 4, 8, ... levels: the totals of the nodes in the middle of a piece, over its lower half, are added to
    the nodes above them in its upper half.
    """
    size = 1
    while size <= deepest:
        cut = nodes.where((F.col("depth") > 0) & (F.col("depth") % (2 * size) == size)).select(
            F.col("node").alias("conv"), "leaves", "saved", F.explode(F.sequence(F.col("depth") - size, F.col("depth") - 1)).alias("depth")
        )
        more = cut.join(members, ["conv", "depth"]).groupBy("node", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        nodes = staged(
            nodes.union(more.select("node", "depth", "leaves", "saved"))
            .groupBy("node", "depth")
            .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")),
            "grafted",
        )
        size *= 2
    return nodes


def ends_digest(ends: DataFrame) -> DataFrame:
    """(node, depth, ends_sha256) of rows (node, depth, conv): SHA-256 of a node's conversations, ascending, joined by commas.

    Sorted ranges of rows become pieces of text in many tasks; only the digest itself, which can't be divided, reads a
    node's pieces one after another, in little memory.
    """

    def pieces(batches):
        node, first, part = None, None, []

        def piece():
            names = ["node", "depth", "first", "piece"]
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, first)] + [pa.array([",".join(part)])], names=names)

        for batch in batches:
            for n, d, c in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if node is not None and ((n, d) != node or len(part) >= PIECE):
                    yield piece()
                    part = []
                if not part:
                    node, first = (n, d), c
                part.append(str(c))
        if part:
            yield piece()

    def digests(batches):
        node, state = None, None

        def done():
            return pa.RecordBatch.from_arrays(
                [pa.array([node[0]]), pa.array([node[1]]), pa.array([state.hexdigest()])], names=["node", "depth", "ends_sha256"]
            )

        for batch in batches:
            for n, d, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if (n, d) != node:
                    if node is not None:
                        yield done()
                    node, state = (n, d), hashlib.sha256(text.encode())
                else:
                    state.update(f",{text}".encode())
        if node is not None:
            yield done()

    order = ["node", "depth", "conv"]
    cut = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    cut = cut.mapInArrow(pieces, "node long, depth long, first long, piece string")
    # A node within one piece needs no further step.
    cut = staged(cut, "ends")
    several = cut.groupBy("node", "depth").agg(F.count("*").alias("pieces"), F.min("piece").alias("only"))
    single = several.where("pieces = 1").select("node", "depth", F.sha2("only", 256).alias("ends_sha256"))
    many = cut.join(several.where("pieces > 1").select("node", "depth"), ["node", "depth"], "left_semi")
    many = many.repartition("node", "depth").sortWithinPartitions("node", "depth", "first")
    return single.union(many.mapInArrow(digests, "node long, depth long, ends_sha256 string"))


def prefix_trie(table: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per node of the trie of rebuilt conversations, named by its smallest member and its depth.

    Conversations are ordered by turn, NULL first; rows of one turn by a digest of role and text, so that any order of
    the input gives the same trie. A NULL role or text is empty. Rows without a conversation number belong to none and
    are left out. Repeated rows are turns of their own. Very long conversations and texts are handled by rows and digests:
    nothing grows with one of them but the digest of the ends of a node, which is read as a stream. Other columns are
    ignored, and an empty table has no nodes.
    """
    turns, lengths = rebuilt(ordered_turns(table, conv, turn, role, text))
    turns = staged(turns, "rebuilt")
    smallest, n_all, longest = lengths.agg(F.min("conv"), F.count("*"), F.max("length")).first()
    found, members = _classes(named_prefixes(turns, longest or 0))

    root = lengths.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(smallest).cast("long").alias("node"), F.lit(n_all).alias("n_convs"))
    members = members.union(root)
    top = lengths.limit(1).select(F.lit(smallest).cast("long").alias("node"), F.lit(0).cast("long").alias("depth"), F.lit(n_all).alias("n_convs"))
    above = members.select(
        F.col("conv").alias("node"), (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"), F.col("n_convs").alias("parent_convs")
    )
    size_of = turns.select(F.col("conv").alias("node"), "depth", "bytes")
    below = found.join(above, ["node", "depth"]).join(size_of, ["node", "depth"])
    none = [F.lit(None).cast("long").alias(c) for c in ("parent", "parent_convs")] + [F.lit(0).cast("long").alias("bytes")]
    nodes = staged(below.select("node", "depth", "n_convs", "parent", "parent_convs", "bytes").union(top.select("*", *none)), "nodes")

    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children"), F.count(F.when(F.col("n_convs") == 1, 1)).alias("single")
    )
    nodes = nodes.join(children, ["node", "depth"], "left").fillna(0, ["n_children", "single"])
    nodes = staged(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes")), "counted")
    # Below a node of one conversation there is one leaf and nothing is saved: only shared nodes are grafted.
    shared = nodes.where("n_convs > 1")
    deepest = shared.agg(F.coalesce(F.max("depth"), F.lit(0))).first()[0]
    leaves = F.col("single") + F.when(F.col("n_children") == 0, 1).otherwise(0)
    totals = _grafted(shared.select("node", "depth", leaves.alias("leaves"), "saved"), members.where("n_convs > 1").drop("n_convs"), deepest)
    ends = lengths.join(members, (lengths.conv == members.conv) & (F.col("length") == F.col("depth"))).select("node", "depth", lengths.conv)
    total = totals.select("node", "depth", "leaves", F.col("saved").alias("total"))
    return (
        nodes.join(total, ["node", "depth"], "left")
        .join(ends_digest(ends), ["node", "depth"], "left")
        .select(
            F.col("node").alias(conv),
            "depth",
            F.col("parent").alias(f"parent_{conv}"),
            "n_convs",
            "n_children",
            F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"),
            F.coalesce("total", F.lit(0)).cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


def op13_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


# A checksum in SQL: the polynomial of CRC-32 over the digits of a number.
_CRC = """(SELECT c AS conv, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))) AS crc
  FROM (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL))"""
OP13_SQL = f"""
WITH head AS (SELECT conv, xor(crc, 4294967295::BIGINT) % {MOST} AS h, conv - conv % {FAMILY} AS base FROM {_CRC}),
turns AS (SELECT conv_id AS conv, md5(octet_length(encode(r)) || ':' || r || t) AS d, octet_length(encode(t)) AS bytes,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(octet_length(encode(r)) || ':' || r || t)) AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL)),
long AS (SELECT conv, count(*) AS n FROM turns GROUP BY conv),
fit AS (SELECT h.conv, h.h, h.base, least(h.h, coalesce(b.n, 0)) AS taken FROM head h LEFT JOIN long b ON b.conv = h.base),
rebuilt AS (
  SELECT f.conv, t.pos AS depth, t.d, t.bytes FROM fit f JOIN turns t ON t.conv = f.base AND t.pos <= f.taken
  UNION ALL
  SELECT f.conv, t.pos - f.h + f.taken, t.d, t.bytes FROM fit f JOIN turns t ON t.conv = f.conv AND t.pos > f.h),
paths AS (SELECT conv, depth, bytes, string_agg(d, '') OVER (PARTITION BY conv ORDER BY depth) AS p FROM rebuilt
  UNION ALL SELECT conv, 0, 0, '' FROM fit),
lengths AS (SELECT conv, max(depth) AS length FROM paths GROUP BY conv),
nodes AS (SELECT p, depth, min(conv) AS conv, count(*) AS n_convs, max(bytes) AS bytes FROM paths GROUP BY p, depth),
kids AS (SELECT a.p, count(b.p) AS n_children FROM nodes a LEFT JOIN nodes b ON b.depth = a.depth + 1 AND b.p[:length(b.p) - 32] = a.p GROUP BY a.p),
spread AS (SELECT n.p, n.n_convs, n.bytes, k.n_children, unnest(range(n.depth + 1)) AS up FROM nodes n JOIN kids k ON k.p = n.p),
totals AS (SELECT p[:32 * up] AS top, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
    sum((n_convs - 1) * bytes) AS saved FROM spread GROUP BY ALL),
ends AS (SELECT x.p, string_agg(CAST(x.conv AS VARCHAR), ',' ORDER BY x.conv) AS e FROM paths x JOIN lengths l ON l.conv = x.conv AND l.length = x.depth GROUP BY x.p)
SELECT n.conv AS conv_id, CAST(n.depth AS BIGINT) AS depth, m.conv AS parent_conv_id, n.n_convs, k.n_children,
  CAST(t.n_leaves AS BIGINT) AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.e, '')) AS ends_sha256
FROM nodes n JOIN kids k ON k.p = n.p JOIN totals t ON t.top = n.p
LEFT JOIN nodes m ON m.depth = n.depth - 1 AND n.p[:length(n.p) - 32] = m.p
LEFT JOIN ends e ON e.p = n.p
"""
