"""Embedding near-duplicates by cross-polytope hashing after fast Hadamard rotations.

A hash rotates a vector by three rounds of random signs and a Hadamard transform, and takes the coordinate of largest
size, with its sign. `WIDTH` hashes make a bucket, `TABLES` buckets are made per vector. A vector lies in the bucket of
its best coordinates and also probes those with one coordinate replaced by the second best. Vectors that meet in a
bucket are verified by their cosine in double precision.

Equal vectors are one class, so copies are never compared. Classes of a bucket are compared as matrices inside a task,
and a pair counts in the first table and bucket where it meets, so links come out as counts per class and as the links
of a spanning forest: rows grow with the classes, not with the pairs. A large bucket is cut into blocks, each pair of
blocks in a task of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm.shared import components, staged

TABLES, WIDTH, SEED = 8, 2, 29
COSINE = 0.93
# Classes of a block: a task compares at most about two blocks at once.
BLOCK = 1024


def _hadamard(x: np.ndarray) -> np.ndarray:
    """Hadamard transform of rows whose length is a power of two."""
    step = 1
    while step < x.shape[1]:
        parts = x.reshape(len(x), -1, 2, step)
        x = np.stack([parts[:, :, 0] + parts[:, :, 1], parts[:, :, 0] - parts[:, :, 1]], axis=2).reshape(len(x), -1)
        step *= 2
    return x


def codes(vectors: np.ndarray, tables: int, width: int) -> np.ndarray:
    """Best and second best signed coordinate per table and hash: shape (rows, tables, width, 2)."""
    size = 1 << max(1, (vectors.shape[1] - 1).bit_length())
    padded = np.zeros((len(vectors), size))
    padded[:, : vectors.shape[1]] = vectors
    out = np.empty((len(vectors), tables, width, 2), np.int32)
    for table in range(tables):
        for k in range(width):
            signs = np.random.default_rng((SEED, size, table, k)).choice([-1.0, 1.0], (3, size))
            x = padded
            for s in signs:
                x = _hadamard(x * s) / np.sqrt(size)
            rows = np.arange(len(x))
            magnitude = np.abs(x)
            for place in range(2):
                at = magnitude.argmax(axis=1)
                out[:, table, k, place] = np.where(x[rows, at] < 0, at + size, at)
                magnitude[rows, at] = -1
    return out


def _hashed(tables: int, width: int):
    """Rows (node, label, vector) to (node, label, dim, codes as bytes, unit vector as bytes)."""

    def run(batches):
        for batch in batches:
            lengths = np.array([len(v) for v in batch.column(2)], np.int64)
            node, label = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            for dim in np.unique(lengths):
                at = np.flatnonzero(lengths == dim)
                rows = batch.column(2).take(pa.array(at))
                flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), -1)
                # By the largest first, so that no square is lost to overflow or underflow.
                flat = flat / np.abs(flat).max(axis=1, keepdims=True)
                unit = flat / np.sqrt((flat * flat).sum(axis=1, keepdims=True))
                found = codes(unit, tables, width)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(node[at]),
                        label.take(pa.array(at)),
                        pa.array(np.full(len(at), dim, np.int32)),
                        pa.array(found.reshape(len(at), tables, -1).tolist(), pa.list_(pa.list_(pa.int32()))),
                        pa.array([x.tobytes() for x in unit], pa.binary()),
                    ],
                    names=["node", "label", "dim", "codes", "unit"],
                )

    return run


def _meets(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of codes, per table: do they share the bucket, and does b probe a's bucket."""
    best = a[..., 0] == b[..., 0]
    same = best.all(axis=-1)
    other = a[..., 0] == b[..., 1]
    probes = np.zeros_like(same)
    for k in range(best.shape[-1]):
        rest = np.ones_like(same)
        for j in range(best.shape[-1]):
            rest &= other[..., j] if j == k else best[..., j]
        probes |= rest
    return same, probes


def _compare(rows: dict[str, np.ndarray], cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one run that are linked and meet here first."""
    role, place, node, table = rows["role"], rows["place"], rows["node"], int(rows["table"][0])
    index = np.flatnonzero(role == 0)
    if not len(index) or len(node) < 2:
        return index[:0], index[:0]
    near = rows["unit"][index] @ rows["unit"].T >= cosine
    i, j = np.nonzero(near)
    i = index[i]
    fits = node[i] != node[j]
    if rows["lo"][0] != rows["hi"][0]:
        fits &= place[i] != place[j]
    i, j = i[fits], j[fits]
    same, probes = _meets(rows["codes"][i], rows["codes"][j])
    _, back = _meets(rows["codes"][j], rows["codes"][i])
    before = (same | probes | back)[:, :table].any(axis=1)
    smaller = node[i] < node[j]
    # In the bucket both lie in, the smaller comes first; else where one probes the other's, the smaller's if both do.
    here = np.where(role[j] == 0, same[:, table] & smaller, ~same[:, table] & probes[:, table] & (smaller | ~back[:, table]))
    fits = here & ~before
    return i[fits], j[fits]


def _links_of_runs(tables: int, width: int, cosine: float):
    """Over rows sorted by run: links (a, b) of forests with n NULL, and (a, NULL, n): n more vectors linked with a."""

    def compared(rows: dict[str, np.ndarray], out: list) -> None:
        i, j = _compare(rows, cosine)
        if not len(i):
            return
        nodes, weights = rows["node"], rows["weight"]
        both, partner = np.r_[i, j], np.r_[j, i]
        which, inverse = np.unique(nodes[both], return_inverse=True)
        total = np.bincount(inverse, weights=weights[partner]).astype(np.int64)
        out += [(int(a), None, int(n)) for a, n in zip(which, total)]
        parent = {}

        def top(x):
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        for a, b in zip(nodes[i].tolist(), nodes[j].tolist()):
            if (x := top(a)) != (y := top(b)):
                parent[x] = y
                out.append((a, b, None))

    def run(batches):
        names = ["run", "table", "lo", "hi", "role", "place", "node", "weight"]
        held, last = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
            units, found = batch.column("unit"), batch.column("codes")
            starts = np.flatnonzero(np.r_[True, columns["run"][1:] != columns["run"][:-1]])
            ends = np.r_[starts[1:], batch.num_rows]
            out = []
            for s, e in zip(starts.tolist(), ends.tolist()):
                part = {n: columns[n][s:e] for n in names}
                part["unit"] = np.frombuffer(b"".join(units[s:e].to_pylist()), np.float64).reshape(e - s, -1)
                flat = found.slice(s, e - s).flatten().flatten().to_numpy(zero_copy_only=False)
                part["codes"] = flat.reshape(e - s, tables, width, 2)
                if held and last != part["run"][0]:
                    compared(held[0] if len(held) == 1 else {n: np.concatenate([h[n] for h in held]) for n in held[0]}, out)
                    held = []
                last = part["run"][0]
                held.append(part)
            yield _rows(out)
        if held:
            out = []
            compared(held[0] if len(held) == 1 else {n: np.concatenate([h[n] for h in held]) for n in held[0]}, out)
            yield _rows(out)

    def _rows(out: list) -> pa.RecordBatch:
        columns = list(zip(*out)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "n"])

    return run


def embedding_groups(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cosine: float = COSINE,
    tables: int = TABLES,
    width: int = WIDTH,
    block: int = BLOCK,
) -> DataFrame:
    """One row (key, n_links, component_id, kept) per row of `vectors`.

    Vectors are linked when their labels are equal and not NULL, their lengths are equal, they meet in a bucket, and
    their cosine is at least `cosine`. Equal vectors are linked without meeting. A vector that is NULL, empty, zero, or
    has a NULL or non-finite component links with nothing, nor does one with a NULL key or label: 0 links, its own
    component, kept. Rows that repeat a key count as vectors of their own, whether their vectors are equal or not. Other columns are ignored; an empty table gives an empty result.
    """
    numbers = F.transform(F.col(vector), lambda x: x.cast("double"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall("vector", lambda x: x == 0.0)
    rows = staged(
        vectors.select(F.col(key).cast("long").alias("key"), numbers.alias("vector"), F.col(label).cast("string").alias("label")).withColumn(
            "vector", F.when(F.col("key").isNotNull() & F.col("label").isNotNull() & ~bad & ~zero, F.col("vector"))
        ),
        "vectors",
    )
    whole = rows.where("vector is not null")
    # A class is all rows of one label and vector. Keys may repeat, so classes are numbered, and keys come back at the end.
    same = whole.groupBy("label", "vector").agg(F.min("key").alias("smallest"), F.count(F.lit(1)).alias("weight"))
    classes = staged(same.withColumn("node", F.monotonically_increasing_id()), "classes")
    hashed = staged(
        classes.select("node", "label", "vector").mapInArrow(
            _hashed(tables, width), "node long, label string, dim int, codes array<array<int>>, unit binary"
        ),
        "hashed",
    )
    # Flat codes of a table: best and second best of each hash. Role 0 lies in the bucket, role 1 probes it.
    best = [F.col("code")[2 * k] for k in range(width)]
    buckets = [F.struct(F.lit(0).alias("role"), F.xxhash64("label", "dim", "nr", *best).alias("bucket"))]
    for k in range(width):
        probe = [F.col("code")[2 * j + (j == k)] for j in range(width)]
        buckets.append(F.struct(F.lit(1).alias("role"), F.xxhash64("label", "dim", "nr", *probe).alias("bucket")))
    spots = (
        hashed.select("node", "label", "dim", F.posexplode("codes").alias("nr", "code"))
        .select("node", F.col("nr").alias("table"), F.explode(F.array(*buckets)).alias("spot"))
        .select("node", "table", "spot.role", "spot.bucket")
    )
    spots = staged(spots, "spots")
    # Only buckets that several classes share, one of them lying in it, are of use.
    sizes = staged(
        spots.groupBy(F.col("bucket").alias("of"))
        .agg(F.count(F.lit(1)).alias("rows"), F.min("role").alias("least"))
        .where("rows > 1 and least = 0")
        .select("of", F.ceil(F.col("rows") / F.lit(block)).cast("int").alias("blocks")),
        "buckets",
    )
    dealt = (
        spots.join(sizes, F.col("bucket") == F.col("of"))
        .withColumn("place", F.pmod(F.xxhash64("node", "bucket"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("lo", F.least("place", "other"))
        .withColumn("hi", F.greatest("place", "other"))
        .select("node", "table", "role", "place", "lo", "hi", F.xxhash64("bucket", "lo", "hi").alias("run"))
    )
    about = hashed.join(classes.select(F.col("node").alias("of"), "weight"), F.col("node") == F.col("of")).select(
        F.col("node").alias("class"), "weight", "codes", "unit"
    )
    found = staged(
        dealt.join(about, F.col("node") == F.col("class"))
        .select("run", "table", "lo", "hi", "role", "place", "node", "weight", "codes", "unit")
        .repartition("run")
        .sortWithinPartitions("run")
        .mapInArrow(_links_of_runs(tables, width, cosine), "a long, b long, n long"),
        "links",
    )
    counts = found.where("n is not null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("more"))
    roots = components(found.where("b is not null").select("a", "b"))
    numbered = staged(
        classes.join(counts, "node", "left")
        .join(roots, "node", "left")
        .select(
            "label", "vector", "smallest", "root", (F.col("weight") - 1 + F.coalesce("more", F.lit(0))).alias("n_links")
        ),
        "numbered",
    )
    # Components with more than a thousandth of these classes are at most a thousand, and are known everywhere.
    tops = numbered.where("root IS NOT NULL").groupBy(F.col("root").alias("top")).agg(F.min("smallest").alias("component_id"), F.count("*").alias("n"))
    tops = staged(tops, "tops")
    large = F.col("n") > (tops.agg(F.sum("n")).first()[0] or 0) / 1000
    of_large = numbered.join(F.broadcast(tops.where(large)), F.col("root") == F.col("top"), "left")
    rest = of_large.where("root IS NOT NULL AND top IS NULL").select(*numbered.columns).join(tops.where(~large), F.col("root") == F.col("top"))
    named = of_large.where("root IS NULL OR top IS NOT NULL").unionByName(rest).select(
        F.col("label").alias("l"), F.col("vector").alias("v"), "n_links", F.coalesce("component_id", "smallest").alias("component_id")
    )
    linked = whole.join(named, (F.col("label") == F.col("l")) & (F.col("vector") == F.col("v"))).select("key", "n_links", "component_id")
    alone = rows.where("vector is null").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    return linked.union(alone).select(
        F.col("key").alias(key), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept")
    )


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
