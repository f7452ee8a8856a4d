import hashlib
import random
import zlib

from oracle import compare, database

from sluiceway.llm import prefixes

SF = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_query_gives_what_sql_gives(spark):
    assert compare(prefixes.op13_prefixes(spark, SF), database(SF), prefixes.OP13_SQL) is None


def plain(rows):
    """The trie by plain Python, from (conv, turn, role, text)."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs.setdefault(c, []).append((turn is not None, turn or 0, digest, (role, text)))
    convs = {c: [t[3] for t in sorted(ts)] for c, ts in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        built[c] = convs.get(base, [])[:h] + own[h:]
    nodes = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    out = []
    for key, members in nodes.items():
        below = {k: m for k, m in nodes.items() if k[: len(key)] == key}
        kids = lambda k: [x for x in nodes if len(x) == len(k) + 1 and x[:-1] == k]
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(key))
        out.append((min(members), len(key), min(nodes[key[:-1]]) if key else None, len(members), len(kids(key)), sum(not kids(k) for k in below),
                    sum((len(m) - 1) * len(k[-1][1].encode()) for k, m in below.items() if k), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows):
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, node string")
    return sorted([tuple(r[c] for c in COLUMNS) for r in prefixes.prefix_trie(table).collect()], key=str)


def test_small_tables_against_plain_python(spark):
    rng = random.Random(7)
    rows = [(c, t, rng.choice(["user", None, "u"]), rng.choice(["hi", "", "é", None, "b"])) for c in list(range(-11, 25)) + [1003, 2004] for t in range(rng.randrange(14))]
    rows += [(7, None, "user", "first"), (7, 3, "user", "tie"), (7, 3, "user", "tie"), (None, 0, "user", "nowhere"), (None, 1, None, None)]
    rows += [(c, t, "user", f"copy {t}") for c in range(30, 50) for t in range(12)]
    rng.shuffle(rows)
    assert got(spark, rows) == plain(rows)


def test_long_conversations_and_many_ends(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "PIECE", 3)
    monkeypatch.setattr(prefixes, "HEAVY", 0.02)
    rows = [(c, t, "user", f"t{t}" if t < 120 else f"t{t} {c % 3}") for c in (0, 5, 6, 10) for t in range(150)]
    rows += [(c, 0, "user", "one turn") for c in range(100, 140)] + [(300, 0, "user", "é" * 200_000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = got(spark, rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == plain(rows)


def test_edges(spark):
    assert got(spark, []) == []
    assert got(spark, [(None, 0, "user", "x")]) == []
    assert got(spark, [(11, 0, "user", "x")]) == plain([(11, 0, "user", "x")])
