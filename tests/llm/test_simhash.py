import random

import pytest
import xxhash

from sluiceway.llm import simhash, words

SF = "/root/testdata/sf0.001"


def brute_print(text, width=4):
    words = (text or "").encode().lower().split()
    rows = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([b" ".join(words)] if words else [])
    hashed = [xxhash.xxh64_intdigest(r, seed=42) for r in rows]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashed) > len(hashed))


def brute_groups(prints, radius=4):
    """{key: (print, smallest key reachable)} of (key, print) pairs."""
    distinct = sorted(set(p for _, p in prints))
    parent = {p: p for p in distinct}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                parent[top(a)] = top(b)
    least = {}
    for key, p in prints:
        if key is not None:
            least[top(p)] = min(least.get(top(p), key), key)
    return sorted((str(k), p, least.get(top(p))) for k, p in prints)


def test_query_gives_what_brute_force_gives(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = sorted((str(r.doc_id), int(r.fingerprint, 16), r.component_id) for r in simhash.op7_simhash(spark, SF).collect())
    assert got == brute_groups([(d.doc_id, brute_print(d.text)) for d in docs])


def test_covering_masks_leave_no_pair_out():
    masks = simhash.covering_masks(4)
    rng = random.Random(1)
    for _ in range(3000):
        differing = sum(1 << i for i in rng.sample(range(64), 4))
        assert any(not (differing & mask) for mask in masks)


@pytest.mark.parametrize("block", [3, 1024])
def test_links_of_small_and_large_buckets(spark, block):
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    prints = [centre ^ sum(1 << i for i in rng.sample(range(64), rng.randrange(5))) for _ in range(60)]
    prints += [rng.getrandbits(64) for _ in range(20)]
    signed = [p - (1 << 64) if p >> 63 else p for p in set(prints)]
    links = simhash.near_links(spark, spark.createDataFrame([(p,) for p in signed], "fp long"), 4, block)
    roots = {r.node: r.root for r in simhash.components(links).collect()}
    want = brute_groups([(p, p % (1 << 64)) for p in signed])
    groups = {}
    for key, _, group in want:
        groups.setdefault(group, set()).add(int(key))
    found = {}
    for p in signed:
        found.setdefault(roots.get(p, p), set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_edges(spark):
    long_text = " ".join(f"w{i % 977}" for i in range(200_000))
    rows = [
        (1, None, "x"), (2, "", "x"), (3, " \n ", "x"), (4, "one two", "x"), (5, "ONE  two", "x"), (5, "ONE  two", "x"),
        (None, "one two", "x"), (None, "alone by itself here", "x"), (8, long_text, "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted((str(r.doc_id), r.fp % (1 << 64), r.component_id) for r in simhash.simhash_groups(docs).collect())
    assert got == brute_groups([(k, brute_print(t)) for k, t, _ in rows])
    kept = simhash.simhash_dedup(docs, width=4)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "4", "8", "None", "None"]
    assert simhash.simhash_groups(docs.limit(0)).count() == 0
    assert simhash.simhash_dedup(docs.limit(0)).count() == 0


def test_a_text_cut_into_pieces_keeps_its_fingerprint(monkeypatch):
    text = " ".join(f"w{i % 91}" for i in range(2000)).encode()
    whole = simhash.fingerprint(text, 4)
    monkeypatch.setattr(words, "PIECE", 37)
    assert simhash.fingerprint(text, 4) == whole == (lambda p: p - (1 << 64) if p >> 63 else p)(brute_print(text.decode()))
