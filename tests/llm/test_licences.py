import random
import re
import time

import pytest
import regex

from sluiceway.llm import licences

SF = "/root/testdata/sf0.001"


def brute(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places, labels = [], set()
    for label, phrase in licences.PHRASES.items():
        for i in range(len(words)):
            if tuple(words[i : i + len(phrase)]) == phrase:
                places.append(i)
                labels.add(label)
    fuzzy = {
        label for label, notice in licences.NOTICES
        if regex.search(f"(?:{regex.escape(notice)}){{e<={licences.errors_allowed(notice)}}}", lower)
    }
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | fuzzy))


def test_query_gives_what_brute_force_gives(spark):
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in licences.op6_licences(spark, SF).collect()}
    assert sorted(got) == sorted(docs)
    short = [k for k in docs if len(docs[k]) < 3000]
    assert len(short) > 100
    for k in docs:
        r = got[k]
        if k in short:
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == brute(docs[k])
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    assert any(r.labels for r in got.values())


def test_every_error_within_the_bound_is_found():
    rng, scanner = random.Random(4), licences.Scanner(licences.NOTICES, licences.PHRASES)
    for label, notice in licences.NOTICES:
        for _ in range(30):
            letters = list(notice)
            for _ in range(rng.randint(0, licences.errors_allowed(notice))):
                at = rng.randrange(len(letters))
                letters[at : at + 1] = rng.choice([[], ["z"], [letters[at], "z"]])
            text = "xx " * rng.randrange(30) + "".join(letters) + " yy" * 5
            found = [f for f in scanner.notices_in(text) if f.label == label]
            assert found, (notice, text)
            assert max(f.score for f in found) >= 1 - licences.errors_allowed(notice) / len(notice)


@pytest.mark.parametrize(
    ("text", "hits"),
    [
        ("licensed under a creatve commons and licensed under a creative commons", ["licensed under a creatve commons", "licensed under a creative commons"]),
        ("licensed under a creative commons and licensed under a creatve commons", ["licensed under a creative commons", "licensed under a creatve commons"]),
        ("all rights reservd x all rights reserved", ["all rights reservd", "all rights reserved"]),
        ("all rights reserved x all rights reservd", ["all rights reserved", "all rights reservd"]),
        ("all rights reserved" * 3, ["all rights reserved"] * 3),
    ],
)
def test_every_hit_is_found_whatever_the_order(text, hits):
    found = sorted(licences.Scanner(licences.NOTICES, licences.PHRASES).notices_in(text), key=lambda f: f.start)
    assert [text[f.start : f.end].strip(" x") for f in found] == hits


def test_planted_hits_are_all_found_and_never_overlap():
    rng, scanner = random.Random(8), licences.Scanner(licences.NOTICES, licences.PHRASES)
    for _ in range(40):
        label, notice = rng.choice(licences.NOTICES)
        text, planted = "", []
        for _ in range(rng.randrange(1, 6)):
            text += rng.choice(["", "some words. ", "licensed under ", "all rights "])
            letters = list(notice)
            for _ in range(rng.randint(0, max(1, licences.errors_allowed(notice) // 2))):
                letters[rng.randrange(len(letters))] = "z"
            planted.append((len(text), len(text) + len(notice)))
            text += "".join(letters) + " -- "
        found = sorted((f.start, f.end) for f in scanner.notices_in(text) if f.label == label)
        assert all(any(a < end and start < b for a, b in found) for start, end in planted), (text, found)
        assert all(x[1] <= y[0] for x, y in zip(found, found[1:])) or len({n for lb, n in licences.NOTICES if lb == label}) > 1


@pytest.mark.parametrize("seed", ["permission ", "licensed under ", "redistribution and use "])
def test_texts_full_of_seeds_take_little_time(seed):
    scanner = licences.Scanner(licences.NOTICES, licences.PHRASES)
    start = time.perf_counter()
    assert list(scanner.notices_in(seed * 20_000)) == []
    assert time.perf_counter() - start < 3


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "MIT, License! mit\n\nlicense"), (3, "MIT, License! mit\n\nlicense"), (4, "submit license; mit licenses"), (None, "the \u00c9 all rights reservd"),
            (5, "a " * 300000 + "general public license"), (6, "all rights reserved " * 3000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, labels int")
    got = licences.license_scan(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(t for k, t in rows if k == r.key)
        if r.key != 5:
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == brute(text)
    by_key = {r.key: r for r in got}
    assert by_key[5][1:6] == (300003, 1, 300000, 300000, "gpl")
    assert len(by_key[6].spans) == 3000
    one = by_key[None].spans[0]
    assert rows[5][1][one.start : one.end] == "all rights reservd" and by_key[None].labels == "proprietary"
    assert licences.license_scan(docs.limit(0)).count() == 0
