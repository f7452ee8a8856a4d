import hashlib
import re
import zlib

import pytest
import regex

from sluiceway.llm import pii

SF = "/root/testdata/sf0.01"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def right(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        each = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(e - 9 * (e > 9) for e in each) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    return sorted((m.start(), nr, m.end()) for nr, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if right(kind, m.group()))


def digest(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_query_gives_what_brute_force_gives(spark):
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = 0
    for r in pii.op4_pii(spark, SF).collect():
        want = brute(docs[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == nr for _, k, _ in want) for nr in range(4)]
        assert r.base_sha256 == hashlib.sha256(digest(want).encode()).hexdigest()
        assert not want or set(digest(want).split(",")) <= set(r.spans.split(","))
        found += len(want)
    assert found > 20


TRICKY = [
    "a@b.c_d@e.f a@b.c@d.e x@y z@.a %@-.- a@b..c a.@b.c \u00e9a@b.c\u00e9 @a.b ..a@b.c",
    "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.255 1..2.3.4 99999999999999999999.1.1.1 \u00b2 12.3.4.5\U0001f600 6.7.8.9",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 41111111111111112 0000000000000000 5500005555555559 30569309025904 1 22",
    "+1 (836) 555-9331 +12 +1234567890. ++1 2 3 4 5 6 7 8 9 0 - +1234567890123456 +1\n234567890 +1 (569) 555-6633 4795326016703902 53.121.55.90",
    "mail 4913187196670932 53.121.55.90 +49 30 1234567 a@b.cd", "", None, "no data here",
]


def test_edges(spark):
    rows = [(i, t) for i, t in enumerate(TRICKY)] + [(50, TRICKY[0]), (50, TRICKY[0]), (None, TRICKY[1])]
    rows += [(60, "1" * 50000), (61, "a" * 50000 + "@" + "b." * 20000), (62, "1.2.3.4 " * 3000), (63, "+" + "1 " * 20000 + "x"), (64, "1-" * 30000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, spans int")
    got = pii.pii_spans(docs).collect()
    assert len(got) == len(rows)
    by_key = {r.doc_id: r for r in got}
    for k, t in rows:
        base = [(s.start, s.kind, s.end) for s in by_key[k].base]
        assert base == brute(t), (k, (t or "")[:80])
        spans = [(s.start, s.kind, s.end) for s in by_key[k].spans]
        assert set(base) <= set(spans) and spans == sorted(spans)
    assert pii.pii_spans(docs.limit(0)).count() == 0


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "to a@b.cd, 53.121.55.90.", 1), (2, None, 1), (3, "call +1 (836) 555-9331, 4111 1111 1111 1111", 1), (4, "clean", 1)], "doc_id long, text string, kind int")
    got = pii.redacted(docs)
    assert got.columns == docs.columns
    assert {r.doc_id: r.text for r in got.collect()} == {1: "to [EMAIL], [IP].", 2: None, 3: "call [PHONE], [CARD]", 4: "clean"}


def plain_bins(kind, m, text, low, high):
    """The features of a candidate in plain Python; what is around it reaches from `low` to `high`."""
    before, after, match = text[max(low, m.start() - 24) : m.start()].lower(), text[m.end() : min(high, m.end() + 8)], m.group()
    if kind == "email":
        match = re.sub(r"\x20?[\(\[]dot[\)\]]\x20?", ".", re.sub(r"\x20?(?:@|[\(\[]at[\)\]])\x20?", "@", match))
    if kind == "phone":
        match = re.sub(r"^\+([0-9]{1,3}([\x20.-]+|(?=\()))?", "", match)
    digits, marks = len(re.sub("[^0-9]", "", match)), len(re.sub("[A-Za-z0-9]", "", match))
    side = lambda alnum, mark, t: 2 if re.search(alnum, t) else int(bool(re.search(mark, t)))
    email = kind == "email"
    return {
        "kind": pii.KINDS.index(kind),
        "digits": 0 if email else min(digits, 20),
        "marks": 0 if email else min(marks, 6),
        "dots": int(bool(re.search(r"@[^.]+\.", match))) if email else min(match.count("."), 4),
        "open": int("(" in match),
        "blank": int(" " in match),
        "left": side(r"[0-9A-Za-z]\Z", r"[.+(/:-]\Z", before),
        "right": side("^[0-9A-Za-z]", "^[/:-]", after),
        "named": int(bool(re.search(pii.NAMED[:-1] + r"\Z", before))),
        "whole": int(all(re.fullmatch("[0-9]+", p) and int(p) <= 255 for p in match.split("."))) if kind == "ip" else 1,
    }


def plain_spans(texts):
    """All spans of each text: candidates scored by the same trees, walked in plain Python."""
    cells, found = {}, []
    for text in texts:
        base, own = brute(text), []
        held = zlib.crc32((text or "").encode()) % pii.HELD_OUT == 0
        for kind in pii.KINDS:
            all_of = list(regex.finditer(pii.WIDE[kind], text or ""))
            lows, highs = [0, *(m.start() for m in all_of)], [*(m.end() for m in all_of[1:]), len(text or "")]
            for m, low, high in zip(all_of, lows, highs):
                bins = plain_bins(kind, m, text, low, high)
                label = (m.start(), bins["kind"], m.end()) in base
                count = cells.setdefault(tuple(bins.values()), [0, 0])
                count[held] += label
                own.append((m.start(), bins["kind"], m.end(), bins))
        found.append((base, own))
    model = pii.boosted([(dict(zip(pii.FEATURES, c)), *n) for c, n in sorted(cells.items())])
    for base, own in found:
        spans, to = list(base), 0
        for a, k, b, bins in sorted(own, key=lambda c: c[:3]):
            score = sum(t.value(bins) for t in model.trees)
            if score < model.thresholds.get(k, float("inf")) or any(x < b and a < y for x, _, y in base) or a < to:
                continue
            spans.append((a, k, b))
            to = b
        yield sorted(spans)


def test_added_spans_are_those_of_plain_scoring(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    texts = {d.doc_id: d.text for d in docs} | {-1 - i: t for i, t in enumerate(TRICKY)}
    texts |= {-90: "tel (836) 555-9331, (836) 555-9332; aa:bb:cc:dd:ee:ff 300.1.1.1 a [at] b [dot] cd"}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: [(s.start, s.kind, s.end) for s in r.spans] for r in pii.pii_spans(frame).collect()}
    added = 0
    for (key, text), want in zip(texts.items(), plain_spans(texts.values())):
        assert got[key] == want, (key, (text or "")[:80])
        added += len(want) - len(brute(text))
    assert added > 5
    assert (4, 3, 18) in got[-90] and (20, 3, 34) in got[-90]


@pytest.mark.parametrize(("base", "rows"), [(1, 1), (19, 1), (20, 1), (300, 5), (300, 19), (300, 500)])
def test_a_format_has_one_verdict_whatever_its_rows(spark, base, rows):
    """Numbers without a country code are added beside those with one, and plain numbers never, by looks and not by count."""
    good = [f"tel +1 (8{i % 90 + 10}) 555-{1000 + i}" for i in range(base)]
    near = [f"tel (8{i % 90 + 10}) 555-{1000 + i}" for i in range(rows)]
    texts = good + near + ["room 12345678"] * 40 + ["rate 1234567.89"] * rows
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    spans = {r.doc_id: r.spans for r in pii.pii_spans(docs).collect()}
    marked = {i for i, s in spans.items() if s}
    assert marked == set(range(base + rows)), (base, rows)


@pytest.mark.parametrize("count", [0, 1])
def test_nothing_to_learn_from(spark, count):
    docs = spark.createDataFrame([(1, "phone 123 456 789"), (2, "x")][:count], "doc_id long, text string")
    assert [r.spans for r in pii.pii_spans(docs).collect()] == [[]] * count
