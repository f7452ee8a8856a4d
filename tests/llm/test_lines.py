import re

import pytest
from oracle import compare, database
from pyspark.sql import functions as F

from sluiceway.llm import lines
from sluiceway.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_query_gives_what_its_oracle_gives(spark):
    assert compare(QUERIES["op2_lines"](spark, SF), database(SF), ORACLES["op2_lines"]) is None


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, before[j] + 1, before[j - 1] + (x != y)))
    return row[-1]


def brute(rows):
    words = lambda line: tuple(re.findall("[^\x20\x09-\x0D]+", line))
    seen, first = [], {}
    for k, t in rows:
        for nr, line in enumerate((t or "").split("\n")):
            seen.append((k is None, k or 0, nr, words(line)))
    for *place, w in sorted(seen):
        first.setdefault(w, place)
    out = []
    for k, t in rows:
        kept = []
        for nr, line in enumerate((t or "").split("\n")):
            w, place = words(line), [k is None, k or 0, nr]
            near = len(w) >= 5 and any(len(v) >= 5 and abs(len(v) - len(w)) < 2 and first[v] < first[w] and edits(v, w) == 1 for v in first)
            if not w or (first[w] == place and not near):
                kept.append(line)
        out.append((str(k), None if t is None else "\n".join(kept)))
    return sorted(out, key=str)


def test_edits_of_every_kind_and_place(spark):
    base = [f"b{i}" for i in range(9)]
    rows = [(0, " ".join(base))]
    for at in range(9):
        rows.append((len(rows), " ".join(base[:at] + base[at + 1 :])))
        rows.append((len(rows), " ".join([*base[:at], "new", *base[at:]])))
        rows.append((len(rows), " ".join([*base[:at], f"new{at}", *base[at + 1 :]])))
    rows += [(100, "x " + " ".join(base) + " y"), (101, " ".join(["q", *base[1:8], "r"])), (102, "a b c d"), (103, "a b c e"), (104, "a b c d f"), (105, "a b c d g\na b c d"), (106, " ".join(base[::-1]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((str(r.doc_id), r.text) for r in lines.line_dedup(docs).collect()), key=str)
    assert got == brute(rows)
    late = [(200 - k, t) for k, t in rows]
    got = sorted(((str(r.doc_id), r.text) for r in lines.line_dedup(spark.createDataFrame(late, "doc_id long, text string")).collect()), key=str)
    assert got == brute(late)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "\n \n"), (4, "one\ntwo\r\none"), (4, "one\ntwo\r\none"), (None, "two\nthree"), (6, "w " * 70000 + "\n" + "w " * 70001), (7, "w " * 70000), (8, "ab\u00a0cd\u2028x")]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, h1 int")
    got = lines.line_dedup(docs)
    assert got.columns == docs.columns
    texts = {r.h1: r.text for r in got.collect()}
    assert texts == {0: None, 1: "", 2: "\n \n", 3: "one\ntwo\r", 4: "one\ntwo\r", 5: "three", 6: "w " * 70000, 7: "", 8: rows[8][1]}
    assert lines.line_dedup(docs.limit(0)).count() == 0


@pytest.mark.parametrize("key", [None, 7])
def test_rows_of_one_key_are_told_apart_by_their_text(spark, key):
    """Lines of one number, of rows with a NULL key or one key, only go where they repeat something themselves."""
    base = [f"b{i}" for i in range(9)]
    near = " ".join([*base[:4], "new", *base[5:]])
    rows = [(1, "seen before\n" + " ".join(base)), (key, f"seen before\n{near}\nx"), (key, "own first line\nown second line of more words\ny")]
    rows += [(key, f"text {i} of many\nits line {i} with words\nand {i}") for i in range(20)]
    got = sorted(r.text for r in lines.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    # Of the many, lines within one word of another go; the first of them by the hash of its text stays.
    assert rows[0][1] in got and "x" in got and rows[2][1] in got
    many = [t.split("\n") for t in got if t not in (rows[0][1], rows[2][1], "x")]
    assert len(many) == 20 and all(f"and {t[-1][4:]}" == t[-1] and f"text {t[-1][4:]} of many" in t for t in many)
    assert sum(len(t) == 3 for t in many) == 1


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 129])
def test_running_sums(spark, n):
    row = spark.range(1).select(lines.running_sums(F.sequence(F.lit(1).cast("bigint"), F.lit(n).cast("bigint")) if n else F.array().cast("array<bigint>")).alias("s"))
    assert row.first().s == [i * (i + 1) // 2 for i in range(1, n + 1)]
