from itertools import combinations

from oracle import compare, database

from sluiceway.llm import decontaminate
from sluiceway.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_query_gives_what_its_oracle_gives(spark):
    assert compare(QUERIES["op8_overlaps"](spark, SF), database(SF), ORACLES["op8_overlaps"]) is None


def test_masks_miss_no_window():
    window, errors = decontaminate.WINDOW, decontaminate.ERRORS
    for wrong in combinations(range(window), errors):
        assert any(
            not {at + x for x in mask} & set(wrong) for mask in decontaminate.MASKS for at in range(window - mask[-1])
        )


def test_replaced_words(spark):
    item = [f"t{i}" for i in range(20)]

    def text(replaced, part=slice(0, 20)):
        return " ".join(["some", "words"] + ["X" if i in replaced else w.upper() for i, w in enumerate(item)][part] + ["after"])

    rows = [(i, text(wrong, slice(3, 16))) for i, wrong in enumerate(combinations(range(3, 16), 2))]
    clean = [(1000 + i, text(wrong)) for i, wrong in enumerate(range(first, 20, 4) for first in range(4))]
    clean += [(1100, " ".join(item[:12])), (1101, " ".join(item[:6] + ["put in"] + item[6:11])), (1102, "s1 s2 s3 s4 X s6")]
    docs = spark.createDataFrame(rows + clean + [(2000, "s1 s2 s3 s4 s5 s6 s7"), (2001, "a s1  s2 S3\ns4 s5 s6 s7 b")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, " ".join(item)), (8, "s1 s2 s3 s4 s5 s6 s7"), (9, "too short this")], "item_id long, text string")
    got = {r.doc_id: r.overlaps for r in decontaminate.overlaps(docs, benchmark).collect()}
    assert all(len(got[k]) == 1 and got[k][0].start <= 2 and got[k][0].end >= 15 and got[k][0].equal == 11 for k, _ in rows)
    assert all(not got[k] for k, _ in clean)
    assert got[2000][0][:4] == (8, 0, 7, 7) and got[2001][0][:4] == (8, 1, 8, 7)
    kept = decontaminate.decontaminated(docs, benchmark)
    assert sorted(r.doc_id for r in kept.collect()) == [k for k, _ in clean]


def test_edges(spark):
    item = " ".join(f"t{i}" for i in range(15))
    rows = [(1, None), (2, ""), (3, item), (3, item), (None, item), (5, "x " * 200000 + item), (6, (item + " ") * 300)]
    docs = spark.createDataFrame([(*r, "keep") for r in rows], "doc_id long, text string, item string")
    tests = spark.createDataFrame([(1, item), (1, item), (None, item), (3, None), (4, "")], "item_id long, text string")
    got = decontaminate.overlaps(docs, tests)
    assert got.columns == ["doc_id", "text", "item", "overlaps"]
    found = [(r.doc_id, len(r.overlaps)) for r in got.collect()]
    assert sorted(found, key=str) == sorted([(1, 0), (2, 0), (3, 2), (3, 2), (None, 2), (5, 2), (6, 600)], key=str)
    assert decontaminate.decontaminated(docs, tests.limit(0)).count() == len(rows)
    assert decontaminate.overlaps(docs.limit(0), tests).count() == 0
    assert decontaminate.decontaminated(docs.drop("item"), tests).columns == ["doc_id", "text"]
