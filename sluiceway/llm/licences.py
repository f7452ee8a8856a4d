"""License scans: exact phrases, and fuzzy search for short notices.

A notice may be found with some errors (letters put in, left out or replaced). It is cut into one seed more than errors
allowed, so at least one seed of any hit stands in the text exactly. One automaton finds all seeds; around each, the
bounded-error matching of the `regex` library verifies the notice and gives its span and errors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Phrases whose words stand consecutively, by label.
PHRASES = {"mit": ("mit", "license"), "apache": ("apache", "license"), "gpl": ("general", "public", "license")}
# Notices by label, in lower case. Labels are sorted where they are joined.
NOTICES = (
    ("mit", "permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("mit", "released under the mit license"),
    ("apache", "licensed under the apache license, version 2.0"),
    ("gpl", "licensed under the gnu general public license"),
    ("gpl", "redistribute it and/or modify it under the terms of the gnu"),
    ("bsd", "redistribution and use in source and binary forms, with or without modification"),
    ("mpl", "subject to the terms of the mozilla public license"),
    ("cc", "licensed under a creative commons"),
    ("cc-by-nc", "licensed under cc by-nc"),
    ("proprietary", "all rights reserved"),
)
# One error is allowed for so many characters of a notice.
CHARACTERS_PER_ERROR = 10
# Stretches of one text whose verdict is remembered.
_REMEMBERED = 4096
_WORD = rb"0-9a-z\x80-\xff"


@dataclass(frozen=True)
class Found:
    label: str
    start: int
    end: int
    score: float


def errors_allowed(notice: str) -> int:
    return max(1, len(notice) // CHARACTERS_PER_ERROR)


def seeds(notice: str) -> list[tuple[int, str]]:
    """Pieces (offset, text) of a notice, one more than the errors allowed."""
    parts = errors_allowed(notice) + 1
    cuts = [len(notice) * i // parts for i in range(parts + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    """The automaton and the expressions; made once per task."""

    def __init__(self, notices: tuple[tuple[str, str], ...], phrases: dict[str, tuple[str, ...]]):
        import ahocorasick
        import regex

        self.notices = [
            (label, text, errors_allowed(text), regex.compile(f"(?b)(?:{regex.escape(text)}){{e<={errors_allowed(text)}}}"))
            for label, text in notices
        ]
        where: dict[str, list[tuple[int, int]]] = {}
        for nr, (_, text) in enumerate(notices):
            for offset, seed in seeds(text):
                where.setdefault(seed, []).append((nr, offset))
        self.automaton = ahocorasick.Automaton()
        for seed, places in where.items():
            self.automaton.add_word(seed, (len(seed), places))
        self.automaton.make_automaton()
        between = rb"[^" + _WORD + rb"]+"
        self.phrases = {
            label: (
                words[0].encode(),
                regex.compile(rb"(?<![" + _WORD + rb"])" + between.join(w.encode() for w in words) + rb"(?![" + _WORD + rb"])"),
            )
            for label, words in phrases.items()
        }
        self.in_word = np.zeros(256, bool)
        self.in_word[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True

    def notices_in(self, text: str) -> Iterator[Found]:
        """Spans of notices in a lower-case text, leftmost first; of a notice, spans that overlap count once.

        An exact seed says where its notice would start. Only so much text as the notice and its errors can take is
        searched around there, so that the work grows with the seeds found; equal stretches are searched once.
        """
        starts: dict[int, set[int]] = {}
        for last, (length, places) in self.automaton.iter(text):
            for nr, offset in places:
                starts.setdefault(nr, set()).add(last + 1 - length - offset)
        for nr, found in starts.items():
            label, notice, errors, expression = self.notices[nr]
            seen: dict[str, tuple[int, int, int] | None] = {}
            done = 0
            for start in sorted(found):
                lo, hi = max(done, start - errors), start + len(notice) + errors
                stretch = text[lo : max(lo, hi)]
                if len(stretch) < len(notice) - errors:
                    continue
                if stretch not in seen:
                    if len(seen) >= _REMEMBERED:
                        seen.clear()
                    hit = expression.search(stretch)
                    seen[stretch] = (hit.start(), hit.end(), sum(hit.fuzzy_counts)) if hit else None
                if (at := seen[stretch]) is not None:
                    yield Found(label, lo + at[0], lo + at[1], 1 - min(1.0, at[2] / len(notice)))
                    done = lo + at[1]

    def scan(self, text: bytes | None) -> tuple:
        """(n_words, n_base, first_word, last_word, base_labels, labels, score, spans)."""
        lower = (text or b"").lower()
        inside = self.in_word[np.frombuffer(lower, np.uint8)]
        starts = inside & ~np.r_[False, inside[:-1]] if len(inside) else inside
        places, base = [], set()
        for label, (first, expression) in self.phrases.items():
            if first in lower:
                here = [m.start() for m in expression.finditer(lower)]
                places += here
                base |= {label} if here else set()
        found = sorted(self.notices_in(lower.decode("utf-8", "replace")), key=lambda f: (f.start, f.end, f.label))
        word = lambda at: int(np.count_nonzero(starts[:at]))
        return (
            int(np.count_nonzero(starts)),
            len(places),
            word(min(places)) if places else None,
            word(max(places)) if places else None,
            ",".join(sorted(base)),
            ",".join(sorted(base | {f.label for f in found})),
            max([1.0 * bool(base), *(f.score for f in found)]),
            [{"label": f.label, "start": f.start, "end": f.end, "score": f.score} for f in found],
        )


RESULT = (
    "key long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<struct<label: string, start: int, end: int, score: double>>"
)


def license_scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    notices: tuple[tuple[str, str], ...] = NOTICES,
    phrases: dict[str, tuple[str, ...]] = PHRASES,
) -> DataFrame:
    """One row per document: words, places of phrases, labels, the best score, and the spans of notices found.

    Spans count code points, ends exclusive. The score is 1 where a phrase stands, else the best notice's share of
    characters without error, else 0. A NULL text is like an empty one: no words, no labels, score 0. Repeated rows get
    equal results, a NULL key stays NULL, other columns are ignored, and an empty table gives an empty result.
    """

    def run(batches):
        scanner = Scanner(notices, phrases)
        span = pa.struct([("label", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(span)]
        names = [x.split()[0] for x in RESULT.split(", ")][:8] + ["spans"]
        for batch in batches:
            rows = [scanner.scan(x.as_py()) for x in batch.column(1).cast(pa.binary())]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, RESULT)


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    spans = F.array_join(
        F.transform("spans", lambda s: F.concat_ws(":", s["label"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    return found.withColumn("spans", spans).withColumnRenamed("key", "doc_id")
