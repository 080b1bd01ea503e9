"""Search for short license notices with a bounded number of edits.

Texts are lower-cased (A to Z), cut into words of digits, letters and
characters beyond ASCII, and joined by single blanks. A notice that may have
``k`` edits is split into ``k + 1`` seeds; by the pigeonhole principle one of
them stands unchanged in every occurrence. Seeds are located by exact search,
and the regex library's bounded-error matching verifies the places around
them, whole words only, and gives the spans: one occurrence after another, each
with the fewest edits that any at its place has. Exact occurrences of the base
phrases are all counted, overlapping ones too.

Each text is searched whole and by itself. A null or empty text has no words
and no labels; repeated rows get one result; an empty table gives an empty
one. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from shopmill.llm.arrow import arrow_schema
from shopmill.llm.decontaminate import words_of

#: Base phrases; every place counts.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Further notices, found with edits as the base phrases are.
NOTICES = BASE + (
    ("mozilla public license", "mpl"),
    ("creative commons attribution", "cc-by"),
    ("permission is hereby granted free of charge", "mit"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("licensed under the apache license", "apache"),
    ("this work is licensed under the gnu general public license", "gpl"),
    ("all rights reserved", "proprietary"),
)
#: One edit for so many characters of a notice, and one more at least.
CHARACTERS_AN_EDIT = 12

FOUND = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double,"
    " span_labels array<string>, span_begins array<long>, span_ends array<long>, span_edits array<long>"
)


@dataclass(frozen=True)
class Notice:
    phrase: bytes
    label: str
    edits: int

    def seeds(self) -> list[tuple[int, bytes]]:
        """``edits + 1`` parts of the phrase, and where each begins."""
        n, k = len(self.phrase), self.edits + 1
        cuts = [n * i // k for i in range(k + 1)]
        return [(a, self.phrase[a:b]) for a, b in zip(cuts, cuts[1:])]

    def pattern(self, lead: int, flag: int) -> regex.Pattern:
        """The phrase behind ``lead`` inserted characters, with the edits that are left: the library begins no match with an insertion."""
        body = regex.escape(self.phrase.decode()).encode()
        before = b"[^ ]" + b"." * (lead - 1) if lead else b""
        return regex.compile(rb"(?<![^ ])" + before + rb"(?:" + body + rb"){e<=%d}(?![^ ])" % (self.edits - lead), flag)


@dataclass(frozen=True)
class Found:
    begin: int
    end: int
    edits: int


class Matcher:
    """Occurrences of a notice in a region of a text."""

    def __init__(self, notice: Notice):
        self.notice = notice
        leads = range(notice.edits + 1)
        self.first = [notice.pattern(n, regex.ENHANCEMATCH) for n in leads]
        self.best = [notice.pattern(n, regex.BESTMATCH) for n in leads]

    def find(self, joined: bytes, begin: int, end: int) -> Iterator[Found]:
        """One after another; the best match is looked for around the next one only.

        That of the whole region would hide worse ones before it, and each search
        would read the region to its end.
        """
        edits, least = self.notice.edits, len(self.notice.phrase) - self.notice.edits
        near: list[Found | None] = [None] * (edits + 1)
        fresh = [True] * (edits + 1)
        while True:
            for lead in range(edits + 1):
                # A match that lies ahead is still the first one.
                if fresh[lead] or (near[lead] and near[lead].begin < begin):
                    near[lead], fresh[lead] = self._one(self.first, lead, joined, begin, end), False
            if not (known := [f for f in near if f]):
                return
            match = min(known, key=lambda f: (f.begin, f.edits, f.end))
            to = _word_end(joined, min(end, match.end + edits))
            around = [self._one(self.best, lead, joined, match.begin, to) for lead in range(edits + 1)]
            # One that begins further on may have another before it.
            close = [f for f in around if f and f.begin < match.begin + least]
            match = min([match, *close], key=lambda f: (f.edits, f.begin, f.end))
            yield match
            begin = match.end

    @staticmethod
    def _one(patterns: list[regex.Pattern], lead: int, joined: bytes, begin: int, end: int) -> Found | None:
        match = patterns[lead].search(joined, begin, end)
        return match and Found(match.start(), match.end(), lead + sum(match.fuzzy_counts))


def notices(known: Sequence[tuple[str, str]] = NOTICES) -> list[Notice]:
    """Notices of (phrase, label); phrases are lower-case words parted by blanks."""
    return [Notice(p.encode(), label, max(1, len(p) // CHARACTERS_AN_EDIT)) for p, label in known]


class Scanner:
    def __init__(self, known: Sequence[tuple[str, str]] = NOTICES, base: Sequence[tuple[str, str]] = BASE):
        self.notices, self.base = [(n, n.seeds(), Matcher(n)) for n in notices(known)], base

    def scan(self, text: bytes | None) -> tuple:
        """Number of words, base places (label, word), and spans (label, begin, end, edits) of a text."""
        words = words_of(text)
        joined = b" ".join(words)
        base = [(label, at) for phrase, label in self.base for at in _exact(phrase.encode(), joined)]
        spans = {
            (notice.label, match.begin, match.end, match.edits)
            for notice, seeds, matcher in self.notices
            for begin, end in self._regions(joined, notice, seeds)
            for match in matcher.find(joined, begin, end)
        }
        if not spans and not base:
            return len(words), [], []
        blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)

        def word(at: int) -> int:
            return int(np.searchsorted(blanks, at))

        spans = {(label, word(begin), word(end) + 1, edits) for label, begin, end, edits in spans}
        return len(words), [(label, word(at)) for label, at in base], sorted(spans)

    @staticmethod
    def _regions(joined: bytes, notice: Notice, seeds: list[tuple[int, bytes]]) -> list[tuple[int, int]]:
        """Around each exact seed, whole words that hold any occurrence with it; merged."""
        places = []
        for offset, seed in seeds:
            at = joined.find(seed)
            while at >= 0:
                begin = max(0, at - offset - notice.edits)
                end = min(len(joined), at - offset + len(notice.phrase) + notice.edits)
                places.append((joined.rfind(b" ", 0, begin + 1) + 1, _word_end(joined, end)))
                at = joined.find(seed, at + 1)
        merged: list[tuple[int, int]] = []
        for begin, end in sorted(places):
            if merged and begin <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
            else:
                merged.append((begin, end))
        return merged


def scan(docs: DataFrame, known: Sequence[tuple[str, str]] = NOTICES, base: Sequence[tuple[str, str]] = BASE) -> DataFrame:
    """Per document its words, base places, labels, and the spans of all notices found."""
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(_scanner(known, base), FOUND)


def op7_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return scan(spark.read.parquet(f"{folder}/documents.parquet"))


def _exact(phrase: bytes, joined: bytes) -> Iterator[int]:
    at = joined.find(phrase)
    while at >= 0:
        end = at + len(phrase)
        if (at == 0 or joined[at - 1] == 32) and (end == len(joined) or joined[end] == 32):
            yield at
        at = joined.find(phrase, at + 1)


def _word_end(joined: bytes, at: int) -> int:
    end = joined.find(b" ", at)
    return len(joined) if end < 0 else end


def _scanner(known, base):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, scanner = arrow_schema(FOUND), Scanner(known, base)
        most = max((notice.edits for notice, _, _ in scanner.notices), default=0)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                n, places, spans = scanner.scan(text.as_py())
                at = [word for _, word in places]
                own = {label for label, _ in places}
                score = 1.0 if places else max((1 - edits / (most + 1) for *_, edits in spans), default=0.0)
                columns = [list(c) for c in zip(*spans)] or [[], [], [], []]
                rows.append(
                    (
                        doc_id, n, len(places), min(at, default=None), max(at, default=None), ",".join(sorted(own)),
                        ",".join(sorted(own.union(columns[0]))), score, *columns,
                    )
                )
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return run
