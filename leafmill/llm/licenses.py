"""License scans: exact phrases, and fuzzy search for short notices.

A text is read as its words in lower case with one blank between them, so line breaks and punctuation
inside a notice do not count as edits. A notice with at most ``k`` edits holds one of its ``k + 1``
pieces unchanged (pigeonhole): one automaton over the pieces of all notices finds the places where a
notice can be, and the ``regex`` library's bounded-error matching decides in a window around each.
Windows are as long as their notice, so the work follows the text's length and its seeds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from leafmill.llm.common import id_text, id_type, map_rows, small_batches

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: One byte for one byte: A-Z in lower case, ASCII that is no letter or digit as a blank.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)

# Exact phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Wordings of public notices and their labels.
NOTICES = [
    ("gnu general public license", "gpl"),
    ("licensed under the gpl", "gpl"),
    ("free software you can redistribute it and or modify it under the terms of the gnu", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("apache license", "apache"),
    ("licensed under the apache license version 2 0", "apache"),
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("licensed under cc by", "cc-by"),
    ("creative commons attribution", "cc-by"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("creative commons zero", "cc0"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("bsd 3 clause license", "bsd"),
    ("redistribution and use in source and binary forms with or without modification", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]
#: One edit for so many characters of a notice, up to so many.
EDIT_CHARS, MOST_EDITS = 10, 3
#: Windows whose result a task remembers: notices are mostly copies of each other.
REMEMBERED = 20_000


@dataclass(frozen=True)
class Notice:
    """A wording with a blank on both sides, its label, the edits it may have, and its matcher."""

    wording: str
    label: str
    edits: int
    matcher: regex.Pattern

    def pieces(self) -> list[tuple[int, str]]:
        """``edits + 1`` pieces that make up the wording, with their offsets."""
        cuts = [len(self.wording) * i // (self.edits + 1) for i in range(self.edits + 2)]
        return [(a, self.wording[a:b]) for a, b in zip(cuts, cuts[1:])]


def edits_of(wording: str) -> int:
    return min(max(len(wording) // EDIT_CHARS, 1), MOST_EDITS)


def make_notices(wordings: Sequence[tuple[str, str]]) -> list[Notice]:
    made = []
    for words, label in wordings:
        wording, edits = f" {words} ", edits_of(words)
        pattern = regex.compile(f"(?:{regex.escape(wording)}){{e<={edits}}}", regex.BESTMATCH)
        made.append(Notice(wording, label, edits, pattern))
    return made


class Scanner:
    """Finds phrases and notices in texts; one for a task."""

    def __init__(self, phrases: dict[str, str], wordings: Sequence[tuple[str, str]]) -> None:
        self.phrases = [(f" {words} ", label) for words, label in phrases.items()]
        self.notices = make_notices(wordings)
        self.seeds = ahocorasick.Automaton()
        pieces: dict[str, list[tuple[int, int]]] = {}
        for number, notice in enumerate(self.notices):
            for offset, piece in notice.pieces():
                pieces.setdefault(piece, []).append((number, offset + len(piece) - 1))
        for piece, uses in pieces.items():
            self.seeds.add_word(piece, uses)
        if pieces:
            self.seeds.make_automaton()
        self.known: dict[tuple[int, str], tuple[int, int, int] | None] = {}

    def _match(self, number: int, window: str) -> tuple[int, int, int] | None:
        """Start, end and edits of the best match of a notice in a window."""
        key = number, window
        if key not in self.known:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            m = self.notices[number].matcher.search(window)
            self.known[key] = m and (m.start(), m.end(), sum(m.fuzzy_counts))
        return self.known[key]

    def places(self, line: str) -> list[tuple[str, int]]:
        """Label and number of the first word of every exact phrase in a line of words."""
        found = []
        for phrase, label in self.phrases:
            at = line.find(phrase)
            while at >= 0:
                found.append((label, line.count(" ", 0, at)))
                at = line.find(phrase, at + 1)
        return found

    def notices_in(self, line: str) -> list[tuple[int, int, int, int]]:
        """Start, end, notice and edits; matches of one notice do not overlap.

        The window of a seed holds every stretch within ``edits`` of the notice that has the seed in
        its place, so a stretch is left out only if it overlaps a match that is reported.
        """
        if not self.notices:
            return []
        starts: dict[int, set[int]] = {}
        for end, uses in self.seeds.iter(line):
            for number, offset in uses:
                starts.setdefault(number, set()).add(end - offset)
        found = []
        for number, seen in starts.items():
            notice, free = self.notices[number], 0
            size, edits = len(notice.wording), notice.edits
            for start in sorted(seen):
                low, high = max(start - edits, free), min(start + size + edits, len(line))
                match = self._match(number, line[low:high]) if high - low >= size - edits else None
                if match:
                    end = low + match[1]
                    found.append((low + match[0], end, number, match[2]))
                    # The blank after a match may stand before the next one.
                    free = end - 1 if line[end - 1] == " " else end
        return sorted(found)

    def scan(self, text: str) -> tuple[int, list[tuple[str, int]], list[dict]]:
        """Number of words, phrase places by word, and notice spans in code points of the text."""
        words = text.encode().translate(FOLD).split()
        line = f" {b' '.join(words).decode()} " if words else ""
        places = sorted(self.places(line), key=lambda p: (p[1], p[0]))
        spans = []
        notices = self.notices_in(line)
        if notices:
            low = text.encode().translate(FOLD).decode()
            at = [m.start() for m in WORD.finditer(low)]
            begins = [m.end() for m in re.finditer(" ", line[:-1])]
            for start, end, number, edits in notices:
                notice = self.notices[number]
                while start < end and line[start] == " ":
                    start += 1
                while end > start and line[end - 1] == " ":
                    end -= 1
                first, last = line.count(" ", 0, start) - 1, line.count(" ", 0, end) - 1
                spans.append(
                    {
                        "label": notice.label,
                        "start": at[first] + start - begins[first],
                        "end": at[last] + end - begins[last],
                        "edits": edits,
                        "likeness": 1.0 - edits / len(notice.wording),
                    }
                )
        return len(words), places, spans


def find(
    df: DataFrame,
    phrases: dict[str, str] | None = None,
    notices: Sequence[tuple[str, str]] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id, n_words, base, spans`` per row.

    ``base`` is an array of ``label, word``: every place where the words of an exact phrase stand in a
    row, by the number of its first word (from 0). ``spans`` is an array of ``label, start, end,
    edits, likeness``: stretches of the text (code points, end exclusive) within the edits that a
    notice may have; those of one notice do not overlap, those of different notices may. ``notices``
    are pairs of wording and label, both in lower-case words.

    A NULL or empty text has no words and empty arrays. Rows are independent of each other, repeated
    rows and ids give a row each, a NULL id stays NULL. No shuffle.
    """
    kind = id_type(df, id_col)
    given = (PHRASES if phrases is None else phrases, NOTICES if notices is None else notices)
    place = pa.struct([("label", pa.string()), ("word", pa.int64())])
    span = pa.struct(
        [
            ("label", pa.string()),
            ("start", pa.int64()),
            ("end", pa.int64()),
            ("edits", pa.int32()),
            ("likeness", pa.float64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(*given)
        for batch in small_batches(batches):
            done = [scanner.scan(text or "") for text in batch.column(1).to_pylist()]
            base = [[{"label": a, "word": w} for a, w in places] for _, places, _ in done]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([n for n, _, _ in done], pa.int64()),
                    pa.array(base, pa.list_(place)),
                    pa.array([spans for _, _, spans in done], pa.list_(span)),
                ],
                ["id", "n_words", "base", "spans"],
            )

    schema = (
        f"id {kind}, n_words bigint, base array<struct<label:string,word:bigint>>, "
        "spans array<struct<label:string,start:bigint,end:bigint,edits:int,likeness:double>>"
    )
    return map_rows(id_text(df, id_col, text_col), run, schema)
