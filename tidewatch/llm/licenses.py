"""License scan: fuzzy short-notice search (operator 12).

A text's words (ASCII letters in lower case, digits, everything beyond ASCII) are joined by single
blanks.  A notice is a short phrase of a licence with a number ``k`` of edits of code points that it
may have; words marked exact stand as they are.

* Pigeonhole: a notice is cut into k + 1 pieces.  With at most k edits one piece stands unedited, at
  most k places off.  One Aho-Corasick automaton finds the pieces of all notices in one pass.
* Each piece found gives a window that holds every match around it.  The ``regex`` library verifies
  it by bounded-error best matching: a search of the window, then a full match of each of its few
  ranges of whole words, for span and errors (one pattern with a boundary behind the fuzzy part
  misses some).

Of overlapping matches of one notice the one with fewest errors stays, then the first.  The three base
phrases are notices too: their matches without an error are the base places.

The scan is one pass over each text with no shuffle; a window is as long as its notice, so time is
linear in text and seeds.  Edge cases: null text is read as empty; null and empty texts have no words
and no match.  Every row gives one row, repeated rows and null doc_id as well.  Only doc_id and text
are read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import importable, small_batches, table, texts_of


@dataclass(frozen=True)
class Notice:
    """``exact_before + phrase + exact_after`` with at most ``k`` edits of the phrase."""

    label: str
    phrase: str
    k: int = 0
    before: str = ""
    after: str = ""
    base: bool = False

    @property
    def text(self) -> str:
        return self.before + self.phrase + self.after


# Phrases of public licences.
NOTICES = (
    Notice("mit", "license", 1, before="mit ", base=True),
    Notice("apache", " license", 2, before="apache", base=True),
    Notice("gpl", "general public license", 2, base=True),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 7),
    Notice("mit", "spdx license identifier ", 2, after="mit"),
    Notice("apache", "licensed under the apache license version 2 0", 4),
    Notice("apache", "spdx license identifier ", 2, after="apache 2 0"),
    Notice("apache", "www apache org licenses license 2 0", 3),
    Notice("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu", 9),
    Notice("gpl", "spdx license identifier ", 2, after="gpl"),
    Notice("lgpl", " general public license", 2, before="lesser"),
    Notice("lgpl", " general public license", 2, before="library"),
    Notice("agpl", " general public license", 2, before="affero"),
    Notice("bsd", "license", 1, before="bsd "),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted", 8),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose", 7),
    Notice("mpl", " public license", 2, before="mozilla"),
    Notice("epl", " public license", 2, before="eclipse"),
    Notice("cc", "creative commons attribution", 2),
    Notice("cc", "creative commons license", 2),
    Notice("boost", " software license", 2, before="boost"),
    Notice("zlib", "this software is provided as is without any express or implied warranty", 6),
    Notice("unlicense", "this is free and unencumbered software released into the public domain", 6),
)

_WORD_BYTE = [c >= 0x80 or chr(c).isalnum() for c in range(256)]
_TO_WORDS = bytes(ord(chr(c).lower()) if c < 0x80 and ok else c if ok else 0x20 for c, ok in enumerate(_WORD_BYTE))
_WORD = regex.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
KNOWN_WINDOWS = 100_000  # verified windows remembered by a task; more are verified again


def pieces(n: Notice) -> list[tuple[int, str]]:
    """(offset, piece) of the k + 1 pieces of a notice."""
    cut = [len(n.text) * i // (n.k + 1) for i in range(n.k + 2)]
    return [(a, n.text[a:b]) for a, b in zip(cut, cut[1:])]


class Finder:
    """The automaton over all pieces and the verifying patterns of notices."""

    def __init__(self, notices: Iterable[Notice]):
        self.notices = list(notices)
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, n in enumerate(self.notices):
            for off, piece in pieces(n):
                seeds.setdefault(piece, []).append((i, off))
        self.automaton = ahocorasick.Automaton()
        for piece, places in seeds.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()
        self.patterns = [regex.compile(f"(?b)(?:{regex.escape(n.phrase)}){{e<={n.k}}}") for n in self.notices]
        self.known: dict[tuple[int, str], tuple[int, int, int] | None] = {}

    def verified(self, i: int, window: str) -> tuple[int, int, int] | None:
        """(errors, start, end) of the best match of notice i in a window, from a word's start to a word's end.

        A blank stands before and after every whole word of the window."""
        key = (i, window)
        if key not in self.known:
            if len(self.known) >= KNOWN_WINDOWS:
                self.known.clear()
            self.known[key] = self._best(i, window)
        return self.known[key]

    def _best(self, i: int, window: str) -> tuple[int, int, int] | None:
        n, pattern = self.notices[i], self.patterns[i]
        if not pattern.search(window):
            return None
        blanks = [p for p, c in enumerate(window) if c == " "]
        best = None
        for s in blanks[:-1]:
            for e in blanks:
                range_ = window[s + 1:e]
                if abs(len(range_) - len(n.text)) <= n.k and range_.startswith(n.before) and range_.endswith(n.after):
                    m = pattern.fullmatch(range_, len(n.before), len(range_) - len(n.after))
                    if m and (best is None or sum(m.fuzzy_counts) < best[0]):
                        best = (sum(m.fuzzy_counts), s + 1, e)
        return best

    def matches(self, joined: str) -> list[tuple[int, int, int, int]]:
        """(start, end, errors, notice) of all matches in words joined by blanks, by start."""
        padded = f" {joined} "
        found: list[set[tuple[int, int, int]]] = [set() for _ in self.notices]
        for last, (size, places) in self.automaton.iter(padded):
            for i, off in places:
                n = self.notices[i]
                s = last + 1 - size - off  # where the notice begins if nothing is edited
                low = max(0, s - n.k - 1)
                got = self.verified(i, padded[low:s + len(n.text) + n.k + 1])
                if got:
                    found[i].add((got[0], low + got[1] - 1, low + got[2] - 1))
        out = []
        for i, some in enumerate(found):
            kept: list[tuple[int, int]] = []
            for errors, s, e in sorted(some):
                at = bisect_left(kept, (s, e))
                if (at and kept[at - 1][1] > s) or (at < len(kept) and kept[at][0] < e):
                    continue
                insort(kept, (s, e))
                out.append((s, e, errors, i))
        return sorted(out)


MATCH = "struct<label:string,notice:string,base:boolean,first_word:long,n_words:long,start:long,end:long,errors:int>"
_ARROW_MATCH = pa.struct([("label", pa.string()), ("notice", pa.string()), ("base", pa.bool_()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("errors", pa.int32())])


def scan(finder: Finder, text: str) -> tuple[int, list[dict]]:
    """(number of words, matches) of one text; spans are code points of the text, end exclusive."""
    words = text.encode().translate(_TO_WORDS).split()
    joined = b" ".join(words).decode()
    got = finder.matches(joined)
    if not got:
        return len(words), []
    blanks = np.array([i for i, c in enumerate(joined) if c == " "], np.int64)
    places = [m.span() for m in _WORD.finditer(text)]
    out = []
    for s, e, errors, i in got:
        a, b = int(np.searchsorted(blanks, s)), int(np.searchsorted(blanks, e))
        n = finder.notices[i]
        out.append({"label": n.label, "notice": n.text, "base": n.base and not errors, "first_word": a, "n_words": b - a + 1, "start": places[a][0], "end": places[b][1], "errors": errors})
    return len(words), out


def notices_in(docs: DataFrame, notices: Iterable[Notice] = NOTICES) -> DataFrame:
    """(doc_id, n_words, matches) of every row; ``matches`` by place, each with label, notice, word and code point span, errors."""
    importable(docs.sparkSession)
    wanted = list(notices)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(wanted)
        for b in small_batches(batches, "text"):
            got = [scan(finder, t) for t in texts_of(b).to_pylist()]
            cols = [b.column("doc_id"), pa.array([n for n, _ in got], pa.int64()), pa.array([m for _, m in got], pa.list_(_ARROW_MATCH))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_words", "matches"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, n_words long, matches array<{MATCH}>")


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 12 over all documents.  ``score``: 1 less the share of edited code points of the best match, 0 without one."""
    got = notices_in(table(spark, sf_dir, "documents"))
    base = F.filter("matches", lambda m: m["base"])
    joined = lambda ms: F.array_join(F.array_sort(F.array_distinct(F.transform(ms, lambda m: m["label"]))), ",")
    starts = F.transform(base, lambda m: m["first_word"])
    scores = F.transform("matches", lambda m: 1 - m["errors"].cast("double") / F.length(m["notice"]))
    return got.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                      joined(base).alias("base_labels"), joined(F.col("matches")).alias("labels"), F.coalesce(F.array_max(scores), F.lit(0.0)).alias("score"),
                      F.size("matches").cast("long").alias("n_places"))
