"""Fuzzy search for short license notices, beside exact phrases.

A notice with at most k errors keeps one of any k + 1 pieces unchanged, so one pass of an
automaton over all pieces finds every place it can stand. Only the text around those places
is handed to the regex library's bounded-error matching, which verifies the edits and tells
the span.

Texts are UTF-8 bytes with A-Z in lower case; a byte from 0x80 on belongs to a word, so
words are the same as over characters.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from assayline.llm.tables import map_rows, pick

SCHEMA = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
    "base_labels string, labels string, score double"
)
SPAN_SCHEMA = "doc_id bigint, label string, start bigint, end bigint, errors int"

# Phrases found word by word, and their labels.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# Short notices found with errors, and their labels.
NOTICES = (
    ("licensed under the apache license, version 2.0", "apache-2.0-notice"),
    ("released under the mit license", "mit-notice"),
    ("licensed under the mit license", "mit-notice"),
    ("licensed under the gnu general public license, version 3", "gpl-3.0-notice"),
    ("gnu lesser general public license", "lgpl-notice"),
    ("licensed under cc by-nc 4.0", "cc-by-nc-4.0-notice"),
    ("licensed under cc by-sa 4.0", "cc-by-sa-4.0-notice"),
    ("licensed under the mozilla public license", "mpl-notice"),
    ("redistribution and use in source and binary forms", "bsd-notice"),
    ("permission is hereby granted, free of charge", "mit-text-notice"),
)


@dataclass(frozen=True)
class ScanSettings:
    # One error for so many characters of a notice.
    per_error: int = 10
    phrases: tuple[tuple[str, str], ...] = PHRASES
    notices: tuple[tuple[str, str], ...] = NOTICES


@dataclass(frozen=True)
class Notice:
    text: str
    label: str
    errors: int
    pieces: tuple[tuple[str, int], ...]  # piece and its offset


@dataclass
class Found:
    n_words: int
    base: list[tuple[int, str]]  # first word's number and label
    spans: list[tuple[str, int, int, int, float]]  # label, start, end, errors, similarity


_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_W = rb"[0-9a-z\x80-\xff]"


class Scanner:
    def __init__(self, settings: ScanSettings = ScanSettings()):
        import ahocorasick
        import regex

        self.phrases = []
        for phrase, label in settings.phrases:
            words = phrase.encode().split()
            inner = (b"(?:(?!" + _W + rb")[\x00-\xff])+").join(map(re.escape, words))
            # The look-ahead lets matches begin inside one another.
            pattern = re.compile(b"(?<!" + _W + b")(?=" + inner + b"(?!" + _W + b"))", re.S)
            self.phrases.append((max(words, key=len), pattern, label))
        self.notices = []
        automaton = ahocorasick.Automaton()
        seeds: dict[str, list[tuple[int, int]]] = {}
        for k, (text, label) in enumerate(settings.notices):
            errors = max(1, len(text) // settings.per_error)
            cuts = [len(text) * i // (errors + 1) for i in range(errors + 2)]
            pieces = tuple((text[a:b], a) for a, b in zip(cuts, cuts[1:]))
            self.notices.append(Notice(text, label, errors, pieces))
            for piece, offset in pieces:
                seeds.setdefault(piece, []).append((k, offset))
        for piece, where in seeds.items():
            automaton.add_word(piece, (len(piece), where))
        if seeds:
            automaton.make_automaton()
        self.automaton = automaton if seeds else None
        # The first tells in order where a notice stands, the second where it fits best.
        self.fuzzy, self.best = [
            [regex.compile(f"(?{flag})(?:{regex.escape(n.text)}){{e<={n.errors}}}") for n in self.notices]
            for flag in ("e", "be")
        ]

    def scan(self, text: str | None) -> Found:
        raw = (text or "").encode("utf-8", "surrogatepass").lower()  # of bytes: A-Z only
        word = _WORD_BYTE[np.frombuffer(raw, np.uint8)]
        starts = word.copy()
        starts[1:] &= ~word[:-1]
        base = []
        for rare, pattern, label in self.phrases:
            if rare in raw:
                for m in pattern.finditer(raw):
                    base.append((int(np.count_nonzero(starts[: m.start()])), label))
        return Found(int(np.count_nonzero(starts)), base, self.spans(raw))

    def windows(self, characters: str) -> dict[int, list[list[int]]]:
        """Per notice the merged stretches of text where it may stand."""
        found: dict[int, list[list[int]]] = {}
        if self.automaton is None:
            return found
        for end, (length, where) in self.automaton.iter(characters):
            for k, offset in where:
                notice = self.notices[k]
                a = end - length + 1 - offset - notice.errors
                b = a + len(notice.text) + 2 * notice.errors
                found.setdefault(k, []).append([max(0, a), b])
        for k, stretches in found.items():
            stretches.sort()
            merged = [stretches[0]]
            for a, b in stretches[1:]:
                if a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            found[k] = merged
        return found

    def _fits(self, k: int, characters: str, low: int, high: int):
        """The best fit between two places, and the best of what is left before and after."""
        if high - low < len(self.notices[k].text) - self.notices[k].errors:
            return
        m = self.best[k].search(characters, low, high)
        if m:
            yield from self._fits(k, characters, low, m.start())
            yield m.start(), m.end(), sum(m.fuzzy_counts)
            yield from self._fits(k, characters, m.end(), high)

    def spans(self, raw: bytes) -> list[tuple[str, int, int, int, float]]:
        """Verified notices, at most one label at a place; code points, end exclusive."""
        characters = raw.decode("latin-1")
        found = []
        for k, stretches in self.windows(characters).items():
            notice = self.notices[k]
            for a, b in stretches:
                done = a
                for m in self.fuzzy[k].finditer(characters, a, b):
                    low = max(done, m.start() - notice.errors)
                    for start, end, errors in self._fits(k, characters, low, min(b, m.end() + notice.errors)):
                        found.append((errors / len(notice.text), start, end, errors, k))
                        done = max(done, end)
        kept: list[tuple[str, int, int, int, float]] = []
        taken: list[tuple[int, int]] = []
        for share, start, end, errors, k in sorted(found):
            if all(end <= a or b <= start for a, b in taken):  # the best notice of a place
                taken.append((start, end))
                kept.append((self.notices[k].label, start, end, errors, 1 - share))
        kept.sort(key=lambda s: s[1])
        points = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80) if kept else None

        def place(at: int) -> int:
            return int(points[at - 1]) if at else 0

        return [(label, place(a), place(b), e, s) for label, a, b, e, s in kept]


def _run(settings: ScanSettings, build):
    def run(batches):
        scanner = Scanner(settings)
        for batch in batches:
            yield build(batch["doc_id"].tolist(), [scanner.scan(t) for t in batch["text"]])

    return run


def find_notices(
    docs: DataFrame,
    settings: ScanSettings = ScanSettings(),
    *,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """One row per notice found: label, span in code points, number of errors."""

    def build(ids, found):
        rows = [(i, *s[:4]) for i, f in zip(ids, found) for s in f.spans]
        return pd.DataFrame(rows, columns=["doc_id", "label", "start", "end", "errors"])

    return map_rows(pick(docs, doc_id=doc_id, text=text), _run(settings, build), SPAN_SCHEMA)


def scan_licenses(
    docs: DataFrame,
    settings: ScanSettings = ScanSettings(),
    *,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Words, exact phrases and the labels of every row.

    `score` is 1 with an exact phrase, else the similarity of the best notice (1 less its
    errors over its length), else 0. One row per input row, repeated rows included. A null
    or empty text has no words, null places, empty labels and score 0. Other columns are
    left out.
    """

    def build(ids, found):
        return pd.DataFrame(
            {
                "doc_id": ids,
                "n_words": [f.n_words for f in found],
                "n_base": [len(f.base) for f in found],
                "first_word": pd.array([min(f.base)[0] if f.base else None for f in found], "Int64"),
                "last_word": pd.array([max(f.base)[0] if f.base else None for f in found], "Int64"),
                "base_labels": [_joined(b[1] for b in f.base) for f in found],
                "labels": [
                    _joined([*(b[1] for b in f.base), *(s[0] for s in f.spans)]) for f in found
                ],
                "score": [
                    1.0 if f.base else max([s[4] for s in f.spans], default=0.0) for f in found
                ],
            }
        )

    return map_rows(pick(docs, doc_id=doc_id, text=text), _run(settings, build), SCHEMA)


def _joined(labels) -> str:
    return ",".join(sorted(set(labels)))
