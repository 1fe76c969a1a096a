"""BPE encoding and decoding by tree concatenation.

A long text is cut into leaves at any code point, the leaves are encoded independently, and
neighbours are joined pairwise up a tree. A join re-encodes a window around its cut and
keeps it once the window and each side agree on a token ending at the same place; until
then the window grows, in the end to both sides whole.

Why agreement is exact: pairwise merging by rank gives a token sequence if and only if
every two neighbouring tokens would stay apart when encoded alone. After a splice every
neighbouring pair stands in one of the encodings that were joined, so the whole is the
encoding of the whole text.

Leaves are quick because no token crosses white space: each distinct word goes through the
library once per worker and its result is looked up afterwards.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from assayline.llm.tables import map_rows, pick

SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
FULL_SCHEMA = "doc_id bigint, ids array<int>, decoded string"


@dataclass(frozen=True)
class TreeSettings:
    # Code points in a leaf and in the first window on each side of a cut.
    leaf: int = 16_384
    window: int = 32
    # Words a worker remembers, and the longest one it remembers.
    remembered: int = 800_000
    longest: int = 64


# Separators of ASCII text. \x1c to \x1f separate for str.split but not for the tokenizer.
_WORD = re.compile(r"[^ \t\n\r\x0b\x0c]+")
_IDS, _TEXT = itemgetter(0), itemgetter(1)
_ODD = re.compile("[\x1c-\x1f]")


@dataclass(slots=True)
class Part:
    """Encoding of a stretch of text: pieces (words, or single tokens near a join) in order.

    A piece is (ids as bytes, tokens joined by a space); starts and ends are its place.
    """

    starts: list[int]
    ends: list[int]
    pieces: list[tuple[bytes, str]]

    def cut(self, first: int, last: int) -> Part:
        return Part(self.starts[first:last], self.ends[first:last], self.pieces[first:last])

    def plus(self, other: Part) -> Part:
        return Part(
            self.starts + other.starts, self.ends + other.ends, self.pieces + other.pieces
        )


class TreeEncoder:
    """Encodes one text at a time, like the library's encode without special tokens added."""

    def __init__(self, path: str, settings: TreeSettings = TreeSettings()):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.settings = settings
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.token = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.single = [(np.array([i], "<u4").tobytes(), t) for i, t in enumerate(self.token)]
        added = self.tokenizer.get_added_tokens_decoder().values()
        # A first window this wide holds any special token that a cut falls into.
        self.widest = max([len(t.content) for t in added], default=0) + 1
        self.plain_join = self.tokenizer.decoder is None
        self.words: dict[str, tuple[bytes, str]] = {}
        self.older: dict[str, tuple[bytes, str]] = {}

    # --- words through a memory of distinct words

    @staticmethod
    def _split(text: str) -> list[str]:
        return _WORD.findall(text) if _ODD.search(text) else text.split()

    def learn(self, texts: list[str], together: int = 500) -> None:
        """Encode the distinct words of these texts that are not remembered yet."""
        missing = set()
        for text in texts:
            missing.update(self._split(text))
        known, new = self.words, []
        for word in missing:
            if word in known:
                continue
            if word in self.older:
                self.words[word] = self.older[word]
            elif len(word) <= self.settings.longest:
                new.append(word)
            else:
                self.words[word] = self._whole(self.tree(word))
        groups = [new[k : k + together] for k in range(0, len(new), together)]
        got = self.tokenizer.encode_batch([" ".join(g) for g in groups], add_special_tokens=False)
        for group, encoding in zip(groups, got):
            ids = np.array(encoding.ids, "<u4")
            starts = np.array([s for s, _ in encoding.offsets], np.int64)
            lengths = np.array([len(w) + 1 for w in group])
            at = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)])).tolist()
            tokens, raw = [self.token[i] for i in encoding.ids], ids.tobytes()
            for word, a, b in zip(group, at, at[1:]):
                self.words[word] = raw[4 * a : 4 * b], " ".join(tokens[a:b])

    def forget(self) -> None:
        """Drop words unused for a while; call it between texts. Bounds the memory."""
        if len(self.words) > self.settings.remembered // 2:
            self.older, self.words = self.words, {}

    def forget_all(self) -> None:
        """Drop all words; call it after a task, as the worker goes on with other work."""
        self.older, self.words = {}, {}

    def encode_decode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian 32-bit integers and their decoded text. `learn` it before."""
        if len(text) > self.settings.leaf:
            ids, decoded = self._whole(self.tree(text))
        else:
            found = list(map(self.words.__getitem__, self._split(text)))
            ids = b"".join(map(_IDS, found))
            # A word without tokens leaves no gap between its neighbours.
            decoded = " ".join(filter(None, map(_TEXT, found)))
        return ids, decoded if self.plain_join else self.decode(ids)

    def decode(self, ids: bytes) -> str:
        return self.tokenizer.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)

    @staticmethod
    def _whole(part: Part) -> tuple[bytes, str]:
        return (
            b"".join(map(_IDS, part.pieces)),
            " ".join(filter(None, map(_TEXT, part.pieces))),
        )

    # --- the tree

    def tree(self, text: str) -> Part:
        """Encode leaves independently, then join neighbours level by level."""
        long = len(text) > self.settings.leaf
        size = self.settings.leaf if long else max(1, self.settings.longest)
        cuts = list(range(0, len(text), size)) + [len(text)]
        leaves = [text[a:b] for a, b in zip(cuts, cuts[1:])]
        if long:
            self.learn(leaves)
            level = [self._leaf(leaf, start) for leaf, start in zip(leaves, cuts)]
        else:  # a piece of a word: its tokens are looked at one by one
            level = [self._tokens(leaf, start) for leaf, start in zip(leaves, cuts)]
        bounds = cuts
        while len(level) > 1:
            above = [
                self.join(text, bounds[k : k + 3], level[k], level[k + 1])
                for k in range(0, len(level) - 1, 2)
            ]
            level = above + level[len(above) * 2 :]
            bounds = sorted({*bounds[::2], bounds[-1]})
        return level[0] if level else Part([], [], [])

    def _leaf(self, leaf: str, start: int) -> Part:
        words, spans, at = self._split(leaf), [m.span() for m in _WORD.finditer(leaf)], 0
        if sum(map(len, words)) != sum([e - s for s, e in spans]) or len(words) != len(spans):
            # str.split also parts words at white space beyond ASCII
            spans = []
            for word in words:
                at = leaf.index(word, at)
                spans.append((at, at + len(word)))
                at += len(word)
        known = self.words
        return Part(
            [start + s for s, _ in spans], [start + e for _, e in spans], [known[w] for w in words]
        )

    def _tokens(self, text: str, start: int) -> Part:
        got = self.tokenizer.encode(text, add_special_tokens=False)
        offsets = got.offsets
        return Part(
            [start + s for s, _ in offsets],
            [start + e for _, e in offsets],
            [self.single[i] for i in got.ids],
        )

    def join(self, text: str, bounds: list[int], left: Part, right: Part) -> Part:
        """Encoding of text[start:end] from those of text[start:cut] and text[cut:end]."""
        start, cut, end = bounds
        reach = max(self.settings.window, self.widest)
        while True:
            low, high = max(start, cut - reach), min(end, cut + reach)
            window = self._tokens(text[low:high], low)
            a, near_left = self._near(text, left, low, cut)
            near_right, b = self._near(text, right, cut, high, tail=False)
            # pieces of the near left kept, tokens of the window skipped; and the reverse
            i = (0, 0) if low == start else _agree(near_left, window, low, cut)
            j = (len(window.ends), len(near_right.ends))
            if low == start:
                a, near_left = Part([], [], []), Part([], [], [])
            if high == end:
                near_right, b = Part([], [], []), Part([], [], [])
                j = (len(window.ends), 0)
            else:
                j = _agree(window, near_right, cut, high)
            if i and j and i[1] <= j[0]:
                middle = near_left.cut(0, i[0]).plus(window.cut(i[1], j[0]))
                return a.plus(middle).plus(near_right.cut(j[1], None)).plus(b)
            reach *= 2

    def _near(self, text: str, part: Part, low: int, high: int, tail: bool = True):
        """`part` in two: what lies clear of (low, high), and single tokens around it."""
        if tail:
            k = bisect_left(part.ends, low)
            far, near = part.cut(0, k), part.cut(k, None)
        else:
            k = bisect_right(part.starts, high)
            near, far = part.cut(0, k), part.cut(k, None)
        tokens = Part([], [], [])
        for s, e, piece in zip(near.starts, near.ends, near.pieces):
            one = len(piece[0]) == 4
            tokens = _extend(tokens, Part([s], [e], [piece]) if one else self._tokens(text[s:e], s))
        return (far, tokens) if tail else (tokens, far)


def _extend(a: Part, b: Part) -> Part:
    a.starts += b.starts
    a.ends += b.ends
    a.pieces += b.pieces
    return a


def _agree(a: Part, b: Part, low: int, high: int) -> tuple[int, int] | None:
    """A place strictly between low and high where both end the same token, as the indices
    of the tokens after it."""
    ours, theirs = _cuts(a, low, high), _cuts(b, low, high)
    for at in ours.keys() & theirs.keys():
        i, j = ours[at], theirs[at]
        if a.pieces[i - 1] == b.pieces[j - 1] and a.starts[i - 1] == b.starts[j - 1]:
            return i, j
    return None


def _cuts(part: Part, low: int, high: int) -> dict[int, int]:
    """Places where a token ends and the next begins -> index of the next. Tokens that are
    bytes of one character share its place and are no cut."""
    return {
        part.ends[k - 1]: k
        for k in range(1, len(part.ends))
        if low < part.ends[k - 1] < high and part.ends[k - 1] <= part.starts[k]
    }


_encoders: dict[tuple, TreeEncoder] = {}


def encoder(path: str, settings: TreeSettings) -> TreeEncoder:
    """One per Python worker, so its memory of words serves all batches of a task."""
    key = path, settings
    if key not in _encoders:
        _encoders[key] = TreeEncoder(path, settings)
    return _encoders[key]


def _texts(batches: Iterator[pd.DataFrame], enc: TreeEncoder, at_once: int = 256):
    try:
        for batch in batches:
            texts = batch["text"].fillna("").tolist()
            ids = batch["doc_id"]
            for k in range(0, len(texts), at_once):
                part = texts[k : k + at_once]
                enc.forget()
                enc.learn([t for t in part if len(t) <= enc.settings.leaf])
                yield ids[k : k + at_once].reset_index(drop=True), part
    finally:
        enc.forget_all()


def encode_documents(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    settings: TreeSettings = TreeSettings(),
) -> DataFrame:
    """Ids and decoded text of every row. A null or empty text has no ids and decodes to ''."""

    def run(batches):
        enc = encoder(tokenizer_path, settings)
        for ids, part in _texts(batches, enc):
            both = [enc.encode_decode(t) for t in part]
            yield pd.DataFrame(
                {
                    "doc_id": ids,
                    "ids": [np.frombuffer(b[0], "<i4") for b in both],
                    "decoded": [b[1] for b in both],
                }
            )

    return map_rows(pick(docs, doc_id=doc_id, text=text), run, FULL_SCHEMA)


def encode_digests(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    settings: TreeSettings = TreeSettings(),
) -> DataFrame:
    """Like `encode_documents`, with digests in place of the ids and the decoded text.

    One row per input row, repeated rows included. A null or empty text has no tokens and
    the digests of nothing. Rows of any length are whole; other columns are left out.
    """

    def run(batches):
        enc = encoder(tokenizer_path, settings)
        for ids, part in _texts(batches, enc):
            both = [enc.encode_decode(t) for t in part]
            yield pd.DataFrame(
                {
                    "doc_id": ids,
                    "n_tokens": [len(b[0]) // 4 for b in both],
                    "ids_sha256": [hashlib.sha256(b[0]).hexdigest() for b in both],
                    "decoded_sha256": [hashlib.sha256(b[1].encode()).hexdigest() for b in both],
                }
            )

    return map_rows(pick(docs, doc_id=doc_id, text=text), run, SCHEMA)
