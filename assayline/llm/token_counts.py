"""Token counts by rank-synchronous merging of ragged arrays.

Distinct pre-tokens of a batch lie one after another in a flat array of symbols. In every
round each pre-token finds its lowest-ranked neighbouring pair and merges that pair's
occurrences from left to right, all pre-tokens in the same numpy operations; what has no
ranked pair left is finished, and its surviving symbols are counted.

Texts are cut into chunks that begin a pre-token (a word with the space before it), so a
chunk seen before is looked up. Its count goes to every place it occurs.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from assayline.llm.tables import map_rows, pick

SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


@dataclass(frozen=True)
class CountSettings:
    limit: int = 1024
    # Chunks a worker remembers, and the longest one, in code points.
    remembered: int = 1_500_000
    longest: int = 64


# Fixed value: how a byte-level vocabulary writes each byte as a printable character.
def byte_characters() -> list[str]:
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    place = {b: chr(b) for b in printable}
    for k, b in enumerate(b for b in range(256) if b not in place):
        place[b] = chr(256 + k)
    return [place[b] for b in range(256)]


class PairTable:
    """(left id, right id) -> (rank, merged id): an open-addressing hash table in arrays."""

    def __init__(self, left, right, merged):
        left, right = np.asarray(left, np.int64), np.asarray(right, np.int64)
        bits = max(4, int(np.ceil(np.log2(max(1, len(left)) * 4))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NO_RANK, np.int32)
        self.merged = np.zeros(1 << bits, np.int32)
        keys = left << 32 | right
        slots, left_over = self._slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(left_over):
            self.probes += 1
            slot = slots[left_over]
            free = self.keys[slot] == -1
            _, first = np.unique(slot[free], return_index=True)
            put = left_over[free][first]
            at = slots[put]
            self.keys[at], self.ranks[at], self.merged[at] = keys[put], put, np.asarray(merged)[put]
            left_over = np.setdiff1d(left_over, put)
            slots[left_over] = slots[left_over] + 1 & self.mask

    def _slot(self, keys):
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def find(self, left, right) -> np.ndarray:
        """Slots of the pairs; a slot without rank where there is none."""
        keys = left.astype(np.int64) << 32 | right
        slots = self._slot(keys)
        found = np.where(self.keys[slots] == keys, slots, -1)
        seek = np.flatnonzero((found < 0) & (self.keys[slots] != -1))
        for _ in range(self.probes):
            if not len(seek):
                break
            slots[seek] = slots[seek] + 1 & self.mask
            there = self.keys[slots[seek]]
            hit = there == keys[seek]
            found[seek[hit]] = slots[seek[hit]]
            seek = seek[~hit & (there != -1)]
        return found


NO_RANK = np.int32(2**31 - 1)


class MergeCounter:
    """Counts tokens of a byte-level BPE vocabulary file of the tokenizers library."""

    def __init__(self, path: str, settings: CountSettings = CountSettings()):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        self.byte_ids = np.array([vocab[c] for c in byte_characters()], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.pairs = PairTable(
            [vocab[a] for a, _ in pairs],
            [vocab[b] for _, b in pairs],
            [vocab[a + b] for a, b in pairs],
        )
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))))
        # Fixed value: the pattern of the byte-level pre-tokenizer.
        self.pretokens = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        )
        # Where white space meets white space a chunk would not stand for itself.
        self.runs = re.compile(r"\s\s|[^\S \n]")
        self.settings = settings
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    # --- merging

    def merged_counts(self, pretokens: list[str]) -> np.ndarray:
        """Number of tokens of each pre-token."""
        raw = [p.encode() for p in pretokens]
        lengths = np.array([len(r) for r in raw], np.int64)
        counts = lengths.copy()
        symbols = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        owner = np.repeat(np.arange(len(raw)), lengths)
        slots = self._pair_slots(symbols, owner)
        while len(symbols):
            rank = np.where(slots >= 0, self.pairs.ranks[slots], NO_RANK)
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, len(owner)])
            lowest = np.minimum.reduceat(rank, starts)
            done = lowest == NO_RANK
            counts[owner[starts[done]]] = sizes[done]
            if done.all():
                break
            hit = (rank == np.repeat(lowest, sizes)) & (rank != NO_RANK)
            hit = _every_other(hit, rank)
            at = np.flatnonzero(hit)
            symbols[at] = self.pairs.merged[slots[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            # Only pairs beside a merged symbol change.
            stale = hit.copy()
            before = at - 1
            stale[before[before >= 0]] = True
            gone = np.flatnonzero(~keep)
            inside = gone[gone > 0] - 1
            stale[inside] = True
            keep &= ~np.repeat(done, sizes)
            symbols, owner, slots, stale = symbols[keep], owner[keep], slots[keep], stale[keep]
            redo = np.flatnonzero(stale)
            slots[redo] = self._pair_slots(symbols, owner, redo)
        return counts

    def _pair_slots(self, symbols, owner, at=None):
        """Table slot of the pair each symbol starts; -1 at a pre-token's last symbol."""
        at = np.arange(len(symbols)) if at is None else at
        after = np.minimum(at + 1, max(0, len(symbols) - 1))
        inside = (after > at) & (owner[after] == owner[at])
        slots = np.full(len(at), -1, np.int64)
        slots[inside] = self.pairs.find(symbols[at[inside]], symbols[after[inside]])
        return slots

    # --- texts

    def _chunks(self, text: str) -> list[str]:
        """The text in chunks that are cut into pre-tokens alone as they are together."""
        if self.runs.search(text):
            return self.pretokens.findall(text)
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")

    def chunks(self, text: str) -> tuple[list[str], int]:
        """Chunks outside special strings, and the number of those strings."""
        if "\0" in text or self.special.search(text):
            parts = self.special.split(text)
            return [c for p in parts for c in self.pretokens.findall(p)], len(parts) - 1
        return self._chunks(text), 0

    def learn(self, chunks: set[str]) -> None:
        known, new = self.known, []
        for chunk in chunks:
            if chunk not in known:
                if chunk in self.older:
                    known[chunk] = self.older[chunk]
                else:
                    new.append(chunk)
        cut = [self.pretokens.findall(c) for c in new]
        distinct = list({p for parts in cut for p in parts})
        count = dict(zip(distinct, self.merged_counts(distinct).tolist())) if distinct else {}
        for chunk, parts in zip(new, cut):
            known[chunk] = sum([count[p] for p in parts])

    def forget(self) -> None:
        """Drop chunks unused for a while, and long ones. Bounds the memory."""
        if len(self.known) > self.settings.remembered // 2:
            kept = self.settings.longest
            self.older = {c: n for c, n in self.known.items() if len(c) <= kept}
            self.known = {}

    def count(self, texts: list[str]) -> list[int]:
        self.forget()
        cut = [self.chunks(t) for t in texts]
        distinct = set()
        for chunks, _ in cut:
            distinct.update(chunks)
        self.learn(distinct)
        look = self.known.__getitem__
        return [sum(map(look, chunks)) + special for chunks, special in cut]


def _every_other(hit: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """In runs of adjacent hits take the first, third, ...: merges from the left."""
    at = np.flatnonzero(hit)
    if len(at) < 2:
        return hit
    new_run = np.r_[True, at[1:] != at[:-1] + 1]
    first = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
    odd = (np.arange(len(at)) - first) % 2 == 1
    out = hit.copy()
    out[at[odd]] = False
    return out


_counters: dict[tuple, MergeCounter] = {}


def counter(path: str, settings: CountSettings) -> MergeCounter:
    """One per Python worker, so its memory of chunks serves all batches."""
    key = path, settings
    if key not in _counters:
        _counters[key] = MergeCounter(path, settings)
    return _counters[key]


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    settings: CountSettings = CountSettings(),
    at_once: int = 256,
) -> DataFrame:
    """Bytes and tokens of every row, and whether there are more tokens than the limit.

    One row per input row, repeated rows included; a null or empty text has no tokens.
    Special strings inside a text count as one token, as the library does by default.
    Texts of any length are whole; other columns are left out.
    """

    def run(batches):
        counting = counter(tokenizer_path, settings)
        for batch in batches:
            texts = batch["text"].fillna("").tolist()
            tokens = []
            for k in range(0, len(texts), at_once):
                tokens += counting.count(texts[k : k + at_once])
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "n_bytes": [len(t.encode()) for t in texts],
                    "n_tokens": tokens,
                    "over_limit": [n > settings.limit for n in tokens],
                }
            )

    return map_rows(pick(docs, doc_id=doc_id, text=text), run, SCHEMA)
