"""Removal of word windows that an earlier document has too, over compressed FM-indexes.

A window is `length` consecutive words. It goes from every document but those with the
smallest id it starts in.

1. Routing. Every window holds an anchor, its run of `gram` words with the smallest hash;
   equal windows have equal anchors at equal places, so they can only meet where their
   anchors do. Texts are dealt by nothing but the anchors that two different texts share:
   the stretch that the windows of one such anchor cover is cut out as text. Equal stretches
   become one row with the smallest document before they are shuffled. An anchor with more
   than `hot` different stretches is dealt by its single windows, so that none is too large
   for a task.
2. Search. A shard of some hundred thousand words is held as an FM-index: the words as
   numbers, their Burrows-Wheeler transform in a wavelet tree of packed bits with counts.
   The stretches stream against it: from every word the search goes backwards, word by word,
   while the interval of the index holds another place, which gives the matching statistic
   of that word, cut at `length`. The intervals that get there are reported, each with the
   smallest document in it; words are compared as text, never by hash.
3. Cover. The reported places of each text are put together, and words under a window whose
   smallest document is smaller than the row's own are left out.

Nulls: a null text has no words; a row without a document id loses nothing and takes nothing
from others. Rows of one id are one document. Texts under `length` words stay as they are.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from dataclasses import dataclass
from itertools import chain, count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from assayline.llm.tables import forget, map_rows, pick, written

_GRAMS = "key binary, grams array<bigint>"
_STRETCHES = "key binary, first bigint, stretches array<struct<low:int,gram:bigint,part:string>>"
_FOUND = "part string, low int, length int, least bigint"
_KEPT = "doc_id bigint, n_words bigint, n_removed bigint, kept string"


@dataclass(frozen=True)
class WindowSettings:
    length: int = 13
    # Words of an anchor.
    gram: int = 4
    # Different stretches of one anchor beyond which its windows are dealt one by one.
    hot: int = 2_000
    # Words of one index; whole cells are put together up to about that.
    shard: int = 200_000
    # Texts handled at once, and windows of them hashed at once; results don't depend on it.
    at_once: int = 64
    segment: int = 1 << 20


# --- words and anchors


def words_of(text: str | None) -> list[bytes]:
    """The words `[^\\x20\\x09-\\x0D]+`: bytes are split at exactly these characters."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


class _Hashes(dict):
    """64-bit hashes of words, kept for the next time they are asked for."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        made = self[word] = xxhash.xxh3_64_intdigest(word)
        return made


_hashes = _Hashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def anchors(texts: list[list[bytes]], settings: WindowSettings):
    """(text, hash, first start, last start) of every run of windows with one anchor.

    All texts at once, one after another; windows that cross from one into the next are left
    out, and no other window sees a word of two texts.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    hashes = np.fromiter(map(_hashes.__getitem__, chain.from_iterable(texts)), np.uint64, sizes.sum())
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), sizes)
    total, found = len(hashes) - settings.length + 1, []
    low_bits = np.uint64((1 << 24) - 1)
    for first in range(0, max(total, 0), settings.segment):
        count = min(settings.segment, total - first)
        own = hashes[first : first + count + settings.length - 1]
        mixed = np.zeros(len(own) - settings.gram + 1, np.uint64)
        for k in range(settings.gram):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + own[k : k + len(mixed)]
        mixed = _mix(mixed)
        # The smallest hash and, among equals, the last place.
        least = (mixed & ~low_bits) | (low_bits - np.arange(len(mixed), dtype=np.uint64))
        reach, width = 1, settings.length - settings.gram + 1
        while reach < width:
            step = min(reach, width - reach)
            least = np.minimum(least[:-step], least[step:])
            reach += step
        text = owner[first : first + count]
        inside = np.flatnonzero(text == owner[first + settings.length - 1 : first + settings.length - 1 + count])
        place = (low_bits - (least[inside] & low_bits)).astype(np.int64)
        # An anchor lies within one text, so a new text always has a new place.
        cuts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]][: len(place)])
        lasts = np.r_[cuts[1:], len(place)] - 1 if len(cuts) else cuts
        of = text[inside[cuts]]
        found.append((
            of, mixed[place[cuts]].view(np.int64),
            inside[cuts] + first - begins[of], inside[lasts] + first - begins[of],
        ))
    return [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 4


# --- FM-index


# Bits below each place of a block.
_BELOW = (np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1)


class WaveletTree:
    """Rank of symbols in a sequence: one packed bit vector for each bit of the symbols,
    the sequence dealt by that bit, zeros first, before the next."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels = []
        bits = max(1, int(size - 1).bit_length())
        n = len(symbols)
        for shift in range(bits - 1, -1, -1):
            bit = (symbols >> shift) & 1
            packed = np.zeros((n // 64 + 1) * 8, np.uint8)
            raw = np.packbits(bit.astype(np.uint8), bitorder="little")
            packed[: len(raw)] = raw
            blocks = packed.view(np.uint64)
            before = np.cumsum(np.r_[0, np.bitwise_count(blocks)[:-1]], dtype=np.int64)
            self.levels.append((shift, blocks, before, n - int(bit.sum())))
            symbols = np.r_[symbols[bit == 0], symbols[bit == 1]]
        # Where the places of each symbol begin after the last level: the order is that of the
        # symbols with their bits reversed, but equal ones lie together.
        kinds, begins = np.unique(symbols, return_index=True)
        self.begin = np.zeros(size, np.int64)
        self.begin[kinds] = begins

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place; several rows of places at once."""
        at = places
        for shift, blocks, before, zeros in self.levels:
            block = at >> 6
            inside = blocks.take(block, mode="clip") & _BELOW.take(at & 63, mode="clip")
            ones = before.take(block, mode="clip") + np.bitwise_count(inside)
            at = np.where((symbols >> shift & 1).astype(bool), ones + zeros, at - ones)
        return at - self.begin[symbols]


class FmIndex:
    """Index of several number sequences for patterns of up to `length` numbers >= 1.

    Suffixes are sorted by their first `length` numbers only, which is all that patterns of
    that length can tell apart, and among equals by place.
    """

    def __init__(self, text: np.ndarray, size: int, length: int):
        rank, reach = text, 1
        while reach < length:
            step = min(reach, length - reach)
            ahead = np.zeros(len(rank), np.int64)
            ahead[: len(rank) - step] = rank[step:] + 1
            _, rank = np.unique(rank * (len(rank) + size + 2) + ahead, return_inverse=True)
            reach += step
        self.suffixes = np.argsort(rank, kind="stable")
        self.tree = WaveletTree(text[self.suffixes - 1], size)
        counts = np.bincount(text, minlength=size)
        self.starts = np.r_[0, np.cumsum(counts)]

    def statistics(self, patterns: np.ndarray, ends: np.ndarray, needed: np.ndarray, length: int):
        """For the words at `ends`: length of the longest stretch ending there that has as
        many places in the index as `needed`, at most `length`, and its interval."""
        symbols = patterns[ends]
        low, high = self.starts[symbols], self.starts[symbols + 1]
        enough = high - low >= needed
        matched = enough.astype(np.int64)
        live = np.flatnonzero(enough)
        for k in range(1, length):
            symbols = patterns[ends[live] - k]
            live, symbols = live[symbols > 0], symbols[symbols > 0]
            both = self.tree.rank(symbols, np.stack([low[live], high[live]]))
            lower, upper = both + self.starts[symbols]
            more = upper - lower >= needed[live]
            live, lower, upper = live[more], lower[more], upper[more]
            low[live], high[live] = lower, upper
            matched[live] = k + 1
        return matched, low, high


def search(parts: list[list[bytes]], firsts: np.ndarray, lasts: np.ndarray, length: int):
    """(part, first word, windows, smallest document) of the windows to report.

    `firsts` and `lasts` are the smallest and largest documents that hold each part, in
    ascending order of `firsts`.
    """
    numbers: dict[bytes, int] = defaultdict(count(1).__next__)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    flat = np.fromiter(map(numbers.__getitem__, chain.from_iterable(parts)), np.int64, sizes.sum())
    # A zero before the first part and after every one.
    owner = np.r_[-1, np.repeat(np.arange(len(parts)), sizes + 1)]
    begins = np.cumsum(sizes + 1) - sizes
    offset = np.arange(len(owner)) - np.r_[0, np.repeat(begins, sizes + 1)]
    text = np.zeros(len(owner), np.int64)
    text[1:][offset[1:] < np.repeat(sizes, sizes + 1)] = flat
    index = FmIndex(text, len(numbers) + 1, length)
    ends = np.flatnonzero((text > 0) & (offset >= length - 1))
    # A part of several documents is one place here, but enough by itself.
    needed = np.where(firsts < lasts, 1, 2)[owner[ends]]
    matched, low, _ = index.statistics(text, ends, needed, length)
    hit = matched >= length
    ends, low = ends[hit], low[hit]
    # The first suffix of an interval is the first in the text, where firsts ascend.
    least = firsts[owner[index.suffixes[low]]]
    begins, own = offset[ends] - length + 1, owner[ends]
    worth = least < lasts[own]
    return _intervals(own[worth], begins[worth], least[worth])


def _intervals(own: np.ndarray, begins: np.ndarray, least: np.ndarray):
    """Windows one after another with one smallest document become one interval."""
    if not len(own):
        return []
    new = np.r_[True, (own[1:] != own[:-1]) | (begins[1:] != begins[:-1] + 1) | (least[1:] != least[:-1])]
    cuts = np.flatnonzero(new)
    lengths = np.diff(np.r_[cuts, len(own)])
    return list(zip(own[cuts].tolist(), begins[cuts].tolist(), lengths.tolist(), least[cuts].tolist()))


# --- Spark steps


def _by_text(batches, at_once: int, of):
    """`of` for a few rows at a time, each as lists of the batch's columns."""
    for batch in batches:
        for k in range(0, batch.num_rows, at_once):
            yield of(*[c.to_pylist() for c in batch.slice(k, at_once).columns])


def _offsets(owner: np.ndarray, texts: int) -> pa.Array:
    """Where the rows of each text begin and the last ends."""
    counts = np.bincount(owner, minlength=texts)
    return pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))


def _grams(rows: DataFrame, settings: WindowSettings) -> DataFrame:
    """key and the hashes of the anchors of every text."""

    def of(keys, texts):
        owner, grams, _, _ = anchors([words_of(t) for t in texts], settings)
        lists = pa.ListArray.from_arrays(_offsets(owner, len(texts)), pa.array(grams))
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), lists], names=["key", "grams"])

    return rows.select("key", "text").mapInArrow(
        lambda batches: _by_text(batches, settings.at_once, of), _GRAMS
    )


def _cut(texts: DataFrame, settings: WindowSettings) -> DataFrame:
    """The stretches of each text's shared anchors (`grams`)."""

    def of(keys, firsts, texts, grams):
        words = [words_of(t) for t in texts]
        owner, found, lows, highs = anchors(words, settings)
        shared = np.zeros(len(owner), bool)
        ends = np.cumsum(np.bincount(owner, minlength=len(words)))
        for k, end in enumerate(ends):
            begin = ends[k - 1] if k else 0
            shared[begin:end] = np.isin(found[begin:end], np.array(grams[k], np.int64))
        owner, found, lows, highs = owner[shared], found[shared], lows[shared], highs[shared]
        parts = [
            b" ".join(words[k][low:high])
            for k, low, high in zip(owner.tolist(), lows.tolist(), (highs + settings.length).tolist())
        ]
        rows = pa.StructArray.from_arrays(
            [pa.array(lows.astype(np.int32)), pa.array(found), pa.array(parts, pa.binary()).cast(pa.string())],
            names=["low", "gram", "part"],
        )
        lists = pa.ListArray.from_arrays(_offsets(owner, len(keys)), rows)
        columns = [pa.array(keys, pa.binary()), pa.array(firsts, pa.int64()), lists]
        return pa.RecordBatch.from_arrays(columns, names=["key", "first", "stretches"])

    cut = texts.select("key", "first", "text", "grams").mapInArrow(
        lambda batches: _by_text(batches, settings.at_once, of), _STRETCHES
    )
    return cut.select("key", "first", F.inline("stretches"))


def _searched(cells: DataFrame, settings: WindowSettings) -> DataFrame:
    """Reported windows of the distinct parts (`cell`, `part`, `first`, `last`), shard by shard."""
    dealt = cells.repartition("cell").sortWithinPartitions("cell")

    def shard(held):
        rows = pd.concat(held, ignore_index=True)
        # A part by itself, of one document, meets nothing.
        lone = ~rows["cell"].duplicated(keep=False) & (rows["first"] == rows["last"])
        rows = rows[~lone].sort_values("first", kind="stable")
        names = rows["part"].tolist()
        found = search(
            [words_of(p) for p in names],
            rows["first"].to_numpy(np.int64), rows["last"].to_numpy(np.int64), settings.length,
        )
        return pd.DataFrame(
            [(names[k], *rest) for k, *rest in found], columns=["part", "low", "length", "least"]
        )

    def run(batches):
        held, size = [], 0
        for batch in batches:
            cell = batch["cell"].to_numpy()
            sizes = np.cumsum(batch["part"].str.count(" ").to_numpy() + 2) if len(batch) else []
            ends = np.flatnonzero(np.r_[cell[1:] != cell[:-1], True]) + 1 if len(batch) else []
            begin, done = 0, 0
            for k, end in enumerate(ends):
                # A cell may go on in the next batch; it is closed when another one begins.
                if held and begin < end and size >= settings.shard and cell[begin] != held[-1]["cell"].iloc[-1]:
                    yield shard(held)
                    held, size = [], 0
                held.append(batch.iloc[begin:end])
                size += int(sizes[end - 1]) - done
                begin, done = end, int(sizes[end - 1])
        if held:
            yield shard(held)

    return dealt.mapInPandas(run, _FOUND)


def _single_windows(parts: DataFrame, settings: WindowSettings) -> DataFrame:
    """Every window of the parts, with the part and the place in it."""
    words = F.split("part", " ")
    places = F.sequence(F.lit(0), F.size("words") - settings.length)
    return (
        parts.withColumn("words", words)
        .withColumn("at", F.explode(places))
        .select("part", "first", "last", "at", F.array_join(F.slice("words", F.col("at") + 1, settings.length), " ").alias("window"))
    )


def _reported(stretches: DataFrame, settings: WindowSettings) -> DataFrame:
    """part, low, length, least: windows of each different stretch that start in a smaller
    document than some document with that stretch."""
    parts = written(
        stretches.groupBy("gram", "part").agg(F.min("first").alias("first"), F.max("first").alias("last")),
        "window-parts",
    )
    sizes = written(
        parts.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > settings.hot), "window-hot"
    )
    plain = parts.join(sizes, "gram", "left_anti").withColumnRenamed("gram", "cell")
    found = _searched(plain.select("cell", "part", "first", "last"), settings)
    windows = written(_single_windows(parts.join(sizes, "gram", "left_semi"), settings), "window-single")
    alone = windows.groupBy("window").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    named = alone.select(F.xxhash64("window").alias("cell"), F.col("window").alias("part"), "first", "last")
    single = _searched(named, settings).select(F.col("part").alias("window"), "least")
    again = windows.join(single, "window").select(
        "part", F.col("at").alias("low"), F.lit(1).alias("length"), "least"
    )
    result = written(found.union(again), "window-found")
    forget(parts, sizes, windows)
    return result


def repeated_windows(docs: DataFrame, settings: WindowSettings = WindowSettings()) -> DataFrame:
    """key, first, lows, lengths: the smallest document with the text of that key, and places
    and numbers of the windows, one after another, that a still smaller document has too.
    `docs` has doc_id, key (md5 of the text) and text."""
    known = docs.where(F.col("doc_id").isNotNull())
    grams = written(_grams(known.select("key", "text"), settings), "window-grams")
    each = grams.select("key", F.explode("grams").alias("gram"))
    shared = written(
        # 64 bits tell two texts apart here.
        each.select("gram", F.xxhash64("key").alias("mark"))
        .groupBy("gram")
        .agg(F.min("mark").alias("least"), F.max("mark").alias("most"))
        .where("least < most")
        .select("gram"),
        "window-shared",
    )
    firsts = known.groupBy("key").agg(F.min("doc_id").alias("first"))
    spots = written(
        each.join(shared.hint("merge"), "gram")
        .groupBy("key")
        .agg(F.collect_set("gram").alias("grams"))  # no more than the text has words
        .join(firsts, "key"),
        "window-spots",
    )
    forget(grams, shared)
    texts = known.withColumnRenamed("doc_id", "first").join(spots.hint("merge"), ["key", "first"])
    cut = written(_cut(texts.select("key", "first", "text", "grams"), settings), "window-stretches")
    forget(spots)
    found = _reported(cut, settings)
    places = (
        cut.select("key", "first", F.col("low").alias("at"), "part")
        .join(found.hint("merge"), "part")
        .where(F.col("least") < F.col("first"))
        .groupBy("key")
        # a set: rows that stand several times count once
        .agg(F.collect_set(F.struct((F.col("at") + F.col("low")).alias("low"), "length")).alias("spans"))
        .select("key", F.col("spans.low").alias("lows"), F.col("spans.length").alias("lengths"))
    )
    # Stored, so that the join with the texts can split the copies of one.
    result = written(places.join(firsts, "key", "right"), "window-places")
    forget(cut, found)
    return result


def uncovered(words: list[bytes], lows, lengths, everything: bool, length: int) -> list[bytes]:
    """The words under none of the windows."""
    if everything and len(words) >= length:
        return []
    if lows is None or not len(lows):
        return words
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, np.asarray(lows, np.int64), 1)
    np.add.at(step, np.asarray(lows, np.int64) + np.asarray(lengths, np.int64) + length - 1, -1)
    covered = np.cumsum(step[:-1]) > 0
    return [w for w, gone in zip(words, covered.tolist()) if not gone]


def remove_windows(
    docs: DataFrame,
    settings: WindowSettings = WindowSettings(),
    *,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words, joined by one space, of every row."""
    rows = pick(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    keyed = rows.withColumn("key", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    places = repeated_windows(keyed, settings)
    marked = keyed.join(places.hint("merge"), "key", "left").select(
        "doc_id", "text", "lows", "lengths",
        F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).alias("later"),
        F.col("doc_id").isNotNull().alias("known"),
    )

    def run(batches):
        for batch in batches:
            out = []
            for text_, lows, lengths, later, known in zip(
                *[batch[c] for c in ("text", "lows", "lengths", "later", "known")]
            ):
                words = words_of(text_)
                kept = uncovered(words, lows if known else None, lengths, later, settings.length)
                joined = b" ".join(kept).decode("utf-8", "surrogatepass")
                out.append((len(words), len(words) - len(kept), joined))
            frame = pd.DataFrame(out, columns=["n_words", "n_removed", "kept"])
            frame.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield frame

    return map_rows(marked, run, _KEPT)


def digests(kept: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256, then the kept words."""
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), "kept")
