"""Removal of long byte strings that occur more than once, with suffix arrays.

Equal strings are told apart by suffix arrays over whatever hashing leaves open:

1. Every string of `length` bytes contains an anchor, the k-gram with the smallest hash in
   it (the rightmost, if several). Equal strings have equal anchors at equal places. The
   strings that share one anchor occurrence start at neighbouring bytes. If the stretch
   they cover occurs twice, all of them do; if the anchor occurs once, none does.
2. What is left is cut into blocks of neighbouring starts. Again a block whose whole stretch
   occurs twice is repeated, one whose core (the bytes common to all its strings) occurs
   once is not.
3. The rest are blocks at the ends of matches. Each is a short string: the bytes before the
   core, the core as one symbol, the bytes after. A suffix array over many of them puts
   equal strings side by side.

Counts are added up map-side, so passages or copies with a third of all rows cost no single
task. The suffix arrays are built by linear grouping (see `suffix_array`).
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from assayline.llm.tables import forget, map_rows, pick, written

SCHEMA = (
    "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept string"
)
_ANCHORS = "key binary, pos int, low int, high int, gram bigint, span_a bigint, span_b bigint"
_BLOCKS = (
    "key binary, low int, high int, core_a bigint, core_b bigint, span_a bigint, span_b bigint, "
    "before binary, after binary"
)
_STRINGS = "key binary, low int, string_a bigint, string_b bigint, here bigint, first boolean, open boolean"


@dataclass(frozen=True)
class RepeatSettings:
    length: int = 400
    gram: int = 32
    block: int = 32
    # Starts handled at once in a very long text; the result does not depend on it.
    segment: int = 1 << 20
    # Blocks of one core that one suffix array takes; beyond it the core is dealt over
    # several, and their counts are added up.
    cell: int = 4_000
    # Symbols from which a suffix array is built.
    symbols: int = 60_000


# --- suffix array


def suffix_array(text: list[int]) -> list[int]:
    """Suffix array of whole numbers >= 0 by linear grouping.

    First phase: suffixes are grouped by first symbol, and groups are refined from the
    highest down. When a group is processed, each of its suffixes points to the nearest
    suffix before it in a lower group. Suffixes pointed at move to a new group right above
    their old one, those pointed at more often higher. In the end a group holds the
    suffixes with one longest Lyndon prefix. Second phase: scanning the array upwards, the
    chain of pointers from before a suffix fills the next free place of each group.
    """
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    group = [0] * n  # of a suffix: where its group starts in `order`
    place = [0] * n  # of a suffix in `order`
    size: dict[int, int] = {}
    start = 0
    for k in range(n):
        if k and text[order[k]] != text[order[k - 1]]:
            start = k
        group[order[k]] = start
        place[order[k]] = k
        size[start] = size.get(start, 0) + 1
    before = [-1] * n
    times = [0] * n
    end = n
    while end:
        own = group[order[end - 1]]
        pointed = []
        for s in sorted(order[own:end]):
            p = s - 1
            while p >= 0 and group[p] > own:
                p = before[p]
            if p >= 0 and group[p] == own:
                p = before[p]
            before[s] = p
            if p >= 0:
                if not times[p]:
                    pointed.append(p)
                times[p] += 1
        end = own
        if not pointed:
            continue
        pointed.sort(key=times.__getitem__, reverse=True)
        k = 0
        while k < len(pointed):
            level, moved = times[pointed[k]], {}
            while k < len(pointed) and times[pointed[k]] == level:
                p = pointed[k]
                moved.setdefault(group[p], []).append(p)
                k += 1
            for old, members in moved.items():
                new = old + size[old] - len(members)
                if new == old:
                    continue
                at = old + size[old]
                for p in members:
                    at -= 1
                    other, q = order[at], place[p]
                    order[at], order[q] = p, other
                    place[p], place[other] = at, q
                    group[p] = new
                size[old] -= len(members)
                size[new] = len(members)
        for p in pointed:
            times[p] = 0
    # Second phase. The empty suffix is the first; what precedes it is the last symbol.
    free = {g: g for g in size}
    result = [-1] * n
    placed = [False] * n
    for k in range(-1, n):
        s = n if k < 0 else result[k]
        p = s - 1
        while p >= 0 and not placed[p]:
            g = group[p]
            result[free[g]] = p
            free[g] += 1
            placed[p] = True
            p = before[p]
    return result


def repeated_strings(pieces: list[tuple[bytes, int, bytes]], length: int):
    """Classes of equal strings of `length` symbols in (before, core, after) pieces.

    Yields (piece, start in it) lists, one for each different string.
    """
    text: list[int] = []
    owner, begin = [], []
    for k, (before, core, after) in enumerate(pieces):
        own = [*before, core, *after]
        starts = max(0, len(own) - length + 1)
        owner += [(k, i) for i in range(starts)]
        begin += range(len(text), len(text) + starts)
        text += own
        text.append(-1 - k)  # separators, all different
    if not text:
        return
    lowest = -min(text)
    values = np.array(text) + lowest
    _, dense = np.unique(values, return_inverse=True)
    array = np.array(suffix_array(dense.tolist()))
    where = np.full(len(text), -1)
    where[begin] = np.arange(len(begin))
    ranked = array[where[array] >= 0]
    if not len(ranked):
        return
    padded = np.r_[dense, np.full(length, -1)]
    rows = padded[ranked[:, None] + np.arange(length)]
    same = (rows[1:] == rows[:-1]).all(axis=1)
    cuts = np.r_[0, np.flatnonzero(~same) + 1, len(ranked)]
    for a, b in zip(cuts, cuts[1:]):
        yield [owner[where[p]] for p in ranked[a:b]]


# --- hashes of substrings

_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_powers: dict[int, tuple] = {}


def _base_powers(n: int):
    """Powers of both bases and of their inverses modulo 2 ** 64."""
    size = max(_powers, default=0)
    if size < n:
        size = max(n, 1 << 16)
        _powers.clear()
        made = []
        for base in _BASES:
            inverse = np.uint64(pow(int(base), -1, 1 << 64))
            for b in (base, inverse):
                column = np.full(size, b)
                column[0] = 1
                made.append(np.cumprod(column))
        _powers[size] = tuple(made)
    return _powers[size]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashed:
    """Hashes of any substrings of a text, from sums over its beginnings."""

    def __init__(self, raw: bytes):
        self.bytes = np.frombuffer(raw, np.uint8)
        values = self.bytes.astype(np.uint64) + np.uint64(1)
        self.powers = _base_powers(len(raw) + 1)
        self.sums = [
            np.r_[np.uint64(0), np.cumsum(values * self.powers[2 * k][: len(raw)])] for k in (0, 1)
        ]

    def of(self, starts, ends, which: int, salt=0) -> np.ndarray:
        sums, inverse = self.sums[which], self.powers[2 * which + 1]
        plain = (sums[ends] - sums[starts]) * inverse[starts]
        return _mix(plain + np.asarray(salt, np.uint64) * _BASES[1 - which]).view(np.int64)


def anchors(raw: bytes, settings: RepeatSettings) -> tuple[np.ndarray, ...]:
    """Anchor occurrences: place, first and last start of its strings, hashes of the gram
    and (twice) of the stretch with the anchor's place in it."""
    found = [np.zeros(0, np.int64)] * 6
    total = len(raw) - settings.length + 1
    parts = []
    for first in range(0, max(0, total), settings.segment):
        count = min(settings.segment, total - first)
        h = Hashed(raw[first : first + count + settings.length - 1])
        grams = np.arange(len(h.bytes) - settings.gram + 1)
        hashes = h.of(grams, grams + settings.gram, 0)
        # Smallest hash, and among equals the last place.
        keyed = hashes.view(np.uint64) >> np.uint64(24) << np.uint64(24)
        keyed |= np.uint64((1 << 24) - 1) - grams.astype(np.uint64)
        lowest = _window_minimum(keyed, settings.length - settings.gram + 1)
        place = ((1 << 24) - 1) - (lowest & np.uint64((1 << 24) - 1)).astype(np.int64)
        cuts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        low, high = cuts, np.r_[cuts[1:], count] - 1
        pos = place[low]
        salt = (pos - low) * (1 << 20) + (high - low)
        spans = [h.of(low, high + settings.length, k, salt) for k in (0, 1)]
        parts.append((pos + first, low + first, high + first, hashes[pos], *spans))
    return tuple(np.concatenate(c) for c in zip(*parts)) if parts else tuple(found)


def _window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` values in a row, in a few passes."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def blocks(raw: bytes, spots, settings: RepeatSettings):
    """Blocks of starts of unsettled anchors (place, first, last start, gram hash)."""
    h, width = Hashed(raw), settings.block
    pos, low, high, gram = (np.asarray(c, np.int64) for c in spots)
    nearest, furthest = (pos - high) // width, (pos - low) // width
    counts = furthest - nearest + 1
    pick_ = np.repeat(np.arange(len(pos)), counts)
    j = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + nearest[pick_]
    pos, low, high, gram = pos[pick_], low[pick_], high[pick_], gram[pick_]
    high = np.minimum(high, pos - j * width)
    low = np.maximum(low, pos - j * width - width + 1)
    core = pos - j * width
    core_end = core + settings.length - width + 1
    seed = gram.view(np.uint64) + j.astype(np.uint64)
    cores = [h.of(core, core_end, k, seed) for k in (0, 1)]
    salt = seed + ((pos - low) * 4096 + (high - low)).astype(np.uint64)
    spans = [h.of(low, high + settings.length, k, salt) for k in (0, 1)]
    before = [raw[a:b] for a, b in zip(low.tolist(), core.tolist())]
    after = [raw[a:b] for a, b in zip(core_end.tolist(), (high + settings.length).tolist())]
    return low, high, *cores, *spans, before, after


# --- Spark steps


def _bytes(text) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def _anchored(rows: DataFrame, settings: RepeatSettings) -> DataFrame:
    def run(batches):
        for batch in batches:
            keys, columns = [], []
            for key, text in zip(batch["key"], batch["text"]):
                found = anchors(_bytes(text), settings)
                keys += [key] * len(found[0])
                columns.append(found)
                if len(keys) > 200_000:
                    yield _anchor_frame(keys, columns)
                    keys, columns = [], []
            yield _anchor_frame(keys, columns)

    return rows.mapInPandas(run, _ANCHORS)


def _anchor_frame(keys, columns) -> pd.DataFrame:
    merged = [np.concatenate(c) for c in zip(*columns)] if columns else [np.zeros(0, np.int64)] * 6
    names = ["pos", "low", "high", "gram", "span_a", "span_b"]
    return pd.DataFrame({"key": keys} | dict(zip(names, merged)))


def _met_again(found: DataFrame) -> DataFrame:
    """Anchor occurrences whose gram stands at two places of different texts or one text;
    one row for the copies of a text."""
    place = F.xxhash64("key", "pos")
    shared = written(
        found.select("gram", place.alias("place"))
        .groupBy("gram")
        .agg(F.min("place").alias("least"), F.max("place").alias("most"))
        .where("least < most")
        .select("gram"),
        "repeat-grams",
    )
    # Both sides are stored, so that the rows of a gram in most texts can be split.
    again = found.join(shared.hint("merge"), "gram").dropDuplicates(["key", "low"])
    met = written(again, "repeat-anchors-met")
    forget(found, shared)
    return met


def _settled(rows: DataFrame, group: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows whose stretch occurs again, what must be looked at more closely, the table both
    read).

    The second has one row of every different stretch of a group that has several: a string
    of one stretch may also stand in another, whether that one occurs again or not. `n` is
    their number.
    """
    spans = ["span_a", "span_b"]
    others = [c for c in rows.columns if c not in group + spans]
    counted = written(
        rows.groupBy(*group, *spans).agg(
            F.count("*").alias("_same"), F.min(F.struct(*others)).alias("_one")
        ),
        "repeat-counted",
    )
    mixed = counted.groupBy(*group).agg(F.count("*").alias("n")).where("n > 1")
    again = counted.where("_same > 1").select(*group, *spans)
    closer = counted.join(mixed, group).select(*group, *spans, "_one.*", "n")
    return rows.join(again.hint("merge"), [*group, *spans]), closer, counted


def _blocked(rows: DataFrame, open_: DataFrame, settings: RepeatSettings) -> DataFrame:
    # The anchors of one text meet again; there are no more than it has bytes.
    spots = open_.groupBy("key").agg(
        *[F.collect_list(c).alias(c) for c in ("pos", "low", "high", "gram")]
    )

    def run(batches):
        names = ["low", "high", "core_a", "core_b", "span_a", "span_b", "before", "after"]
        for batch in batches:
            for key, text, *spot in batch.itertuples(index=False):
                found = blocks(_bytes(text), spot, settings)
                yield pd.DataFrame({"key": [key] * len(found[0])} | dict(zip(names, found)))

    # One row stands for the copies of a text; they collapse before they are dealt out.
    texts = rows.groupBy("key").agg(F.first("text").alias("text"))
    both = texts.join(spots, "key").select("key", "text", "pos", "low", "high", "gram")
    return both.mapInPandas(run, _BLOCKS)


def _strings(open_: DataFrame, settings: RepeatSettings) -> DataFrame:
    """Repeated strings among unsettled blocks, and all strings of cores dealt over several
    suffix arrays."""
    shares = F.ceil(F.col("n") / settings.cell).cast("int")
    cells = (
        open_.withColumn("open", shares > 1)
        .withColumn("cell", F.xxhash64("core_a", "core_b", F.pmod(F.xxhash64("key", "low"), shares)))
        .select("cell", "key", "low", "core_a", "core_b", "before", "after", "open")
        .repartition("cell")
        .sortWithinPartitions("cell")
    )

    def run(batches):
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            if sum(map(len, held)) * settings.block < settings.symbols:
                continue
            rows = pd.concat(held, ignore_index=True)
            cell = rows["cell"].to_numpy()
            ready = int(np.searchsorted(cell, cell[-1], side="left"))
            held = [rows.iloc[ready:]]
            yield from _bins(rows.iloc[:ready], settings)
        if held:
            yield from _bins(pd.concat(held, ignore_index=True), settings)

    return cells.mapInPandas(run, _STRINGS)


def _bins(rows: pd.DataFrame, settings: RepeatSettings):
    """One suffix array for whole cells of about `symbols` symbols."""
    cell = rows["cell"].to_numpy()
    step = max(1, settings.symbols // (2 * settings.block))
    first = 0
    while first < len(rows):
        last = min(len(rows), first + step)
        if last < len(rows):
            last = int(np.searchsorted(cell, cell[last - 1], side="right"))
        yield _bin(rows.iloc[first:last], settings)
        first = last


def _bin(rows: pd.DataFrame, settings: RepeatSettings) -> pd.DataFrame:
    cores: dict[tuple, int] = {}
    pieces = [
        (bytes(b), cores.setdefault((x, y), 256 + len(cores)), bytes(a))
        for b, x, y, a in zip(rows["before"], rows["core_a"], rows["core_b"], rows["after"])
    ]
    keys, lows, opens = rows["key"].tolist(), rows["low"].tolist(), rows["open"].tolist()
    pairs = list(zip(rows["core_a"].tolist(), rows["core_b"].tolist()))
    out = []
    for members in repeated_strings(pieces, settings.block):
        k, i = members[0]
        if len(members) == 1 and not opens[k]:
            continue
        string = (0, 0)
        if opens[k]:
            before, _, after = pieces[k]
            used = before[i:]
            whole = repr((pairs[k], used, after[: settings.block - 1 - len(used)])).encode()
            digest = xxhash.xxh3_128_digest(whole)
            string = tuple(np.frombuffer(digest, np.int64).tolist())
        for rank, (k, i) in enumerate(members):
            out.append((keys[k], lows[k] + i, *string, len(members), rank == 0, opens[k]))
    return pd.DataFrame(
        out, columns=["key", "low", "string_a", "string_b", "here", "first", "open"]
    )


def repeated_starts(docs: DataFrame, settings: RepeatSettings = RepeatSettings()) -> DataFrame:
    """key, low, high: all bytes low..high start a string of `length` bytes that starts
    anywhere else too. `docs` has key (md5 of the text) and text."""
    found = _met_again(written(_anchored(docs, settings), "repeat-anchors"))
    sure, open_, anchors_counted = _settled(found, ["gram"])
    cut = written(_blocked(docs, open_, settings), "repeat-blocks")
    sure = written(sure.select("key", "low", "high"), "repeat-sure")
    forget(found, anchors_counted)
    more, unsettled, blocks_counted = _settled(cut, ["core_a", "core_b"])
    strings = written(_strings(unsettled, settings), "repeat-strings")
    more = written(more.select("key", "low", "high"), "repeat-more")
    forget(cut, blocks_counted)
    dealt = strings.where("open")
    # A string of a core that several suffix arrays share: its counts together.
    shared = (
        dealt.where("first")
        .groupBy("string_a", "string_b")
        .agg(F.sum("here").alias("_all"))
        .where("_all > 1")
    )
    late = dealt.join(shared, ["string_a", "string_b"]).select("key", "low")
    single = strings.where("NOT open").select("key", "low").union(late)
    return sure.union(more).union(single.select("key", "low", F.col("low").alias("high")))


def remove(raw: bytes, lows, highs, whole: bool, length: int) -> tuple[bytes, int, int]:
    """What is left of a text, the bytes removed and the number of removed runs."""
    if whole:
        return b"", len(raw), 1
    if not len(lows):
        return raw, 0, 0
    step = np.zeros(len(raw) + 1, np.int64)
    np.add.at(step, np.asarray(lows, np.int64), 1)
    np.add.at(step, np.asarray(highs, np.int64) + length, -1)
    gone = np.cumsum(step[:-1]) > 0
    runs = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
    return kept, int(np.count_nonzero(gone)), runs


def _marked(keyed: DataFrame, settings: RepeatSettings) -> DataFrame:
    """The rows with `lows` and `highs`, the repeated starts of their text, and `whole` for
    texts that stand twice and go entirely. `keyed` has key (md5 of the text) and text."""
    long = keyed.where(F.octet_length("text") >= settings.length).select("key", "text")
    copied = (
        long.groupBy("key").agg(F.count("*").alias("_copies")).where("_copies > 1").select("key")
    )
    parts = repeated_starts(long, settings)
    # Copies are removed whole, so their repeated starts are not needed; what is left are
    # the starts of one row for each key.
    spots = (
        parts.join(copied, "key", "left_anti")
        .groupBy("key")
        .agg(F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs"))
    )
    none = F.array().cast("array<int>")
    every = written(
        spots.withColumn("whole", F.lit(False)).unionByName(
            copied.select("key", none.alias("lows"), none.alias("highs"), F.lit(True).alias("whole"))
        ),
        "repeat-spots",
    )
    return keyed.join(every.hint("merge"), "key", "left").withColumn(
        "whole", F.coalesce("whole", F.lit(False))
    )


def _removed(text, lows, highs, whole: bool, settings: RepeatSettings):
    raw = _bytes(text)
    lows = () if lows is None else lows
    highs = () if highs is None else highs
    return raw, *remove(raw, lows, highs, whole, settings.length)


def _as_text(kept: bytes) -> str:
    """Removal may cut a character; the bytes left of it become U+FFFD."""
    return kept.decode("utf-8", "replace")


def deduplicate(
    docs: DataFrame,
    settings: RepeatSettings = RepeatSettings(),
    *,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept text of every row.

    Judged on the input as it is: a row that stands twice is removed whole from
    `length` bytes on. A null or empty text has no bytes, nothing removed and the digest of
    nothing. One row per input row; other columns are left out. The digest is of the bytes
    that are left, `kept` is these bytes as text, with U+FFFD for what is left of a character
    that was cut.
    """
    rows = pick(docs, doc_id=doc_id, text=text).withColumn("text", F.coalesce("text", F.lit("")))
    keyed = rows.withColumn("key", F.unhex(F.md5("text")))
    marked = _marked(keyed, settings).select("doc_id", "text", "lows", "highs", "whole")

    def run(batches):
        for batch in batches:
            out = []
            for text_, lows, highs, whole in zip(*[batch[c] for c in ("text", "lows", "highs", "whole")]):
                raw, kept, n, runs = _removed(text_, lows, highs, whole, settings)
                out.append((len(raw), n, runs, hashlib.sha256(kept).hexdigest(), _as_text(kept)))
            frame = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
            frame.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield frame

    return map_rows(marked, run, SCHEMA)


def remove_repeats(
    docs: DataFrame, settings: RepeatSettings = RepeatSettings(), *, text: str = "text"
) -> DataFrame:
    """All rows and columns of `docs`, the text without its repeated strings.

    Nulls stay null; a text nothing of which repeats comes back as it was.
    """
    row = F.struct(*[docs[c] for c in docs.columns])
    keyed = docs.select(row.alias("row"), F.coalesce(docs[text], F.lit("")).alias("text"))
    marked = _marked(keyed.withColumn("key", F.unhex(F.md5("text"))), settings)

    @F.pandas_udf("string")
    def without(text_: pd.Series, lows: pd.Series, highs: pd.Series, whole: pd.Series) -> pd.Series:
        parts = zip(text_, lows, highs, whole)
        return pd.Series([_as_text(_removed(*p, settings)[1]) for p in parts], dtype=object)

    left = F.when(F.col("lows").isNull() | F.col(f"row.{text}").isNull(), F.col(f"row.{text}")).otherwise(
        without("text", "lows", "highs", "whole")
    )
    return marked.withColumn("_left", left).select(
        *[F.col("_left").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns]
    )
