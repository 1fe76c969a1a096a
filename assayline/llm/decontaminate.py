"""Benchmark decontamination by SimHash fingerprints of item-sized windows.

DataFrame functions only. A window as long as a benchmark item can be similar to it only if
they share a shingle of five words, so windows are laid where a text has a shingle of an
item, aligned with it; every other window has similarity 0. An item of fewer words is one
shingle, which a window of as many words has or has not.

Windows and items get 64-bit SimHash fingerprints of their words. The radius follows from
the item's length: as many words as a similar window may lack or have in place of the item's
own flip each bit with a known chance, and the radius lies some standard deviations above
the mean. With radius + 1 blocks of bits, fingerprints at most that far apart agree in a
whole block, so equality joins on the blocks find all pairs within the radius. The weighted
(multiset) shingle similarity of these pairs is then computed exactly.

Fingerprints can be further apart than any radius, so a small share of similar windows may
be missed. With `exact`, pairs that share one of the item's rarest shingles, which no similar
pair can do without, are compared too, and nothing is missed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from assayline.llm.tables import columns_of, let, pick, row_of, written

BITS = 64


@dataclass(frozen=True)
class LeakSettings:
    shingle: int = 5
    similarity: float = 0.8
    # Standard deviations of the distance that the radius lies above its mean.
    deviations: float = 5.0
    # Compare pairs beyond the radius as well.
    exact: bool = False
    # The shingles of all items are broadcast up to this many; 16 bytes each. Beyond it
    # both sides are shuffled, with the same result.
    broadcast_shingles: int = 1_000_000


def radius_of(length: int, settings: LeakSettings = LeakSettings()) -> int:
    """Distance up to which the windows of an item of `length` words are compared.

    A similar window has at most `replaced` words of its own, which stand together, or ends
    up to `cut` words early at the end of its text. A bit is the sign of a sum over words; two
    sums of correlation c differ in sign with the chance arccos(c) / pi.
    """
    shingles = max(length - settings.shingle + 1, 1)
    t = settings.similarity
    replaced = math.floor(shingles * (1 - t) / (1 + t) + 1e-9)
    cut = math.floor(shingles * (1 - t) + 1e-9)
    if not replaced and not cut:
        return 0
    correlation = min(1 - replaced / length, math.sqrt(1 - cut / length))
    flips = math.acos(correlation) / math.pi
    mean = BITS * flips
    return min(BITS - 1, math.ceil(mean + settings.deviations * math.sqrt(mean * (1 - flips))))


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")


def _runs(values: Column, size: int, kind: str, run) -> Column:
    """`run(values, i)` for every place i with `size` values from it on."""

    def whole(v: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(v) - size)
        return F.when(F.size(v) >= size, F.transform(places, lambda i: run(v, i))).otherwise(
            F.array().cast(f"array<{kind}>")
        )

    return let(values, whole)


def _shingle_hashes(words: Column, size: int) -> Column:
    """Hash of every `size` words in a row; none for a shorter text."""
    return _runs(
        F.transform(words, lambda w: F.xxhash64(w)),
        size,
        "bigint",
        lambda v, i: F.xxhash64(F.lit(size), *[F.get(v, i + k) for k in range(size)]),
    )


def _shingles(words: Column, size: int) -> Column:
    """Every `size` words in a row; a shorter text is one shingle."""
    runs = _runs(words, size, "string", lambda v, i: F.array_join(F.slice(v, i + 1, size), " "))
    return F.when(F.size(words) >= size, runs).otherwise(F.array(F.array_join(words, " ")))


def fingerprint(words: Column) -> Column:
    """SimHash: bit b is set where most of the words' hashes have it."""

    def bits(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.lit(BITS - 1)),
            lambda b: F.when(
                F.size(F.filter(hashes, lambda h: _bit(h, b) == 1)) * 2 > F.size(hashes), "1"
            ).otherwise("0"),
        )

    return F.array_join(let(F.transform(words, lambda w: F.xxhash64(w)), bits), "")


def _bit(value: Column, place: Column) -> Column:
    return F.call_function("getbit", value, place)


def _with_blocks(rows: DataFrame) -> DataFrame:
    """A row for each of radius + 1 stretches that cover all bits of `print` once."""

    def cut(k: Column) -> Column:
        return F.floor(F.lit(BITS) * k / (F.col("radius") + 1)).cast("int")

    parts = F.transform(
        F.sequence(F.lit(0), F.col("radius")),
        lambda k: F.struct(
            k.alias("place"), F.substring(F.col("print"), cut(k) + 1, cut(k + 1) - cut(k)).alias("bits")
        ),
    )
    return rows.withColumn("block", F.explode(parts))


def _apart(a: str, b: str) -> Column:
    """Number of bits in which two fingerprints differ."""
    halves = []
    for start in (1, BITS // 2 + 1):
        x, y = [F.conv(F.substring(c, start, BITS // 2), 2, 10).cast("bigint") for c in (a, b)]
        halves.append(F.bit_count(x.bitwiseXOR(y)))
    return reduce(lambda m, n: m + n, halves)


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard of two bags of shingles: shared over all, counts counted."""

    def count(bag: Column, s: Column) -> Column:
        return F.size(F.filter(bag, lambda x: x == s))

    def repeats(bag: Column) -> Column:
        return F.size(F.array_distinct(bag)) < F.size(bag)

    counted = F.aggregate(
        F.array_distinct(a), F.lit(0), lambda n, s: n + F.least(count(a, s), count(b, s))
    )
    # Where no shingle of one side stands twice, each counts once at most.
    shared = F.when(repeats(a) & repeats(b), counted).otherwise(F.size(F.array_intersect(a, b)))
    return F.try_divide(shared.cast("double"), F.size(a) + F.size(b) - shared)


def _items(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """Distinct item texts of at least one word, with all their ids."""
    rows = pick(benchmark, item_id=item_id, text=text).where(F.col("text").isNotNull())
    words = rows.select("item_id", words_of(F.col("text")).alias("words"))
    return (
        words.where(F.size("words") > 0)
        .groupBy("words")
        .agg(F.collect_set("item_id").alias("item_ids"))
        .withColumn("item", F.array_join("words", " "))
        .withColumn("length", F.size("words"))
    )


def _hashes_of(words: Column, sizes: list[int], length: Column | None = None) -> Column:
    """Hashes of the shingles of all sizes with their places; with a length, of its size only."""
    found = []
    for size in sizes:
        hashes = F.transform(
            _shingle_hashes(words, size), lambda h, i: F.struct(i.alias("at"), h.alias("hash"))
        )
        if length is not None:
            own = length == size if size < max(sizes) else length >= size
            hashes = F.when(own, hashes).otherwise(F.array().cast("array<struct<at:int,hash:bigint>>"))
        found.append(hashes)
    return F.concat(*found)


def _windows(
    docs: DataFrame, items: DataFrame, sizes: list[int], settings: LeakSettings, doc_id: str, text: str
):
    """doc_id, key, first word, item size and words of every window laid beside a shingle."""
    seeds = (
        items.select("length", F.inline(_hashes_of(F.col("words"), sizes, F.col("length"))))
        .select("length", F.col("at").alias("offset"), "hash")
        .distinct()
    )
    rows = pick(docs, doc_id=doc_id, text=text).where(F.col("text").isNotNull())
    worded = rows.select(
        "doc_id", F.unhex(F.md5("text")).alias("key"), words_of(F.col("text")).alias("words")
    )
    hashes = F.inline(_hashes_of(F.col("words"), sizes))
    if seeds.limit(settings.broadcast_shingles + 1).count() <= settings.broadcast_shingles:
        met = worded.select("doc_id", "key", "words", hashes).join(F.broadcast(seeds), "hash")
    else:
        # Both sides are shuffled, without the words; those of texts that met are fetched again.
        slim = worded.select("key", hashes).distinct()
        places = slim.join(seeds.hint("merge"), "hash")
        met = worded.join(places.select("key", "at", "offset", "length").distinct(), "key")
    # Inside the text, at its ends moved inwards.
    last = F.greatest(F.size("words") - F.col("length"), F.lit(0))
    start = F.least(F.greatest(F.col("at") - F.col("offset"), F.lit(0)), last)
    return met.select(
        "doc_id",
        "key",
        start.alias("start"),
        "length",
        F.array_join(F.slice("words", start + 1, F.col("length")), " ").alias("window"),
    ).distinct()


def _rare(items: DataFrame, sizes: list[int], settings: LeakSettings) -> DataFrame:
    """length, hash and item of the rarest shingles of every item, so many that a window
    without one of them shares less than `similarity` of the item's shingles, which it needs."""
    hashed = items.select(
        "item", "length", F.inline(_hashes_of(F.col("words"), sizes, F.col("length")))
    ).drop("at")
    held = hashed.groupBy("length", "hash").agg(F.count_distinct("item").alias("held"))
    ranked = (
        hashed.join(held, ["length", "hash"])
        .groupBy("length", "item")
        # the shingles of one item
        .agg(F.array_sort(F.collect_list(F.struct("held", "hash"))).alias("shingles"))
    )
    # Shared over all is at most shared over the item's, also where the window is shorter.
    needed = F.ceil(F.size("shingles") * settings.similarity - 1e-9)
    taken = F.slice("shingles", 1, (F.size("shingles") - needed + 1).cast("int"))
    return ranked.select("length", "item", F.explode(taken["hash"]).alias("hash")).distinct()


def _within_radius(passages: DataFrame, items: DataFrame, settings: LeakSettings) -> DataFrame:
    """length, window, item of all fingerprints within the radius of the item's length."""
    lengths = [row[0] for row in items.select("length").distinct().collect()]
    # One number for each length of an item.
    radii = F.create_map(*[F.lit(x) for n in lengths for x in (n, radius_of(n, settings))]) if lengths else None
    radius = radii[F.col("length")] if lengths else F.lit(0)
    ours = passages.withColumn("print", fingerprint(F.split("window", " "))).withColumn("radius", radius)
    theirs = items.select("length", "item", fingerprint(F.col("words")).alias("print")).withColumn(
        "radius", radius
    )
    blocks = _with_blocks(theirs).withColumnRenamed("print", "item_print").drop("radius")
    return (
        _with_blocks(ours)
        .join(blocks, ["length", "block"])
        .where(_apart("print", "item_print") <= F.col("radius"))
        .select("length", "window", "item")
    )


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    settings: LeakSettings = LeakSettings(),
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per window that repeats an item: doc_id, key (md5 of the text), item_id,
    start_word, n_words, similarity.

    Words are lower case, parted by white space. Texts and items that are null or without
    words repeat nothing; an item of fewer words than a shingle is found where a text has all
    of them in order. Rows with equal doc_id and text give their windows once; items with
    equal words are all reported. Empty tables give no rows. Other columns are left out.
    """
    items = _items(benchmark, item_id, item_text)
    sizes = sorted(
        row[0] for row in items.select(F.least("length", F.lit(settings.shingle))).distinct().collect()
    ) or [settings.shingle]
    # Stored, as they are used twice and all texts are read for them.
    windows = written(_windows(docs, items, sizes, settings, doc_id, text), "leak-windows")
    # A passage that many documents hold is compared once.
    passages = windows.select("length", "window").distinct()
    pairs = _within_radius(passages, items, settings)
    if settings.exact:
        rare = passages.withColumn(
            "found", F.explode(_hashes_of(F.split("window", " "), sizes, F.col("length")))
        ).select("length", "window", F.col("found.hash").alias("hash"))
        beyond = rare.distinct().join(_rare(items, sizes, settings), ["length", "hash"])
        pairs = pairs.union(beyond.select("length", "window", "item"))

    def alike(bags: Column) -> Column:
        return similarity(bags["a"], bags["b"])

    bags = F.struct(
        _shingles(F.split("window", " "), settings.shingle).alias("a"),
        _shingles(F.split("item", " "), settings.shingle).alias("b"),
    )
    exact = pairs.distinct().withColumn("similarity", let(bags, alike)).where(
        F.col("similarity") >= settings.similarity
    )
    return (
        windows.join(exact, ["length", "window"])
        .join(items.select("item", F.explode("item_ids").alias("item_id")), "item")
        .select(
            "doc_id",
            "key",
            "item_id",
            F.col("start").alias("start_word"),
            F.size(F.split("window", " ")).alias("n_words"),
            "similarity",
        )
    )


def remove_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    settings: LeakSettings = LeakSettings(),
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows whose text repeats no benchmark item, with their own columns.

    Null and empty texts repeat nothing and stay; equal texts share one fate. Without items
    all rows stay. Columns may have any other names.
    """
    found = find_leaks(
        docs, benchmark, settings, text=text, doc_id=doc_id, item_id=item_id, item_text=item_text
    )
    leaked = found.select("key").distinct()
    keyed = docs.select(row_of(docs).alias("row"), F.unhex(F.md5(docs[text])).alias("key"))
    return keyed.join(leaked, "key", "left_anti").select(*columns_of(docs))
