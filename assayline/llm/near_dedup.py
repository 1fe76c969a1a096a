"""Near-duplicate classes by ProbMinHash, banding and exact verification.

A text is a bag of five-word shingles weighted by their counts. Every shingle starts a
Poisson process whose rate is its weight; each arrival is dealt to one of the signature's
places, and a place keeps the shingle that arrives first. Two signatures then agree in a
place with the probability Jaccard similarity of the bags. Arrivals later than everything
the signature holds change nothing, so a process stops there.

Texts that agree in a whole band are candidates. Classes are the connected components of
the pairs whose exact similarity reaches the threshold. Comparing all pairs of a band's
bucket would be quadratic, and most pairs are needless: first everybody is compared with
one leader, then only members that are not yet in the leader's class are compared with the
others, by signature and then exactly, unless their classes have been joined meanwhile.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from assayline.llm.tables import columns_of, forget, pick, row_of, written

SIGNED = "key binary, signature binary"
PAIRS = "a binary, b binary, similarity double"


@dataclass(frozen=True)
class NearSettings:
    shingle: int = 5
    similarity: float = 0.8
    bands: int = 24
    rows: int = 5
    # Signatures that agree in a smaller share of places are not compared exactly. With 120
    # places that is over four standard deviations below the threshold.
    likely: float = 0.64
    # Members of a bucket, and those outside the leader's class, that meet in one task.
    block: int = 1_000

    @property
    def places(self) -> int:
        return self.bands * self.rows


# --- bags and signatures


def words_of(text: str) -> list[str]:
    return text.lower().split()


def bag_of(text: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted, and their counts. Shorter texts are one shingle."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0)
    local: dict[str, int] = {}
    numbers = np.array([local.setdefault(w, len(local)) for w in words])
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in local], np.uint64)[numbers]
    size = min(size, len(words))
    n = len(words) - size + 1
    mixed = np.zeros(n, np.uint64)
    for k in range(size):
        mixed = _mix(mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n])
    keys, counts = np.unique(mixed, return_counts=True)
    return keys, counts.astype(np.float64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], places: int) -> np.ndarray:
    """One row of 16-bit values for each bag that is not empty (else zeros).

    All processes of all bags advance together, one arrival a round; a process whose
    arrival is later than its bag's whole signature has ended.
    """
    out = np.zeros(len(bags) * places, np.uint16)
    if not bags:
        return out.reshape(0, places)
    sizes = [len(keys) for keys, _ in bags]
    own = np.repeat(np.arange(len(bags)), sizes)
    keys = np.concatenate([k for k, _ in bags])
    weights = np.concatenate([w for _, w in bags])
    first = np.full(len(out), np.inf)
    time = np.zeros(len(keys))
    state = keys.copy()
    live = np.arange(len(keys))
    step = np.uint64(0x9E3779B97F4A7C15)
    while len(live):
        state[live] += step
        draw = _mix(state[live])
        unit = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        time[live] -= np.log(unit) / weights[live]
        place = own[live] * places + (_mix(draw ^ step) % np.uint64(places)).astype(np.int64)
        now = time[live]
        np.minimum.at(first, place, now)
        won = now == first[place]
        out[place[won]] = (keys[live[won]] >> np.uint64(48)).astype(np.uint16)
        latest = first.reshape(-1, places).max(axis=1)
        live = live[now < latest[own[live]]]
    return out.reshape(-1, places)


def probability_jaccard(a, b) -> float:
    """Exact similarity of two bags: the chance that one weighted draw falls alike.

    Sum over shared shingles d of 1 / sum over all e of max(a[e] / a[d], b[e] / b[d]).
    """
    (ka, wa), (kb, wb) = a, b
    _, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    if not len(ia):
        return 0.0
    x, y = wa[ia], wb[ib]
    # max(a[e]/a[d], b[e]/b[d]) takes its left side where a[e]/b[e] >= a[d]/b[d].
    ratio = x / y
    order = np.argsort(ratio, kind="stable")
    ratio, x, y = ratio[order], x[order], y[order]
    only_a, only_b = wa.sum() - x.sum(), wb.sum() - y.sum()
    a_from = only_a + np.r_[np.cumsum(x[::-1])[::-1], 0.0]
    b_below = only_b + np.r_[0.0, np.cumsum(y)]
    at = np.searchsorted(ratio, ratio, side="left")
    return float((1.0 / (a_from[at] / x + b_below[at] / y)).sum())


# --- Spark steps




def keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with the md5 of its lower-case words joined by a space; null without a word."""
    plain = F.trim(F.regexp_replace(F.lower(F.col(text)), r"\s+", " "))
    return docs.withColumn("_key", F.when(F.length(plain) > 0, F.unhex(F.md5(plain))))


def _signed(texts: DataFrame, settings: NearSettings, at_once: int = 1024) -> DataFrame:
    def run(batches):
        for batch in batches:
            for k in range(0, len(batch), at_once):
                part = batch.iloc[k : k + at_once]
                bags = [bag_of(t, settings.shingle) for t in part["text"]]
                yield pd.DataFrame(
                    {
                        "key": part["key"],
                        "signature": [s.tobytes() for s in signatures(bags, settings.places)],
                    }
                )

    return texts.mapInPandas(run, SIGNED)


def _buckets(signed: DataFrame, settings: NearSettings) -> DataFrame:
    """key and band of every band that more than one text shares."""
    width = settings.rows * 2
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(settings.bands - 1)),
        lambda b: F.xxhash64(b, F.substring("signature", b * width + 1, F.lit(width))),
    )
    rows = signed.select("key", F.posexplode(bands).alias("place", "band"))
    shared = (
        rows.groupBy("band")
        .agg(F.count("*").alias("members"), F.min("key").alias("leader"))
        .where(F.col("members") > 1)
    )
    return rows.join(shared, "band")


def _verified(pairs: DataFrame, texts: DataFrame, settings: NearSettings) -> DataFrame:
    """Exact similarity of every pair."""
    left = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))

    def run(batches):
        bags: dict[bytes, tuple] = {}

        def bag(key, text):
            key = bytes(key)
            if key not in bags:
                if len(bags) >= 64:
                    bags.clear()
                bags[key] = bag_of(text, settings.shingle)
            return bags[key]

        for batch in batches:
            found = [
                probability_jaccard(bag(a, ta), bag_of(tb, settings.shingle))
                for a, ta, b, tb in zip(batch["a"], batch["text_a"], batch["b"], batch["text_b"])
            ]
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "similarity": found})

    both = pairs.join(right, "b").join(left, "a").select("a", "text_a", "b", "text_b")
    return both.mapInPandas(run, PAIRS)


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """key and class (its smallest key) of every key that an edge (a, b) names.

    Rounds of pointing every key at the smallest key around it, until nothing changes.
    """
    links = written(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    seen = _digest(links)
    while True:
        # Large star: larger neighbours of a key move to the smallest around it.
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = (
            both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        )
        # Small star: smaller neighbours of a key, and itself, move to their smallest.
        down = large.distinct()
        least = down.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            down.join(least, "a")
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
            .where("a <> b")
            .distinct()
        )
        links = written(small, "links")
        before, seen = seen, _digest(links)
        if seen == before:
            return links.select(F.col("a").alias("key"), F.col("b").alias("class")).union(
                links.select(F.col("b").alias("key"), F.col("b").alias("class")).distinct()
            )


def _digest(links: DataFrame) -> tuple:
    """Number and digest of a set of links: the same for the same set."""
    each = F.xxhash64("a", "b")
    row = links.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.sum(each.cast("decimal(38)")))
    return tuple(row.first())


def _likely_leaders(buckets: DataFrame, signed: DataFrame, settings: NearSettings) -> DataFrame:
    """Pairs of a member and its bucket's leader whose signatures are close."""
    pairs = buckets.where("key <> leader").select(
        F.col("leader").alias("a"), F.col("key").alias("b")
    ).distinct()
    signs = [
        signed.select(F.col("key").alias(k), F.col("signature").alias(f"s_{k}")) for k in ("a", "b")
    ]

    def run(batches):
        for batch in batches:
            if len(batch):
                alike = _share(batch["s_a"], batch["s_b"])
                yield batch.loc[alike >= settings.likely, ["a", "b"]]

    return (
        pairs.join(signs[1], "b").join(signs[0], "a").mapInPandas(run, "a binary, b binary")
    )


def _matrix(signatures_: pd.Series) -> np.ndarray:
    raw = b"".join(map(bytes, signatures_))
    return np.frombuffer(raw, np.uint16).reshape(len(signatures_), -1)


def _share(x: pd.Series, y: pd.Series) -> np.ndarray:
    return (_matrix(x) == _matrix(y)).mean(axis=1)


def _between_classes(
    buckets: DataFrame,
    signed: DataFrame,
    texts: DataFrame,
    classes: DataFrame,
    settings: NearSettings,
) -> DataFrame:
    """Verified links (a, b, similarity) that join different classes.

    In every bucket that has several classes, members outside the leader's class meet all
    members, dealt in blocks. Likely pairs are verified there and then, closest first, unless
    links found before have joined their classes; so texts travel once for each block, not
    once for each pair, and only links come out.
    """
    named = (
        buckets.join(classes, "key", "left")
        .withColumn("class", F.coalesce("class", "key"))
        .withColumnRenamed("leader", "_leader")
    )
    leaders = classes.select(F.col("key").alias("_leader"), F.col("class").alias("_class"))
    named = named.join(leaders, "_leader", "left").withColumn(
        "outside", F.col("class") != F.coalesce("_class", "_leader")
    )
    open_ = (
        named.groupBy("band")
        .agg(F.sum(F.col("outside").cast("bigint")).alias("askers"))
        .where("askers > 0")
    )
    members = named.join(open_, "band").join(signed, "key").join(texts, "key")
    blocks, turns = [F.ceil(F.col(c) / settings.block).cast("int") for c in ("members", "askers")]
    spread = F.xxhash64("key")
    # A row asks, is asked, or both; one copy of it goes to each cell where it does.
    asked = F.transform(
        F.sequence(F.lit(0), turns - 1),
        lambda t: F.struct(
            F.pmod(spread, blocks).cast("int").alias("block"), t.alias("turn"), F.lit(False).alias("asks")
        ),
    )
    asking = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda b: F.struct(
            b.alias("block"), F.pmod(spread, turns).cast("int").alias("turn"), F.lit(True).alias("asks")
        ),
    )
    cells = (
        members.withColumn("c", F.explode(F.when(F.col("outside"), F.concat(asked, asking)).otherwise(asked)))
        .select(
            F.xxhash64("band", "c.block", "c.turn").alias("cell"),
            "place", "c.asks", "key", "class", "signature", "text",
        )
        .repartition("cell")
        .sortWithinPartitions("cell")
    )

    def run(batches):
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if not len(rows):
                continue
            cell = rows["cell"].to_numpy()
            # The last cell may go on in the next batch.
            ready = int(np.searchsorted(cell, cell[-1], side="left"))
            held = rows.iloc[ready:].reset_index(drop=True)
            yield _meet(rows.iloc[:ready], settings)
        if held is not None:
            yield _meet(held, settings)

    return cells.mapInPandas(run, PAIRS)


def _meet(rows: pd.DataFrame, settings: NearSettings) -> pd.DataFrame:
    """Links between the asking rows of each cell and its other rows; rows by cell."""
    out = []
    if len(rows):
        cell, asks = rows["cell"].to_numpy(), rows["asks"].to_numpy(bool)
        keys = [bytes(k) for k in rows["key"]]
        classes = [bytes(c) for c in rows["class"]]
        texts, signs = rows["text"].tolist(), _matrix(rows["signature"])
        places = rows["place"].to_numpy()
        cuts = np.r_[0, np.flatnonzero(cell[1:] != cell[:-1]) + 1, len(cell)]
        for first, last in zip(cuts, cuts[1:]):
            group = np.arange(first, last)
            theirs = group[~asks[first:last]]
            parent: dict[bytes, bytes] = {}
            bags: dict[int, tuple] = {}

            def root(c):
                while parent.get(c, c) != c:
                    c = parent[c]
                return c

            def bag(k):
                if k not in bags:
                    bags[k] = bag_of(texts[k], settings.shingle)
                return bags[k]

            for k in group[asks[first:last]]:
                same = signs[theirs] == signs[k]
                alike = same.mean(axis=1)
                near = np.flatnonzero(alike >= settings.likely)
                # A pair is taken in the first band that it shares.
                shared = same[near].reshape(len(near), settings.bands, settings.rows).all(axis=2)
                near = near[shared.argmax(axis=1) == places[k]]
                for other in theirs[near[np.argsort(-alike[near], kind="stable")]]:
                    ours, its = root(classes[k]), root(classes[other])
                    if ours == its:
                        continue
                    found = probability_jaccard(bag(k), bag(other))
                    if found >= settings.similarity:
                        parent[its] = ours
                        out.append((*sorted((keys[k], keys[other])), found))
    return pd.DataFrame(out, columns=["a", "b", "similarity"])


def links(docs: DataFrame, settings: NearSettings = NearSettings(), text: str = "text"):
    """(keyed rows, verified links between keys, classes of keys) of a table of texts."""
    spark = docs.sparkSession
    rows = keyed(docs, text)
    texts = (
        rows.where(F.col("_key").isNotNull())
        .select(F.col("_key").alias("key"), F.col(text).alias("text"))
    )
    # One text stands for its copies. Which copy makes no difference to its words.
    distinct = texts.groupBy("key").agg(F.min("text").alias("text"))
    distinct = written(distinct, "near-texts")
    signed = written(_signed(distinct, settings), "near-signatures")
    buckets = written(_buckets(signed, settings), "near-buckets")
    tested = written(
        _verified(_likely_leaders(buckets, signed, settings), distinct, settings), "near-tested"
    )
    good = tested.where(F.col("similarity") >= settings.similarity)
    classes = written(components(spark, good.select("a", "b")), "near-classes")
    found = written(_between_classes(buckets, signed, distinct, classes, settings), "near-found")
    forget(distinct, signed, buckets)
    # What is known of the classes is a star each; the new links are added to the stars.
    stars = classes.where("key <> class").select("key", "class")
    joined = components(spark, stars.toDF("a", "b").union(found.select("a", "b")))
    return rows, good.union(found), written(joined, "near-classes")


def near_duplicates(
    docs: DataFrame,
    settings: NearSettings = NearSettings(),
    *,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the class), n_verified, n_class of every row.

    Texts with equal lower-case words are copies. `n_verified` counts the pairs with a
    text that were compared in full and found alike, enough to join its class and seldom all; `n_class` the rows of the class. Texts of fewer
    than five words are one shingle. A null, empty or blank text is like nothing: it is in
    a class of its own with its own id. A class of null ids only has a null class_id. One
    row per input row, repeated rows included; other columns are left out.
    """
    rows, good, classes = links(pick(docs, doc_id=doc_id, text=text), settings)
    count = (
        good.select(F.explode(F.array("a", "b")).alias("_key"))
        .groupBy("_key")
        .agg(F.count("*").alias("n_verified"))
    )
    named = classes.select(F.col("key").alias("_key"), F.col("class").alias("_class"))
    each = (
        rows.select("doc_id", "_key")
        .join(named, "_key", "left")
        .join(count, "_key", "left")
        .withColumn("_class", F.coalesce("_class", "_key"))
    )
    least = (
        each.where(F.col("_class").isNotNull())
        .groupBy("_class")
        .agg(F.min("doc_id").alias("_least"), F.count("*").alias("_n"))
    )
    return each.join(least, "_class", "left").select(
        "doc_id",
        F.when(F.col("_class").isNull(), F.col("doc_id")).otherwise(F.col("_least")).alias("class_id"),
        F.coalesce("n_verified", F.lit(0)).alias("n_verified"),
        F.coalesce("_n", F.lit(1)).alias("n_class"),
    )


def keep_one(
    docs: DataFrame,
    settings: NearSettings = NearSettings(),
    *,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """One row of each class, the one with the smallest doc_id (null last, then by text);
    rows without a word all stay. Rows of one id and text are one. An empty table gives no
    rows. Columns may have any other names."""
    rows, _, classes = links(
        docs.select(row_of(docs).alias("row"), docs[doc_id].alias("doc_id"), docs[text].alias("text")), settings
    )
    named = classes.select(F.col("key").alias("_key"), F.col("class").alias("_class"))
    marked = rows.withColumn("_text", F.unhex(F.md5("text"))).withColumn(
        "_id", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    )
    # The best row of a class is found on short columns with partial aggregation, and then
    # looked up by id and text, so a class with a third of all rows costs no single task.
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_id", "_text")
    best = (
        marked.where(F.col("_key").isNotNull())
        .select("_key", order.alias("_order"))
        .join(named, "_key", "left")
        .groupBy(F.coalesce("_class", "_key").alias("_class"))
        .agg(F.min("_order").alias("_best"))
        .select("_best._id", "_best._text")
    )
    kept = marked.where(F.col("_key").isNotNull()).join(best, ["_id", "_text"], "left_semi")
    blank = marked.where(F.col("_key").isNull())
    # Rows that repeat each other whole are one.
    return kept.dropDuplicates(["_id", "_text"]).unionByName(blank).select(*columns_of(docs))
