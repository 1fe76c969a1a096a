"""How far the sources of each language use words differently, over run-length columns.

Every (lang, source) group, and every language as a whole, gives each kept term of the
language a smoothed probability in whole billionths, p = 1 + floor(10^9 (n + a) / (N + a V)).
The distance of two groups is the sum of |p - q| over all kept terms.

Tasks count the terms of their texts; the counts are added up by (lang, source, term), so
a source that holds a third of all rows is spread over its terms. The vocabulary of a
language is dealt into cells of a bounded number of (source, term) places. In a cell the
terms are put in the order of their counts, the least varied source deciding first, so that
equal counts stand together; each source's column becomes runs of one p, terms without a count
included. For a pair of sources the run boundaries are intersected, and |p - q| of a piece
counts as many times as the piece is long. Cells are added up, first in the task and then
over tasks. Whole numbers throughout.

Nulls in text, lang and source are empty strings. Repeated rows count again. Groups whose
texts have no terms, and languages without kept terms, take part; with V = 0 their distance
is 0. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from assayline.llm.tables import forget, pick, written
from assayline.operators.lookup import LookupBounds, fits

# Bytes of a term stay, A-Z in lower case; all others part terms. Characters
# beyond ASCII are made of bytes from 0x80 in UTF-8.
_UPPER, _LOWER = range(0x41, 0x5B), range(0x61, 0x7B)
_PARTED = bytes(
    b + 0x20 if b in _UPPER else b if b in _LOWER or b >= 0x80 else 0x20 for b in range(256)
)
_BILLION = 1_000_000_000

_COUNTED = "lang string, source string, term string, n bigint, docs bigint"
_PARTIAL = "lang string, a string, b string, value bigint"


@dataclass(frozen=True)
class DivergenceSettings:
    # Documents of the language that a kept term is in, and what is added to every count.
    support: int = 30
    added: int = 5
    # Ranks of the terms a group uses more than its language does.
    top: int = 50
    # Places (sources times terms) of one cell; entries a task counts before it hands on, and
    # texts it takes at once.
    places: int = 1 << 17
    entries: int = 250_000
    at_once: int = 64


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_PARTED).split()


def _counted(rows: DataFrame, settings: DivergenceSettings) -> DataFrame:
    """lang, source, term, occurrences and documents, added up within tasks."""

    def part(group, counts: Counter, docs: Counter):
        terms, same = list(counts), len(counts)
        columns = [
            *[pa.repeat(pa.scalar(name, pa.string()), same) for name in group],
            pa.array(terms, pa.binary()).cast(pa.string()),
            pa.array(list(counts.values()), pa.int64()),
            pa.array([docs[t] for t in terms], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])

    def run(batches):
        counts, docs = defaultdict(Counter), defaultdict(Counter)
        for batch in batches:
            for k in range(0, batch.num_rows, settings.at_once):
                for lang, source, text in zip(*[c.to_pylist() for c in batch.slice(k, settings.at_once).columns]):
                    terms = terms_of(text)
                    counts[lang, source].update(terms)
                    docs[lang, source].update(set(terms))
                if sum(map(len, counts.values())) >= settings.entries:
                    for group in list(counts):
                        yield part(group, counts.pop(group), docs.pop(group))
        for group in list(counts):
            yield part(group, counts.pop(group), docs.pop(group))

    parts = rows.select("lang", "source", "text").mapInArrow(run, _COUNTED)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column, total: Column, size: Column, added: int) -> Column:
    """1 + floor(10^9 (n + a) / (N + a V)), exact: the product has up to 29 digits."""
    above = F.lit(_BILLION).cast("decimal(10,0)") * (n + added).cast("decimal(20,0)")
    below = (total + added * size).cast("decimal(20,0)")
    return (1 + F.call_function("div", above, below)).cast("bigint")


def _beside(rows: DataFrame, side: DataFrame, on: list[str]) -> DataFrame:
    """Inner join with a side that is broadcast only where measured to be small."""
    return rows.join(F.broadcast(side) if fits(side, LookupBounds()) else side.hint("merge"), on)


def _tables(docs: DataFrame, settings: DivergenceSettings, **columns: str):
    """(counts of kept terms with both shares, one row a group with its share of no count)."""
    empty = F.lit("")
    rows = pick(docs, **columns).select(*[F.coalesce(c, empty).alias(c) for c in ("lang", "source", "text")])
    counts = written(_counted(rows, settings), "terms-counted")
    kept = written(
        counts.groupBy("lang", "term")
        .agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= settings.support)
        .drop("docs"),
        "terms-kept",
    )
    own = written(counts.drop("docs").join(kept, ["lang", "term"]), "terms-own")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("size"), F.sum("n_lang").alias("total_lang"))
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("bigint")
    groups = (
        rows.select("lang", "source").distinct()
        .join(totals, ["lang", "source"], "left")
        .join(sizes, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "size", "total_lang")])
    )
    sources = F.count("*").over(Window.partitionBy("lang"))
    least = _share(zero, F.col("total"), F.col("size"), settings.added)
    groups = written(
        groups.withColumn("least", F.when(F.col("size") > 0, least).otherwise(zero)).withColumn(
            "cells", F.ceil(F.col("size") * sources / settings.places)
        ),
        "terms-groups",
    )
    known = _beside(own, groups, ["lang", "source"])
    shares = known.select(
        "lang", "source", "term", "cells",
        _share(F.col("n"), F.col("total"), F.col("size"), settings.added).alias("p"),
        _share(F.col("n_lang"), F.col("total_lang"), F.col("size"), settings.added).alias("q"),
    )
    shares = written(shares, "terms-shares")
    forget(counts, kept, own)
    return shares, groups


# --- run-length columns


def ordered(columns: np.ndarray) -> np.ndarray:
    """Terms in the order of their shares, the source with the fewest different ones deciding
    first: its column falls into few runs and leaves long stretches to the next."""
    varied = [len(np.unique(c)) for c in columns]
    return np.lexsort(columns[np.argsort(varied)[::-1]])


def runs_of(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of one share begins, and the share."""
    begins = np.flatnonzero(np.r_[True, column[1:] != column[:-1]]) if len(column) else np.zeros(0, int)
    return begins, column[begins]


def distance(a, b, length: int) -> int:
    """Sum of |p - q| over columns of `length` places given as runs."""
    (a_begins, a_shares), (b_begins, b_shares) = a, b
    begins = np.union1d(a_begins, b_begins)
    p = a_shares[np.searchsorted(a_begins, begins, "right") - 1]
    q = b_shares[np.searchsorted(b_begins, begins, "right") - 1]
    return int((np.abs(p - q) * np.diff(np.r_[begins, length])).sum())


def _cell(least: np.ndarray, sources: np.ndarray, terms: np.ndarray, shares: np.ndarray):
    """Runs of all sources over the terms of one cell."""
    kinds, place = np.unique(terms, return_inverse=True)
    columns = np.repeat(least[:, None], len(kinds), axis=1)
    columns[sources, place] = shares
    columns = columns[:, ordered(columns)] if len(kinds) else columns
    return [runs_of(c) for c in columns], len(kinds)


def _distances(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b (a before b) and their distance."""
    cell = F.pmod(F.xxhash64("term"), F.col("cells"))
    own = shares.select("lang", cell.alias("cell"), "source", "term", "p")
    # Every cell needs the share of no count for each source of its language.
    last = F.greatest(F.col("cells") - 1, F.lit(0))
    none = groups.select(
        "lang", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("cell"), "source",
        F.lit(None).cast("string").alias("term"), F.col("least").alias("p"),
    )
    dealt = (
        none.union(own).repartition("lang", "cell")
        .sortWithinPartitions("lang", "cell", F.col("term").isNotNull(), "source")
    )

    def close(held, sums):
        rows = pd.concat(held, ignore_index=True)
        first = rows["term"].isna().to_numpy()
        names = rows.loc[first, "source"].tolist()
        number = {name: k for k, name in enumerate(names)}
        at = rows.loc[~first, "source"].map(number).to_numpy(dtype=np.int64)
        runs, length = _cell(
            rows.loc[first, "p"].to_numpy(np.int64), at,
            rows.loc[~first, "term"].to_numpy(), rows.loc[~first, "p"].to_numpy(np.int64),
        )
        for i, a in enumerate(names):
            for j in range(i + 1, len(names)):
                sums[a, names[j]] += distance(runs[i], runs[j], length)

    def emit(lang, sums):
        rows = [(lang, a, b, value) for (a, b), value in sums.items()]
        return pd.DataFrame(rows, columns=["lang", "a", "b", "value"])

    def run(batches):
        now, lang, held, sums = None, None, [], Counter()
        for batch in batches:
            key = list(zip(batch["lang"], batch["cell"]))
            cuts = [0] + [k for k in range(1, len(key)) if key[k] != key[k - 1]] + [len(key)]
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end:
                    continue
                if key[begin] != now:
                    if held:
                        close(held, sums)
                    if lang is not None and key[begin][0] != lang:
                        yield emit(lang, sums)
                        sums = Counter()
                    now, lang, held = key[begin], key[begin][0], []
                held.append(batch.iloc[begin:end])
        if held:
            close(held, sums)
            yield emit(lang, sums)

    return (
        dealt.mapInPandas(run, _PARTIAL).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    )


def divergence(
    docs: DataFrame,
    settings: DivergenceSettings = DivergenceSettings(),
    *,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """lang, source, part, item, value and rank.

    Part `pair`: every other source of the language with the distance, the furthest first.
    Part `term`: the terms that the group uses and uses more than its language, by how much,
    up to `top` of them. Ties go by item.
    """
    shares, groups = _tables(docs, settings, text=text, lang=lang, source=source)
    apart = written(_distances(shares, groups), "source-distances")
    forget(groups)
    pairs = apart.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").union(
        apart.select("lang", "b", "a", "value")
    )
    more = shares.where("p > q").select(
        "lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")

    def ranked(rows, part):
        return rows.select(
            "lang", "source", F.lit(part).alias("part"), "item", "value",
            F.row_number().over(order).alias("rank"),
        )

    return ranked(pairs, "pair").union(ranked(more, "term").where(F.col("rank") <= settings.top))
