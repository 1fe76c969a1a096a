"""Divergence of sources against a plain count, also where cells are small."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from assayline.llm import divergence as dv


def plain(rows, support, added=5, top=50):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        terms, word = [], ""
        for c in lowered + " ":
            if "a" <= c <= "z" or "A" <= c <= "Z" or ord(c) > 127:
                word += c
            elif word:
                terms, word = terms + [word], ""
        groups[lang].add(source)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= support]
        whole = Counter({t: sum(counts[lang, s][t] for s in sources) for t in kept})

        def share(own):
            total = sum(own[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (own[t] + added) // (total + added * len(kept)) for t in kept}

        q = share(whole)
        shares = {s: share(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(sum(abs(shares[s][t] - shares[o][t]) for t in kept), o) for o in sources - {s}]
            more = [(shares[s][t] - q[t], t) for t in kept if counts[lang, s][t] and shares[s][t] > q[t]]
            for part, items, last in (("pair", pairs, None), ("term", more, top)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:last]
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(ranked)]
    return sorted(out)


def got(docs, **settings):
    rows = dv.divergence(docs, dv.DivergenceSettings(**settings))
    assert rows.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, rows.collect()))


SCHEMA = "text string, lang string, source string"


@pytest.mark.parametrize("places", [1, 40, 1 << 17])
def test_random_rows(spark, places):
    draw = random.Random(places)
    words = ["a", "B", "ü", "Ü", "漢", "x1y", "the", "İ", "of", "😀"] + [f"w{chr(97 + k)}" for k in range(20)]
    rows = [
        (
            " ".join(draw.choices(words, k=draw.randint(0, 30))),
            draw.choice(["en", "de", None, ""]),
            draw.choice(["hot"] * 5 + ["s1", "s2", None, "ß"]),
        )
        for _ in range(200)
    ]
    rows += [(None, "en", "empty"), ("", "only", "one"), (None, "only", None), rows[0], rows[0]]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "text as term", "lang as item", "source as p").repartition(5)
    assert got(docs, support=8, places=places, entries=50, top=4) == plain(rows, 8, top=4)
    assert got(docs.limit(0)) == []


def test_no_kept_terms_and_large_counts(spark):
    rows = [("word " * 40_000, "en", s) for s in "abc"]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert got(docs) == plain(rows, 30)
    assert {r[4] for r in got(docs)} == {0}
    assert got(docs, support=2) == plain(rows, 2)


def test_runs_give_the_distance_of_columns():
    draw = np.random.default_rng(1)
    for _ in range(50):
        columns = draw.integers(0, 3, (4, int(draw.integers(1, 60))))
        order = dv.ordered(columns)
        assert sorted(order) == list(range(columns.shape[1]))
        runs = [dv.runs_of(c[order]) for c in columns]
        for i in range(4):
            for j in range(4):
                expected = np.abs(columns[i] - columns[j]).sum()
                assert dv.distance(runs[i], runs[j], columns.shape[1]) == expected
        assert min(len(r[0]) for r in runs) <= 3


def test_nothing_is_kept_in_memory_for_a_hot_source(spark, sf_dir):
    """The plan holds no cross join and no broadcast of unmeasured size."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = dv.divergence(docs)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
