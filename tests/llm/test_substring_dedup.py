"""Window removal against sets of windows; the index against plain counting."""

import hashlib
import random
import re

import numpy as np
import pytest

from assayline.llm import substring_dedup as sd


def plain(rows, length):
    words = [re.findall("[^\x20\x09-\x0d]+", text or "") for _, text in rows]
    least = {}
    for (doc, _), w in zip(rows, words):
        for p in range(len(w) - length + 1):
            window = tuple(w[p : p + length])
            if doc is not None:
                least[window] = min(doc, least.get(window, doc))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = set()
        for p in range(len(w) - length + 1):
            if doc is not None and least[tuple(w[p : p + length])] < doc:
                gone.update(range(p, p + length))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=repr)


def got(docs, **settings):
    rows = sd.digests(sd.remove_windows(docs, sd.WindowSettings(**settings)))
    assert rows.columns[:4] == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    return sorted(map(tuple, rows.collect()), key=repr)


def test_edge_rows(edge_docs, no_docs):
    rows = [tuple(r) for r in edge_docs.select("doc_id", "text").collect()]
    assert got(edge_docs) == plain(rows, 13)
    assert got(no_docs) == []


def corpus(draw, n):
    """Texts that share passages, borders, whole copies and ids, some of them without an id."""
    passages = [[f"p{k}.{j}" for j in range(draw.randint(3, 40))] for k in range(6)]
    common = [f"c{j}" for j in range(20)]
    rows = []
    for _ in range(n):
        words = []
        for _ in range(draw.randint(0, 4)):
            words += draw.choice(passages + [common] * 6)[draw.randint(0, 3) :]
            words += [f"w{draw.randint(0, 400)}" for _ in range(draw.randint(0, 12))]
        rows.append((draw.choice([None, *range(n)]) if draw.random() < 0.1 else draw.randint(0, n), draw.choice(" \t\n").join(words)))
    return rows + rows[:5] + [(1000 + k, rows[3][1]) for k in range(10)]


@pytest.mark.parametrize("hot,shard", [(2_000, 200_000), (3, 200), (0, 50)])
def test_random_texts(spark, hot, shard):
    rows = corpus(random.Random(hot + shard), 150)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "text as key", "doc_id as first", "text as part", "doc_id as low"
    ).repartition(4)
    assert got(docs, hot=hot, shard=shard, segment=17) == plain(rows, 13)
    assert got(docs, length=5, gram=2, hot=hot, shard=shard) == plain(rows, 5)


def test_words_are_split_at_six_characters_only(spark):
    text = "a\x1cb c\xa0d e f g\x0bh i\x0cj k\rl m\x85n"
    assert [w.decode() for w in sd.words_of(text)] == re.findall("[^\x20\x09-\x0d]+", text)


def test_equal_windows_have_equal_anchors():
    draw = random.Random(2)
    settings = sd.WindowSettings(length=7, gram=3, segment=40)
    texts = [[draw.choice([b"a", b"b", b"c"]) for _ in range(n)] for n in (400, 6, 0, 7, 90, 1, 8, 300, 5)]
    seen = {}
    owner, grams, lows, highs = sd.anchors(texts, settings)
    for k, words in enumerate(texts):
        own = owner == k
        starts = [p for low, high in zip(lows[own], highs[own]) for p in range(low, high + 1)]
        assert starts == list(range(len(words) - 6))
        for gram, low, high in zip(grams[own], lows[own], highs[own]):
            for p in range(low, high + 1):
                assert seen.setdefault(tuple(words[p : p + 7]), gram) == gram
    assert [len(c) for c in sd.anchors([words[:6] for words in texts], settings)] == [0] * 4
    assert [len(c) for c in sd.anchors([], settings)] == [0] * 4


@pytest.mark.parametrize("size", [1, 2, 3, 17, 64, 300])
def test_wavelet_tree_ranks(size):
    draw = np.random.default_rng(size)
    for n in (0, 1, 63, 64, 65, 500):
        symbols = draw.integers(0, size, n)
        tree = sd.WaveletTree(symbols, size)
        if n:
            ask, at = draw.choice(symbols, 200), draw.integers(0, n + 1, 200)
            assert tree.rank(ask, at).tolist() == [int((symbols[:p] == c).sum()) for c, p in zip(ask, at)]


def test_matching_statistics():
    draw = np.random.default_rng(4)
    for _ in range(30):
        text = draw.integers(0, 4, int(draw.integers(20, 120)))
        text[0] = text[-1] = 0
        index = sd.FmIndex(text, 4, 6)
        ends = np.flatnonzero(text > 0)
        matched, low, high = index.statistics(text, ends, np.full(len(ends), 2), 6)
        flat = "".join(map(str, text))
        for e, m, a, b in zip(ends, matched, low, high):
            def places(n):
                return [k for k in range(len(flat)) if flat.startswith(flat[e - n + 1 : e + 1], k)]
            own = [n for n in range(1, 7) if n <= e and "0" not in flat[e - n + 1 : e + 1] and len(places(n)) > 1]
            assert m == max(own, default=0)
            if m:
                assert sorted(index.suffixes[a:b].tolist()) == places(m)
                # Whole patterns lie by place, which ascending documents rely on.
                assert m < 6 or index.suffixes[a:b].tolist() == places(m)
