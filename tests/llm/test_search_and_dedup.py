"""Searches and deduplication against brute force on small tables."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayline.llm import cover_tree, decontaminate, near_dedup, quality, suffix_dedup
from tests.llm.conftest import EDGE


# --- exact top-k


def best(rows, k, every):
    usable = [
        (i, [int(np.floor(256 * float(x))) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for i, v in usable:
        if i % every == 0:
            found = sorted(
                (-sum(a * b for a, b in zip(v, w)), j)
                for j, w in usable
                if j != i and len(w) == len(v)
            )
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(found[:k])]
    return sorted(out)


def test_dual_tree_equals_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(150):
        n, m, d = rng.integers(0, 200), rng.integers(0, 60), rng.integers(1, 6)
        points = np.floor(rng.normal(size=(n, d)) * rng.choice([1, 3, 100]))
        if n > 3:
            points[rng.integers(0, n, n // 3)] = points[0]
        asks = np.floor(rng.normal(size=(m, d)) * 3)
        ids, names = rng.permutation(1000)[:n], rng.permutation(1000)[:m]
        got = cover_tree.DualSearch(asks, names, points, ids, 5, 4).run().frame()
        want = []
        for a in range(m):
            found = sorted((-int(asks[a] @ points[b]), ids[b]) for b in range(n) if ids[b] != names[a])
            want += [(names[a], i, -s) for s, i in found[:5]]
        assert sorted(map(tuple, got.values.tolist())) == sorted(tuple(map(int, w)) for w in want)


def test_large_components_are_multiplied_exactly(spark):
    """Products beyond 2 ** 53, where doubles would round them."""
    rng = np.random.default_rng(8)
    rows = [(k, (rng.integers(-(10**6), 10**6, 6) + 0.25).tolist()) for k in range(200)]
    rows += [(200 + k, rows[k][1]) for k in range(5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = cover_tree.top_k(frame, cover_tree.SearchSettings(every=7, leaf=4, queries=9, candidates=50))
    assert sorted(map(tuple, got.collect())) == best(rows, 5, 7)


def test_top_k_over_blocks(spark):
    rng = np.random.default_rng(4)
    rows = [(k, [float(x) for x in rng.normal(size=4)]) for k in range(300)]
    rows += [(300, None), (350, [None, 1.0, 1.0, 1.0]), (400, [float("nan")] * 4), (None, [1.0] * 4)]
    rows += [(500, [1.0, 2.0]), (501, [1.0, 1.0]), (450, [float("inf")] * 4), (600, [5.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "vec_id as block", "1 as v")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    settings = cover_tree.SearchSettings(queries=2, candidates=40, leaf=4)
    got = cover_tree.top_k(frame, settings)
    assert sorted(map(tuple, got.collect())) == best(rows, 5, 50)
    assert cover_tree.top_k(frame.where("false")).count() == 0


# --- near-duplicates


def edited(r, words, changes):
    words = list(words)
    for _ in range(changes):
        words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
    return words


@pytest.fixture(scope="module")
def families():
    r = random.Random(2)
    rows, number = [], 0
    for family in range(30):
        base = [f"w{r.randrange(10**5)}" for _ in range(r.choice([8, 60, 200]))]
        for _ in range(r.choice([1, 2, 6, 25])):
            rows.append((number, " ".join(edited(r, base, r.choice([0, 0, 1, 2, 5])))))
            number += 1
    rows += [(number, rows[0][1].upper()), (number + 1, None), (None, "  ")]
    return rows


def classes_of(rows, settings):
    bags = [near_dedup.bag_of(t or "", settings.shingle) for _, t in rows]
    parent = list(range(len(rows)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if near_dedup.probability_jaccard(bags[a], bags[b]) >= settings.similarity:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return [root(a) for a in range(len(rows))]


@pytest.mark.parametrize("block", [1000, 3])
def test_classes_equal_brute_force(spark, families, block):
    settings = near_dedup.NearSettings(block=block)
    frame = spark.createDataFrame(families, "doc_id long, text string").repartition(3)
    got = near_dedup.near_duplicates(frame, settings).collect()
    want = classes_of(families, settings)
    assert sorted(
        (str(r.doc_id), str(r.class_id)) for r in got
    ) == sorted((str(i), str(families[c][0])) for (i, _), c in zip(families, want))
    kept = near_dedup.keep_one(frame, settings)
    assert kept.columns == ["doc_id", "text"]
    assert kept.count() == len(set(want))


def test_similarity_is_exact_and_estimated():
    r = random.Random(1)
    bags, exact = [], []
    for _ in range(150):
        words = [str(r.randrange(8)) for _ in range(r.randint(0, 40))]
        other = edited(r, words, r.randint(0, 4)) if words else words
        a, b = near_dedup.bag_of(" ".join(words), 2), near_dedup.bag_of(" ".join(other), 2)
        x, y = dict(zip(*map(list, a))), dict(zip(*map(list, b)))
        want = sum(
            1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in x | y) for d in x if d in y
        )
        exact.append(near_dedup.probability_jaccard(a, b))
        assert abs(exact[-1] - want) < 1e-9
        bags += [a, b]
    signs = near_dedup.signatures(bags, 512)
    full = [k for k in range(150) if len(bags[2 * k][0])]
    error = [(signs[2 * k] == signs[2 * k + 1]).mean() - exact[k] for k in full]
    assert abs(np.mean(error)) < 0.01 and np.std(error) < 0.03


def test_near_edges(edge_docs, no_docs):
    got = sorted((str(r.doc_id), str(r.class_id), r.n_class) for r in near_dedup.near_duplicates(edge_docs).collect())
    assert got.count(("4", "4", 3)) == 2 and ("5", "4", 3) in got and ("1", "1", 1) in got
    assert len(got) == len(EDGE)
    kept = near_dedup.keep_one(edge_docs)
    assert kept.count() == len(EDGE) - 2 and kept.columns == edge_docs.columns
    assert near_dedup.near_duplicates(no_docs).count() == 0 and near_dedup.keep_one(no_docs).count() == 0


# --- benchmark passages


def leaks(docs, items, most=5):
    def bag(words, size):
        return collections.Counter(tuple(words[k : k + size]) for k in range(len(words) - size + 1))

    out = set()
    for i, text in docs:
        words = (text or "").lower().split()
        for item, passage in items:
            wanted = (passage or "").lower().split()
            size = min(most, len(wanted))
            if not size:
                continue
            last = max(len(words) - len(wanted), 0)
            for start in range(last + 1):
                ours, theirs = bag(words[start : start + len(wanted)], size), bag(wanted, size)
                shared = sum((ours & theirs).values())
                every = sum(ours.values()) + sum(theirs.values()) - shared
                if every and shared / every >= 0.8:
                    out.add((i, item, start))
    return out


@pytest.mark.parametrize("bound", [1_000_000, 0])
def test_leaks_equal_brute_force(spark, edge_docs, no_docs, bound):
    r = random.Random(3)
    items = [(k, " ".join(f"i{r.randrange(500)}" for _ in range(r.randint(12, 60)))) for k in range(12)]
    items += [(50, items[0][1]), (51, None), (52, "too short"), (53, ""), (54, "One"), (55, "a b c d")]
    items += [(56, "a a a a a a a a a a b"), (57, "five words are one shingle")]
    docs = [(200, "too short"), (201, "this is too  short one a b c"), (202, "a b c d"), (203, "one"), (204, "a b c")]
    docs += [(205, "x a a a a a a a a a a b y"), (206, "five words are one shingle"), (207, "words are one shingle")]
    for k in range(80):
        words = [f"i{r.randrange(500)}" for _ in range(r.randint(0, 80))]
        passage = edited(r, r.choice(items[:12])[1].split(), r.choice([0, 0, 1]))
        at = r.randint(0, len(words))
        docs.append((k, " ".join(words[:at] + passage + words[at:]).title()))
    docs += [(k, " ".join(f"z{r.randrange(500)}" for _ in range(50))) for k in range(100, 110)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "text as words")
    settings = decontaminate.LeakSettings(broadcast_shingles=bound, exact=True)
    got = decontaminate.find_leaks(frame, benchmark, settings).collect()
    want = leaks(docs, items)
    # Windows are laid beside shared shingles, so of shifted windows the aligned one is told.
    assert {(r.doc_id, r.item_id, r.start_word) for r in got} <= want
    assert {(r.doc_id, r.item_id) for r in got} == {w[:2] for w in want}
    clean = decontaminate.remove_leaks(frame, benchmark, settings)
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in docs} - {w[0] for w in want}
    dirty = {w[0] for w in leaks(EDGE, items)}
    left = [r.doc_id for r in decontaminate.remove_leaks(edge_docs, benchmark, settings).collect()]
    assert sorted(left, key=str) == sorted([i for i, _ in EDGE if i not in dirty], key=str)
    assert decontaminate.find_leaks(no_docs, benchmark, settings).count() == 0
    assert decontaminate.find_leaks(frame, benchmark.where("false"), settings).count() == 0


def test_leaks_cut_or_replaced_at_the_end(spark):
    """Similarities from 0.8 to 0.82, some with fingerprints beyond the radius."""
    r = random.Random(5)
    items, docs = [], []
    for k in range(900):
        n = r.choice([20, 31, 40, 59])
        words = [f"{k}w{j}" for j in range(n)]
        items.append((k, " ".join(words)))
        if k % 2:  # the last words replaced: shared / (2 * (n - 4) - shared) >= 0.8
            left = n - (n - 4) // 9
            docs.append((k, " ".join(words[:left] + [f"{k}x{j}" for j in range(n - left)])))
        else:  # the text ends early: shared / (n - 4) >= 0.8
            docs.append((k, " ".join(words[: n - (n - 4) // 5])))
    want = {(k, k) for (k, t), (_, i) in zip(docs, items) if leaks([(k, t)], [(k, i)])}
    assert len(want) == len(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_leaks(frame, benchmark).select("doc_id", "item_id", "similarity").collect()
    assert {(x.doc_id, x.item_id) for x in got} == want
    of_text = decontaminate.fingerprint(decontaminate.words_of(F.col("text")))
    ours, theirs = ({r[0]: r[1] for r in f.select(f.columns[0], of_text).collect()} for f in (frame, benchmark))
    assert any(sum(a != b for a, b in zip(ours[k], theirs[k])) > 16 for k in ours)


def borderline(r, count):
    """Items, and texts that hold them with as much cut or replaced as 0.8 allows."""
    items, docs = [], []
    for k in range(count):
        n = r.randint(9, 220)
        words = [f"v{r.randrange(5000)}" for _ in range(n)]
        items.append((k, " ".join(words)))
        shingles, more = n - 4, [f"z{r.randrange(5000)}" for _ in range(30)]
        replaced, cut = int(shingles * 0.2 / 1.8 + 1e-9), int(shingles * 0.2 + 1e-9)
        if replaced:
            docs.append((3 * k, " ".join(more + words[: n - replaced] + more)))
            docs.append((3 * k + 1, " ".join(more + words[replaced:] + more)))
        if cut:
            docs.append((3 * k + 2, " ".join(words[: n - cut])))
    return items, docs


def test_fingerprints_find_borderline_passages(spark):
    items, docs = borderline(random.Random(6), 500)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = {
        exact: {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(
            frame, benchmark, decontaminate.LeakSettings(exact=exact)
        ).collect()}
        for exact in (True, False)
    }
    few = [d for d in docs if d[0] < 3 * 12]
    want = {w[:2] for w in leaks(few, items[:12])}
    assert {w for w in found[True] if w[0] < 3 * 12 and w[1] < 12} == want
    assert {i for i, _ in docs} <= {i for i, _ in found[True]}
    recall = len(found[False] & found[True]) / len(found[True])
    assert found[False] <= found[True] and recall >= 0.995, recall


def test_fingerprints_decide(spark, monkeypatch):
    """Without the exact parameter nothing is found beside the fingerprints within the radius."""
    items, docs = borderline(random.Random(7), 20)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    within = decontaminate._within_radius
    monkeypatch.setattr(decontaminate, "_within_radius", lambda *a: within(*a).where("false"))
    assert decontaminate.find_leaks(frame, benchmark).count() == 0
    assert decontaminate.find_leaks(frame, benchmark, decontaminate.LeakSettings(exact=True)).count() > 0


def test_radius_follows_the_length():
    assert [decontaminate.radius_of(n) for n in (1, 4, 5, 8)] == [0, 0, 0, 0]
    radii = [decontaminate.radius_of(n) for n in range(9, 400)]
    assert min(radii) >= 17 and max(radii) <= 26


CLASHES = ["_key", "_id", "_text", "_shape", "key", "row", "words", "shape", "class", "window"]


def test_stages_keep_columns_of_any_name(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(4, 1), (7, 0)], "doc_id long, quality int")
    benchmark = spark.createDataFrame([(1, "nothing like it")], "item_id long, text string")
    for start in (edge_docs, no_docs):
        docs = start.select("doc_id", "text", *[F.concat(F.lit(c), "text").alias(c) for c in CLASHES])
        for after in (
            near_dedup.keep_one(docs), decontaminate.remove_leaks(docs, benchmark), quality.keep_good(docs, labels),
            quality.keep_good(docs, labels.where("false")),
        ):
            assert after.columns == docs.columns
            rows = after.collect()
            assert bool(rows) == (start is edge_docs)
            for x in rows:
                assert [x[c] for c in CLASHES] == [None if x.text is None else c + x.text for c in CLASHES]
        renamed = docs.withColumnRenamed("text", "body").withColumnRenamed("doc_id", "id")
        assert near_dedup.keep_one(renamed, text="body", doc_id="id").columns == renamed.columns
        assert decontaminate.remove_leaks(renamed, benchmark, text="body", doc_id="id").columns == renamed.columns
        assert quality.keep_good(renamed, labels, text="body", doc_id="id").columns == renamed.columns


# --- repeated byte strings


def test_suffix_array_by_linear_grouping():
    r = random.Random(3)
    for _ in range(1500):
        top = r.choice([1, 2, 5])
        text = [r.randint(0, top) for _ in range(r.randint(0, 40))]
        assert suffix_dedup.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def removed(rows, length):
    raws = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(raw[k : k + length] for raw in raws for k in range(len(raw) - length + 1))
    out = []
    for (i, _), raw in zip(rows, raws):
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - length + 1):
            if seen[raw[k : k + length]] > 1:
                gone[k : k + length] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        whole = kept.decode("utf-8", "replace")
        out.append((i, len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), whole))
    return sorted(out, key=str)


@pytest.mark.parametrize(
    "settings",
    [
        suffix_dedup.RepeatSettings(length=20, gram=4, block=4),
        suffix_dedup.RepeatSettings(length=24, gram=6, block=8, cell=3, symbols=100, segment=30),
    ],
)
def test_repeats_equal_brute_force(spark, settings):
    r = random.Random(4)
    bits = ["".join(r.choice("ab ") for _ in range(60)) for _ in range(6)]
    rows = []
    for k in range(150):
        parts = [
            r.choice(bits)[r.randint(0, 20) : r.randint(30, 60)]
            if r.random() < 0.7
            else r.choice(["a" * r.randint(1, 40), "é" * 5, str(r.random())])
            for _ in range(r.randint(0, 8))
        ]
        rows.append((k, "".join(parts)))
    rows += [(None, None), (1, ""), (2, rows[5][1]), (None, rows[6][1]), (5, rows[5][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffix_dedup.deduplicate(frame, settings).collect()
    assert sorted(map(tuple, got), key=str) == removed(rows, settings.length)


def test_repeat_edges(edge_docs, no_docs):
    got = suffix_dedup.deduplicate(edge_docs).collect()
    assert sorted(map(tuple, got), key=str) == removed(EDGE, 400)
    assert suffix_dedup.deduplicate(no_docs).count() == 0


def test_planted_passages_go_and_clean_texts_stay(spark):
    r = random.Random(9)

    def prose(n):
        return " ".join("".join(r.choices("abcdefghij", k=r.randint(2, 9))) for _ in range(n))

    passages = [prose(90) for _ in range(4)]
    rows = []
    for k in range(60):
        middle = passages[k % 4] if k < 20 else prose(90)
        rows.append((k, f"{prose(40)} {middle} {prose(40)}"))
    rows += [(60 + k, rows[30][1]) for k in range(2)]
    clash = "*", "text as key", "doc_id as row", "text as lows", "doc_id as whole", "text as _left"
    docs = spark.createDataFrame([*rows, (99, None)], "doc_id long, text string").selectExpr(*clash)
    left = suffix_dedup.remove_repeats(docs.repartition(3))
    assert left.columns == docs.columns and left.dtypes == docs.dtypes
    texts = dict(rows) | {99: None}
    for row in left.collect():
        assert (row.key, row.row, row.lows, row.whole, row._left) == (
            texts[row.doc_id], row.doc_id, texts[row.doc_id], row.doc_id, texts[row.doc_id]
        )
        if row.doc_id < 20:
            assert not any(p[5:-5] in row.text for p in passages)
            assert len(row.text) > 300
        elif row.doc_id in (30, 60, 61):
            assert row.text == ""
        else:
            assert row.text == texts[row.doc_id]


def test_repeats_equal_brute_force_on_the_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, suffix_dedup.deduplicate(docs).collect()), key=str) == removed(rows, 400)
