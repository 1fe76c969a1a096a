"""Operators that give one row per document: against the libraries and brute force."""

import collections
import hashlib
import os
import random
import re

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from assayline.llm import bpe_tree, language, license_scan, pii, quality, token_counts
from tests.llm.conftest import EDGE

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")

ALPHABETS = (
    "abcdefgh", "thei nghaou", "'s't'll're !!''", "éèüßçñ中国", "0123 ,.", "é ä ̈́",
    "a\x1cb \x85\xa0　 ", "ΣσΑ İI", "👍🏽👨‍👩", "aaaaaaa", "\n\t", "\0 x", "<|endoftext|><",
)


def strings(seed: int, count: int):
    r = random.Random(seed)
    for _ in range(count):
        pool = "".join(r.sample(ALPHABETS, r.randint(1, 3)))
        text = "".join(r.choice(pool) for _ in range(r.choice([0, 3, 20, 70, 150, 400])))
        yield text + "<|endoftext|>" + text if r.random() < 0.1 else text


def test_tree_equals_the_library():
    library = Tokenizer.from_file(WORDS)
    r = random.Random(1)
    encoder = bpe_tree.TreeEncoder(WORDS)
    for text in strings(2, 1500):
        encoder.settings = bpe_tree.TreeSettings(
            leaf=r.choice([3, 8, 32, 100]), window=r.choice([1, 2, 16]), longest=r.choice([3, 64])
        )
        encoder.words = {}
        encoder.learn([text])
        ids, decoded = encoder.encode_decode(text)
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert decoded == library.decode(want, skip_special_tokens=False)


def test_a_worker_keeps_no_words_after_a_task():
    encoder = bpe_tree.TreeEncoder(WORDS)
    rows = pd.DataFrame({"doc_id": ["1", "2"], "text": ["some words here", "others"]})
    for ids, part in bpe_tree._texts(iter([rows]), encoder):
        assert len(encoder.words) == 4 and [encoder.encode_decode(t)[1] for t in part]
    assert not encoder.words and not encoder.older
    assert [len(p) for _, p in bpe_tree._texts(iter([rows, rows]), encoder)] == [2, 2]


def test_counts_equal_the_library():
    library = Tokenizer.from_file(BYTES)
    counter = token_counts.MergeCounter(BYTES)
    texts = list(strings(3, 1500)) + ["ab" * 3000 + "ing" * 500]
    for k in range(0, len(texts), 100):
        want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts[k : k + 100]]
        assert counter.count(texts[k : k + 100]) == want


def test_edge_rows_of_tokens(edge_docs, no_docs):
    words, counted = Tokenizer.from_file(WORDS), Tokenizer.from_file(BYTES)
    want, sizes = [], []
    for doc_id, text in EDGE:
        ids = words.encode(text or "", add_special_tokens=False).ids
        decoded = words.decode(ids, skip_special_tokens=False)
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want.append((doc_id, len(ids), digest, hashlib.sha256(decoded.encode()).hexdigest()))
        n = len(counted.encode(text or "", add_special_tokens=False).ids)
        sizes.append((doc_id, len((text or "").encode()), n, n > 1024))
    got = bpe_tree.encode_digests(edge_docs, WORDS).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    got = token_counts.token_counts(edge_docs, BYTES).collect()
    assert sorted(map(tuple, got), key=str) == sorted(sizes, key=str)
    assert bpe_tree.encode_documents(no_docs, WORDS).count() == 0
    assert token_counts.token_counts(no_docs, BYTES).count() == 0


# --- licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def license_base(text: str):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words, places = WORD.findall(text), []
    for phrase, label in license_scan.PHRASES:
        size = len(phrase.split())
        places += [
            (k, label) for k in range(len(words)) if words[k : k + size] == phrase.split()
        ]
    return len(words), sorted(places)


def test_license_base_and_fuzzy():
    scanner = license_scan.Scanner()
    r = random.Random(5)
    pieces = ["mit", "MIT-", "license", "License", "apache", " ", "\n", "é", "x", "general public", ","]
    for _ in range(2000):
        text = "".join(r.choice(pieces) for _ in range(r.randint(0, 12)))
        found = scanner.scan(text)
        assert (found.n_words, sorted(found.base)) == license_base(text)
    spans = scanner.scan("é Releesed undr the MIT Licence.").spans
    assert [s[:4] for s in spans] == [("mit-notice", 2, 31, 3)]
    assert scanner.scan("Released upon the river, nothing here").spans == []


def test_every_notice_is_found_with_its_errors():
    settings = license_scan.ScanSettings()
    scanner = license_scan.Scanner(settings)
    r = random.Random(6)
    for notice in scanner.notices:
        for _ in range(20):
            text = list(notice.text)
            for at in r.sample(range(len(text)), notice.errors):
                text[at] = "#"
            found = scanner.scan("before " + "".join(text) + " after").spans
            assert notice.label in [s[0] for s in found]


def changed(r, text, edits):
    """Some insertions, deletions and substitutions by letters the notices don't have."""
    for _ in range(edits):
        at, kind = r.randrange(len(text)), r.randrange(3)
        text = text[:at] + ("#" if kind else "") + text[at + (kind != 1) :]
    return text


def test_edited_notices_in_a_row_are_all_found():
    """Up to the allowed edits of any kind, each notice beside others of its kind; spans are
    where an edit distance over all stretches says."""
    scanner = license_scan.Scanner()
    r = random.Random(7)
    for notice in scanner.notices:
        for _ in range(6):
            edits = [r.randint(0, notice.errors) for _ in range(5)]
            copies = [changed(r, notice.text, n) for n in edits]
            text = " ~~~~~ ".join(copies)
            spans = [s for s in scanner.scan(text).spans if s[0] == notice.label]
            assert len(spans) == len(copies)
            for (label, start, end, errors, share), copy, n in zip(spans, copies, edits):
                assert errors <= n and share == pytest.approx(1 - errors / len(notice.text))
                assert errors == distance(notice.text, text[start:end])


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_an_earlier_worse_notice_is_not_lost():
    scanner = license_scan.Scanner()
    for text in (
        "released under teh mit license released under the mit license",
        "released under the mit license released under teh mit license",
    ):
        assert [s[1:3] for s in scanner.scan(text).spans] == [(0, 30), (31, 61)]


def test_license_edge_rows(edge_docs, no_docs):
    got = license_scan.scan_licenses(edge_docs).collect()
    assert sorted(r.n_words for r in got) == sorted(license_base(t or "")[0] for _, t in EDGE)
    assert all(r.first_word is None and r.labels == "" and r.score == 0 for r in got)
    assert license_scan.scan_licenses(no_docs).count() == 0
    assert license_scan.find_notices(edge_docs).count() == 0


# --- personal data

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def holds(kind: str, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base_list(text: str | None) -> str:
    return ",".join(
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern in BASE.items()
        for m in re.finditer(pattern, text or "")
        if holds(kind, m[0])
    )


def test_pii_base_equals_the_patterns(spark, edge_docs):
    r = random.Random(8)
    pools = ("ab.@-_%+1 ", "0123456789 -.", "+12() .-5", "1.2.3.255.256.0", "é😀a@b.c 1+",
             "4111 1111 1111 1111-", "aB@c.d-e@f.g_")
    rows = [
        (k, "".join(r.choice(pools[k % len(pools)]) for _ in range(r.randint(0, 60))))
        for k in range(1500)
    ]
    rows += [(9999, "a.b" * 3000 + "@" + "c.d" * 4000 + "1." * 3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for docs, want in ((frame, rows), (edge_docs, EDGE)):
        got = pii.report(docs).collect()
        ours = sorted(
            (str(x.doc_id), ",".join(s for s in x.spans.split(",") if s.split(":")[0] in BASE))
            for x in got
        )
        assert ours == sorted((str(i), base_list(t)) for i, t in want)
        for x in got:
            base = ",".join(s for s in x.spans.split(",") if s.split(":")[0] in BASE)
            assert x.base_sha256 == hashlib.sha256(base.encode()).hexdigest()


def prose(r, n):
    return " ".join("".join(r.choices("abcdefghijklmnop", k=r.randint(3, 8))) for _ in range(n))


def test_revealing_words_are_taken_and_others_left(spark, no_docs):
    r = random.Random(1)
    rows = [(k, f"{prose(r, 30)} Zanzibor writes to z@example.com today {prose(r, 30)}") for k in range(6)]
    rows += [(9, f"heard of zanzibor {prose(r, 60)}")]
    rows += [(10 + k, f"{prose(r, 30)} today writes to {prose(r, 30)}") for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    texts = {x.doc_id: x.text for x in pii.sanitise(docs).collect()}
    # 7 texts hold the word, 6 of them the address: p is 0.487 at the lower end of 6 / 7, and
    # 1 - log2(1 / 0.487) / log2(607 / 6) = 0.844, so the word is generalised.
    for k in (*range(6), 9):
        want = rows[min(k, 6)][1].replace("Zanzibor", "[generalised]").replace("zanzibor", "[generalised]")
        assert texts[k] == want.replace("z@example.com", "[email]")
    assert all(texts[i] == t for i, t in rows if i >= 10)
    assert pii.report(no_docs).count() == 0 and pii.sanitise(no_docs).columns == no_docs.columns


def test_near_copies_and_chance_reveal_nothing(spark):
    """A text in many slightly different copies is one context; rare words meet by chance."""
    r = random.Random(2)
    copied = f"{prose(r, 80)} Zanzibor writes to z@example.com today {prose(r, 80)}"
    rows = [(k, f"{copied} {prose(r, 2)}") for k in range(8)]
    rows += [(20 + k, f"{prose(r, 40)} y@example.com {prose(r, 3)}") for k in range(12)]
    rows += [(100 + k, prose(r, 60)) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    texts = {x.doc_id: x.text for x in pii.sanitise(docs).collect()}
    for i, t in rows:
        assert texts[i] == re.sub("[yz]@example.com", "[email]", t)


def shares(rows, settings):
    """Terms and shares by the formulas, over sets of texts; entity value by text index."""
    import itertools
    import math

    n_term = collections.Counter(w for _, t in rows for w in set(re.findall(r"[^\W\d_]+", t.lower())))
    clear = [re.sub(r"[a-z0-9]+@[a-z0-9]+\.[a-z]+", " ", t) for _, t in rows]
    words = [set(re.findall(r"[^\W\d_]+", t.lower())) for t in clear]
    found = collections.defaultdict(set)
    for k, (_, t) in enumerate(rows):
        for m in re.finditer(r"[a-z0-9]+@[a-z0-9]+\.[a-z]+", t):
            found[m[0]].add(k)
    out, z = {}, settings.deviations
    pairs = len(found) * len(n_term)
    for entity, holders in found.items():
        for word in set(itertools.chain.from_iterable(words[k] for k in holders)):
            both, n = sum(word in words[k] for k in holders), n_term[word]
            mean = n * len(holders) / len(rows)
            if both <= mean or math.log(pairs) + both - mean + both * math.log(mean / both) > math.log(settings.by_chance):
                continue
            p = both / n
            low = (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
            share = 1 + math.log2(low) / math.log2(len(rows) / len(holders))
            if share >= settings.generalise:
                out[word] = max(share, out.get(word, 0))
    return out


def test_shares_equal_the_formulas(spark):
    r = random.Random(5)
    vocabulary = [prose(r, 1) for _ in range(3000)]
    rows = []
    for k in range(700):
        words = r.sample(vocabulary, 25)
        group = k % 25
        if group < 4:
            words += [f"{'abcd'[group]}1@mail.com"]
            words += [w for w in (f"name{'abcd'[group]}", f"town{'ab'[group % 2]}") if r.random() < 0.9]
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    settings = pii.PiiSettings()
    keyed = docs.selectExpr("text", "unhex(md5(text)) as key")
    got = {x.term: x.reveals for x in pii.revealing(keyed, settings).collect()}
    want = shares(rows, settings)
    assert {"namea", "nameb", "namec", "named"} <= set(want)
    assert got == pytest.approx(want)


def test_sanitise_keeps_columns_of_any_name(spark, edge_docs):
    names = ["_key", "_spans", "key", "base", "row", "spans", "terms", "extra", "clean"]
    docs = edge_docs.select("doc_id", "text", *[F.col("text").alias(c) for c in names])
    for x in pii.sanitise(docs).collect():
        same = [x[c] for c in names]
        assert same == [same[0]] * len(names)
        if x.text != same[0]:
            assert "[email]" in x.text and "[phone]" in x.text
    renamed = docs.withColumnRenamed("text", "body")
    assert pii.sanitise(renamed, text="body").columns == renamed.columns


# --- models


@pytest.fixture(scope="module")
def known(spark, sf_dir):
    """The next larger tables if they are there: the smallest have 20 held-out labels."""
    larger = os.path.join(os.path.dirname(sf_dir), "sf0.01")
    folder = larger if os.path.isdir(larger) else sf_dir
    return [spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels")]


def test_quality_on_held_out_labels(known):
    docs, labels = known
    scored = quality.classify(docs, labels)
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert scored.count() == docs.count() and len(rows) > 5
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9
    again = quality.classify(docs.repartition(5), labels).collect()
    first = {r.doc_id: r.score for r in scored.collect()}
    assert all(abs(first[r.doc_id] - r.score) < 1e-9 for r in again)


def test_quality_edges(edge_docs, no_docs, known):
    labels = known[1]
    for some in (labels, labels.where("false")):
        rows = quality.classify(edge_docs, some).collect()
        assert len(rows) == len(EDGE)
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert quality.classify(no_docs, labels).count() == 0
    assert quality.keep_good(edge_docs, labels).columns == edge_docs.columns


def test_tables_add_up_to_the_score():
    rng = np.random.default_rng(1)
    x = rng.random((400, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # a pure interaction
    settings = quality.QualitySettings(rounds=20)
    model = quality.train(x, y, settings)
    assert (0, 1) in model.pairs
    assert np.mean((model.scores(x) > 0.5) == y) > 0.95


def test_scores_are_sums_of_table_entries():
    """Every score again, entry by entry, from the edges and tables alone."""
    import bisect
    import math

    rng = np.random.default_rng(2)
    x = rng.random((300, len(quality.FEATURES)))
    y = ((x[:, 0] + x[:, 3] * x[:, 5]) > 0.7).astype(float)
    model = quality.train(x, y, quality.QualitySettings(rounds=8))
    for row, got in zip(x, model.scores(x)):
        places = [bisect.bisect_left(edges.tolist(), v) for edges, v in zip(model.edges, row)]
        total = model.base + sum(table[k] for table, k in zip(model.tables, places))
        for (a, b), table in zip(model.pairs, model.pair_tables):
            total += table[model.coarse[a][places[a]]][model.coarse[b][places[b]]]
        assert got == pytest.approx(1 / (1 + math.exp(-total)))


def test_trees_take_the_best_cuts():
    """The first cut of a shallow tree is the best of all, by squared sums over weights."""
    rng = np.random.default_rng(3)
    for _ in range(100):
        n = int(rng.integers(2, 12))
        g, h = rng.normal(size=n), rng.random(n) + 0.1
        value = quality._tree(g, h, 2, 1.0)

        def gain(cut):
            return sum(g[p].sum() ** 2 / (h[p].sum() + 1.0) for p in (slice(0, cut), slice(cut, n)))

        best = max(range(1, n), key=gain)
        if gain(best) - g.sum() ** 2 / (h.sum() + 1.0) > 1e-6:
            for p in (slice(0, best), slice(best, n)):
                assert value[p] == pytest.approx(g[p].sum() / (h[p].sum() + 1.0))


def test_kernel_and_ridge_equal_a_dense_solution():
    r = random.Random(4)
    pools = {"xx": "abcd ", "yy": "cdef ", "zz": "fgha "}
    texts = [(k, "".join(r.choices(pool, k=r.randint(5, 60)))) for k, pool in pools.items() for _ in range(20)]
    settings = language.KernelSettings(landmarks=6, batch=7)
    model = language.solve([(k, language.grams(t)) for k, t in texts], settings)

    def grams(text):
        raw = f" {text.lower()} ".encode()
        return {raw[k : k + n] for n in (1, 2, 3) for k in range(len(raw) - n + 1)}

    def kernel(left, right):
        return np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in right] for a in left])

    marks = [grams(t) for name in sorted(pools) for t in [t for k, t in texts if k == name][:6]]
    c, k = kernel([grams(t) for _, t in texts], marks), kernel(marks, marks)
    targets = np.array([[float(own == other) for other in sorted(pools)] for own, _ in texts])
    share = np.array([1 / 20] * len(texts))
    left = (c * share[:, None]).T @ c + settings.ridge * (k + 1e-6 * np.eye(len(marks)))
    weights = np.linalg.solve(left, (c * share[:, None]).T @ targets)
    new = ["".join(r.choices(pool, k=30)) for pool in pools.values()]
    got = model.scorer().kernel([language.grams(t) for t in new])
    assert got == pytest.approx(kernel([grams(t) for t in new], marks), rel=1e-5)
    assert got @ model.weights == pytest.approx(kernel([grams(t) for t in new], marks) @ weights, abs=1e-3)
    assert model.scorer().predict(new)[0] == sorted(pools)


@pytest.mark.parametrize("text,letter", [
    ("½ ² Ⅷ", False), ("٣", False), ("_ 12", False), ("ª", True), ("漢", True), ("é", True), ("ⓐ", False), ("", False),
])
def test_letters_are_the_letter_categories(spark, text, letter):
    assert language.has_letter(text) == letter
    rows = spark.createDataFrame([(text,)], "text string")
    assert rows.where(F.col("text").rlike(r"\p{L}")).count() == letter


def test_language_sample_is_bounded(spark):
    """Rare languages beyond the bound are left out, large ones are not ranked whole."""
    r = random.Random(1)
    rows = [(4 * k + 1, "".join(r.choices("abc ", k=20)) + str(k), "big") for k in range(400)]
    rows += [(4 * k + 3, "".join(r.choices("xyz ", k=20)) + str(k), "mid") for k in range(30)]
    rows += [(5000 + 4 * k + 1, "qqq", f"rare{k}") for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, language.KernelSettings(sample=10, languages=2, landmarks=4))
    assert model.languages == ["big", "mid"] and model.presence.shape[1] == 8


def test_language_on_the_held_out_fold(known):
    docs = known[0]
    found = language.identify(docs, language.fit(docs))
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 20 and np.mean([r.lang_pred == r.lang for r in rows]) > 0.95


def test_language_edges(edge_docs, no_docs, known):
    model = language.fit(known[0])
    rows = {(r.doc_id, r.lang_pred == "und", r.score == 0) for r in language.identify(edge_docs, model).collect()}
    assert {(1, True, True), (2, True, True), (3, True, True), (4, False, False)} <= rows
    assert language.identify(no_docs, model).count() == 0
    nothing = language.fit(no_docs)
    assert {r.lang_pred for r in language.identify(edge_docs, nothing).collect()} == {"und"}


def test_distinct_grams_are_exact():
    text = "Abab ééa"
    raw = f" {text.lower()} ".encode()
    want = {raw[k : k + n] for n in (1, 2, 3) for k in range(len(raw) - n + 1)}
    assert len(language.grams(text)) == len(want)
