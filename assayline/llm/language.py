"""Language identification with a string kernel, Nyström landmarks and ridge regression.

The kernel of two texts is the number of byte n-grams (n = 1, 2, 3 together, lower case)
that both contain, over the geometric mean of their own numbers. Landmarks are whole
training texts. Kernel ridge regression of one-versus-rest targets is solved in the span of
the landmarks; a batch of texts is scored by two matrix products.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window, functions as F, types as T

from assayline.llm.tables import id_remainder, map_rows, pick

SCHEMA = "doc_id bigint, held_out boolean, lang_pred string, score double"
UNKNOWN = "und"


@dataclass(frozen=True)
class KernelSettings:
    # The model is fitted on at most this many distinct texts of each language, those with
    # the smallest hash, and the first of them are landmarks. Every row is scored.
    sample: int = 200
    # Languages learned, those with the most texts.
    languages: int = 256
    landmarks: int = 24
    ridge: float = 1e-2
    # Texts scored by one matrix product.
    batch: int = 256
    # Rows whose crc32(id as text) modulo `folds` is `held` are never learned from.
    folds: int = 4
    held: int = 2


_LETTER = regex.compile(r"\p{L}")  # the letter categories, as in `fit`
_OFFSETS = (0, 1 << 8, (1 << 8) + (1 << 16))
SPACE = (1 << 8) + (1 << 16) + (1 << 24)
_scratch: dict[str, np.ndarray] = {}


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def grams(text: str) -> np.ndarray:
    """Codes of the distinct n-grams of a text, exact for every n."""
    if "seen" not in _scratch:  # one per Python worker
        _scratch["seen"] = np.full(SPACE, -1, np.int32)
    seen = _scratch["seen"]
    raw = np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), np.uint8)
    b = raw.astype(np.int32)
    codes = np.concatenate(
        [
            b,
            (b[:-1] << 8 | b[1:]) + _OFFSETS[1],
            (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) + _OFFSETS[2],
        ]
    )
    # The last writer of a code keeps its place there: one survivor for each code.
    place = np.arange(len(codes), dtype=np.int32)
    seen[codes] = place
    return codes[seen[codes] == place]


@dataclass
class LanguageModel:
    languages: list[str]
    vocabulary: np.ndarray = field(repr=False)  # codes that occur in a landmark
    presence: np.ndarray = field(repr=False)  # code x landmark, 0 or 1
    norms: np.ndarray = field(repr=False)
    weights: np.ndarray = field(repr=False)  # landmark x language

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    def __init__(self, model: LanguageModel):
        self.model = model
        self.column = np.full(SPACE, -1, np.int32)
        self.column[model.vocabulary] = np.arange(len(model.vocabulary), dtype=np.int32)
        self.presence = model.presence.astype(np.float32)

    def kernel(self, codes: list[np.ndarray]) -> np.ndarray:
        x = np.zeros((len(codes), len(self.model.vocabulary)), np.float32)
        for row, own in enumerate(codes):
            columns = self.column[own]
            x[row, columns[columns >= 0]] = 1
        sizes = np.array([max(1, len(own)) for own in codes], np.float64)
        return (x @ self.presence) / np.sqrt(sizes[:, None] * self.model.norms[None, :])

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        languages = [UNKNOWN] * len(texts)
        scores = np.zeros(len(texts))
        rows = [k for k, text in enumerate(texts) if has_letter(text)]
        if rows and self.model.languages:
            values = self.kernel([grams(texts[k]) for k in rows]) @ self.model.weights
            best = values.argmax(axis=1)
            scores[rows] = np.clip(values[np.arange(len(rows)), best], 0.0, 1.0)
            for k, language in zip(rows, best):
                languages[k] = self.model.languages[language]
        return languages, scores


def solve(samples: list[tuple[str, np.ndarray]], settings: KernelSettings) -> LanguageModel:
    """Fit on (language, n-gram codes) pairs, in a fixed order."""
    languages = sorted({language for language, _ in samples})
    if not languages:
        empty = np.zeros((0, 0))
        return LanguageModel([], np.zeros(0, np.int64), empty, np.zeros(0), empty)
    marks = [
        codes
        for language in languages
        for codes in [c for other, c in samples if other == language][: settings.landmarks]
    ]
    vocabulary = np.unique(np.concatenate(marks))
    presence = np.zeros((len(vocabulary), len(marks)), np.uint8)
    for k, codes in enumerate(marks):
        presence[np.searchsorted(vocabulary, codes), k] = 1
    norms = np.array([max(1, len(c)) for c in marks], np.float64)
    model = LanguageModel(languages, vocabulary, presence, norms, np.zeros((len(marks), 0)))
    scorer = model.scorer()
    among = scorer.kernel(marks)
    targets = np.array([[float(own == other) for other in languages] for own, _ in samples])
    # Each language weighs the same, however many texts it has.
    share = np.array([1.0 / sum(own == other for other, _ in samples) for own, _ in samples])
    normal, right = np.zeros_like(among), np.zeros((len(marks), len(languages)))
    for k in range(0, len(samples), settings.batch):
        part = slice(k, k + settings.batch)
        rows = scorer.kernel([codes for _, codes in samples[part]])
        normal += rows.T @ (rows * share[part, None])
        right += rows.T @ (targets[part] * share[part, None])
    ridge = settings.ridge * (among + 1e-6 * np.eye(len(marks)))
    model.weights = np.linalg.lstsq(normal + ridge, right, rcond=None)[0]
    return model


def fit(
    docs: DataFrame,
    settings: KernelSettings = KernelSettings(),
    *,
    text: str = "text",
    language: str = "lang",
    doc_id: str = "doc_id",
) -> LanguageModel:
    """Learn from labelled rows outside the held-out fold."""
    rows = pick(docs, doc_id=doc_id, text=text, lang=language)
    held = F.coalesce(id_remainder("doc_id", settings.folds) == settings.held, F.lit(False))
    usable = rows.where(
        ~held & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    ).withColumn("key", F.xxhash64("text", "lang"))
    # Copies meet in one row before the languages are ranked, on keys without texts.
    keys = usable.select("lang", "key", F.shiftrightunsigned("key", 1).alias("order")).distinct()
    sizes = (
        keys.groupBy("lang").agg(F.count("*").alias("texts"))
        .orderBy(F.desc("texts"), "lang").limit(settings.languages)
    )
    # Some times the sample passes this bound, so few rows of a language are ever ranked.
    share = F.least(F.lit(1.0), (4 * settings.sample + 64) / F.col("texts"))
    few = keys.join(F.broadcast(sizes), "lang").where(F.col("order") <= share * 2.0**63)
    first = Window.partitionBy("lang").orderBy("order", "key")
    chosen = few.withColumn("place", F.row_number().over(first)).where(
        F.col("place") <= settings.sample
    )
    picked = [r["key"] for r in chosen.select("key").collect()]
    codes = F.udf(lambda t: grams(t).tolist(), T.ArrayType(T.IntegerType()))
    # At most `sample` rows a language meet here, each once.
    found = (
        usable.where(F.col("key").isin(picked) if picked else F.lit(False))
        .groupBy("lang", "key")
        .agg(F.min("text").alias("text"))
        .select("lang", "key", codes("text").alias("codes"))
        .orderBy("lang", "key")
        .collect()
    )
    return solve([(r["lang"], np.array(r["codes"], np.int64)) for r in found], settings)


def identify(
    docs: DataFrame,
    model: LanguageModel,
    settings: KernelSettings = KernelSettings(),
    *,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Language and score of every row.

    `und` and 0 for a null text or one without a letter, and for all if nothing could be
    learned. A null id is not held out. One row per input row; other columns are left out.
    """

    def run(batches):
        scorer = model.scorer()
        for batch in batches:
            texts = batch["text"].tolist()
            for k in range(0, len(texts), settings.batch):
                languages, scores = scorer.predict(texts[k : k + settings.batch])
                part = batch.iloc[k : k + settings.batch]
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"],
                        "held_out": part["held_out"],
                        "lang_pred": languages,
                        "score": scores,
                    }
                )

    rows = pick(docs, doc_id=doc_id, text=text).withColumn(
        "held_out",
        F.coalesce(id_remainder("doc_id", settings.folds) == settings.held, F.lit(False)),
    )
    return map_rows(rows, run, SCHEMA)
