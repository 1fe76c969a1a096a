"""Personal data: patterns, and terms that give a protected value away by co-occurrence.

DataFrame functions only. Emails, addresses, cards and phone numbers are found by pattern.
Each distinct value found is a protected entity. A word in a text that holds it carries
pointwise mutual information about it; the share of the entity's own information that the
word reveals is

    1 - log2(1 / p) / log2(N / n(entity)),    p = n(word, entity) / n(word)

over all N documents. p is taken at the lower end of its confidence interval, and the two
must meet in so many contexts that chance would not bring any pair of the whole corpus
together as often: the bound on the chance, times the number of all pairs of an entity and
a word, must stay under a level. So the support grows with the corpus. Near copies of one
text are one context: texts are told apart by the smallest word hashes that they have.

Words that reveal more than a threshold are generalised or, beyond a higher threshold,
removed wherever they stand, also in texts without a pattern match. Entities that share the
set of their texts are examined as one.

Texts stay where they lie. Only the words of texts with an entity, and the counts of words,
are shuffled; the words found are few and are brought to the texts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from assayline.llm.tables import forget, holding, written
from assayline.operators.lookup import LookupBounds, fits

# The kinds in their order, and their patterns.
KINDS = ("email", "ip", "card", "phone", "removed", "generalised")

# A run that failed from its first character fails from every later one, so a match may
# only begin where a run begins, or where the last match ended. Possessive repetition keeps
# long texts linear and off the stack. Neither changes what matches.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_TERM = r"[\p{L}\p{M}]++"
_SPAN = "array<struct<kind:int,start:int,end:int,value:string>>"


@dataclass(frozen=True)
class PiiSettings:
    # Share of the entity's information from which a word is generalised, and removed.
    generalise: float = 0.8
    remove: float = 0.95
    # Standard deviations of the confidence interval of p.
    deviations: float = 1.96
    # Expected number of pairs that meet often enough by chance, over the whole corpus.
    by_chance: float = 0.01
    # Smallest hashes by which near copies are told from other texts.
    marks: int = 4


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)
    doubled = F.transform(
        F.sequence(F.lit(1), F.length(digits)),
        lambda i: F.substring(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1),
    )
    total = F.aggregate(
        doubled, F.lit(0), lambda sum_, x: sum_ + F.when(x > 9, x - 9).otherwise(x)
    )
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _matches(text: Column, pattern: str, kind: int | Column) -> Column:
    """Spans of all matches in order: the lengths between and of matches, added up."""
    pieces = F.zip_with(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        F.split(text, pattern, -1),
        lambda value, before: F.struct(value.alias("value"), F.length(before).alias("gap")),
    )
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))

    def add(state, piece):
        start = state["at"] + piece["gap"]
        end = start + F.length(piece["value"])
        kind_ = F.lit(kind) if isinstance(kind, int) else kind
        span = F.struct(
            kind_.alias("kind"), start.alias("start"), end.alias("end"), piece["value"].alias("value")
        )
        more = F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))
        return F.when(piece["value"].isNull(), state).otherwise(more)

    return F.aggregate(pieces, begin, add, lambda state: state["spans"])


def _holds(kind: str):
    return lambda s: _valid(kind, s["value"])


def _of(kind: int):
    return lambda s: s["kind"] == kind


def base_spans(text: Column) -> Column:
    """Pattern matches that hold, by kind and then start, in code points."""
    none = F.array().cast(_SPAN)
    # What a text must hold before its pattern is tried.
    worth = {
        "email": F.contains(text, F.lit("@")),
        "ip": text.rlike(r"[0-9]\.[0-9]"),
        "card": text.rlike(r"[0-9][\x20-]?[0-9]"),
        "phone": F.contains(text, F.lit("+")),
    }
    found = []
    for kind, pattern in PATTERNS.items():
        spans = _matches(text, pattern, KINDS.index(kind))
        found.append(F.when(worth[kind], F.filter(spans, _holds(kind))).otherwise(none))
    return F.concat(*found)


def _terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(_TERM), F.lit(0)))


def _entity(span: Column) -> Column:
    """Kind and value of a span, the same however it is written."""
    value = F.when(span["kind"] >= 2, _digits(span["value"])).otherwise(F.lower(span["value"]))
    return F.struct(span["kind"].alias("kind"), value.alias("value"))


def _unlikely(meetings: str, settings: PiiSettings) -> Column:
    """Whether chance would hardly bring any pair together in so many contexts.

    Chernoff's bound of a Poisson count of mean m = n(word) n(entity) / N to reach c, which is
    e^(c - m) (m / c)^c, times the number of pairs, in logarithms.
    """
    mean, c = F.col("n_term") * F.col("n_entity") / F.col("n"), F.col(meetings)
    bound = c - mean + c * F.log(mean / c)
    return (c > mean) & (F.log(F.col("pairs")) + bound <= math.log(settings.by_chance))


def _reveals(settings: PiiSettings) -> Column:
    """Share of the entity's information, p at the lower end of Wilson's interval."""
    z, n = settings.deviations, F.col("n_term")
    p = F.least(F.lit(1.0), F.col("both") / n)
    middle = p + z * z / (2 * n)
    width = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    lowest = F.greatest((middle - width) / (1 + z * z / n), F.lit(1e-300))
    return 1 + F.log2(lowest) / F.log2(F.col("n") / F.col("n_entity"))


def _beside(rows: DataFrame, side: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join with a side that is broadcast only where measured to be small."""
    return rows.join(F.broadcast(side) if fits(side, LookupBounds()) else side.hint("merge"), on, how)


def revealing(rows: DataFrame, settings: PiiSettings = PiiSettings()) -> DataFrame:
    """term and the largest share it reveals of any entity. `rows` has text (no nulls) and key
    (md5 of the text)."""
    found = holding(rows.select("key", "text"), "base", base_spans(F.col("text")))
    matched = written(found.where(F.size("base") > 0), "pii-matched")
    clear = sanitised(F.col("text"), F.col("base"), " ")
    # The copies of a text are one row, without the text.
    marks = [_two_smallest(F.transform("terms", _seeded(k))) for k in range(settings.marks)]
    distinct = matched.groupBy("key").agg(
        F.count("*").alias("copies"), F.first("text").alias("text"), F.first("base").alias("base")
    )
    texts = written(
        holding(distinct, "terms", _terms(clear)).select(
            "key", "copies", "terms", F.array(*marks).alias("marks"),
            F.array_distinct(F.transform("base", _entity)).alias("entities"),
        ),
        "pii-texts",
    )
    # Stored, so that the join can split the rows of a term that most texts hold.
    counts = written(
        rows.select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term").agg(
            F.count("*").alias("n_term")
        ),
        "pii-counts",
    )
    held = texts.select("key", "copies", "marks", F.explode("entities").alias("entity"))
    # The set of an entity's texts by two 64-bit sums.
    same = [F.bit_xor(F.xxhash64("key", F.lit(k))).alias(f"set{k}") for k in (0, 1)]
    classes = written(
        held.groupBy("entity")
        .agg(*same, F.count("*").alias("texts"), F.sum("copies").alias("n_entity"))
        .groupBy("set0", "set1", "texts", "n_entity")
        .agg(F.min("entity").alias("entity"), F.count("*").alias("members")),
        "pii-entities",
    )
    n, words = rows.count(), counts.count()
    pairs = float((classes.agg(F.sum("members")).first()[0] or 0) * words)
    # Were every text of the entity, and no other, to hold the word.
    best = (
        classes.select("entity", "texts", "n_entity", F.lit(n).alias("n"), F.lit(pairs).alias("pairs"))
        .where(F.col("n") > F.col("n_entity"))
        .withColumn("n_term", F.col("texts"))
    )
    # No term met with the entity in all its texts reveals enough if it is in more texts.
    most = F.col("n_entity") * F.pow(F.col("n") / F.col("n_entity"), F.lit(1 - settings.generalise))
    entities = written(
        best.where(_unlikely("texts", settings))
        .select("entity", "n", "pairs", "n_entity", (most * (1 + 1e-9)).alias("most")),
        "pii-candidates",
    )
    bounded = _beside(held, entities, "entity")
    widest = entities.agg(F.max("most")).first()[0] or 0.0
    terms = written(
        texts.join(bounded.select("key").distinct(), "key", "left_semi")
        .select("key", F.explode("terms").alias("term"))
        .join(counts.where(F.col("n_term") <= widest).hint("merge"), "term"),
        "pii-terms",
    )
    pair = ["entity", "term", "n", "pairs", "n_entity", "n_term"]
    met = written(
        bounded.join(terms.hint("merge"), "key")
        .where(F.col("n_term") <= F.col("most"))
        .groupBy(*pair)
        .agg(F.sum("copies").alias("both"), F.count("*").alias("texts"))
        .withColumn("reveals", _reveals(settings))
        .where((F.col("reveals") >= settings.generalise) & _unlikely("texts", settings)),
        "pii-met",
    )
    # Of the few that are left, the texts that are no near copies of one another.
    apart = [
        F.count_distinct(_mark_without("term", k)).alias(f"apart{k}") for k in range(settings.marks)
    ]
    contexts = (
        _beside(terms.select("key", "term"), met.select("term").distinct(), "term", "left_semi")
        .join(bounded.select("entity", "key", "marks"), "key")
        .join(met.select("entity", "term").hint("merge"), ["entity", "term"])
        .groupBy("entity", "term")
        .agg(*apart)
        .select("entity", "term", F.least(*[f"apart{k}" for k in range(settings.marks)]).alias("contexts"))
    )
    strong = written(
        met.join(contexts, ["entity", "term"])
        .where(_unlikely("contexts", settings))
        .groupBy("term")
        .agg(F.max("reveals").alias("reveals")),
        "pii-strong",
    )
    forget(matched, texts, counts, classes, entities, terms, met)
    return strong


def _seeded(seed: int):
    return lambda word: F.xxhash64(word, F.lit(seed))


def _two_smallest(hashes: Column) -> Column:
    return F.slice(F.sort_array(hashes), 1, 2)  # of different words, so different


def _mark_without(term: str, seed: int) -> Column:
    """A text's smallest word hash, not counting the term, which all texts compared have."""
    smallest, next_ = [F.get(F.get("marks", F.lit(seed)), F.lit(k)) for k in (0, 1)]
    return F.when(smallest == F.xxhash64(term, F.lit(seed)), F.coalesce(next_, smallest)).otherwise(smallest)


def _places(text: Column, terms: Column) -> Column:
    """start, end and word of every word of the text that is one of `terms`."""
    pieces = F.zip_with(
        F.regexp_extract_all(text, F.lit(_TERM), F.lit(0)),
        F.split(text, _TERM, -1),
        lambda value, before: F.struct(value.alias("value"), F.length(before).alias("gap")),
    )
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))

    def add(state, piece):
        start = state["at"] + piece["gap"]
        end = start + F.length(piece["value"])
        word = F.lower(piece["value"])
        span = F.struct(
            F.element_at(terms, word).alias("kind"), start.alias("start"), end.alias("end"), word.alias("value")
        )
        spans = F.when(
            F.map_contains_key(terms, word), F.concat(state["spans"], F.array(span))
        ).otherwise(state["spans"])
        more = F.struct(end.alias("at"), spans.alias("spans"))
        return F.when(piece["value"].isNull(), state).otherwise(more)

    return F.aggregate(pieces, begin, add, lambda state: state["spans"])


def _annotated(rows: DataFrame, settings: PiiSettings) -> DataFrame:
    """`rows` (row, text) with spans: pattern matches by kind and then start, and the
    revealing words by place. Texts stay where they are."""
    keyed = rows.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("key", F.unhex(F.md5("text")))
    whole = holding(keyed, "base", base_spans(F.col("text")))
    kind = F.when(F.col("reveals") >= settings.remove, KINDS.index("removed")).otherwise(
        KINDS.index("generalised")
    )
    strong = revealing(keyed, settings).select("term", kind.alias("kind"))
    words = keyed.select("key", F.explode(_terms(F.col("text"))).alias("term"))
    hits = written(
        _beside(words, strong, "term")
        .distinct()
        .groupBy("key")
        # the revealing terms of one text
        .agg(F.map_from_entries(F.collect_list(F.struct("term", "kind"))).alias("terms")),
        "pii-hits",
    )
    extra = F.when(F.col("terms").isNotNull(), _places(F.col("text"), F.col("terms"))).otherwise(
        F.array().cast(_SPAN)
    )

    def clear(w):
        return ~F.exists("base", lambda s: (s["start"] < w["end"]) & (s["end"] > w["start"]))

    place = F.array_sort(F.filter("extra", clear))
    sized = F.broadcast(hits) if _small(hits) else hits.hint("merge")
    found = holding(whole.join(sized, "key", "left"), "extra", extra)
    return holding(found, "spans", F.concat("base", place)).select("row", "text", "spans")


def _small(hits: DataFrame) -> bool:
    """Whether the words found may be broadcast: measured as rows of a word each."""
    return fits(hits.select("key", F.explode(F.map_keys("terms")).alias("term")), LookupBounds())


def find(
    docs: DataFrame,
    settings: PiiSettings = PiiSettings(),
    *,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """doc_id and all spans of every row, by kind and then start, in code points."""
    rows = docs.select(docs[doc_id].alias("row"), docs[text].alias("text"))
    return _annotated(rows, settings).select(F.col("row").alias("doc_id"), "spans")


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def report(docs: DataFrame, settings: PiiSettings = PiiSettings(), **columns: str) -> DataFrame:
    """Counts, digest and spans of every row.

    One row per input row, repeated rows included. A null or empty text has no spans, zero
    counts, the digest of an empty list and an empty `spans`. Other columns are left out.
    """
    found = find(docs, settings, **columns)
    base = F.filter("spans", lambda s: s["kind"] < 4)
    counts = [
        F.size(F.filter("spans", _of(k))).cast("bigint").alias(f"n_{KINDS[k]}")
        for k in range(4)
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def sanitised(text: Column, spans: Column, mark: str | None = None) -> Column:
    """The text with every span replaced by its kind in brackets, or by `mark`; removed words
    leave '[]'."""
    marks = F.array(*[F.lit(mark or (f"[{k}]" if k != "removed" else "[]")) for k in KINDS])
    # In order of place, the longest first; what an earlier span covers is skipped.
    ordered = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind")
            ),
        )
    )
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def add(state, s):
        end = -s["back"]
        gap = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        mark = F.element_at(marks, s["kind"] + 1)
        return (
            F.when(end <= state["at"], state)
            .when(
                s["start"] < state["at"],
                F.struct(end.alias("at"), state["out"].alias("out")),
            )
            .otherwise(
                F.struct(
                    end.alias("at"), F.concat(state["out"], F.array(gap, mark)).alias("out")
                )
            )
        )

    return F.aggregate(
        ordered,
        begin,
        add,
        lambda state: F.concat(
            F.array_join(state["out"], ""),
            F.substring(text, state["at"] + 1, F.length(text) - state["at"]),
        ),
    )


def sanitise(
    docs: DataFrame, settings: PiiSettings = PiiSettings(), *, text: str = "text"
) -> DataFrame:
    """All rows and columns of `docs`, the text sanitised.

    Null texts stay null, empty ones empty, and rows without spans are as they were; equal
    texts come out equal. An empty table gives no rows. Columns may have any other names.
    """
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text].alias("text"))
    clean = F.when(F.size("spans") == 0, F.col("row")[text]).otherwise(
        sanitised(F.col("text"), F.col("spans"))
    )
    done = _annotated(rows, settings).withColumn("clean", clean)
    return done.select(
        *[(F.col("clean") if c == text else F.col("row")[c]).alias(c) for c in docs.columns]
    )
