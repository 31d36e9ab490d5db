"""Quality rules on documents: repetition and size, and distance from how their language is written.

Every text has two histograms: of character classes, and of the most common words of its language against all
other words. The references are the same histograms summed over all documents of the language that pass the base
rules, so they follow the corpus. A text of at least ``MIN_CHARS`` characters or ``MIN_WORDS`` words whose
Jensen-Shannon distance from its reference is above the limit is rejected; shorter ones say too little and pass.

DataFrame functions only. Rows: a null or empty text has no words and fails the base rules; a document whose
language is null or has no reference is judged by the base rules alone. Repeated rows are judged each. Of other
columns none is read; a column that bears the name of a measure is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronomart.llm.scratch import written

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 50
MIN_CHARS = 200
#: Limits of the Jensen-Shannon distance, a square root between 0 and 1. A short text misses most common words by
#: chance alone, so its word limit is wider by WORD_NOISE over the root of its length.
MAX_CLASS_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.2
WORD_NOISE = 1.6

# Common words of the languages.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "it", "was", "for", "on", "are", "with", "as", "be",
           "at", "this", "have", "from", "or", "by", "not", "but"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "que", "est", "pour", "qui", "dans", "au",
           "par", "sur", "pas", "plus", "avec", "ce", "il", "elle"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im",
           "dem", "nicht", "ein", "eine", "als", "auch", "es", "an", "werden"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "no",
           "una", "su", "al", "lo", "es", "más", "como", "o"],
}
LONGEST = max(len(w) for listed in COMMON_WORDS.values() for w in listed)


def _shifted(values: str, by: int) -> tuple[Column, Column]:
    """An array without its last ``by`` items, and without its first."""
    left = F.greatest(F.size(values) - by, F.lit(0))
    return F.slice(values, 1, left), F.slice(values, by + 1, left)


def with_windows(df: DataFrame, words: str = "words") -> DataFrame:
    """Adds ``n_repeat_words``: words in windows of eight that occur twice or more in the same text.

    Each step is a column of its own that the next reads more than once, so none is computed again inside
    a lambda. Positions are only sorted for texts in which some window repeats.
    """
    df = df.withColumn("_h1", F.transform(words, lambda w: F.xxhash64(w)))
    for reach in (1, 2, 4):
        df = df.withColumn(
            f"_h{2 * reach}", F.zip_with(*_shifted(f"_h{reach}", reach), lambda a, b: F.xxhash64(a, b))
        )
    df = df.withColumn("_twice", F.size(F.array_distinct(f"_h{WINDOW}")) < F.size(f"_h{WINDOW}"))
    df = df.withColumn(
        "_sorted",
        F.when(
            F.col("_twice"),
            F.array_sort(
                F.zip_with(
                    f"_h{WINDOW}",
                    F.sequence(F.lit(1), F.size(f"_h{WINDOW}")),
                    lambda h, at: F.struct(h.alias("h"), at.alias("at")),
                )
            ),
        ),
    )
    df = df.withColumn("_same", F.zip_with(*_shifted("_sorted", 1), lambda a, b: a["h"] == b["h"]))
    no = F.array(F.lit(False))
    df = df.withColumn(
        "_found", F.zip_with(F.concat(no, "_same"), F.concat("_same", no), lambda a, b: a | b)
    )
    df = df.withColumn(
        "_at",
        F.array_sort(
            F.filter(
                F.zip_with("_sorted", "_found", lambda s, found: F.when(found, s["at"])),
                lambda at: at.isNotNull(),
            )
        ),
    )
    steps = F.zip_with(*_shifted("_at", 1), lambda a, b: F.least(b - a, F.lit(WINDOW)))
    covered = F.aggregate(steps, F.lit(WINDOW), lambda total, step: total + step)
    return df.withColumn("n_repeat_words", F.when(F.col("_twice"), covered).otherwise(0).cast("long")).drop(
        "_h1", "_h2", "_h4", "_h8", "_twice", "_sorted", "_same", "_found", "_at"
    )


def _without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def measures(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with the base measures, ``base_failed`` and the two histograms ``classes`` and ``common``."""
    listed = F.create_map(
        *[x for k, v in COMMON_WORDS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))]
    )
    whole = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumn("_text", whole).withColumn(
        "words", F.filter(F.split("_text", SPACES), lambda w: w != "")
    )
    df = with_windows(df).withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = (
        df.withColumn("n_words", F.size("words").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("words", "")).cast("long"))
        .withColumn("n_chars", F.length("_text").cast("long"))
        .withColumn("n_symbols", F.col("n_chars") - _without(F.col("_text"), SYMBOLS))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
        # Letters only, each word between two spaces of its own.
        .withColumn("_plain", F.concat(F.lit(" "), F.regexp_replace(F.lower("_text"), r"[^\p{L}]+", "  "), F.lit(" ")))
        # Without the words that are longer than any listed one, which is then sought in less.
        .withColumn("_short", F.regexp_replace("_plain", f"[^ ]{{{LONGEST + 1},}}", ""))
        .withColumn("_listed", listed[F.col(lang)])
    )
    letters = F.length(F.replace("_plain", F.lit(" "), F.lit("")))
    upper = F.col("n_chars") - _without(F.col("_text"), r"\p{Lu}+")
    digits = F.col("n_chars") - _without(F.col("_text"), "[0-9]+")
    spaces = F.col("n_chars") - F.col("word_chars")
    rest = F.col("n_chars") - letters - digits - spaces - F.col("n_symbols")
    # Bytes, which are known of a string without counting its characters.
    found = F.transform(
        "_listed",
        lambda w: (
            (F.octet_length("_short") - F.octet_length(F.replace(F.col("_short"), F.concat(F.lit(" "), w, F.lit(" ")), F.lit(""))))
            / (F.octet_length(w) + 2)
        ).cast("long"),
    )
    return (
        df.withColumn(
            "classes",
            F.transform(
                F.array(letters - upper, upper, digits, spaces, F.col("n_symbols"), F.greatest(rest, F.lit(0))),
                lambda n: n.cast("long"),
            ),
        )
        .withColumn("common", found)
        .drop("_text", "words", "_lines", "_plain", "_short", "_listed")
    )


def _total(values: str) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, b: a + b)


def with_other_words(df: DataFrame) -> DataFrame:
    """The word histogram with all other words as its last entry."""
    listed = _total("common")
    return df.withColumn(
        "common", F.concat("common", F.array(F.greatest(F.col("n_words") - listed, F.lit(0).cast("long"))))
    )


def references(measured: DataFrame, lang: str = "lang") -> DataFrame:
    """``(lang, ref_classes, ref_common)``: sums over all documents of a language that pass the base rules."""
    good = measured.where(~F.col("base_failed") & F.col("common").isNotNull())

    def sums(name: str, size: int) -> Column:
        return F.array(*[F.sum(F.get(name, F.lit(i))) for i in range(size)])

    return good.groupBy(F.col(lang).alias("_lang")).agg(
        sums("classes", 6).alias("ref_classes"), sums("common", len(COMMON_WORDS["en"]) + 1).alias("ref_common")
    )


def js_distance(df: DataFrame, counts: str, reference: str, out: str) -> DataFrame:
    """Adds the Jensen-Shannon distance, in bits, of two histograms; null without counts on either side."""

    def share(values: str) -> Column:
        return F.transform(values, lambda n: n / F.col(f"_total_{values}"))

    def part(x: Column, middle: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / middle)).otherwise(0.0)

    totals = {f"_total_{v}": _total(v) for v in (counts, reference)}
    df = df.withColumns(totals)
    parts = F.zip_with(
        share(counts), share(reference), lambda p, q: part(p, (p + q) / 2) + part(q, (p + q) / 2)
    )
    divergence = F.aggregate(parts, F.lit(0.0), lambda a, b: a + b) / 2
    there = (F.col(f"_total_{counts}") > 0) & (F.col(f"_total_{reference}") > 0)
    return df.withColumn(out, F.when(there, F.sqrt(F.greatest(divergence, F.lit(0.0))))).drop(*totals)


def judge(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` without its text but with measures, distances and ``kept``. Writes the measured rows to the
    shared folder: the references need all of them first. There is one reference row per listed language."""
    measured = written(with_other_words(measures(docs, text, lang)).drop(text), "measures")
    known = references(measured, lang)
    df = measured.join(F.broadcast(known), F.col(lang) == F.col("_lang"), "left").drop("_lang")
    df = js_distance(df, "classes", "ref_classes", "class_distance")
    df = js_distance(df, "common", "ref_common", "word_distance")
    far = (F.col("n_chars") >= MIN_CHARS) & (F.col("class_distance") > MAX_CLASS_DISTANCE)
    limit = MAX_WORD_DISTANCE + WORD_NOISE / F.sqrt("n_words")
    far |= (F.col("n_words") >= MIN_WORDS) & (F.col("word_distance") > limit)
    return df.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(far, F.lit(False))).drop(
        "ref_classes", "ref_common"
    )


def kept_documents(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that are kept, with their own columns."""
    rows = docs.select(F.col(text).alias("_body"), F.col(lang).alias("_language"), F.struct("*").alias("_row"))
    return judge(rows, "_body", "_language").where("kept").select("_row.*")
