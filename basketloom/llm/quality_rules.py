"""Quality rules by distribution divergence, in DataFrame functions only.

Each text gets two histograms, of character classes and of common words (and all others). References per language are the
pooled histograms of the documents of that language that have few symbols. A text is rejected where the Jensen-Shannon distance to the
nearest reference is too large and the text is long enough for the histogram to mean something.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.llm.columns import WHITE, written

# Common words of the languages.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "a", "in", "is", "that"],
    "fr": ["de", "la", "le", "et", "les", "des", "un", "du"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se"],
}
BINS = sorted({w for words in COMMON_WORDS.values() for w in words})
CLASSES = ["small", "upper", "points", "symbols", "blanks", "wide"]
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class QualityParams:
    """Base rules and divergence bounds. A distance lies between 0 and 1."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_class_distance: float = 0.125
    min_class_chars: int = 200
    max_word_distance: float = 0.275
    min_histogram_words: int = 100
    max_reference_symbol_percent: int = 1


def _words(text: Column) -> Column:
    cut = F.trim(text, F.lit(BLANKS))
    return F.when(cut == "", F.array().cast("array<string>")).otherwise(F.split(cut, WHITE))


def _sorted_windows() -> Column:
    """33 bits of each 3-word window's hash above its 31-bit position, in order: equal windows are neighbours."""
    window = F.transform(F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.xxhash64(
        F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)).bitwiseAND(F.lit(~0x7FFFFFFF)) + i.cast("long"))
    return F.when(F.size("words") >= 3, F.sort_array(window)).otherwise(F.array().cast("array<bigint>"))


def _neighbours(sorted_array: str, key) -> Column:
    """Elements that have an equal neighbour."""
    return F.filter(sorted_array, lambda x, i: (key(x) == key(F.get(sorted_array, i - 1)))
                    | (key(x) == key(F.get(sorted_array, i + 1))))


def _equals(word: str):
    return lambda w: w == word


def base_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """(doc_id, text_hash, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_chars, classes, commons) per row."""
    lang = docs[lang_col] if lang_col else F.lit(None)
    rows = docs.select(docs[id_col].alias("doc_id"), lang.cast("string").alias("lang"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    rows = rows.withColumn("words", _words(F.col("text")))
    rows = rows.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    rows = rows.withColumn("windows", _sorted_windows())
    # Windows whose 33 bits meet are compared by their words, so that the count is exact.
    rows = rows.withColumn("alike", _neighbours("windows", lambda x: F.shiftright(x, 31)))
    rows = rows.withColumn("alike", F.sort_array(F.transform("alike", lambda x: F.struct(
        F.concat_ws(" ", F.slice("words", x.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int") + 1, 3)).alias("k"),
        x.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("p")))))
    rows = rows.withColumn("places", F.sort_array(F.transform(
        _neighbours("alike", lambda x: x["k"]), lambda x: x["p"])))
    covered = F.aggregate(F.transform("places", lambda p, i: F.least(
        F.lit(3), F.coalesce(F.get("places", i + 1) - p, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    rows = rows.withColumn("commons", F.filter("words", lambda w: w.isin(BINS)))
    rows = rows.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), "lang", "text", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"), "commons")
    upper, points, odd = (F.regexp_count("text", F.lit(p)).cast("long")
                          for p in ("[A-Z]", "[.,;:!?()'\"-]", r"[@=+_~^`{}\[\]\\/]"))
    rows = rows.select("*", upper.alias("upper"), points.alias("points"),
                       (odd + F.col("n_symbols")).alias("symbols"),
                       (F.length("text") - F.col("word_chars")).alias("blanks"),
                       (F.octet_length("text") - F.length("text")).cast("long").alias("wide"), F.length("text").alias("n_chars"))
    small = F.col("n_chars") - F.col("upper") - F.col("points") - F.col("symbols") - F.col("blanks")
    counted = F.array(*[F.size(F.filter("commons", _equals(c))).cast("long") for c in BINS],
                      F.col("n_words") - F.size("commons"))
    return rows.select(
        "doc_id", "text_hash", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars",
        F.array(small.cast("long"), *CLASSES[1:]).alias("classes"), counted.alias("commons"))


def references(features: DataFrame, max_symbol_percent: int) -> list[tuple[list[int], list[int]]]:
    """Pooled (classes, commons) counts of each language with a word list: four rows at most.

    Over all its documents, but for those with more symbols than the given percentage of their words.
    """
    features = features.where(100 * F.col("n_symbols") <= max_symbol_percent * F.col("n_words"))
    sums = [F.sum(F.col("classes")[i]).alias(f"c{i}") for i in range(len(CLASSES))]
    sums += [F.sum(F.col("commons")[i]).alias(f"w{i}") for i in range(len(BINS) + 1)]
    rows = features.where(F.col("lang").isin(list(COMMON_WORDS))).groupBy("lang").agg(*sums).orderBy("lang").collect()
    return [([r[f"c{i}"] for i in range(len(CLASSES))], [r[f"w{i}"] for i in range(len(BINS) + 1)]) for r in rows]


def js_distance(counts: Column, reference: list[int]) -> Column:
    """Jensen-Shannon distance (root of the divergence, base 2) of two count vectors; null if one is empty."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    whole = sum(reference)
    shares = F.array(*[F.lit(x / whole if whole else 0.0) for x in reference])

    def part(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0))

    terms = F.zip_with(F.transform(counts, lambda x: x / total), shares, lambda p, q: part(p, q) + part(q, p))
    distance = F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2))
    return F.when(total > 0, distance) if whole else F.lit(None).cast("double")


def judge(features: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """Adds class_distance, word_distance (to the nearest reference), base_failed and kept to ``features``."""
    found = references(features, params.max_reference_symbol_percent)
    foreign = ~F.coalesce(F.col("lang").isin(list(COMMON_WORDS)), F.lit(True))
    script_free = F.concat(F.slice("classes", 1, len(CLASSES) - 1), F.array(F.lit(0).cast("long")))
    nearest = []
    for i, counts in enumerate((F.when(foreign, script_free).otherwise(F.col("classes")), F.col("commons"))):
        distances = [js_distance(counts, pair[i]) for pair in found]
        nearest.append(F.array_min(F.array(*distances)) if distances else F.lit(None).cast("double"))
    rows = features.withColumns({"class_distance": nearest[0], "word_distance": F.when(~foreign, nearest[1])})
    failed = (F.col("n_words") < params.min_words) | (
        100 * F.col("n_repeat_words") > params.max_repeat_percent * F.col("n_words"))
    odd_classes = (F.col("n_chars") >= params.min_class_chars) & (F.col("class_distance") > params.max_class_distance)
    odd_words = (F.col("n_words") >= params.min_histogram_words) & (F.col("word_distance") > params.max_word_distance)
    return rows.select("*", failed.alias("base_failed"),
                       (~failed & ~F.coalesce(odd_classes, F.lit(False)) & ~F.coalesce(odd_words, F.lit(False))).alias("kept"))


def quality_rules(docs: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """One row per row of ``docs``: text_hash, the base counts, both distances, base_failed and kept.

    Null and empty texts have no words and fail the base rules. Rows whose language has no word list (or is null)
    add to no reference. Texts of a named language without a list have no word distance, and their classes are compared without
    the bytes of their script; texts without a language are judged by the nearest of all references. With no reference the base rules decide alone.
    Repeated rows are judged each; an empty table gives no rows. Counts are written once, without the texts.
    """
    return judge(written(base_features(docs)), params)
