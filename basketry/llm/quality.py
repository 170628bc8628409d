"""Quality rules: how far a document's characters and common words are from its language.

The references are counted over all documents of a language that pass the base rules:
a histogram of character classes, and one of the language's most common words with one
more bin for all other words.  A document's own histograms are compared with them by the
Jensen-Shannon distance (the square root of the divergence in bits, from 0 to 1).  A
histogram of too few characters or words says little, so it is not judged.

Everything is a DataFrame expression.  Texts are read once: the counts of each document
are written to the checkpoint folder, summed per language, and joined with the sums.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import checkpointed, words

# The twelve most common words of each language.
COMMON_WORDS = {
    "en": "the of and to a in is that it for was on",
    "de": "der die und in den von zu das mit sich des auf",
    "es": "de la que el en y los se del un las por",
    "fr": "de la le et les des en un une du est que",
}
SYMBOLS = r"[#*$%&|<>]"
#: Character classes as what a text keeps of each; the rest of its characters is one more.
CLASSES = {
    "lower": r"[^\p{Ll}]+",
    "upper": r"[^\p{Lu}]+",
    "digit": r"[^\p{Nd}]+",
    "space": r"[^\x20\x09-\x0D]+",
    "mark": r"[^.,;:!?'\"()\-]+",
}
#: Languages, of about 300 bytes each, up to which their sums are sent to every executor.
BROADCAST_LANGUAGES = 10_000
BINS = len(COMMON_WORDS["en"].split())
WINDOW = 5


@dataclass(frozen=True)
class Limits:
    """Base rules, distances above which a document goes, and sizes below which it is not judged."""

    min_words: int = 10
    max_repeated_percent: int = 20
    max_class_distance: float = 0.27
    max_word_distance: float = 0.29
    min_chars: int = 500
    min_judged_words: int = 100


def _counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """``row`` with a document's columns, its ``lang``, and a struct ``q`` of counts."""
    body = F.coalesce(F.col("_text"), F.lit(""))
    n = F.size("_words")
    step = docs.select(
        F.struct("*").alias("row"), F.col(text).alias("_text"), F.col(lang).alias("lang")
    ).withColumn("_words", words(F.col("_text")))
    step = step.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    at = lambda i, k: F.get(F.col("_hashes"), i + k)
    step = step.withColumn(
        "_grams",
        F.when(
            n >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), n - WINDOW),
                lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW)]),
            ),
        ),
    )
    # Sorting finds the repeated windows in n log n; most documents have none.
    step = step.withColumn(
        "_paired",
        F.when(
            F.size(F.array_distinct("_grams")) < F.size("_grams"),
            F.sort_array(
                F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))
            ),
        ),
    )
    same = lambda a, i: F.coalesce(a["g"] == F.get(F.col("_paired"), i)["g"], F.lit(False))
    step = step.withColumn(
        "_starts",
        F.sort_array(
            F.transform(
                F.filter("_paired", lambda p, i: same(p, i - 1) | same(p, i + 1)), lambda p: p["i"]
            )
        ),
    )
    covered = F.aggregate(
        F.transform(
            "_starts",
            lambda p, k: F.least(
                F.lit(WINDOW), F.coalesce(F.get(F.col("_starts"), k + 1) - p, F.lit(WINDOW))
            ),
        ),
        F.lit(0).cast("long"),
        lambda total, add: total + add,
    )
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    common = sorted({w for listed in COMMON_WORDS.values() for w in listed.split()})
    step = step.withColumn("_lines", lines).withColumn(
        "_common",
        F.transform(
            F.filter("_words", lambda w: F.lower(w).isin(common)), lambda w: F.lower(w)
        ),
    )
    own = F.create_map(
        *[F.lit(x) for k, v in COMMON_WORDS.items() for x in (k, v)]
    )
    step = step.withColumn("_own", F.split(own[F.col("lang")], " "))
    long_of = lambda c: c.cast("long")
    kept = {name: F.length(F.regexp_replace(body, rest, "")) for name, rest in CLASSES.items()}
    return step.select(
        "row",
        "lang",
        F.struct(
            long_of(n).alias("n_words"),
            long_of(F.length(body) - kept["space"]).alias("word_chars"),
            long_of(F.length(body) - F.length(F.regexp_replace(body, SYMBOLS, ""))).alias("n_symbols"),
            long_of(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
            F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
            F.array(*[long_of(c) for c in kept.values()]).alias("classes"),
            F.when(
                F.col("_own").isNotNull(),
                F.array(
                    *[
                        long_of(
                            F.size("_common")
                            - F.size(F.array_remove("_common", F.get(F.col("_own"), F.lit(i))))
                        )
                        for i in range(BINS)
                    ]
                ),
            ).alias("common"),
            long_of(F.length(body)).alias("n_chars"),
        ).alias("q"),
    )


def _with_rest(parts: Column, total: Column) -> Column:
    """Histogram of ``parts`` and what ``total`` has beside them."""
    summed = F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.concat(parts, F.array(total - summed))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of counts; null if either is empty."""
    total = lambda h: F.aggregate(h, F.lit(0.0), lambda a, x: a + x)
    n, m = total(p), total(q)

    def term(x: Column, y: Column) -> Column:
        both = (x + y) / 2
        part = lambda v: F.when(v > 0, v * F.log2(v / both)).otherwise(F.lit(0.0))
        return (part(x) + part(y)) / 2

    pairs = F.arrays_zip(
        F.transform(p, lambda x: x / n).alias("a"), F.transform(q, lambda x: x / m).alias("b")
    )
    spread = F.aggregate(pairs, F.lit(0.0), lambda a, z: a + term(z["a"], z["b"]))
    return F.when((n > 0) & (m > 0), F.sqrt(F.greatest(spread, F.lit(0.0))))


def quality_rules(
    docs: DataFrame, limits: Limits = Limits(), text: str = "text", lang: str = "lang"
) -> DataFrame:
    """Every row of ``docs`` with a struct ``quality``: counts, distances and the verdict.

    ``base_failed``: fewer than ``min_words`` words, or too many words in repeated windows of
    five.  ``kept``: neither that nor a distance above its limit.  A null text has no words
    and fails.  A null or unlisted language is a language of its own without common words: its
    documents are judged by characters alone.  Repeated rows are judged alike and all
    returned.  All columns of ``docs`` come back unchanged; one of the name ``quality`` is
    replaced.
    """
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    counted = _counts(docs.drop("quality"), text, lang)
    failed = (F.col("q.n_words") < limits.min_words) | (
        100 * F.col("q.n_repeat_words") > limits.max_repeated_percent * F.col("q.n_words")
    )
    counted = checkpointed(counted.withColumn("failed", failed))
    part = lambda name, i: F.sum(F.get(F.col(f"q.{name}"), F.lit(i)))
    references = checkpointed(
        counted.filter(~F.col("failed"))
        .groupBy(F.col("lang").alias("of"))
        .agg(
            F.array(*[part("classes", i) for i in range(len(CLASSES))]).alias("all_classes"),
            F.array(*[part("common", i) for i in range(BINS)]).alias("all_common"),
            F.sum("q.n_chars").alias("all_chars"),
            F.sum("q.n_words").alias("all_words"),
        )
    )
    if references.count() <= BROADCAST_LANGUAGES:
        references = F.broadcast(references)  # texts need not be dealt by language
    joined = counted.join(references, F.col("lang").eqNullSafe(F.col("of")), "left")
    distances = joined.withColumn(
        "class_distance",
        F.when(
            F.col("q.n_chars") >= limits.min_chars,
            js_distance(
                _with_rest(F.col("q.classes"), F.col("q.n_chars")),
                _with_rest(F.col("all_classes"), F.col("all_chars")),
            ),
        ),
    ).withColumn(
        "word_distance",
        F.when(
            F.col("q.n_words") >= limits.min_judged_words,
            js_distance(
                _with_rest(F.col("q.common"), F.col("q.n_words")),
                _with_rest(F.col("all_common"), F.col("all_words")),
            ),
        ),
    )
    far = (F.coalesce("class_distance", F.lit(0.0)) > limits.max_class_distance) | (
        F.coalesce("word_distance", F.lit(0.0)) > limits.max_word_distance
    )
    return distances.withColumn(
        "quality",
        F.struct(
            *[F.col(f"q.{name}") for name in base],
            F.col("failed").alias("base_failed"),
            "class_distance",
            "word_distance",
            (~F.col("failed") & ~far).alias("kept"),
        ),
    ).select("row.*", "quality")
