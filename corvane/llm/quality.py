"""Quality rules: counts of plain defects, and the divergence of a text's histograms from those of its language."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.mixing import SPACES, words_of
from corvane.session import cut_lineage

# The character classes of a histogram, each taken from what those before it left; the rest is "other".
CLASSES = {
    "lower": "[a-z]+",
    "upper": "\\p{Lu}+",
    "letter": "\\p{L}+",
    "digit": "[0-9]+",
    "stop": "[.,;:'\"()\\-]+",
    "mark": "[!?]+",
    "symbol": "[#*$%&|<>]+",
}
KINDS = [*CLASSES, "other"]


def _covered(places: Column, width: int) -> Column:
    """Words that windows at these ascending places cover: ``width`` each, less what the next one covers too."""
    reach = F.transform(places, lambda p, i: F.least(F.lit(width), F.coalesce(F.get(places, i + 1), p + width) - p))
    return F.aggregate(reach, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: a lambda over an array of one names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated_words(words: Column, width: int = 3) -> Column:
    """How many words lie in a window of ``width`` words that occurs twice or more in the same array.

    Words are hashed, a window's hash combines its words', and the sorted hashes put equal windows side by side. Below
    65 536 words 47 bits of the hash and the place share one long, which sorts fast and parts windows with a
    probability of error under 10^-5 in the longest of these texts; longer texts sort (64-bit hash, place) structs.
    """
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    last = F.size(words) - width

    def window(h: Column, i: Column) -> Column:
        out = F.get(h, i)
        for k in range(1, width):
            out = out.bitwiseXOR(F.shiftleft(F.get(h, i + k), k))
        return out

    def packed(h: Column) -> Column:
        keys = F.transform(F.sequence(F.lit(0), last), lambda i: window(h, i).bitwiseAND(F.lit(0x7FFFFFFFFFFF0000)).bitwiseOR(i.cast("bigint")))

        def places(s: Column) -> Column:
            again = F.filter(s, lambda x, i: (x.bitwiseXOR(F.get(s, i + 1)) < 65536) | (x.bitwiseXOR(F.get(s, i - 1)) < 65536))
            return F.sort_array(F.transform(again, lambda x: x.bitwiseAND(F.lit(65535))))

        return _bound(_bound(F.sort_array(keys), places), lambda p: _covered(p, width))

    def whole(h: Column) -> Column:
        keys = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(window(h, i).alias("h"), i.cast("bigint").alias("i")))

        def places(s: Column) -> Column:
            again = F.filter(s, lambda x, i: (x["h"] == F.get(s, i + 1)["h"]) | (x["h"] == F.get(s, i - 1)["h"]))
            return F.sort_array(F.transform(again, lambda x: x["i"]))

        return _bound(_bound(F.sort_array(keys), places), lambda p: _covered(p, width))

    return (
        F.when(last < 1, F.lit(0).cast("bigint"))
        .when(last < 65536, _bound(hashed, packed))
        .otherwise(_bound(hashed, whole))
    )


def class_counts(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``_c_<class>`` per character class; needs ``_chars``, the characters without white space.

    The first class goes together with white space, and each class is cut out of what those before it left, so only one
    pattern sees the whole text.
    """
    (first, pattern), *others = CLASSES.items()
    rest = df.withColumn("_rest", F.regexp_replace(text, f"[{pattern[1:-2]}{SPACES[1:-2]}]+", ""))
    rest = rest.withColumn(f"_c_{first}", F.col("_chars") - F.length("_rest"))
    for name, pattern in others:
        rest = rest.withColumn("_next", F.regexp_replace("_rest", pattern, ""))
        rest = rest.withColumn(f"_c_{name}", (F.length("_rest") - F.length("_next")).cast("bigint")).drop("_rest").withColumnRenamed("_next", "_rest")
    return rest.withColumn("_c_other", F.length("_rest").cast("bigint")).drop("_rest")


def _half(p: Column, q: Column) -> Column:
    """The share of one bin in the Jensen-Shannon divergence, in bits."""
    m = (p + q) / 2
    part = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    return (part(p) + part(q)) / 2


def common_words(tokens: DataFrame, common: int, buckets: int = 1 << 16) -> DataFrame:
    """``_ref, _word, _count``: the ``common`` most frequent words of each reference, ties by word, exactly.

    Hash buckets are counted first, which are numbers and few. Words are counted in the fullest buckets only, and then in
    every other bucket that holds as much as the last word found so far, as no word of a lesser one can be more frequent.
    """
    of = F.pmod(F.xxhash64("_word"), F.lit(buckets)).cast("int").alias("_b")
    full = cut_lineage(tokens.groupBy("_ref", of).agg(F.count(F.lit(1)).alias("n")))
    first = full.withColumn("_at", F.row_number().over(Window.partitionBy("_ref").orderBy(F.col("n").desc(), "_b"))).filter(F.col("_at") <= 4 * common)
    first = cut_lineage(first.select("_ref", "_b"))
    counted = lambda chosen: tokens.withColumn("_b", of).join(chosen, ["_ref", "_b"], "left_semi").groupBy("_ref", "_word").agg(F.count(F.lit(1)).alias("_count"))
    most = Window.partitionBy("_ref").orderBy(F.col("_count").desc(), "_word")
    found = cut_lineage(counted(first).withColumn("_at", F.row_number().over(most)).filter(F.col("_at") <= common))
    mark = found.filter(F.col("_at") == common).select("_ref", F.col("_count").alias("_mark"))
    rest = full.join(mark, "_ref", "left").filter(F.col("n") >= F.coalesce("_mark", F.lit(0))).join(first, ["_ref", "_b"], "left_anti")
    rest = cut_lineage(rest.select("_ref", "_b"))
    if not rest.isEmpty():
        both = found.drop("_at").unionByName(counted(rest))
        found = cut_lineage(both.withColumn("_at", F.row_number().over(most)).filter(F.col("_at") <= common))
    return found.drop("_at")


def judge_quality(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    common: int = 48,
    class_distance: float = 0.34,
    word_distance: float = 0.31,
    word_noise: float = 0.9,
    min_class_chars: int = 100,
    min_common_words: int = 80,
    min_reference: int = 1000,
    min_words: int = 50,
    most_repeated: int = 50,
) -> DataFrame:
    """One row per document: ``key``, its counts, ``class_distance``, ``word_distance``, ``base_failed`` and ``kept``.

    The language references are the histograms of all other texts of a language: characters by class, and the ``common``
    most frequent words, lower-cased, by their share of all words; a document is no part of its own reference. Where the
    others have fewer than ``min_reference`` words, the characters are held against all other texts of the table and the
    words are not judged. A document is compared by the Jensen-Shannon distance, and rejected if its characters lie further than ``class_distance`` or its common words
    further than ``word_distance + word_noise / sqrt(words)`` from the reference, as the chance part of the distance falls
    with the root of the length. A text with fewer than ``min_class_chars`` characters or ``min_common_words`` words is not
    judged by the one or the other. Documents with fewer than ``min_words`` words, or with more than ``most_repeated``
    percent of them in repeated windows, fail before.

    Null text has no words and fails. Every language has its own reference, however many there are; null counts as the
    empty one. Rows with equal keys are judged each by itself. An empty table gives no rows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(key).alias("_key"), F.col(lang).alias("_lang"), body.alias("_text"))
    base = base.withColumn("_words", words_of("_text")).withColumn("_t", F.xxhash64("_text"))
    base = base.withColumn("_chars", F.length(F.array_join("_words", "")).cast("bigint"))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\u000b\f\r"))) > 0)
    again = _bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    measured = class_counts(base, "_text").select(
        "_key",
        F.coalesce("_lang", F.lit("")).alias("_ref"),
        "_t",
        F.size("_words").cast("bigint").alias("_n"),
        again.cast("bigint").alias("_again"),
        repeated_words(F.col("_words")).cast("bigint").alias("_repeat"),
        "_chars",
        F.transform("_words", F.lower).alias("_low"),
        *[f"_c_{k}" for k in KINDS],
    )
    measured = cut_lineage(measured, "zstd")
    tokens = measured.select("_ref", "_t", F.explode("_low").alias("_word"))
    top = common_words(tokens, common)
    referring = measured.drop("_low")
    sums = referring.groupBy("_ref").agg(F.sum("_n").alias("_all"), F.sum("_chars").alias("_all_chars"), *[F.sum(f"_c_{k}").alias(f"_s_{k}") for k in KINDS])
    sums = cut_lineage(sums)
    # counts of the common words of each text; a text stands once for all its copies, whose shares are the same
    found = (
        tokens.join(top, ["_ref", "_word"])
        .groupBy("_ref", "_t", "_word")
        .agg(F.count(F.lit(1)).alias("_own"), F.first("_count").alias("_count"))
    )
    sizes = referring.groupBy("_ref", "_t").agg(F.first("_n").alias("_size"), F.count(F.lit(1)).alias("_copies"))
    shares = found.join(sizes, ["_ref", "_t"]).join(sums.select("_ref", "_all"), "_ref")
    shares = shares.withColumn("_own", F.col("_own") / F.col("_copies")).withColumn("_p", F.col("_own") / F.col("_size"))
    others = lambda n: F.greatest(F.lit(1), F.col("_all") - F.col(n))
    parts = shares.groupBy("_ref", "_t").agg(
        F.sum(_half(F.col("_p"), (F.col("_count") - F.col("_own")) / others("_size"))).alias("_div"), F.sum("_p").alias("_hit"),
        F.sum("_own").alias("_mine"), F.sum("_count").alias("_met"),
    )
    held = top.groupBy("_ref").agg(F.sum("_count").alias("_held"))
    pooled = sums.agg(F.sum("_all_chars").alias("_t_chars"), *[F.sum(f"_s_{k}").alias(f"_t_{k}") for k in KINDS])
    languages = cut_lineage(sums.join(held, "_ref", "left").withColumn("_pool", pooled.select(F.struct("*")).scalar()).select("*", "_pool.*").drop("_pool"))
    judged = referring.join(languages, "_ref").join(parts, ["_ref", "_t"], "left")
    none = lambda c: F.coalesce(c, F.lit(0))
    # a common word that a text lacks adds half its share in the reference
    lacking = (none("_held") - none("_met")) / others("_n") / 2
    left = lambda x: F.greatest(F.lit(0.0), 1 - x)
    rest = _half(left(none("_hit")), left((none("_held") - none("_mine")) / others("_n")))
    words_far = F.sqrt(F.greatest(F.lit(0.0), none("_div") + lacking + rest))
    enough = F.col("_all") - F.col("_n") >= min_reference

    def apart(kind: str) -> Column:
        other = F.when(enough, F.col(f"_s_{kind}")).otherwise(F.col(f"_t_{kind}")) - F.col(f"_c_{kind}")
        chars = F.when(enough, F.col("_all_chars")).otherwise(F.col("_t_chars")) - F.col("_chars")
        return F.when(chars > 0, _half(F.col(f"_c_{kind}") / F.col("_chars"), other / chars)).otherwise(0.0)

    classes_far = F.sqrt(F.greatest(F.lit(0.0), sum([apart(k) for k in KINDS], F.lit(0.0))))
    failed = (F.col("_n") < min_words) | (100 * F.col("_repeat") > most_repeated * F.col("_n"))
    return judged.select(
        F.col("_key").alias(key),
        F.col("_n").alias("n_words"),
        F.col("_chars").alias("word_chars"),
        F.col("_c_symbol").alias("n_symbols"),
        F.col("_again").alias("n_dup_lines"),
        F.col("_repeat").alias("n_repeat_words"),
        F.when(F.col("_chars") >= min_class_chars, classes_far).alias("class_distance"),
        F.when((F.col("_n") >= min_common_words) & enough, words_far).alias("word_distance"),
        failed.alias("base_failed"),
    ).withColumn(
        "kept",
        ~F.col("base_failed")
        & (F.coalesce("class_distance", F.lit(0.0)) <= class_distance)
        & (F.coalesce("word_distance", F.lit(0.0)) <= word_distance + word_noise / F.sqrt(F.greatest(F.lit(1), F.col("n_words")))),
    )
