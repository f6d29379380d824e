"""Token tables, corpus statistics, term weights and the terms of a query."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions import text as tx
from corvane.operators import ordering

# Class factors and the counts assumed for special and unknown terms.
FREQUENCY_TOTAL = 10_000_000
DOCUMENT_TOTAL = 1_000_000_000
NUMBER = r"^[0-9,.]{2,}$"
SHORT_WORD = r"^[a-z]{1,2}$"
NUMBER_GROUP = r"^[0-9. -]{2,}$"
LETTERS = r"^[a-z. -]+$"
LEADING_DIGIT = r"^[0-9-]"


def tokenize(df: DataFrame, text: str = "content") -> DataFrame:
    """Add word tokens and sub-tokens of a text column."""
    plain = tx.strip_table_tags(text)
    return df.withColumns({"tokens": tx.words(plain), "fine_tokens": tx.fine_words(plain)})


def explode_tokens(df: DataFrame, key: str, tokens: Column | str = "tokens") -> DataFrame:
    """One row ``(key, pos, token)`` per token."""
    return df.select(key, F.posexplode(tokens).alias("pos", "token"))


def document_frequency(
    df: DataFrame, key: str, tokens: Column | str = "tokens", vocabulary: DataFrame | None = None
) -> DataFrame:
    """``(token, df, tf)``: documents holding the token and its occurrences.

    Occurrences are counted within the row, so one aggregation with a map side is all there is to shuffle. A
    ``vocabulary(token)`` restricts the count to its tokens.
    """
    rows = df.select(F.explode(tx.counted(tokens)).alias("e")).select("e.token", "e.n")
    if vocabulary is not None:
        rows = rows.join(vocabulary.select("token").distinct(), "token", "left_semi")
    return rows.groupBy("token").agg(F.count(F.lit(1)).alias("df"), F.sum("n").alias("tf"))


def inverse_frequency(n: Column, total: int) -> Column:
    """``log10(10 + (N - n + 0.5) / (n + 0.5))``."""
    return F.log10(F.lit(10) + (F.lit(float(total)) - n + 0.5) / (n + 0.5))


def raw_term_weight(token: Column, tf: Column, df: Column) -> Column:
    """Weight of a term before normalising; ``tf`` and ``df`` are null for a term the corpus lacks."""
    unknown = F.when(token.rlike(LETTERS), 300.0)
    freq = F.when(token.rlike(NUMBER_GROUP), 3.0).otherwise(
        F.greatest(F.coalesce(tf.cast("double"), unknown, F.lit(10.0)), F.lit(10.0))
    )
    docs = F.when(token.rlike(NUMBER_GROUP), 5.0).otherwise(F.coalesce(df.cast("double") + 3, unknown, F.lit(3.0)))
    kind = F.when(token.rlike(NUMBER), 2.0).when(token.rlike(SHORT_WORD), 0.01).otherwise(1.0)
    role = F.when(token.rlike(LEADING_DIGIT), 2.0).otherwise(1.0)
    return (0.3 * inverse_frequency(freq, FREQUENCY_TOTAL) + 0.7 * inverse_frequency(docs, DOCUMENT_TOTAL)) * kind * role


def term_weights(token_rows: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """Add ``weight`` to rows ``(key, …, token)``: term weights that add up to 1 within each key.

    A key is one question or one text, whose tokens came out of one row, so a window holds them.
    """
    raw = raw_term_weight(F.col("token"), F.col("tf"), F.col("df"))
    return (
        token_rows.join(stats, "token", "left")
        .withColumn("_raw", raw)
        .withColumn("weight", F.col("_raw") / F.sum("_raw").over(Window.partitionBy(key)))
        .drop("tf", "df", "_raw")
    )


def token_merge(tokens: Column, stop_words: Sequence[str] = ()) -> Column:
    """Join runs of short terms: runs of two to four become one term, longer runs give pairs first.

    A leading short term joins a following long non-Latin one.
    """
    short = lambda t: (F.length(t) == 1) | t.rlike("^[0-9a-z]{1,2}$")
    joins = lambda t: short(t) & (t != "") & ~t.isin(*stop_words) if stop_words else short(t) & (t != "")
    none = F.array().cast("array<string>")

    def flush(run: Column) -> Column:
        n = F.size(run)
        pairs = F.greatest(F.lit(0), F.floor((n - 3) / 2).cast("int"))
        leading = F.when(
            pairs > 0,
            F.transform(F.sequence(F.lit(1), pairs), lambda i: F.array_join(F.slice(run, i * 2 - 1, F.lit(2)), " ")),
        ).otherwise(none)
        rest = F.when(n > pairs * 2, F.array(F.array_join(F.slice(run, pairs * 2 + 1, n - pairs * 2), " "))).otherwise(none)
        return F.concat(leading, rest)

    second = F.try_element_at(tokens, F.lit(2))
    opens = (
        short(F.coalesce(F.try_element_at(tokens, F.lit(1)), F.lit("--")))
        & (F.size(tokens) > 1)
        & F.coalesce((F.length(second) > 1) & ~second.rlike("^[0-9a-zA-Z]"), F.lit(False))
    )
    first = F.when(opens, F.array(F.array_join(F.slice(tokens, 1, 2), " "))).otherwise(none)
    body = F.when(opens, F.slice(tokens, F.lit(3), F.size(tokens))).otherwise(tokens)
    state = F.struct(none.alias("done"), none.alias("run"))

    def step(acc: Column, t: Column) -> Column:
        return F.when(
            joins(t), F.struct(acc["done"].alias("done"), F.array_append(acc["run"], t).alias("run"))
        ).otherwise(
            F.struct(
                F.concat(acc["done"], flush(acc["run"]), F.array(t)).alias("done"), none.alias("run")
            )
        )

    folded = F.aggregate(body, state, step, lambda acc: F.concat(acc["done"], flush(acc["run"])))
    return F.filter(F.concat(first, folded), lambda t: t != "")


def synonym_expand(token_rows: DataFrame, dictionary: DataFrame, limit: int = 8) -> DataFrame:
    """Synonyms of each weighted term at a quarter of its weight; ``dictionary(token, synonyms)``."""
    return (
        token_rows.join(dictionary, "token")
        .withColumn("synonym", F.explode(F.slice("synonyms", 1, limit)))
        .withColumn("weight", F.col("weight") / 4)
        .drop("synonyms")
    )


def query_terms(
    queries: DataFrame, stats: DataFrame, dictionary: DataFrame | None = None, max_terms: int | None = None
) -> DataFrame:
    """Terms of each question ``(query_id, kind, term, weight)``.

    ``term`` rows carry the term weights, ``synonym`` rows a quarter, ``pair`` rows (adjacent terms as a phrase)
    twice the larger weight. ``max_terms`` limits the terms used per question.
    """
    rows = explode_tokens(queries.withColumn("tokens", tx.words(tx.normalize_query("text"))), "query_id")
    weighed = term_weights(rows, stats, "query_id")
    if max_terms is not None:
        weighed = weighed.filter(F.col("pos") < max_terms)
    per_query = weighed.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "token", "weight"))).alias("t")
    )
    t = F.col("t")
    pairs = F.when(
        F.size(t) > 1,
        F.zip_with(
            F.slice(t, F.lit(1), F.size(t) - 1),
            F.slice(t, F.lit(2), F.size(t) - 1),
            lambda a, b: F.struct(
                F.concat_ws(" ", a["token"], b["token"]).alias("term"),
                (F.greatest(a["weight"], b["weight"]) * 2).alias("weight"),
            ),
        ),
    )
    out = weighed.select("query_id", F.lit("term").alias("kind"), F.col("token").alias("term"), "weight").unionByName(
        per_query.select("query_id", F.lit("pair").alias("kind"), F.explode(pairs).alias("p")).select(
            "query_id", "kind", "p.term", "p.weight"
        )
    )
    if dictionary is not None:
        extra = synonym_expand(weighed, dictionary)
        out = out.unionByName(
            extra.select("query_id", F.lit("synonym").alias("kind"), F.col("synonym").alias("term"), "weight")
        )
    return out.groupBy("query_id", "kind", "term").agg(F.sum("weight").alias("weight"))


def paragraph_query(texts: DataFrame, stats: DataFrame, key: str, topn: int = 30, tokens: str = "tokens") -> DataFrame:
    """The heaviest ``topn`` distinct terms of each text ``(key, tokens)`` as a query, with the matches it needs.

    Needed matches are a tenth of the terms (half to even), at most three. A text's terms are brought together once and
    ranked and counted there; a limit before the shuffle would sort all terms and find few of a text in one place.
    """
    distinct = texts.select(key, F.explode(F.array_distinct(tokens)).alias("token"))
    weighed = distinct.join(stats, "token", "left").select(
        key, "token", F.round(raw_term_weight(F.col("token"), F.col("tf"), F.col("df")), 6).alias("weight")
    )
    top = ordering.topk_per_query(weighed.repartition(key), topn, score="weight", tie="token", key=key)
    terms = F.count(F.lit(1)).over(Window.partitionBy(key))
    return top.withColumn("need", F.least(F.lit(3), F.bround(terms / 10, 0)).cast("int")).withColumnRenamed("token", "term")


def chunk_keywords(texts: DataFrame, stats: DataFrame, total: DataFrame, key: str, topn: int, tokens: str = "tokens") -> DataFrame:
    """The ``topn`` terms of each text by term frequency times ``ln(N / df)``, as a list column.

    ``texts(key, tokens)`` has one row per text, ``total`` is the one-row table ``(documents)``.
    """
    tf = texts.select(key, F.explode(tx.counted(tokens)).alias("e")).select(key, "e.token", F.col("e.n").alias("_n"))
    scored = (
        tf.join(stats.select("token", "df"), "token")
        .withColumn("documents", total.scalar())
        .withColumn("score", F.round(F.col("_n") * F.ln(F.col("documents") / F.col("df")), 6))
    )
    top = ordering.topk_per_query(scored, topn, score="score", tie="token", key=key)
    return top.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "token"))), lambda e: e["token"]).alias("keywords")
    )
