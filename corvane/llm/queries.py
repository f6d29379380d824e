"""The registered queries of this subpackage, and their SQL where SQL can say the same."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import lines, mixing, near_duplicates, neighbours, pieces, prefix_trie, quality, repeats, sharding, token_counts, token_files, url_templates, whitening
from corvane.session import cut_lineage, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


CLASS_SQL = ", ".join(
    f"length(r{i}) - length(r{i + 1}) AS c{i}" for i in range(len(quality.CLASSES))
)
REST_SQL = " ".join(
    f", x{i + 1} AS (SELECT *, regexp_replace(r{i}, '{pattern.replace(chr(39), chr(39) * 2)}', '', 'g') AS r{i + 1} FROM x{i})"
    for i, pattern in enumerate(quality.CLASSES.values())
)
BINS = len(quality.KINDS)


def _half_sql(p: str, q: str) -> str:
    part = lambda x: f"CASE WHEN {x} > 0 THEN {x} * log2({x} / ((({p}) + ({q})) / 2)) ELSE 0 END"
    return f"(({part(f'({p})')}) + ({part(f'({q})')})) / 2"


@query(
    "op2_quality_divergence",
    f"""
    WITH x AS (
        SELECT doc_id, coalesce(lang, '') AS ref, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
    ), x0 AS (SELECT *, array_to_string(words, '') AS r0 FROM x) {REST_SQL}
    , tri AS (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM x)
    ), again AS (
        SELECT doc_id, count(DISTINCT i + k) AS n_repeat FROM tri, (VALUES (0), (1), (2)) AS t(k) WHERE n > 1 GROUP BY doc_id
    ), c AS (
        SELECT x{BINS - 1}.doc_id, ref, len(words) AS n_words, length(r0) AS chars, {CLASS_SQL}, length(r{BINS - 1}) AS c{BINS - 1}, coalesce(n_repeat, 0) AS n_repeat,
            list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
        FROM x{BINS - 1} LEFT JOIN again USING (doc_id)
    ), s AS (
        SELECT ref, sum(n_words) AS all_words, sum(chars) AS all_chars, {", ".join(f"sum(c{i}) AS s{i}" for i in range(BINS))} FROM c GROUP BY ref
    ), pool AS (
        SELECT sum(all_chars) AS t_chars, {", ".join(f"sum(s{i}) AS t{i}" for i in range(BINS))} FROM s
    ), tokens AS (
        SELECT doc_id, ref, lower(w) AS word FROM (SELECT doc_id, ref, unnest(words) AS w FROM x)
    ), top AS (
        SELECT ref, word, n FROM (SELECT ref, word, count(*) AS n, row_number() OVER (PARTITION BY ref ORDER BY count(*) DESC, word) AS place FROM tokens GROUP BY ref, word)
        WHERE place <= 48
    ), hits AS (
        SELECT doc_id, sum({_half_sql("p", "q")}) AS div, sum(p) AS hit, sum(own) AS mine, sum(n) AS met FROM (
            SELECT doc_id, own, n, own / n_words AS p, (n - own) / greatest(1, all_words - n_words) AS q
            FROM (SELECT doc_id, ref, word, t.n, count(*) AS own FROM tokens k JOIN top t USING (ref, word) GROUP BY ALL) JOIN (SELECT doc_id, n_words FROM c) USING (doc_id) JOIN s USING (ref)
        ) GROUP BY doc_id
    ), held AS (SELECT ref, sum(n) AS held FROM top GROUP BY ref
    ), sided AS (
        SELECT c.*, all_words - n_words >= 1000 AS enough, greatest(1, all_words - n_words) AS others, coalesce(held, 0) AS held, coalesce(div, 0) AS div, coalesce(hit, 0) AS hit,
            coalesce(mine, 0) AS mine, coalesce(met, 0) AS met,
            CASE WHEN all_words - n_words >= 1000 THEN all_chars ELSE t_chars END - chars AS other_chars,
            {", ".join(f"CASE WHEN all_words - n_words >= 1000 THEN s{i} ELSE t{i} END - c{i} AS o{i}" for i in range(BINS))}
        FROM c JOIN s USING (ref) LEFT JOIN held USING (ref) LEFT JOIN hits USING (doc_id) CROSS JOIN pool
    ), judged AS (
        SELECT *, CASE WHEN enough THEN sqrt(greatest(0, div + (held - met) / others / 2 + {_half_sql("greatest(0, 1 - hit)", "greatest(0, 1 - (held - mine) / others)")})) ELSE 0 END AS words_far,
            CASE WHEN chars >= 100 AND other_chars > 0 THEN sqrt(greatest(0, {" + ".join(_half_sql(f"c{i} / chars", f"o{i} / other_chars") for i in range(BINS))})) ELSE 0 END AS chars_far,
            n_words < 50 OR 100 * n_repeat > 50 * n_words AS base_failed
        FROM sided
    )
    SELECT doc_id, n_words::BIGINT AS n_words, chars::BIGINT AS word_chars, c6::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        n_repeat::BIGINT AS n_repeat_words, base_failed,
        NOT base_failed AND chars_far <= 0.34 AND (n_words < 80 OR words_far <= 0.31 + 0.9 / sqrt(greatest(1, n_words))) AS kept
    FROM judged
    """,
)
def op2_quality_divergence(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge_quality(table(spark, folder, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


# The level of the SQL is the first one, by size per weight, at which the next source is not yet full; later ones are lower.
@query(
    "op4_mix_sources",
    """
    WITH sized AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents
    ), sources AS (
        SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sized GROUP BY source
    ), weighed AS (
        SELECT source, source_size, CASE (place - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM sources
    ), ordered AS (
        SELECT *, 2 * source_size / weight AS ratio,
            coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight, weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
            sum(weight) OVER (ORDER BY 2 * source_size / weight, weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
            sum(source_size) OVER () AS total
        FROM weighed
    ), levels AS (
        SELECT (total * 150 / 100 - filled)::DOUBLE / open_weight::DOUBLE AS level, ratio FROM ordered
    ), level AS (
        SELECT max(level) AS level FROM levels WHERE level < ratio
    ), rates AS (
        SELECT source, source_size, least(2.0::DOUBLE * source_size, weight * coalesce((SELECT level FROM level), 'infinity'::DOUBLE)) AS target FROM weighed
    ), rated AS (
        SELECT s.doc_id, s.size, r.source_size, r.target,
            CASE WHEN r.source_size > 0 THEN r.target / r.source_size ELSE 0 END AS rate,
            ('0x' || substr(md5(coalesce(s.doc_id::VARCHAR, '') || ':4'), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS u
        FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source
    )
    SELECT doc_id, size, source_size, target, (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
    FROM rated
    """,
)
def op4_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix_sources(docs, F.size(mixing.words_of("text")))
    return mixed.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


@query("op10_shard_by_bytes")
def op10_shard_by_bytes(spark: SparkSession, folder: str) -> DataFrame:
    # what the digest needs of a text is computed before the exchange, so the texts themselves do not move
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, folder, "documents").select(
        "doc_id", "text", (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    placed = sharding.shard_by_bytes(docs, 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op3_near_duplicates")
def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


@query("op7_repeated_passages")
def op7_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeated_passages(table(spark, folder, "documents"), window=35)


@query("op8_fuzzy_lines")
def op8_fuzzy_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines.fuzzy_lines(table(spark, folder, "documents"), min_bytes=lines.WIDTH)


@query("op6_sampled_pieces")
def op6_sampled_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.sample_pieces(table(spark, folder, "documents"))


@query("op5_nearest_neighbours")
def op5_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return neighbours.nearest_neighbours(vectors, vectors.filter("vec_id % 100 = 0"))


URL_RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))


@query("op1_url_templates")
def op1_url_templates(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    # the number in a page's path is that of the document it shows
    shown = pages.withColumn("doc_id", F.expr("try_cast(regexp_extract(url, '/([0-9]+)', 1) AS bigint)"))
    labels = shown.join(table(spark, folder, "labels"), "doc_id").select("page_id", (F.col("quality") == 0).cast("int").alias("bad"))
    return url_templates.judge_urls(pages, labels, URL_RULES)


@query("op9_edited_token_counts")
def op9_edited_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Each document gets three edits, drawn by its id: parts of its own text take the place of others."""
    trees = token_counts.build_trees(table(spark, folder, "documents"))
    size = F.greatest(F.lit(1), F.length("text"))
    edits = F.transform(
        F.array(*[F.lit(i) for i in range(3)]),
        lambda i: F.struct(
            F.pmod(F.xxhash64("doc_id", i), size).cast("int").alias("at"),
            F.pmod(F.xxhash64("doc_id", i + 10), F.lit(30)).cast("int").alias("cut"),
            F.substring(F.col("text"), (F.pmod(F.xxhash64("doc_id", i + 20), size) + 1).cast("int"), F.pmod(F.xxhash64("doc_id", i + 30), F.lit(40)).cast("int")).alias("put"),
        ),
    )
    edited = token_counts.apply_edits(trees.withColumn("edits", edits))
    return edited.select(
        "doc_id", "tokens_before", "tokens_after", "leaves_before", "leaves_after", "encoded_leaves", F.crc32(F.col("text").cast("binary")).alias("text_crc32")
    )


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op11_range_coded_tokens")
def op11_range_coded_tokens(spark: SparkSession, folder: str) -> DataFrame:
    out = f"{shared_folder(spark).rstrip('/')}/token-ids-{uuid.uuid4().hex}"
    token_files.write_tokens(table(spark, folder, "documents"), out, tokenizer_path("word_bpe_49k.json"))
    read = token_files.read_tokens(spark, out)
    return read.select(F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op12_embedding_whitening")
def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = cut_lineage(whitening.quantize(table(spark, folder, "embeddings"), "vec_id", "embedding", 64, 1_000_000))
    fit = whitening.fit_whitening(rows, 16)
    if fit is None:
        return spark.createDataFrame([], "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    return whitening.whiten(rows, fit).withColumnRenamed("key", "vec_id")


@query("op13_prefix_trie")
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    convs = prefix_trie.conversations(table(spark, folder, "conversations"))
    return prefix_trie.conversation_trie(prefix_trie.share_openings(convs))
