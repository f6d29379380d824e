"""Knowledge graph: extraction, co-occurrence, building, merging, resolving, paths, ranking for a query.

A graph is a pair of tables: vertices ``(name, …)`` and undirected edges ``(src, dst, weight, …)`` with ``src <= dst``.
Where an entity or edge comes from is kept in long tables, one row per source, never in growing lists.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions import text as tx
from corvane.operators import aggregates, ordering, scans, sets

# Separators of the extraction and decision formats.
RECORD_SEPARATOR, FIELD_SEPARATOR = "##", "<|>"
DESCRIPTION_SEPARATOR = "<SEP>"


def _records(responses: DataFrame, key: str, response: str) -> DataFrame:
    inner = F.regexp_extract(F.trim("record"), r"(?s)\((.*)\)", 1)
    fields = F.transform(F.split(inner, r"<\|>"), lambda f: F.trim(f))
    return (
        responses.select(key, F.explode(F.split(response, "##|" + r"<\|COMPLETE\|>")).alias("record"))
        .withColumn("fields", F.filter(fields, lambda f: f != ""))
        .drop("record")
    )


def parse_extractions(
    responses: DataFrame, types: Sequence[str] | None = None, key: str = "chunk_id", response: str = "response"
) -> tuple[DataFrame, DataFrame]:
    """Entity and relation rows of delimited model output.

    An entity record has at least four fields, a relation at least five; names are upper-cased and cleaned, relation
    ends sorted, and a numeric last field is the weight (else 1).
    """
    records = _records(responses, key, response)
    field = lambda n: F.get("fields", F.lit(n))
    upper = lambda n: F.upper(tx.clean_name(F.upper(field(n))))
    entities = (
        records.filter((F.size("fields") >= 4) & (field(0) == '"entity"'))
        .select(upper(1).alias("name"), upper(2).alias("type"), tx.clean_name(field(3)).alias("description"), F.col(key).alias("source_id"))
        .filter(F.trim("name") != "")
    )
    if types is not None:
        entities = entities.filter(F.col("type").isin(*[t.upper() for t in types]))
    last = F.element_at("fields", -1)
    weight = F.when(last.rlike(r"^[-+]?[0-9]*\.?[0-9]+$"), last.try_cast("double")).otherwise(1.0)
    relations = records.filter((F.size("fields") >= 5) & (field(0) == '"relationship"')).select(
        F.least(upper(1), upper(2)).alias("src"),
        F.greatest(upper(1), upper(2)).alias("dst"),
        weight.alias("weight"),
        tx.clean_name(field(3)).alias("description"),
        tx.clean_name(field(4)).alias("keywords"),
        F.col(key).alias("source_id"),
    )
    return entities, relations


def mentions(chunks: DataFrame, key: str = "chunk_id", text: str = "content", pattern: str = r"\p{Lu}\p{L}{3,}") -> DataFrame:
    """Rule-based entity mentions ``(key, name, sentence, occurrences)``: capitalised words, placed in their first sentence.

    ``occurrences`` counts the name anywhere in the text, without regard to case.
    """
    upper = F.upper(F.col(text))
    named = lambda s, i: F.transform(
        F.regexp_extract_all(s, F.lit(pattern), F.lit(0)), lambda n: F.struct(F.upper(n).alias("name"), i.alias("sentence"))
    )
    found = chunks.select(key, upper.alias("_upper"), F.flatten(F.transform(F.split(text, tx.SENTENCE_END), named)).alias("_found"))
    found = found.select(key, "_upper", F.col("_found.name").alias("_names"), F.col("_found.sentence").alias("_at"))
    gone = F.length(F.replace("_upper", F.col("name"), F.lit("")))
    counted = found.select("*", F.explode(F.array_distinct("_names")).alias("name")).select(  # a text stays in its row
        key,
        "name",
        F.get("_at", (F.array_position("_names", F.col("name")) - 1).cast("int")).alias("sentence"),
        ((F.length("_upper") - gone) / F.length("name")).cast("bigint").alias("occurrences"),
    )
    return counted.repartition(key).groupBy(key, "name").agg(F.min("sentence").alias("sentence"), F.first("occurrences").alias("occurrences"))


def cooccurrence(mention_rows: DataFrame, distance: int = 0, key: str = "chunk_id", fixed_weight: float | None = 1.0) -> DataFrame:
    """Entity pairs of the same or nearby sentences, once per chunk: ``(key, src, dst, weight)``.

    One side is spread over the sentences it reaches, and the names that meet in a sentence are put together in a row,
    which gives its pairs. Rows are placed by ``key`` for all of it, as :func:`mentions` places them. Without a fixed
    weight a pair weighs the sum of its ends' shares of all occurrences in the chunk, at least 0.01.
    """
    total = F.sum("occurrences").over(Window.partitionBy(key))
    shares = mention_rows.filter(F.col(key).isNotNull()).select(
        key, "name", "sentence", F.when(total > 0, F.col("occurrences") / total).otherwise(0.0).alias("share")
    )
    reach = F.sequence(F.lit(-distance), F.lit(distance))
    met = shares.select(key, "name", "share", "sentence", F.explode(reach).alias("_off")).groupBy(
        key, (F.col("sentence") + F.col("_off")).alias("_meet")
    ).agg(F.collect_list(F.struct("name", "share", (F.col("_off") == 0).alias("own"))).alias("_names"))
    ends = met.filter(F.size("_names") > 1).select(key, "_names", F.explode("_names").alias("_a")).filter("_a.own")
    pairs = ends.select(key, "_a", F.explode("_names").alias("_b")).filter("_a.name < _b.name")
    weight = F.lit(fixed_weight) if fixed_weight is not None else F.greatest(F.col("_a.share") + F.col("_b.share"), F.lit(0.01))
    return pairs.select(key, F.col("_a.name").alias("src"), F.col("_b.name").alias("dst"), weight.alias("weight"))


def cooccurrence_edges(pairs: DataFrame) -> DataFrame:
    """Chunk pairs added up to graph edges."""
    return pairs.groupBy("src", "dst").agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("chunks"))


def keep_linked(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Edges whose both ends are vertices."""
    names = vertices.select("name").distinct()
    return edges.join(names.withColumnRenamed("name", "src"), "src", "left_semi").join(
        names.withColumnRenamed("name", "dst"), "dst", "left_semi"
    )


edges_between = keep_linked


def build_graph(entities: DataFrame, relations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merged entity and relation mentions; relations that miss an end are dropped."""
    return aggregates.merge_entity_mentions(entities), aggregates.merge_relation_mentions(keep_linked(relations, entities))


def merge_graphs(
    first: tuple[DataFrame, DataFrame], second: tuple[DataFrame, DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """Second graph merged into the first: descriptions and lists appended, weights added, touched rows ``changed``.

    Both hold one row per vertex ``(name, type, description)`` and per edge ``(src, dst, weight, description)``; array
    columns that both have, such as ``keywords`` and ``source_ids``, are put one after the other.
    """
    stacked = lambda i: first[i].withColumn("_g", F.lit(0)).unionByName(second[i].withColumn("_g", F.lit(1)))
    in_order = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("_g", c))), lambda e: e[c])
    text = F.array_join(in_order("description"), DESCRIPTION_SEPARATOR).alias("description")
    changed = (F.max("_g") == 1).alias("changed")

    def lists(i: int) -> list[Column]:
        both = [c for c, t in first[i].dtypes if t.startswith("array") and dict(second[i].dtypes).get(c) == t]
        return [F.flatten(in_order(c)).alias(c) for c in both]

    vertices = stacked(0).groupBy("name").agg(F.min_by("type", "_g").alias("type"), text, changed, *lists(0))
    edges = stacked(1).groupBy("src", "dst").agg(F.sum("weight").alias("weight"), text, changed, *lists(1))
    return vertices, edges


def degree(edges: DataFrame) -> DataFrame:
    """Edge ends per vertex; a self-loop counts two."""
    return edges.select(F.explode(F.array("src", "dst")).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("rank"))


def tidy_graph(vertices: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices and edges that have a description and a source; edges keep only kept ends."""
    ok = F.col("description").isNotNull() & F.col("source_id").isNotNull()
    kept = vertices.filter(ok)
    return kept, keep_linked(edges.filter(ok), kept)


def normalize_names(vertices: DataFrame) -> DataFrame:
    """Upper-case, trimmed and unescaped names."""
    return vertices.withColumn("name", F.upper(F.trim(tx.unescape_html("name"))))


def mask_subgraph(vertex_sources: DataFrame, edge_sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Subgraph of every source ``(source_id, name)`` and ``(source_id, src, dst)``.

    An edge belongs to each source that both of its ends carry.
    """
    vertices = vertex_sources.select("source_id", "name").distinct()
    ends = edge_sources.select("src", "dst").distinct()
    edges = ends.join(vertices.select("source_id", F.col("name").alias("src")), "src").join(
        vertices.select("source_id", F.col("name").alias("dst")), ["source_id", "dst"]
    )
    return vertices, edges.select("source_id", "src", "dst")


def rebuild_graph(entities: DataFrame, relations: DataFrame, excluded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Graph of the mention rows whose source is not excluded."""
    rest = lambda df: df.join(excluded.select("source_id").distinct(), "source_id", "left_anti")
    return build_graph(rest(entities), rest(relations))


def digit_grams(name: Column) -> Column:
    """The 2-grams of a name that hold a digit, as one text; similar names must agree on it."""
    return F.array_join(F.array_sort(F.filter(sets.bigram_set(name), lambda g: g.rlike("[0-9]"))), "|")


def _characters(name: Column) -> Column:
    return F.regexp_extract_all(name, F.lit("(?s)."), F.lit(0))


def _numbered(chars: Column) -> Column:
    """Characters numbered by repetition, so that common elements count as in a multiset."""
    seen = lambda i: F.size(F.filter(F.slice(chars, F.lit(1), i), lambda c: c == F.element_at(chars, i)))
    return F.transform(F.sequence(F.lit(1), F.size(chars)), lambda i: F.concat(F.element_at(chars, i), seen(i).cast("string")))


def similar_names(a: Column, b: Column) -> Column:
    """Edit distance of at most half the shorter name for English pairs, else shared characters."""
    half = F.floor(F.least(F.length(a), F.length(b)) / 2).cast("int")
    english = tx.is_english(a) & tx.is_english(b)
    x, y = F.array_distinct(_characters(a)), F.array_distinct(_characters(b))
    common, most = F.size(F.array_intersect(x, y)), F.greatest(F.size(x), F.size(y))
    return F.when(english, F.levenshtein(a, b) <= half).when(most < 4, common > 1).otherwise(common / most >= 0.8)


def candidate_pairs(vertices: DataFrame, new_names: DataFrame | None = None) -> DataFrame:
    """Pairs of similar names ``(type, a, b)`` within a type, at least one of them new.

    Names meet on exact blocking keys, never as all pairs of a type. The digit 2-grams must agree. English pairs share
    at least the longer length less half the shorter of their characters, other pairs four fifths of their distinct
    characters (two when there are fewer than four). So with one order of characters, rare ones first, two similar
    names share a character within a short leading part of each, and names are keyed by that part only.
    """
    named = vertices.select("type", "name").distinct().withColumns(
        {"digits": digit_grams(F.col("name")), "english": tx.is_english("name"), "chars": _characters(F.col("name"))}
    )
    elements = lambda rule, column: F.transform(column, lambda c: F.struct(F.lit(rule).alias("rule"), c.alias("c")))
    whole = F.when(F.col("english"), elements("all", _numbered(F.col("chars")))).otherwise(
        F.array().cast("array<struct<rule:string,c:string>>")
    )
    keyed = named.select(
        "type", "name", "digits", "english", F.explode(F.concat(whole, elements("distinct", F.array_distinct("chars")))).alias("e")
    ).select("type", "name", "digits", "english", "e.rule", "e.c")
    rarity = keyed.groupBy("rule", "c").agg(F.count(F.lit(1)).alias("_df"))
    of_name = Window.partitionBy("type", "name", "rule")
    size = F.count(F.lit(1)).over(of_name)
    lead = (
        F.when(F.col("rule") == "all", F.floor(F.col("_size") / 2) + 1)
        .when(F.col("_size") < 4, F.col("_size") - 1)
        .otherwise(F.floor(F.col("_size") / 5) + 1)
    )
    prefix = (
        keyed.join(rarity, ["rule", "c"])
        .withColumns({"_place": F.row_number().over(of_name.orderBy("_df", "c")), "_size": size})
        .filter(F.col("_place") <= lead)
        .select("type", "digits", "rule", "c", "name", "english")
    )
    right = prefix.withColumnsRenamed({"name": "b", "english": "_eb"})
    pairs = (
        prefix.withColumnsRenamed({"name": "a", "english": "_ea"})
        .join(right, ["type", "digits", "rule", "c"])
        .filter((F.col("a") < F.col("b")) & ((F.col("rule") == "all") | ~(F.col("_ea") & F.col("_eb"))))
        .select("type", "a", "b")
        .distinct()
        .filter(similar_names(F.col("a"), F.col("b")))
    )
    if new_names is None:
        return pairs
    fresh = new_names.select(F.col("name"), F.lit(1).alias("_new")).distinct()
    return (
        pairs.join(fresh.withColumnsRenamed({"name": "a", "_new": "_x"}), "a", "left")
        .join(fresh.withColumnsRenamed({"name": "b", "_new": "_y"}), "b", "left")
        .filter("_x IS NOT NULL OR _y IS NOT NULL")
        .select("type", "a", "b")
    )


def parse_decisions(responses: DataFrame, limit: str = "n", key: str = "batch_id", response: str = "response") -> DataFrame:
    """Question numbers a model answered with yes: records ``<|>number<|> … &&yes&&``, numbers up to the batch size."""
    records = responses.select(key, limit, F.explode(F.split(response, "##")).alias("record"))
    number = F.regexp_extract("record", r"<\|>(\d+)<\|>", 1).try_cast("int")
    answer = F.lower(F.regexp_extract("record", "&&([a-zA-Z]+)&&", 1))
    return (
        records.select(key, limit, number.alias("question"), answer.alias("answer"))
        .filter((F.col("question") > 0) & (F.col("question") <= F.col(limit)) & (F.col("answer") == "yes"))
        .select(key, "question")
    )


def contract_nodes(vertices: DataFrame, edges: DataFrame, components: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merge the vertices of each component into the one of smallest name.

    ``components(name, component)``. Edges are re-pointed, inner edges dropped and parallel edges merged:
    weights are added, and descriptions, keywords and source ids united where the edges have them.
    """
    target = components.withColumnRenamed("component", "_to")
    onto = lambda df, c: (
        df.join(target.withColumnRenamed("name", c), c, "left").withColumn(c, F.coalesce("_to", c)).drop("_to")
    )
    moved = onto(onto(edges, "src"), "dst").filter("src <> dst")
    pairs, ends = aggregates.unordered(moved), ["src", "dst"]
    merged_edges = pairs.groupBy(*ends).agg(F.sum("weight").alias("weight"))
    for column, separator in (("description", DESCRIPTION_SEPARATOR), ("keywords", ",")):
        if column in edges.columns:
            merged_edges = merged_edges.join(aggregates.joined_text(pairs, ends, column, separator), ends, "left")
    if "source_ids" in edges.columns:
        sources = pairs.select(*ends, F.explode("source_ids").alias("source_id"))
        merged_edges = merged_edges.join(aggregates.source_lists(sources, ends), ends, "left")
    renamed = onto(vertices.withColumn("_old", F.col("name")), "name")
    types = renamed.groupBy("name").agg(
        F.min_by("type", F.struct((F.col("_old") != F.col("name")).alias("moved"), F.col("_old"))).alias("type"),
        F.count(F.lit(1)).alias("members"),
    )
    texts = aggregates.joined_text(renamed, ["name"], "description", DESCRIPTION_SEPARATOR)
    return types.join(texts, "name", "left"), merged_edges


def both_ways(edges: DataFrame) -> DataFrame:
    """Each undirected edge as two directed ones; a self-loop as one."""
    return edges.select("src", "dst", "weight").unionByName(
        edges.filter("src <> dst").select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    )


def nhop_paths(edges: DataFrame, hops: int = 2) -> DataFrame:
    """Paths of up to ``hops`` edges from every vertex with the weight of each step ``(path, weights)``.

    A path that returned to one of its vertices stops, an edge is not used twice in either direction, and a path that
    cannot go on stays short.
    """
    steps = both_ways(edges)
    paths = steps.select(F.array("src", "dst").alias("path"), F.array(F.col("weight").cast("double")).alias("weights"))
    onward = steps.select(F.col("src").alias("_last"), F.col("dst").alias("_next"), F.col("weight").cast("double").alias("_weight"))
    for _ in range(hops - 1):
        last = F.element_at("path", -1)
        closed = F.array_contains(F.slice("path", F.lit(1), F.size("path") - 1), last)
        used = lambda a, b: F.exists(
            F.sequence(F.lit(1), F.size("path") - 1),
            lambda i: (F.element_at("path", i) == a) & (F.element_at("path", i + 1) == b),
        )
        open_ = paths.filter(~closed).withColumn("_last", last)
        longer = (
            open_.join(onward, "_last")
            .filter(~used(F.col("_last"), F.col("_next")) & ~used(F.col("_next"), F.col("_last")))
            .select(F.col("path").alias("_from"), F.array_append("path", F.col("_next")).alias("path"), F.array_append("weights", F.col("_weight")).alias("weights"))
        )
        stuck = open_.drop("_last").join(longer.select(F.col("_from").alias("path")).distinct(), "path", "left_anti")
        paths = paths.filter(closed).unionByName(stuck).unionByName(longer.drop("_from"))
    return paths


def path_scores(query_entities: DataFrame, paths: DataFrame, strict: bool = False) -> DataFrame:
    """Score of each edge on the paths of a query's entities: step i adds ``sim / (2 + i)``; also the edge weight.

    ``query_entities(query_id, name, sim)``. Edges are unordered unless ``strict``, which keeps the walking direction.
    """
    walked = paths.select(F.element_at("path", 1).alias("name"), "path", "weights")
    steps = query_entities.join(walked, "name").select(
        "query_id", "sim", "path", F.posexplode("weights").alias("step", "weight")
    )
    src, dst = F.element_at("path", F.col("step") + 1), F.element_at("path", F.col("step") + 2)
    ends = (src, dst) if strict else (F.least(src, dst), F.greatest(src, dst))
    return steps.groupBy("query_id", ends[0].alias("src"), ends[1].alias("dst")).agg(
        F.sum(F.col("sim") / (F.col("step") + 2)).alias("path_sim"), F.max("weight").alias("path_weight")
    )


def graph_rank(
    entities: DataFrame, type_hits: DataFrame, relations: DataFrame, paths: DataFrame, top_entities: int = 6, top_relations: int = 6
) -> tuple[DataFrame, DataFrame]:
    """Best entities and relations of each query by similarity times rank.

    ``entities(query_id, name, sim, pagerank)``, ``type_hits(query_id, name)``, ``relations(query_id, src, dst, sim,
    pagerank)``, ``paths`` from ``path_scores``. A type hit doubles an entity; a relation is multiplied by one plus its
    path score plus its type hits; relations found on paths only start from their path score.
    """
    hit = type_hits.select("query_id", "name", F.lit(1).alias("_hit")).distinct()
    boosted = entities.join(hit, ["query_id", "name"], "left").withColumn(
        "score", F.col("sim") * F.when(F.col("_hit") == 1, 2).otherwise(1) * F.col("pagerank")
    )
    best_entities = ordering.topk_per_query(boosted.drop("_hit"), top_entities, tie="name")
    both = relations.join(paths, ["query_id", "src", "dst"], "full")
    for end in ("src", "dst"):
        both = both.join(hit.withColumnsRenamed({"name": end, "_hit": f"_{end}"}), ["query_id", end], "left")
    types = F.coalesce("_src", F.lit(0)) + F.coalesce("_dst", F.lit(0))
    sim = F.when(F.col("sim").isNotNull(), F.col("sim") * (F.coalesce("path_sim", F.lit(0.0)) + types + 1)).otherwise(
        F.col("path_sim") * (types + 1)
    )
    scored = both.withColumn("score", sim * F.coalesce("pagerank", "path_weight")).withColumn(
        "relation", F.concat_ws("→", "src", "dst")
    )
    best_relations = ordering.topk_per_query(scored.select("query_id", "src", "dst", "relation", "score"), top_relations, tie="relation")
    return best_entities, best_relations.drop("relation")


def graph_view(vertices: DataFrame, edges: DataFrame, top_vertices: int = 256, top_edges: int = 128) -> DataFrame:
    """Strongest edges between the highest ranked vertices, without self-loops."""
    best = vertices.orderBy(F.round("pagerank", 9).desc(), "name").limit(top_vertices)
    inner = keep_linked(edges.filter("src <> dst"), best)
    return inner.orderBy(F.col("weight").desc(), "src", "dst").limit(top_edges)


def community_weights(members: DataFrame, vertices: DataFrame) -> DataFrame:
    """Weight of each community: sum of rank times weight of its members, as a share of the level's largest."""
    sums = (
        members.join(vertices.select("name", "rank", "weight"), "name")
        .groupBy("level", "community")
        .agg(F.sum(F.col("rank") * F.col("weight")).alias("_sum"), F.count(F.lit(1)).alias("size"))
    )
    top = sums.groupBy("level").agg(F.max("_sum").alias("_top"))
    return sums.join(top, "level").select(
        "level", "community", "size", F.when(F.col("_top") == 0, 0.0).otherwise(F.col("_sum") / F.col("_top")).alias("weight")
    )


def community_tables(members: DataFrame, edges: DataFrame, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Entities and inner relations of every community with at least two members.

    Relations are ranked by weight; with ``limit`` only so many of the heaviest are listed. ``members(community, name)``.
    """
    sizes = members.groupBy("community").agg(F.count(F.lit(1)).alias("size")).filter("size >= 2")
    kept = members.join(sizes, "community")
    end = lambda c: kept.select("community", F.col("name").alias(c))
    inner = edges.join(end("src"), "src").join(end("dst"), ["community", "dst"])
    order = [F.col("weight").desc(), F.col("src"), F.col("dst")]
    if limit is None:
        return kept, scans.ranked(inner, ["community"], order, "place")
    place = F.row_number().over(Window.partitionBy("community").orderBy(*order))
    return kept, inner.withColumn("place", place).filter(F.col("place") <= limit)


def parse_reports(responses: DataFrame, key: str = "community", response: str = "response") -> DataFrame:
    """Community reports out of JSON model output: valid ones only, with the text and the joined findings."""
    schema = "title string, summary string, findings array<struct<summary:string,explanation:string>>, rating double, rating_explanation string"
    report = F.from_json(F.regexp_extract(response, r"(?s)(\{.*\})", 1), schema)
    parsed = responses.select(key, report.alias("r")).select(key, "r.*")
    complete = parsed.filter(
        "title IS NOT NULL AND summary IS NOT NULL AND findings IS NOT NULL AND rating IS NOT NULL AND rating_explanation IS NOT NULL"
    )
    section = lambda f: F.concat(F.lit("## "), f["summary"], F.lit("\n\n"), f["explanation"])
    return complete.select(
        key,
        "title",
        "rating",
        F.concat(F.lit("# "), "title", F.lit("\n\n"), "summary", F.lit("\n\n"), F.array_join(F.transform("findings", section), "\n\n")).alias("report"),
        F.array_join(F.transform("findings", lambda f: f["explanation"]), "\n").alias("evidence"),
    )


def community_lookup(wanted: DataFrame, members: DataFrame, weights: DataFrame, topn: int = 1) -> DataFrame:
    """Reports of communities that hold any of a query's entities, heaviest first. ``wanted(query_id, name)``."""
    hits = wanted.join(members, "name").select("query_id", "community").distinct()
    return ordering.topk_per_query(hits.join(weights, "community"), topn, score="weight", tie="community")


def entity_rows(vertices: DataFrame, paths: DataFrame | None = None) -> DataFrame:
    """Vertices as searchable rows: key, type, a JSON text, and with ``paths(path, weights)`` those that start there.

    ``paths`` is then a JSON list in order of the path, null for a vertex that starts none.
    """
    body = F.to_json(F.struct("name", "type", "description", "rank"))
    rows = vertices.select(tx.stable_id(F.lit("entity"), F.col("name")).alias("row_id"), "name", "type", body.alias("content"))
    if paths is None:
        return rows
    entry = F.struct("path", "weights")
    listed = F.to_json(F.transform(F.array_sort(F.collect_list(F.struct(F.array_join("path", ">").alias("k"), entry.alias("e")))), lambda x: x["e"]))
    return rows.join(paths.groupBy(F.get("path", F.lit(0)).alias("name")).agg(listed.alias("paths")), "name", "left")


def relations_by_vector(queries: DataFrame, relations: DataFrame, topn: int, min_sim: float) -> DataFrame:
    """Relations nearest to each question's vector ``(query_id, src, dst, score, rank)``; ``relations(src, dst, embedding)``."""
    from corvane.operators.retrieval import vector_match

    named = relations.select(F.concat_ws("\u0001", "src", "dst").alias("chunk_id"), "src", "dst", "embedding")
    found = vector_match(queries, named.select("chunk_id", "embedding"), topn, min_sim)
    return found.join(named.select("chunk_id", "src", "dst"), "chunk_id").select("query_id", "src", "dst", "score", "rank")


def relation_rows(edges: DataFrame) -> DataFrame:
    """Edges as searchable rows: key, ends, weight, a JSON text."""
    body = F.to_json(F.struct("src", "dst", "description", "weight"))
    return edges.select(
        tx.stable_id(F.lit("relation"), F.col("src"), F.col("dst")).alias("row_id"), "src", "dst", F.col("weight").cast("bigint").alias("weight"), body.alias("content")
    )
