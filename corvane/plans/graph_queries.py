"""Knowledge-graph queries (G ids, J9–J13, W9, U6, L7) over the trade, supply and text graphs of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import text as tx
from corvane.functions import scalars as sc
from corvane.operators import aggregates, graph, graph_algorithms, ordering, retrieval, scans
from corvane.plans import inputs as inp
from corvane.plans.aggregate_queries import trade_mentions
from corvane.plans.registry import query, table
from corvane.session import cut_lineage

TRADE_SQL = """trade_lines AS (
  SELECT p_brand AS src, n_name AS dst, l_quantity AS weight, l_returnflag AS description, l_linestatus AS keywords, l_shipdate AS s, n_regionkey
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN part ON p_partkey = l_partkey),
trade AS (SELECT src, dst, count(*) AS weight FROM trade_lines GROUP BY src, dst),
directed AS (SELECT src, dst, weight FROM trade UNION ALL SELECT dst, src, weight FROM trade),
names AS (SELECT p_brand AS name, 'BRAND' AS type FROM part GROUP BY p_brand UNION ALL SELECT n_name, 'NATION' FROM nation)"""


def trade_edges(spark, folder):
    """Brand – nation edges weighted by line items."""
    return trade_mentions(spark, folder).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight"))


def trade_vertices(spark, folder):
    brands = table(spark, folder, "part").select(F.col("p_brand").alias("name"), F.lit("BRAND").alias("type")).distinct()
    return brands.unionByName(table(spark, folder, "nation").select(F.col("n_name").alias("name"), F.lit("NATION").alias("type")))


def supply_edges(spark, folder):
    """Part – supplier edges weighted by line items."""
    return table(spark, folder, "lineitem").groupBy(
        F.concat(F.lit("P"), "l_partkey").alias("src"), F.concat(F.lit("S"), "l_suppkey").alias("dst")
    ).agg(F.count(F.lit(1)).alias("weight"))


def supply_vertices(edges):
    return edges.select(F.explode(F.array("src", "dst")).alias("name")).distinct()


@query(
    "g1_parse_extractions",
    """
SELECT 'entity' AS kind, upper(p_name) AS a, upper(p_type) AS b, p_brand AS description, 0.0::DOUBLE AS weight, p_partkey AS source_id FROM part WHERE p_type IN ('ECONOMY', 'SMALL')
UNION ALL SELECT 'relation', least(upper(p_name), upper(p_brand)), greatest(upper(p_name), upper(p_brand)), 'made by', CASE WHEN p_size % 2 = 0 THEN p_size ELSE 1 END, p_partkey FROM part
""",
)
def g1_parse_extractions(spark, folder):
    q = F.lit
    record = F.concat(
        q('("entity"<|>'), "p_name", q("<|>"), "p_type", q("<|>"), "p_brand", q(')##("relationship"<|>'), "p_name", q("<|>"), "p_brand",
        q("<|>made by<|>brand<|>"), F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("string")).otherwise("often"), q(")<|COMPLETE|>"),
    )
    responses = table(spark, folder, "part").select(F.col("p_partkey").alias("chunk_id"), record.alias("response"))
    entities, relations = graph.parse_extractions(responses, ["economy", "small"])
    return entities.select(
        F.lit("entity").alias("kind"), F.col("name").alias("a"), F.col("type").alias("b"), "description", F.lit(0.0).alias("weight"), "source_id"
    ).unionByName(
        relations.select(F.lit("relation").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), "description", "weight", "source_id")
    )


MENTIONS_SQL = rf"""sent AS (
  SELECT chunk_id, replace(upper(content), 'ẞ', 'SS') AS u, unnest(regexp_split_to_array(content, '[.!?;\n]+')) AS s, generate_subscripts(regexp_split_to_array(content, '[.!?;\n]+'), 1) - 1 AS sentence FROM chunks),
found AS (SELECT chunk_id, u, sentence, replace(upper(unnest(regexp_extract_all(s, '\p{{Lu}}\p{{L}}{{3,}}'))), 'ẞ', 'SS') AS name FROM sent),
ment AS (SELECT chunk_id, name, min(sentence) AS sentence, CAST((length(first(u)) - length(replace(first(u), name, ''))) / length(name) AS BIGINT) AS occurrences FROM found GROUP BY chunk_id, name)"""


@query("g2_mentions", f"WITH {inp.CHUNKS_SQL}, {MENTIONS_SQL} SELECT chunk_id, name, CAST(sentence AS BIGINT) AS sentence, occurrences FROM ment")
def g2_mentions(spark, folder):
    return graph.mentions(inp.chunks(spark, folder))


@query(
    "w9_cooccurrence",
    f"""
WITH {inp.CHUNKS_SQL}, {MENTIONS_SQL}
SELECT a.chunk_id, a.name AS src, b.name AS dst, 1.0::DOUBLE AS weight FROM ment a JOIN ment b ON a.chunk_id = b.chunk_id AND a.name < b.name AND abs(a.sentence - b.sentence) <= 1
""",
)
def w9_cooccurrence(spark, folder):
    return graph.cooccurrence(graph.mentions(inp.chunks(spark, folder)), distance=1)


@query(
    "g3_cooccurrence_edges",
    f"""
WITH {inp.CHUNKS_SQL}, {MENTIONS_SQL},
tot AS (SELECT chunk_id, sum(occurrences) AS total FROM ment GROUP BY chunk_id)
SELECT a.name AS src, b.name AS dst, round(sum(greatest((a.occurrences + b.occurrences) / total, 0.01)), 6) AS weight, count(*) AS chunks
FROM ment a JOIN ment b ON a.chunk_id = b.chunk_id AND a.name < b.name AND a.sentence = b.sentence JOIN tot ON tot.chunk_id = a.chunk_id GROUP BY ALL
""",
)
def g3_cooccurrence_edges(spark, folder):
    pairs = graph.cooccurrence(graph.mentions(inp.chunks(spark, folder)), fixed_weight=None)
    return graph.cooccurrence_edges(pairs)


def near_vertices(spark, folder):
    """Brands, and the nations of the first three regions."""
    near = table(spark, folder, "nation").filter("n_regionkey < 3").select(F.col("n_name").alias("name"))
    return trade_vertices(spark, folder).join(near.unionByName(table(spark, folder, "part").select(F.col("p_brand").alias("name"))).distinct(), "name", "left_semi")


@query(
    "g4_build_graph",
    f"""
WITH {TRADE_SQL}
SELECT src, dst, sum(weight) AS weight, count(DISTINCT s) AS sources, string_agg(DISTINCT description, '<SEP>' ORDER BY description) AS description FROM trade_lines WHERE n_regionkey < 3 GROUP BY src, dst
""",
)
def g4_build_graph(spark, folder):
    entities = near_vertices(spark, folder).withColumns({"description": F.col("type"), "source_id": F.col("name")})
    _, edges = graph.build_graph(entities, trade_mentions(spark, folder))
    return edges.select("src", "dst", "weight", "sources", "description")


@query("j9_edges_between", f"WITH {TRADE_SQL} SELECT src, dst, count(*) AS weight FROM trade_lines WHERE n_regionkey < 3 GROUP BY src, dst")
def j9_edges_between(spark, folder):
    return graph.edges_between(trade_edges(spark, folder), near_vertices(spark, folder))


def _flag_graph(spark, folder, flag):
    mentions = trade_mentions(spark, folder).filter(F.col("description") == flag)
    edges = mentions.groupBy("src", "dst").agg(F.sum("weight").alias("weight"), F.lit(flag).alias("description"))
    ends = mentions.select(F.explode(F.array("src", "dst")).alias("name")).distinct()
    return ends.select("name", F.lit("X").alias("type"), F.lit(flag).alias("description")), edges


@query(
    "g5_merge_graphs",
    f"""
WITH {TRADE_SQL}
SELECT src, dst, sum(weight) AS weight, string_agg(DISTINCT description, '<SEP>' ORDER BY description) AS description, bool_or(description = 'N') AS changed
FROM trade_lines WHERE description IN ('A', 'N') GROUP BY src, dst
""",
)
def g5_merge_graphs(spark, folder):
    _, edges = graph.merge_graphs(_flag_graph(spark, folder, "A"), _flag_graph(spark, folder, "N"))
    return edges


@query(
    "g6_degree",
    "SELECT name, count(*) AS rank FROM (SELECT 'P' || l_partkey AS name FROM lineitem GROUP BY l_partkey, l_suppkey UNION ALL SELECT 'S' || l_suppkey FROM lineitem GROUP BY l_partkey, l_suppkey) GROUP BY name",
)
def g6_degree(spark, folder):
    return graph.degree(supply_edges(spark, folder))


@query(
    "g7_tidy_graph",
    f"WITH {TRADE_SQL} SELECT src, dst, count(*) AS weight FROM trade_lines WHERE n_regionkey < 3 GROUP BY src, dst HAVING count(*) % 2 = 0",
)
def g7_tidy_graph(spark, folder):
    near = near_vertices(spark, folder).select("name", F.lit("d").alias("description"))
    vertices = trade_vertices(spark, folder).select("name").join(near, "name", "left").withColumn("source_id", F.lit("s"))
    edges = trade_edges(spark, folder).withColumns(
        {"description": F.when(F.col("weight") % 2 == 0, "even"), "source_id": F.lit("s")}
    )
    return graph.tidy_graph(vertices, edges)[1].select("src", "dst", "weight")


@query(
    "g8_pagerank",
    f"""
WITH RECURSIVE {TRADE_SQL},
strength AS (SELECT src, sum(weight) AS o FROM directed GROUP BY src),
link AS (SELECT d.src, d.dst, weight / o AS share FROM directed d JOIN strength USING (src)),
pr AS (
  SELECT name, CAST(1.0 / (SELECT count(*) FROM names) AS DOUBLE) AS r, 0 AS step FROM names
  UNION ALL
  SELECT l.dst, 0.85 * sum(pr.r * l.share) + 0.15 / (SELECT count(*) FROM names), max(step) + 1 FROM pr JOIN link l ON l.src = pr.name WHERE step < 60 GROUP BY l.dst)
SELECT name, round(r, 6) AS pagerank FROM pr WHERE step = 60
""",
)
def g8_pagerank(spark, folder):
    return graph_algorithms.pagerank(trade_vertices(spark, folder), trade_edges(spark, folder), tolerance=1e-11)


@query("g8_pagerank_supply")
def g8_pagerank_supply(spark, folder):
    edges = cut_lineage(supply_edges(spark, folder))
    return graph_algorithms.pagerank(supply_vertices(edges), edges)


NAMES_SQL = r"""pn AS (SELECT DISTINCT p_type AS type, p_name || ' ' || p_brand AS name FROM part),
gram AS (SELECT type, name, list_sort(list_distinct(list_filter(list_transform(range(1, length(name)), lambda i: substr(name, i, 2)), lambda g: regexp_matches(g, '[0-9]')))) AS digits,
  len(regexp_extract_all(name, '[`a-zA-Z0-9.,'':;/"?<>!()\-]')) / CAST(length(name) AS DOUBLE) > 0.8 AS english,
  list_distinct(string_split(name, '')) AS letters FROM pn),
cand AS (SELECT a.type, a.name AS a, b.name AS b FROM gram a JOIN gram b ON a.type = b.type AND a.name < b.name AND a.digits = b.digits
  WHERE CASE WHEN a.english AND b.english THEN levenshtein(a.name, b.name) <= least(length(a.name), length(b.name)) // 2
    WHEN greatest(len(a.letters), len(b.letters)) < 4 THEN len(list_intersect(a.letters, b.letters)) > 1
    ELSE len(list_intersect(a.letters, b.letters)) / CAST(greatest(len(a.letters), len(b.letters)) AS DOUBLE) >= 0.8 END)"""


def part_names(spark, folder):
    return table(spark, folder, "part").select(
        F.col("p_type").alias("type"), F.concat_ws(" ", "p_name", "p_brand").alias("name")
    ).distinct()


@query("g9_resolve_pairs", f"WITH {NAMES_SQL} SELECT type, a, b FROM cand")
def g9_resolve_pairs(spark, folder):
    return graph.candidate_pairs(part_names(spark, folder))


@query(
    "j10_candidate_pairs",
    f"WITH {NAMES_SQL}, fresh AS (SELECT DISTINCT p_name || ' ' || p_brand AS name FROM part WHERE p_size > 40) SELECT type, a, b FROM cand WHERE a IN (FROM fresh) OR b IN (FROM fresh)",
)
def j10_candidate_pairs(spark, folder):
    fresh = table(spark, folder, "part").filter("p_size > 40").select(F.concat_ws(" ", "p_name", "p_brand").alias("name"))
    return graph.candidate_pairs(part_names(spark, folder), fresh)


@query(
    "g10_parse_decisions",
    "SELECT conv_id AS batch_id, CAST(turn + 1 AS BIGINT) AS question FROM conversations WHERE role = 'user' AND turn + 1 <= 5",
)
def g10_parse_decisions(spark, folder):
    answer = F.concat(
        F.lit("For question <|>"), (F.col("turn") + 1).cast("string"), F.lit("<|> the answer is &&"),
        F.when(F.col("role") == "user", "Yes").otherwise("no"), F.lit("&&.##unreadable"),
    )
    responses = table(spark, folder, "conversations").select(F.col("conv_id").alias("batch_id"), F.lit(5).alias("n"), answer.alias("response"))
    return graph.parse_decisions(responses)


SHARED_LINE_SQL = rf"""ln AS (SELECT DISTINCT doc_id, md5(line) AS h FROM lines WHERE length(line) > 20),
first AS (SELECT h, min(doc_id) AS d FROM ln GROUP BY h),
pairs AS (SELECT DISTINCT ln.doc_id AS src, first.d AS dst FROM ln JOIN first USING (h) WHERE ln.doc_id <> first.d)"""


def shared_line_pairs(spark, folder):
    """Documents linked to the first document that holds one of their longer lines."""
    lines = inp.lines(spark, folder).filter(F.length("line") > 20).select("doc_id", F.md5("line").alias("h")).distinct()
    first = lines.groupBy("h").agg(F.min("doc_id").alias("dst"))
    return lines.join(first, "h").filter("doc_id <> dst").select(F.col("doc_id").alias("src"), "dst").distinct()


@query(
    "g11_connected_components",
    f"""
WITH RECURSIVE {inp.LINES_SQL}, {SHARED_LINE_SQL},
twoway AS (SELECT src, dst FROM pairs UNION SELECT dst, src FROM pairs),
reach AS (SELECT src AS name, src AS other FROM twoway UNION SELECT r.name, b.dst FROM reach r JOIN twoway b ON b.src = r.other)
SELECT name, min(other) AS component FROM reach GROUP BY name
""",
)
def g11_connected_components(spark, folder):
    return graph_algorithms.connected_components(shared_line_pairs(spark, folder))


@query(
    "g13_largest_component",
    f"""
WITH RECURSIVE {inp.LINES_SQL}, {SHARED_LINE_SQL},
twoway AS (SELECT src, dst FROM pairs UNION SELECT dst, src FROM pairs),
reach AS (SELECT src AS name, src AS other FROM twoway UNION SELECT r.name, b.dst FROM reach r JOIN twoway b ON b.src = r.other),
comp AS (SELECT name, min(other) AS component FROM reach GROUP BY name)
SELECT 'D' || name AS name FROM comp WHERE component = (SELECT component FROM comp GROUP BY component ORDER BY count(*) DESC, component LIMIT 1)
""",
)
def g13_largest_component(spark, folder):
    largest = graph_algorithms.largest_component(shared_line_pairs(spark, folder))
    return graph.normalize_names(largest.select(F.concat(F.lit(" d"), F.col("name").cast("string")).alias("name")))


@query(
    "g12_contract_nodes",
    f"""
WITH {TRADE_SQL},
comp AS (SELECT n_name AS name, min(n_name) OVER (PARTITION BY n_regionkey) AS component FROM nation)
SELECT src, component AS dst, CAST(sum(weight) AS BIGINT) AS weight FROM trade JOIN comp ON comp.name = dst GROUP BY ALL
""",
)
def g12_contract_nodes(spark, folder):
    nations = table(spark, folder, "nation")
    first = nations.groupBy("n_regionkey").agg(F.min("n_name").alias("component"))
    components = nations.join(first, "n_regionkey").select(F.col("n_name").alias("name"), "component")
    vertices = trade_vertices(spark, folder).withColumn("description", F.col("type"))
    return graph.contract_nodes(vertices, trade_edges(spark, folder), components)[1]


def text_edges(spark, folder, most=512):
    """Edges between all documents that share lines, weighted by shared lines.

    The work is the number of such pairs, which grows with the square of a line's documents. The documents of a line are
    dealt into blocks of about ``most``, and a task holds one block while it pairs two of them.
    """
    lines = inp.lines(spark, folder).filter(F.length("line") > 20).select("doc_id", F.md5("line").alias("h")).distinct()
    shared = lines.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h", F.ceil(F.col("n") / most).cast("int").alias("blocks"))
    dealt = cut_lineage(lines.join(shared, "h").withColumn("x", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")))
    left = dealt.select("h", F.col("doc_id").alias("a"), "x", F.explode(F.sequence("x", F.col("blocks") - 1)).alias("y"))
    right = dealt.select("h", F.col("doc_id").alias("b"), F.explode(F.sequence(F.lit(0), "x")).alias("x"), F.col("x").alias("y"))
    pairs = left.join(right, ["h", "x", "y"]).filter("a < b OR x < y")
    name = lambda c: F.concat(F.lit("D"), F.lpad(F.col(c).cast("string"), 9, "0"))
    met = pairs.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    return met.select(name("a").alias("src"), name("b").alias("dst"), "weight")


@query("g14_communities")
def g14_communities(spark, folder):
    """Sizes of the communities by level."""
    found = graph_algorithms.communities(cut_lineage(text_edges(spark, folder)))
    return found.groupBy("level", "community").agg(F.count(F.lit(1)).alias("size"))


@query(
    "g14_community_weights",
    f"""
WITH {TRADE_SQL}, deg AS (SELECT src AS name, count(*) AS rank, CAST(sum(weight) AS DOUBLE) AS weight FROM directed GROUP BY src),
m AS (SELECT n_name AS name, CAST(n_regionkey AS VARCHAR) AS community FROM nation UNION ALL SELECT p_brand, 'brands' FROM part GROUP BY p_brand),
s AS (SELECT community, sum(rank * weight) AS w, count(*) AS size FROM m JOIN deg USING (name) GROUP BY community)
SELECT CAST(0 AS BIGINT) AS level, community, size, round(w / max(w) OVER (), 6) AS weight FROM s
""",
)
def g14_community_weights(spark, folder):
    return graph.community_weights(region_members(spark, folder), weighed_vertices(spark, folder))


def weighed_vertices(spark, folder):
    ends = graph.both_ways(trade_edges(spark, folder))
    return ends.groupBy(F.col("src").alias("name")).agg(F.count(F.lit(1)).alias("rank"), F.sum("weight").cast("double").alias("weight"))


def region_members(spark, folder):
    nations = table(spark, folder, "nation").select(F.col("n_name").alias("name"), F.col("n_regionkey").cast("string").alias("community"))
    brands = table(spark, folder, "part").select(F.col("p_brand").alias("name"), F.lit("brands").alias("community")).distinct()
    return nations.unionByName(brands).withColumn("level", F.lit(0))


@query(
    "g15_community_tables",
    f"""
WITH {TRADE_SQL},
m AS (SELECT 'half' || (CAST(substr(p_brand, 7) AS INT) % 2) AS community, p_brand AS name FROM part GROUP BY p_brand UNION ALL SELECT 'half' || (n_nationkey % 2), n_name FROM nation)
SELECT a.community, src, dst, weight, row_number() OVER (PARTITION BY a.community ORDER BY weight DESC, src, dst) AS place
FROM trade JOIN m a ON a.name = src JOIN m b ON b.name = dst AND a.community = b.community
""",
)
def g15_community_tables(spark, folder):
    half = lambda c: F.concat(F.lit("half"), (c % 2).cast("string"))
    brands = table(spark, folder, "part").select(half(F.substr("p_brand", F.lit(7)).cast("int")).alias("community"), F.col("p_brand").alias("name")).distinct()
    nations = table(spark, folder, "nation").select(half(F.col("n_nationkey")).alias("community"), F.col("n_name").alias("name"))
    _, inner = graph.community_tables(brands.unionByName(nations), trade_edges(spark, folder))
    return inner.select("community", "src", "dst", "weight", "place")


@query(
    "g16_parse_reports",
    r"""
SELECT doc_id AS community, source AS title, round(n_chars / 10.0, 6) AS rating, '# ' || source || chr(10) || chr(10) || lang || chr(10) || chr(10) || '## f1' || chr(10) || chr(10) || 'because ' || lang AS report, 'because ' || lang AS evidence
FROM documents WHERE n_chars % 3 <> 0
""",
)
def g16_parse_reports(spark, folder):
    finding = F.array(F.struct(F.lit("f1").alias("summary"), F.concat(F.lit("because "), "lang").alias("explanation")))
    body = F.to_json(
        F.struct(
            F.col("source").alias("title"), F.col("lang").alias("summary"), finding.alias("findings"),
            F.when(F.col("n_chars") % 3 != 0, F.col("n_chars") / 10.0).alias("rating"), F.lit("so").alias("rating_explanation"),
        )
    )
    responses = table(spark, folder, "documents").select(F.col("doc_id").alias("community"), F.concat(F.lit("Here: "), body, F.lit(" done")).alias("response"))
    return graph.parse_reports(responses)


@query(
    "g17_community_lookup",
    f"""
WITH {TRADE_SQL}, m AS (SELECT n_name AS name, CAST(n_regionkey AS VARCHAR) AS community FROM nation),
deg AS (SELECT dst AS name, sum(weight) AS w FROM trade GROUP BY dst),
wt AS (SELECT community, CAST(sum(w) AS DOUBLE) AS weight FROM m JOIN deg USING (name) GROUP BY community),
h AS (SELECT DISTINCT src AS query_id, community FROM trade JOIN m ON m.name = dst WHERE weight >= 80)
SELECT query_id, community, weight, row_number() OVER (PARTITION BY query_id ORDER BY weight DESC, community) AS rank FROM h JOIN wt USING (community) QUALIFY rank <= 2
""",
)
def g17_community_lookup(spark, folder):
    edges = trade_edges(spark, folder)
    members = table(spark, folder, "nation").select(F.col("n_name").alias("name"), F.col("n_regionkey").cast("string").alias("community"))
    weights = edges.join(members.withColumnRenamed("name", "dst"), "dst").groupBy("community").agg(F.sum("weight").cast("double").alias("weight"))
    wanted = edges.filter("weight >= 80").select(F.col("src").alias("query_id"), F.col("dst").alias("name"))
    return graph.community_lookup(wanted, members, weights, 2)


@query(
    "g18_entities_by_vector",
    """
WITH cen AS (SELECT label, list(v ORDER BY pos) AS vector FROM (SELECT label, pos, avg(v) AS v FROM (
  SELECT label, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY label, pos) GROUP BY label),
s AS (SELECT cen.label AS query_id, vec_id AS chunk_id, list_cosine_similarity(vector, CAST(embedding AS DOUBLE[])) AS score FROM cen CROSS JOIN embeddings e)
SELECT CAST(query_id AS BIGINT) AS query_id, chunk_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, chunk_id) AS rank
FROM s WHERE round(score, 6) >= 0.3 QUALIFY rank <= 56
""",
)
def g18_entities_by_vector(spark, folder):
    from corvane.plans.retrieval_queries import item_vectors, label_queries

    return retrieval.vector_match(label_queries(spark, folder), item_vectors(spark, folder), 56, 0.3)


@query(
    "g18_entities_by_type",
    f"""
WITH {TRADE_SQL}, deg AS (SELECT src AS name, CAST(sum(weight) AS DOUBLE) AS pagerank FROM directed GROUP BY src)
SELECT type AS query_id, name, pagerank, row_number() OVER (PARTITION BY type ORDER BY pagerank DESC, name) AS rank FROM names JOIN deg USING (name) QUALIFY rank <= 10
""",
)
def g18_entities_by_type(spark, folder):
    ranked = trade_vertices(spark, folder).join(weighed_vertices(spark, folder), "name").select(
        F.col("type").alias("query_id"), "name", F.col("weight").alias("pagerank")
    )
    return ordering.topk_per_query(ranked, 10, score="pagerank", tie="name")


PATHS_SQL = """paths AS (
  SELECT [a.src, a.dst, b.dst] AS path, [a.weight, b.weight] AS weights FROM directed a JOIN directed b ON b.src = a.dst AND b.dst <> a.src
  UNION ALL SELECT [a.src, a.dst], [a.weight] FROM directed a WHERE NOT EXISTS (SELECT 1 FROM directed b WHERE b.src = a.dst AND b.dst <> a.src))"""


@query(
    "j11_nhop_paths",
    f"WITH {TRADE_SQL}, {PATHS_SQL} SELECT array_to_string(path, '>') AS path, array_to_string(weights, '>') AS weights FROM paths",
)
def j11_nhop_paths(spark, folder):
    return graph.nhop_paths(trade_edges(spark, folder)).select(
        F.array_join("path", ">").alias("path"), F.array_join(F.col("weights").cast("array<bigint>").cast("array<string>"), ">").alias("weights")
    )


@query(
    "j13_mask_subgraph",
    f"""
WITH {TRADE_SQL}, vs AS (SELECT DISTINCT description AS source_id, src AS name FROM trade_lines UNION SELECT DISTINCT description, dst FROM trade_lines)
SELECT a.source_id, src, dst FROM trade JOIN vs a ON a.name = src JOIN vs b ON b.name = dst AND a.source_id = b.source_id
""",
)
def j13_mask_subgraph(spark, folder):
    rows = trade_mentions(spark, folder).select(F.col("description").alias("source_id"), "src", "dst")
    ends = rows.select("source_id", F.explode(F.array("src", "dst")).alias("name"))
    return graph.mask_subgraph(ends, rows)[1]


def asked_entities(spark, folder):
    """Each region asks for its nations, with a similarity by nation key."""
    return table(spark, folder, "nation").select(
        F.col("n_regionkey").cast("bigint").alias("query_id"), F.col("n_name").alias("name"), (1.0 / (F.col("n_nationkey") + 2)).alias("sim")
    )


ASKED_SQL = "asked AS (SELECT CAST(n_regionkey AS BIGINT) AS query_id, n_name AS name, 1.0 / (n_nationkey + 2) AS sim FROM nation)"
PATH_SCORES_SQL = f"""{ASKED_SQL}, {PATHS_SQL},
step AS (SELECT query_id, sim, unnest(weights) AS weight, generate_subscripts(weights, 1) - 1 AS i, path FROM asked JOIN paths ON path[1] = name),
ps AS (SELECT query_id, least(path[i + 1], path[i + 2]) AS src, greatest(path[i + 1], path[i + 2]) AS dst, sum(sim / (2 + i)) AS path_sim, CAST(max(weight) AS DOUBLE) AS path_weight FROM step GROUP BY ALL)"""


@query(
    "g19_path_scores",
    f"WITH {TRADE_SQL}, {PATH_SCORES_SQL} SELECT query_id, src, dst, round(path_sim, 6) AS path_sim, path_weight FROM ps",
)
def g19_path_scores(spark, folder):
    return graph.path_scores(asked_entities(spark, folder), graph.nhop_paths(trade_edges(spark, folder)))


@query(
    "g20_graph_rank",
    f"""
WITH {TRADE_SQL}, {PATH_SCORES_SQL},
deg AS (SELECT src AS name, CAST(sum(weight) AS DOUBLE) AS pagerank FROM directed GROUP BY src),
hit AS (SELECT CAST(r_regionkey AS BIGINT) AS query_id, n_name AS name FROM region JOIN nation ON n_nationkey % 5 = (r_regionkey + 1) % 5),
ent AS (SELECT query_id, name, sim * CASE WHEN (query_id, name) IN (SELECT (query_id, name) FROM hit) THEN 2 ELSE 1 END * pagerank AS score FROM asked JOIN deg USING (name)),
rel AS (SELECT CAST(r_regionkey AS BIGINT) AS query_id, src, dst, weight / 100.0 AS sim, CAST(weight AS DOUBLE) AS pagerank FROM trade JOIN region ON weight % 5 = r_regionkey),
j AS (SELECT query_id, src, dst, sim, pagerank, path_sim, path_weight,
  CASE WHEN (query_id, src) IN (SELECT (query_id, name) FROM hit) THEN 1 ELSE 0 END + CASE WHEN (query_id, dst) IN (SELECT (query_id, name) FROM hit) THEN 1 ELSE 0 END AS t
  FROM rel FULL JOIN ps USING (query_id, src, dst)),
rs AS (SELECT query_id, src || '→' || dst AS item, CASE WHEN sim IS NOT NULL THEN sim * (coalesce(path_sim, 0) + t + 1) ELSE path_sim * (t + 1) END * coalesce(pagerank, path_weight) AS score FROM j)
SELECT query_id, 'entity' AS kind, name AS item, round(score, 5) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, name) AS rank FROM ent QUALIFY rank <= 6
UNION ALL
SELECT query_id, 'relation', item, round(score, 5), row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, item) AS rank FROM rs QUALIFY rank <= 6
""",
)
def g20_graph_rank(spark, folder):
    edges = trade_edges(spark, folder)
    ranks = weighed_vertices(spark, folder).select("name", F.col("weight").alias("pagerank"))
    asked = asked_entities(spark, folder)
    regions = table(spark, folder, "region").select(F.col("r_regionkey").cast("bigint").alias("query_id"))
    hits = table(spark, folder, "nation").select(
        F.col("n_name").alias("name"), F.pmod(F.col("n_nationkey") % 5 + 4, F.lit(5)).cast("bigint").alias("query_id")
    ).join(regions, "query_id")
    relations = edges.withColumn("query_id", F.col("weight") % 5).join(regions, "query_id").select(
        "query_id", "src", "dst", (F.col("weight") / 100.0).alias("sim"), F.col("weight").cast("double").alias("pagerank")
    )
    entities, found = graph.graph_rank(
        asked.join(ranks, "name"), hits, relations, graph.path_scores(asked, graph.nhop_paths(edges))
    )
    return entities.select("query_id", F.lit("entity").alias("kind"), F.col("name").alias("item"), F.round("score", 5).alias("score"), "rank").unionByName(
        found.select("query_id", F.lit("relation").alias("kind"), F.concat_ws("→", "src", "dst").alias("item"), F.round("score", 5).alias("score"), "rank")
    )


@query(
    "g21_rebuild_graph",
    f"WITH {TRADE_SQL} SELECT src, dst, sum(weight) AS weight, count(DISTINCT s) AS sources, string_agg(DISTINCT description, '<SEP>' ORDER BY description) AS description FROM trade_lines WHERE s >= TIMESTAMP '1996-01-01' GROUP BY src, dst",
)
def g21_rebuild_graph(spark, folder):
    rows = trade_mentions(spark, folder)
    excluded = rows.filter(F.col("source_id") < F.lit("1996-01-01").cast("timestamp_ntz")).select("source_id").distinct()
    entities = trade_vertices(spark, folder).withColumns({"description": F.col("type"), "source_id": F.lit("2030-01-01").cast("timestamp_ntz")})
    return graph.rebuild_graph(entities, rows, excluded)[1].select("src", "dst", "weight", "sources", "description")


@query(
    "u6_graph_union",
    f"""
WITH {TRADE_SQL} SELECT src, dst, sum(weight) AS weight, string_agg(DISTINCT description, '<SEP>' ORDER BY description) AS description FROM trade_lines WHERE description <> 'R' GROUP BY src, dst
""",
)
def u6_graph_union(spark, folder):
    rows = trade_mentions(spark, folder).filter("description <> 'R'")
    return aggregates.merge_relation_mentions(rows).select("src", "dst", "weight", "description")


@query("g22_node_embeddings")
def g22_node_embeddings(spark, folder):
    return graph_algorithms.node_embeddings(trade_edges(spark, folder)).select("name", F.size("vector").alias("dim"))


@query("g22_neighbours_nearer", "SELECT true AS nearer")
def g22_neighbours_nearer(spark, folder):
    """Whether documents that share lines are nearer to each other, on the mean, than documents that chance puts together."""
    edges = cut_lineage(text_edges(spark, folder))
    vectors = cut_lineage(graph_algorithms.node_embeddings(edges))
    end = lambda c: vectors.select(F.col("name").alias(c), F.col("vector").alias(f"v_{c}"))
    near = edges.join(end("src"), "src").join(end("dst"), "dst").agg(F.avg(sc.cosine(F.col("v_src"), F.col("v_dst"))).alias("near"))
    n = vectors.count()
    placed = scans.ranked(vectors, [], [F.xxhash64("name")], "at")
    other = placed.select((F.pmod(F.col("at"), F.lit(n)) + 1).alias("at"), F.col("vector").alias("w"))
    chance = placed.join(other, "at").agg(F.avg(sc.cosine(F.col("vector"), F.col("w"))))
    return near.select((F.col("near") > chance.scalar() + 0.1).alias("nearer"))


@query(
    "g23_graph_rows",
    f"""
WITH {TRADE_SQL}, deg AS (SELECT src AS name, count(*) AS rank FROM directed GROUP BY src)
SELECT md5('entity' || chr(1) || name) AS row_id, name AS a, type AS b, '{{"name":"' || name || '","type":"' || type || '","description":"' || type || '","rank":' || rank || '}}' AS content FROM names JOIN deg USING (name)
UNION ALL SELECT md5('relation' || chr(1) || src || chr(1) || dst), src, dst, '{{"src":"' || src || '","dst":"' || dst || '","description":"d","weight":' || weight || '}}' FROM trade
""",
)
def g23_graph_rows(spark, folder):
    edges = trade_edges(spark, folder)
    vertices = trade_vertices(spark, folder).join(graph.degree(edges), "name").withColumn("description", F.col("type"))
    entities = graph.entity_rows(vertices).select("row_id", F.col("name").alias("a"), F.col("type").alias("b"), "content")
    relations = graph.relation_rows(edges.withColumn("description", F.lit("d"))).select("row_id", F.col("src").alias("a"), F.col("dst").alias("b"), "content")
    return entities.unionByName(relations)


@query(
    "l7_graph_view",
    f"""
WITH {TRADE_SQL}, deg AS (SELECT src AS name, CAST(sum(weight) AS DOUBLE) AS pagerank FROM directed GROUP BY src),
best AS (SELECT name FROM deg ORDER BY pagerank DESC, name LIMIT 30)
SELECT src, dst, weight FROM trade WHERE src IN (FROM best) AND dst IN (FROM best) ORDER BY weight DESC, src, dst LIMIT 40
""",
)
def l7_graph_view(spark, folder):
    vertices = weighed_vertices(spark, folder).select("name", F.col("weight").alias("pagerank"))
    return graph.graph_view(vertices, trade_edges(spark, folder), 30, 40)
