"""Operators on small fixtures against independent brute force and worked examples."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions import scalars as sc
from corvane.functions import text as tx
from corvane.operators import aggregates, chunking, cluster, filters, graph, graph_algorithms, joins, memory, ordering, postings, retrieval, tables, tagging, terms
from corvane.operators.scans import running_total
from corvane.sources import store
from corvane.streaming import ingest


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_cjk_text_functions(spark):
    lit = F.lit
    assert one(spark, tx.fine_words(lit("数据库 abc12"))) == ["数据", "据库", "abc", "12"]
    assert one(spark, tx.space_between_scripts(lit("abc12中文def"))) == "abc12 中文 def"
    assert one(spark, tx.halfwidth(lit("ＡＢ１　ｃ"))) == "AB1 c"
    assert one(spark, tx.is_cjk(lit("中文a"))) and not one(spark, tx.is_cjk(lit("abcdef中")))
    # Neighbouring filler words share a blank, so only every other one goes; the first listed alternative wins.
    assert one(spark, tx.normalize_query(lit("What is the weather, 北京怎么办?"))).split() == ["the", "weather", "北京"]
    assert one(spark, tx.arabic_digits(lit("١٢۳"))) == "123"
    assert one(spark, tx.strip_qa_prefix(lit("Answer：  yes"))) == "yes"


@pytest.mark.parametrize(
    "text,seconds",
    [("2024-01-01T00:00:00Z", 0), ("2024-01-01T05:30:00+0530", 0), ("2024-01-01 00:00:00-3", 10800), ("2024-01-01", 0), ("no date", None)],
)
def test_parse_datetime_any(spark, text, seconds):
    got = one(spark, F.unix_timestamp(sc.parse_datetime_any(F.lit(text))))
    assert got == (None if seconds is None else 1704067200 + seconds)


def test_vectors(spark):
    zero, unit = F.array(F.lit(0.0), F.lit(0.0)), F.array(F.lit(3.0), F.lit(4.0))
    assert one(spark, sc.cosine(zero, unit)) == 0 and one(spark, sc.cosine(unit, F.array(F.lit(1.0)))) == 0
    assert one(spark, sc.cosine(unit, unit)) == pytest.approx(1)
    assert one(spark, sc.blend_vectors(F.array(F.lit(1.0)), unit)) == [3.0, 4.0]


def test_token_merge(spark):
    merge = lambda words: one(spark, terms.token_merge(F.array(*[F.lit(w) for w in words]), ["x"]))
    assert merge(["a", "b", "word", "c"]) == ["a b", "word", "c"]
    assert merge(list("abcdefg")) == ["a b", "c d", "e f g"]
    assert merge(["a", "x", "b"]) == ["a", "x", "b"]
    assert merge(["多", "工位"]) == ["多 工位"]


def test_running_total_equals_plain_window(spark):
    rows = [(k, i, random.Random(k * 1000 + i).randint(0, 9)) for k in range(3) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, i int, v long").withColumn("b", F.floor(F.col("i") / 16))
    got = {(r.k, r.i): r.t for r in running_total(df, ["k"], ["b"], ["i"], "v", "t").collect()}
    for k in range(3):
        total = 0
        for _, i, v in [r for r in rows if r[0] == k]:
            total += v
            assert got[k, i] == total


META = [("d1", "n", "5"), ("d2", "n", "abc"), ("d3", "n", "2024-05-01"), ("d4", "n", ""), ("d5", "t", "a"), ("d5", "t", "b"), ("d6", "n", "07")]


@pytest.mark.parametrize(
    "op,value,expected",
    [
        ("=", 5, {"d1"}), ("≠", 5, {"d2", "d3", "d4", "d6"}), (">", "4", {"d1"}), (">", "ab", {"d2"}), ("≥", "2024-01-01", {"d3"}),
        ("in", "abcdef", {"d2", "d4"}), ("in", ["5", "ABC"], {"d1", "d2"}), ("not in", ["5", "abc", "", "07"], {"d3"}), ("empty", "", {"d4"}),
        ("start with", "AB", {"d2"}), ("end with", "01", {"d3"}), ("no such operator", "x", set()), ("is", "ABC", {"d2"}),
    ],
)
def test_meta_filter(spark, op, value, expected):
    meta = spark.createDataFrame(META, "doc_id string, key string, value string")
    got = {r.doc_id for r in filters.meta_filter(meta, [{"key": "n", "op": op, "value": value}]).collect()}
    assert got == expected


def test_meta_filter_any_value_and_absent_key(spark):
    meta = spark.createDataFrame(META, "doc_id string, key string, value string")
    ids = lambda *a, **k: {r.doc_id for r in filters.meta_filter(meta, *a, **k).collect()}
    assert ids([{"key": "t", "op": "≠", "value": "a"}]) == {"d5"}
    assert ids([{"key": "gone", "op": "empty", "value": ""}]) == set()
    assert filters.metadata_scope(meta, []) is None


def test_overlap_and_adjacent_chunks(spark):
    docs = spark.createDataFrame([(1, "a b c\nd e f\ng h i\nj k l")], "doc_id int, text string")
    plain = [r.content for r in chunking.chunk_by_tokens(docs, 5).orderBy("chunk").collect()]
    assert plain == ["\na b c\nd e f", "\ng h i\nj k l"]
    tails = [r.content for r in chunking.chunk_by_tokens(docs, 5, 50).orderBy("chunk").collect()]
    # With half overlap a chunk closes after 2.5 tokens, and takes half of its predecessor's characters along.
    assert tails == ["\na b c", "b c\nd e f", "d e f\ng h i", "\ng h i\nj k l"]
    items = spark.createDataFrame([(1, [("text", "a b"), ("text", "c"), ("table", "T"), ("text", "d")])], "doc_id int, items array<struct<kind:string,text:string>>")
    merged = [(r.kind, r.content) for r in chunking.merge_adjacent(items, 8).orderBy("chunk").collect()]
    assert merged == [("text", "a b\nc"), ("table", "T"), ("text", "d")]


def test_titles(spark):
    text = "# One\nintro\n## Two\nbody two\n## Three\nbody three\n# Four\nlast"
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    paths = [r.content for r in chunking.chunk_by_titles(docs, "hierarchy", nth=2).orderBy("chunk").collect()]
    assert paths == ["# One\nintro", "# One\n## Two\nbody two", "# One\n## Three\nbody three", "# Four\nlast"]
    leaves = [r.content for r in chunking.chunk_by_titles(docs, "hierarchy", nth=2, with_bodies=False).orderBy("chunk").collect()]
    assert leaves == ["# One\nintro\n## Two\nbody two", "# One\nintro\n## Three\nbody three", "# Four\nlast"]
    long = "\n".join(["# A", "word " * 40, "# B", "word " * 40, "x"])
    grouped = chunking.chunk_by_titles(spark.createDataFrame([(1, long)], "doc_id int, text string")).collect()
    assert len(grouped) == 2 and sorted(r.content for r in grouped)[1].startswith("# B")


def test_contents_pages(spark):
    text = "Preface\nContents\nChapter one 1\nChapter two 9\nChapter one\nbody"
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    # The first entry starts with "Chapter one"; everything up to the next line that starts so is cut.
    assert chunking.drop_contents_pages(docs).first()["content"] == "Preface\nChapter one\nbody"


def test_html(spark):
    html = "<html><head><title>t</title></head><body><h1>Top</h1><script>x</script><p>one <b>two</b></p><!-- c --><table><tr><td>A</td></tr></table><p>three</p></body></html>"
    rows = chunking.html_to_sections(spark.createDataFrame([(1, html)], "page_id int, html string"), 100).collect()
    assert {(r.kind, r.content) for r in rows} == {("text", "# Top\none two\nthree"), ("table", "<table><tr><td>A</td></tr></table>")}
    cut = chunking.html_to_sections(spark.createDataFrame([(1, "<body><p>" + "w " * 25 + "</p></body>")], "page_id int, html string"), 10).collect()
    assert sorted(len(r.content.split()) for r in cut) == [5, 10, 10]


def test_json(spark):
    docs = spark.createDataFrame([(1, '{"a": [1, {"b": "x"}]}'), (2, '{"a": 1}\n{"a": 2}'), (3, "no json")], "doc_id int, text string")
    got = {}
    for r in chunking.json_to_chunks(docs, 500).orderBy("doc_id", "chunk").collect():
        got.setdefault(r.doc_id, []).append(r.content)
    assert got == {1: ['{"a": {"0": 1, "1": {"b": "x"}}}'], 2: ['{"a": 1}', '{"a": 2}']}


def test_markdown(spark):
    text = "# Head\nparagraph\nmore\n\n- a\n- b\n\n```\n# no head\n\ncode\n```\n| x | y |\n| - | - |"
    parts = [r.content for r in chunking.markdown_elements(spark.createDataFrame([(1, text)], "doc_id int, text string")).orderBy("chunk").collect()]
    assert parts == ["# Head\nparagraph\nmore", "- a\n- b", "```\n# no head\n\ncode\n```", "| x | y |\n| - | - |"]


def test_media_context(spark):
    items = spark.createDataFrame([(1, [("text", "One two. Three four."), ("table", "T"), ("text", "Five. Six seven eight.")])], "doc_id int, items array<struct<kind:string,text:string>>")
    row = chunking.media_context(items, 3).filter("kind = 'table'").first()
    assert row.above.strip() == "Three four." and row.below.startswith("Five.")


def test_pairs_from_lines(spark):
    lines = spark.createDataFrame([(1, i, s) for i, s in enumerate(["x", "q1,a1", "more", "q2,", "q3,a3"])], "doc_id int, ord int, line string")
    assert [(r.question, r.answer) for r in tables.qa_pairs(lines).orderBy("item").collect()] == [("q1", "a1\nmore"), ("q3", "a3")]
    md = spark.createDataFrame([(1, i, s) for i, s in enumerate(["# A", "## B", "text", "# C", "last"])], "doc_id int, ord int, line string")
    assert [(r.question, r.answer) for r in tables.markdown_qa(md).orderBy("item").collect()] == [("A\nB", "text"), ("C", "last")]


def test_column_types(spark):
    rows = spark.createDataFrame([("12", "0.5", "yes", "9223372036854775808"), ("13", "0.7", "no", "1"), ("x", "1.5", "是", "2")], "a string, b string, c string, d string")
    assert {r["column"]: r["type"] for r in tables.infer_column_types(rows).collect()} == {"a": "int", "b": "text", "c": "bool", "d": "float"}


def test_text_match_is_exact(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    weights = [1 / (i + 1) for i in range(30)]
    chunks = [(f"c{i}", rng.choices(words, weights, k=rng.randint(3, 15))) for i in range(80)]
    asked = [(q, w, 1.0 / len(ws)) for q in range(12) for ws in [set(rng.choices(words, weights, k=14))] for w in ws]
    table = spark.createDataFrame(chunks, "chunk_id string, tokens array<string>")
    terms_df = spark.createDataFrame(asked, "query_id int, term string, weight double")
    index = postings.build(table, {"t": "tokens"}, block_rows=16)
    got = {(r.query_id, r.chunk_id): (r.matched, r.score) for r in retrieval.text_match(terms_df, index, {"t": 2.0}, 0.4).collect()}
    df = {w: sum(w in t for _, t in chunks) for w in words}
    average = sum(len(t) for _, t in chunks) / len(chunks)
    expected = {}
    for q in range(12):
        mine = {w: weight for qq, w, weight in asked if qq == q}
        for c, t in chunks:
            hit = [w for w in mine if w in t]
            if len(hit) >= max(1, int(len(mine) * 0.4)):
                expected[q, c] = (len(hit), sum(
                    mine[w] * 2 * np.log(1 + (len(chunks) - df[w] + 0.5) / (df[w] + 0.5)) * t.count(w) * 2.2 / (t.count(w) + 1.2 * (0.25 + 0.75 * len(t) / average))
                    for w in hit
                ))
    assert got.keys() == expected.keys() and len(got) > 20
    assert all(got[k][0] == expected[k][0] and got[k][1] == pytest.approx(expected[k][1]) for k in got)


def test_vector_match_blocks_equal_broadcast(spark, monkeypatch):
    rng = np.random.default_rng(5)
    queries = spark.createDataFrame([(i, rng.normal(size=6).tolist()) for i in range(9)], "query_id int, vector array<double>")
    vectors = spark.createDataFrame([(i, rng.normal(size=6).tolist()) for i in range(50)], "chunk_id int, embedding array<double>")
    small = sorted((r.query_id, r.rank, r.chunk_id) for r in retrieval.vector_match(queries, vectors, 4).collect())
    monkeypatch.setattr(retrieval, "BROADCAST_BYTES", 1)
    blocks = sorted((r.query_id, r.rank, r.chunk_id) for r in retrieval.vector_match(queries, vectors, 4, block_rows=7).collect())
    assert small == blocks and len(small) == 36


def test_rank_feature_score(spark):
    score = retrieval.rank_feature_score(F.create_map(F.lit("apple"), F.lit(2.0)), F.create_map(F.lit("apple"), F.lit(1.0)), F.lit(0.0))
    assert one(spark, score) == pytest.approx(10.0)
    assert one(spark, retrieval.rank_feature_score(F.lit(None).cast("map<string,double>"), F.create_map(F.lit("a"), F.lit(1.0)), F.lit(3.0))) == 3.0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_candidate_pairs_equal_all_pairs(spark):
    rng = random.Random(11)
    names = sorted({"".join(rng.choices("abc d", k=rng.randint(2, 8))) + rng.choice(["", "1", "22"]) for _ in range(60)} | {"数据库", "数据仓库", "数据", "据数"})
    got = {(r.a, r.b) for r in graph.candidate_pairs(spark.createDataFrame([("t", n) for n in names], "type string, name string")).collect()}
    grams = lambda s: {s[i:i + 2] for i in range(len(s) - 1)}
    english = lambda s: len(re.findall(r"[`a-zA-Z0-9.,':;/\"?<>!()\-]", s)) / len(s) > 0.8
    expected = set()
    for a, b in itertools.combinations(names, 2):
        if any(re.search("[0-9]", g) for g in grams(a) ^ grams(b)):
            continue
        if english(a) and english(b):
            ok = distance(a, b) <= min(len(a), len(b)) // 2
        else:
            common, most = len(set(a) & set(b)), max(len(set(a)), len(set(b)))
            ok = common > 1 if most < 4 else common / most >= 0.8
        if ok:
            expected.add((a, b))
    assert got == expected and expected


EDGES = [("a", "b", 1.0), ("b", "c", 2.0), ("d", "d", 1.0), ("e", "f", 3.0)]


def test_paths_and_degree(spark):
    edges = spark.createDataFrame(EDGES, "src string, dst string, weight double")
    paths = {tuple(r.path) for r in graph.nhop_paths(edges).collect()}
    assert paths == {("a", "b", "c"), ("c", "b", "a"), ("b", "a"), ("b", "c"), ("d", "d"), ("e", "f"), ("f", "e")}
    assert {r.name: r["rank"] for r in graph.degree(edges).collect()} == {"a": 1, "b": 2, "c": 1, "d": 2, "e": 1, "f": 1}


def test_dense_contraction(spark):
    edges = spark.createDataFrame([(h, f"n{i:02d}", 1.0) for h in ("hub1", "hub2") for i in range(20)], "src string, dst string, weight double")
    names = ["hub1", "hub2"] + [f"n{i:02d}" for i in range(20)]
    vertices = spark.createDataFrame([(n, "T", "d " + n) for n in names], "name string, type string, description string")
    parts = spark.createDataFrame([("hub1", "hub1"), ("hub2", "hub1")], "name string, component string")
    merged, moved = graph.contract_nodes(vertices, edges, parts)
    assert merged.count() == 21 and moved.count() == 20 and moved.agg(F.min("weight")).first()[0] == 2.0


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)]
    got = {r.name: r.component for r in graph_algorithms.connected_components(spark.createDataFrame(pairs, "src int, dst int")).collect()}
    parent = {n: n for p in pairs for n in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    assert got == {n: root(n) for n in parent}


def test_pagerank(spark):
    names = list("abcdefg")
    edges = [("a", "b", 1.0), ("b", "c", 2.0), ("a", "c", 1.0), ("d", "d", 1.0), ("e", "f", 3.0)]
    got = graph_algorithms.pagerank(
        spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame(edges, "src string, dst string, weight double"), tolerance=1e-12
    ).collect()
    n, at = len(names), {x: i for i, x in enumerate(names)}
    m = np.zeros((n, n))
    for a, b, w in edges:
        m[at[a], at[b]] += w
        if a != b:
            m[at[b], at[a]] += w
    rank = np.full(n, 1 / n)
    for _ in range(300):
        out = m.sum(axis=1)
        share = np.divide(m, out[:, None], out=np.zeros_like(m), where=out[:, None] > 0)
        rank = 0.85 * (rank @ share + rank[out == 0].sum() / n) + 0.15 / n
    assert all(r.pagerank == pytest.approx(rank[at[r.name]], abs=1e-6) for r in got) and len(got) == n


def test_communities(spark):
    clique = lambda p: [(f"{p}{i}", f"{p}{j}", 1.0) for i in range(5) for j in range(i + 1, 5)]
    edges = spark.createDataFrame(clique("a") + clique("b") + [("a0", "b0", 1.0)], "src string, dst string, weight double")
    found = graph_algorithms.communities(edges)
    level = found.filter("level = 0")
    assert level.select("name").distinct().count() == 10 == level.count()
    assert graph_algorithms.modularity(edges, level.select("name", "community")) > 0.3


def test_trees(spark):
    rng = np.random.default_rng(1)
    points = rng.normal(size=(40, 5))
    vectors = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id int, vector array<double>")
    buckets = cluster.split_buckets(vectors, 10)
    sizes = [r["count"] for r in buckets.groupBy("bucket").count().collect()]
    assert sum(sizes) == 40 and max(sizes) <= 10
    tree = cluster.pair_tree(vectors.withColumn("bucket", F.lit("x"))).collect()
    assert len(tree) == 79 and sum(r.parent == -1 for r in tree) == 1
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    sims = unit @ unit.T - 2 * np.eye(40)
    a, b = divmod(int(np.argmax(sims)), 40)
    leaves = {r.id: r.parent for r in tree if r.id is not None and r.id == r.id}
    assert leaves[a] == leaves[b]
    wide = spark.createDataFrame([(f"c{i:02d}", "r") for i in range(11)], "node string, parent string")
    balanced = cluster.rebalance(wide, 3)
    assert balanced.groupBy("parent").count().agg(F.max("count")).first()[0] <= 3
    assert {r.node for r in balanced.collect()} >= {f"c{i:02d}" for i in range(11)}


def test_ward_finds_blobs(spark):
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.normal(c, 0.02, size=(8, 3)) for c in ([1, 0, 0], [0, 1, 0], [0, 0, 1])])
    labels = cluster._ward_labels(points, 10)
    assert len(set(labels)) == 3 and all(len(set(labels[i * 8:(i + 1) * 8])) == 1 for i in range(3))


def test_citations(spark):
    rows = [("x", 0, "c1", 0.5), ("x", 0, "c2", 0.499), ("x", 1, "c1", 0.6), ("x", 1, "c3", 0.3), ("y", 0, "c1", 0.2)]
    got = {(r.answer_id, r.piece, r.chunk_id) for r in joins.citation_join(spark.createDataFrame(rows, "answer_id string, piece int, chunk_id string, score double")).collect()}
    assert got == {("x", 1, "c1")}


def test_conversation_fit(spark):
    rows = [(1, 0, "system", "s " * 5), (1, 1, "user", "u " * 50), (1, 2, "user", "v " * 10), (2, 0, "user", "short")]
    fitted = memory.conversation_fit(spark.createDataFrame(rows, "memory_id int, turn int, role string, content string"), 10)
    got = {(r.memory_id, r.turn): len(r.content.split()) for r in fitted.collect()}
    assert got == {(1, 0): 5, (1, 2): 5, (2, 0): 1}


def test_feedback(spark):
    cited = spark.createDataFrame([(1, 5, i, f"c{i}", s) for i, s in enumerate([0.9, 0.6, 0.3])], "event_id int, budget int, position int, chunk_id string, signal double")
    deltas = tagging.feedback_deltas(cited)
    # Shares 2.5, 1.667, 0.833: whole parts 2, 1, 0 and the two left units go to the largest remainders.
    assert {r.chunk_id: r.delta for r in deltas.collect()} == {"c0": 2, "c1": 2, "c2": 1}
    chunks = spark.createDataFrame([("c0", 99.0), ("c1", None), ("c9", 4.0)], "chunk_id string, pagerank double")
    down = spark.createDataFrame([("c0", 5), ("c1", -1)], "chunk_id string, delta long")
    assert {r.chunk_id: r.pagerank for r in tagging.apply_feedback(chunks, down).collect()} == {"c0": 100.0, "c1": None, "c9": 4.0}


def test_one_sided_fusion(spark):
    hits = lambda rows: spark.createDataFrame(rows, "query_id int, chunk_id string, score double")
    fused = retrieval.fuse_scores(hits([(1, "a", 1.0)]), hits([(1, "b", 0.5)]), 0.5, 5)
    assert {r.chunk_id: r.score for r in fused.collect()} == {"a": 0.5, "b": 0.25}
    gated = retrieval.fuse_scores(hits([(1, "a", 1.0)]), hits([(1, "b", 0.5)]), 0.5, 5, text_gated=True)
    assert [r.chunk_id for r in gated.collect()] == ["a"]


def test_pages_cover_every_row(spark):
    df = spark.range(57).withColumn("s", F.col("id") % 7)
    seen = []
    for number in range(1, 8):
        seen += [r.id for r in ordering.page(df.orderBy("s", "id"), number, 10).collect()]
    assert sorted(seen) == list(range(57))
    last, keyed = None, []
    while True:
        rows = ordering.keyset_page(df, ["s", "id"], last, 10).collect()
        if not rows:
            break
        keyed += [r.id for r in rows]
        last = (rows[-1].s, rows[-1].id)
    assert keyed == seen


def test_store_moves_keeps_ids_and_order(spark, tmp_path):
    path = str(tmp_path / "chunks")
    make = lambda rows: spark.createDataFrame(rows, "chunk_id string, dataset_id string, content string, version int")
    store.write_chunks(make([("c1", "007", "old", 1), ("c2", "7", "x", 1), ("c3", "a/b", "y", 1)]), path, order="version")
    store.write_chunks(make([("c1", "7", "moved", 2), ("c2", "7", "stale", 0), ("c4", None, "z", 1), ("c4", "q", "zz", 2)]), path, order="version", bucket_rows=1)
    got = sorted((r.chunk_id, r.dataset_id, r.content) for r in store.read_chunks(spark, path).collect())
    assert got == [("c1", "7", "moved"), ("c2", "7", "x"), ("c3", "a/b", "y"), ("c4", "q", "zz")]
    assert [r.chunk_id for r in store.read_chunks(spark, path, ["007"]).collect()] == []
    with pytest.raises(ValueError):
        store.write_chunks(make([("c9", "7", "a", 1), ("c9", "7", "b", 1)]), path)


def test_stream_upsert_keeps_late_and_newer_rows(spark, tmp_path):
    schema = "chunk_id string, dataset_id string, content string, at timestamp"
    days = [
        [("a", "d", "first", "2024-01-10 00:00:00"), ("b", "d", "b", "2024-01-10 00:00:00")],
        [("a", "d", "second", "2024-01-10 05:00:00"), ("late", "d", "new", "2024-01-01 00:00:00")],
        [("b", "d", "too old", "2024-01-09 00:00:00")],
    ]
    for i, rows in enumerate(days):
        spark.createDataFrame(rows, "chunk_id string, dataset_id string, content string, at string").selectExpr(
            "chunk_id", "dataset_id", "content", "timestamp(at) AS at"
        ).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
        stream = ingest.read_files(spark, str(tmp_path / "in/*"), T.StructType.fromDDL(schema))
        ingest.idempotent_upsert(stream, str(tmp_path / "chunks"), str(tmp_path / "checkpoint"))
    got = {r.chunk_id: r.content for r in store.read_chunks(spark, str(tmp_path / "chunks")).collect()}
    assert got == {"a": "second", "b": "b", "late": "new"}


def test_one_row_per_key_at_any_size(spark):
    rows = spark.range(3000).selectExpr("'e' AS name", "'t' AS type", "concat('d', id) AS description", "cast(id % 5 AS string) AS source_id")
    merged = aggregates.merge_entity_mentions(rows).collect()
    assert len(merged) == 1 and len(merged[0].description.split("<SEP>")) == 3000 and merged[0].source_ids == list("01234")
    records = spark.range(3000).selectExpr("1 AS g", "id AS ord", "map('k', array(cast(id AS string))) AS record")
    combined = aggregates.combine_records(records, "g", "ord").collect()
    assert len(combined) == 1 and combined[0]["values"] == [str(i) for i in range(3000)] and not combined[0].scalar


def test_communities_settle(spark):
    """A grid has few, balanced communities whatever its diameter, and no community is split for ever."""
    cells = [(i, j) for i in range(8) for j in range(8)]
    name = lambda c: f"{c[0]:02d}{c[1]:02d}"
    edges = [(name(c), name((c[0] + a, c[1] + b)), 1.0) for c in cells for a, b in ((0, 1), (1, 0)) if c[0] + a < 8 and c[1] + b < 8]
    df = spark.createDataFrame(edges, "src string, dst string, weight double")
    top = graph_algorithms.communities(df, max_size=64).filter("level = 0").select("name", "community")
    assert top.count() == 64 and 3 <= top.select("community").distinct().count() <= 12
    assert graph_algorithms.modularity(df, top) > 0.5


def test_pages_cover_every_candidate(spark):
    hits = spark.range(200).selectExpr("'q' AS query_id", "cast(id AS string) AS chunk_id", "0.5D AS cosine", "cast(id + 1 AS int) AS rank")
    chunks = spark.range(200).selectExpr("cast(id AS string) AS chunk_id", "'d' AS doc_id", "'n' AS doc_name", "array('w') AS tokens", "array('w') AS title_tokens")
    documents = spark.createDataFrame([("d",)], "doc_id string")
    features = spark.createDataFrame([("q", {"w": 1.0}, 1.0)], "query_id string, features map<string,double>, feature_total double")
    seen = []
    for page in range(1, 24):
        rows, _ = retrieval.retrieval(hits, chunks, documents, features, page=page)
        seen += [r.chunk_id for r in rows.collect()]
    assert sorted(seen, key=int) == [str(i) for i in range(200)]


def test_slices_of_a_long_block_stay_alone(spark):
    html = "<body><p>" + "w " * 11 + "</p><p>tail block</p><p>more</p></body>"
    rows = chunking.html_to_sections(spark.createDataFrame([(1, html)], "page_id int, html string"), 6).orderBy("chunk").collect()
    assert [r.content for r in rows] == ["w w w w w w", "w w w w w", "tail block\nmore"]
    far = "Contents\nAlpha one 1\n" + "\n".join(f"Entry {i} {i}" for i in range(300)) + "\nAlpha one\nbody"
    cut = chunking.drop_contents_pages(spark.createDataFrame([(1, far)], "doc_id int, text string")).first()["content"]
    assert cut == "Alpha one\nbody"
