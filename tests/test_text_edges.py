"""All pairs of documents that share lines are linked, however many documents a line has."""

from itertools import combinations

import pytest

from corvane.plans import graph_queries


@pytest.mark.parametrize("most", [512, 3])
def test_every_pair_of_a_line_is_linked(spark, tmp_path, most):
    common, rare, short = "a line that many documents share", "another line that few documents share", "short"
    texts = {i: [common, common, short] + [rare] * (i % 4 == 0) + [f"a line that only document {i} has"] for i in range(11)}
    texts[11] = [short, "nothing of this is in another text"]
    rows = [(i, "\n".join(t), "en", "web", 1) for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    found = {(r.src, r.dst): r.weight for r in graph_queries.text_edges(spark, str(tmp_path), most).collect()}
    assert found == {(f"D{a:09d}", f"D{b:09d}"): 1.0 + (a % 4 == b % 4 == 0) for a, b in combinations(range(11), 2)}
