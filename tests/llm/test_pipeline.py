"""The pipeline's rows against a plain version of each stage, and the entry without the optional parts."""

import hashlib
import math
import random
import re
import subprocess
import sys
from collections import Counter, defaultdict

import corpus_pipeline
from corvane.llm import pieces

from . import brute
from .test_native import plain_counts

CLASSES = ["[a-z]", r"[A-ZÀ-Þ]", r"[^\W\d_]", "[0-9]", r"[.,;:'\"()\-]", "[!?]", "[#*$%&|<>]"]


def divergence(p, q):
    part = lambda x, m: x * math.log2(x / m) if x > 0 else 0.0
    return sum((part(a, (a + b) / 2) + part(b, (a + b) / 2)) / 2 for a, b in zip(p, q))


def histogram(text):
    rest, out = "".join(brute.words(text)), []
    for pattern in CLASSES:
        left = re.sub(pattern, "", rest)
        out.append(len(rest) - len(left))
        rest = left
    return [*out, len(rest)]


def plain_quality(docs, common=48, least=1000):
    """Rows kept: the counts of test_native, and distances to the histograms of all other texts of a language."""
    by = defaultdict(list)
    for d in docs:
        by[d["lang"]].append(d)
    pool = [sum(x) for x in zip(*(histogram(d["text"]) for d in docs))]
    kept = []
    for own in by.values():
        chars = [sum(x) for x in zip(*(histogram(d["text"]) for d in own))]
        said = Counter(w.lower() for d in own for w in brute.words(d["text"]))
        total = sum(len(brute.words(d["text"])) for d in own)
        top = sorted(said.items(), key=lambda x: (-x[1], x[0].encode()))[:common]
        for d in own:
            n, n_chars, _, _, again = plain_counts(d["text"])
            if n < 50 or 100 * again > 50 * n:
                continue
            here = Counter(w.lower() for w in brute.words(d["text"]))
            p = [here[w] / n for w, _ in top]
            q = [(c - here[w]) / max(1, total - n) for w, c in top]
            enough = total - n >= least
            far = math.sqrt(divergence([*p, 1 - sum(p)], [*q, 1 - sum(q)])) if enough else 0
            mine = histogram(d["text"])
            other = [x - y for x, y in zip(chars if enough else pool, mine)]
            shape = math.sqrt(divergence([c / n_chars for c in mine], [c / sum(other) for c in other])) if sum(other) else 0
            if (n < 80 or far <= 0.31 + 0.9 / math.sqrt(n)) and (n_chars < 100 or shape <= 0.34):
                kept.append(d)
    return kept


def plain_mix(docs):
    size = {d["doc_id"]: len(brute.words(d["text"])) for d in docs}
    held = defaultdict(int)
    for d in docs:
        held[d["source"]] += size[d["doc_id"]]
    names = sorted(held)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, total = set(), sum(held.values())
    while True:
        open_ = [s for s in names if s not in full]
        level = (1.5 * total - sum(2 * held[s] for s in full)) / sum(weight[s] for s in open_)
        more = {s for s in open_ if 2 * held[s] <= weight[s] * level}
        if not more:
            break
        full |= more
    out = Counter()
    for d in docs:
        rate = min(2 * held[d["source"]], weight[d["source"]] * level) / held[d["source"]]
        u = int(hashlib.md5(f"{d['doc_id']}:4".encode()).hexdigest()[:13], 16) / 2**52
        out[d["doc_id"], d["text"]] = int(rate) + (u < rate - int(rate))
    return +out


def test_pipeline(spark, tmp_path):
    draw = random.Random(5)
    vocabulary = ["".join(draw.choices("abcdefghijklmnop", k=draw.randint(2, 9))) for _ in range(300)]
    often = ["the", "of", "and", "in", "to", "is"]
    say = lambda n: " ".join(draw.choice(often) if draw.random() < 0.4 else draw.choice(vocabulary) for _ in range(n))
    texts = ["\n".join(say(draw.randint(20, 60)) for _ in range(draw.randint(2, 6))) for _ in range(80)]
    texts += [texts[0], texts[1] + "\n" + say(70), texts[2].replace("the", "a", 1), "\n".join([texts[3].split("\n")[0], say(80)])]
    texts += ["!! " * 90, " ".join(f"{w.upper()}$$$ |" for w in vocabulary[:120]), "", None, "short"]
    docs = [{"doc_id": i, "text": t, "lang": "en", "source": f"s{i % 4}", "n_chars": len(t or "")} for i, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))

    left = plain_quality(docs)
    heads = brute.fuzzy_lines([(d["doc_id"], d["text"]) for d in left])
    changed = []
    for d in left:
        kept = [x for k, x in enumerate(d["text"].split("\n")) if heads.get((d["doc_id"], k), (d["doc_id"], k)) == (d["doc_id"], k)]
        if any(brute.words(x) for x in kept):
            changed.append(d | {"text": "\n".join(kept)})
    groups = brute.near([(d["doc_id"], d["text"]) for d in changed])
    want = plain_mix([d for d in changed if groups[d["doc_id"]][1] == d["doc_id"]])

    rows = corpus_pipeline.run(spark, str(tmp_path))
    assert all(r.lossless for r in rows.collect())
    got = Counter((r.doc_id, r.text) for r in pieces.decode_pieces(rows).collect())
    assert got == want and len(want) > 60


def test_null_and_repeated_ids(spark):
    """No stage loses a text for its id: rejected, repeated and linked rows are told apart by id and text."""
    draw = random.Random(6)
    vocabulary = ["".join(draw.choices("abcdefghijklmnop", k=draw.randint(2, 7))) for _ in range(100)]
    say = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    table = lambda rows: spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    after = lambda stage, rows: Counter((r.doc_id, r.text) for r in stage(spark, table(rows), "").collect())
    a, b, c, d, line = say(70), say(70), say(70), say(70), say(30)
    assert after(corpus_pipeline.quality_stage, [(None, a), (None, b), (7, c), (7, "short"), (8, d)]) == Counter([(None, a), (None, b), (7, c), (8, d)])
    rows = [(2, line), (None, f"{a}\n{line}"), (None, f"{b}\n{c}"), (5, f"{line}\n{d}"), (5, f"{d[::-1]}\n{c[::-1]}")]
    assert after(corpus_pipeline.line_stage, rows) == Counter([(2, line), (None, a), (None, f"{b}\n{c}"), (5, d), (5, f"{d[::-1]}\n{c[::-1]}")])
    rows = [(1, a), (1, b), (1, a), (1, b + " more"), (None, c), (None, c), (None, d), (None, None), (None, None), (9, d)]
    got = after(corpus_pipeline.near_stage, rows)
    assert sum(n for (i, t), n in got.items() if t in (b, b + " more")) == 1
    assert {k: n for k, n in got.items() if k[1] not in (b, b + " more")} == {(1, a): 1, (None, c): 1, (None, None): 2, (9, d): 1}


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "near-duplicate dedup", "mixing sources", "sampled pieces",
    ]


def test_entry_without_the_optional_parts(tmp_path):
    """A copy of the repository without this subpackage and its pipeline still imports and has its queries."""
    import shutil
    from pathlib import Path

    root = Path(corpus_pipeline.__file__).parent
    shutil.copytree(root / "corvane", tmp_path / "corvane", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 200 and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path), "JAVA_HOME": ""})
