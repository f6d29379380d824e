"""Documents to chunks.

One document is one row, so nothing here needs a shuffle to bring a document together: texts are split and measured
with JVM expressions, the order-dependent part of a rule sees only arrays of small integers (token counts, levels,
kinds) in an Arrow function and answers with a group number per piece, and pieces are put together again by a
``groupBy(document, group)`` that spreads a long document over many tasks.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Callable, Sequence
from html.parser import HTMLParser
from itertools import accumulate, groupby

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions import text as tx

INTS = T.ArrayType(T.IntegerType())

# Heading families, in order of preference, and lines that only look like headings.
HEADING_FAMILIES = (
    (
        r"第[零一二三四五六七八九十百0-9]+(分?编|部分)",
        r"第[零一二三四五六七八九十百0-9]+章",
        r"第[零一二三四五六七八九十百0-9]+节",
        r"第[零一二三四五六七八九十百0-9]+条",
        r"[\(（][零一二三四五六七八九十百]+[\)）]",
    ),
    (
        r"第[0-9]+章",
        r"第[0-9]+节",
        r"[0-9]{0,2}[\. 、]",
        r"[0-9]{0,2}\.[0-9]{0,2}[^a-zA-Z/%~-]",
        r"[0-9]{0,2}\.[0-9]{0,2}\.[0-9]{0,2}",
        r"[0-9]{0,2}\.[0-9]{0,2}\.[0-9]{0,2}\.[0-9]{0,2}",
    ),
    (
        r"第[零一二三四五六七八九十百0-9]+章",
        r"第[零一二三四五六七八九十百0-9]+节",
        r"[零一二三四五六七八九十百]+[ 、]",
        r"[\(（][零一二三四五六七八九十百]+[\)）]",
        r"[\(（][0-9]{0,2}[\)）]",
    ),
    (
        r"PART (ONE|TWO|THREE|FOUR|FIVE|SIX|SEVEN|EIGHT|NINE|TEN)",
        r"Chapter (I+V?|VI*|XI|IX|X)",
        r"Section [0-9]+",
        r"Article [0-9]+",
    ),
    (r"#[^#]", r"##[^#]", r"###.*", r"####.*", r"#####.*", r"######.*"),
)
FALSE_HEADING = r"^(0|[0-9]+ +[0-9~个只-]|[0-9]+\.{2,})"
CONTENTS_TITLE = r"^(contents|目录|目次|tableofcontents|致谢|acknowledge)$"
BODY = 99
SECTION_MIN_TOKENS, SECTION_MAX_TOKENS = 32, 1024
BLOCK_TAGS = frozenset(
    "h1 h2 h3 h4 h5 h6 p div article section aside ul ol li table pre code blockquote figure figcaption".split()
)


def _per_row(fn: Callable, returns: T.DataType):
    """Arrow function that maps each row's arrays with ``fn``."""

    @F.pandas_udf(returns)
    def apply(first: pd.Series, second: pd.Series) -> pd.Series:
        return pd.Series([fn(a, b) for a, b in zip(first, second)], dtype=object)

    return apply


def _groups_after(sizes, limit: float) -> list[int]:
    """Group numbers when a new group starts after the size so far has passed ``limit``."""
    out, group, total = [], 0, 0
    for i, size in enumerate(sizes):
        if i and total > limit:
            group, total = group + 1, 0
        total += size
        out.append(group)
    return out


def _groups_within(sizes, limit: float) -> list[int]:
    """Group numbers when a new group starts before the size would pass ``limit``."""
    out, group, total = [], 0, 0
    for i, size in enumerate(sizes):
        if i and total + size > limit:
            group, total = group + 1, 0
        total += size
        out.append(group)
    return out


def merge_groups(counts: Column, limit: float) -> Column:
    """Group number of each piece: pieces join until the group has passed ``limit``."""
    return _per_row(lambda sizes, _: _groups_after(sizes, limit), INTS)(counts, counts)


def pack_groups(counts: Column, limit: float) -> Column:
    """Batch number of each piece: a batch never passes ``limit`` unless one piece alone does."""
    return _per_row(lambda sizes, _: _groups_within(sizes, limit), INTS)(counts, counts)


def _counts(pieces: Column) -> Column:
    return F.transform(pieces, lambda p: F.regexp_count(p, F.lit(tx.TOKEN)))


def gather(df: DataFrame, key: str, pieces: str, groups: str, separator: str) -> DataFrame:
    """Pieces of each (document, group) joined in order: ``(key, chunk, content)``."""
    rows = df.select(key, F.posexplode(F.arrays_zip(F.col(pieces).alias("piece"), F.col(groups).alias("group"))).alias("pos", "e"))
    return (
        rows.groupBy(key, F.col("e.group").alias("chunk"))
        .agg(F.array_sort(F.collect_list(F.struct("pos", F.col("e.piece").alias("piece")))).alias("p"))
        .select(key, "chunk", F.array_join(F.transform("p", lambda e: e["piece"]), separator).alias("content"))
    )


def overlap_tails(chunks: DataFrame, key: str, percent: int) -> DataFrame:
    """Put the last ``percent`` of each chunk's characters before the next chunk of the document."""
    state = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("last"))

    def step(acc: Column, e: Column) -> Column:
        start = F.floor(F.length(acc["last"]) * (100 - percent) / 100.0).cast("int")
        text = F.concat(F.substr(acc["last"], start + 1), e["content"])
        return F.struct(F.array_append(acc["done"], text).alias("done"), text.alias("last"))

    lists = chunks.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("chunk", "content"))).alias("c"))
    texts = F.aggregate("c", state, step, lambda acc: acc["done"])
    return lists.select(key, F.posexplode(texts).alias("chunk", "content"))


def chunk_by_tokens(docs: DataFrame, size: int, overlap: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Lines merged greedily: a chunk closes once it holds more than the size less the overlap."""
    staged = docs.select(key, F.transform(F.split(text, "\n"), lambda s: F.concat(F.lit("\n"), s)).alias("pieces"))
    grouped = staged.withColumn("groups", merge_groups(_counts(F.col("pieces")), size * (100 - overlap) / 100.0))
    chunks = gather(grouped, key, "pieces", "groups", "")
    return overlap_tails(chunks, key, overlap) if overlap else chunks


def chunk_by_delimiter(docs: DataFrame, delimiters: Sequence[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """One chunk per part; the delimiter stays with the part on its left, parts are never merged."""
    return docs.select(key, F.posexplode(tx.split_keep(text, delimiters)).alias("chunk", "content"))


def chunk_text(
    docs: DataFrame, size: int, delimiters: str = "\n!?;。；！？", key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Plain text split at single delimiter characters, parts merged line by line while the chunk is not over the size."""
    pattern = "[" + "".join("\\" + c if c in "[]\\^-&" else c for c in delimiters) + "]"
    staged = docs.select(key, F.split(text, pattern, -1).alias("pieces"))
    grouped = staged.withColumn("groups", merge_groups(_counts(F.col("pieces")), size))
    return gather(grouped, key, "pieces", "groups", "\n")


def merge_adjacent(items: DataFrame, size: int, overlap: int = 0, key: str = "doc_id") -> DataFrame:
    """Merge text items of ``items(key, items array<struct<kind, text>>)``; other kinds stay alone and break runs.

    The overlap taken from the previous chunk counts in the new chunk's size.
    """
    out = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("content", T.StringType())]))
    limit, kept = size * (100 - overlap) / 100.0, (100 - overlap) / 100.0
    count = lambda s: len(re.findall(r"\w+|[^\w\s]", s))

    def packed(texts: list[str]) -> list[str]:
        """The texts of one run in chunks; sizes of pieces that join are added up, as the pieces are counted alone."""
        chunks, held = [], math.inf
        for piece in texts:
            if held > limit:
                lead = chunks[-1][int(len(chunks[-1]) * kept) :] if chunks and overlap else ""
                chunks.append(lead + piece)
                held = count(chunks[-1])
            else:
                chunks[-1] = "\n".join(s for s in (chunks[-1], piece) if s)
                held += count(piece)
        return chunks

    def merge(kinds, texts):
        rows = []
        for alone, run in groupby(zip(kinds, texts), key=lambda e: e[0] != "text"):
            rows += list(run) if alone else [("text", content) for content in packed([t for _, t in run])]
        return [{"kind": k, "content": c} for k, c in rows]

    merged = _per_row(merge, out)(
        F.transform("items", lambda i: i["kind"]), F.transform("items", lambda i: i["text"])
    )
    return items.select(key, F.posexplode(merged).alias("chunk", "e")).select(key, "chunk", "e.kind", "e.content")


def split_children(chunks: DataFrame, delimiters: Sequence[str], key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Child rows of each chunk and the distinct hidden parent rows they point to."""
    parent = tx.stable_id(F.col("content"), F.col(key))
    children = chunks.filter(F.col("content").rlike(r"\S")).select(
        key,
        parent.alias("parent_id"),
        F.col("content").alias("parent"),
        F.posexplode(tx.split_keep("content", delimiters)).alias("child", "text"),
    )
    parents = children.select("parent_id", key, F.col("parent").alias("content")).dropDuplicates(["parent_id"])
    return children.drop("parent").withColumnRenamed("text", "content"), parents.withColumn("available", F.lit(0))


def one_chunk(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The whole document as its only chunk; blank documents give none."""
    return docs.filter(F.col(text).rlike(r"\S")).select(key, F.lit(0).alias("chunk"), F.col(text).alias("content"))


def _family_pattern(family: Sequence[str]) -> str:
    return "^(" + "|".join(f"({p})" for p in family) + ")"


def family_hits(lines: Column, families: Sequence[Sequence[str]] = HEADING_FAMILIES) -> Column:
    """Number of lines that look like headings of each family."""
    trimmed = F.transform(lines, lambda s: F.trim(s))
    return F.array(*[F.size(_hits(trimmed, _family_pattern(family))) for family in families])


def _hits(trimmed: Column, pattern: str) -> Column:
    return F.filter(trimmed, lambda s: s.rlike(pattern) & ~s.rlike(FALSE_HEADING))


def bullet_family(lines: Column, families: Sequence[Sequence[str]] = HEADING_FAMILIES) -> Column:
    """Index of the family with most hits, the first one on ties, -1 without any hit."""
    hits = family_hits(lines, families)
    best = F.array_max(hits)
    return F.when(best > 0, F.array_position(hits, best).cast("int") - 1).otherwise(F.lit(-1))


def title_levels(lines: Column, family: Column, families: Sequence[Sequence[str]] = HEADING_FAMILIES) -> Column:
    """Level of each line within the chosen family, counted from 1; lines without a match are body."""

    def level(line: Column) -> Column:
        trimmed = F.trim(line)
        out = F.lit(BODY)
        for index, patterns in enumerate(families):
            within = F.lit(BODY)
            for depth, pattern in reversed(list(enumerate(patterns))):
                within = F.when(trimmed.rlike("^" + pattern), F.lit(depth + 1)).otherwise(within)
            out = F.when(family == index, within).otherwise(out)
        return F.when(trimmed.rlike(FALSE_HEADING), F.lit(BODY)).otherwise(out)

    return F.transform(lines, level)


def _split_level(levels, nth: int | None):
    """The level that starts sections: the ``nth`` of those in use, or the one used most (ties: the one seen first)."""
    titles = [level for level in levels if level < BODY]
    if nth:
        return sorted(set(titles))[:nth][-1] if titles else None
    return Counter(titles).most_common(1)[0][0] if titles else None


def _section_groups(levels, sizes, nth: int | None) -> list[int]:
    """Group of each line, -1 for lines left out. A line joins the open group while that is small, or while it is not
    full and the section is still the same."""
    head = _split_level(levels, nth)
    sections = list(accumulate(int(i > 0 and head is not None and level <= head) for i, level in enumerate(levels)))
    lines = [i for i, size in enumerate(sizes) if size >= 0]
    groups = dict.fromkeys(range(len(sizes)), -1)
    held = 0
    for before, line in zip([None, *lines], lines):
        full = SECTION_MAX_TOKENS if before is not None and sections[before] == sections[line] else SECTION_MIN_TOKENS
        opens = before is None or held >= full
        groups[line] = (0 if before is None else groups[before]) + (opens and before is not None)
        held = sizes[line] if opens else held + sizes[line]
    return [groups[i] for i in range(len(sizes))]


def _leaf_paths(levels, nth: int, with_bodies: bool) -> list[list[int]]:
    """Line numbers of each chunk: the titles above a heading, the heading, its body lines."""
    distinct = sorted({lv for lv in levels if lv < BODY})
    if not distinct:
        return [list(range(len(levels)))]
    depth = distinct[min(max(nth, 1), len(distinct)) - 1]
    above, own, body, leaf, root, open_ = {}, [], {}, {}, [], []
    for i, level in enumerate(levels):
        if level > depth:
            (body[open_[-1]] if open_ else root).append(i)
            continue
        while open_ and level <= levels[open_[-1]]:
            open_.pop()
        above[i], body[i], leaf[i] = list(open_), [], True
        if open_:
            leaf[open_[-1]] = False
        open_.append(i)
        own.append(i)
    paths = [root] if root else []
    for i in own:
        if with_bodies:
            if body[i] or leaf[i]:
                paths.append([*above[i], i, *body[i]])
        elif leaf[i]:
            paths.append([j for a in [*above[i], i] for j in (a, *body[a])])
    return paths


def _title_rows(docs: DataFrame, families, key: str, text: str) -> DataFrame:
    lines = F.split(text, "\n")
    staged = docs.select(key, lines.alias("pieces")).withColumn("family", bullet_family(F.col("pieces"), families))
    return staged.withColumn("levels", title_levels(F.col("pieces"), F.col("family"), families))


def chunk_by_titles(
    docs: DataFrame,
    mode: str = "group",
    nth: int | None = None,
    with_bodies: bool = True,
    root_as_heading: bool = False,
    families: Sequence[Sequence[str]] = HEADING_FAMILIES,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Chunks along the document's own headings.

    ``group`` cuts at the most frequent level (or the ``nth`` distinct one) and merges sections that are too small.
    ``hierarchy`` gives one chunk per heading path down to the ``nth`` level, each with the titles above it.
    """
    rows = _title_rows(docs, families, key, text)
    if mode == "group":
        sizes = F.transform("pieces", lambda s: F.when(s.rlike(r"\S"), F.regexp_count(s, F.lit(tx.TOKEN))).otherwise(-1))
        groups = _per_row(lambda levels, counts: _section_groups(list(levels), counts, nth), INTS)(F.col("levels"), sizes)
        return gather(rows.withColumn("groups", groups), key, "pieces", "groups", "\n").filter("chunk >= 0")
    paths = _per_row(lambda levels, _: _leaf_paths(list(levels), nth or 1, with_bodies), T.ArrayType(INTS))(
        F.col("levels"), F.col("levels")
    )
    chunk = rows.select(key, "pieces", F.posexplode(paths).alias("chunk", "path")).select(
        key, "chunk", F.array_join(F.transform("path", lambda i: F.get("pieces", i)), "\n").alias("content")
    )
    if not root_as_heading:
        return chunk
    roots = chunk.filter("chunk = 0").select(key, F.col("content").alias("_root"))
    counts = chunk.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return (
        chunk.join(roots, key)
        .join(counts, key)
        .filter("_n = 1 OR chunk > 0")
        .select(key, "chunk", F.when(F.col("_n") > 1, F.concat_ws("\n", "_root", "content")).otherwise(F.col("content")).alias("content"))
    )


def _after_contents(lines, english: bool) -> list[int]:
    """Numbers of the lines outside contents lists.

    A list reaches from its title over its first entry up to the next line, however far, that begins as the entry does;
    without such a line only title and entry go, and without an entry all that follows the title.
    """
    texts = [str(line).strip() for line in lines]
    begins = [" ".join(text.split()[:2]) if english else text[:3] for text in texts]
    titles = [i for i, text in enumerate(texts) if re.match(CONTENTS_TITLE, re.sub(r"[ \u3000]+", "", text).lower())]
    cut, upto = set(), 0
    for title in titles:
        if title < upto:
            continue
        entry = next((i for i in range(title + 1, len(texts)) if begins[i]), len(texts))
        again = (i for i in range(entry + 1, len(texts)) if texts[i].startswith(begins[entry]))
        upto = next(again, entry + 1) if entry < len(texts) else entry
        cut.update(range(title, upto))
    return [i for i in range(len(texts)) if i not in cut]


def drop_contents_pages(docs: DataFrame, english: bool = True, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Text without its contents list: from a contents title up to the next line that repeats the first entry."""
    lines = F.split(text, "\n")
    kept = _per_row(lambda s, _: _after_contents(s, english), INTS)(lines, lines)
    return docs.select(key, F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n").alias("content"))


class _Blocks(HTMLParser):
    """Text blocks of a page in reading order; scripts, styles and comments are skipped, tables kept as they are."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, str]] = []
        self.block = self.skip = self.table = self.body = 0
        self.parts: list[str] = []
        self.path: list[tuple[str, int]] = []
        self.number = 0

    def handle_starttag(self, tag, attrs):
        if tag == "body":
            self.body = 1
        if tag in ("script", "style"):
            self.skip += 1
        if tag == "table":
            self.table += 1
        if self.table:
            self.parts.append(f"<{tag}>")
        if tag in BLOCK_TAGS:
            self.number += 1
        self.path.append((tag, self.number if tag in BLOCK_TAGS else (self.path[-1][1] if self.path else 0)))

    def handle_endtag(self, tag):
        if self.table:
            self.parts.append(f"</{tag}>")
        if tag == "table" and self.table:
            self.table -= 1
            if not self.table:
                self.blocks.append(("table", "".join(self.parts), 0))
                self.parts = []
        if tag in ("script", "style") and self.skip:
            self.skip -= 1
        for at in range(len(self.path) - 1, -1, -1):
            if self.path[at][0] == tag:
                del self.path[at:]
                break

    def handle_data(self, data):
        text = data.strip()
        if self.skip or not self.body or not text:
            return
        if self.table:
            self.parts.append(text)
            return
        tag, block = self.path[-1] if self.path else ("", 0)
        mark = "#" * int(tag[1]) + " " if re.fullmatch("h[1-6]", tag) else ""
        self.blocks.append(("text", mark + text if block else text, block))


def _page_blocks(html: str) -> tuple[list[str], list[str]]:
    parser = _Blocks()
    parser.feed(html or "")
    parser.close()
    texts, tables, last = [], [], None
    for kind, content, block in parser.blocks:
        if kind == "table":
            tables.append(content)
        elif texts and (block == last or not block):
            texts[-1] += " " + content
        else:
            texts.append(content)
            last = block
    return texts, tables


def html_to_sections(pages: DataFrame, size: int = 512, key: str = "page_id", html: str = "html") -> DataFrame:
    """Page text in chunks of at most ``size`` words; a longer block is cut by words, tables follow whole."""

    def blocks(batches):
        for batch in batches:
            found = [_page_blocks(s) for s in batch[html]]
            yield pd.DataFrame({key: batch[key], "texts": [f[0] for f in found], "tables": [f[1] for f in found]})

    kind = pages.schema[key].dataType.simpleString()
    staged = pages.select(key, html).mapInPandas(blocks, f"{key} {kind}, texts array<string>, tables array<string>")
    words = lambda s: F.size(tx.words(s))
    # a slice of a longer block counts as full, so it stays alone and the next block starts afresh
    piece = lambda text, n: F.struct(text.alias("text"), n.cast("int").alias("n"))
    cut = F.flatten(
        F.transform(
            "texts",
            lambda s: F.when(words(s) <= size, F.array(piece(s, words(s)))).otherwise(
                F.transform(
                    F.sequence(F.lit(0), F.floor((F.greatest(words(s), F.lit(1)) - 1) / size).cast("int")),
                    lambda n: piece(F.array_join(F.slice(tx.words(s), n * size + 1, F.lit(size)), " "), F.lit(size)),
                )
            ),
        )
    )
    pieces = staged.select(key, cut.alias("cut"), "tables")
    pieces = pieces.select(key, F.col("cut.text").alias("pieces"), F.col("cut.n").alias("sizes"), "tables")
    counted = pieces.withColumn("groups", pack_groups(F.col("sizes"), size))
    chunks = gather(counted, key, "pieces", "groups", "\n")
    tables = staged.select(key, F.posexplode("tables").alias("chunk", "content")).withColumn("kind", F.lit("table"))
    return chunks.withColumn("kind", F.lit("text")).unionByName(tables)


def html_tables(pages: DataFrame, size: int = 512, key: str = "page_id", html: str = "html") -> DataFrame:
    """Tables of a page cut by rows under ``size`` words."""
    tables = pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(r"(?is)<table\b.*?</table>"), F.lit(0))).alias("table", "t"))
    rows = tables.select(
        key, "table", F.struct(key, "table").alias("_k"), F.regexp_extract_all("t", F.lit(r"(?is)<tr\b.*?</tr>"), F.lit(0)).alias("pieces")
    )
    counted = rows.withColumn("groups", pack_groups(F.transform("pieces", lambda s: F.size(tx.words(s))), size))
    return gather(counted, "_k", "pieces", "groups", "").select(
        f"_k.{key}", "_k.table", "chunk", F.concat(F.lit("<table>"), "content", F.lit("</table>")).alias("content")
    )


def _json_rows(value) -> list[tuple[tuple[str, ...], object]]:
    """``(path, leaf)`` rows of a JSON value in order; list places are keys, empty containers are leaves."""
    rows, todo = [], [((), value)]
    while todo:
        path, node = todo.pop()
        inner = enumerate(node) if isinstance(node, list) else node.items() if isinstance(node, dict) else ()
        below = [((*path, str(key)), child) for key, child in inner]
        if below:
            todo.extend(reversed(below))
        else:
            rows.append((path, node))
    return rows


def _json_nested(rows: list, depth: int = 0) -> dict:
    """The object that holds the leaves of consecutive rows at their paths."""
    out = {}
    for key, run in groupby(rows, key=lambda row: row[0][depth]):
        run = list(run)
        out[key] = run[0][1] if len(run[0][0]) == depth + 1 else _json_nested(run, depth + 1)
    return out


def _json_pack(rows: list, most: int, least: int) -> list[str]:
    """JSON texts of consecutive rows, packed by size.

    What moves as one is the largest subtree of at most ``most - least`` characters, or a single leaf, so a text that is
    closed for want of room has ``least`` characters.
    """
    sizes = [len(json.dumps(leaf, ensure_ascii=False)) + sum(len(key) + 4 for key in path) for path, leaf in rows]
    upto = [0, *accumulate(sizes)]
    units, todo = [], [(0, len(rows), 0)]
    while todo:
        first, last, depth = todo.pop()
        if upto[last] - upto[first] <= most - least and depth or last - first == 1:
            units.append((first, last))
            continue
        runs = [list(run) for _, run in groupby(range(first, last), key=lambda i: rows[i][0][depth])]
        todo.extend((run[0], run[-1] + 1, depth + 1) for run in reversed(runs))
    groups = _groups_within([upto[b] - upto[a] for a, b in units], most)
    packs = [[units[i] for i in run] for _, run in groupby(range(len(units)), key=lambda i: groups[i])]
    return [json.dumps(_json_nested(rows[pack[0][0] : pack[-1][1]]), ensure_ascii=False) for pack in packs]


def _json_chunks(text: str | None, most: int, least: int) -> list[str]:
    """Texts of one JSON value, or of each line that is one if at least four lines in five are."""
    values = []
    for part in ([text], [line for line in (text or "").splitlines() if line.strip()]):
        values = []
        for candidate in part:
            try:
                values.append(json.loads(candidate))
            except (TypeError, ValueError):
                pass
        if values and 5 * len(values) >= 4 * len(part):
            break
        values = []
    rows = ([row for row in _json_rows(value) if row[0]] for value in values)
    return [chunk for some in rows if some for chunk in _json_pack(some, most, least)]


def json_to_chunks(docs: DataFrame, size: int = 2000, least: int | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """JSON or JSON-lines documents cut into smaller JSON texts that keep the nesting; lists become index-keyed maps."""
    floor = max(size - 200, 50) if least is None else least
    parts = _per_row(lambda s, _: _json_chunks(s, size * 2, floor), T.ArrayType(T.StringType()))
    return docs.select(key, F.posexplode(parts(F.col(text), F.col(text))).alias("chunk", "content"))


# Line kinds of a Markdown text.
BLANK, HEADER, FENCE, LIST, QUOTE, TABLE, PLAIN = range(7)


def _markdown_groups(kinds, sizes) -> list[int]:
    """Element number of each line, -1 for separating blank lines; a short header joins what follows."""
    out, group, state = [], -1, None
    for kind, size in zip(kinds, sizes):
        if state == FENCE:
            out.append(group)
            state = None if kind == FENCE else FENCE
            continue
        if kind == BLANK:
            out.append(-1)
            state = HEADER if state == HEADER else None
            continue
        follows = state == HEADER or (kind == state and kind != HEADER) or (state == LIST and kind == PLAIN and size < 0)
        if not follows or (state == HEADER and kind == HEADER):
            group += 1
        out.append(group)
        state = HEADER if kind == HEADER and abs(size) <= 32 else kind if kind != HEADER else None
    return out


def markdown_elements(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Headers, fenced code, lists, quotes, tables and paragraphs of a Markdown text, each kept whole.

    A header joins the element that follows it.
    """
    kind = lambda s: (
        F.when(~s.rlike(r"\S"), BLANK)
        .when(s.rlike(r"^#{1,6}\s+.*$"), HEADER)
        .when(s.rlike(r"^\s*(```|~~~)"), FENCE)
        .when(s.rlike(r"^\s*([-*+]|\d+\.)\s+.*$"), LIST)
        .when(s.rlike(r"^\s*>"), QUOTE)
        .when(s.rlike(r"^\s*\|.*\|\s*$"), TABLE)
        .otherwise(PLAIN)
    )
    signed = lambda s: F.when(s.rlike(r"^\s"), -1).otherwise(1) * F.greatest(F.regexp_count(s, F.lit(tx.TOKEN)), F.lit(1))
    staged = docs.select(key, F.split(text, "\n").alias("pieces"))
    groups = _per_row(_markdown_groups, INTS)(F.transform("pieces", kind), F.transform("pieces", signed))
    return gather(staged.withColumn("groups", groups), key, "pieces", "groups", "\n").filter("chunk >= 0")


def _media_context(kinds, texts, need: int) -> list[dict]:
    split = re.compile(r"(?<=[。!?？；！\n])|(?<=\. )")
    count = lambda s: len(re.findall(r"\w+|[^\w\s]", s))

    def take(order, from_end):
        left, got = need, []
        for i in order:
            if left <= 0:
                break
            if kinds[i] != "text":
                continue
            whole = count(texts[i])
            if whole < left:
                got.append(texts[i])
                left -= whole
                continue
            sentences = [s for s in split.split(texts[i]) if s]
            picked = []
            for s in reversed(sentences) if from_end else sentences:
                if left <= 0:
                    break
                picked.append(s)
                left -= count(s)
            got.append("".join(reversed(picked) if from_end else picked))
            left = 0
        return "".join(reversed(got) if from_end else got)

    return [
        {"above": take(range(i - 1, -1, -1), True), "below": take(range(i + 1, len(kinds)), False)}
        if kind != "text" else {"above": "", "below": ""}
        for i, kind in enumerate(kinds)
    ]


def media_context(items: DataFrame, tokens: int, key: str = "doc_id") -> DataFrame:
    """Surround each table or image item with about ``tokens`` tokens of whole neighbouring sentences."""
    out = T.ArrayType(T.StructType([T.StructField("above", T.StringType()), T.StructField("below", T.StringType())]))
    around = _per_row(lambda kinds, texts: _media_context(list(kinds), list(texts), tokens), out)(
        F.transform("items", lambda i: i["kind"]), F.transform("items", lambda i: i["text"])
    )
    zipped = F.zip_with("items", around, lambda i, c: F.struct(i["kind"].alias("kind"), c["above"].alias("above"), i["text"].alias("text"), c["below"].alias("below")))
    return items.select(key, F.posexplode(zipped).alias("pos", "e")).select(key, "pos", "e.*")
