"""Text functions as Column expressions; every one stays inside JVM expressions unless its docstring says otherwise."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Token, script and markup patterns, and the query stop phrases.
WORD = r"[\p{L}\p{N}_]+"
TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"
SENTENCE_END = r"[.!?;\n]+"
TABLE_TAG = r"</?(table|td|caption|tr|th)( [^<>]{0,12})?>"
ENGLISH_CHARACTER = r"[`a-zA-Z0-9.,':;/\"?<>!()\-]"
CJK_CHARACTER = r"[\x{4e00}-\x{9fff}]"
QUERY_PUNCTUATION = r"[ :|\r\n\t,，。？?/`!！&^%()\[\]{}<>*~'\"\\]+"
CJK_QUESTION_WORDS = (
    "是*(怎么办|什么样的|哪家|一下|那家|请问|啥样|咋样了|什么时候|何时|何地|何人|是否|是不是|多少|哪里|怎么|哪儿|怎么样|"
    "如何|哪些|是啥|啥是|啊|吗|呢|吧|咋|什么|有没有|呀|谁|哪位|哪个)是*"
)
QUESTION_WORDS = r"(^| )(what|who|how|which|where|why)('re|'s)? "
FILLER_WORDS = (
    r"(^| )('s|'re|is|are|were|was|do|does|did|don't|doesn't|didn't|has|have|be|there|you|me|your|my|mine|just|please|"
    r"may|i|should|would|wouldn't|will|won't|done|go|for|with|so|the|a|an|by|i'm|it's|he's|she's|they|they're|you're|"
    r"as|on|in|at|up|out|down|of|to|or|and|if) "
)
QA_PREFIX = r"^(问题|答案|回答|user|assistant|Q|A|Question|Answer|问|答)[\t:： ]+"
VALUE_SEPARATOR = r"[、,，;；|]+"
KEYWORD_SEPARATOR = r"[,，;；、\r\n]+"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def words(text: Column | str) -> Column:
    """Lower-case word tokens in reading order."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(WORD), F.lit(0))


def fine_words(text: Column | str) -> Column:
    """Sub-tokens: CJK runs become overlapping character pairs, other words split between letters and digits."""
    pieces = F.regexp_extract_all(
        F.lower(_c(text)), F.lit(r"[\x{4e00}-\x{9fff}]+|[\p{L}&&[^\x{4e00}-\x{9fff}]]+|\p{N}+"), F.lit(0)
    )
    return F.flatten(
        F.transform(
            pieces,
            lambda piece: F.when(
                piece.rlike(r"^[\x{4e00}-\x{9fff}]{2,}$"),
                F.regexp_extract_all(piece, F.lit("(?=(..))"), F.lit(1)),
            ).otherwise(F.array(piece)),
        )
    )


def tokens(text: Column | str) -> Column:
    """Budget tokens: each word and each single punctuation mark."""
    return F.regexp_extract_all(_c(text), F.lit(TOKEN), F.lit(0))


def token_count(text: Column | str) -> Column:
    """Number of budget tokens; every budget operator takes such a count as a column."""
    return F.regexp_count(_c(text), F.lit(TOKEN)).cast("bigint")


def truncate_tokens(text: Column | str, n: int | Column) -> Column:
    """The first ``n`` budget tokens, joined by one blank."""
    limit = F.lit(n) if isinstance(n, int) else n
    return F.array_join(F.slice(tokens(text), F.lit(1), limit), " ")


def split_on(text: Column | str, delimiters: Sequence[str]) -> Column:
    """Split at any delimiter, dropping the delimiters and blank parts."""
    pattern = "|".join(_quote(d) for d in sorted(delimiters, key=len, reverse=True))
    return F.filter(F.split(_c(text), pattern), lambda part: part.rlike(r"\S"))


def split_keep(text: Column | str, delimiters: Sequence[str]) -> Column:
    """Split after any delimiter; the delimiter stays with the part on its left, blank parts are dropped."""
    pattern = "|".join(f"(?<={_quote(d)})" for d in sorted(delimiters, key=len, reverse=True))
    return F.filter(F.split(_c(text), pattern), lambda part: part.rlike(r"\S"))


def _quote(literal: str) -> str:
    return "".join("\\" + ch if ch in r"\.[]{}()*+-?^$|" else ch for ch in literal)


def render(template: str, values: dict[str, Column], delimiter: str = ",") -> Column:
    """Put named column values into ``{name}`` places; array values are joined by ``delimiter``."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def strip_table_tags(text: Column | str) -> Column:
    """Table markup becomes blanks."""
    return F.regexp_replace(_c(text), TABLE_TAG, " ")


def embed_text(questions: Column, content: Column) -> Column:
    """Text handed to an embedding model: joined questions if any, else the content, without table markup."""
    chosen = F.when(F.size(F.coalesce(questions, F.array().cast("array<string>"))) > 0, F.array_join(questions, "\n")).otherwise(
        F.coalesce(content, F.lit(""))
    )
    clean = strip_table_tags(chosen)
    return F.when(clean.rlike(r"\S"), clean).otherwise(F.lit("None"))


def embed_title(title: Column) -> Column:
    """Title handed to an embedding model, with the fixed stand-in for a missing one."""
    return F.when(title.isNotNull() & (title != ""), title).otherwise(F.lit("Title"))


def remove_redundant_spaces(text: Column | str) -> Column:
    """Drop blanks after opening marks and before closing marks."""
    opened = F.regexp_replace(_c(text), r"(?i)([^a-z0-9.,\)>]) +([^ ])", "$1$2")
    return F.regexp_replace(opened, r"(?i)([^ ]) +([^a-z0-9.,\(<])", "$1$2")


def unescape_html(text: Column | str) -> Column:
    """The named entities that occur in generated markup; ``&amp;`` goes last so that nothing is unescaped twice."""
    out = _c(text)
    for entity, character in (
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&quot;", '"'),
        ("&#39;", "'"),
        ("&nbsp;", "\u00a0"),
        ("&middot;", "·"),
        ("&copy;", "©"),
        ("&amp;", "&"),
    ):
        out = F.replace(out, F.lit(entity), F.lit(character))
    return out


def clean_name(text: Column | str) -> Column:
    """Trim, unescape markup entities, then drop double quotes and control characters."""
    return F.regexp_replace(unescape_html(F.trim(_c(text))), r"[\"\x00-\x1f\x7f-\x9f]", "")


def halfwidth(text: Column | str) -> Column:
    """Full-width ASCII forms to their plain forms."""
    wide = "".join(chr(code) for code in range(0xFF01, 0xFF5F)) + "\u3000"
    plain = "".join(chr(code) for code in range(0x21, 0x7F)) + " "
    return F.translate(_c(text), wide, plain)


def space_between_scripts(text: Column | str) -> Column:
    """A blank at each boundary of Latin and CJK text."""
    han = "[\\x{4e00}-\\x{9fa5}]"
    spaced = F.regexp_replace(_c(text), f"([A-Za-z]+[0-9]*)({han})", "$1 $2")
    return F.regexp_replace(spaced, f"({han})([A-Za-z])", "$1 $2")


def strip_question_words(text: Column | str) -> Column:
    """Remove question and filler words; a text made of nothing else stays as it is."""
    source = _c(text)
    out = F.regexp_replace(source, CJK_QUESTION_WORDS, "")
    out = F.regexp_replace(out, "(?i)" + QUESTION_WORDS, " ")
    out = F.regexp_replace(out, "(?i)" + FILLER_WORDS, " ")
    return F.when(out == "", source).otherwise(out)


def normalize_query(text: Column | str) -> Column:
    """Question text ready for tokenising."""
    plain = halfwidth(F.lower(space_between_scripts(text)))
    return strip_question_words(F.trim(F.regexp_replace(plain, QUERY_PUNCTUATION, " ")))


def is_english(text: Column | str) -> Column:
    """More than 80 % of all characters are in the ASCII prose set; blanks count in the total only."""
    source = _c(text)
    share = F.regexp_count(source, F.lit(ENGLISH_CHARACTER)) / F.length(source)
    return F.coalesce(F.length(source) > 0, F.lit(False)) & F.coalesce(share > 0.8, F.lit(False))


def all_english(texts: Column) -> Column:
    """More than 80 % of the non-blank elements are wholly ASCII prose."""
    kept = F.filter(texts, lambda t: t.rlike(r"\S"))
    plain = F.filter(kept, lambda t: F.trim(t).rlike(r"^[`a-zA-Z0-9\s.,':;/\"?<>!()\-]+$"))
    return F.when(F.size(kept) > 0, F.size(plain) / F.size(kept) > 0.8).otherwise(F.lit(False))


def is_cjk(text: Column | str) -> Column:
    """More than 20 % of the characters are CJK ideographs."""
    source = _c(text)
    return F.when(F.length(source) > 0, F.regexp_count(source, F.lit(CJK_CHARACTER)) / F.length(source) > 0.2).otherwise(
        F.lit(False)
    )


def is_cjk_query(text: Column | str) -> Column:
    """Queries of at most three words, or with 70 % of words not purely Latin, take the CJK form."""
    parts = F.split(_c(text), r"[ \t]+")
    foreign = F.filter(parts, lambda part: ~part.rlike("^[a-zA-Z]+$"))
    return (F.size(parts) <= 3) | (F.size(foreign) / F.size(parts) >= 0.7)


def has_qa_prefix(text: Column | str) -> Column:
    """Whether a line starts with a question or answer marker."""
    return F.trim(_c(text)).rlike("(?i)" + QA_PREFIX)


def strip_qa_prefix(text: Column | str) -> Column:
    """Remove a leading question or answer marker."""
    return F.regexp_replace(F.trim(_c(text)), "(?i)" + QA_PREFIX, "")


def arabic_digits(text: Column | str) -> Column:
    """Arabic-Indic and Persian digits to ASCII digits."""
    return F.translate(_c(text), "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹", "01234567890123456789")


@F.pandas_udf(T.StringType())
def compatibility_form(text: pd.Series) -> pd.Series:
    """Unicode NFKC for texts with Arabic presentation forms; others pass unchanged (Arrow batches)."""
    marked = text.str.contains("[\ufb50-\ufdff\ufe70-\ufeff]", regex=True, na=False)
    return text.where(~marked, text.str.normalize("NFKC"))


def split_values(text: Column | str) -> Column:
    """Multi-valued text to trimmed distinct values in first-seen order."""
    parts = F.transform(F.split(F.trim(_c(text)), VALUE_SEPARATOR), lambda part: F.trim(part))
    return F.array_distinct(F.filter(parts, lambda part: part != ""))


def split_keywords(text: Column | str) -> Column:
    """Keywords out of a model response column."""
    parts = F.transform(F.split(_c(text), KEYWORD_SEPARATOR), lambda part: F.trim(part))
    return F.filter(parts, lambda part: part != "")


def sentences(text: Column | str) -> Column:
    """Non-blank sentences in reading order."""
    parts = F.transform(F.split(_c(text), SENTENCE_END), lambda part: F.trim(part))
    return F.filter(parts, lambda part: part != "")


def highlight(text: Column | str, keywords: Sequence[str]) -> Column:
    """Sentences that hold a keyword, with the hits marked, joined by ``...``; the plain text when there is none.

    English sentences mark whole words, others any occurrence (longest keyword first).
    """
    flat = F.regexp_replace(_c(text), r"[\r\n]", " ")
    parts = F.filter(F.transform(F.split(flat, r"[.?!;]"), lambda s: F.trim(s)), lambda s: s != "")
    edge = r"[ .?/'\"\(\)!,:;-]"

    def mark(sentence: Column) -> Column:
        english, other = sentence, sentence
        for word in keywords:
            english = F.regexp_replace(
                english, f"(?i)(^|{edge})({_quote(word)})({edge}|$)", "$1<em>$2</em>$3"
            )
        for word in sorted(keywords, key=len, reverse=True):
            other = F.regexp_replace(other, f"(?i){_quote(word)}", f"<em>{word}</em>")
        return F.when(is_english(sentence), english).otherwise(other)

    hits = F.filter(F.transform(parts, mark), lambda s: s.rlike("<em>[^<>]+</em>"))
    return F.when(F.size(hits) > 0, F.array_join(hits, "...")).otherwise(flat)


def stable_id(*parts: Column) -> Column:
    """Content-derived id: md5 over the parts with a separator that cannot occur in them."""
    return F.md5(F.concat_ws("\u0001", *[p.cast("string") for p in parts]))


def counted(tokens: Column | str) -> Column:
    """Distinct tokens of an array with their number, as ``array<struct<token, n>>`` in token order.

    Runs of the sorted array are counted in the row itself, so no shuffle brings equal tokens of a row together. Each
    array is bound once, as the variable of a lambda over a list of one.
    """
    let = lambda value, body: F.get(F.transform(F.array(value), body), F.lit(0))

    def runs(s: Column) -> Column:
        opens = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        ends = lambda b, j: F.coalesce(F.get(b, j + 1), F.size(s))
        return let(opens, lambda b: F.transform(b, lambda at, j: F.struct(F.get(s, at).alias("token"), (ends(b, j) - at).alias("n"))))

    full = F.when(F.size(tokens) > 0, F.sort_array(tokens))
    none = F.array().cast("array<struct<token:string,n:int>>")
    return F.coalesce(let(full, lambda s: F.when(s.isNotNull(), runs(s))), none)
