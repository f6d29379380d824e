"""Numeric, date, JSON and vector functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def get_float(value: Column) -> Column:
    """Number of a text; anything that is no number is minus infinity."""
    return F.coalesce(value.cast("string").try_cast("double"), F.lit(float("-inf")))


def clamp_overlap(value: Column) -> Column:
    """Overlap percent in 0..90; a fraction below one is read as a share; no number is 0."""
    number = F.coalesce(value.cast("string").try_cast("double"), F.lit(0.0))
    percent = F.when((number > 0) & (number < 1), number * 100).otherwise(number)
    return F.least(F.greatest(percent, F.lit(0.0)), F.lit(90.0)).cast("int")


def iso_to_timestamp(text: Column) -> Column:
    """ISO-8601 text to a timestamp, null when it is none."""
    return text.try_cast("timestamp")


def parse_datetime_any(text: Column) -> Column:
    """Date-time text in ISO form with any offset spelling (``Z``, ``+0000``, ``+5``) to a UTC timestamp."""
    plain = F.trim(text)
    zone = F.regexp_extract(plain, r"(?<=\d)([+-])(\d{1,2}):?(\d{2})?$", 0)
    has_time = plain.rlike(r"\d:\d")
    sign = F.substring(zone, 1, 1)
    digits = F.replace(F.substring(zone, 2, 5), F.lit(":"), F.lit(""))
    long = F.length(digits) >= 3
    hours = F.lpad(F.when(long, F.regexp_extract(digits, r"^(\d+)\d{2}$", 1)).otherwise(digits), 2, "0")
    minutes = F.when(long, F.right(digits, F.lit(2))).otherwise(F.lit("00"))
    body = F.regexp_replace(plain, r"(?<=\d)[+-]\d{1,2}:?(\d{2})?$", "")
    shifted = F.concat(body, sign, hours, F.lit(":"), minutes)
    text_out = F.when((zone != "") & has_time, shifted).otherwise(plain)
    return text_out.try_cast("timestamp")


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x
    )


def norm(a: Column) -> Column:
    """Euclidean length."""
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; 0 for a zero vector or unequal dimensions."""
    length = norm(a) * norm(b)
    return F.when((F.size(a) == F.size(b)) & (length > 0), dot(a, b) / length).otherwise(F.lit(0.0))


def blend_vectors(title: Column, body: Column, weight: float = 0.1) -> Column:
    """``weight`` of the title vector plus the rest of the body vector; the body alone when shapes differ."""
    mixed = F.zip_with(title, body, lambda t, b: t.cast("double") * weight + b.cast("double") * (1 - weight))
    return F.when(F.size(title) == F.size(body), mixed).otherwise(F.transform(body, lambda b: b.cast("double")))


def fixed_dimension(vector: Column, dim: int) -> Column:
    """The vector, or zeros when its dimension differs from ``dim``."""
    return F.when(F.size(vector) == dim, vector).otherwise(F.array_repeat(F.lit(0.0).cast("float"), dim))


def parse_tag_features(text: Column) -> Column:
    """JSON (or single-quoted literal) map to tag → score, keeping finite numbers under non-blank names."""
    as_map = "map<string,variant>"
    raw = F.coalesce(F.from_json(text, as_map), F.from_json(F.replace(text, F.lit("'"), F.lit('"')), as_map))
    numeric = F.map_filter(raw, lambda k, v: F.schema_of_variant(v).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"))
    scores = F.transform(
        F.map_entries(numeric),
        lambda e: F.struct(F.trim(e["key"]).alias("key"), F.try_variant_get(e["value"], "$", "double").alias("value")),
    )
    finite = F.filter(scores, lambda e: (e["key"] != "") & ~F.isnan(e["value"]) & (F.abs(e["value"]) < float("inf")))
    return F.coalesce(F.map_from_entries(finite), F.create_map().cast("map<string,double>"))


def literal_value(text: Column) -> Column:
    """Text that looks like a literal to a typed nested value (Variant); other text becomes a string value."""
    as_json = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"\bTrue\b", "true"), r"\bFalse\b", "false"), r"\bNone\b", "null")
    return F.coalesce(
        F.try_parse_json(as_json),
        F.try_parse_json(F.replace(as_json, F.lit("'"), F.lit('"'))),
        F.try_parse_json(F.to_json(F.array(text))),
    )


def record_value(value: Column, path: str, as_type: str = "string") -> Column:
    """Dotted path into a JSON text; null when any step is missing."""
    steps = "".join(f"[{s}]" if s.isdigit() else f".{s}" for s in path.split("."))
    return F.try_variant_get(F.try_parse_json(value), "$" + steps, as_type)


# Words read as yes and no in table cells.
YES_WORDS = r"^(?i)(true|yes|是|\*|✓|✔|☑|✅|√)$"
NO_WORDS = r"^(?i)(false|no|否|⍻|×)$"


def typed_cell(value: Column, kind: str) -> Column:
    """A table cell as ``int``, ``float``, ``datetime``, ``bool`` (yes/no text) or ``text``; null when it does not fit."""
    plain = F.trim(value.cast("string"))
    if kind == "int":
        return plain.try_cast("bigint")
    if kind == "float":
        return plain.try_cast("double")
    if kind == "datetime":
        return F.date_format(plain.try_cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss")
    if kind == "bool":
        return F.when(plain.rlike(YES_WORDS), "yes").when(plain.rlike(NO_WORDS), "no")
    return value.cast("string")
