"""Filters: chunk conditions, dynamic metadata, JSON paths, records, routing."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import text as tx

# Accepted spellings of the comparison operators, and extensions read as tables.
OPERATOR_ALIASES = {"is": "=", "not is": "≠", ">=": "≥", "<=": "≤", "!=": "≠"}
STRUCTURED_EXTENSIONS = (".xls", ".xlsx", ".xlsm", ".xlsb", ".csv", ".tsv")

NUMBER_LITERAL = r"^[+-]?(0|[1-9]\d*|\d*\.\d+|\d+\.\d*)([eE][+-]?\d+)?$"
DATE_LITERAL = r"^\d{4}-\d{2}-\d{2}$"


def _all(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def is_available(column: Column) -> Column:
    """A chunk without the flag is available."""
    return F.coalesce(column, F.lit(1)) >= 1


def chunk_filter(condition: Mapping[str, Any], array_columns: Sequence[str] = ()) -> Column:
    """Conjunction of equality and membership tests; empty values are ignored, ``available`` treats null as 1.

    ``exists`` / ``must_not_exist`` name one column that must / must not be null.
    """
    parts = []
    for name, value in condition.items():
        if name == "available":
            parts.append(is_available(F.col(name)) if value else ~is_available(F.col(name)))
        elif name == "exists":
            parts.append(F.col(value).isNotNull())
        elif name == "must_not_exist":
            parts.append(F.col(value).isNull())
        elif not value:
            continue
        elif name in array_columns:
            wanted = value if isinstance(value, (list, tuple)) else [value]
            parts.append(F.arrays_overlap(F.col(name), F.array(*[F.lit(v) for v in wanted])))
        elif isinstance(value, (list, tuple)):
            parts.append(F.col(name).isin(*value))
        else:
            parts.append(F.col(name) == value)
    return _all(parts)


def _compare(left: Column, op: str, right: Column) -> Column:
    return {
        "=": left == right,
        "≠": left != right,
        ">": left > right,
        "<": left < right,
        "≥": left >= right,
        "≤": left <= right,
    }[op]


def value_matches(value: Column, op: str, wanted: Any) -> Column:
    """One metadata value against one condition.

    Comparisons are by date when the wanted value is a date (other values then never match), by number when both
    sides are number literals, by lower-cased text when neither is; mixed kinds match ``≠`` only.
    """
    op = OPERATOR_ALIASES.get(op, op)
    if op in ("=", "≠", ">", "<", "≥", "≤"):
        wanted_text = str(wanted).strip()
        trimmed = F.trim(value)
        if re.match(DATE_LITERAL, wanted_text):
            return F.when(trimmed.rlike(DATE_LITERAL), _compare(trimmed, op, F.lit(wanted_text))).otherwise(F.lit(False))
        numeric = trimmed.rlike(NUMBER_LITERAL)
        mixed = F.lit(op == "≠")
        if re.match(NUMBER_LITERAL, wanted_text):
            same = _compare(trimmed.try_cast("double"), op, F.lit(float(wanted_text)))
            return F.when(numeric, same).otherwise(mixed)
        return F.when(numeric, mixed).otherwise(_compare(F.lower(value), op, F.lit(str(wanted).lower())))
    low = F.lower(value)
    if op in ("in", "not in"):
        if isinstance(wanted, (list, tuple)):
            inside = low.isin(*[str(w).lower() for w in wanted])
        else:
            inside = F.instr(F.lit(str(wanted).lower()), low) > 0
        return inside if op == "in" else ~inside
    if op == "empty":
        return value == ""
    if op == "not empty":
        return value != ""
    if isinstance(wanted, (list, tuple)):
        return F.lit(False)
    text = F.lit(str(wanted).lower())
    if op == "contains":
        return F.contains(low, text)
    if op == "not contains":
        return ~F.contains(low, text)
    if op == "start with":
        return F.startswith(low, text)
    if op == "end with":
        return F.endswith(low, text)
    return F.lit(False)


def meta_filter(meta: DataFrame, filters: Sequence[Mapping[str, Any]], logic: str = "and") -> DataFrame:
    """Document ids whose long metadata ``(doc_id, key, value)`` satisfies the filters.

    A filter holds for a document when any of its values under the key matches, so an absent key matches nothing.
    One scan and one partially aggregated shuffle serve all filters.
    """
    flags = [
        F.max((F.col("key") == f["key"]) & value_matches(F.col("value"), f["op"], f.get("value", ""))).alias(f"f{i}")
        for i, f in enumerate(filters)
    ]
    columns = [F.col(f"f{i}") for i in range(len(filters))]
    keep = _any(columns) if logic == "or" else _all(columns)
    wanted = sorted({f["key"] for f in filters})
    return meta.filter(F.col("key").isin(*wanted)).groupBy("doc_id").agg(*flags).filter(keep).select("doc_id")


def metadata_scope(
    meta: DataFrame, filters: Sequence[Mapping[str, Any]], logic: str = "and", base_ids: DataFrame | None = None
) -> DataFrame | None:
    """Documents a search may see: ``base_ids`` extended by the filter's matches.

    ``None`` means no restriction. Filters without any match give an empty table, which matches nothing.
    """
    if not filters:
        return base_ids
    found = meta_filter(meta, filters, logic)
    return found if base_ids is None else base_ids.select("doc_id").union(found).distinct()


def restrict(df: DataFrame, scope: DataFrame | None) -> DataFrame:
    """Rows of the documents in ``scope``; all rows when there is no scope."""
    return df if scope is None else df.join(scope, "doc_id", "left_semi")


def json_condition(document: Column, name: str, op: str, value: Any) -> Column:
    """One condition on a field of a JSON text; number operators compare decimals, ``before``/``after`` times."""
    field = F.get_json_object(document, f"$.{name}")
    if op == "is":
        return field == str(value)
    if op == "is not":
        return field != str(value)
    if op == "contains":
        members = F.from_json(field, "array<string>")
        return F.coalesce(F.array_contains(members, str(value)), field == str(value))
    if op == "not contains":
        return ~json_condition(document, name, "contains", value)
    if op == "start with":
        return F.startswith(field, F.lit(str(value)))
    if op == "end with":
        return F.endswith(field, F.lit(str(value)))
    blank = field.isNull() | field.isin("", "[]", "{}")
    if op == "empty":
        return blank
    if op == "not empty":
        return ~blank
    if op in ("before", "after"):
        moment = field.try_cast("timestamp_ntz")
        bound = F.lit(str(value)).cast("timestamp_ntz")
        return moment < bound if op == "before" else moment > bound
    if op in ("=", "≠", ">", "<", "≥", "≤"):
        return _compare(field.try_cast("decimal(20,10)"), op, F.lit(str(value)).cast("decimal(20,10)"))
    raise ValueError(f"unknown operator {op}")


def json_filter(
    df: DataFrame, column: str, conditions: Sequence[Mapping[str, Any]], logic: str = "and"
) -> DataFrame:
    """Rows whose JSON column satisfies the conditions; a condition on a missing field is not satisfied."""
    tests = [F.coalesce(json_condition(F.col(column), c["name"], c["op"], c.get("value")), F.lit(False)) for c in conditions]
    if not tests:
        return df
    if logic not in ("and", "or"):
        raise ValueError("logic is 'and' or 'or'")
    return df.filter(_all(tests) if logic == "and" else _any(tests))


def record_rule(record: Column, rule: Mapping[str, Any]) -> Column:
    """One rule on a ``map<string,string>`` record: case-sensitive text test; a missing key fails."""
    held = F.element_at(record, rule["key"])
    text, wanted = F.coalesce(held, F.lit("")), F.lit("" if rule.get("value") is None else str(rule["value"]))
    test = {
        "=": text == wanted,
        "≠": text != wanted,
        "contains": F.contains(text, wanted),
        "start with": F.startswith(text, wanted),
        "end with": F.endswith(text, wanted),
    }.get(rule.get("op", "="), F.lit(False))
    return F.map_contains_key(record, rule["key"]) & test


def filter_values(df: DataFrame, record: str, rules: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Records that satisfy every rule."""
    return df.filter(_all(record_rule(F.col(record), r) for r in rules))


def select_keys(record: Column, keys: Sequence[str]) -> Column:
    """Keep the named keys of a map record."""
    return F.map_filter(record, lambda k, v: k.isin(*keys))


def remove_keys(record: Column, keys: Sequence[str]) -> Column:
    """Drop the named keys of a map record."""
    return F.map_filter(record, lambda k, v: ~k.isin(*keys))


def rename_keys(record: Column, names: Mapping[str, str]) -> Column:
    """Rename keys; a renamed key replaces one that already has the new name."""
    taken = [new for old, new in names.items() if old != new]
    mapping = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    old_names = list(names)
    kept = F.map_filter(
        record,
        lambda k, v: ~(
            k.isin(*taken) & F.exists(F.array(*[F.lit(o) for o in old_names]), lambda o: F.map_contains_key(record, o) & (mapping[o] == k) & (o != k))
        ),
    )
    return F.transform_keys(kept, lambda k, v: F.coalesce(F.try_element_at(mapping, k), k))


def append_or_update(record: Column, updates: Mapping[str, Column]) -> Column:
    """Set keys of a map record."""
    new = F.create_map(*[x for k, v in updates.items() for x in (F.lit(k), v.cast("string"))])
    return F.map_concat(remove_keys(record, list(updates)), new)


def route_test(value: Column, op: str, operand: Any, numeric: bool = False) -> Column:
    """One routing test; ``numeric`` values coerce the operand, text tests ignore case."""
    if numeric and op in ("=", "≠", ">", "<", "≥", "≤"):
        return _compare(value.cast("double"), op, F.lit(float(operand)))
    text, wanted = value.cast("string"), F.lit(str(operand))
    if op in (">", "<", "≥", "≤"):
        numbers = _compare(text.try_cast("double"), op, wanted.try_cast("double"))
        return F.coalesce(numbers, _compare(text, op, wanted))
    return {
        "=": text == wanted,
        "≠": text != wanted,
        "contains": F.contains(F.lower(text), F.lower(wanted)),
        "not contains": ~F.contains(F.lower(text), F.lower(wanted)),
        "start with": F.startswith(F.lower(text), F.lower(wanted)),
        "end with": F.endswith(F.lower(text), F.lower(wanted)),
        "empty": F.coalesce(text, F.lit("")) == "",
        "not empty": F.coalesce(text, F.lit("")) != "",
    }[op]


def route(conditions: Sequence[tuple[str, str, Sequence[Column]]], default: str) -> Column:
    """Name of the first condition ``(name, and|or, tests)`` that holds, else ``default``."""
    choice = F.lit(default)
    for name, logic, tests in reversed(list(conditions)):
        holds = _all(tests) if logic == "and" else _any(tests)
        choice = F.when(F.coalesce(holds, F.lit(False)), F.lit(name)).otherwise(choice)
    return choice


def prune_orphans(hits: DataFrame, documents: DataFrame) -> DataFrame:
    """Hits whose document still exists."""
    return hits.join(documents.select("doc_id").distinct(), "doc_id", "left_semi")


def list_documents(
    documents: DataFrame,
    name_contains: str = "",
    ids: Sequence[Any] = (),
    suffixes: Sequence[str] = (),
    runs: Sequence[str] = (),
    types: Sequence[str] = (),
    without_metadata: DataFrame | None = None,
) -> DataFrame:
    """Document listing filter over ``doc_id, name, suffix, run, type``; unset parts do not restrict."""
    tests = []
    if name_contains:
        tests.append(F.contains(F.lower("name"), F.lit(name_contains.lower())))
    for column, allowed in (("doc_id", ids), ("suffix", suffixes), ("run", runs), ("type", types)):
        if allowed:
            tests.append(F.col(column).isin(*allowed))
    kept = documents.filter(_all(tests))
    if without_metadata is not None:
        kept = kept.join(without_metadata.select("doc_id").distinct(), "doc_id", "left_anti")
    return kept


def valid_messages(
    messages: DataFrame, include_forgotten: bool = False, session_contains: str | None = None
) -> DataFrame:
    """Messages whose status is valid and, unless asked, that are not forgotten."""
    kept = messages.filter(F.coalesce(F.col("status"), F.lit(1)) == 1)
    if not include_forgotten:
        kept = kept.filter(F.col("forget_at").isNull())
    if session_contains:
        kept = kept.filter(F.contains(F.col("session_id"), F.lit(session_contains)))
    return kept


def needs_no_tree(extension: Column, parser: Column, tabular: Column) -> Column:
    """Structured or tabular documents get no summary tree."""
    dotted = F.when(F.startswith(extension, F.lit(".")), F.lower(extension)).otherwise(F.concat(F.lit("."), F.lower(extension)))
    structured = F.coalesce(dotted.isin(*STRUCTURED_EXTENSIONS), F.lit(False))
    pdf = F.coalesce(dotted == ".pdf", F.lit(False))
    return structured | (pdf & ((F.lower(F.coalesce(parser, F.lit(""))) == "table") | F.coalesce(tabular, F.lit(False))))


def toc_entries(entries: DataFrame) -> DataFrame:
    """Contents-page entries worth keeping, per document: ``doc_id, title, level``.

    Titles of ``-1``, over-long titles and bare numbering go; documents with more than 512 entries use a
    stricter length and lose their deepest level.
    """
    sizes = entries.groupBy("doc_id").agg((F.count(F.lit(1)) > 512).alias("_many"))
    limit = F.when(F.col("_many"), 12).otherwise(22)
    kept = entries.join(sizes, "doc_id").filter(
        (F.col("title") != "")
        & (F.col("title") != "-1")
        & (F.size(tx.words("title")) <= limit)
        & ~F.col("title").rlike(r"^[0-9,.()/ -]+$")
    ).drop("_many")
    again = kept.groupBy("doc_id").agg((F.count(F.lit(1)) > 512).alias("_many"), F.max("level").alias("_deepest"))
    return kept.join(again, "doc_id").filter(~F.col("_many") | (F.col("level") < F.col("_deepest"))).drop("_many", "_deepest")
