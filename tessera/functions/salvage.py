"""Getting JSON out of model text. Finding the candidate is Column work; only strict
parsing, which no Spark parser matches, is an Arrow UDF over the short candidates."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip_ws


def unwrapped(raw: Column) -> Column:
    """Text after the last chain of thought, without code fence."""
    t = strip_ws(raw)
    t = strip_ws(F.when(t.contains("</think>"), F.substring_index(t, "</think>", -1)).otherwise(t))
    fenced = strip_ws(F.regexp_replace(F.regexp_replace(t, "^`+|`+$", ""), "^(?i)json", ""))
    return F.when(t.startswith("```"), fenced).otherwise(t)


def object_candidate(raw: Column) -> Column:
    """The object in the text: all of it if it opens one, else first to last brace."""
    t = unwrapped(raw)
    found = F.regexp_extract(t, r"(?s)\{.*\}", 0)
    return F.when(t.startswith("{") | (found == ""), t).otherwise(found)


def array_candidate(raw: Column) -> Column:
    t = unwrapped(raw)
    found = F.regexp_extract(t, r"(?s)\[.*\]", 0)
    return F.when(found != "", found).otherwise(object_candidate(raw))


def _load(text):
    try:
        return json.loads(text)
    except (TypeError, ValueError):
        return None


def _strict(candidates: pd.Series) -> pd.DataFrame:
    rows = []
    for c in candidates:
        d = _load(c)
        if not isinstance(d, dict):
            rows.append((None, None, False))
            continue
        e = d.get("expected")
        rows.append((str(d.get("prompt", "")).strip(), None if e is None or str(e).strip() == "" else str(e).strip(), True))
    return pd.DataFrame(rows, columns=["prompt", "expected", "ok"])


def _object(candidates: pd.Series) -> pd.Series:
    return candidates.map(lambda c: json.dumps(d, ensure_ascii=False) if isinstance(d := _load(c), dict) else None)


def _records(candidates: pd.Series) -> pd.Series:

    def records(c):
        d = _load(c)
        d = [d] if isinstance(d, dict) else d
        return [json.dumps(x, ensure_ascii=False) for x in d if isinstance(x, dict)] if isinstance(d, list) else []

    return candidates.map(records)


def strict_object(candidate: Column, once: bool = False) -> Column:
    """Canonical JSON of a strictly valid object, else null; ``once`` keeps filters from
    running it a second time, in Python workers of their own."""
    parse = F.pandas_udf(_object, "string")
    return (parse.asNondeterministic() if once else parse)(candidate)


def strict_records(candidate: Column) -> Column:
    """Canonical JSON of the objects in an array; an object counts as an array of one."""
    return F.pandas_udf(_records, "array<string>")(candidate)


def parse_response(raw: Column) -> Column:
    """struct(prompt, expected); falls back to the stripped text without an answer."""
    got = F.pandas_udf(_strict, "prompt string, expected string, ok boolean")(object_candidate(raw))
    good = got["ok"] & (F.length(got["prompt"]) > 0)
    return F.struct(F.when(good, got["prompt"]).otherwise(strip_ws(raw)).alias("prompt"), F.when(good, got["expected"]).alias("expected"))


def parse_seed_records(raw: Column) -> Column:
    return strict_records(array_candidate(raw))
