"""JSON out of what a model said: fences, commentary, wrapped arrays."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from sievework.functions.text import strip


def strip_fences(c: Column) -> Column:
    """Without a code fence at either end."""
    t = strip(c)
    inner = F.regexp_replace(F.regexp_replace(t, r"^```(?:json)?\s*", ""), r"\s*```\z", "")
    return strip(F.when(t.startswith("```"), inner).otherwise(t))


def _loads(text: str, span: str) -> object:
    try:
        return json.loads(text)
    except (ValueError, RecursionError):
        found = re.search(span, text, re.S)
        try:
            return json.loads(found.group(0)) if found else None
        except (ValueError, RecursionError):
            return None


def first_array(text: str | None) -> list | None:
    """The array that a response holds: all of it, its outermost [...], or an object's first list."""
    got = _loads(text or "", r"\[.*\]")
    if isinstance(got, dict):
        got = next((v for v in got.values() if isinstance(v, list)), None)
    return got if isinstance(got, list) else None


def first_object(text: str | None) -> dict | None:
    """The object that a response holds: all of it, or its outermost {...}."""
    got = _loads(text or "", r"\{.*\}")
    return got if isinstance(got, dict) else None


def unfenced(text: str) -> str:
    """strip_fences() of one text."""
    t = text.strip()
    return re.sub(r"\s*```\Z", "", re.sub(r"^```(?:json)?\s*", "", t)).strip() if t.startswith("```") else t


def has_array(text: str) -> bool:
    return first_array(unfenced(text)) is not None


def has_objects(text: str) -> bool:
    """Whether there is an array with an object in it."""
    return any(isinstance(x, dict) for x in first_array(unfenced(text)) or ())


def has_object(text: str) -> bool:
    """Whether there is an object with something in it."""
    return bool(first_object(unfenced(text)))


def has_checks(text: str) -> bool:
    """Whether there is an object whose two checks are real booleans."""
    got = first_object(unfenced(text)) or {}
    return all(isinstance(got.get(k), bool) for k in ("unanswerable", "plausible"))


def _token(v: object) -> str | None:
    return None if v is None else json.dumps(v, ensure_ascii=False)


def json_objects(response: Column) -> Column:
    """The objects of a response's array, each a map from name to JSON text; items of other kinds are
    left out (positions stay in ``at``). Null if there is no array."""

    def run(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> list | None:
            got = first_array(t)
            return None if got is None else [{"at": i, "fields": {str(k): _token(v) for k, v in x.items()}} for i, x in enumerate(got) if isinstance(x, dict)]

        return texts.map(one)

    return F.pandas_udf(run, "array<struct<at: int, fields: map<string, string>>>")(strip_fences(response))


def json_object(response: Column) -> Column:
    """The object of a response as a map from name to JSON text; null if there is none."""

    def run(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> dict | None:
            got = first_object(t)
            return None if got is None else {str(k): _token(v) for k, v in got.items()}

        return texts.map(one)

    return F.pandas_udf(run, "map<string, string>")(strip_fences(response))


def as_text(token: Column) -> Column:
    """A JSON value as text: strings without quotes and escapes, anything else as it prints."""
    return F.when(token.startswith('"'), F.get_json_object(F.concat(F.lit('{"v":'), token, F.lit("}")), "$.v")).otherwise(token)


def as_boolean(token: Column) -> Column:
    """true or false only if the value is a real boolean."""
    return F.when(token == "true", True).when(token == "false", False)
