"""Tolerant parsing of model output and span replacement: plain functions and their vectorised forms."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StringType


def tolerant_json(text: str) -> object:
    """The text as JSON, else its outermost object or array, else that with cut-off brackets closed; ValueError."""
    for candidate in (text, *(m[0] for p in (r"\{.*\}", r"\[.*\]") if (m := re.search(p, text, re.S)))):
        try:
            return json.loads(candidate)
        except ValueError:
            continue
    start = min((i for i in (text.find("{"), text.find("[")) if i >= 0), default=-1)
    if start >= 0:
        for end in ("}", "]}", '"}', '"}]}'):
            try:
                return json.loads(text[start:].rstrip().rstrip(",") + end)
            except ValueError:
                continue
    raise ValueError("no JSON in the text")


def agent_json(text: str) -> dict | None:
    """The outermost object, else the first fenced block's; None if neither parses."""
    for pattern in (r"\{.*\}", r"```(?:json)?\s*(.*?)```"):
        if m := re.search(pattern, text or "", re.S):
            try:
                got = json.loads(m[m.lastindex or 0])
                return got if isinstance(got, dict) else None
            except ValueError:
                continue
    return None


def replace_spans(text: str, spans: list[tuple[int, int, str]]) -> str:
    """Each (start, end, replacement), right to left."""
    for start, end, new in sorted(spans, reverse=True):
        text = text[:start] + new + text[end:]
    return text


def chain_spans(text: str, chains: list[list[tuple[int, int]]]) -> list[tuple[int, int, str]]:
    """In each chain all mentions become the one with most words (the first of equals)."""
    out = []
    for chain in chains:
        best = max(chain, key=lambda m: len(text[m[0] : m[1]].split()))
        out += [(a, b, text[best[0] : best[1]]) for a, b in chain if text[a:b] != text[best[0] : best[1]]]
    return out


def matching_ratio(a: str, b: str) -> float:
    """Twice the matched characters over all characters, by longest common blocks."""
    return SequenceMatcher(None, a, b).ratio()


@pandas_udf(DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """`matching_ratio` of two columns; null where either is null."""
    return pd.Series([None if x is None or y is None else matching_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def ratio_from(least: float) -> Callable[[Column, Column], Column]:
    """`ratio` where it is ``least`` or more, else null. A second text is indexed once, and bounds that are quicker to find come first."""

    @pandas_udf(DoubleType())
    def found(a: pd.Series, b: pd.Series) -> pd.Series:
        known: dict[str, SequenceMatcher] = {}

        def one(x: str | None, y: str | None) -> float | None:
            if x is None or y is None:
                return None
            if y not in known:
                if len(known) >= 4096:
                    known.clear()
                known[y] = SequenceMatcher(None, "", y)
            m = known[y]
            m.set_seq1(x)
            if m.real_quick_ratio() < least or m.quick_ratio() < least:
                return None
            score = m.ratio()
            return score if score >= least else None

        return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return found


@pandas_udf(StringType())
def repaired_json(c: pd.Series) -> pd.Series:
    """`tolerant_json` rendered again; null where there is none."""

    def one(x: str | None) -> str | None:
        try:
            return None if x is None else json.dumps(tolerant_json(x))
        except ValueError:
            return None

    return c.map(one)


@pandas_udf(StringType())
def decode_ignoring(c: pd.Series) -> pd.Series:
    """UTF-8 without the bytes that are none."""
    return c.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore"))
