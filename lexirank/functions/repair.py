"""Repair of almost-JSON as models write it: one scan over tokens, in Arrow batches."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

_TOKEN = re.compile(r'(?P<string>"(?:[^"\\]|\\.)*(?:"|\\?\Z))|(?P<comment>[^\S\n]*//[^\n]*)|(?P<open>[\[{])|(?P<close>[\]}])|(?P<comma>,)|(?P<decimal>\d\.(?!\d))|(?P<space>\s+)|(?P<other>.)', re.S)
_CLOSES = {"[": "]", "{": "}"}


def repair_json(text: str) -> str:
    """Without // comments and surplus commas, `1.` as `1.0`, what is open at the end closed; closers that fit nothing stay as they are."""
    out: list[str] = []
    open_: list[str] = []
    comma = False
    for m in _TOKEN.finditer(text):
        kind, token = m.lastgroup, m[0]
        if kind == "comment" or (kind == "space" and comma):
            continue
        if kind == "comma":
            comma = True
            continue
        if kind == "string" and (len(token) == 1 or not token.endswith('"') or _odd_slashes(token[:-1])):
            token = (token[:-1] if _odd_slashes(token) else token) + '"'
        if comma and kind != "close":
            out.append(",")
        comma = False
        if kind == "open":
            open_.append(_CLOSES[token])
        elif kind == "close" and open_ and open_[-1] == token:
            open_.pop()
        elif kind == "decimal":
            token += "0"
        out.append(token)
    if comma and not open_:
        out.append(",")
    return "".join(out + open_[::-1])


def _odd_slashes(token: str) -> bool:
    return (len(token) - len(token.rstrip("\\"))) % 2 == 1


def balanced_blocks(text: str, start: int = 0) -> list[tuple[int, int]]:
    """Spans of the outermost balanced brackets, strings read as such, from a position on."""
    spans, depth, begin = [], 0, 0
    for m in _TOKEN.finditer(text, start):
        if m.lastgroup == "open":
            if not depth:
                begin = m.start()
            depth += 1
        elif m.lastgroup == "close" and depth:
            depth -= 1
            if not depth:
                spans.append((begin, m.end()))
    return spans


def parse_content(text: str | None) -> tuple[str | None, str]:
    """(JSON, stage): parsed as it is (plain), repaired, its first block (block), or the objects saved from a broken array (salvaged)."""
    if not text or not text.strip():
        return None, "empty"
    for stage, candidate in (("plain", text), ("repaired", repair_json(text))):
        if (found := _loads(candidate)) is not None:
            return found, stage
    blocks = balanced_blocks(text)
    for a, b in blocks[:1]:
        for candidate in (text[a:b], repair_json(text[a:b])):
            if (found := _loads(candidate)) is not None:
                return found, "block"
    saved = salvage_objects(text)
    return (json.dumps(saved, ensure_ascii=False), "salvaged") if saved else (None, "failed")


def _loads(text: str) -> str | None:
    try:
        value = json.loads(text)
    except ValueError:
        return None
    return json.dumps(value, ensure_ascii=False) if isinstance(value, (dict, list)) else None


def salvage_objects(text: str) -> list:
    """The objects of an array that can't be read as a whole, each repaired by itself; those beyond repair are left out."""
    at = text.find("[")
    body = text[at + 1 :] if at >= 0 else text
    spans = balanced_blocks(body)
    tail = body.rfind("{")
    if tail >= 0 and not any(a <= tail < b for a, b in spans):
        spans.append((tail, len(body)))
    out = []
    for a, b in spans:
        if (found := _loads(repair_json(body[a:b]))) is not None:
            out.append(json.loads(found))
    return [x for x in out if isinstance(x, dict)]


@F.pandas_udf(StringType())
def repair_json_udf(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else repair_json(t))


@F.pandas_udf(StructType().add("node", StringType()).add("stage", StringType()))
def parse_content_udf(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([parse_content(t) for t in texts], columns=["node", "stage"])


@F.pandas_udf(ArrayType(StringType()))
def salvage_udf(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: [json.dumps(x, ensure_ascii=False) for x in salvage_objects(t or "")])
