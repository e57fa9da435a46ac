"""What built-in functions can't express: compatibility normal form and lenient JSON repair.

Both are Arrow-batched; callers apply them to model replies or distinct phrases, not to
every message.
"""

from __future__ import annotations

import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_LAST_COMMA = re.compile(r",\s*([}\]])")


def _nfkc(text: str | None) -> str | None:
    return None if text is None else _EDGES.sub("", unicodedata.normalize("NFKC", text))


def repair_text(raw: str | None) -> str | None:
    """The first JSON object or list in a reply, closed and without dangling commas; null if beyond repair."""
    if not raw:
        return None
    body = re.sub(r"```(?:json)?", "", raw)
    start = min((i for i in (body.find("{"), body.find("[")) if i >= 0), default=-1)
    if start < 0:
        return None
    closers, quoted, escaped, end = [], False, False, None
    for i, c in enumerate(body[start:], start):
        if quoted:
            quoted, escaped = (c != '"' or escaped), (c == "\\" and not escaped)
            continue
        if c == '"':
            quoted = True
        elif c in "{[":
            closers.append("}" if c == "{" else "]")
        elif c in "}]" and closers:
            closers.pop()
            if not closers:
                end = i + 1
                break
    text = body[start:end] if end else body[start:] + ('"' if quoted else "") + "".join(reversed(closers))
    try:
        value = json.loads(_LAST_COMMA.sub(r"\1", text))
    except ValueError:
        return None
    while isinstance(value, list):
        if not value:
            return None
        value = value[0]
    return json.dumps(value, ensure_ascii=False) if isinstance(value, dict) else None


@F.pandas_udf(StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """NFKC, then punctuation stripped at both ends."""
    return texts.map(_nfkc, na_action="ignore")


@F.pandas_udf(StringType())
def repaired_json(raws: pd.Series) -> pd.Series:
    """``repair_text`` for a column."""
    return raws.map(repair_text, na_action="ignore")
