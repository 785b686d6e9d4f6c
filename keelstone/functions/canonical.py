"""Canonical JSON in two forms: sorted by code point (keys and digests), and RFC 8785 (signatures)."""

from __future__ import annotations

import json
import math

import pandas as pd

from .udf import vectorised


def canonical_json(value) -> str:
    """Keys sorted by code point, no spaces, text as it is; NaN and infinities are refused."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _number(x: float) -> str:
    """A double as ECMAScript writes it."""
    if not math.isfinite(x):
        raise ValueError("JSON has no such number")
    if x == 0:
        return "0"
    sign, x = ("-", -x) if x < 0 else ("", x)
    mantissa, _, exponent = f"{x!r}".partition("e") if "e" in repr(x) else (repr(x), "", "")
    whole, _, part = mantissa.partition(".")
    digits = (whole + part).lstrip("0")
    point = len(whole) + int(exponent or 0)  # value = 0.digits * 10**point, leading zeros counted
    point -= len(whole + part) - len((whole + part).lstrip("0"))
    digits = digits.rstrip("0")
    n = len(digits)
    if n <= point <= 21:
        out = digits + "0" * (point - n)
    elif 0 < point <= 21:
        out = f"{digits[:point]}.{digits[point:]}"
    elif -6 < point <= 0:
        out = f"0.{'0' * -point}{digits}"
    else:
        e = point - 1
        out = f"{digits[0]}{'.' + digits[1:] if n > 1 else ''}e{'+' if e >= 0 else '-'}{abs(e)}"
    return sign + out


def jcs(value) -> str:
    """RFC 8785: keys by UTF-16 units, numbers as doubles."""
    if value is None or isinstance(value, (bool, str)):
        return json.dumps(value, ensure_ascii=False)
    if isinstance(value, (int, float)):
        if isinstance(value, int) and abs(value) > 2**53 - 1:
            raise ValueError("integer beyond what a double holds exactly")
        return _number(float(value))
    if isinstance(value, (list, tuple)):
        return f"[{','.join(map(jcs, value))}]"
    if isinstance(value, dict):
        if not all(isinstance(k, str) for k in value):
            raise ValueError("keys have to be text")
        return f"{{{','.join(f'{jcs(k)}:{jcs(value[k])}' for k in sorted(value, key=lambda k: k.encode('utf-16-be')))}}}"
    raise ValueError(f"not a JSON value: {type(value).__name__}")


def strict_loads(text: str):
    """A JSON document without repeated keys and non-finite numbers."""

    def pairs(items):
        out = dict(items)
        if len(out) != len(items):
            raise ValueError("repeated key")
        return out

    def refuse(name):
        raise ValueError(f"not a JSON number: {name}")

    return json.loads(text, object_pairs_hook=pairs, parse_constant=refuse)


def _column(form):
    @vectorised("string")
    def convert(texts: pd.Series) -> pd.Series:
        def one(t):
            try:
                return None if t is None else form(strict_loads(t))
            except (ValueError, RecursionError):
                return None

        return texts.map(one)

    return convert


#: Columns of JSON text in canonical form; null where the text isn't JSON.
to_canonical_json = _column(canonical_json)
to_jcs = _column(jcs)
