"""Column expressions over flat JSON text, clips and store rows. All native; no Python runs per row.

Two ways to read a field exist. ``json`` mode parses the line. ``textual`` mode looks for the first textual
occurrence of the quoted key and reads the value behind it, so nested keys and odd numbers count as they stand.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from chunklake import schemas

# The names, limits and blanks the data format lays down.
END_MARKER_NAME = ".pipeline_end"
SIDECAR_SUFFIX = ".meta.jsonl"
PAYLOAD_SUFFIX = ".bin"
CLIP_TYPE = "clip"
DATA_KIND = "data"
END_KIND = "end"
LINE_BLANKS = " \t\n\u000b\f\r"

_QUOTED = r'"(?:[^"\\]|\\.)*+"'
_BARE = r'[^,} \t\r\n"][^,} \t\r\n]*+'


def _col(line: Column | str) -> Column:
    return F.col(line) if isinstance(line, str) else line


def trim_line(line: Column | str) -> Column:
    """Strip white space, line ends and tabs included, from both ends."""
    return F.btrim(_col(line), F.lit(LINE_BLANKS))


def _value(line: Column | str, key: str, token: str, blanks: str = r"[ \t]") -> Column:
    """The token behind the first ``"key"``; '' if there is no such key, or no colon and such a token behind it.

    What follows the key is optional in the pattern, so its first match is the first mention of the key, always.
    """
    quoted_key = re.sub(r"[^A-Za-z0-9_]", r"\\\g<0>", f'"{key}"')
    return F.regexp_extract(_col(line), rf"(?s){quoted_key}(?:[ \t]*+:{blanks}*+({token}))?", 1)


def _rest(token: Column, cut: int) -> Column:
    """The token from its second character on, ``cut`` characters shorter; NULL if it is empty.

    The NULL comes in through the length, so that the token is no argument of a branch, and is computed once.
    """
    return F.substr(token, F.lit(2), F.when(F.length(token) > 0, F.length(token) - F.lit(cut)))


def _unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def field_string(line: Column | str, key: str) -> Column:
    """The string value of a key, each backslash dropped and its next character kept; NULL if not a string."""
    return _unescape(_rest(_value(line, key, _QUOTED), 2))


def field_scalar(line: Column | str, key: str) -> Column:
    """As `field_string`, and any other value as its raw token."""
    token = _value(line, key, f"{_QUOTED}|{_BARE}")
    return F.when(token.startswith('"'), _unescape(_rest(token, 2))).when(token != "", token)


def field_equals(line: Column | str, key: str, value: str, scalars: bool = False) -> Column:
    """Whether a key has this string value or, with ``scalars``, this raw token. Looks the key up once or twice."""
    token = _value(line, key, f"{_QUOTED}|{_BARE}" if scalars else _QUOTED)
    equal = _unescape(token) == f'"{value}"'
    return equal | (token == value) if scalars and not value.startswith('"') else equal


def field_integer(line: Column | str, key: str) -> Column:
    """The leading decimal integer of an unquoted value; NULL if there is none or it exceeds 64 bits."""
    return _value(line, key, "[+-]?[0-9]++", r"[ \t\n\x0b\f\r]").try_cast("bigint")


def field_kind(line: Column | str) -> Column:
    """The record kind: what follows the opening quote up to the next, NULL if the value is not quoted."""
    head = _value(line, "kind", '"[^"]*+')
    return _rest(head, 1)


def meta_fields(line: Column | str, mode: str = "textual") -> dict[str, Column]:
    """The five sidecar fields as columns, each NULL where it is missing or unreadable."""
    if mode == "json":
        meta = F.from_json(_col(line), schemas.META)
        return {name: meta[name] for name in schemas.META.fieldNames()}
    if mode != "textual":
        raise ValueError(f"unknown parse mode {mode!r}")
    numbers = {name: field_integer(line, name) for name in ("sequence", "offset", "length", "ts_ms")}
    return {"kind": field_kind(line)} | numbers


def whole_meta(fields: dict[str, Column]) -> Column:
    """The five fields as a struct of `schemas.META`; NULL unless all are there and the unsigned ones not negative."""
    whole = F.lit(True)
    for name in schemas.META.fieldNames():
        whole = whole & fields[name].isNotNull()
    for name in ("sequence", "offset", "length"):
        whole = whole & (fields[name] >= 0)
    return F.when(whole, F.struct(*[fields[name].alias(name) for name in schemas.META.fieldNames()]))


def parse_meta(line: Column | str, mode: str = "textual") -> Column:
    """A sidecar line as one struct expression. `operators.sidecar` does the same in steps that share their work."""
    return whole_meta(meta_fields(line, mode))


#: Stands between a session's folder and its id where both are one key; no path holds it.
_KEY_SEPARATOR = "\u0000"


def session_key(folder: Column | str, session_id: Column | str) -> Column:
    """A session's identity: its folder and its id. Sessions of the same name in two folders are two."""
    return F.concat_ws(_KEY_SEPARATOR, _col(folder), _col(session_id))


def session_name(key: Column | str) -> Column:
    """The id in a session's key, with or without a folder."""
    return F.substring_index(_col(key), _KEY_SEPARATOR, -1)


def session_folder(key: Column | str) -> Column:
    """The folder in a session's key; null where the key has none."""
    key = _col(key)
    rest = F.length(key) - F.length(session_name(key)) - len(_KEY_SEPARATOR)
    return F.when(rest >= 0, F.substr(key, F.lit(1), rest))


def looks_like_object(line: Column | str) -> Column:
    """True when, blanks and tabs aside, the line begins with ``{`` and ends with ``}``."""
    bare = F.btrim(_col(line), F.lit(" \t"))
    return bare.startswith("{") & bare.endswith("}")


def clip_ts(start_ts_ms: Column) -> Column:
    """Whole seconds, truncated toward zero."""
    return F.call_function("div", start_ts_ms, F.lit(1000))


def clip_path(src: str, session_id: Column, ts: Column) -> Column:
    """``{src}/{session}_{ts}.bin``. In the folder, ``{session_id}`` stands for the session."""
    folder = F.replace(F.lit(src), F.lit("{session_id}"), session_id) if "{session_id}" in src else F.lit(src)
    return F.concat(folder, F.lit("/"), session_id, F.lit("_"), ts.cast("string"), F.lit(PAYLOAD_SUFFIX))


def store_key(session_id: Column, ts: Column) -> Column:
    """``session_id:ts``; NULL when either part is."""
    return F.concat(session_id, F.lit(":"), ts.cast("string"))


def expire_at(ttl: int, now: Column | int) -> Column:
    """0 (never) for a zero ttl, else now + ttl."""
    now = now if isinstance(now, Column) else F.lit(now)
    return F.lit(0).cast("bigint") if ttl == 0 else (now + F.lit(ttl)).cast("bigint")


def is_live(expires: Column | str, now: Column | int) -> Column:
    """Never-expiring, or expiring strictly after now."""
    expires = _col(expires)
    return (expires == 0) | (expires > now)


def is_end_marker(path: Column | str) -> Column:
    """The last path component is the end-of-session marker's name."""
    return F.substring_index(_col(path), "/", -1) == END_MARKER_NAME
