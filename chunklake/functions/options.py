"""Option checks, all made on the driver before any job starts."""

from __future__ import annotations

DEFAULT_TTL_SECONDS = 3600
DEFAULT_CLIP_MS = 5000
DEFAULT_IDLE_MS = 2000
FORMATS = ("json", "csv")


def check_fields(fields: str | list[str]) -> list[str]:
    """Field names from a comma-separated text or a list; none empty, none twice."""
    names = fields.split(",") if isinstance(fields, str) else list(fields)
    if not names or any(not name for name in names):
        raise ValueError(f"invalid fields {fields!r}: empty name")
    if len(set(names)) != len(names):
        raise ValueError(f"invalid fields {fields!r}: a name occurs twice")
    return names


def check_filter(condition: str) -> tuple[str, str]:
    """``key=value``, cut at the first ``=``, both sides not empty."""
    key, eq, value = condition.partition("=")
    if not (key and eq and value):
        raise ValueError(f"invalid filter {condition!r}: expected key=value")
    return key, value


def check_format(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}")
    return fmt


def check_log_options(pattern: str | None, fields: str | list[str] | None, fmt: str | None) -> None:
    """Fields and a pattern go together; a format needs both."""
    if fmt is not None:
        check_format(fmt)
    if pattern is not None and fields is None:
        raise ValueError("fields are required with a pattern")
    if pattern is None and (fields is not None or fmt is not None):
        raise ValueError("fields and format require a pattern")


def check_ttl(ttl: int | str) -> int:
    """A whole number of seconds, not negative; 0 means never."""
    if isinstance(ttl, bool) or not isinstance(ttl, int | str):
        raise ValueError(f"invalid ttl {ttl!r}")
    text = str(ttl).lstrip(" \t\n\v\f\r")
    digits = text[1:] if text[:1] in ("+", "-") else text
    if not (digits.isascii() and digits.isdigit()) or int(text) < 0:
        raise ValueError(f"invalid ttl {ttl!r}")
    return int(text)


def check_span_ms(name: str, value: int) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value <= 0:
        raise ValueError(f"{name} must be a positive number of milliseconds, not {value!r}")
    return value


def seconds_to_ms(seconds: float) -> int:
    """Fractions of a second are allowed; the rest below a millisecond is cut off."""
    return int(seconds * 1000.0)
