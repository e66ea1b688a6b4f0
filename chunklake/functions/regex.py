"""Field extraction by regular expression.

Patterns are POSIX extended expressions. `translate` rewrites the few places where their spelling differs from Java's
(bracket expressions), and reports which groups may take no part in a match. Spark's functions cannot tell an empty group
from one that took no part, so `require_groups` has the pattern itself refuse a line in which a used group takes none.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The POSIX character classes in the C locale, as ranges valid inside brackets.
POSIX_CLASSES = {
    "alnum": "A-Za-z0-9",
    "alpha": "A-Za-z",
    "blank": r" \t",
    "cntrl": r"\x00-\x1f\x7f",
    "digit": "0-9",
    "graph": r"\x21-\x7e",
    "lower": "a-z",
    "print": r"\x20-\x7e",
    "punct": r"\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e",
    "space": r" \t\n\x0b\f\r",
    "upper": "A-Z",
    "xdigit": "0-9A-Fa-f",
}

_BRACKET = re.compile(r"\[(\^?)(\]?(?:\[:[a-z]+:\]|[^\]])*)\]")
#: A bracket expression as `_bracket` writes it: what is special in it is escaped.
_JAVA_BRACKET = re.compile(r"\[\^?(?:\\.|[^\]\\])*\]", re.S)
_PLAIN = "x"
_CLASS = re.compile(r"\[:([a-z]+):\]")


@dataclass(frozen=True)
class Translated:
    pattern: str
    groups: int
    #: numbers of the groups that may take no part in a match
    skippable: frozenset[int]
    #: numbers of the groups that may match nothing at all
    nullable: frozenset[int]


def _bracket(match: re.Match[str]) -> str:
    parts = _CLASS.split(match[2])
    out = []
    for i, part in enumerate(parts):
        if i % 2:
            if part not in POSIX_CLASSES:
                raise ValueError(f"unknown character class [:{part}:]")
            out.append(POSIX_CLASSES[part])
        else:
            out.append(re.sub(r"[\\\[\]&~|^]", r"\\\g<0>", part))
    return f"[{match[1]}{''.join(out)}]"


def translate(pattern: str) -> Translated:
    """Rewrite bracket expressions, count groups, and note optional groups or alternations."""
    rewritten, skeleton, at = [], [], 0
    while at < len(pattern):
        if pattern[at] == "\\":
            step = pattern[at : at + 2]
            rewritten.append(step)
            skeleton.append(_PLAIN)
        elif pattern[at] == "[":
            found = _BRACKET.match(pattern, at)
            if found is None:
                raise ValueError(f"invalid pattern {pattern!r}: open bracket expression")
            step = found[0]
            rewritten.append(_bracket(found))
            skeleton.append(_PLAIN)
        else:
            step = pattern[at]
            rewritten.append(step)
            skeleton.append(step)
        at += len(step)
    text, shape = "".join(rewritten), "".join(skeleton)
    try:
        groups = re.compile(text).groups
    except re.error as error:
        raise ValueError(f"invalid pattern {pattern!r}: {error}") from error
    return Translated(text, groups, _skippable(shape), _nullable(text, shape, rewritten))


def _nullable(text: str, shape: str, steps: list[str]) -> frozenset[int]:
    """Groups whose own pattern matches the empty text; one that refers to others or to word borders is taken for such."""
    found, open_groups, groups = set(), [], 0
    for at, step in enumerate(shape):
        if step == "(":
            capturing = shape[at + 1 : at + 2] != "?"
            groups += capturing
            open_groups.append((groups if capturing else None, at + 1))
        elif step == ")":
            number, begin = open_groups.pop()
            inner = steps[begin:at]
            odd = any(re.fullmatch(r"\\[0-9bB]", part) for part in inner)
            if number and (odd or re.fullmatch("".join(inner), "", re.S)):
                found.add(number)
    return frozenset(found)


def _skippable(shape: str) -> frozenset[int]:
    """Groups inside one of several alternatives, and groups in anything that may be repeated zero times.

    ``shape`` is the pattern with a plain letter for every escape and bracket. An alternation inside a group does not
    touch that group.
    """
    found: set[int] = set()
    scopes: list[dict] = [{"own": None, "inner": set(), "bar": False}]
    groups = 0
    for at, step in enumerate(shape):
        if step == "(":
            capturing = shape[at + 1 : at + 2] != "?"
            groups += capturing
            scopes.append({"own": groups if capturing else None, "inner": set(), "bar": False})
        elif step == "|":
            scopes[-1]["bar"] = True
        elif step == ")":
            scope = scopes.pop()
            if scope["bar"]:
                found |= scope["inner"]
            whole = scope["inner"] | ({scope["own"]} if scope["own"] else set())
            if re.match(r"\?|\*|\{0*[,}]", shape[at + 1 :]):
                found |= whole
            scopes[-1]["inner"] |= whole
    if scopes[0]["bar"]:
        found |= scopes[0]["inner"]
    return frozenset(found)


def regex_records(
    lines: DataFrame, line: Column, pattern: str, fields: list[str], keep: tuple[str, ...], strict: bool = True
) -> tuple[DataFrame, DataFrame]:
    """``(records, refused lines)``: the groups of each line's first match as string columns named by ``fields``.

    Groups beyond the fields are ignored. With more fields than groups no line can pass: that raises, unless
    ``strict`` is off, in which case every line is refused.
    """
    parsed = translate(pattern)
    if len(fields) > parsed.groups:
        if strict:
            raise ValueError(f"{len(fields)} fields but only {parsed.groups} groups in {pattern!r}")
        none = [F.lit(None).cast("string").alias(name) for name in fields]
        return lines.where(F.lit(False)).select(*keep, *none), lines
    java, numbers = require_groups(parsed, len(fields))
    groups = [F.regexp_extract(line, java, number).alias(name) for name, number in zip(fields, numbers, strict=True)]
    matched = F.regexp_like(line, F.lit(java))
    for number in sorted(parsed.skippable - parsed.nullable):
        if number <= len(fields):
            matched = matched & (F.regexp_extract(line, java, numbers[number - 1]) != "")
    return lines.where(matched).select(*keep, *groups), lines.where(~matched)


def require_groups(parsed: Translated, used: int) -> tuple[str, list[int]]:
    """A Java pattern that fails where one of the first ``used`` groups, if it may be empty, takes no part, and their numbers in it.

    Of a group that cannot be empty an empty value tells enough. Behind one that can an empty group is put, as part of
    the same step, and a reference to it at the end: a reference to a group that took no part fails. The first match is found in an atomic group, so that the failure is final and does
    not make another match of the line.
    """
    asked = {number for number in parsed.skippable & parsed.nullable if number <= used}
    if not asked:
        return f"(?sd){parsed.pattern}", list(range(1, used + 1))
    out: list[str] = []
    scopes: list[int | None] = []
    new_number: dict[int, int] = {}
    marks: list[int] = []
    old = new = at = 0
    text = parsed.pattern
    while at < len(text):
        step = text[at]
        if step == "\\":
            step = text[at : at + 2]
            if step[1] in "123456789":
                step = f"\\{new_number[int(step[1])]}(?:)"
        elif step == "[":
            step = _JAVA_BRACKET.match(text, at)[0]
            at += len(step)
            out.append(step)
            continue
        elif step == "(":
            capturing = text[at + 1 : at + 2] != "?"
            if capturing:
                old, new = old + 1, new + 1
                new_number[old] = new
            asked_here = capturing and old in asked
            scopes.append(old if asked_here else None)
            step = "(?:(" if asked_here else "("
        elif step == ")" and scopes.pop() is not None:
            new += 1
            marks.append(new)
            step = ")())"
        at += 2 if text[at] == "\\" else 1
        out.append(step)
    seen = "".join(f"\\{number}(?:)" for number in marks)
    return rf"(?sd)\A(?>.*?(?:{''.join(out)})){seen}", [new_number[number] for number in range(1, used + 1)]
