"""Shell-glob patterns (``*``, ``?``, ``[seq]``, ``[!seq]``) as one Java regex.

Patterns are translated once on the driver and evaluated with ``rlike`` on the
executors, so a list of patterns costs one regex test per row. Matching is
whole-string and case-sensitive, like ``fnmatch`` on POSIX.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

_CLASS_SPECIAL = set("\\[]^&-")


def _bracket(pattern: str, i: int) -> tuple[str | None, int]:
    """Translate the bracket expression starting after ``[`` at index ``i``.

    Returns ``(None, i)`` when there is no closing bracket (``[`` is literal).
    """
    j = i
    negate = j < len(pattern) and pattern[j] == "!"
    if negate:
        j += 1
    body_start = j
    if j < len(pattern) and pattern[j] == "]":  # a leading ']' is a member
        j += 1
    while j < len(pattern) and pattern[j] != "]":
        j += 1
    if j >= len(pattern):
        return None, i
    body = pattern[body_start:j]
    out = []
    k = 0
    while k < len(body):
        ch = body[k]
        if k + 2 < len(body) and body[k + 1] == "-":
            lo, hi = ch, body[k + 2]
            if lo <= hi:
                out.append(_class_char(lo) + "-" + _class_char(hi))
            k += 3
            continue
        out.append(_class_char(ch))
        k += 1
    inner = "".join(out)
    if not inner:
        # an empty set matches nothing; its negation matches any character
        return ("." if negate else "(?!)"), j + 1
    return ("[^" if negate else "[") + inner + "]", j + 1


def _class_char(ch: str) -> str:
    return "\\" + ch if ch in _CLASS_SPECIAL else ch


def glob_to_regex(pattern: str) -> str:
    """One glob as an unanchored Java regex fragment."""
    out = []
    i = 0
    while i < len(pattern):
        ch = pattern[i]
        i += 1
        if ch == "*":
            if not out or out[-1] != ".*":
                out.append(".*")
        elif ch == "?":
            out.append(".")
        elif ch == "[":
            cls, i2 = _bracket(pattern, i)
            if cls is None:
                out.append("\\[")
            else:
                out.append(cls)
                i = i2
        else:
            out.append(re.escape(ch) if not ch.isalnum() else ch)
    return "".join(out)


def globs_to_regex(patterns: list[str]) -> str | None:
    """All globs as one anchored, dot-all regex; ``None`` when the list is empty."""
    parts = [glob_to_regex(p) for p in patterns]
    if not parts:
        return None
    # \z (not $): Java's $ would also match before a trailing newline.
    return "(?s)^(?:" + "|".join(parts) + ")\\z"


def matches_any_glob(col: str | Column, patterns: list[str]) -> Column:
    """True when the value matches any pattern; null values never match."""
    c = F.col(col) if isinstance(col, str) else col
    regex = globs_to_regex(patterns)
    if regex is None:
        return F.lit(False)
    return F.coalesce(c.rlike(regex), F.lit(False))
