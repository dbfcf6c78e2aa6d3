"""Blank handling, keyword search and URL authority."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Optional control characters or blanks, optional scheme, then whatever sits between "//" and the
# next "/", "?" or "#": user, host and port together. Runs unchanged in Java and RE2.
URL_AUTHORITY = r"^[\x00-\x20]*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"


def is_blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def blank_to(c: Column, default: str) -> Column:
    """``default`` for NULL and the empty string."""
    return F.when(is_blank(c), F.lit(default)).otherwise(c)


def url_authority(url: Column) -> Column:
    """The ``netloc`` of a URL as Python's ``urlparse`` gives it: case, user and port kept.

    ``""`` when the URL has no authority, NULL for NULL. Tabs and line breaks are not part of a URL
    and vanish first.
    """
    for mark in ("\t", "\r", "\n"):
        url = F.replace(url, F.lit(mark), F.lit(""))
    return F.regexp_extract(url, URL_AUTHORITY, 1)


def contains_any(c: Column, words: Iterable[str]) -> Column:
    """True when one of ``words`` occurs in ``c``; false for no words."""
    quoted = [re.escape(w) for w in words]
    if len(quoted) > 3:
        # One regex looks at the text once and keeps the generated code short.
        return c.rlike("|".join(quoted))
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words], F.lit(False))


# Patterns made of plain text, escaped parentheses, ".*" and groups of alternatives. Whatever plain
# text such a pattern has must occur in any string it matches.
_TEXT = r"(?:[\w /;]|\\[()])+"
_SIMPLE_PATTERN = rf"(?:{_TEXT}|\.\*|\([\w|]+\)\??)+"


def matches(c: Column, pattern: str) -> Column:
    """Regex search. Byte-wise ``contains`` tests, which cost a fraction of a regex, do it alone for an
    alternation of plain words and sort out most strings beforehand for other simple patterns.
    """
    words = pattern.split("|")
    if all(re.fullmatch(r"[\w /;]+", w) for w in words):
        return contains_any(c, words)
    found = c.rlike(pattern)
    if re.fullmatch(_SIMPLE_PATTERN, pattern):
        texts = re.findall(_TEXT, re.sub(r"(?<!\\)\([\w|]+\)\??", ".*", pattern))
        for text in reversed(texts):
            found = c.contains(text.replace("\\", "")) & found
    return found
