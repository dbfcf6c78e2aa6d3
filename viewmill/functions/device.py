"""Operating system and browser family from a user-agent string, by ordered rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from viewmill.functions.text import is_blank, matches
from viewmill.schemas import UNKNOWN

Rules = Sequence[tuple[str, str]]

OTHER = "Other"

# Family names as public user-agent parsers spell them. First hit wins. The patterns
# use no look-around, so any regex engine gives the same answer.
OS_RULES: Rules = (
    ("Windows Phone", "Windows Phone"),
    ("Windows", "Windows"),
    ("Android", "Android"),
    ("iPhone|iPad|iPod", "iOS"),
    ("CrOS", "Chrome OS"),
    ("Mac OS X", "Mac OS X"),
    ("Ubuntu", "Ubuntu"),
    ("Linux|X11", "Linux"),
)
BROWSER_RULES: Rules = (
    ("Googlebot", "Googlebot"),
    (r"Edg(e|A|iOS)?/", "Edge"),
    ("OPR/|Opera", "Opera"),
    ("SamsungBrowser/", "Samsung Internet"),
    ("FBAN|FBAV", "Facebook"),
    ("CriOS/", "Chrome Mobile iOS"),
    ("FxiOS/", "Firefox iOS"),
    (r"Android.*Firefox/", "Firefox Mobile"),
    ("Firefox/", "Firefox"),
    (r"; wv\)", "Chrome Mobile WebView"),
    (r"Android.*Chrome/", "Chrome Mobile"),
    ("Chrome/", "Chrome"),
    (r"(iPhone|iPad|iPod).*Version/.*Safari/", "Mobile Safari"),
    (r"Version/.*Safari/", "Safari"),
    ("MSIE |Trident/", "IE"),
)


def classify(user_agent: Column, rules: Rules) -> Column:
    """The label of the first rule that matches; ``UNKNOWN`` for blank, ``Other`` for no hit."""
    label = F.when(is_blank(user_agent), F.lit(UNKNOWN))
    for pattern, name in rules:
        label = label.when(matches(user_agent, pattern), F.lit(name))
    return label.otherwise(F.lit(OTHER))
