"""Content-hash keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*parts: Column) -> Column:
    """MD5 of the parts joined with ``_``.

    NULL parts vanish, so (NULL, "a") and ("a", NULL) share a key; a lone NULL part stays NULL.
    """
    return F.md5(parts[0] if len(parts) == 1 else F.concat_ws("_", *parts))
