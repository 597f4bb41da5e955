"""Text keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def borough_key(c: Column) -> Column:
    """Lower-cased borough bucket key; NULL becomes ''."""
    return F.lower(F.coalesce(c, F.lit("")))


def url_quote(c: Column) -> Column:
    """Percent-encode like ``urllib.parse.quote`` with its default safe set ``/``:
    ``url_encode`` is form encoding (space -> '+', '/', '~' and '*' differ)."""
    e = F.url_encode(c)
    e = F.replace(e, F.lit("+"), F.lit("%20"))
    e = F.replace(e, F.lit("%2F"), F.lit("/"))
    e = F.replace(e, F.lit("%7E"), F.lit("~"))
    e = F.replace(e, F.lit("*"), F.lit("%2A"))
    return e
