"""Parts of a url as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased.

    Empty for a null url and for one without ``://``.
    """
    found = F.regexp_extract(url.cast("string"), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty where the host is undefined."""
    found = F.regexp_extract(url.cast("string"), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)
    return F.coalesce(found, F.lit(""))
