"""URL and host expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Network location of an absolute URL, with port and user info (fixed pattern).
NETLOC = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)"


def netloc(url: Column) -> Column:
    """Host with port and user info; empty where there is none. Unlike ``parse_url`` it takes hosts with ``_``."""
    return F.regexp_extract(url, NETLOC, 1)


def bare_host(domain: Column, url: Column) -> Column:
    """``domain`` (else the host of ``url``) in lower case without user info and port; null where neither is given."""
    first = F.when(F.trim(domain) != "", F.trim(domain))
    host = F.coalesce(first, netloc(F.trim(url)))
    host = F.regexp_replace(F.regexp_replace(F.lower(host), r"^.*@", ""), r":\d*$", "")
    return F.when(host != "", host)
