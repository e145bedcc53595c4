"""Parts of urls as columns."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F


def host_of(url: str) -> Column:
    """From after the first :// up to /, ? or # or the end, A-Z lower-cased; empty for null or no ://."""
    found = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), "://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: str) -> Column:
    """From the end of the host up to ? or # or the end."""
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), "://[^/?#]*([^?#]*)", 1)
