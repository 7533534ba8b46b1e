"""Names derived from users."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the schema prefix users' existing tables live under.
SCHEMA_PREFIX = "handson_"


def user_slug(user: Column, prefix: str = SCHEMA_PREFIX) -> Column:
    """Schema name for a user: the part before ``@``, lower case, other
    characters than ASCII letters and digits turned into ``_``.

    Different users can share a name (``a.b@x`` and ``a_b@y``); this is kept.
    """
    local_part = F.split_part(user, F.lit("@"), F.lit(1))
    return F.concat(F.lit(prefix), F.lower(F.regexp_replace(local_part, "[^0-9a-zA-Z]", "_")))
