"""Session settings and the per-user namespace."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.names import SCHEMA_PREFIX, user_slug

# Fixed value: the catalog that is tried first.
PREFERRED_CATALOG = "workspace"

# What the plans rely on. Adaptive execution splits skewed join partitions and
# merges small ones; UTC makes month starts independent of the machine.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@dataclass(frozen=True)
class Namespace:
    user: str
    catalog: str
    schema: str

    def table(self, name: str) -> str:
        return f"`{self.catalog}`.`{self.schema}`.`{name}`"


def session_user(spark: SparkSession) -> tuple[str, str]:
    """Current user and current catalog."""
    row = spark.sql("SELECT current_user() AS user, current_catalog() AS catalog").first()
    return row["user"], row["catalog"]


def session_facts(spark: SparkSession) -> dict[str, Column]:
    """What can be said of user and catalog without naming them."""
    user, catalog = session_user(spark)
    return {
        "user_known": F.current_user() == F.lit(user),
        "user_is_session_user": F.current_user() == F.session_user(),
        "catalog_is_current": F.current_catalog() == F.lit(catalog),
    }


# The property of a schema that tells whose it is, as the SHA-256 of the user's name.
OWNER = "ledgerloom.owner_sha256"


class NamespaceTaken(PermissionError):
    """Another user's name gives the same schema."""


def owner_of(spark: SparkSession, schema: str) -> str | None:
    described = spark.sql(f"DESCRIBE SCHEMA EXTENDED {schema}").collect()
    said = re.search(rf"{re.escape(OWNER)},([0-9a-f]{{64}})", " ".join(str(r[1]) for r in described))
    return said[1] if said else None


def open_namespace(
    spark: SparkSession,
    preferred_catalog: str = PREFERRED_CATALOG,
    prefix: str = SCHEMA_PREFIX,
    location: str | None = None,
) -> Namespace:
    """Create the user's schema if missing and make it current.

    The preferred catalog is used if it can hold the schema, otherwise the
    current one. ``location`` sets the schema's folder. Different users can have one schema
    name; the schema belongs to the first, who is recorded in it when it is created (or, if
    it has no record, when it is first opened), and the others get :class:`NamespaceTaken`
    before anything is changed.
    """
    user, current = session_user(spark)
    schema = spark.range(1).select(user_slug(F.lit(user), prefix)).first()[0]
    at = f" LOCATION '{location}'" if location else ""
    owner = hashlib.sha256(user.encode()).hexdigest()
    at += f" WITH DBPROPERTIES ('{OWNER}' = '{owner}')"
    catalog = preferred_catalog
    try:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{catalog}`.`{schema}`{at}")
    except AnalysisException:
        catalog = current
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{catalog}`.`{schema}`{at}")
    name = f"`{catalog}`.`{schema}`"
    if owner_of(spark, name) is None:
        spark.sql(f"ALTER SCHEMA {name} SET DBPROPERTIES ('{OWNER}' = '{owner}')")
    if owner_of(spark, name) not in (owner, None):
        raise NamespaceTaken(f"schema {name} belongs to another user than {user}; choose another prefix")
    spark.sql(f"USE {name}")
    return Namespace(user, catalog, schema)
