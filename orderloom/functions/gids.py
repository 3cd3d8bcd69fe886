"""Global ids: `gid://<app>/<EntityType>/<key>`."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ENTITY_PATTERN = r"^gid://[^/]+/([^/]+)/"
KEY_PATTERN = r"^gid://[^/]+/[^/]+/(.+)$"


def first_group(text: Column, pattern: str) -> Column:
    # The plain extraction gives "" for no match, and telling that from a match
    # would evaluate the pattern twice.
    return F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(0))


def entity_type(gid: Column) -> Column:
    """Entity type of a global id; null for anything that is not one."""
    return first_group(gid, ENTITY_PATTERN)


def gid_key(gid: Column) -> Column:
    return first_group(gid, KEY_PATTERN)


def make_gid(entity: str, *parts: Column, app: str = "shop") -> Column:
    """Build an id; several key parts are joined with a dash."""
    return F.concat(F.lit(f"gid://{app}/{entity}/"), F.concat_ws("-", *[p.cast("string") for p in parts]))


def is_entity(gid: Column, entity: str, app: str | None = None) -> Column:
    """Whether an id is of a type.  With the app known this is a prefix test, which
    scans understand; without it the type is taken from the id."""
    return gid.startswith(f"gid://{app}/{entity}/") if app else entity_type(gid) == entity
