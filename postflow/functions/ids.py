"""Identifiers of stored and published rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parts of the public id, and the length of its last part.
PUBLIC_ID_PARTS = ("code", "crawl_source_code", "source_type", "auth_type", "doc_type", "uid")
UID_LENGTH = 16


def post_id(url: str = "url", org_id: str = "org_id") -> Column:
    """``url-org``; a NULL part is skipped."""
    return F.concat_ws("-", url, org_id)


def keyed_uid(keys: Sequence[str]) -> Column:
    """16 hex digits derived from the row's keys: the same row gets the same id in every run and retry."""
    return F.substring(F.md5(F.concat_ws("-", *keys)), 1, UID_LENGTH)


def random_uid(seed: int | None = None) -> Column:
    """16 hex digits from a row number and a random value; differs between evaluations of the plan."""
    draw = F.rand() if seed is None else F.rand(seed)
    row = F.monotonically_increasing_id()
    return F.substring(F.md5(F.concat(row.cast("string"), draw.cast("string"))), 1, UID_LENGTH)


def public_id() -> Column:
    """Published id made of the organisation code, source descriptors and ``uid``; NULL parts are skipped."""
    return F.concat_ws("-", *PUBLIC_ID_PARTS)
