"""From crawled posts to stored posts, one row per (url, organisation)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.functions.calendar import AsOf, in_publish_window, stored_stamp
from postflow.functions.ids import post_id
from postflow.functions.phrases import org_keywords, spam_terms
from postflow.operators.dedupe import keep_latest, latest_crawl
from postflow.operators.matching import (
    DEFAULT_LIMITS,
    DictionaryCache,
    MatchLimits,
    drop_spam,
    has_text,
    match_terms,
    org_sets,
    with_lower,
    without_lower,
)
from postflow.operators.row_keys import row_digest
from postflow.schemas import POST_STORED, conform
from postflow.session import stage


def to_stored(posts: DataFrame, as_of: AsOf = None, null_url: str = "reject") -> DataFrame:
    """Id, stamps and flag added; projected to the stored schema; latest crawl kept per ``post_id``.

    A NULL url would make all such posts of an organisation one row. They are rejected by default, as the
    store's own contract demands; ``null_url="collapse"`` keeps that one row.
    """
    checked = _checked_url(posts, null_url)
    return _stored(latest_crawl(checked.withColumn("post_id", post_id()), ["post_id"]), as_of)


def _checked_url(posts: DataFrame, null_url: str) -> DataFrame:
    if null_url not in ("reject", "collapse"):
        raise ValueError(f"null_url must be reject or collapse, not {null_url!r}")
    return posts.filter(F.col("url").isNotNull()) if null_url == "reject" else posts


def _stored(kept: DataFrame, as_of: AsOf) -> DataFrame:
    stamps = {"pg_sync": F.lit(False), "createdAt": stored_stamp(as_of), "updatedAt": stored_stamp(as_of)}
    return conform(kept.withColumns(stamps), POST_STORED)


def _latest_of_sets(posts: DataFrame) -> DataFrame:
    """Posts with ``org_ids`` to one row per ``post_id`` with ``org_id``, of the latest crawl.

    The posts are written once; which of them stays for an organisation is settled on their ids and times alone. A text moves
    once, to the organisations it stays for, and is repeated for these only after that.
    """
    columns = [c for c in posts.columns if c != "org_ids"]
    held = stage(posts.withColumns({"_row": F.monotonically_increasing_id(), "_tie": F.xxhash64(*[F.col(c) for c in columns])}))
    few = [c for c in ("url", "crawl_time", "id") if c in columns]
    slim = held.select("_row", "_tie", *few, F.explode("org_ids").alias("org_id")).withColumn("post_id", post_id()).drop("url")
    order = [F.col(c).desc_nulls_last() for c in few if c != "url"]
    stays = keep_latest(slim, ["post_id"], [*order, F.col("_tie")]).groupBy("_row").agg(F.collect_list("org_id").alias("org_ids"))
    spread = held.drop("org_ids", "_tie").join(stays, "_row").select(*columns, F.explode("org_ids").alias("org_id"))
    return spread.withColumn("post_id", post_id())


def classify_posts(
    posts: DataFrame,
    orgs: DataFrame,
    as_of: AsOf = None,
    *,
    encoded_spam: bool = True,
    null_url: str = "reject",
    limits: MatchLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Posts of the publish window, without spam, assigned to every organisation whose keywords occur."""
    recent = has_text(posts.filter(in_publish_window(F.col("pub_time"), as_of)))
    lowered = with_lower(recent, "content")
    clean = drop_spam(lowered, spam_terms(orgs, encoded_spam), limits=limits)
    sets = without_lower(org_sets(_checked_url(clean, null_url), org_keywords(orgs), limits=limits))
    return _stored(_latest_of_sets(sets.filter(F.size("org_ids") > 0)), as_of)


def normalise_classified(posts: DataFrame, as_of: AsOf = None, *, null_url: str = "reject") -> DataFrame:
    """Posts that arrive with an organisation: same window and output, no spam or text filter."""
    return to_stored(posts.filter(in_publish_window(F.col("pub_time"), as_of)), as_of, null_url)


def classify_all(
    posts: DataFrame,
    orgs: DataFrame,
    *,
    how: str = "left",
    encoded_spam: bool = False,
    limits: MatchLimits = DEFAULT_LIMITS,
    cache: DictionaryCache | None = None,
) -> DataFrame:
    """One row per (post, matching dictionary entry) with its ``org_id``; unmatched posts stay with NULL.

    Nothing is reduced: two keywords of one organisation give two rows. ``how="inner"`` drops the unmatched.
    With a ``cache`` the dictionary is the one of the version begun there.
    """
    clean = drop_spam(with_lower(posts, "content"), spam_terms(orgs, encoded_spam), limits=limits, cache=cache)
    return match_terms(clean, org_keywords(orgs), how=how, limits=limits, cache=cache).select(*posts.columns, "org_id")


def classify_collapsed(
    posts: DataFrame,
    orgs: DataFrame,
    keys: Sequence[str] = ("post_id", "content"),
    *,
    encoded_spam: bool = False,
    limits: MatchLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """One row per ``keys``, of the latest crawl, with the sorted set of its organisations; unmatched posts stay, with none.

    ``keys`` must hold ``content``, so that rows with equal keys have equal organisations. These are found before anything is
    shuffled, as one array per post: no aggregation holds a text, and it is shuffled once and not for every keyword.
    """
    if "content" not in keys:
        raise ValueError("keys must hold content")
    clean = drop_spam(with_lower(posts, "content"), spam_terms(orgs, encoded_spam), limits=limits)
    sets = without_lower(org_sets(clean, org_keywords(orgs), limits=limits))
    keyed = sets.withColumn("_key", row_digest(sets.select(*keys).schema))
    return keep_latest(keyed, ["_key"], [F.col("crawl_time").desc_nulls_last()]).drop("_key")
