"""From stored posts to rows of the publish table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.functions.calendar import AsOf, stored_on
from postflow.functions.ids import keyed_uid, public_id, random_uid
from postflow.operators.dedupe import latest_crawl
from postflow.operators.matching import bounded_broadcast
from postflow.schemas import POST_PUBLISH

# Flags of a freshly published row.
NEW_FLAGS = {"is_sent": 0, "spam": 0, "completed": 0, "bot_id": "bot_cron"}


def publish_posts(stored: DataFrame, org_codes: DataFrame, as_of: AsOf = None, *, random_ids: bool = False) -> DataFrame:
    """Posts stored on the day, with organisation code, public id and flags; one row per (url, org_id).

    The code table is broadcast only if its measured size allows it, so that normally the posts are not
    shuffled by organisation; beyond that, adaptive execution splits a hot organisation. Ids derive from (url, org_id) so that a
    retried task writes the same row; ``random_ids`` draws them at random instead.
    """
    today = stored_on(stored, "createdAt", as_of)
    coded = today.join(bounded_broadcast(org_codes.select("code", "org_id")), "org_id")
    uid = random_uid() if random_ids else keyed_uid(["url", "org_id"])
    # which row stays is settled on stored columns, before any id is drawn
    kept = latest_crawl(coded, ["url", "org_id"], tiebreak="post_id")
    flagged = kept.withColumns({name: F.lit(value) for name, value in NEW_FLAGS.items()})
    return flagged.withColumn("uid", uid).withColumn("id", public_id()).select(*POST_PUBLISH.names)
