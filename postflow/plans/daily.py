"""The daily run: classify, normalise, publish; a failing step stops the ones after it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from postflow.functions.calendar import AsOf
from postflow.operators.incremental import LoadReport, append_missing
from postflow.plans.classify import classify_posts, normalise_classified
from postflow.plans.publish import publish_posts
from postflow.schemas import POST_STORED
from postflow.session import staging_scope
from postflow.sources.readers import read_source
from postflow.sources.specs import SinkSpec, SourceSpec
from postflow.sources.writers import check_target


@dataclass(frozen=True)
class DailyConfig:
    raw_posts: SourceSpec
    classified_posts: SourceSpec
    orgs: SourceSpec
    stored_posts: SourceSpec
    store: SinkSpec
    publish: SinkSpec


def daily_run(spark: SparkSession, config: DailyConfig, as_of: AsOf = None) -> dict[str, LoadReport]:
    """Run the three steps in order. An exception in one leaves the later ones undone."""
    check_target(spark, config.publish)
    orgs = read_source(spark, config.orgs)
    reports = {}
    with staging_scope():
        posts = classify_posts(read_source(spark, config.raw_posts), orgs, as_of)
        reports["classify"] = append_missing(posts, config.store, ["post_id"])
    posts = normalise_classified(read_source(spark, config.classified_posts), as_of)
    reports["normalise"] = append_missing(posts, config.store, ["post_id"])
    stored = read_source(spark, config.stored_posts).select(*POST_STORED.names)
    reports["publish"] = append_missing(publish_posts(stored, orgs, as_of), config.publish, ["url", "org_id"])
    return reports
