"""Dictionary entries: the spellings and encodings keyword and spam lists arrive in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Encoding of one spam phrase as JSON and as legacy text.
PHRASE_JSON = "struct<match_phrase:struct<content:string>>"
PHRASE_TEXT = r"content=([^}]*)\}"


def without_blanks(terms: Column) -> Column:
    """Drop NULL and blank terms; a blank term would occur in every text."""
    return F.filter(terms, lambda t: F.trim(t) != "")


def phrases_from_json(entries: Column) -> Column:
    """``['{"match_phrase":{"content":"x"}}', ...]`` -> ``['x', ...]``; other entries become NULL."""
    return F.transform(entries, lambda e: F.from_json(e, PHRASE_JSON)["match_phrase"]["content"])


def phrases_from_structs(entries: Column) -> Column:
    """The same phrases where the source already delivers them as nested structs."""
    return entries["match_phrase"]["content"]


def phrases_from_text(text: Column) -> Column:
    """``[{match_phrase={content=A}}, {match_phrase={content=B c}}]`` -> ``['A', 'B c']``."""
    found = F.regexp_extract_all(text, F.lit(PHRASE_TEXT), F.lit(1))
    return F.filter(F.transform(found, lambda p: F.trim(p)), lambda t: t != "")


def bracket_list(text: Column) -> Column:
    """``[a,b]`` -> ``['a', 'b']``; parts are kept as they are."""
    return F.split(F.regexp_replace(text, r"[\[\]]", ""), ",")


def bracket_objects(text: Column) -> Column:
    """``[{..}, {..}]`` -> the trimmed text of each object, split at the inner braces."""
    return F.transform(F.split(F.regexp_replace(text, r"^\[|\]$", ""), r"\}, \{"), lambda o: F.trim(o))


def org_keywords(orgs: DataFrame) -> DataFrame:
    """(org_id, keyword): one row per dictionary entry; repeated entries stay repeated."""
    return orgs.select("org_id", F.explode(without_blanks(F.col("keywords"))).alias("keyword"))


def spam_terms(orgs: DataFrame, encoded: bool = True) -> DataFrame:
    """(term): distinct spam phrases over all organisations.

    ``encoded`` says whether the entries are JSON strings (batch dictionary) or plain phrases.
    """
    entries = F.col("spamwords")
    if encoded:
        entries = phrases_from_json(entries)
    return orgs.select(F.explode(without_blanks(entries)).alias("term")).distinct()
