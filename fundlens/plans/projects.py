"""Project groups: profiles that share enough attributes are one project."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fundlens import constants as K
from fundlens.functions.text import json_fields, none_if_blank, normalize_title, repo_owner
from fundlens.functions.times import epoch_ms_ts
from fundlens.operators.dedup import latest_per_group
from fundlens.operators.filters import drop_test_chains, require_title, valid_addresses
from fundlens.operators.groups import group_summary
from fundlens.operators.joins import attach_stats
from fundlens.operators.linking import connected_components, k_of_n_links
from fundlens.operators.numbering import number_rows
from fundlens.operators.sets import concat_profiles, order_lookup, order_totals
from fundlens.session import cut_lineage
from fundlens.sources.schemas import PROFILE_METADATA

PROFILE_ORDER = ["source", "project_id", *K.PROFILE_ATTRIBUTES]


def historical_profiles(past_grants: DataFrame, contributions: DataFrame) -> DataFrame:
    """Grants before the indexer with what they received."""
    received = contributions.groupBy("grant_id").agg(
        F.sum("amountUSD").alias("amount_donated"), F.max("created_on").alias("last_donation")
    )
    return attach_stats(past_grants, received, {"grantid": "grant_id"}).select(
        F.col("grantid").cast("string").alias("project_id"),
        F.col("name").alias("title"),
        F.col("websiteurl").alias("website"),
        F.lower("payoutaddress").alias("payout_address"),
        F.col("twitter").alias("project_twitter"),
        F.col("github").alias("project_github"),
        F.col("createdon").cast("timestamp").alias("created_at"),
        "amount_donated",
        "last_donation",
        F.lit(K.HISTORICAL_PROFILE_SOURCE).alias("source"),
    )


def indexed_profiles(applications: DataFrame) -> DataFrame:
    """Profiles from the metadata of indexed applications."""
    fields = drop_test_chains(applications).select(
        "project_id",
        "total_amount_donated_in_usd",
        json_fields(F.col("metadata"), PROFILE_METADATA)["application"].alias("application"),
    )
    project = F.col("application.project")
    return fields.select(
        "project_id",
        project["projectGithub"].alias("project_github"),
        project["projectTwitter"].alias("project_twitter"),
        project["title"].alias("title"),
        project["website"].alias("website"),
        F.col("application.recipient").alias("payout_address"),
        epoch_ms_ts(project["createdAt"]).alias("created_at"),
        F.col("total_amount_donated_in_usd").alias("amount_donated"),
        F.lit(K.INDEXED_PROFILE_SOURCE).alias("source"),
    )


def normalize_projects(historical: DataFrame, indexed: DataFrame, blank_is_value: bool = False) -> DataFrame:
    """Profiles of both sources with comparable attributes.

    Rows without a valid address or a title go. A missing or blank website,
    twitter or repository counts as missing and links nothing; pass
    ``blank_is_value=True`` to let blank values match each other.
    """
    both = concat_profiles(historical, indexed)
    clean = both.withColumns(
        {
            "payout_address": F.lower("payout_address"),
            "title": normalize_title(F.col("title")),
            "project_twitter": F.lower("project_twitter"),
            "project_github": repo_owner(F.col("project_github")),
        }
    )
    if not blank_is_value:
        blanks = ["website", "project_twitter", "project_github"]
        clean = clean.withColumns({c: none_if_blank(F.col(c)) for c in blanks})
    # Behind a generator the filters stay where they are; pushed to the sources, each of them would parse
    # the documents and normalize the titles once more.
    made = clean.select(F.inline_outer(F.array(F.struct(*clean.columns))))
    return require_title(valid_addresses(made, "payout_address"))


def assign_group_ids(components: DataFrame) -> DataFrame:
    """Component of each row to a dense id as text, in order of the components' least rows."""
    distinct = components.select("component").distinct()
    dense = number_rows(distinct, ["component"], "_n").select(
        F.col("component").alias("_component"), (F.col("_n") - 1).cast("string").alias("group_id")
    )
    joined = components.join(dense, components["component"] == dense["_component"])
    return joined.select("row_id", "group_id")


def _tuple_key(attributes: list[str]) -> Column:
    """Digest of all attributes, missing ones told apart from empty ones."""
    texts = [F.col(a).cast("string") for a in attributes]
    parts = [F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def tuple_components(numbered: DataFrame, attributes: list[str], k: int) -> DataFrame:
    """(row_id, component): components of the rows' links, searched among distinct attribute tuples.

    Equal profiles are linked whenever ``k`` of their attributes are known, so the
    least row of each distinct tuple stands for all of them: links and components
    are those of the tuples, however often each of them occurs. Rows with fewer
    known attributes link with nothing and are components of their own.
    """
    known = sum((F.col(a).isNotNull().cast("int") for a in attributes), F.lit(0))
    keyed = numbered.select("row_id", *attributes, F.when(known >= k, _tuple_key(attributes)).alias("_tuple"))
    # The attributes are keys beside their digest, which makes no other groups: as aggregates of
    # texts they would have every row sorted before the first copies collapse.
    tuples = keyed.where(F.col("_tuple").isNotNull()).groupBy("_tuple", *attributes).agg(F.min("row_id").alias("row_id"))
    # Read again for links and nodes: distinct tuples, mostly far fewer than rows.
    tuples = cut_lineage(tuples, "tuples")
    found = connected_components(k_of_n_links(tuples, attributes, k), tuples)
    component = tuples.select("_tuple", "row_id").join(found, "row_id").select("_tuple", "component")
    # Written, so that the join back meets two plain shuffles and a hot tuple is split.
    component = cut_lineage(component, "labels")
    rows = keyed.select("row_id", "_tuple").join(component, "_tuple", "left")
    return rows.select("row_id", F.coalesce("component", "row_id").alias("component"))


def grouped_projects(
    profiles: DataFrame,
    attributes: list[str] | None = None,
    k: int = K.MIN_SHARED_ATTRIBUTES,
    order: list[str] | None = None,
) -> DataFrame:
    """Profiles with ``row_id`` and ``group_id``; rows are numbered in the order of their attributes."""
    attributes = attributes or K.PROFILE_ATTRIBUTES
    numbered = number_rows(profiles, order or PROFILE_ORDER, "row_id")
    ids = assign_group_ids(cut_lineage(tuple_components(numbered, attributes, k), "row-components"))
    return numbered.join(ids, "row_id")


def project_lookup(grouped: DataFrame) -> DataFrame:
    """Group of each project, sorted by group id as text."""
    return order_lookup(grouped.select("group_id", "project_id", "source"))


def project_groups_summary(grouped: DataFrame) -> DataFrame:
    """Newest profile of each group with the group's totals, largest donated total first."""
    newest = latest_per_group(grouped, "group_id", "created_at", "row_id").select(
        "group_id",
        "title",
        F.col("project_id").alias("latest_created_project_id"),
        *[
            F.col(c).alias(f"latest_{c}")
            for c in ["website", "payout_address", "project_twitter", "project_github", "source"]
        ],
    )
    return order_totals(newest.join(group_summary(grouped), "group_id"), "total_amount_donated")


def project_groups(historical: DataFrame, indexed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(project_lookup, project_groups_summary)."""
    grouped = grouped_projects(normalize_projects(historical, indexed))
    return project_lookup(grouped), project_groups_summary(grouped)
