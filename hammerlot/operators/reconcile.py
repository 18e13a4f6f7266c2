"""Exact reconciliation of agents with an authority table: by label, else by alias, else none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hammerlot.functions import text as T


def reconcile_agents(agents: DataFrame, authority: DataFrame, key: str = "agent_id", label: str = "label") -> DataFrame:
    """``(key, label, wikidata_id, wikidata_label, match_type)`` for every agent.

    Names are compared by their slugs. match_type is ``label`` or ``alias``; where several entries match in the better
    way the one with the smallest id is taken. An agent without a match, or with a null label, has nulls there.
    """
    entries = authority.select("wikidata_id", "wikidata_label", "aliases")
    labels = entries.select("wikidata_id", "wikidata_label", F.expr(T.slug("wikidata_label")).alias("name"), F.lit(0).alias("rank"))
    aliases = entries.where("aliases is not null").select("wikidata_id", "wikidata_label", F.explode(F.expr(T.parts("aliases"))).alias("alias"))
    aliases = aliases.select("wikidata_id", "wikidata_label", F.expr(T.slug("alias")).alias("name"), F.lit(1).alias("rank"))
    names = labels.unionByName(aliases).where("name <> ''")
    # One best entry per name, so the join repeats no agent.
    best = names.groupBy("name").agg(F.min(F.struct("rank", "wikidata_id", "wikidata_label")).alias("b"))
    rows = agents.select(F.col(key).alias("key"), F.col(label).alias("label"), F.expr(T.slug(label)).alias("name"))
    joined = rows.join(best, "name", "left")
    kind = F.when(F.col("b.rank") == 0, "label").when(F.col("b.rank") == 1, "alias")
    return joined.select(F.col("key").alias(key), "label", F.col("b.wikidata_id").alias("wikidata_id"), F.col("b.wikidata_label").alias("wikidata_label"), kind.alias("match_type"))
