"""Crawl permission as a join with a table of rules.

Rules: ``(robots_url, group_ord, agent, rule_ord, path_prefix, allow)``. A group is one block of agents and
rules in a site's file; ``group_ord`` and ``rule_ord`` give the order in that file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from placefolio.functions.urls import percent_decoded, robots_address, robots_target, without_empty_parts
from placefolio.operators.hot_keys import hot_keys, join_on_unique, spread_join


def rules_from_answers(answers: DataFrame) -> DataFrame:
    """Rules that stand for a server's refusal, from ``(robots_url, http_status)``.

    401, 403 and server errors forbid the whole site; other client errors leave no rule, so all is allowed.
    """
    refused = F.col("http_status").isin(401, 403) | (F.col("http_status") >= 500)
    return answers.where(refused).select(
        "robots_url", F.lit(0).alias("group_ord"), F.lit("*").alias("agent"), F.lit(0).alias("rule_ord"),
        F.lit("/").alias("path_prefix"), F.lit(False).alias("allow"))


def rule_prefix() -> Column:
    return without_empty_parts(percent_decoded(F.col("path_prefix")))


def rules_in_force(rules: DataFrame, user_agent: str) -> DataFrame:
    """The one rule that counts per site and prefix for this agent.

    The first group naming a part of the agent's name decides for a site, else its first ``*`` group. Within
    the group a later rule for the same prefix never applies.
    """
    token = user_agent.split("/")[0].lower()
    named = F.contains(F.lit(token), F.lower("agent"))
    chosen = (rules.groupBy("robots_url", "group_ord")
              .agg(F.bool_or(F.col("agent") == "*").alias("fallback"), F.bool_or(named).alias("named"))
              .where(F.col("fallback") | F.col("named"))
              .groupBy("robots_url").agg(F.min(F.struct("fallback", "group_ord")).alias("_group"))
              .select("robots_url", F.col("_group.group_ord").alias("_chosen")))
    # "Disallow:" with nothing behind it allows everything.
    allow = F.col("allow") | (F.col("path_prefix") == "")
    return (join_on_unique(rules, chosen, "robots_url").where(F.col("group_ord") == F.col("_chosen"))
            .groupBy("robots_url", rule_prefix().alias("prefix"))
            .agg(F.min(F.struct("rule_ord", allow.alias("allow"))).alias("rule")))


def with_permission(visits: DataFrame, rules: DataFrame, user_agent: str) -> DataFrame:
    """Add ``robots_url`` and ``robots_allowed`` to distinct rows with a ``url``.

    The first rule in file order whose prefix starts the URL's path decides; without one it is allowed.
    A URL is cut to the prefix lengths its site has rules in force for and meets them in an equi-join, so a site with
    many URLs and many rules never compares each with each.
    """
    # Distinct lengths only, so at most as many as the longest rule has characters.
    in_force = rules_in_force(rules, user_agent)
    lengths = in_force.groupBy("robots_url").agg(F.collect_set(F.length("prefix")).alias("_lengths"))
    asked = (visits.withColumn("robots_url", robots_address(F.col("url")))
             .withColumn("_target", robots_target(F.col("url"))))
    hot = hot_keys(asked, "robots_url")
    fitting = F.filter("_lengths", lambda n: n <= F.length("_target"))
    cut = (spread_join(asked, lengths, ["robots_url"], hot, "left")
           .withColumn("prefix", F.explode_outer(
               F.transform(fitting, lambda n: F.substring(F.col("_target"), F.lit(1), n))))
           .select(*visits.columns, "robots_url", "prefix"))
    return (spread_join(cut, in_force, ["robots_url", "prefix"], hot, "left")
            .groupBy(*visits.columns, "robots_url")
            .agg(F.coalesce(F.min("rule").getField("allow"), F.lit(True)).alias("robots_allowed")))
