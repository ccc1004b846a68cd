"""Approximate match of names that the roster does not have.

Two names within k edits (letters inserted, left out or replaced) become equal
when at most k letters are left out of each. So both sides are exploded to the
names that remain after up to k deletions, and meet by an equi-join on (team,
remainder); the edit distance itself decides. Only distinct (team, name) pairs
take part, and how many edits count grows with a name's length, so short names,
of which nearly all resemble each other, share no remainder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlog.operators.roster import reduce_roster

# letters of a name for each edit that is allowed in it
LETTERS_AN_EDIT = 3


def _without_one(name: Column) -> Column:
    places = F.sequence(F.lit(1), F.length(name))
    shorter = F.transform(places, lambda i: F.concat(name.substr(F.lit(1), i - 1), name.substr(i + 1, F.length(name))))
    return F.when(F.length(name) > 0, shorter).otherwise(F.expr("cast(array() as array<string>)"))


def remainders(name: Column, edits: Column, most: int) -> Column:
    """Distinct names after leaving out up to ``edits`` letters (at most ``most``)."""
    layer = found = F.array(name)
    for k in range(1, most + 1):
        layer = F.array_distinct(F.flatten(F.transform(layer, _without_one)))
        layer = F.when(edits >= k, layer).otherwise(F.expr("cast(array() as array<string>)"))
        found = F.array_union(found, layer)
    return found


def allowed_edits(name: Column, most: int) -> Column:
    """Edits that a name may differ by: one for each LETTERS_AN_EDIT letters, at most ``most``."""
    return F.least(F.lit(most), F.floor(F.length(name) / LETTERS_AN_EDIT)).cast("int")


def similar_names(pairs: DataFrame, roster: DataFrame, most: int = 2) -> DataFrame:
    """For each distinct (team, name_token) the nearest roster names of its team.

    Columns: team, name_token, distance (null: none near enough), candidates (how
    many true names lie at that distance), similar_name (the true name, where it
    is the only one at that distance) and similar_names (all of them, sorted).
    A name that is in the roster has distance 0. Null and empty names drop out.
    """
    left = pairs.select("team", "name_token").filter("name_token <> '' and team is not null").distinct()
    edits = allowed_edits(F.col("name_token"), most)
    probes = left.select("*", edits.alias("edits")).select(
        "*", F.explode(remainders(F.col("name_token"), F.col("edits"), most)).alias("rest"))
    names = reduce_roster(roster.filter("name <> ''")).filter("true_name <> ''")
    targets = names.select(F.col("team").alias("r_team"), "name", "true_name", F.explode(
        remainders(F.col("name"), F.lit(most), most)).alias("r_rest"))
    met = (probes.join(targets, (F.col("team") == F.col("r_team")) & (F.col("rest") == F.col("r_rest")))
           .select("team", "name_token", "edits", "name", "true_name").distinct())
    near = (met.withColumn("distance", F.levenshtein("name_token", "name", most))
            .filter(F.col("distance").between(0, F.col("edits"))))
    best = near.groupBy("team", "name_token", "distance").agg(F.sort_array(F.collect_set("true_name")).alias("found"))
    first = best.groupBy("team", "name_token").agg(F.min_by(F.struct("distance", "found"), "distance").alias("b"))
    out = left.join(first, ["team", "name_token"], "left")
    found = F.coalesce("b.found", F.expr("cast(array() as array<string>)"))
    return out.select("team", "name_token", F.col("b.distance").alias("distance"), F.size(found).alias("candidates"),
                      F.when(F.size(found) == 1, F.get(found, 0)).alias("similar_name"), found.alias("similar_names"))
