"""Hot keys: one game / player / group holding a large share of the rows.

Results are checked against a brute-force pandas computation on the same
fixture; plans are checked to spread the hot group over several tasks.
"""

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from playlog.operators.joins import lookup_join
from playlog.operators.matches import running_score
from playlog.operators.sequence import CHUNK, number_rows, stable_range_chunks
from tests.conftest import rows


def _hot_log(spark):
    # game G0 has 6,000 lines, G1..G3 have 100 each; every 7th line carries a score
    sizes = {"G0": 6000, "G1": 100, "G2": 100, "G3": 100}
    recs = []
    for g, n in sizes.items():
        for i in range(1, n + 1):
            home = i if i % 7 == 0 else None
            away = i // 2 if i % 11 == 0 else None
            recs.append((g, i, home, away))
    return spark.createDataFrame(recs, "game_id string, line_no int, score_home_token int, score_away_token int")


def test_running_score_hot_game_matches_brute_force(spark):
    df = _hot_log(spark)
    got = rows(running_score(df, chunk_lines=256), "game_id", "line_no", "score_home", "score_away")
    pdf = df.toPandas().sort_values(["game_id", "line_no"])
    pdf["score_home"] = pdf.groupby("game_id")["score_home_token"].ffill().fillna(0).astype(int)
    pdf["score_away"] = pdf.groupby("game_id")["score_away_token"].ffill().fillna(0).astype(int)
    want = sorted(tuple(r) for r in pdf[["game_id", "line_no", "score_home", "score_away"]].itertuples(index=False))
    assert got == want


def test_hot_group_spans_range_chunks(spark):
    df = _hot_log(spark).select("game_id", "line_no")
    chunked = stable_range_chunks(df, ["game_id"], ["line_no"], n=8)
    per = chunked.where("game_id = 'G0'").groupBy(CHUNK).count().collect()
    assert len(per) >= 4  # the hot game is cut into several slices
    assert max(r["count"] for r in per) < 6000
    got = rows(number_rows(df, ["game_id"], [F.desc("line_no")], "n", n_chunks=8), "game_id", "line_no", "n")
    w = Window.partitionBy("game_id").orderBy(F.desc("line_no"))
    want = rows(df.select("game_id", "line_no", F.row_number().over(w).cast("long").alias("n")))
    assert got == want


def _hot_events(spark):
    # a third of the rows belong to one player, a third have no name token
    recs = []
    for i in range(3000):
        if i % 3 == 0:
            recs.append((i, "HOT", "T1"))
        elif i % 3 == 1:
            recs.append((i, None, None))
        else:
            recs.append((i, f"P{i % 40}", "T1"))
    return spark.createDataFrame(recs, "id int, name_token string, team string")


def _roster(spark):
    recs = [("HOT", "T1", "Hot, Player")] + [(f"P{i}", "T1", f"Player, {i}") for i in range(0, 40, 2)]
    return spark.createDataFrame(recs, "name_token string, team string, true_name string")


def test_shuffled_lookup_with_hot_and_null_keys(spark, no_broadcast):
    ev, ro = _hot_events(spark), _roster(spark)
    with no_broadcast():
        j = lookup_join(ev, ro, ["name_token", "team"], "left")
        shuffled = rows(j, "id", "true_name")
        assert "BroadcastHashJoin" not in j._jdf.queryExecution().executedPlan().toString()
    broadcast = rows(lookup_join(ev, ro, ["name_token", "team"], "left"), "id", "true_name")
    pdf = ev.toPandas().merge(ro.toPandas(), on=["name_token", "team"], how="left")
    want = sorted((int(r.id), None if pd.isna(r.true_name) else r.true_name) for r in pdf.itertuples())
    assert shuffled == broadcast == want


def test_null_keys_spread_over_tasks(spark, no_broadcast):
    """Rows without a key do not meet in one task of the shuffled join."""
    left = spark.range(4000).select(F.lit(None).cast("string").alias("k"), "id")
    right = spark.createDataFrame([("a", 1)], "k string, v int")
    with no_broadcast():
        j = lookup_join(left, right, ["k"]).select("id", "v", F.spark_partition_id().alias("p"))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            per = j.groupBy("p").count().collect()
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in per) == 4000 and max(r["count"] for r in per) < 2000


def test_aqe_splits_hot_join_partition(spark):
    keys = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        big = spark.range(60000).select(
            F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("P"), (F.col("id") % 997).cast("string"))).alias("name_token"),
            F.lit("T1").alias("team"), "id")
        ro = spark.range(997).select(F.concat(F.lit("P"), F.col("id").cast("string")).alias("name_token"),
                                     F.lit("T1").alias("team"), F.lit("x").alias("true_name"))
        ro = ro.unionByName(spark.createDataFrame([("HOT", "T1", "Hot")], "name_token string, team string, true_name string"))
        j = lookup_join(big, ro, ["name_token", "team"], "left")
        assert len(j.collect()) == 60000
        plan = j._jdf.queryExecution().executedPlan().toString()  # the final adaptive plan
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _half_hot(spark, n=30_000):
    """Half of the rows under one name, the rest under 500; some without a name or a roster row."""
    return spark.range(n).select(
        F.col("id").alias("line_no"),
        F.when(F.col("id") % 2 == 0, "S1").when(F.col("id") % 97 == 0, None)
        .otherwise(F.concat(F.lit("S"), (F.col("id") % 500).cast("string"))).alias("name_token"),
        F.when(F.col("id") % 89 == 0, None).otherwise(F.lit("H00")).alias("team"))


def _twice_named(spark):
    """Every name but each 25th, S1 on two lines."""
    r = spark.range(1, 500).where("id % 25 <> 0").select(
        F.concat(F.lit("S"), "id").alias("name"), F.concat(F.lit("Name "), "id").alias("true_name"), F.lit("H00").alias("team"),
        F.col("id").alias("ord"))
    return r.unionByName(r.where("name = 'S1'").withColumn("true_name", F.lit("Other")).withColumn("ord", F.lit(999).cast("long")))


def test_hot_names_are_found(spark):
    from playlog.operators.joins import hot_keys

    hot = hot_keys(_half_hot(spark), ["name_token", "team"], 0.05)
    assert len(hot) == 1 and "S1" in next(iter(hot)) and abs(next(iter(hot.values())) - 14_800) < 400
    assert hot_keys(_half_hot(spark).where("name_token is null"), ["name_token", "team"]) == {}
    assert hot_keys(_half_hot(spark).limit(0), ["name_token", "team"]) == {}


def test_salted_join_gives_the_same_rows(spark):
    from playlog.operators.joins import lookup_join, salted_lookup_join

    events, roster = _half_hot(spark), _twice_named(spark).withColumnRenamed("name", "name_token")
    keys = ["name_token", "team"]
    for how in ("left", "inner"):
        want = lookup_join(events, roster, keys, how)
        got = salted_lookup_join(events, roster, keys, how, rows_a_salt=1000)
        assert got.columns == want.columns and got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
    from playlog.operators.roster import resolve_players

    plain = resolve_players(events, _twice_named(spark))
    salted = resolve_players(events, _twice_named(spark), salt_hot=True)
    assert salted.columns == plain.columns and salted.exceptAll(plain).count() == 0 == plain.exceptAll(salted).count()


def test_salted_join_spreads_a_hot_name_without_aqe(spark, no_broadcast):
    """With AQE off the largest task of the plain join holds half of the rows, of the salted one a few salts."""
    from playlog.operators.joins import lookup_join, salted_lookup_join

    events, roster = _half_hot(spark), _twice_named(spark).withColumnRenamed("name", "name_token")
    keys = ["name_token", "team"]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        with no_broadcast():
            def largest(df):
                assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
                return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

            first = events.select(*keys, "line_no")
            assert largest(lookup_join(first, roster, keys)) > 14_000
            assert largest(salted_lookup_join(first, roster, keys, rows_a_salt=300)) < 6_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
