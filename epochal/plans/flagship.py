"""The feature table: panel, form, pair history, lagged averages and ratings, one row a match and player."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epochal.functions import features as fx
from epochal.operators import panel, ratings, scans
from epochal.plans.rating_queries import ROUND
from epochal.plans.temporal_queries import ORDER, form_shares, month, pair_history, won
from epochal.sources import tables


def features(spark, sf_dir) -> DataFrame:
    m = tables.matches(spark, sf_dir)
    s = tables.stats(spark, sf_dir).select("id", fx.ratio(F.col("won_points"), F.col("all_points")).alias("kpi"))
    met = pair_history(m, ["player_a", "player_b"]).select("id", "player_a", F.coalesce("met", F.lit(0)).alias("met"), F.coalesce("a_wins", F.lit(0)).alias("a_wins"))
    elo = ratings.elo_by_round(m, ORDER, ROUND).select("id", "winner_elo", "loser_elo")
    p = scans.means(form_shares(panel.unpivot(m).join(s, "id", "left")), ["player_code"], month(), ORDER, {"kpi_mean": (F.col("kpi"), 5)})
    p = p.join(met, "id").join(elo, "id")
    mine = F.when(F.col("player_code") == F.col("player_a"), F.col("a_wins")).otherwise(F.col("met") - F.col("a_wins"))
    return p.select(
        "id",
        "player_code",
        "opponent_code",
        won().cast("int").alias("target"),
        "form_5",
        "kpi_mean",
        fx.smoothed(mine, F.col("met"), 8.0).alias("h2h_rate"),
        F.when(won(), F.col("winner_elo") - F.col("loser_elo")).otherwise(F.col("loser_elo") - F.col("winner_elo")).alias("elo_diff"),
    )
