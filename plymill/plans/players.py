"""Monthly player statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plymill.operators.keyed import heaviest
from plymill.operators.roles import player_rows


def player_months(games: DataFrame) -> DataFrame:
    """Games, results, ratings and favourite openings per player and month.

    Two steps, both with map-side partial sums: first per opening and seat,
    then per player, so that the favourite opening needs no per-player map.
    """
    keys = ["player", "year", "month"]
    per_opening = (
        player_rows(games, ["year", "month", "eco_code"])
        .groupBy(*keys, "seat", "eco_code")
        .agg(
            F.count("*").alias("n"),
            F.count_if("won").alias("w"),
            F.count_if("lost").alias("l"),
            F.count_if("drew").alias("d"),
            F.sum("elo").alias("elo_sum"),
            F.count("elo").alias("elo_n"),
            F.max("elo").alias("elo_max"),
            F.min("elo").alias("elo_min"),
        )
    )
    seats = per_opening.withColumns(
        {f"{seat}_code": F.when(F.col("seat") == seat, F.col("eco_code")) for seat in ("white", "black")}
    )
    return seats.groupBy(*keys).agg(
        F.sum("n").alias("games_played"),
        F.sum("w").alias("wins"),
        F.sum("l").alias("losses"),
        F.sum("d").alias("draws"),
        (F.sum("w") / F.sum("n")).alias("win_rate"),
        F.try_divide(F.sum("elo_sum"), F.sum("elo_n")).alias("avg_elo"),
        (F.max("elo_max") - F.min("elo_min")).alias("elo_change"),
        heaviest("white_code", "n").alias("most_played_opening_white"),
        heaviest("black_code", "n").alias("most_played_opening_black"),
    )
