"""Opening performance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plymill.operators.keyed import heaviest

KEYS = ["eco_code", "opening_family", "elo_bucket", "time_control_type", "year"]


def moves_column(games: DataFrame) -> str:
    """Our move array, or one supplied by the user in coordinate form."""
    return "moves_san" if "moves_san" in games.columns else "moves_uci"


def opening_performance(games: DataFrame) -> DataFrame:
    """Volume, result rates, mean length and the most common reply per opening, level and year."""
    reply = F.try_element_at(F.col(moves_column(games)), F.lit(2))
    per_reply = (
        games.withColumn("reply", reply)
        .groupBy(*KEYS, "reply")
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("result") == "white_win").alias("w"),
            F.count_if(F.col("result") == "black_win").alias("b"),
            F.count_if(F.col("result") == "draw").alias("d"),
            F.sum("game_length").alias("length_sum"),
            F.count("game_length").alias("length_n"),
        )
    )
    return per_reply.groupBy(*KEYS).agg(
        F.sum("n").alias("games_count"),
        (F.sum("w") / F.sum("n")).alias("white_win_rate"),
        (F.sum("b") / F.sum("n")).alias("black_win_rate"),
        (F.sum("d") / F.sum("n")).alias("draw_rate"),
        F.try_divide(F.sum("length_sum"), F.sum("length_n")).alias("avg_game_length"),
        heaviest("reply", "n").alias("most_common_response"),
    )
