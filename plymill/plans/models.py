"""Dimensional models over silver and gold: staging, dimensions, intermediate tables and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plymill import schemas
from plymill.functions import scalars as S
from plymill.operators.roles import player_rows
from plymill.sources.lake import write_partitions

STAGED_NAMES = {"white": "white_player", "black": "black_player"}

# Staged column -> type; arrays pass through.
STAGED_TYPES = """
    game_id string, white_player string, black_player string, white_elo int,
    black_elo int, result string, termination string, result_reason string,
    eco_code string, opening_family string, opening_variation string,
    time_control_type string, base_time_seconds int, increment_seconds int,
    game_date date, game_length int, has_clock_data boolean,
    clock_seconds array<int>, has_capture boolean, capture_count int,
    white_castled boolean, black_castled boolean, legal_prefix_length int,
    has_bot_player boolean, moves_san array<string>, batch_id string
"""


def cast_to(df: DataFrame, ddl: str, rename: dict[str, str] | None = None) -> list[F.Column]:
    """Projection of ``df`` onto a contract; ``rename`` maps contract names to source names."""
    rename = rename or {}
    columns = []
    for part in ddl.split(","):
        name, kind = part.split(maxsplit=1)
        columns.append(F.col(rename.get(name, name)).cast(kind.strip()).alias(name))
    return columns


def staged_games(silver: DataFrame) -> DataFrame:
    """Cast silver to the staging contract; year and month come from the date again."""
    rename = {new: old for old, new in STAGED_NAMES.items()}
    if "moves_san" not in silver.columns:
        rename["moves_san"] = "moves_uci"
    typed = silver.filter(F.col("game_id").isNotNull()).select(*cast_to(silver, STAGED_TYPES, rename))
    return typed.withColumns({"year": F.year("game_date"), "month": F.month("game_date")})


def _staged_rows(staged: DataFrame, shared: list[str]) -> DataFrame:
    rows = player_rows(staged, shared, names=STAGED_NAMES)
    return rows.filter(F.col("player").isNotNull())


def staged_players(staged: DataFrame) -> DataFrame:
    return (
        _staged_rows(staged, ["game_date"])
        .groupBy("player")
        .agg(
            F.min("game_date").alias("first_seen_date"),
            F.max("game_date").alias("last_seen_date"),
            F.count("*").alias("games_seen"),
            F.avg("elo").alias("avg_elo"),
        )
    )


def staged_openings(staged: DataFrame) -> DataFrame:
    return (
        staged.filter(F.col("eco_code").isNotNull())
        .groupBy("eco_code", "opening_family", "opening_variation")
        .agg(F.count("*").alias("games_seen"), F.avg("game_length").alias("avg_game_length"))
    )


def dim_players(staged: DataFrame) -> DataFrame:
    return staged_players(staged).select(F.md5("player").alias("player_key"), "*")


def dim_openings(staged: DataFrame) -> DataFrame:
    key = S.surrogate_key(F.col("eco_code"), F.col("opening_family"), F.col("opening_variation"))
    return staged_openings(staged).select(key.alias("opening_key"), "*")


def dim_time_controls(staged: DataFrame) -> DataFrame:
    columns = ["time_control_type", "base_time_seconds", "increment_seconds"]
    distinct = staged.filter(F.col("time_control_type").isNotNull()).select(*columns).distinct()
    return distinct.select(S.surrogate_key(*[F.col(c) for c in columns]).alias("time_control_key"), *columns)


def enriched_results(staged: DataFrame) -> DataFrame:
    return staged.select(
        "game_id",
        "white_player",
        "black_player",
        "white_elo",
        "black_elo",
        "result",
        S.winner(F.col("result"), F.col("white_player"), F.col("black_player")).alias("winner"),
        S.numeric_rating_bucket(F.col("white_elo"), F.col("black_elo")).alias("elo_bucket"),
        "eco_code",
        "opening_family",
        "opening_variation",
        "time_control_type",
        "game_date",
        "year",
        "month",
        "game_length",
        "has_clock_data",
    )


def player_rating_history(staged: DataFrame) -> DataFrame:
    """Monthly results per player, with the change of the mean rating since the player's last month.

    The window sees the aggregated months of one player, never the games.
    """
    months = (
        _staged_rows(staged, ["year", "month"])
        .groupBy("player", "year", "month")
        .agg(
            F.count("*").alias("games_played"),
            F.count_if("won").alias("wins"),
            F.count_if("lost").alias("losses"),
            F.count_if("drew").alias("draws"),
            (F.count_if("won") / F.count("*")).alias("win_rate"),
            F.avg("elo").alias("avg_elo"),
        )
    )
    by_time = Window.partitionBy("player").orderBy("year", "month")
    return months.withColumn("elo_change", F.col("avg_elo") - F.lag("avg_elo").over(by_time))


def _mart(df: DataFrame, ddl: str) -> DataFrame:
    """A contract with its changes of rating as doubles; counts stay 64 bits wide."""
    return df.select(*cast_to(df, ddl.replace("elo_change bigint", "elo_change double").replace("elo_change int", "elo_change double")))


def mart_player_profile(player_months: DataFrame) -> DataFrame:
    return _mart(player_months.filter(F.col("player").isNotNull()), schemas.PLAYER_MONTHS)


def mart_opening_analysis(openings: DataFrame) -> DataFrame:
    return _mart(openings.filter(F.col("eco_code").isNotNull()), schemas.OPENINGS)


def mart_time_pressure(time_pressure: DataFrame) -> DataFrame:
    return _mart(time_pressure, schemas.TIME_PRESSURE)


def mart_blunder_heatmap(positions: DataFrame) -> DataFrame:
    return (
        positions.filter(F.col("is_blunder"))
        .groupBy("square")
        .agg(F.count("*").alias("blunders"), F.avg(F.col("cp_loss").cast("double")).alias("avg_cp_loss"))
    )


def build(
    silver: DataFrame, player_months: DataFrame, openings: DataFrame, time_pressure: DataFrame, positions: DataFrame
) -> dict[str, DataFrame]:
    """All models by name."""
    staged = staged_games(silver)
    return {
        "stg_games": staged,
        "stg_players": staged_players(staged),
        "stg_openings": staged_openings(staged),
        "dim_players": dim_players(staged),
        "dim_openings": dim_openings(staged),
        "dim_time_controls": dim_time_controls(staged),
        "int_game_results_enriched": enriched_results(staged),
        "int_player_elo_history": player_rating_history(staged),
        "mart_player_profile": mart_player_profile(player_months),
        "mart_opening_analysis": mart_opening_analysis(openings),
        "mart_time_pressure": mart_time_pressure(time_pressure),
        "mart_blunder_heatmap": mart_blunder_heatmap(positions),
    }


def publish(models: dict[str, DataFrame], root: str) -> None:
    """Staging and intermediate models become views, dimensions and marts become tables."""
    for name, df in models.items():
        if name.startswith(("dim_", "mart_")):
            path = f"{root.rstrip('/')}/{name}"
            write_partitions(df, path)
            df = df.sparkSession.read.parquet(path)
        df.createOrReplaceTempView(name)


def orphans(facts: DataFrame, fact_key: str, dimension: DataFrame, dimension_key: str) -> DataFrame:
    """Distinct fact keys with no row in the dimension."""
    keys = facts.select(F.col(fact_key).alias("key")).filter(F.col("key").isNotNull()).distinct()
    return keys.join(dimension.select(F.col(dimension_key).alias("key")), "key", "left_anti")
