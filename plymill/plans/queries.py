"""Parameterised queries over the gold tables.

Optional arguments add a predicate only when given, so the plan stays prunable.
Orderings end with every grouping column, which makes limits repeatable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plymill import schemas
from plymill.functions import scalars as S


def where(df: DataFrame, **equal: object) -> DataFrame:
    """Equality predicates for the arguments that are not None."""
    for name, value in equal.items():
        if value is not None:
            df = df.filter(F.col(name) == F.lit(value))
    return df


def matching(df: DataFrame, column: str, text: str | None) -> DataFrame:
    """Case-insensitive substring match; ``%`` and ``_`` in ``text`` stay wildcards."""
    if not text:
        return df
    return df.filter(F.ilike(F.col(column), F.lit(f"%{text}%")))


def _smallest_filled(column: str) -> Column:
    """A representative value that does not depend on row order."""
    return F.min(column)


def opening_stats(
    openings: DataFrame, code: str | None = None, opening: str | None = None, year: int | None = None, limit: int = 50
) -> DataFrame:
    """Opening rows re-aggregated, largest first.  Rates are plain means of the stored rates."""
    keys = ["eco_code", "opening_family", "elo_bucket", "time_control_type", "year"]
    chosen = where(matching(openings, "opening_family", opening), eco_code=code, year=year)
    return (
        chosen.groupBy(*keys)
        .agg(
            F.sum("games_count").alias("games_count"),
            S.stable_round(F.avg("white_win_rate"), 4).alias("white_win_rate"),
            S.stable_round(F.avg("black_win_rate"), 4).alias("black_win_rate"),
            S.stable_round(F.avg("draw_rate"), 4).alias("draw_rate"),
            S.stable_round(F.avg("avg_game_length"), 1).alias("avg_game_length"),
            _smallest_filled("most_common_response").alias("most_common_response"),
        )
        .orderBy(F.desc("games_count"), *keys)
        .limit(limit)
    )


def opening_summary(openings: DataFrame, weighted: bool = True) -> DataFrame:
    """Rates per code over all levels, weighted by games unless told otherwise."""
    rates = ["white_win_rate", "black_win_rate", "draw_rate", "avg_game_length"]
    games = F.sum("games_count")

    def mean(name: str) -> Column:
        value = F.sum(F.col(name) * F.col("games_count")) / games if weighted else F.avg(name)
        return S.stable_round(value, 4).alias(name)

    return openings.groupBy("eco_code").agg(games.alias("games_count"), *[mean(name) for name in rates])


def player_leaderboard(
    players: DataFrame, search: str | None = None, year: int | None = None, limit: int | None = 50
) -> DataFrame:
    board = (
        where(matching(players, "player", search), year=year)
        .groupBy("player")
        .agg(
            F.sum("games_played").alias("games_played"),
            S.stable_round(F.avg("win_rate"), 4).alias("avg_win_rate"),
            S.stable_round(F.avg("avg_elo"), 1).alias("avg_elo"),
            _smallest_filled("most_played_opening_white").alias("white_opening"),
            _smallest_filled("most_played_opening_black").alias("black_opening"),
        )
        .orderBy(F.desc("games_played"), "player")
    )
    return board.limit(limit) if limit is not None else board


def player_profile(players: DataFrame, player: str) -> DataFrame:
    """One player's months in order; the name matches in any case."""
    rows = players.filter(F.lower("player") == F.lower(F.lit(player)))
    return rows.select(*schemas.column_names(schemas.PLAYER_MONTHS)).orderBy("year", "month", "player")


def years(openings: DataFrame, players: DataFrame) -> DataFrame:
    both = openings.select("year").union(players.select("year")).distinct()
    return both.filter(F.col("year").isNotNull()).orderBy(F.desc("year"))


def time_pressure_stats(time_pressure: DataFrame, year: int | None = None) -> DataFrame:
    """Bucket totals with the loss weighted by evaluated positions."""
    evaluated = F.sum("evaluated_positions")
    loss = F.sum(F.coalesce("avg_cp_loss", F.lit(0.0)) * F.coalesce("evaluated_positions", F.lit(0)))
    keys = ["time_remaining_bucket", "game_phase", "time_control_type"]
    return (
        where(time_pressure, year=year)
        .groupBy(*keys)
        .agg(
            F.sum("games_count").alias("games_count"),
            evaluated.alias("evaluated_positions"),
            F.sum("blunder_count").alias("blunder_count"),
            S.stable_round(F.try_divide(loss, evaluated), 1).alias("avg_cp_loss"),
            S.stable_round(F.try_divide(F.sum("blunder_count"), evaluated), 4).alias("blunder_rate"),
        )
        .orderBy("time_control_type", "game_phase", "time_remaining_bucket")
    )


def in_display_order(df: DataFrame) -> DataFrame:
    """Add the display ranks of bucket and phase and sort by them."""
    ranked = df.withColumns(
        {
            "bucket_rank": S.display_rank(F.col("time_remaining_bucket"), schemas.TIME_BUCKETS),
            "phase_rank": S.display_rank(F.col("game_phase"), schemas.PHASES),
        }
    )
    return ranked.orderBy("bucket_rank", "phase_rank", "time_control_type")


def outcome_long(openings: DataFrame) -> DataFrame:
    """Result rates as rows (outcome, rate) with display labels."""
    rates = ["white_win_rate", "black_win_rate", "draw_rate"]
    long = openings.unpivot(["eco_code", "opening_family"], rates, "outcome", "rate")
    label = (
        F.when(F.col("outcome") == "white_win_rate", "White wins")
        .when(F.col("outcome") == "black_win_rate", "Black wins")
        .otherwise("Draws")
    )
    return long.withColumn("outcome", label)


def recommendations(
    openings: DataFrame,
    player_rating: int | None = None,
    time_control: str | None = None,
    goal: str = "win",
    limit: int = 10,
    bucket: str | None = None,
) -> DataFrame:
    """Best openings for a level and control, by draw rate or (any other goal) by win rate."""
    chosen = openings.filter(F.col("games_count") >= 5)
    if player_rating is not None:
        chosen = chosen.filter(F.col("elo_bucket") == S.rating_label(F.lit(player_rating)))
    chosen = where(chosen, elo_bucket=bucket, time_control_type=time_control)
    target = "draw_rate" if goal == "draw" else "white_win_rate"
    columns = [c for c in schemas.column_names(schemas.OPENINGS) if c != "year"]
    ties = ["eco_code", "opening_family", "elo_bucket", "time_control_type", "year"]
    return chosen.orderBy(F.desc(target), F.desc("games_count"), *ties).limit(limit).select(*columns)


def blunder_heatmap(positions: DataFrame, year: int | None = None) -> DataFrame:
    return (
        where(positions, year=year)
        .filter(F.col("cp_loss").isNotNull())
        .groupBy("square")
        .agg(
            F.count("*").alias("evaluated_positions"),
            F.count_if("is_blunder").alias("blunders"),
            S.stable_round(F.avg("cp_loss"), 1).alias("avg_cp_loss"),
            F.max("cp_loss").alias("max_cp_loss"),
        )
        .orderBy(F.desc("blunders"), F.desc("avg_cp_loss"), "square")
    )


def heatmap_totals(heatmap: DataFrame) -> DataFrame:
    """Totals of a heatmap; zeros when it is empty."""
    return heatmap.agg(
        F.coalesce(F.sum("evaluated_positions"), F.lit(0)).alias("evaluated_positions"),
        F.coalesce(F.sum("blunders"), F.lit(0)).alias("blunders"),
        F.coalesce(F.max("max_cp_loss"), F.lit(0)).alias("max_cp_loss"),
    )


def board_grid(heatmap: DataFrame, value: str = "blunders") -> DataFrame:
    """All 64 squares with their value (0 when absent) and its share of the largest value."""
    letters = F.explode(F.array(*[F.lit(c) for c in "abcdefgh"]))
    grid = (
        heatmap.sparkSession.range(1, 9)
        .select(F.col("id").cast("int").alias("rank"), letters.alias("file"))
        .withColumn("square", F.concat("file", "rank"))
    )
    # a heatmap has one row per square, so its maximum is a tiny scalar
    top = heatmap.agg(F.max(value).cast("double").alias("top")).scalar()
    joined = grid.join(heatmap.select("square", F.col(value).alias("value")), "square", "left")
    filled = joined.withColumn("value", F.coalesce(F.col("value").cast("double"), F.lit(0.0)))
    share = F.coalesce(F.try_divide(F.col("value"), F.nullif(F.coalesce(top, F.lit(0.0)), F.lit(0.0))), F.lit(0.0))
    return filled.select("square", "file", "rank", "value", share.alias("intensity"))


def overview(players: DataFrame, openings: DataFrame, time_pressure: DataFrame, positions: DataFrame) -> DataFrame:
    """One row of totals; each table is aggregated once, on its own."""
    quality = positions.agg(F.struct(F.count("cp_loss").alias("n"), F.count_if("is_blunder").alias("bad")).alias("q"))

    def rows(df: DataFrame) -> Column:
        return df.agg(F.count("*").alias("n")).scalar()

    one = players.sparkSession.range(1).withColumn("q", quality.scalar())
    return one.select(
        rows(players).alias("player_profile_rows"),
        rows(openings).alias("opening_rows"),
        rows(time_pressure).alias("time_pressure_rows"),
        F.col("q.n").alias("evaluated_positions"),
        F.col("q.bad").alias("blunders"),
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count and state of every named table."""
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("rows")) for name, df in tables.items()
    ]
    united = counts[0]
    for other in counts[1:]:
        united = united.unionByName(other)
    return united.withColumn("status", F.when(F.col("rows") > 0, "ready").otherwise("empty"))


def opening_kpis(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count("*").alias("group_count"),
        F.coalesce(F.sum("games_count"), F.lit(0)).alias("games"),
        F.count_distinct("eco_code").alias("codes"),
        S.stable_round(F.avg("avg_game_length"), 2).alias("avg_length"),
    )


def player_kpis(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.coalesce(F.sum("games_played"), F.lit(0)).alias("games"),
        S.stable_round(F.avg("avg_elo"), 2).alias("avg_elo"),
        S.stable_round(F.avg("win_rate"), 4).alias("win_rate"),
        F.count("*").alias("months"),
    )


def heatmap_kpis(heatmap: DataFrame) -> DataFrame:
    return heatmap.agg(
        F.coalesce(F.sum("evaluated_positions"), F.lit(0)).alias("evaluated_positions"),
        F.coalesce(F.sum("blunders"), F.lit(0)).alias("blunders"),
        S.stable_round(F.avg("avg_cp_loss"), 2).alias("avg_cp_loss"),
        F.max("max_cp_loss").alias("worst_cp_loss"),
    )


def time_pressure_kpis(rows: DataFrame, controls: list[str] | None = None) -> DataFrame:
    """Totals over the chosen controls, with the pooled blunder rate."""
    chosen = rows.filter(F.col("time_control_type").isin(controls)) if controls else rows
    evaluated, blunders = F.sum("evaluated_positions"), F.sum("blunder_count")
    return chosen.agg(
        F.coalesce(F.sum("games_count"), F.lit(0)).alias("clock_positions"),
        F.coalesce(evaluated, F.lit(0)).alias("evaluated_positions"),
        F.coalesce(blunders, F.lit(0)).alias("blunders"),
        S.stable_round(F.avg("avg_cp_loss"), 2).alias("avg_cp_loss"),
        S.stable_round(F.try_divide(blunders, evaluated), 4).alias("blunder_rate"),
    )
