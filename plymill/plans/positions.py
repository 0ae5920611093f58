"""Evaluated positions: one row per half-move with its loss against the evaluation before it."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import AbstractContextManager, ExitStack
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plymill import schemas
from plymill.functions import scalars as S
from plymill.operators import board
from plymill.operators.keyed import check_fraction, hash_order, hash_sample
from plymill.plans.openings import moves_column

BLUNDER_CP = 200


def sample_games(
    games: DataFrame, fraction: float, seed: int = 42, max_games: int | None = None
) -> DataFrame:
    """Games with moves, thinned by the hash of their id; ``max_games`` keeps those first in hash order."""
    playable = games.filter(F.size(moves_column(games)) > 0)
    check_fraction(fraction)
    sampled = hash_sample(playable, "game_id", fraction, seed) if fraction < 1 else playable
    if max_games is None:
        return sampled
    return sampled.orderBy(hash_order(F.col("game_id"), seed), "game_id").limit(max_games)


def evaluations_per_game(evaluations: DataFrame, max_plies: int | None = None) -> DataFrame:
    """All scores of a game in one row: an array with the score after every ply from 0.

    Repeats of a ply collapse first (the smallest score counts), so a list is as long as
    its game at most.  Plies without a score are nulls.
    """
    useful = evaluations.filter(F.col("game_id").isNotNull() & (F.col("ply") >= 0))
    if max_plies is not None:
        useful = useful.filter(F.col("ply") <= max_plies)
    # one shuffle by game serves both steps
    unique = useful.repartition("game_id").groupBy("game_id", "ply").agg(F.min("eval_cp").alias("eval_cp"))
    listed = unique.groupBy("game_id").agg(F.array_sort(F.collect_list(F.struct("ply", "eval_cp"))).alias("entries"))
    before = F.concat(F.array(F.lit(-1)), F.slice(F.col("entries.ply"), F.lit(1), F.size("entries") - 1))

    def padded(entry: Column, last: Column) -> Column:
        gap = F.array_repeat(F.lit(None).cast("int"), (entry["ply"] - last - 1).cast("int"))
        return F.concat(gap, F.array(entry["eval_cp"].cast("int")))

    return listed.select("game_id", F.flatten(F.zip_with("entries", before, padded)).alias("scores"))


def played_positions(games: DataFrame, max_plies: int | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per half-move with everything the move array and clocks can tell."""
    moves = F.col(moves_column(games))
    moves = moves if max_plies is None else F.slice(moves, 1, max_plies)
    inputs = games.select(
        "game_id",
        moves.alias("moves"),
        *[c for c in ("clock_seconds", "time_control_type", "year", "white_elo", "black_elo") if c in games.columns],
        *carry,
    )
    squares, pieces = board.arrivals(F.col("moves"))
    prepared = (
        inputs.withColumns({"squares": squares, "pieces": pieces})
        .withColumn("changes", board.material_changes(F.col("moves"), F.col("squares"), F.col("pieces")))
        .withColumn("moved", board.changing(F.col("changes")))
        .withColumn("balances", board.balance_before(F.col("changes"), F.col("moved")))
    )
    index = F.col("index")
    # the optimizer guards an inner explode by a filter that parses every text again, an outer one it leaves alone
    exploded = prepared.select("*", F.posexplode_outer("moves").alias("index", "move")).filter("index is not null")
    return exploded.select(
        "game_id",
        (index + 1).alias("ply_number"),
        "move",
        F.get("squares", index * 2).alias("square"),
        S.phase_of_ply(index + 1).alias("game_phase"),
        "time_control_type",
        "year",
        F.when(index % 2 == 0, F.col("white_elo")).otherwise(F.col("black_elo")).alias("player_elo"),
        F.get("clock_seconds", index).alias("time_remaining_seconds"),
        F.get("balances", index).alias("material_balance"),
        board.gives_check(F.get("moves", index - 1)).alias("is_in_check"),
        *carry,
    )


def evaluated_positions(
    games: DataFrame,
    evaluations: DataFrame,
    *,
    fraction: float = 1.0,
    seed: int = 42,
    max_games: int | None = None,
    max_plies: int | None = None,
    threshold_cp: int = BLUNDER_CP,
) -> DataFrame:
    """Positions with the mover's evaluation before and after, the loss and the blunder flag.

    ``evaluations`` has a row per score (game_id, ply, eval_cp), or one row per game with all its
    ``scores`` as a list by ply from 0.  The scores join once per game, before the moves are spread out, so the wide
    rows are never shuffled.  A half-move without both scores keeps nulls.
    """
    # games without moves give no positions, so a whole table needs no filter on them
    chosen = games if fraction == 1 and max_games is None else sample_games(games, fraction, seed, max_games)
    if fraction < 1:
        evaluations = hash_sample(evaluations, "game_id", fraction, seed)
    lists = evaluations if "scores" in evaluations.columns else evaluations_per_game(evaluations, max_plies)
    scored = chosen.join(lists.select("game_id", "scores"), "game_id", "left")
    view = F.when(F.col("ply_number") % 2 == 1, 1).otherwise(-1)
    loss = F.col("eval_before_cp") - F.col("eval_after_cp")
    return (
        played_positions(scored, max_plies, carry=("scores",))
        .withColumns(
            {
                "eval_before_cp": F.get("scores", F.col("ply_number") - 1) * view,
                "eval_after_cp": F.get("scores", F.col("ply_number")) * view,
            }
        )
        .withColumn("cp_loss", F.when(loss.isNotNull(), F.greatest(F.lit(0), loss)))
        .withColumn("is_blunder", F.col("cp_loss") >= threshold_cp)
        .select(*schemas.column_names(schemas.POSITIONS))
    )


def score_with(
    games: DataFrame,
    resource: Callable[[], AbstractContextManager[Any]],
    score: Callable[[Any, str, list[str]], Iterable[tuple[int, int]]],
) -> DataFrame:
    """Evaluations (game_id, ply, eval_cp) from a user's own scorer.

    ``resource`` opens what scoring needs, such as an engine process.  It is entered once for each
    partition that has games, and left when the partition ends, fails, or is no longer read.
    ``score`` gets it with the id and the moves of a game, and gives any number of (ply, score).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ExitStack() as stack:
            opened: list[Any] = []
            for batch in batches:
                if not opened and len(batch):
                    opened.append(stack.enter_context(resource()))
                ids, moves = batch.iloc[:, 0], batch.iloc[:, 1]
                rows = [(i, *s) for i, m in zip(ids, moves, strict=True) for s in score(opened[0], i, [] if m is None else list(m))]
                yield pd.DataFrame(rows, columns=["game_id", "ply", "eval_cp"])

    return games.select("game_id", moves_column(games)).mapInPandas(run, schemas.EVALUATIONS)
