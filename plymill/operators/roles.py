"""Two rows per game, one for each player, from a single scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _seat(own: str, other: str, names: dict[str, str], shared: list[str], extra: dict[str, tuple[str, str]]) -> Column:
    index = 0 if own == "white" else 1
    fields = [
        F.lit(own).alias("seat"),
        F.col(names[own]).alias("player"),
        F.col(f"{own}_elo").alias("elo"),
        (F.col("result") == f"{own}_win").alias("won"),
        (F.col("result") == f"{other}_win").alias("lost"),
        (F.col("result") == "draw").alias("drew"),
    ]
    fields += [F.col(pair[index]).alias(name) for name, pair in extra.items()]
    return F.struct(*fields, *shared)


def player_rows(
    games: DataFrame,
    shared: list[str],
    extra: dict[str, tuple[str, str]] | None = None,
    names: dict[str, str] | None = None,
) -> DataFrame:
    """Explode each game into its two seats.

    ``shared`` columns are repeated on both rows; ``extra`` maps a new column
    to its (white, black) source columns.
    """
    names, extra = names or {"white": "white", "black": "black"}, extra or {}
    seats = F.array(
        _seat("white", "black", names, shared, extra),
        _seat("black", "white", names, shared, extra),
    )
    return games.select(F.explode(seats).alias("row")).select("row.*")
