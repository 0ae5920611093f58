import random

from pyspark.sql import functions as F

from plymill.operators import board


def stepwise(changes):
    balance, seen = 0, []
    for change in changes:
        seen.append(balance)
        balance = -(balance + change)
    return seen


def rows():
    draw = random.Random(5)
    games = [[draw.choice([0, 0, 0, 100, 320, 800]) for _ in range(n)] for n in (1, 2, 3, 7, 40, 301)]
    return [*games, [], None, [0] * 9, [100], [0, 900], [500, 0]]


def test_balance_is_summed_over_the_moves_that_change_it(spark):
    """It was an array that grew by every move, copied whole each time."""
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows())], "i int, changes array<int>")
    frame = frame.withColumn("moved", board.changing(F.col("changes")))
    found = frame.withColumn("balances", board.balance_before(F.col("changes"), F.col("moved"))).orderBy("i").collect()
    for row, changes in zip(found, rows(), strict=True):
        assert row["balances"] == (None if changes is None else stepwise(changes))
        assert row["moved"] == [i for i, change in enumerate(changes or []) if change]
