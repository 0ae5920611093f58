import re

from pyspark.sql import functions as F

from plymill import catalog
from plymill.plans import silver
from plymill.sources import lake, tables


def below(plan, marker):
    """The lines of a plan under the first one with ``marker``."""
    lines = plan.split("\n")
    return "\n".join(lines[next(i for i, line in enumerate(lines) if marker in line) + 1 :])


def test_silver_is_gathered_by_month_before_it_is_parsed(spark, small):
    """The parsed rows, which are much wider, were shuffled."""
    rows = silver.silver_games(silver.by_month(catalog.bronze(spark, small)))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "moves_san" in plan and not re.search("moves_san|clock_seconds|moves_lower", below(plan, "RebalancePartitions"))


def test_stored_silver_has_the_same_rows_and_few_files(spark, small, tmp_path, monkeypatch):
    """Each writer gathered the finished rows by its partition keys."""
    seen, write = [], lake.write_partitions
    monkeypatch.setattr(lake, "write_partitions", lambda *args, **options: (seen.append(options.get("gather", True)), write(*args, **options)))
    path = str(tmp_path / "silver")
    silver.store(catalog.bronze(spark, small), path, catalog.reference(spark, small))
    assert seen == [False]
    stored, expected = spark.read.parquet(path), catalog.games(spark, small)
    columns = sorted(expected.columns)
    assert stored.select(columns).exceptAll(expected.select(columns)).count() == 0 == expected.select(columns).exceptAll(stored.select(columns)).count()
    files = stored.select("year", "month", F.input_file_name().alias("file")).distinct().groupBy("year", "month").count()
    assert files.agg(F.max("count")).first()[0] == 1


def test_rows_are_dealt_by_the_rule_of_their_id(spark, small):
    """The id itself was shuffled as well; grouping by it needs no second shuffle."""
    games = tables.raw_games(spark, small, dealt=True)
    plan = games.filter("game_id is not null").groupBy("game_id").agg(F.min("white"))._jdf.queryExecution().executedPlan().toString()
    by_id = [line for line in plan.split("\n") if "Exchange hashpartitioning(" in line and "l_orderkey#" in line and "CASE WHEN" in line]
    assert len(by_id) == 1 and "Exchange hashpartitioning(game_id" not in plan
