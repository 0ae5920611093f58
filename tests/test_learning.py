import inspect
import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from plymill.ml import cluster, frames, metrics, prep, train
from plymill.session import use_checkpoints


def auc(pairs):
    pos, neg = [s for y, s in pairs if y], [s for y, s in pairs if not y]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def average_precision(pairs):
    total, hits, last = 0.0, sum(y for y, _ in pairs), 0.0
    for cut in sorted({s for _, s in pairs}, reverse=True):
        chosen = [y for y, s in pairs if s >= cut]
        recall = sum(chosen) / hits
        total += (recall - last) * sum(chosen) / len(chosen)
        last = recall
    return total


def test_ranking_metrics_with_ties(spark):
    pairs = [(int((i * 7) % 5 == 0), ((i * 13) % 10) / 10) for i in range(60)]
    frame = spark.createDataFrame(pairs, "label int, score double")
    for scale, shift in ((1, 0), (1e9, -7)):
        row = metrics.ranking_metrics(frame.withColumn("score", F.col("score") * scale + shift)).first()
        assert math.isclose(row["roc_auc"], auc(pairs)) and math.isclose(row["pr_auc"], average_precision(pairs))
    one_class = metrics.ranking_metrics(frame.filter("label = 0")).first()
    assert one_class["roc_auc"] is None


def test_binary_and_threshold_metrics(spark):
    frame = spark.createDataFrame([(1, 0.9, 1), (1, 0.2, 0), (0, 0.6, 1), (0, 0.1, 0)], "label int, score double, prediction int")
    assert tuple(metrics.binary_metrics(frame).first()) == (0.5, 0.5, 0.5, 0.5)
    sweep = {r["threshold"]: r for r in metrics.threshold_sweep(frame).collect()}
    assert len(sweep) == 19 and sweep[0.95]["f1"] == 0.0 and sweep[0.65]["precision"] == 1.0
    none = metrics.binary_metrics(frame.withColumn("prediction", F.lit(0))).first()
    assert (none["precision"], none["f1"]) == (0.0, 0.0)


def test_multiclass_metrics(spark):
    rows = [(0, 0, [0.8, 0.1, 0.1]), (0, 2, [0.0, 0.0, 1.0]), (2, 2, [0.2, 0.2, 0.6]), (1, 1, [0.1, 0.9, 0.0])]
    frame = spark.createDataFrame(rows, "label int, prediction int, probabilities array<double>")
    row = metrics.multiclass_metrics(frame).first()
    assert row["accuracy"] == 0.75 and math.isclose(row["balanced_accuracy"], (0.5 + 1 + 1) / 3)
    assert math.isclose(row["macro_f1"], (2 / 3 + 1 + 2 / 3) / 3)
    expected = -(math.log(0.8) + math.log(metrics.EPSILON) + math.log(0.6) + math.log(0.9)) / 4
    assert math.isclose(row["log_loss"], expected)
    matrix = {r["label"]: list(r)[1:] for r in metrics.confusion_matrix(frame, [0, 1, 2]).collect()}
    assert matrix == {0: [1, 0, 1], 1: [0, 1, 0], 2: [0, 0, 1]}


def test_preparation(spark):
    frame = spark.createDataFrame([(1.0, None, "a", 1), (3.0, None, "b", 0), (None, None, "b", 0), (10.0, None, None, 0)], "x double, gone double, level string, y int")
    values = prep.medians(frame, ["x", "gone"])
    assert values == {"x": 3.0}
    assert prep.impute_numbers(frame, values).filter("x is null").count() == 0
    assert prep.impute_levels(frame, ["level"]).filter("level = 'b'").count() == 3
    assert sorted(r[0] or "" for r in prep.fold_rare(frame, "level", 2).select("level").collect()) == ["", prep.RARE_LEVEL, "b", "b"]
    assert {r["y"]: r["weight"] for r in prep.class_weights(frame, "y").collect()} == {1: 2.0, 0: 4 / 6}
    assert {r["y"]: r["weight"] for r in prep.class_weights(frame, "y", balanced=False).collect()} == {1: 3.0, 0: 1.0}
    with pytest.raises(frames.FrameError):
        frames.validate_classes(frame, "y", [0, 1], ["x"])
    with pytest.raises(frames.FrameError):
        frames.outcome_features("other")


def blunders(spark, n):
    return spark.range(n).select(
        F.concat(F.lit("k"), "id").alias("row_id"),
        (F.col("id") % 5 == 0).cast("int").alias("is_blunder"),
        *[(F.col("id") * p % 50 + F.when(F.col("id") % 5 == 0, 40).otherwise(0)).cast("double").alias(c) for p, c in zip((3, 7, 11, 13, 2, 1), frames.BLUNDER_NUMERIC, strict=True)],
        F.when(F.col("id") % 9 != 0, F.lit("opening")).alias("game_phase"),
        F.lit("blitz").alias("time_control_type"),
        F.concat(F.lit("e"), F.col("id") % 8).alias("square"),
    )


def test_blunder_training(spark):
    use_checkpoints(spark)
    trained = train.train_blunder(blunders(spark, 200), "row_id", trees=3)
    assert trained.scored.count() == 40
    row = trained.metrics.first()
    assert row["roc_auc"] > 0.9
    assert trained.importances.count() > 6


def test_metrics_read_stored_scores(spark, capsys):
    use_checkpoints(spark)
    fits = [
        train.train_blunder(blunders(spark, 200), "row_id", trees=2),
        train.train_outcome(outcomes(spark, 150), "game_id", "pre_game", trees=2),
    ]
    for trained in fits:
        capsys.readouterr()
        trained.scored.explain()
        trained.metrics.explain()
        plans = capsys.readouterr().out
        assert "FileScan parquet" in plans and "UDF" not in plans  # the trees are not walked again


def test_saved_model_scores_raw_rows(spark, tmp_path):
    use_checkpoints(spark)
    rows = blunders(spark, 200)
    trained = train.train_blunder(rows, "row_id", trees=3)
    trained.model.save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    number, level = frames.BLUNDER_NUMERIC[1], frames.BLUNDER_CATEGORIES[0]
    bare = rows.withColumn(number, F.lit(None).cast("double")).withColumn(level, F.lit("it's new"))
    scored = train.score_blunders(loaded, bare)
    assert scored.columns == [*bare.columns, "score", "prediction"]
    assert scored.filter(f"score between 0 and 1 and {number} is null").count() == rows.count()


def test_filler_folds_and_quotes(spark):
    frame = spark.createDataFrame([(1, "a\\'b"), (2, None), (None, "rare")], "n int, level string")
    stage = prep.filler({"n": 5.0}, {"level": "a\\'b"}, {"level": ["a\\'b"]})
    rows = {(r["n_filled"], r["level_filled"]) for r in stage.transform(frame).collect()}
    assert rows == {(1.0, "a\\'b"), (2.0, "a\\'b"), (5.0, prep.RARE_LEVEL)}


def test_outcome_training(spark):
    names = frames.OUTCOME_NUMERIC + frames.OUTCOME_PLAYED
    frame = spark.range(150).select(
        F.concat(F.lit("g"), "id").alias("game_id"),
        F.element_at(F.array(*[F.lit(r) for r in ("white_win", "black_win", "draw")]), (F.col("id") % 3 + 1).cast("int")).alias("result"),
        *[(F.col("id") % 3 * 10 + F.col("id") % 7).cast("double").alias(n) for n in names],
        *[F.concat(F.lit("c"), F.col("id") % 4).alias(n) for n in frames.OUTCOME_CATEGORIES],
    )
    trained = train.train_outcome(frame, "game_id", "pre_game", trees=5)
    assert trained.scored.count() == 30 and trained.metrics.first()["accuracy"] > 0.9


def test_player_clusters(spark):
    frame = spark.range(60).select(
        F.concat(F.lit("p"), "id").alias("player"), F.lit(20).alias("games_played"),
        *[(F.col("id") % 3 * (i + 1) + F.rand(i)).alias(c) for i, c in enumerate(frames.STYLE_FEATURES)],
    ).persist()
    found = cluster.cluster_players(frame, clusters=3)
    assert found.assignments.count() == 60 and found.assignments.filter("style_label is null").count() == 0
    labels = [r["style_label"] for r in found.profiles.collect()]
    assert len(set(labels)) == 3
    assert cluster.sweep(cluster.scaled(frame), 3, 4).count() == 2
    with pytest.raises(frames.FrameError):
        frames.validate_clusters(frame, 61)


def outcomes(spark, n):
    names = frames.OUTCOME_NUMERIC + frames.OUTCOME_PLAYED
    return spark.range(n).select(
        F.concat(F.lit("g"), "id").alias("game_id"),
        F.element_at(F.array(*[F.lit(r) for r in ("white_win", "black_win", "draw")]), (F.col("id") % 3 + 1).cast("int")).alias("result"),
        *[(F.col("id") % 3 * 10 + F.col("id") % 7).cast("double").alias(n) for n in names],
        *[F.concat(F.lit("c"), F.col("id") % 4).alias(n) for n in frames.OUTCOME_CATEGORIES],
    )


def test_boosted_outcomes_have_probabilities(spark, tmp_path):
    use_checkpoints(spark)
    rows = outcomes(spark, 150)
    trained = train.train_outcome(rows, "game_id", "post_game", trees=3, boosted=True)
    scored = trained.scored.collect()
    assert len(scored) == 30 and all(len(r.probabilities) == 3 and abs(sum(r.probabilities) - 1) < 1e-12 for r in scored)
    assert all(r.probabilities[r.prediction] == max(r.probabilities) for r in scored)
    row = trained.metrics.first()
    assert row["accuracy"] > 0.9 and 0 < row["log_loss"] < math.log(3)
    assert abs(trained.importances.agg(F.sum("importance")).first()[0] - 1) < 1e-9
    assert [m.getNumTrees for m in trained.model.stages[-3:]] == [3] * 3
    trained.model.save(str(tmp_path / "m"))
    raw = rows.withColumn("eco_code", F.lit("new")).withColumn("white_elo", F.lit(None).cast("double")).drop("result")
    again = train.score_outcomes(PipelineModel.load(str(tmp_path / "m")), raw)
    assert again.columns == [*raw.columns, "prediction", "probabilities"]
    assert again.filter("size(probabilities) = 3 and prediction between 0 and 2").count() == 150


def test_fit_reads_a_bounded_exact_sample(spark):
    use_checkpoints(spark)
    trained = train.train_blunder(blunders(spark, 1000), "row_id", trees=2, max_fit_rows=100)
    sizes = {r["class"]: (r.train_rows, r.fit_rows, r.test_rows) for r in trained.sizes.collect()}
    assert sizes == {0: (640, 80, 160), 1: (160, 20, 40)}
    assert trained.scored.count() == 200


def test_fitted_once(spark, tmp_path):
    use_checkpoints(spark)
    calls = []

    def fit():
        calls.append(1)
        return train.train_blunder(blunders(spark, 200), "row_id", trees=2)

    one, two = (train.fitted_once(spark, str(tmp_path / "kept"), fit) for _ in range(2))
    assert len(calls) == 1
    assert sorted(one.scored.collect()) == sorted(two.scored.collect())
    assert one.metrics.collect() == two.metrics.collect() and two.sizes.count() == 2
    assert train.score_blunders(two.model, blunders(spark, 20)).count() == 20


def test_registered_models_fit_all_trees(spark, small, monkeypatch, tmp_path):
    """The registered jobs use the full number of trees and share a fit; few trees are fitted here, for real."""
    from plymill import catalog

    asked = []
    blunder, outcome = train.train_blunder, train.train_outcome
    defaults = (inspect.signature(f).parameters["trees"].default for f in (blunder, outcome))
    assert tuple(defaults) == (250, 180)

    def few(real):
        def fit(*args, **options):
            asked.append(options.pop("trees", None))
            return real(*args, trees=2, **options)

        return fit

    monkeypatch.setattr(train, "train_blunder", few(blunder))
    monkeypatch.setattr(train, "train_outcome", few(outcome))
    monkeypatch.setattr(frames, "OUTCOME_SETS", {"pre_game": frames.OUTCOME_SETS["pre_game"]})
    monkeypatch.setattr(catalog, "model_path", lambda spark, folder, name: str(tmp_path / name))
    for name in ("m09_blunder_model", "m11_batch_scoring", "m26_o04_importances", "m10_outcome_models", "m10_boosted_outcome_models"):
        assert catalog.QUERIES[name](spark, small).count() > 0
    assert asked == [None] * 3  # one for three queries, and one of each kind for the outcomes
