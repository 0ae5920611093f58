from plymill import catalog
from plymill.ml import prep, train


def test_feature_sets_share_one_frame(spark, small, monkeypatch):
    """The frame holds the features of all sets, but was derived anew from the raw table for each."""
    made, fitted = [], []

    def fit(frame, key, name, *, boosted):
        fitted.append((frame, name))
        scored = spark.sql("select 0 as label, 0 as prediction, array(0.5D, 0.25D, 0.25D) as probabilities")
        sizes = spark.sql("select 0 as class, 4L as train_rows, 4L as fit_rows, 1L as test_rows")
        return train.Trained(None, scored, spark.sql("select 0.7D as log_loss"), None, sizes)

    monkeypatch.setattr(catalog, "_outcome_training", lambda *_: made.append("frame") or f"frame {len(made)}")
    monkeypatch.setattr(train, "train_outcome", fit)
    monkeypatch.setattr(train, "fitted_once", lambda _spark, _path, job: job())
    monkeypatch.setattr(train, "complete", lambda *_: False, raising=False)
    rows = catalog.QUERIES["m10_boosted_outcome_models"](spark, small).collect()
    assert sorted(fitted) == [("frame 1", "post_game"), ("frame 1", "pre_game")]
    assert sorted(r["feature_set"] for r in rows) == ["post_game", "pre_game"] and all(r["n_sound"] == 1 for r in rows)


def test_levels_are_counted_and_filled_in_from_a_stored_table(spark, small, monkeypatch):
    """Each of the two steps derived all rows from the raw table."""
    read, impute = [], prep.impute_levels

    def seen(frame, columns):
        read.extend(frame.inputFiles())
        return impute(frame, columns)

    monkeypatch.setattr(prep, "impute_levels", seen)
    assert catalog.QUERIES["m05_one_hot"](spark, small).count() == 4
    assert read and not [path for path in read if "lineitem" in path]
