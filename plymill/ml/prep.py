"""Preparation steps: imputation, rare levels, weights, labels, scaling."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plymill.operators.keyed import exact_medians, heaviest
from plymill.session import scratch_path

RARE_LEVEL = "__infrequent__"
FILLED = "_filled"


def stored(frame: DataFrame, label: str) -> DataFrame:
    """A frame written to the shared folder, so that the many passes of a fit read a table that outlives executors."""
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def medians(frame: DataFrame, columns: list[str]) -> dict[str, float]:
    """Exact median per column; all-null columns are left out."""
    return {row["feature"]: row["median"] for row in exact_medians(frame, columns).collect()}


def impute_numbers(frame: DataFrame, values: dict[str, float]) -> DataFrame:
    return frame.withColumns(
        {name: F.coalesce(F.col(name).cast("double"), F.lit(value)) for name, value in values.items()}
    )


def most_frequent_levels(frame: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, level): the most frequent non-null level, smallest on ties."""
    long = frame.select(*columns).unpivot([], columns, "feature", "level")
    counted = long.groupBy("feature", "level").agg(F.count("*").alias("n"))
    return counted.groupBy("feature").agg(heaviest("level", "n").alias("level"))


def common_levels(frame: DataFrame, column: str, instead: str, min_count: int) -> list[str]:
    """Levels of at least ``min_count`` rows, where nulls count as ``instead``."""
    level = F.coalesce(F.col(column), F.lit(instead)).alias("level")
    counted = frame.groupBy(level).agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)
    return sorted(row["level"] for row in counted.collect())


def filler(numbers: dict[str, float], levels: dict[str, str], common: dict[str, list[str]] | None = None) -> SQLTransformer:
    """Pipeline stage that adds ``<name>_filled``: nulls replaced, levels outside ``common`` folded.

    Saved with the model, so that raw rows with nulls or new levels can be scored.  Like the one-hot
    encoder, it holds the levels in ``common``, so leave out rare ones.
    """

    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    filled = [f"coalesce(cast(`{c}` AS double), {float(v)!r}D) AS `{c}{FILLED}`" for c, v in numbers.items()]
    filled += [f"coalesce(cast(`{c}` AS string), {quoted(instead)}) AS `{c}{FILLED}`" for c, instead in levels.items()]
    inner = f"SELECT *, {', '.join(filled)} FROM __THIS__"
    if common is None:
        return SQLTransformer(statement=inner)
    names = [f"{c}{FILLED}" for c in levels]
    known = {c: ", ".join(map(quoted, common[c])) or "NULL" for c in levels}
    folded = [f"if(`{c}{FILLED}` IN ({known[c]}), `{c}{FILLED}`, {quoted(RARE_LEVEL)}) AS `{c}{FILLED}`" for c in levels]
    return SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(f'`{n}`' for n in names)}), {', '.join(folded)} FROM ({inner})")


def impute_levels(frame: DataFrame, columns: list[str], fitted_on: DataFrame | None = None) -> DataFrame:
    source = fitted_on if fitted_on is not None else frame
    levels = {row["feature"]: row["level"] for row in most_frequent_levels(source, columns).collect()}
    return frame.withColumns({c: F.coalesce(F.col(c), F.lit(levels.get(c) or "")) for c in columns})


def fold_rare(frame: DataFrame, column: str, min_count: int = 25, fitted_on: DataFrame | None = None) -> DataFrame:
    """Levels with fewer than ``min_count`` rows become one level; nulls stay null."""
    source = fitted_on if fitted_on is not None else frame
    common = source.groupBy(column).agg(F.count("*").alias("_n")).filter(F.col("_n") >= min_count)
    common = common.select(F.col(column).alias("_level"))
    joined = frame.join(common, F.col(column) == F.col("_level"), "left")
    kept = F.when(F.col(column).isNotNull(), F.coalesce(F.col("_level"), F.lit(RARE_LEVEL)))
    return joined.withColumn(column, kept).select(*frame.columns)


def class_weights(frame: DataFrame, label: str, balanced: bool = True) -> DataFrame:
    """(label, weight): ``n / (k * n_c)``, or for two classes negatives per positive on class 1."""
    counts = frame.groupBy(label).agg(F.count("*").alias("n"))
    if balanced:
        totals = counts.agg(F.struct(F.sum("n").alias("n"), F.count("*").alias("k")).alias("t")).scalar()
        return counts.select(label, (totals["n"] / (totals["k"] * F.col("n"))).alias("weight"))
    negatives = counts.agg(F.sum(F.when(F.col(label) == 0, F.col("n"))).alias("n")).scalar()
    return counts.select(label, F.when(F.col(label) == 1, negatives / F.col("n")).otherwise(1.0).alias("weight"))


def with_class_weights(frame: DataFrame, label: str, balanced: bool = True) -> DataFrame:
    """The rows that have a class, with its weight looked up in a map of one entry per class."""
    weights = class_weights(frame, label, balanced).filter(F.col(label).isNotNull())
    entries = F.map_from_entries(F.collect_list(F.struct(label, "weight")))
    known = frame.filter(F.col(label).isNotNull())
    return known.withColumn("weight", F.element_at(weights.agg(entries.alias("w")).scalar(), F.col(label)))


def label_index(column: Column, classes: list[str]) -> Column:
    """Position of a class in alphabetical order, as an int; unknown classes give null."""
    place = F.array_position(F.array(*[F.lit(c) for c in sorted(classes)]), column)
    return F.when(place > 0, (place - 1).cast("int"))


def encoder(numeric: list[str], categories: list[str]) -> Pipeline:
    """One-hot levels (unseen ones are ignored) and numbers, assembled into ``features``."""
    indexed = [f"{c}_index" for c in categories]
    coded = [f"{c}_onehot" for c in categories]
    return Pipeline(
        stages=[
            StringIndexer(inputCols=categories, outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=coded, handleInvalid="keep"),
            VectorAssembler(inputCols=[*numeric, *coded], outputCol="features"),
        ]
    )


def standardised(frame: DataFrame, columns: list[str], suffix: str = "_z") -> DataFrame:
    """Adds z-scores with the population deviation; constant columns give 0."""
    moments = frame.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_mean") for c in columns],
            *[F.stddev_pop(c).alias(f"{c}_std") for c in columns],
        ).alias("m")
    )
    placed = frame.withColumn("_m", moments.scalar())

    def score(name: str) -> Column:
        spread = F.when(F.col(f"_m.{name}_std") > 0, F.col(f"_m.{name}_std")).otherwise(1.0)
        return (F.col(name) - F.col(f"_m.{name}_mean")) / spread

    return placed.withColumns({f"{c}{suffix}": score(c) for c in columns}).drop("_m")
