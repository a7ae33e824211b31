"""The regressor run on semicolon-separated CSV files with a header."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from ratelab.functions.cleaning import clean_books, clean_users, drop_implicit, year_mean
from ratelab.operators.evaluate import rmse_row
from ratelab.operators.regressors import MAX_DEPTH, fit_regressor
from ratelab.operators.sampling import bootstrap, draw_split
from ratelab.operators.star import star
from ratelab.shared import scratch_scope
from ratelab.sources.ratings import read_books_csv, read_ratings_csv, read_users_csv
from ratelab.sources.tables import (
    TEST,
    TRAIN,
    metric_rows,
    prediction_rows,
    read_split,
    write_split,
    write_table,
)

# File names inside the input folder, sample fractions.
BOOKS_FILE = "BX-Books.csv"
USERS_FILE = "BX-Users.csv"
RATINGS_FILE = "BX-Book-Ratings.csv"
SAMPLE_FRACTION = {"tree": 1.0, "forest": 0.9}


@dataclass
class RegressionRun:
    output: str
    kind: str = "tree"
    max_depth: int = MAX_DEPTH
    seed: int = 1
    leaky: bool = False
    age_fill: str = "mean"
    overwrite: bool = False


def run_regression(spark: SparkSession, folder: str, run: RegressionRun) -> DataFrame:
    """Writes model, predictions and RMSE under ``run.output``; returns the RMSE row.

    ``age_fill="year_mean"`` puts the mean publication year where an age is
    out of range, "mean" the mean valid age.
    """
    root, out = folder.rstrip("/"), run.output.rstrip("/")
    with scratch_scope(spark):
        books = read_books_csv(spark, f"{root}/{BOOKS_FILE}")
        fill: Column | None = None
        if run.age_fill == "year_mean":
            fill = year_mean(books).scalar()
        elif run.age_fill != "mean":
            raise ValueError(f"age_fill must be 'mean' or 'year_mean': {run.age_fill}")
        rated = star(
            clean_books(books, "mean"),
            clean_users(read_users_csv(spark, f"{root}/{USERS_FILE}"), "range", fill),
            drop_implicit(read_ratings_csv(spark, f"{root}/{RATINGS_FILE}")),
            dedup=False,
        )
        fraction = SAMPLE_FRACTION[run.kind]
        drawn = draw_split(bootstrap(rated, fraction, run.seed) if run.leaky else rated, seed=run.seed)
        # Fitting reads its input several times; a written table is read cheaply
        # and outlives lost executors.
        write_split(drawn, f"{out}/split", run.overwrite)
        train = read_split(spark, f"{out}/split", TRAIN)
        if not run.leaky:
            train = bootstrap(train, fraction, run.seed)
        model = fit_regressor(train, run.kind, max_depth=run.max_depth, seed=run.seed)
        model.save(f"{out}/model", run.overwrite)
        predictions = model.transform(read_split(spark, f"{out}/split", TEST))
        rows = prediction_rows(predictions, with_label=run.kind == "tree")
        write_table(rows, f"{out}/predictions", overwrite=run.overwrite)
        labelled = metric_rows(rmse_row(predictions), {"rmse": "rmse"})
        write_table(labelled, f"{out}/rmse", overwrite=run.overwrite)
    return spark.read.parquet(f"{out}/rmse")
