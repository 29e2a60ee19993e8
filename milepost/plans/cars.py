"""Preparation of car adverts for price models."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.functions.scalars import lenient_timestamp
from milepost.operators.prepare import drop_value, impute_by_group, keep_between, lower_case_columns
from milepost.operators.scratch import written
from milepost.plans.training import Spec

DATE_COLUMNS = ("datecreated", "datecrawled", "lastseen")
UNUSED = (*DATE_COLUMNS, "numberofpictures", "postalcode")
#: The columns that are encoded.
CATEGORIES = ("vehicletype", "gearbox", "model", "fueltype", "brand", "notrepaired")

NUMBERS = ("registrationyear", "power", "kilometer", "registrationmonth")

# Sound registration years, engine power limit, hand-set medians of two groups.
YEARS = (1980, 2016)
POWER_BELOW = 1000
POWER_BY_MODEL = {"samara": 76.5}
POWER_BY_BRAND = {"trabant": 26.0}


def advert_dates(adverts: DataFrame) -> DataFrame:
    """Date columns as timestamps, for the summaries taken before they are dropped."""
    return lower_case_columns(adverts).select(
        *[lenient_timestamp(F.col(c)).alias(c) for c in DATE_COLUMNS]
    )


def clean_adverts(adverts: DataFrame) -> DataFrame:
    """Drop unused columns, free cars and outliers; fill the gaps from like cars.

    The model is filled from the brand first and written to the shared folder, as the (brand, model) statistics read
    those rows several times; then body and gearbox, then the power limit, then fuel and power.
    """
    rows = lower_case_columns(adverts).drop(*UNUSED)
    rows = drop_value(rows, "price", 0)
    rows = keep_between(rows, registrationyear=YEARS)
    rows = written(impute_by_group(rows, {"model": "mode"}, ["brand"]), "adverts-with-model")
    # Bodies and gearboxes are filled before engines are looked at, so adverts with unsound power count there.
    rows = impute_by_group(rows, {"vehicletype": "mode", "gearbox": "mode"}, ["brand", "model"])
    rows = rows.where(F.col("power") < POWER_BELOW)
    # Hand-set medians may be fractions.
    rows = rows.withColumn("power", F.col("power").cast("double"))
    hand_set = [(F.col("model") == m, v) for m, v in POWER_BY_MODEL.items()]
    hand_set += [(F.col("brand") == b, v) for b, v in POWER_BY_BRAND.items()]
    rows = impute_by_group(
        rows,
        {"fueltype": "mode", "power": "median"},
        ["brand", "model"],
        missing={"power": F.col("power") == 0},
        overrides={"power": hand_set},
        whole_numbers=True,
    )
    return rows.fillna({"notrepaired": "no"})


def price_spec(key: str, models: Mapping[str, Estimator]) -> Spec:
    """What to train on the cleaned adverts, which need a key column for the split."""
    return Spec(
        key=key,
        label="price",
        numeric=NUMBERS,
        categories=CATEGORIES,
        scale=NUMBERS,
        models=models,
    )
