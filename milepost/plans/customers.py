"""Customer view of a telecom provider: contract, person and services in one row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Estimator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.functions.scalars import lenient_double, parse_date, weekday_name
from milepost.operators.prepare import fill_text_nulls, full_outer
from milepost.plans.training import Spec

# The marker of an open contract or an absent service, and the data cut-off date.
OPEN = ABSENT = "No"
CUT_OFF = "2020-02-01"

SCALED = ("MonthlyCharges", "TotalCharges", "DaysInside")
NUMBERS = (*SCALED, "SeniorCitizen")
#: The columns that are encoded.
CATEGORIES = (
    "gender", "Partner", "Dependents", "Type", "PaperlessBilling", "PaymentMethod", "Day",
    "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport",
    "StreamingTV", "StreamingMovies", "MultipleLines",
)


def _day(text: Column) -> Column:
    """Date of ``2020-02-01`` or ``2020-02-01 00:00:00``."""
    return F.coalesce(parse_date(text), parse_date(text, "yyyy-MM-dd HH:mm:ss"))


def contract_features(contract: DataFrame, cut_off: str = CUT_OFF) -> DataFrame:
    """Typed contract rows: start parts, days inside, lenient charges and ``is_active``."""
    begin = _day(F.col("BeginDate"))
    end = F.when(F.col("EndDate") == OPEN, F.lit(cut_off).cast("date")).otherwise(
        _day(F.col("EndDate"))
    )
    return contract.select(
        "customerID",
        "Type",
        "PaperlessBilling",
        "PaymentMethod",
        "MonthlyCharges",
        F.coalesce(lenient_double(F.col("TotalCharges")), F.lit(0.0)).alias("TotalCharges"),
        weekday_name(begin).alias("Day"),
        F.month(begin).alias("Month"),
        F.year(begin).alias("Year"),
        F.datediff(end, begin).alias("DaysInside"),
        F.when(F.col("EndDate") == OPEN, 1).otherwise(0).alias("is_active"),
    )


def customer_view(
    contract: DataFrame,
    personal: DataFrame,
    internet: DataFrame,
    phone: DataFrame,
    cut_off: str = CUT_OFF,
) -> DataFrame:
    """Full outer join of the four tables; absent services read ``No``."""
    frames = [personal, contract_features(contract, cut_off), internet, phone]
    return fill_text_nulls(full_outer(frames, "customerID"), ABSENT)


def without_any_service(view: DataFrame) -> DataFrame:
    """One row: customers with neither internet nor phone, which a sound join leaves at zero."""
    absent = (F.col("InternetService") == ABSENT) & (F.col("MultipleLines") == ABSENT)
    return view.agg(F.count_if(absent).alias("without_any_service"))


def with_service(view: DataFrame, service: str) -> DataFrame:
    return view.where(F.col(service) != ABSENT)


def model_rows(view: DataFrame) -> DataFrame:
    """The view for training: a customer without a personal row is not known to be a senior, so 0."""
    return view.fillna({"SeniorCitizen": 0})


def churn_spec(view: DataFrame, models: Mapping[str, Estimator]) -> Spec:
    """What to train on the view: no calendar columns, which would leak time, and no id among the features.

    ``SeniorCitizen`` is 0 or 1 and is not scaled; fill it with ``model_rows`` first. An absent column raises.
    """
    if absent := [c for c in (*NUMBERS, *CATEGORIES, "is_active") if c not in view.columns]:
        raise ValueError(f"the view has no column {', '.join(absent)}")
    return Spec(
        key="customerID",
        label="is_active",
        numeric=NUMBERS,
        categories=CATEGORIES,
        task="classification",
        scale=SCALED,
        models=models,
    )
