"""Schemas and fixed values shared by all modules."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: names, labels and lists that results must carry as they are ---

RENAMES = {
    "incident_number": "A_INCIDENT_ID",
    "total_offense": "TOTAL_DELITOS",
    "date_HRF": "INCIDENT_DATE_RAW",
}

WEEKDAY = "DIA_SEMANA"
WEEKEND = "FIN_SEMANA"
WEEKEND_DAYS = (6, 7)
UNKNOWN_HOUR = "UNK"
HOUR_PATTERN = r"(\d{2})\d{2}"
DATE_PATTERN = "yyyyMMdd"

# Flag column -> label, in order of priority.
FLAG_LABELS = {
    "violence_offense": "VIOLENCE",
    "theft_offense": "THEFT",
    "drug_offense": "DRUG",
    "sex_offense": "SEX",
    "kidnapping_trafficking": "KIDNAPPING_TRAFFICKING",
    "other_offense": "OTHER",
}
FLAGS = tuple(FLAG_LABELS)
MULTIPLE = "MULTIPLE"
UNKNOWN = "UNKNOWN"

CATEGORICAL = ("state", "TIPO_DIA", "HOUR_BUCKET", "MONTH")
NUMERIC = (
    "TOTAL_DELITOS",
    "total_victim",
    "total_offender",
    "gun_involvement",
    "drug_involvement",
    "stolen_motor",
    "property_value",
)
DOUBLES = ("property_value",)
MINOR_AGE = 18
PROPERTY_COLUMNS = ("property_description1", "property_description2", "property_description3")
ATTEMPT_COLUMNS = ("completed_attempted2", "completed_attempted3")

PIVOT_LABELS = ("THEFT", "VIOLENCE", "SEX", "DRUG", "OTHER", "MULTIPLE", "KIDNAPPING_TRAFFICKING")
FOCUS_LABELS = ("THEFT", "VIOLENCE", "SEX", "DRUG")
RANKED_LABELS = ("THEFT", "VIOLENCE", "SEX", "DRUG", "OTHER")

ALGORITHM_NAMES = {"lr": "LogisticRegression(multinomial)", "rf": "RandomForestClassifier"}

# --- Schemas ---

INCIDENT_SCHEMA = T.StructType(
    [
        T.StructField("incident_number", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("date_HRF", T.IntegerType()),
        T.StructField("hour", T.StringType()),
        T.StructField("total_offense", T.IntegerType()),
        T.StructField("total_victim", T.IntegerType()),
        T.StructField("total_offender", T.IntegerType()),
        T.StructField("gun_involvement", T.IntegerType()),
        T.StructField("drug_involvement", T.IntegerType()),
        T.StructField("stolen_motor", T.IntegerType()),
        T.StructField("property_value", T.DoubleType()),
        *[T.StructField(flag, T.IntegerType()) for flag in FLAGS],
    ]
)

SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("run_timestamp", T.StringType()),
        T.StructField("data_file", T.StringType()),
        T.StructField("records_total", T.LongType()),
        T.StructField("records_processed", T.LongType()),
        T.StructField("train_rows", T.LongType()),
        T.StructField("test_rows", T.LongType()),
        T.StructField("algorithm", T.StringType()),
        T.StructField("model_path", T.StringType()),
        T.StructField(
            "metrics",
            T.StructType([T.StructField("accuracy", T.DoubleType()), T.StructField("f1", T.DoubleType())]),
        ),
        T.StructField("timings_seconds", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField(
            "features",
            T.StructType(
                [
                    T.StructField("categorical", T.ArrayType(T.StringType())),
                    T.StructField("numeric", T.ArrayType(T.StringType())),
                ]
            ),
        ),
        T.StructField("total_runtime_seconds", T.DoubleType()),
    ]
)
