"""Patient file: the latest complete row per patient, and incomplete rows."""

from pyspark.sql import DataFrame, SparkSession

from sluice.model import PATIENT_REQUIRED
from sluice.operators.dedupe import keep_latest
from sluice.operators.rules import split_required
from sluice.sources.delimited import read_csv


def split_patients(df: DataFrame, tie_break=()):
    """(valid, invalid); a missing update time counts as the latest."""
    complete, invalid = split_required(df, PATIENT_REQUIRED)
    return keep_latest(complete, ["patient_id"], "updated_at", tie_break), invalid


def process_patient_file(spark: SparkSession, path):
    return split_patients(read_csv(spark, path))
