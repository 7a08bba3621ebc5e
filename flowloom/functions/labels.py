"""Class labels, verdicts and severities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The name of the harmless class, and the verdict texts of the
# report file.
BENIGN = "Benign"
VERDICT_ATTACK = "Attaque"

# Score bands of a dashboard severity, lowest first.
SEVERITY_BANDS = [("low", 0.5), ("medium", 0.8)]
SEVERITY_TOP = "high"


def derive_label(text: Column) -> Column:
    """0 for a benign raw label (``0`` or ``Benign``), 1 for all else, null too."""
    return F.when(F.trim(text).isin("0", BENIGN), 0).otherwise(1)


def binary_label(attack_type: Column) -> Column:
    """0 for exactly ``Benign``, else 1."""
    return F.when(attack_type == BENIGN, 0).otherwise(1)


def decode_prediction(prediction: Column, attack: str = VERDICT_ATTACK) -> Column:
    return F.when(prediction == 0, BENIGN).otherwise(attack)


def severity(score: Column) -> Column:
    """Band of an anomaly score: low below 0.5, medium below 0.8, then high."""
    banded = F.when(score.isNull(), F.lit(None).cast("string"))
    for name, upper in SEVERITY_BANDS:
        banded = banded.when(score < upper, name)
    return banded.otherwise(SEVERITY_TOP)
