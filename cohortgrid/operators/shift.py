"""Re-anchoring the time axis on earlier refill evidence (stage 6).

In long form a shift is ``time_bucket + shift``: every cell moves at once,
so no column reads an already-moved column (D7). A cell that a shift moves
past the cutoff becomes null; its row stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.status import is_positive
from ..spec import FULL_SPEC, MatrixSpec
from .matrix import LongMatrix


def detect_shift(cells: DataFrame, variable: str = "refill", spec: MatrixSpec = FULL_SPEC) -> DataFrame:
    """Per patient with a ``variable`` row the months from its earliest
    pre-baseline bucket of ``spec`` with a Yes cell to the start, else 0."""
    evidence = F.col("time_bucket").isin(spec.pre_baseline) & is_positive("cell")
    shift = F.max(F.when(evidence, -F.col("time_bucket")))
    return cells.filter(F.col("variable") == variable).groupBy("mrn").agg(F.coalesce(shift, F.lit(0)).alias("bucket_shift"))


def shift_matrix(m: LongMatrix, shifts: DataFrame) -> LongMatrix:
    """C35 + C36: new[B] = old[B - shift] for every variable; B beyond the
    cutoff (or the domain) is null for shifted patients; start moves back
    by the shift; ``correct_enrollment_date`` holds the corrected start. A
    cell beyond keeps its row by a null bucket and cell, so a variable
    whose cells all moved out is still a row of the wide matrix."""
    s = shifts.select("mrn", "bucket_shift")
    shift = F.coalesce(F.col("bucket_shift"), F.lit(0))
    c = m.cells.join(s, "mrn", "left").withColumn("__s", shift)
    nb = F.col("time_bucket") + F.col("__s")
    inside = (F.col("__s") == 0) | ((nb <= m.spec.cutoff) & (nb <= m.spec.hi))
    cells = c.select("mrn", "variable", F.when(inside, nb).alias("time_bucket"), F.when(inside, F.col("cell")).alias("cell"))
    p = m.patients.join(s, "mrn", "left").withColumn("__s", shift)
    start = F.col("enrollment_start_date").cast("date")
    corrected = F.when(F.col("__s") > 0, F.add_months(start, -F.col("__s"))).otherwise(start)
    patients = p.select(
        "mrn",
        corrected.alias("enrollment_start_date"),
        F.col("enrollment_end_date"),
        corrected.alias("correct_enrollment_date"),
    )
    return LongMatrix(patients, cells, m.spec)


def shift_audit(shifts: DataFrame) -> DataFrame:
    """Shifted patients out of those with a refill row."""
    return shifts.agg(
        F.count_if(F.col("bucket_shift") > 0).alias("shifted"), F.count(F.lit(1)).alias("total")
    )
