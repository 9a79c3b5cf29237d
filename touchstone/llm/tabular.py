"""Labels joined to narrow per-document rows, shared by the two text classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchstone.llm.common import crc_fold


def training_labels(labels: DataFrame, label_col: str, *, id_col: str = "doc_id", held_out_fold: int = 0, folds: int = 5) -> DataFrame:
    """``(_label_id, _label)``: distinct 0/1 labels outside the held-out fold.

    Null ids and null or other labels are left out; an id with both labels gives
    one row for each.
    """
    chosen = labels.select(F.col(id_col).alias("_label_id"), F.col(label_col).cast("int").alias("_label"))
    return chosen.where(F.col("_label").isin(0, 1) & (crc_fold(F.col("_label_id"), folds) != held_out_fold)).distinct()
