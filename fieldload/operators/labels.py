"""Label dictionary (S7, A4) and strict label lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import blank_to_null
from .joins import bounded_broadcast


def label_dictionary(labels: DataFrame) -> DataFrame:
    """One row per label text: ``text, id, blur``.

    A repeated text keeps its greatest id; a text is blurred if any of its
    rows says so.
    """
    return labels.groupBy("text").agg(
        F.max(F.col("id").cast("bigint")).alias("id"),
        F.coalesce(F.bool_or("blur"), F.lit(False)).alias("blur"),
    )


def prepared(labels: DataFrame) -> DataFrame:
    """The dictionary, broadcast when its size is proven small (checked once)."""
    return bounded_broadcast(label_dictionary(labels))


def lookup(
    df: DataFrame,
    text_col: str,
    dictionary: DataFrame,
    id_col: str,
    error_col: str,
    blur_col: str | None = None,
    blank_is_missing: bool = True,
) -> DataFrame:
    """Map ``text_col`` to a label id; flag present texts that are unknown.

    ``dictionary`` comes from ``prepared`` (already size-checked).  With
    ``blank_is_missing`` an empty text counts as absent (no id, no error);
    otherwise only NULL is absent.
    """
    probe = blank_to_null(text_col) if blank_is_missing else F.col(text_col)
    key = f"__{id_col}_key"
    cols = [F.col("text").alias(key), F.col("id").alias(id_col)]
    if blur_col:
        cols.append(F.col("blur").alias(blur_col))
    dim = dictionary.select(*cols)
    joined = df.withColumn(key + "_probe", probe).join(
        dim, F.col(key + "_probe") == F.col(key), "left"
    )
    return joined.withColumn(
        error_col, F.col(key + "_probe").isNotNull() & F.col(id_col).isNull()
    ).drop(key, key + "_probe")
