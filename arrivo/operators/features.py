"""Feature derivation: interactions (E7-E10, X4), squared columns (E11, X5),
assembling (K2, F7) and squares of scaled features inside the vector (E12)."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivo.layout import Layout


def product(a: str, b: str):
    """X4 widened to long: Spark 4 raises on int overflow."""
    return F.col(a).cast("long") * F.col(b).cast("long")


def interaction_pairs(layout: Layout) -> list[tuple[str, str, str]]:
    names = layout.interactions
    return [
        (names[0], layout.dep_delay, layout.taxi_out),
        (names[1], layout.origin, layout.dest),
        (names[2], layout.month, layout.day),
        (names[3], layout.dep_delay, layout.origin),
    ]


def add_interactions(df: DataFrame, layout: Layout) -> DataFrame:
    """Each one only when both inputs exist."""
    new = {}
    for out, a, b in interaction_pairs(layout):
        if a in df.columns and b in df.columns:
            new[out] = product(a, b)
    return df.withColumns(new) if new else df


def is_interaction(name: str) -> bool:
    return "interaction" in name.lower()


def add_squared_columns(df: DataFrame, label: str, exclude=()) -> DataFrame:
    """``<col>Squared`` for every column except the label, interaction
    columns and ``exclude``."""
    new = {f"{c}Squared": F.col(c).cast("long") * F.col(c).cast("long")
           for c in df.columns
           if c != label and c not in exclude and not is_interaction(c)}
    return df.withColumns(new) if new else df


def feature_columns(df: DataFrame, label: str, exclude=()) -> list[str]:
    """Every column except the label (and carried keys), in frame
    order."""
    return [c for c in df.columns if c != label and c not in exclude]


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    """Rows with a null or NaN feature are skipped."""
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="skip").transform(df)


def squared_feature_names(features: list[str]) -> list[str]:
    return list(features) + [f"{f}Squared" for f in features if not is_interaction(f)]


def append_scaled_squares(df: DataFrame, features: list[str], col: str = "scaledFeatures"
                          ) -> DataFrame:
    """Append the squares of the scaled values of every non-interaction
    feature, in feature order, at the end of the vector. Positions are taken
    from the feature names (T16), not from the frame's column list."""
    keep = [i for i, f in enumerate(features) if not is_interaction(f)]
    arr = vector_to_array(F.col(col))
    squares = [arr[i] * arr[i] for i in keep]
    return df.withColumn(col, array_to_vector(F.concat(arr, F.array(*squares))))
