"""Feature engineering with Spark ML: frequency indexing, vector assembly."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import presets as P
from strata.operators.columns import numeric_columns
from strata.operators.nulls import fill_constant


def fit_indexer(df: DataFrame, cols: list[str] | None = None,
                suffix: str = P.INDEX_SUFFIX, handle_invalid: str = "keep") -> PipelineModel:
    """Frequency string indexer over several columns, fitted in one job.

    Most frequent label -> 0.0, ties broken alphabetically; with "keep",
    null or unseen labels map to the number of labels.  Label counting is a
    distributed aggregate; the label lists reach the driver, so columns of very
    many labels are for `labels.fit_label_tables`.
    """
    cols = [c for c in (P.INDEX_COLUMNS if cols is None else cols) if c in df.columns]
    indexer = StringIndexer(inputCols=cols, outputCols=[c + suffix for c in cols],
                            handleInvalid=handle_invalid, stringOrderType="frequencyDesc")
    return Pipeline(stages=[indexer]).fit(df)


def index_categoricals(df: DataFrame, cols: list[str] | None = None,
                       fill: dict | None = None, suffix: str = P.INDEX_SUFFIX,
                       model: PipelineModel | None = None,
                       drop_sources: bool = True) -> tuple[DataFrame, PipelineModel]:
    """Fill nulls with a placeholder label, index, drop the text columns."""
    cols = [c for c in (P.INDEX_COLUMNS if cols is None else cols) if c in df.columns]
    fill = P.CATEGORICAL_FILL if fill is None else fill
    df = fill_constant(df, {c: v for c, v in fill.items() if c in cols})
    model = model or fit_indexer(df, cols, suffix)
    out = model.transform(df)
    return (out.drop(*cols) if drop_sources else out), model


def feature_columns(df: DataFrame, label: str = P.LABEL) -> list[str]:
    """All numeric columns except the label, in schema order."""
    return numeric_columns(df, exclude=[label])


def assemble(df: DataFrame, label: str = P.LABEL, features: list[str] | None = None,
             out: str = "features") -> tuple[DataFrame, list[str]]:
    """Drop rows with a missing feature or label, assemble the feature vector."""
    features = feature_columns(df, label) if features is None else features
    clean = df.na.drop(how="any", subset=[*features, label])
    assembled = VectorAssembler(inputCols=features, outputCol=out,
                                handleInvalid="error").transform(clean)
    return assembled, features


def _categories(df: DataFrame) -> dict[str, dict]:
    """The ML attribute of each nominal column that lists its categories."""
    attrs = {f.name: f.metadata.get("ml_attr", {}) for f in df.schema.fields}
    return {c: a for c, a in attrs.items() if a.get("type") == "nominal" and "vals" in a}


def seen_categories(df: DataFrame) -> tuple[DataFrame, int]:
    """`df` with the categories of its nominal columns cut after the last one
    that a row has, and its number of rows (one aggregate over those columns).

    An indexer that keeps unseen labels declares a category for them, which the
    rows it was fitted on never have.  A forest tries every two-part grouping of
    a column of few categories against every row: a category without rows
    doubles their number, each grouping then standing there twice.
    """
    nominal = _categories(df)
    row = df.agg(F.count(F.lit(1)).alias("rows"),
                 *[F.max(F.when(~F.isnan(f"`{c}`"), F.col(f"`{c}`"))).alias(c) for c in nominal]).first()
    seen = {c: {**a, "vals": a["vals"][:int(row[c]) + 1]} for c, a in nominal.items() if row[c] is not None}
    return df.select(*[F.col(f"`{c}`").alias(c, metadata={**df.schema[c].metadata, "ml_attr": seen[c]})
                       if c in seen else F.col(f"`{c}`") for c in df.columns]), row["rows"]
