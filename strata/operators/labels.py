"""Frequency indexing by a table of labels: no label reaches the driver.

The table of a column holds each label, its count and its index (most frequent
first, ties in Java string order, as the fitted indexer has them).  Ranks come
from a range-partitioned sort with partition counts.  The index is joined back;
the few labels that may each fill a large part of the rows are joined by
broadcast and their rows are spread, so no join task holds a hot label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.ranking import with_positions
from strata.session import scratch_path, unique_name

# A label is hot from this share of the rows on, so there are at most 256 ...
HOT_SHARE = 256
# ... and they are broadcast only while their text is below this many bytes.
HOT_BYTES = 8 << 20


def label_counts(df: DataFrame, label: Column) -> DataFrame:
    """(label, n) of the non-null labels: a hash aggregate with a partial step,
    so a hot label ships one row a task."""
    return df.select(label.cast("string").alias("label")).filter(F.col("label").isNotNull()) \
        .groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def label_table(counts: DataFrame, path: str | None = None) -> DataFrame:
    """(label, n, label_index) from (label, n), written to `path` (default: the
    shared scratch folder) and read back."""
    spark = counts.sparkSession
    path = path or scratch_path(spark, "labels")
    java_order = F.encode(F.col("label"), "UTF-16BE")
    with_positions(counts, [F.col("n").desc(), java_order.asc()], position="label_index", name="label-ranks") \
        .write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def fit_label_tables(df: DataFrame, cols: list[str], fill: dict | None = None) -> dict[str, DataFrame]:
    """The label table of each column; nulls count as their `fill` label."""
    fill = fill or {}
    return {c: label_table(label_counts(df, F.coalesce(F.col(f"`{c}`"), F.lit(fill.get(c))))) for c in cols}


def index_by_table(df: DataFrame, col: str, table: DataFrame, out: str, handle_invalid: str = "keep") -> DataFrame:
    """`df` with `out`: the index (double) of `col`'s label.  A null or unseen
    label gets the number of labels ("keep"), or its row goes ("skip")."""
    if handle_invalid not in ("keep", "skip"):
        raise ValueError(f"handle_invalid is keep or skip, not {handle_invalid!r}")
    labels, rows = table.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    hot = F.col("n") * HOT_SHARE >= rows
    size = table.filter(hot).agg(F.coalesce(F.sum(F.octet_length("label")), F.lit(0))).first()[0]
    if size > HOT_BYTES:
        hot = F.lit(False)  # Spark's own handling of skewed joins is left
    near, far, key, mine = (unique_name(n) for n in ("near", "far", "key", "label"))
    side = lambda rows, label, at: rows.select(label.alias(mine), F.col("label_index").alias(at))
    value = F.col(f"`{col}`").cast("string")

    found = df.join(F.broadcast(side(table.filter(hot), F.col("label"), near)), value == F.col(mine), "left").drop(mine)
    # rows that are done, and nulls, need no partner: their keys are many and match none
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if not _has_map(f.dataType)]
    done = F.col(near).isNotNull() | F.col(f"`{col}`").isNull()
    found = found.withColumn(key, F.when(done, F.concat(F.lit("#"), F.xxhash64(*plain).cast("string")))
                             .otherwise(F.concat(F.lit("="), value)))
    rest = side(table.filter(~hot), F.concat(F.lit("="), F.col("label")), far)
    found = found.join(rest, F.col(key) == F.col(mine), "left")
    index = F.coalesce(F.col(near), F.col(far))
    if handle_invalid == "skip":
        found = found.filter(index.isNotNull())
    return found.select(*[F.col(f"`{c}`") for c in df.columns if c != out],
                        F.coalesce(index, F.lit(labels)).cast("double").alias(out))


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType))


class LabelIndexer:
    """Indexes several columns: by a fitted model where the labels are a list,
    by a join where they are a label table."""

    def __init__(self, labels: dict, suffix: str, handle_invalid: str = "keep") -> None:
        self._labels, self._suffix, self._invalid = labels, suffix, handle_invalid

    def transform(self, df: DataFrame, inputs: dict[str, str] | None = None) -> DataFrame:
        """`inputs` names the column to read for a column (itself by default)."""
        from pyspark.ml.feature import StringIndexerModel
        for c, labels in self._labels.items():
            source = (inputs or {}).get(c, c)
            if isinstance(labels, DataFrame):
                df = index_by_table(df, source, labels, c + self._suffix, self._invalid)
            else:
                df = StringIndexerModel.from_labels(
                    labels, inputCol=source, outputCol=c + self._suffix, handleInvalid=self._invalid).transform(df)
        return df
