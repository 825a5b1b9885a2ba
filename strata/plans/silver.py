"""Silver chains: the join table and the ML table from one raw frame.

Both chains share the same converted prefix and the same imputation
statistics, so the statistics are computed once (one aggregate job) and
passed to both.  Everything else is lazy projection/filter, collapsed by
Catalyst into one scan-project stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from strata import presets as P
from strata.functions import clean_wind, convert_all, default_text, encode_flags
from strata.operators.columns import drop_tolerant
from strata.operators.features import index_categoricals
from strata.operators.labels import LabelIndexer, label_counts, label_table
from strata.operators.nulls import dropna_subset, impute, imputation_stats


def prepare(raw: DataFrame) -> DataFrame:
    """Units, durations and wind columns: the prefix both chains share."""
    return clean_wind(convert_all(raw))


def silver_join(raw: DataFrame, stats: dict | None = None, prepared: bool = False) -> DataFrame:
    """The table joined with predictions: readable text, imputed measures,
    rows without all twilight values dropped (after the statistics).  With
    `prepared` the input is `prepare`'s output already."""
    df = raw if prepared else prepare(raw)
    df = drop_tolerant(df, P.JOIN_DROP)
    df = impute(df, stats=stats)
    df = dropna_subset(df, P.TWILIGHT_REQUIRED)
    return default_text(df)


def silver_ml(raw: DataFrame, stats: dict | None = None, indexer=None, prepared: bool = False):
    """The all-numeric ML table; returns (frame, indexer).  Without an
    `indexer` (e.g. from `indexer_from_labels`) one is fitted."""
    df = raw if prepared else prepare(raw)
    df, indexer = index_categoricals(df, model=indexer)
    df = drop_tolerant(df, P.ML_DROP_TEXT)
    df = encode_flags(df)
    df = drop_tolerant(df, P.ML_DROP_GEO)
    return impute(df, stats=stats), indexer


# ---------------------------------------------------------------------------
# Every statistic the silver/ML stages need.
# ---------------------------------------------------------------------------

# Distinct labels of one column that may reach the driver; the labels of a
# column with more stay in a table and are joined (`operators/labels.py`).
MAX_LABELS = 100_000


def profile(prepared: DataFrame, mean: list[str] | None = None, median: list[str] | None = None,
            categorical: list[str] | None = None, fill: dict | None = None,
            label: str | None = P.LABEL, max_labels: int = MAX_LABELS) -> dict:
    """Imputation statistics, categorical label frequencies and class counts.

    One global aggregate gives the means, plain hash aggregates the medians
    (`imputation_stats`), and one count over grouping sets the labels of all
    columns: rows carry the few label columns only, and a hot label costs one
    row per task.  Returns {"stats", "labels", "class_counts"}; `labels[c]` is
    ordered as the frequency indexer orders them (count desc, then label), or is
    a label table for a column with more than `max_labels`; nulls are no labels
    and no class.
    """
    from pyspark.sql import functions as F

    mean = [c for c in (P.IMPUTE_MEAN if mean is None else mean) if c in prepared.columns]
    median = [c for c in (P.IMPUTE_MEDIAN if median is None else median)
              if c in prepared.columns]
    categorical = [c for c in (P.INDEX_COLUMNS if categorical is None else categorical)
                   if c in prepared.columns]
    fill = P.CATEGORICAL_FILL if fill is None else fill
    sets = [(c, F.coalesce(F.col(f"`{c}`"), F.lit(fill[c])) if c in fill else F.col(f"`{c}`"))
            for c in categorical]
    if label and label in prepared.columns:
        sets.append((label, F.col(f"`{label}`").cast("string")))
    counts = {c: [] for c, _ in sets}
    if sets:
        keys = [f"k{i}" for i in range(len(sets))]
        slim = prepared.select(*[e.alias(k) for k, (_, e) in zip(keys, sets)])
        grouped = (slim.groupingSets([[F.col(k)] for k in keys], *[F.col(k) for k in keys])
                   .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g")))
        # the grouping id of a set has a zero bit at its own column
        which = {(1 << len(keys)) - 1 - (1 << (len(keys) - 1 - i)): i for i in range(len(keys))}
        rows = grouped.limit(max_labels * len(sets) + 1).collect()
        for r in rows:
            i = which[r["g"]]
            if r[keys[i]] is not None:  # like the fitted indexer: nulls are not labels
                counts[sets[i][0]].append((r[keys[i]], r["n"]))
        if len(rows) > max_labels * len(sets) or any(len(v) > max_labels for v in counts.values()):
            sizes = {which[r["g"]]: r["count"] for r in grouped.groupBy("g").count().collect()}
            tables = {i: e for i, (_, e) in enumerate(sets) if sizes.get(i, 0) > max_labels}
            few = [g for g, i in which.items() if i not in tables]
            counts = {c: [] for c, _ in sets}
            for r in grouped.filter(F.col("g").isin(few)).collect():
                i = which[r["g"]]
                if r[keys[i]] is not None:
                    counts[sets[i][0]].append((r[keys[i]], r["n"]))
            for i, e in tables.items():
                counts[sets[i][0]] = label_table(label_counts(prepared, e))
    class_counts = counts.pop(label, [])
    if isinstance(class_counts, DataFrame):
        raise ValueError(f"more than {max_labels} classes in {label}")
    # count desc, then label in Java string order (UTF-16 code units)
    labels = {c: v if isinstance(v, DataFrame) else
              [k for k, _ in sorted(v, key=lambda kv: (-kv[1], _java_order(kv[0])))]
              for c, v in counts.items()}
    class_counts = dict(class_counts)
    return {"stats": imputation_stats(prepared, mean, median), "labels": labels, "class_counts": class_counts}


def _java_order(text):
    return b"" if text is None else text.encode("utf-16-be")


def indexer_from_labels(labels: dict, suffix: str = P.INDEX_SUFFIX, handle_invalid: str = "keep"):
    """A frequency indexer built from counted labels (no fitting pass): one
    single-column model per column, so each keeps its own label count (the
    multi-column constructor pads shorter label lists with nulls).  Columns that
    have a label table are indexed by a join."""
    if any(isinstance(v, DataFrame) for v in labels.values()):
        return LabelIndexer(labels, suffix, handle_invalid)
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import StringIndexerModel
    return PipelineModel(stages=[
        StringIndexerModel.from_labels(labels[c], inputCol=c, outputCol=c + suffix,
                                       handleInvalid=handle_invalid)
        for c in labels])


def majority_from_counts(class_counts: dict, cast=int):
    """Most frequent class (ties: smallest) from `profile`'s class counts."""
    if not class_counts:
        return None
    best = max(class_counts.items(), key=lambda kv: (kv[1], -cast(kv[0])))
    return cast(best[0])


# ---------------------------------------------------------------------------
# Both silver tables as one physical table (one write pass).
# ---------------------------------------------------------------------------

TWILIGHT_COMPLETE = "__twilight_complete"


def silver_wide(raw: DataFrame, stats: dict, labels: dict,
                prepared: bool = False) -> tuple[DataFrame, list, list]:
    """One frame holding both silver tables' columns, and their column lists.

    The two tables share the converted and imputed measures; the ML-only
    columns (indices over null-filled copies of the categorical columns,
    `_num` encodings) are added next to the join table's columns, whose text
    defaults are applied in place afterwards.  A flag marks the rows that
    belong to the join table (all twilight values present).  Returns
    (wide, join_columns, ml_columns).
    """
    from pyspark.sql import functions as F

    from strata.functions import bool_as_int, daynight_as_int
    join_columns = silver_join(raw, stats, prepared).columns
    ml_columns = silver_ml(raw, stats, indexer_from_labels(labels), prepared)[0].columns
    df = impute(raw if prepared else prepare(raw), stats=stats)
    tmp = {c: f"__cat_{c}" for c in labels if c in df.columns}
    df = df.withColumns({t: F.coalesce(F.col(c), F.lit(P.CATEGORICAL_FILL[c]))
                         for c, t in tmp.items()})
    df = LabelIndexer({c: labels[c] for c in tmp}, P.INDEX_SUFFIX).transform(df, tmp)
    flags = {c + P.FLAG_SUFFIX: bool_as_int(F.col(c)) for c in P.BOOL_FLAGS if c in df.columns}
    flags.update({c + P.FLAG_SUFFIX: daynight_as_int(F.col(c))
                  for c in P.DAYNIGHT_COLUMNS if c in df.columns})
    complete = None
    for c in P.TWILIGHT_REQUIRED:
        if c in df.columns:
            cond = F.col(c).isNotNull()
            complete = cond if complete is None else complete & cond
    flags[TWILIGHT_COMPLETE] = complete if complete is not None else F.lit(True)
    df = default_text(df.withColumns(flags))
    keep = list(dict.fromkeys([*join_columns, *ml_columns, TWILIGHT_COMPLETE]))
    return df.select(*[F.col(f"`{c}`") for c in keep]), join_columns, ml_columns


def join_view(wide: DataFrame, join_columns: list) -> DataFrame:
    from pyspark.sql import functions as F
    return wide.filter(F.col(TWILIGHT_COMPLETE)).select(*[F.col(f"`{c}`") for c in join_columns])


def ml_view(wide: DataFrame, ml_columns: list) -> DataFrame:
    from pyspark.sql import functions as F
    return wide.select(*[F.col(f"`{c}`") for c in ml_columns])
