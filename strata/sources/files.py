"""File and catalog sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import presets as P


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = P.ACC_SCHEMA,
             infer: bool = False, null_value: str = "\\N", **options) -> DataFrame:
    """CSV with a header row.

    A declared schema is used by default (no inference pass over the data);
    `infer=True` falls back to Spark's inference, which costs an extra scan.
    `null_value` matches `write_csv`; pass "" for files using Spark's default.
    """
    reader = spark.read.option("header", True).option("nullValue", null_value).options(**options)
    if infer or schema is None:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_parquet(spark: SparkSession, *paths: str, **options) -> DataFrame:
    return spark.read.options(**options).parquet(*paths)


CORRUPT = "_corrupt_record"


def load_csv(spark: SparkSession, path: str, out: str, schema: T.StructType = P.ACC_SCHEMA, header: bool = True,
             null_value: str = "\\N", **options) -> tuple[DataFrame, DataFrame]:
    """Parse CSV once into parquet under `out`, keeping malformed rows apart.

    Returns (good, rejected): the rows that fit the schema, and the others as
    (file, reason, record).  A record is rejected whole when a value cannot be
    read as its column's type, or when it has too few or too many fields or a
    broken quote; `reason` names the columns or says `fields`.  Good and
    rejected rows add up to the records of the input.  All columns are parsed in
    the write, so what is rejected does not depend on the columns read later.
    """
    known = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = (spark.read.option("header", header).option("nullValue", null_value).options(**options)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).schema(known).csv(path))
    parsed.withColumn("source_file", F.col("_metadata.file_path")) \
        .withColumn("rejected", F.col(CORRUPT).isNotNull()) \
        .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("rejected").parquet(out)
    stored = spark.read.schema(T.StructType([
        *known.fields, T.StructField("source_file", T.StringType()), T.StructField("rejected", T.BooleanType())])) \
        .parquet(out)
    good = stored.filter(~F.col("rejected")).select(*[F.col(f"`{f.name}`") for f in schema.fields])
    # the record again, all as text: what is wrong with it?
    texts = [T.StructField(f"c{k}", T.StringType()) for k in range(len(schema.fields))]
    again = F.from_csv(F.col(CORRUPT), T.StructType([*texts, T.StructField("wrong", T.StringType())]).simpleString()
                       .removeprefix("struct<").removesuffix(">").replace(":", " "),
                       {"columnNameOfCorruptRecord": "wrong", "mode": "PERMISSIVE", "nullValue": null_value,
                        **{k: str(v) for k, v in options.items()}})
    bad = [F.when(F.col(f"r.c{k}").isNotNull() & F.col(f"r.c{k}").try_cast(f.dataType).isNull(), F.lit(f.name))
           for k, f in enumerate(schema.fields) if not isinstance(f.dataType, T.StringType)]
    named = F.array_join(F.array_compact(F.array(*bad)), ", ") if bad else F.lit("")
    rejected = stored.filter("rejected").select("source_file", CORRUPT, again.alias("r")).select(
        F.col("source_file").alias("file"),
        F.when(F.col("r.wrong").isNotNull(), F.lit("fields")).when(named != "", named)
        .otherwise(F.lit("value")).alias("reason"), F.col(CORRUPT).alias("record"))
    return good, rejected
