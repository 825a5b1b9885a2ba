"""The bronze table: one layout and one set of rules for every writer.

    <root>/batch_date=<date>/batch_part=<part>/*.parquet
    <root>/_runs/<number>/            stream runs begun and ended (not data)

A batch run writes the rows of a date to the part `batch`; a stream writes each
micro-batch to a part of its own, named by query and batch number.  Parts are
replaced whole (dynamic partition overwrite), so a job or a micro-batch that is
run again replaces itself and nothing else.  There is no sink log: what the
directories hold is what every reader sees, whoever wrote it.

A stream run that was cut short leaves dates that may be incomplete.  Its record
says so until it ends: the same stream goes on with them; any other writer
first removes them and ingests them whole.  Only one writer may run at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import presets as P
from strata.sources.batches import child_names, delete_paths, partition_values, path_exists
from strata.sources.sinks import write_partitioned

PART_COLUMN = "batch_part"
BATCH_PART = "batch"
_RUN_SCHEMA = "writer string, ingested array<string>, open boolean"


@dataclass
class Run:
    """A stream run: its query, the dates bronze had when it began, whether it
    has yet to end."""
    writer: str
    ingested: list[str]
    open: bool


def read_bronze(spark: SparkSession, root: str, parts: bool = False) -> DataFrame:
    """All rows, without the part column unless `parts`."""
    table = spark.read.parquet(root)
    return table if parts else table.drop(PART_COLUMN)


def write_part(df: DataFrame, root: str, part: str, col: str = P.BATCH_COLUMN) -> None:
    """Write the rows of each date in `df` as that date's `part`, replacing it."""
    write_partitioned(df.withColumn(PART_COLUMN, F.lit(part)), root, [col, PART_COLUMN], mode="overwrite")


def check_layout(spark: SparkSession, root: str, col: str = P.BATCH_COLUMN) -> None:
    """Raise when `root` holds bronze of another layout: a file sink's log would
    hide rows, and files beside parts would not be read.  `migrate_bronze`
    copies such a table."""
    if path_exists(spark, f"{root.rstrip('/')}/_spark_metadata"):
        raise ValueError(f"{root} was written by a streaming file sink; copy it with migrate_bronze")
    flat = child_names(spark, f"{root.rstrip('/')}/{col}=*", lambda name: name[0] not in "._"
                       and not name.startswith(f"{PART_COLUMN}="))
    if flat:
        raise ValueError(f"{root} holds files without a {PART_COLUMN}; copy it with migrate_bronze")


def migrate_bronze(spark: SparkSession, old_root: str, new_root: str, col: str = P.BATCH_COLUMN) -> None:
    """Copy bronze of an earlier layout (as Spark reads it) into this one."""
    write_part(spark.read.parquet(old_root), new_root, BATCH_PART, col)


def last_run(spark: SparkSession, root: str) -> Run | None:
    """The latest record of a stream run; half-written ones do not count."""
    numbers = _records(spark, root)
    if not numbers:
        return None
    row = spark.read.schema(_RUN_SCHEMA).json(f"{root.rstrip('/')}/_runs/{numbers[-1]}").first()
    return Run(row["writer"], list(row["ingested"] or []), row["open"])


def record_run(spark: SparkSession, root: str, run: Run) -> None:
    """Append a record; none is ever overwritten."""
    taken = [n for n in child_names(spark, f"{root.rstrip('/')}/_runs") if n.isdigit()]
    number = f"{int(max(taken, default='0')) + 1:010d}"
    spark.createDataFrame([(run.writer, run.ingested, run.open)], _RUN_SCHEMA).coalesce(1) \
        .write.json(f"{root.rstrip('/')}/_runs/{number}")


def _records(spark: SparkSession, root: str) -> list[str]:
    base = f"{root.rstrip('/')}/_runs"
    return sorted(n for n in child_names(spark, base) if n.isdigit() and path_exists(spark, f"{base}/{n}/_SUCCESS"))


def settle(spark: SparkSession, root: str, raw_dates: list, writer: str | None = None,
           col: str = P.BATCH_COLUMN) -> list[str]:
    """The dates bronze has for good, before `writer` goes on.

    If the latest stream run was cut short and is not `writer`'s own, the dates
    it began are removed (raw must still hold them) and the run is ended; a
    writer that resumes its own run gets the dates bronze had when it began.
    Safe to repeat: the record stays open until the dates are gone.
    """
    run = last_run(spark, root)
    have = [d for d in partition_values(spark, root, col) if d is not None]
    if run is None or not run.open:
        return have
    if run.writer == writer:
        return run.ingested
    begun = [d for d in have if d not in set(run.ingested)]
    gone = sorted(set(begun) - set(raw_dates))
    if gone:
        raise ValueError(f"dates {gone} of an interrupted stream run are no longer in raw; resume that stream")
    delete_paths(spark, *[f"{root.rstrip('/')}/{col}={d}" for d in begun])
    record_run(spark, root, Run(run.writer, run.ingested, False))
    return [d for d in have if d not in set(begun)]
