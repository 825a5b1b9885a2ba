"""Resumable runs: a log of stage outputs by what they were made from.

A stage has a key: a hash of its name, its parameters and the keys (or the
fingerprint) of its inputs.  The log beside the outputs says which stage began
and ended with which key.  A stage whose last record says it ended with the
same key is not run again; everything else is, and a changed input or parameter
changes the keys of all that follows from it.  Records are only ever added, and
one counts once its write is committed, so a run may be cut short anywhere.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.sources.batches import _file_system, child_names

_SCHEMA = "number long, stage string, key string, ended boolean, payload string"


def fingerprint(df: DataFrame) -> str:
    """Hash of what `df` reads (path, length and time of every file), its plan
    and its schema.  A frame that reads no file (rows from the driver) has none:
    name one yourself."""
    spark = df.sparkSession
    files = sorted(df.inputFiles())
    if not files:
        raise ValueError("the frame reads no files; give its fingerprint")
    seen = []
    for folder in sorted({f.rsplit("/", 1)[0] for f in files}):
        fs, path = _file_system(spark, folder)
        seen += [f"{s.getPath()}:{s.getLen()}:{s.getModificationTime()}" for s in fs.listStatus(path) if s.isFile()]
    setting = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "100000")
    try:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set(setting, before)
    plan = re.sub(r"#\d+L?|plan_id=\d+", "", plan)  # numbers that differ from session to session
    return _digest([files, sorted(seen), plan, df.schema.json()])


def stage_key(stage: str, inputs: list[str], **parameters) -> str:
    return _digest([stage, inputs, sorted((k, repr(v)) for k, v in parameters.items())])


def _digest(parts) -> str:
    return hashlib.sha256(json.dumps(parts).encode()).hexdigest()[:24]


class StageLog:
    """The log under `<root>/_stages`."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark, self._base = spark, f"{root.rstrip('/')}/_stages"
        self.ran: list[str] = []
        self.kept: list[str] = []
        self._last: dict[str, tuple] = {}
        names = child_names(spark, self._base)
        self._next = 1 + max([int(n) for n in names if n.isdigit()], default=0)
        if names:
            rows = spark.read.schema(_SCHEMA).json([f"{self._base}/{n}" for n in names if n.isdigit()])
            for r in sorted(rows.collect(), key=lambda r: r["number"]):
                self._last[r["stage"]] = (r["key"], r["ended"], r["payload"])

    def _add(self, stage: str, key: str, ended: bool, payload: str) -> None:
        row = (self._next, stage, key, ended, payload)
        self._spark.createDataFrame([row], _SCHEMA).coalesce(1).write.json(f"{self._base}/{self._next:010d}")
        self._last[stage], self._next = (key, ended, payload), self._next + 1

    def run(self, stage: str, key: str, action: Callable[[], dict | None]) -> dict:
        """The payload (JSON values) of `stage`: on record if it ended with this
        key, else from running `action`, which writes the stage's outputs."""
        last = self._last.get(stage)
        if last is not None and last[:2] == (key, True):
            self.kept.append(stage)
            return json.loads(last[2])
        self._add(stage, key, False, "{}")
        payload = action() or {}
        self._add(stage, key, True, json.dumps(payload))
        self.ran.append(stage)
        return payload


class NoLog:
    """Runs every stage; what a run without resumption uses."""

    def run(self, stage: str, key: str, action: Callable[[], dict | None]) -> dict:
        return action() or {}
