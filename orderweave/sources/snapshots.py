"""Versioned snapshots of several tables that change together.

Every version of a table is written to a folder of its own and never overwritten. Logs grow by parts, each a folder of its
own. A *commit* is one small record that names the folder of every table, the new parts, and the schema of every log; readers
look at commits only, so a change of several tables shows up at once or not at all, and what a part without a commit
holds (other columns, a broken file) concerns nobody. A commit carries a key: committing the same
key again does nothing, which makes a replayed micro-batch harmless. Every folder has a fresh name, so what a crash left
behind is neither read nor in the way. One writer at a time is assumed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COMMIT = ("version long, run_key string, tables map<string,string>, added map<string,string>, "
           "schemas map<string,string>")


class LogSchemaError(ValueError):
    """A part whose columns are not those of its log."""


def _columns(schema: T.StructType) -> list[tuple[str, str]]:
    """What two parts of a log must share: names and types in order; whether nulls may occur is left open."""
    return [(f.name, f.dataType.simpleString()) for f in schema]


def _schema(stored: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(stored))


class SnapshotStore:
    """Below ``root``: ``data/`` holds table versions, ``logs/`` parts of logs, ``commits/`` one record per commit."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _commits(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_COMMIT).json(f"{self.root}/commits/*")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _state(self, run_key: str | None = None) -> Row | None:
        """The latest commit, and the version that has this key (or null): one reading of the commits."""
        commits = self._commits()
        if commits is None:
            return None
        state = commits.agg(
            F.max_by(F.struct("version", "tables", "schemas"), "version").alias("c"),
            F.max(F.when(F.col("run_key") == F.lit(run_key), F.col("version"))).alias("done")).first()
        return state if state["c"] is not None else None

    def version(self) -> int:
        state = self._state()
        return state["c"]["version"] if state else 0

    def committed(self, run_key: str) -> bool:
        state = self._state(run_key)
        return state is not None and state["done"] is not None

    def commit(self, run_key: str, tables: Mapping[str, DataFrame] | None = None,
               added: Mapping[str, DataFrame] | None = None) -> bool:
        """Replace ``tables``, append to the logs in ``added``, and publish both at once. False if already done.

        A part whose columns differ from those of its log is refused before anything is written.
        """
        state = self._state(run_key)
        if state and state["done"] is not None:
            return False
        latest = state["c"] if state else None
        schemas = dict(latest["schemas"] or {}) if latest else {}
        for name, df in (added or {}).items():
            if name in schemas and _columns(df.schema) != _columns(_schema(schemas[name])):
                raise LogSchemaError(f"log {name!r} has the columns {schemas[name]}, the part {df.schema.json()}")
            schemas.setdefault(name, df.schema.json())
        paths = dict(latest["tables"] or {}) if latest else {}
        paths.update({name: self.stage(name, df) for name, df in (tables or {}).items()})
        logs = {name: self.stage_part(name, df) for name, df in (added or {}).items()}
        self._write((latest["version"] if latest else 0) + 1, run_key, paths, logs, schemas)
        return True

    def publish(self, version: int, run_key: str, paths: Mapping[str, str], logs: Mapping[str, str],
                schemas: Mapping[str, str] | None = None) -> None:
        """The one write that makes a version visible; a version that is there already is refused.

        ``schemas`` has the schema, as JSON, of each log that is new.
        """
        state = self._state()
        if state and version <= state["c"]["version"]:
            raise RuntimeError(f"version {version} exists")
        known = {**(schemas or {}), **((state["c"]["schemas"] or {}) if state else {})}
        if unknown := set(logs) - set(known):
            raise LogSchemaError(f"no schema for the logs {sorted(unknown)}")
        self._write(version, run_key, paths, logs, known)

    def _write(self, version: int, run_key: str, paths: Mapping[str, str], logs: Mapping[str, str],
               schemas: Mapping[str, str]) -> None:
        record = self.spark.createDataFrame([(version, run_key, dict(paths), dict(logs), dict(schemas))], _COMMIT)
        record.coalesce(1).write.mode("error").json(f"{self.root}/commits/{version:012d}-{uuid.uuid4().hex}")

    def stage(self, name: str, df: DataFrame) -> str:
        """Write a new folder that no reader sees until a commit names it."""
        path = f"{self.root}/data/{name}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return path

    def stage_part(self, name: str, df: DataFrame) -> str:
        """Write a new part of a log that no reader sees until a commit names it."""
        path = f"{self.root}/logs/{name}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return path

    def load(self, name: str, version: int | None = None) -> DataFrame:
        """The table as of a version, by default the latest."""
        if version is None:
            state = self._state()
            tables = state["c"]["tables"] if state else {}
        else:
            commits = self._commits()
            at = commits.where(F.col("version") == version).select("tables").first() if commits is not None else None
            if at is None:
                raise KeyError(f"no version {version}")
            tables = at["tables"]
        return self.spark.read.parquet(tables[name])

    def load_log(self, name: str, empty: Callable[[], DataFrame] | None = None, since: int | None = None,
                 until: int | None = None, run_id: str | None = None) -> DataFrame:
        """Committed additions to a log, of all versions or those after ``since`` up to ``until``, of all runs or one
        (keys ``<run_id>/...``). Only the parts of these commits are opened; their schema is the log's.

        The driver gets one path for each commit, as it does for the files of any table.
        """
        commits = self._commits()
        parts: list[str] = []
        schema: T.StructType | None = None
        if commits is not None:
            wanted = F.col("added")[name].isNotNull()
            if since is not None:
                wanted &= F.col("version") > since
            if until is not None:
                wanted &= F.col("version") <= until
            if run_id is not None:
                wanted &= F.col("run_key").startswith(f"{run_id}/")
            path = F.when(wanted, F.col("added")[name])
            found = commits.agg(F.max_by(F.col("schemas")[name], "version").alias("schema"),
                                F.collect_list(path).alias("parts")).first()
            parts = found["parts"]
            schema = _schema(found["schema"]) if found["schema"] else None
        if schema is None:
            if empty is None:
                raise KeyError(f"no log {name!r}")
            return empty()
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*parts)

    def added_by(self, run_key: str, name: str) -> DataFrame:
        """What one commit added to a log; only that part is read."""
        commit = self._commits().where(F.col("run_key") == run_key).select(
            F.col("added")[name].alias("part"), F.col("schemas")[name].alias("schema")).first()
        return self.spark.read.schema(_schema(commit["schema"])).parquet(commit["part"])
