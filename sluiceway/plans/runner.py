"""Run a whole job: extract, transform, load, log."""

from __future__ import annotations

import datetime as dt
import re
import uuid
import warnings
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass, field
from threading import Thread
from typing import Any

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions.names import is_yes
from sluiceway.operators.protection import Method, ProtectionError
from sluiceway.plans.job import Job
from sluiceway.plans.run_log import Entry, append_log, entries_frame
from sluiceway.plans.sources import read_base, shares_base
from sluiceway.plans.transforms import (
    SHARING,
    Transform,
    base_consumers,
    consumers,
    equal_results,
    load_transforms,
    run_transforms,
)
from sluiceway.sinks import jdbc
from sluiceway.sinks.files import Tap, load_files, no_tap, output_path, write_files
from sluiceway.sinks.staging import remove_staged, staging_folder
from sluiceway.sinks.tables import load_table, table_location

# Load types, in lower case, by the sink they stand for.
FILE_LOADS = ("s3",)
TABLE_LOADS = ("athena",)
TRUNCATING_LOADS = ("teradata",)
ALIGNED_LOADS = ("redshift",)
AUDITED_LOADS = ("postgres", "jdbc_postgres", "jdbc")
LOAD_TYPES = FILE_LOADS + TABLE_LOADS + TRUNCATING_LOADS + ALIGNED_LOADS + AUDITED_LOADS


@dataclass
class JobResult:
    """What a run produced: the log, and the lazy frames by transform id."""

    run_id: str
    base: DataFrame = field(repr=False)
    frames: dict[str, DataFrame] = field(repr=False)
    entries: list[Entry] = field(default_factory=list)
    staged: list[str] = field(default_factory=list)

    def release(self) -> None:
        """Remove the tables the run shared through the folder; frames built on them can't be read after that."""
        while self.staged:
            remove_staged(self.base.sparkSession, self.staged.pop())

    def log(self) -> DataFrame:
        return entries_frame(self.base.sparkSession, self.entries)


def load_kind(load: Mapping[str, Any]) -> str:
    kind = str(load.get("load_type") or "").lower()
    if kind not in LOAD_TYPES:
        raise ValueError(f"unknown load type {load.get('load_type')!r}, know {list(LOAD_TYPES)}")
    return kind


def _connection(job: Job, props: Mapping[str, Any], default: str | None = None) -> dict[str, Any]:
    name = str(props.get("connection_name") or default or "").strip()
    if not name:
        raise ValueError("a JDBC load needs 'connection_name'")
    return job.connection(name)


def load_target(load: Mapping[str, Any], job: Job) -> str:
    """A name for where a load goes; loads of one target never overlap."""
    kind, props = load_kind(load), load.get("load_properties") or {}
    if kind in FILE_LOADS:
        return output_path(props.get("bucket"), props.get("name"), job.period or "")
    if kind in TABLE_LOADS:
        return f"{props.get('schema')}.{props.get('table')}"
    return f"{kind}:{props.get('connection_name') or 'default'}:{props.get('dbtable')}"


def _place(load: Mapping[str, Any], job: Job, spark: SparkSession) -> tuple[str, str]:
    """Where a load's rows end up: a folder, which for a catalog table is the table's, or a remote table."""
    kind, props = load_kind(load), load.get("load_properties") or {}
    target = load_target(load, job)
    if kind in TABLE_LOADS:
        try:
            target = table_location(spark, str(props.get("schema")).strip(), str(props.get("table")).strip())
        except (AnalysisException, ValueError):
            return "table", target.lower()
    elif kind not in FILE_LOADS:
        # Two connections may lead to one database, so tables are told apart by their own name only.
        return "remote", str(props.get("dbtable")).split(".")[-1].strip().strip('"`').lower()
    return "folder", re.sub(r"^file:/*", "/", re.sub(r"(?<!:)/+", "/", target)).rstrip("/") + "/"


def _overlap(a: tuple[str, str], b: tuple[str, str]) -> bool:
    """Do two loads touch the same place, or one a folder inside the other's?"""
    if a[0] != b[0]:
        return False
    return a[1].startswith(b[1]) or b[1].startswith(a[1]) if a[0] == "folder" else a[1] == b[1]


def run_load(
    df: DataFrame,
    load: Mapping[str, Any],
    job: Job,
    methods: Mapping[str, Method] | None = None,
    tap: Tap = no_tap,
) -> None:
    """Send one frame to the sink its load names."""
    kind, props = load_kind(load), load.get("load_properties") or {}
    if kind in FILE_LOADS:
        load_files(df, props, job.batch_id, job.period, methods, tap)
    elif kind in TABLE_LOADS:
        load_table(df, props, job.period, methods, tap)
    elif kind in TRUNCATING_LOADS:
        jdbc.load_truncating(df, props, _connection(job, props), tap)
    elif kind in ALIGNED_LOADS:
        connection = _connection(job, props, jdbc.ALIGNED["connection"])
        jdbc.load_aligned(df, props, connection, tap=tap)
    else:
        connection = _connection(job, props, jdbc.AUDITED["connection"])
        jdbc.load_audited(df, props, connection, job.period, job.batch_id, tap)


class _Run:
    """One run's state: its log and the job it belongs to."""

    def __init__(self, job: Job, methods: Mapping[str, Method] | None, run_id: str) -> None:
        self.id = run_id
        self.job = job
        self.methods = methods
        self.entries: list[Entry] = []
        self.rows_of: list[tuple[DataFrame, int]] = []

    def note(self, stage: str, target: str, rows: int | None, error: BaseException | None = None) -> None:
        self.entries.append(
            Entry(
                run_id=self.id,
                batch_id=self.job.batch_id,
                period=self.job.period,
                stage=stage,
                target=target,
                rows=rows,
                status="error" if error else "ok",
                # The kind of error only: messages may quote data or connections.
                error=type(error).__name__ if error else None,
                logged_at=dt.datetime.now(dt.UTC),
            )
        )

    def load(self, df: DataFrame, load: Mapping[str, Any]) -> None:
        """Run one load and count its rows on the way, without a pass of its own.

        The count is kept with the frame it came from: loads of one target may
        take different frames.

        The count sits in the writing stage, after any shuffle, where a task
        that is run again is counted once.
        """
        target = load_target(load, self.job)
        seen = Observation()
        try:
            run_load(df, load, self.job, self.methods, _counting(seen))
        except Exception as error:
            self.note("load", target, None, error)
            tolerant = is_yes((load.get("load_properties") or {}).get("error_continue"))
            if isinstance(error, ProtectionError) or not tolerant:
                raise
        else:
            rows = _rows_seen(seen)
            self.note("load", target, rows)
            if rows is not None:
                self.rows_of.append((df, rows))


def _rows_seen(seen: Observation, seconds: float = 600) -> int | None:
    """The row count of a write that has ended; its report may be on its way. None, with a warning, where none comes."""
    found: list[int | None] = []
    waiter = Thread(target=lambda: found.append(seen.get.get("rows")), daemon=True)
    waiter.start()
    waiter.join(seconds)
    if not found:
        warnings.warn("a load ended but reported no row count", stacklevel=2)
    return found[0] if found else None


def _counting(seen: Observation) -> Tap:
    return lambda rows: rows.observe(seen, F.count(F.lit(1)).alias("rows"))


def _staged(df: DataFrame, label: str, paths: list[str]) -> tuple[DataFrame, int | None]:
    """The frame as a table in the shared folder, cut off from what computed it, and its rows; notes the path."""
    path, seen = staging_folder(df.sparkSession, label), Observation()
    paths.append(path)
    write_files(df, path, mode="errorifexists", tap=_counting(seen))
    return df.sparkSession.read.schema(df.schema).parquet(path), _rows_seen(seen)


def _asked_by(load: Mapping[str, Any]) -> str:
    """The transform a load asks for; '' is the base."""
    ident = load.get("transform_id")
    return "" if ident is None else str(ident)


def _check_loads(loads: list[dict[str, Any]], transforms: list[Transform], job: Job) -> list[str]:
    """Every load has a known type, a target and an existing transform; which are asked for."""
    known = {t.id for t in transforms}
    for load in loads:
        load_target(load, job)
        if _asked_by(load) not in known | {""}:
            raise ValueError(f"load names transform {_asked_by(load)!r}, which does not exist")
    return [_asked_by(load) for load in loads if _asked_by(load)]


def _run_loads(run: _Run, work: list[tuple[DataFrame, Mapping[str, Any]]]) -> None:
    """Loads run in document order and end at the first failure, unless the job asks for parallel ones.

    Even then loads whose places overlap keep their order.
    """

    def run_all(items: list[tuple[DataFrame, Mapping[str, Any]]]) -> None:
        for df, load in items:
            run.load(df, load)

    if run.job.parallelism() == 1 or len(work) == 1:
        run_all(work)
        return
    spark = work[0][0].sparkSession
    places = [_place(load, run.job, spark) for _, load in work]
    groups: list[list[int]] = []
    for nr, place in enumerate(places):
        touched = [g for g in groups if any(_overlap(place, places[i]) for i in g)]
        groups = [g for g in groups if g not in touched] + [sorted([nr, *(i for g in touched for i in g)])]
    with ThreadPoolExecutor(min(run.job.parallelism(), len(groups))) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(run_all), [work[i] for i in g]) for g in groups]
        try:
            for future in as_completed(futures):
                future.result()
        except BaseException:
            pool.shutdown(wait=True, cancel_futures=True)
            raise


def run_job(
    spark: SparkSession,
    process: Mapping[str, Any],
    shared: Mapping[str, Any] | None = None,
    batch_id: str | None = None,
    period: str | None = None,
    base: DataFrame | None = None,
    methods: Mapping[str, Method] | None = None,
    log_path: str | None = None,
    count_source: bool = False,
    run_id: str | None = None,
) -> JobResult:
    """Run a job document.

    ``base`` replaces the extract stage with a frame at hand.  Only transforms a
    load asks for are planned, and one with several consumers is shared by them
    as its ``share`` says, and so is the base.  Transforms with equal plans are one.  Tables shared through the folder
    stay until the result is released, or the run fails.  ``count_source`` counts the source, which is a scan of
    its own for anything but parquet.  The log is appended to ``log_path`` even
    when the run fails.
    """
    job = Job(process, shared or {}, batch_id, period)
    run = _Run(job, methods, run_id or uuid.uuid4().hex)
    kept: list[DataFrame] = []
    paths: list[str] = []
    try:
        # Whatever the documents alone can tell to be wrong is told before any work.
        loads = job.modules("load")
        sql_folder = str(job.settings("paths").get("path_transform_sql") or "")
        transforms = load_transforms(spark, job.modules("transform"), sql_folder)
        asked = _check_loads(loads, transforms, job)
        only = set(asked) if loads else None

        def shared(df: DataFrame, share: str, label: str) -> tuple[DataFrame, int | None]:
            if share == "table":
                return _staged(df, label, paths)
            # Filled before its consumers start: side by side, each would compute it.
            kept.append(df.persist(StorageLevel.MEMORY_AND_DISK))
            return df, df.count()

        source, base_rows = "frame", None
        if base is None:
            share = shares_base(job)
            if share not in SHARING:
                raise ValueError(f"the base is shared as {share!r}, know {SHARING}")
            base, source = read_base(spark, job, methods)
        same = equal_results(base, transforms, only) if loads and len(transforms) > 1 else {}
        uses = consumers(transforms, asked, only, same)
        if source != "frame" and loads and share != "none" and base_consumers(transforms, list(map(_asked_by, loads)), only, same) > 1:
            base, base_rows = shared(base, share, "base")
        if count_source and base_rows is None:
            base_rows = base.count()
        run.note("extract", source, base_rows)

        counted: dict[str, int | None] = {}

        def settle(transform: Transform, df: DataFrame) -> DataFrame:
            if not loads or uses[transform.id] < 2 or transform.share == "none":
                return df
            df, counted[transform.id] = shared(df, transform.share, transform.view)
            return df

        frames = run_transforms(base, transforms, only, settle, same, job.parallelism())
        work = [(frames.get(_asked_by(load), base), load) for load in loads]
        if work:
            _run_loads(run, work)
        for ident in frames:
            first = same.get(ident, ident)
            rows = counted[first] if first in counted else _rows_of(run, frames[ident])
            run.note("transform", f"tx_{ident}", rows)
        return JobResult(run.id, base, frames, run.entries, paths)
    except Exception as error:
        run.note("run", "job", None, error)
        for path in paths:
            remove_staged(spark, path)
        raise
    finally:
        for df in kept:
            df.unpersist()
        if log_path:
            append_log(spark, log_path, run.entries)


def _rows_of(run: _Run, df: DataFrame) -> int | None:
    """A transform's rows are those of any load that took them."""
    return next((rows for frame, rows in run.rows_of if frame is df), None)
