"""Spark SQL transforms over one base relation."""

from __future__ import annotations

import re
import threading
import warnings
from collections import Counter, defaultdict
from collections.abc import Callable, Collection, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from graphlib import CycleError, TopologicalSorter

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession

from sluiceway.functions.names import quoted

# Names under which SQL text finds the base and earlier results.
INPUT_TOKEN = "{{SOURCE_INPUT}}"
BASE_VIEW = "source_table"
RESULT_VIEW = "tx_"

# What becomes of a result that several consumers ask for.
SHARING = ("persist", "table", "none")

# Views are session-wide names.  Two jobs of one session take turns between
# registering them and resolving their SQL, which is all that needs the names.
_VIEWS = threading.Lock()


@dataclass(frozen=True)
class Transform:
    """One SQL text with its id, and how its result is shared.

    A result with several consumers is by default persisted while they run.
    ``table`` writes it to the shared folder instead, which outlives the loss of
    executors; ``none`` computes it for each consumer, which is best where the
    text is a cheap filter or projection that reaches the scan.  ``relations``
    are the names of relations the text reads, where Spark has parsed it.
    """

    id: str
    sql: str
    share: str = "persist"
    relations: frozenset[str] | None = None

    def __post_init__(self) -> None:
        if self.share not in SHARING:
            raise ValueError(f"transform {self.id!r} is shared as {self.share!r}, know {SHARING}")

    @property
    def view(self) -> str:
        return RESULT_VIEW + self.id

    def reads(self, ids: Collection[str]) -> set[str]:
        """Which of the given transforms this one reads; without parsed relations, which its text mentions."""
        if self.relations is None:
            names = {w.lower() for w in re.findall(rf"\b{RESULT_VIEW}\w+", self.sql, flags=re.IGNORECASE)}
        else:
            names = self.relations
        return {i for i in ids if i != self.id and (RESULT_VIEW + i).lower() in names}


def relations_of(spark: SparkSession, sql: str) -> frozenset[str] | None:
    """Names, in lower case, of the relations a SQL text reads, as Spark's parser finds them; None if it can't.

    A text that can't be parsed fails when it is run, and only if somebody asks for it.
    """
    try:
        parsed = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql.replace(INPUT_TOKEN, BASE_VIEW))
    except ParseException:
        return None
    return frozenset(name.lower() for name in re.findall(r"UnresolvedRelation \[(\w+)\]", parsed.toString()))


def read_sql(spark: SparkSession, folder: str, name: str) -> str:
    """The text of a SQL file, on any file system Spark can read."""
    path = f"{folder.rstrip('/')}/{name}" if folder else name
    try:
        return spark.read.text(path, wholetext=True).first()["value"]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(path) from error


def load_transforms(
    spark: SparkSession, modules: Sequence[Mapping[str, object]], sql_folder: str = ""
) -> list[Transform]:
    """Read transform modules: inline text, or a file when ``transform_type`` says so.

    The id is ``transform_id`` or the module's position; a module without SQL is
    left out with a warning.
    """
    found: dict[str, Transform] = {}
    for place, module in enumerate(modules, start=1):
        ident = str(module.get("transform_id") or place)
        text = str(module.get("transform_sql") or "")
        kind = module.get("transform_type")
        if not text:
            warnings.warn(f"transform {ident} has no SQL, left out", stacklevel=2)
            continue
        if not re.fullmatch(r"\w+", ident):
            raise ValueError(f"transform id {ident!r} cannot be part of a view name")
        if ident in found:
            raise ValueError(f"transform id {ident!r} is used twice")
        if str(kind or "code").lower() == "file":
            text = read_sql(spark, sql_folder, text)
        elif kind is None and text.lower().endswith(".sql"):
            warnings.warn(f"transform {ident} names no type, {text!r} is taken as SQL text", stacklevel=2)
        share = str(module.get("share") or "persist").lower()
        found[ident] = Transform(ident, text, share, relations_of(spark, text))
    return list(found.values())


def needed_in_order(transforms: Sequence[Transform], only: Collection[str] | None = None) -> list[Transform]:
    """Transforms to run, each after those it reads.

    With ``only``, the named ones and whatever they read, directly or not.
    """
    by_id = {t.id: t for t in transforms}
    reads = {t.id: sorted(t.reads(by_id)) for t in transforms}
    wanted, open_ids = set(), [i for i in (by_id if only is None else only) if i in by_id]
    while open_ids:
        ident = open_ids.pop()
        if ident not in wanted:
            wanted.add(ident)
            open_ids += reads[ident]
    try:
        order = list(TopologicalSorter({i: reads[i] for i in by_id if i in wanted}).static_order())
    except CycleError as error:
        raise ValueError(f"transforms read each other in a circle: {error.args[1]}") from error
    return [by_id[i] for i in order]


def _is_temp_view(spark: SparkSession, name: str) -> bool:
    return any(t.name.lower() == name.lower() for t in spark.catalog.listTables(pattern=name) if t.isTemporary)


@contextmanager
def _views(spark: SparkSession, frames: Mapping[str, DataFrame]) -> Iterator[None]:
    """Temporary views for the time of one resolution; earlier ones come back after it."""
    with _VIEWS:
        earlier = {name: spark.table(name) if _is_temp_view(spark, name) else None for name in frames}
        created = []
        try:
            for name, df in frames.items():
                df.createOrReplaceTempView(name)
                created.append(name)
            yield
        finally:
            for name in created:
                df = earlier[name]
                if df is None:
                    # catalog.dropTempView would also unpersist the frame behind the view.
                    spark.sql(f"DROP VIEW IF EXISTS {quoted(name)}")
                else:
                    df.createOrReplaceTempView(name)


def equal_results(base: DataFrame, transforms: Sequence[Transform], only: Collection[str] | None = None) -> dict[str, str]:
    """Transforms whose result is that of an earlier one, however their SQL is written, with that one's id.

    Spark compares the resolved plans; column names, types and the way to share must be equal too. Plans that draw
    random values differ from each other.
    """
    share = {t.id: t.share for t in transforms}
    results = run_transforms(base, transforms, only)
    classes: dict[object, list[str]] = defaultdict(list)
    same = {}
    for transform in needed_in_order(transforms, only):
        df = results[transform.id]
        alike = classes[(df.semanticHash(), share[transform.id], df.schema.json())]
        first = next((i for i in alike if results[i].sameSemantics(df)), None)
        if first is None:
            alike.append(transform.id)
        else:
            same[transform.id] = first
    return same


def consumers(
    transforms: Sequence[Transform],
    asked: Sequence[str],
    only: Collection[str] | None = None,
    same: Mapping[str, str] | None = None,
) -> Counter[str]:
    """How many loads and planned transforms read each result; equal ones are one result."""
    planned, same = needed_in_order(transforms, only), same or {}
    ids = {t.id for t in planned}
    reads = [{same.get(i, i) for i in t.reads(ids)} for t in planned if t.id not in same]
    return Counter(same.get(i, i) for i in asked) + Counter(i for read in reads for i in read)


def base_consumers(
    transforms: Sequence[Transform],
    asked: Sequence[str],
    only: Collection[str] | None = None,
    same: Mapping[str, str] | None = None,
) -> int:
    """How many loads (those that ask for '') and planned transforms read the base; equal transforms are one."""
    planned = [t for t in needed_in_order(transforms, only) if t.id not in (same or {})]
    return list(asked).count("") + sum(t.relations is None or BASE_VIEW in t.relations for t in planned)


def run_transforms(
    base: DataFrame,
    transforms: Sequence[Transform],
    only: Collection[str] | None = None,
    settle: Callable[[Transform, DataFrame], DataFrame] = lambda transform, df: df,
    same: Mapping[str, str] | None = None,
    at_once: int = 1,
) -> dict[str, DataFrame]:
    """Lazy results by id, in the order of the job.

    Nothing is computed here: Spark sees each result together with the load that
    asks for it, and reads only the columns and rows that load needs.  ``settle``
    may put a result on firmer ground before others build on it; of results that
    don't read each other, up to ``at_once`` are settled side by side.  Transforms
    in ``same`` get the result of the one named there.
    """
    spark, same = base.sparkSession, same or {}
    results: dict[str, DataFrame] = {}
    left = needed_in_order(transforms, only)
    ids = {t.id for t in left}

    def planned(transform: Transform) -> DataFrame:
        read = {RESULT_VIEW + ident: results[ident] for ident in transform.reads(results)}
        with _views(spark, {BASE_VIEW: base, **read}):
            return spark.sql(transform.sql.replace(INPUT_TOKEN, BASE_VIEW))

    while left:
        for transform in left:
            if same.get(transform.id) in results:
                results[transform.id] = results[same[transform.id]]
        ready = [t for t in left if t.id not in same and t.reads(ids) <= results.keys()]
        work = [(t, planned(t)) for t in ready]
        if at_once > 1 and len(work) > 1:
            with ThreadPoolExecutor(min(at_once, len(work))) as pool:
                settled = list(pool.map(inheritable_thread_target(spark)(lambda one: settle(*one)), work))
        else:
            settled = [settle(*one) for one in work]
        results.update(zip([t.id for t in ready], settled))
        left = [t for t in left if t.id not in results]
    return {t.id: results[t.id] for t in transforms if t.id in results}


def last_result(base: DataFrame, results: Mapping[str, DataFrame]) -> DataFrame:
    """The last transform's result, or the base when there is none."""
    return list(results.values())[-1] if results else base
