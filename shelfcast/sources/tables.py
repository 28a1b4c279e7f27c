"""Named Parquet tables that outlive the session.

A table is a folder of versions and a log of its states, both under ``base``. A version holds its rows in
loads, one folder each; a state names the version, the loads that count, and for a table by day the loads
of each day. Every write makes a new folder and then a new state: replacing a table starts a version,
appending adds a load, replacing days lets the new load stand for them. What a failed write left
behind is in no state, so readers see the old rows or the new ones, and a repeated load is written
whole again. The catalog's entry is a view of the newest state, moved in one change. The log is what
counts: a session whose catalog does not know the table (a new process, or one that failed between the
log and the catalog) finds it there.

States are small files, read and written by the driver's file system without a Spark job.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.columns import align_to
from ..operators.joins import not_in
from ..operators.upserts import upserted

#: Loads are told apart by at most so many values of their ``once`` columns; others by reading the table.
LOAD_KEYS = 10_000
#: Days of rows that need not be dealt by day to be written.
FEW_DAYS = 8
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class State:
    """``loads``: the keys of each load that counts (None: not known). ``days``: for a table by one
    column, the loads of each of its values."""

    version: int
    folder: str
    schema: dict
    partitions: list[str]
    loads: dict[str, list[str] | None]
    days: dict[str, list[str]] = field(default_factory=dict)

    @property
    def columns(self) -> T.StructType:
        return T.StructType.fromJson(self.schema)


def _file_system(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def path_exists(spark: SparkSession, path: str) -> bool:
    files, found = _file_system(spark, path)
    return files.exists(found)


def _names(spark: SparkSession, path: str) -> list[str]:
    files, found = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(found)) if files.exists(found) else []


def _root(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name.replace('.', '/')}"


def _states(spark: SparkSession, name: str, base: str, last: int) -> list[State]:
    """The newest states, newest first."""
    log, found = f"{_root(base, name)}/log", []
    for file in reversed(_names(spark, log)):
        if len(found) == last:
            break
        files, path = _file_system(spark, f"{log}/{file}")
        stream = files.open(path)
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            found.append(State(**json.loads(text)))
        except ValueError:  # a writer that failed within the file has changed nothing
            continue
    return found


def _state(spark: SparkSession, name: str, base: str) -> State | None:
    return next(iter(_states(spark, name, base, 1)), None)


def _commit(spark: SparkSession, name: str, base: str, state: State) -> DataFrame:
    """Add the state to the log, unless another writer has taken its number, and show it."""
    files, path = _file_system(spark, f"{_root(base, name)}/log/{state.version:012d}.json")
    stream = files.create(path, False)
    try:
        stream.write(bytearray(json.dumps(asdict(state)), "utf-8"))
    finally:
        stream.close()
    _point(spark, name, base, state)
    return spark.table(name)


def _write_load(spark: SparkSession, root: str, df: DataFrame, folder: str, partition_by: Sequence[str]) -> tuple[str, list[str]]:
    """The new load's name and, for a table by one column, its values."""
    load = f"l{uuid.uuid4().hex[:12]}"
    path = f"{root}/{folder}/_load={load}"
    df.write.partitionBy(*partition_by).parquet(path)
    if len(partition_by) != 1:
        return load, []
    held = [unquote(n.split("=", 1)[1]) for n in _names(spark, path) if "=" in n]
    return load, ["" if v == _NO_DAY else v for v in held]


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _point(spark: SparkSession, name: str, base: str, state: State) -> None:
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    columns = [f"`{f.name}`" for f in state.columns.fields]
    if len(state.partitions) == 1:
        parts = [f"{load}/{day}" for day, loads in state.days.items() for load in loads]
        shown = f"concat(_load, '/', coalesce(CAST(`{state.partitions[0]}` AS STRING), ''))"
    else:
        parts, shown = list(state.loads), "_load"
    if parts:
        rows = f"parquet.`{_root(base, name)}/{state.folder}` WHERE {shown} IN ({', '.join(map(_text, parts))})"
        text = f"SELECT {', '.join(columns)} FROM {rows}"
    else:  # without files there is nothing to read a schema from
        nothing = [f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in state.columns.fields]
        text = f"SELECT {', '.join(nothing)} WHERE FALSE"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {text}")


def recover_table(spark: SparkSession, name: str, base: str) -> bool:
    """Point the catalog's entry at the newest state in the log; False if there is none."""
    state = _state(spark, name, base)
    if state:
        _point(spark, name, base, state)
    return state is not None


def table_exists(spark: SparkSession, name: str, base: str | None = None) -> bool:
    """Whether the catalog knows the table, or, given ``base``, its log does."""
    return spark.catalog.tableExists(name) or (base is not None and recover_table(spark, name, base))


def table_columns(spark: SparkSession, name: str) -> list[str]:
    return spark.table(name).columns


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog name, or a path (anything with a slash)."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def _keys(df: DataFrame, once: Sequence[str]) -> list[str] | None:
    """The loads that a frame holds, by the values of its ``once`` columns; None if they are many."""
    if not once:
        return None
    values = df.select(F.to_json(F.array(*[F.col(c).cast("string") for c in once])).alias("key")).distinct()
    found = [r.key for r in values.limit(LOAD_KEYS + 1).collect()]
    return sorted(found) if len(found) <= LOAD_KEYS else None


def replace_table(
    spark: SparkSession,
    name: str,
    df: DataFrame,
    base: str,
    partition_by: Sequence[str] = (),
    once: Sequence[str] = (),
) -> DataFrame:
    """Write ``df`` as the table's next version. ``df`` may read the old one."""
    before = _state(spark, name, base)
    folder = uuid.uuid4().hex[:12]
    load, days = _write_load(spark, _root(base, name), df, folder, partition_by)
    ordered = [*[f for f in df.schema.fields if f.name not in partition_by], *[df.schema[c] for c in partition_by]]
    state = State(
        version=before.version + 1 if before else 1,
        folder=folder,
        schema=T.StructType(ordered).jsonValue(),
        partitions=list(partition_by),
        loads={load: _keys(df, once)},
        days={day: [load] for day in days},
    )
    return _commit(spark, name, base, state)


def ensure_table(
    spark: SparkSession, name: str, schema: T.StructType, base: str, partition_by: Sequence[str] = ()
) -> None:
    """Create an empty table (and its database) unless it exists."""
    if not table_exists(spark, name, base):
        replace_table(spark, name, spark.createDataFrame([], schema), base, partition_by)


def refill_table(
    spark: SparkSession, name: str, df: DataFrame, schema: T.StructType, base: str
) -> DataFrame:
    """Empty the table and insert ``df``, under the declared schema."""
    return replace_table(spark, name, align_to(df, schema), base)


def _added(state: State, load: str, keys: list[str] | None, days: Sequence[str], gone: Sequence[str]) -> State:
    """The state after a load, in place of those ``gone``."""
    kept = {day: [x for x in loads if x not in gone] for day, loads in state.days.items()}
    for day in days:
        kept[day] = [*kept.get(day, []), load]
    return replace(
        state,
        version=state.version + 1,
        loads={**{x: k for x, k in state.loads.items() if x not in gone}, load: keys},
        days={day: loads for day, loads in kept.items() if loads},
    )


def append_aligned(
    spark: SparkSession, name: str, df: DataFrame, base: str, once: Sequence[str] = ()
) -> DataFrame:
    """Create the table from ``df``, or append ``df`` in the stored columns and order.

    ``once`` names columns that tell one load from another. A load that ``df`` repeats is written
    again as a whole, in place of what the table holds of it, so that a repeated run adds nothing and
    mends a load that lost files. Loads that were written together with others that ``df`` doesn't
    have stay, and their rows of ``df`` are left out.
    """
    state = _state(spark, name, base)
    if state is None:
        return replace_table(spark, name, df, base, once=once)
    _point(spark, name, base, state)
    rows = align_to(df, state.columns)
    keys, gone = _keys(rows, once), []
    if once and keys == []:
        return spark.table(name)
    if once and keys is not None and None not in state.loads.values():
        gone = [load for load, held in state.loads.items() if held and set(held) <= set(keys)]
        held = {k for load, own in state.loads.items() if load not in gone for k in own} & set(keys)
        if held:
            rows = rows.where(~F.to_json(F.array(*[F.col(c).cast("string") for c in once])).isin(sorted(held)))
            keys = sorted(set(keys) - held)
            if not keys:
                return spark.table(name)
    elif once:
        rows = not_in(rows, spark.table(name), once)
    load, days = _write_load(spark, _root(base, name), rows, state.folder, state.partitions)
    return _commit(spark, name, base, _added(state, load, keys, days, gone))


def append_log(
    spark: SparkSession,
    name: str,
    batch: DataFrame,
    schema: T.StructType,
    base: str,
    once: Sequence[str] = (),
) -> DataFrame:
    """Append a whole batch to a declared log table; see ``append_aligned`` for ``once``."""
    ensure_table(spark, name, schema, base)
    return append_aligned(spark, name, batch, base, once)


def upsert_table(
    spark: SparkSession,
    name: str,
    stage: DataFrame,
    keys: Sequence[str],
    base: str,
    newest_first: Sequence[str] = (),
) -> DataFrame:
    """Replace the staged keys of a table; rows of other keys stay as they are."""
    if not table_exists(spark, name, base):
        raise ValueError(f"no table {name!r} to upsert into")
    return replace_table(spark, name, upserted(spark.table(name), stage, keys, newest_first), base)


def replace_days(
    spark: SparkSession, name: str, df: DataFrame, base: str, day: str, by_day: bool = False
) -> DataFrame:
    """Replace the days that ``df`` holds in a table partitioned by ``day``; other days stay.

    ``df`` may read the table; rows without a day are a day of their own. A first call creates the table.
    ``by_day``: a task has few days, as the rows come from files that lie by day or are of ``few_days``; they
    aren't shuffled.
    """
    state = _state(spark, name, base)
    if state is None:
        return replace_table(spark, name, df if by_day else df.hint("rebalance", day), base, [day])
    if state.partitions != [day]:
        raise ValueError(f"table {name!r} is not partitioned by {day!r}")
    rows = align_to(df, state.columns)
    rows = rows if by_day else rows.hint("rebalance", day)
    load, days = _write_load(spark, _root(base, name), rows, state.folder, [day])
    kept = {d: loads for d, loads in state.days.items() if d not in days}
    standing = {x for loads in kept.values() for x in loads}
    loads = {x: k for x, k in state.loads.items() if x in standing}
    state = replace(state, loads=loads, days=kept)
    return _commit(spark, name, base, _added(state, load, None, days, []))


def few_days(days: Sequence) -> bool:
    """Whether rows of these days are written as they come: each task writes a file a day, ``FEW_DAYS`` at most.

    Rows of more days are dealt by day first, which shuffles all of them.
    """
    return len(days) <= FEW_DAYS


def held_days(spark: SparkSession, name: str, base: str) -> list[str]:
    """The values that a table by one column holds, as text; from the log alone."""
    state = _state(spark, name, base)
    return list(state.days) if state else []


def newest_days(spark: SparkSession, name: str, base: str) -> list[str]:
    """The values that the last load of a table by one column holds, as text; from the log alone."""
    state = _state(spark, name, base)
    if state is None or not state.loads:
        return []
    last = list(state.loads)[-1]
    return [day for day, loads in state.days.items() if last in loads]


def drop_old_versions(spark: SparkSession, name: str, base: str, keep: int = 2) -> int:
    """Delete what none of the last ``keep`` states counts; readers of older ones, and writers, must have ended."""
    root = _root(base, name)
    states = _states(spark, name, base, max(keep, 1))
    counted: dict[str, set[str]] = {}
    for state in states:
        counted.setdefault(state.folder, set()).update(f"_load={x}" for x in state.loads)
    old = []
    for folder in _names(spark, root):
        if folder in counted:
            old += [f"{folder}/{x}" for x in _names(spark, f"{root}/{folder}") if x.startswith("_load=") and x not in counted[folder]]
        elif folder != "log":
            old.append(folder)
    gone = 0
    for path in old:
        files, found = _file_system(spark, f"{root}/{path}")
        gone += bool(files.delete(found, True))
    least = min((s.version for s in states), default=0)
    for file in _names(spark, f"{root}/log"):
        if file.split(".")[0].isdigit() and int(file.split(".")[0]) < least:
            files, found = _file_system(spark, f"{root}/log/{file}")
            files.delete(found, False)
    return gone


def overwrite_days(df: DataFrame, path: str, day: str) -> None:
    """Write by day, replacing only the days present in ``df``.

    The rebalance hint lets AQE cut a large day into several files and pack small ones together.
    """
    (
        df.hint("rebalance", day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def create_view(spark: SparkSession, name: str, query: str) -> DataFrame:
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    return spark.table(name)


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def days_in(df: DataFrame, day: str) -> list:
    """The distinct known days of a frame, in order: a calendar's worth of values."""
    return [r[0] for r in df.select(F.col(day).cast("date")).distinct().dropna().sort(day).collect()]
