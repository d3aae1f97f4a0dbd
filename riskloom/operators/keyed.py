"""Per-key tables and how their columns get back onto the rows.

Many keys are looked at together: one scan unpivots them into (name, key) rows, one shuffle
aggregates all of them, and the small result is written once. Its measured size then decides how a
key's columns are attached:

* the smallest tables are broadcast, as long as their measured bytes fit a budget for all of them together, so the
  wide table is not shuffled for them at all;
* every other key takes a narrow detour of its own (id, key): look-up on the key, back together on
  the id, a join with the wide table. Keys that own more than ``TASK_ROWS`` rows are looked up by broadcast, so no
  task receives a hot key's rows. Where over ``MOST_HOT`` keys of a name could own so many, the bar rises with the
  rows, so that a name never has more than ``MOST_HOT`` keys in a broadcast.

Both kinds are left joins with one row per key or id, which the plan shows, so that a look-up none of whose columns are
asked for is not run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.session import written

ROW_ID = "TransactionID"
BYTES_PER_ROW = 100
#: Rows of one key that a task may receive, and keys of a name that may be broadcast because they own more.
TASK_ROWS, MOST_HOT = 1_000_000, 10_000
#: Tables of the session's broadcast limit that may be broadcast together.
BUDGET_TABLES = 8
#: Bytes of a looked-up row besides its key, and of each of its other columns.
_ROW_BYTES, _CELL_BYTES = 56, 8

_budgets: list[list[int]] = []
#: The lean rows of each open ``broadcast_budget`` block, the innermost last.
_lean: list[DataFrame | None] = []


def key_rows(df: DataFrame, keys: Mapping[str, Column], keep: Sequence[str] = (), kind: str = "string") -> DataFrame:
    """Long form (keep..., name, key) of all key columns; rows with a missing key are left out."""
    entries = F.array(*[F.struct(F.lit(n).alias("name"), c.cast(kind).alias("key")) for n, c in keys.items()])
    return df.select(*keep, F.inline(entries)).where(F.col("key").isNotNull())


def columns_as_keys(df: DataFrame, names: Sequence[str]) -> dict[str, Column]:
    return {n: F.col(f"`{n}`") for n in names if n in df.columns}


def broadcast_bytes(df: DataFrame) -> int:
    """The session's broadcast limit for one table."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    text = text.lower().rstrip("b")
    size = int(text[:-1]) * units[text[-1]] if text and text[-1] in units else int(text or 0)
    return max(size, 0)


def broadcast_rows(df: DataFrame) -> int:
    """Rows of ordinary width that fit the session's broadcast limit."""
    return broadcast_bytes(df) // BYTES_PER_ROW


@contextmanager
def broadcast_budget(df: DataFrame, lean: DataFrame | None = None) -> Iterator[None]:
    """Let all look-ups of the block share one budget of broadcast bytes; by default each call has its own.

    ``lean`` has the rows that the block attaches features to, with their ids and keys: detours start from there, where
    nothing has been attached yet.
    """
    _budgets.append([BUDGET_TABLES * broadcast_bytes(df)])
    _lean.append(lean)
    try:
        yield
    finally:
        _budgets.pop()
        _lean.pop()


def hot_bar(rows: int) -> int:
    """Rows of a key above which it is hot, in a table of so many rows: at most ``MOST_HOT`` keys own more."""
    return max(TASK_ROWS, -(-rows // MOST_HOT))


@dataclass(frozen=True)
class KeyTable:
    """A written (name, key, n, ...) table with the number of keys and rows, the bytes and the most rows of a key, per name.

    ``little`` is a table of the names that may be broadcast, so that their look-ups need not read the others.
    """

    table: DataFrame
    sizes: dict[str, tuple[int, int]]
    bytes: dict[str, int]
    most: dict[str, int]
    little: DataFrame


def key_table(table: DataFrame) -> KeyTable:
    """Write a (name, key, n, ...) table, n = rows that have the key, and measure it."""
    fixed = written(table)
    lists = [F.coalesce(F.size(f.name), F.lit(0)) * _CELL_BYTES for f in fixed.schema if isinstance(f.dataType, T.ArrayType)]
    measured = fixed.groupBy("name").agg(
        F.count("*").alias("k"), F.sum("n").alias("n"), F.max("n").alias("m"),
        F.sum(sum(lists, F.octet_length(F.col("key").cast("string")))).alias("b")).collect()
    width = _ROW_BYTES + _CELL_BYTES * (len(fixed.columns) - 2)
    size = {r["name"]: r["k"] * width + (r["b"] or 0) for r in measured}
    few = [n for n, b in size.items() if b <= broadcast_bytes(fixed)]
    little = written(fixed.where(F.col("name").isin(few))) if 0 < len(few) < len(size) else fixed
    return KeyTable(fixed, {r["name"]: (r["k"], r["n"]) for r in measured}, size, {r["name"]: r["m"] for r in measured}, little)


def _small(df: DataFrame, table: KeyTable, wanted: Sequence[str], small_rows: int | None) -> list[str]:
    """The names whose tables are broadcast: the smallest ones, while they fit the budget."""
    if small_rows is not None:
        return [n for n in wanted if table.sizes.get(n, (0, 0))[0] <= small_rows]
    limit = broadcast_bytes(df)
    budget, chosen = _budgets[-1] if _budgets else [BUDGET_TABLES * limit], set()
    for n in sorted(wanted, key=lambda n: table.bytes.get(n, 0)):
        size = table.bytes.get(n, 0)
        if size > min(limit, budget[0]):
            break
        budget[0] -= size
        chosen.add(n)
    return [n for n in wanted if n in chosen]


def attach(df: DataFrame, keys: Mapping[str, Column], table: KeyTable, outputs: Mapping[str, Mapping[str, str]],
           row_id: str = ROW_ID, kind: str = "string", small_rows: int | None = None,
           told: Mapping[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """Add columns of a key table to ``df``; rows whose key is missing or unknown get nulls.

    ``outputs``: name -> {new column: table column}. ``row_id`` must identify the rows of ``df``; a
    frame without it joins each large key on its own. ``told``: table column -> what a row with ``row_id`` reads from it.
    """
    wanted = [n for n in outputs if n in keys]
    small = _small(df, table, wanted, small_rows)
    large = [n for n in wanted if n not in small]
    out, told = df, told or {}
    for i, n in enumerate(wanted if row_id not in df.columns else small):
        columns = [F.col(c).alias(o) for o, c in outputs[n].items()]
        one = (table.little if table.bytes.get(n, 0) <= broadcast_bytes(df) else table.table).where(F.col("name") == n).select(
            F.col("key").alias(f"_k{i}"), *columns)
        # Keys are unique; said once more, for the plan.
        one = F.broadcast(one.dropDuplicates([f"_k{i}"])) if n in small else one
        out = out.join(one, keys[n].cast(kind) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
        read = {o: told[c](F.col(o)) for o, c in outputs[n].items() if c in told}
        out = out.withColumns(read) if read else out
    if row_id not in df.columns:
        return out
    for n in large:
        used = sorted(set(outputs[n].values()))
        lean = _lean[-1] if _lean else None
        start, key = (lean, F.col(f"`{n}`")) if lean is not None and {n, row_id} <= set(lean.columns) else (df, keys[n])
        rows = start.select(row_id, key.cast(kind).alias("key")).where(F.col("key").isNotNull())
        lookup, bar = table.table.where(F.col("name") == n), hot_bar(table.sizes[n][1])
        cold = lookup.where(F.col("n") <= bar).select("key", *used)
        if table.most[n] > bar:
            # At most MOST_HOT keys own more.
            hot = F.broadcast(lookup.where(F.col("n") > bar).select("key", *used))
            found = rows.join(hot, "key").unionByName(rows.join(F.broadcast(hot.select("key")), "key", "left_anti").join(cold, "key"))
        else:
            found = rows.join(cold, "key")
        found = found.withColumns({c: read(F.col(c)) for c, read in told.items() if c in used})
        out = out.join(found.groupBy(row_id).agg(*[F.max(c).alias(o) for o, c in outputs[n].items()]), row_id, "left")
    return out


def join_totals(rows: DataFrame, totals: DataFrame, keys: Sequence[str], size: str) -> DataFrame:
    """Join per-group totals to the rows of their groups without gathering a large group in one task.

    ``size`` is the column of ``totals`` with the number of rows of the group. Groups with more rows than a task may
    receive, at most ``MOST_HOT`` of them, are broadcast; the others are shuffled.
    """
    keys = list(keys)
    bar = F.greatest(F.lit(TASK_ROWS), F.ceil(totals.agg(F.sum(size)).scalar() / MOST_HOT))
    marked = totals.withColumn("_bar", bar)
    hot = marked.where(F.col(size) > F.col("_bar")).drop("_bar", size)
    cold = marked.where(F.col(size) <= F.col("_bar")).drop("_bar", size)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(hot), keys).unionByName(rest.join(cold, keys))
