"""A table's profile kept up to date by reading only what a run has written.

A committed directory never changes, so its figures are measured once and kept as one row of mergeable state: rows,
present values, smallest and largest value, mean and summed squares around it, and a sketch of the distinct
values. The profile of a table is the merge of the rows of its current directories.

Distinct values do not add up over directories, so for most columns they come from the merged sketch (approximate). For a column
named in `keys` they are counted exactly in each directory and added: right where equal values never stand in two directories, as
holds for the key of a table that only `upsert` and `overwrite` change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stateloom.functions.keys import quoted
from stateloom.sinks.tables import TableStore

SKETCH_BITS = 14  # of the distinct sketch: 0.8 % standard error, 16 KB at the most
_DIR = "__dir"


def is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


class RunningProfile:
    """Profile of `columns` of `table`, with its state in `state`."""

    def __init__(self, table: TableStore, state: TableStore, columns: Sequence[str], keys: Sequence[str] = ()) -> None:
        self.table = table
        self.state = state
        self.columns = list(dict.fromkeys([*columns, *keys]))
        self.keys = set(keys)

    def refresh(self, run_id: str) -> DataFrame:
        """Measure the directories that have no state yet, forget those that are gone, and return the profile (one row)."""
        spark, commit = self.table.spark, self.table.current()
        if commit is None:
            raise FileNotFoundError(f"no table at {self.table.path}")
        current = spark.createDataFrame([(d,) for _, d in commit.dirs], f"{_DIR} string")
        known = self.state.read_or_none()
        if known is not None and known.columns != self.state_columns(commit.schema):
            known = None  # the state is of other columns
        kept = None if known is None else known.join(current, _DIR, "left_semi")
        measured = set() if kept is None else {r[0] for r in kept.select(_DIR).collect()}  # one short entry per directory
        new = [d for _, d in commit.dirs if d not in measured]
        rows = self.measure(self.table._frame(commit.schema, new)) if new else None
        parts = [r for r in (kept, rows) if r is not None]
        if rows is not None or known is None or known.count() != len(measured):
            if not parts:
                parts = [self.measure(spark.createDataFrame([], commit.schema), empty=True)]
            self.state.overwrite(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]), run_id)
        return self.merged(self.state.read(), commit.schema)

    def state_columns(self, schema: T.StructType) -> list[str]:
        names = [_DIR, "rows"]
        for c in self.columns:
            names += [f"{c}_present", f"{c}_low", f"{c}_high"]
            names += [f"{c}_mean", f"{c}_m2"] if is_number(schema[c].dataType) else []
            names += [f"{c}_distinct"] if c in self.keys else [f"{c}_sketch"]
        return names

    def measure(self, rows: DataFrame, empty: bool = False) -> DataFrame:
        """One row of state per directory, in one pass over them."""
        figures: list[Column] = [F.count(F.lit(1)).alias("rows")]
        for name in self.columns:
            kind, column = rows.schema[name].dataType, F.col(quoted(name))
            present = F.count(column)
            figures += [present.alias(f"{name}_present"), F.min(column).alias(f"{name}_low"), F.max(column).alias(f"{name}_high")]
            if is_number(kind):
                value = column.cast("double")
                figures += [F.avg(value).alias(f"{name}_mean"), (F.var_pop(value) * present).alias(f"{name}_m2")]
            if name in self.keys:
                figures.append(F.count_distinct(column).alias(f"{name}_distinct"))
            else:
                figures.append(F.hll_sketch_agg(column.cast("string"), F.lit(SKETCH_BITS)).alias(f"{name}_sketch"))
        if empty:
            return rows.withColumn(_DIR, F.lit("")).groupBy(_DIR).agg(*figures)
        folder = F.regexp_extract(F.col("_metadata.file_path"), r"/(data/[^/]+/[^/]+/[^/]+)/[^/]+$", 1)
        return rows.withColumn(_DIR, F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))).groupBy(_DIR).agg(*figures)

    def merged(self, states: DataFrame, schema: T.StructType) -> DataFrame:
        """The profile: total_rows, and of each column its complete rows, min, max, mean, sample deviation and distinct values."""
        out: list[Column] = [F.coalesce(F.sum("rows"), F.lit(0).cast("bigint")).alias("total_rows")]
        for name in self.columns:
            present = F.col(quoted(f"{name}_present"))
            out.append(F.coalesce(F.sum(present), F.lit(0).cast("bigint")).alias(f"{name}_complete"))
            out += [F.min(quoted(f"{name}_low")).alias(f"min_{name}"), F.max(quoted(f"{name}_high")).alias(f"max_{name}")]
            if is_number(schema[name].dataType):
                mean, count = F.col(quoted(f"{name}_mean")), F.sum(present)
                total = F.sum(present * mean) / F.nullif(count, F.lit(0))
                # squares around the common mean: those around each mean, and of the means around the common one
                whole = states.agg(total.alias("mean")).scalar()
                spread = F.sum(F.col(quoted(f"{name}_m2")) + present * (mean - whole) * (mean - whole))
                out += [total.alias(f"avg_{name}"), F.when(count > 1, F.sqrt(spread / (count - 1))).alias(f"{name}_stddev")]
            if name in self.keys:
                out.append(F.coalesce(F.sum(quoted(f"{name}_distinct")), F.lit(0).cast("bigint")).alias(f"unique_{name}"))
            else:
                out.append(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(quoted(f"{name}_sketch"))), F.lit(0).cast("bigint")).alias(f"about_unique_{name}"))
        return states.agg(*out)
