"""Data-quality rules. All simple rules of a table are counted in one pass over it."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fleetpulse.sources.tables import per_folder


@dataclass(frozen=True)
class Rule:
    column: str
    kind: str
    low: float | None = None
    high: float | None = None
    values: tuple = ()

    @property
    def label(self) -> str:
        if self.kind == "between":
            return f"between({_bound(self.low)},{_bound(self.high)})"
        if self.kind == "accepted":
            return "accepted(" + ",".join(str(v) for v in self.values) + ")"
        return self.kind

    @property
    def violated(self) -> str:
        """SQL predicate of a bad row. A null only violates ``not_null``."""
        if self.kind == "not_null":
            return f"`{self.column}` IS NULL"
        if self.kind == "accepted":
            return f"`{self.column}` NOT IN ({', '.join(_quoted(v) for v in self.values)})"
        if self.kind == "between":
            bounds = (("<", self.low), (">", self.high))
            return " OR ".join(f"`{self.column}` {op} {bound}" for op, bound in bounds if bound is not None)
        raise ValueError(f"rule kind {self.kind!r} has no row predicate")


def _bound(value: float | None) -> str:
    return "" if value is None else f"{value:g}"


def _quoted(value: str) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def not_null(*columns: str) -> list[Rule]:
    return [Rule(c, "not_null") for c in columns]


def unique(*columns: str) -> list[Rule]:
    return [Rule(c, "unique") for c in columns]


def between(column: str, low: float | None = None, high: float | None = None) -> list[Rule]:
    return [Rule(column, "between", low, high)]


def accepted(column: str, *values: str) -> list[Rule]:
    return [Rule(column, "accepted", values=values)]


_LABELS = ("Bus", "Rail", "Other")

# The declared rules of every model.
RULES: dict[str, list[Rule]] = {
    "stg_vehicle_positions": not_null("event_id", "vehicle_id", "route_id", "event_ts") + unique("event_id")
    + between("latitude", -90, 90) + between("longitude", -180, 180),
    "stg_trip_updates": not_null("event_id", "trip_id", "route_id", "delay", "delay_minutes", "event_ts")
    + unique("event_id"),
    "stg_stall_events": not_null("stall_id", "vehicle_id", "reading_count") + unique("stall_id")
    + between("reading_count", 3) + between("stall_duration_s", 0),
    "stg_headway_metrics": not_null("route_id", "trip_count", "is_bunching") + between("trip_count", 1)
    + between("headway_mean_s", 0),
    "stg_gtfs_routes": not_null("route_id", "route_short_name", "route_type_label") + unique("route_id")
    + accepted("route_type_label", *_LABELS),
    "stg_gtfs_stops": not_null("stop_id", "stop_name", "stop_lat", "stop_lon") + unique("stop_id")
    + between("stop_lat", -48, -34) + between("stop_lon", 166, 179),
    "dim_routes": not_null("route_id", "route_name", "route_type_label") + unique("route_id")
    + accepted("route_type_label", *_LABELS),
    "dim_stops": not_null("stop_id", "stop_name", "stop_lat", "stop_lon") + unique("stop_id"),
    "fct_delay_alerts": not_null("event_id", "event_date", "route_id", "trip_id", "delay", "delay_minutes", "event_ts")
    + unique("event_id") + between("delay", 300, 86400) + accepted("route_type_label", *_LABELS),
    "fct_stall_incidents": not_null("stall_id", "event_date", "vehicle_id", "route_id", "detected_at")
    + unique("stall_id") + between("stall_duration_s", 0, 86400),
    "fct_delay_by_hour": not_null("event_date", "event_hour", "avg_delay_minutes", "trip_count")
    + between("event_hour", 0, 23),
    "fct_headway_regularity": not_null("route_id", "hour_bucket", "trip_count") + between("avg_headway_s", 0)
    + between("headway_cv", 0, 3) + between("bunching_pct", 0, 100),
}


def check(df: DataFrame, table: str, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Violations per rule: (table_name, column_name, rule, violations).

    All rules are counted in one pass. Uniqueness means values that occur more than once, so
    where it is asked for, everything is counted per value first, with copies folded before
    the one shuffle. A second unique column takes a pass of its own.
    """
    rules = RULES[table] if rules is None else list(rules)
    keys = [r for r in rules if r.kind == "unique"]
    simple = [r for r in rules if r.kind != "unique"]
    result = _report(table, df, simple, keys[0] if keys else None)
    for key in keys[1:]:
        result = result.unionByName(_report(table, df, [], key))
    return result


def _report(table: str, df: DataFrame, simple: Sequence[Rule], key: Rule | None) -> DataFrame:
    bad = {r: f"v{i}" for i, r in enumerate(simple)}
    counts = [F.expr(f"count_if({r.violated})").alias(name) for r, name in bad.items()]
    if key is None:
        totals = df.agg(*counts)
    else:
        per_value = df.groupBy(F.col(key.column).alias("value")).agg(F.count(F.lit(1)).alias("copies"), *counts)
        repeated = F.count_if(F.col("value").isNotNull() & (F.col("copies") > 1))
        # An empty table has no groups: its sums are null, its violations zero.
        sums = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in bad.values()]
        totals = per_value.agg(*sums, repeated.alias("repeated"))
        bad[key] = "repeated"
    return totals.selectExpr(_lines(table, bad))


def _lines(table: str, counts: dict[Rule, str]) -> str:
    lines = ", ".join(
        f"named_struct('table_name', {_quoted(table)}, 'column_name', {_quoted(r.column)}, "
        f"'rule', {_quoted(r.label)}, 'violations', {count})"
        for r, count in counts.items()
    )
    return f"inline(array({lines}))"


def write_checked(
    df: DataFrame, table: str, path: str, rules: Sequence[Rule] | None = None, fmt: str = "parquet", mode: str = "errorifexists",
    date_col: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Store a table and check it on the way: (the stored table, its report as of ``check``).

    Row rules are counted by the tasks that write, so they cost neither a pass nor a shuffle; a task that is run
    again counts once, as its files do. A unique rule then reads its one column of the stored table, copies folded
    before the one shuffle. ``mode`` "append" reports row rules of the rows added and unique rules of the whole
    table.
    """
    rules = RULES[table] if rules is None else list(rules)
    simple = {r: f"v{i}" for i, r in enumerate(r for r in rules if r.kind != "unique")}
    rows = per_folder(df, date_col) if date_col else df
    seen = Observation()
    if simple:
        # Above the shuffle that deals rows to folders: only tasks that end the job are counted once for sure.
        rows = rows.observe(seen, *[F.expr(f"count_if({r.violated})").alias(name) for r, name in simple.items()])
    writer = rows.write.format(fmt).mode(mode)
    (writer.partitionBy(date_col) if date_col else writer).save(path)
    spark = df.sparkSession
    stored = spark.read.format(fmt).load(path)
    parts = []
    if simple:
        found = seen.get
        parts.append(spark.range(1).selectExpr(_lines(table, {r: f"{int(found.get(name) or 0)}L" for r, name in simple.items()})))
    parts += [_report(table, stored, [], r) for r in rules if r.kind == "unique"]
    return stored, functools.reduce(DataFrame.unionByName, parts)


def profile(df: DataFrame, columns: Sequence[str], accuracy: int | None = 10_000) -> DataFrame:
    """Count, non-null count, mean, deviation, minimum, maximum and quartiles per numeric column, in one pass.

    Quartiles come from a mergeable sketch, a stored value with a rank off by ``1 / accuracy`` of the rows at most;
    with ``accuracy`` None they are exact, between two values where a quarter falls between them, which takes memory
    for all distinct values of a column.
    """
    def quartiles(c: str) -> Column:
        value, at = F.col(c).cast("double"), [0.25, 0.5, 0.75]
        return F.percentile(value, at) if accuracy is None else F.percentile_approx(value, at, accuracy)

    stats = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            f(F.col(c).cast("double")).alias(f"{c}__{n}")
            for c in columns
            for n, f in (("mean", F.avg), ("stddev", F.stddev_samp), ("min", F.min), ("max", F.max))
        ],
        *[F.count(c).alias(f"{c}__n") for c in columns],
        *[quartiles(c).alias(f"{c}__q") for c in columns],
    )
    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("rows").alias("row_count"),
            F.col(f"{c}__n").alias("non_null"),
            *[F.col(f"{c}__{n}").alias(n) for n in ("mean", "stddev", "min", "max")],
            *[F.get(F.col(f"{c}__q"), F.lit(i)).alias(q) for i, q in enumerate(("p25", "p50", "p75"))],
        )
        for c in columns
    ]
    return stats.select(F.inline(F.array(*lines)))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counted = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
               for name, df in tables.items()]
    result = counted[0]
    for part in counted[1:]:
        result = result.unionByName(part)
    return result
