"""Missing-value profile (A1-A3) and the ordered missing-value policy.

Policy, for each column in frame order: ratio = missing / rows still left;
``10 * missing >= 3 * rows`` drops the column, otherwise the rows with a
missing value are dropped, and later columns see fewer rows. For a string
column "missing" in the ratio means the text ``NA``; its row filter
``col != 'NA'`` removes null as well (T5). For other columns missing is null.

Fit takes two aggregations, whatever the number of columns. The profile
(missing values of each column over all rows) bounds the rows that earlier
columns may have removed, and that settles nearly every column. The others
stay open: the second aggregation counts rows by the first settled column
that removes them and by their statuses (0 present, 1 null, 2 NA) in the open
columns, and the ordered rule is replayed exactly on these few counts. Should
more than ``MAX_OPEN`` columns be open, the rows that are left go through both
aggregations again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns that one round may leave open; its counts are at most
#: 2 * 3^MAX_OPEN for each column.
MAX_OPEN = 5

DROP_COLUMN = "drop_column"
DROP_ROWS = "drop_rows"


class PolicyError(ValueError):
    pass


def _is_string(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.StringType)


def _status(df: DataFrame, c: str) -> Column:
    col = F.col(c)
    if _is_string(df, c):
        return F.when(col.isNull(), 1).when(col == "NA", 2).otherwise(0).cast("tinyint")
    return F.when(col.isNull(), 1).otherwise(0).cast("tinyint")


def _quote(name: str) -> str:
    return name.replace("\\", "\\\\").replace("'", "\\'")


def missing_profile(df: DataFrame, columns=None) -> DataFrame:
    """A1-A3 in one aggregate: per column its position, NA count (string
    columns only, T2), null count and row count; unpivoted with ``stack``."""
    columns = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(columns):
        na = F.count_if(F.col(c) == "NA") if _is_string(df, c) else F.lit(0).cast("bigint")
        aggs += [na.alias(f"__na{i}"), F.count_if(F.col(c).isNull()).alias(f"__nl{i}")]
    wide = df.agg(*aggs)
    parts = ", ".join(f"{i}, '{_quote(c)}', __na{i}, __nl{i}" for i, c in enumerate(columns))
    return wide.selectExpr(
        f"stack({len(columns)}, {parts}) AS (position, column_name, na_count, null_count)",
        "__rows AS row_count")


@dataclass(frozen=True)
class Decision:
    position: int
    column_name: str
    rows_seen: int
    missing: int
    action: str


@dataclass(frozen=True)
class MissingPolicy:
    """Fitted policy: the per-column decisions, applied as one drop and one
    filter."""
    decisions: tuple[Decision, ...]
    string_columns: frozenset
    rows_left: int

    @property
    def dropped(self) -> list[str]:
        return [d.column_name for d in self.decisions if d.action == DROP_COLUMN]

    def transform(self, df: DataFrame) -> DataFrame:
        return _without_missing(df, self.decisions, self.string_columns).drop(
            *[c for c in self.dropped if c in df.columns])

    def decisions_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(d.position, d.column_name, d.rows_seen, d.missing, d.action) for d in self.decisions],
            "position int, column_name string, rows_seen long, missing long, action string")


def _decide(c, seen, missing, protected) -> str:
    # the reference compares a float ratio with 0.3; a zero-row frame gives NaN,
    # which is never >= 0.3, so rows are "dropped" instead of the column
    if seen > 0 and 10 * missing >= 3 * seen:
        if c in protected:
            raise PolicyError(
                f"column {c!r} is {missing}/{seen} missing; it may not be dropped")
        return DROP_COLUMN
    return DROP_ROWS


def _without_missing(df: DataFrame, decisions, strings) -> DataFrame:
    """The rows that the decisions leave, with all columns."""
    for d in decisions:
        if d.action == DROP_ROWS and d.column_name in df.columns:
            col = F.col(d.column_name)
            df = df.filter((col != "NA") if d.column_name in strings else col.isNotNull())
    return df


def settled(profile: list[Row], strings) -> list[str | None]:
    """What the profile alone decides for each column; None where it depends
    on which rows earlier columns remove.

    At most ``removed`` rows are gone before a column. Each of them lowers the
    missing values by one at most, so the ratio is least if all of them were
    missing here, and largest if none was."""
    out, removed = [], 0
    for r in profile:
        rows = r["row_count"]
        missing = r["na_count"] if r["column_name"] in strings else r["null_count"]
        if missing == 0 or 10 * missing < 3 * (rows - removed):
            out.append(DROP_ROWS)
        elif rows > removed and 10 * (missing - removed) >= 3 * (rows - removed):
            out.append(DROP_COLUMN)
        else:
            out.append(None)
        if out[-1] != DROP_COLUMN:
            removed = min(rows, removed + r["na_count"] + r["null_count"])
    return out


def _counted(df: DataFrame, columns, strings, actions) -> list[Row]:
    """Rows by the first settled column that removes them (``first``, with the
    status there) and their statuses in the open columns; for each settled
    drop, its missing values in rows that are left there."""
    status = [_status(df, c) for c in columns]
    removing = [i for i, a in enumerate(actions) if a == DROP_ROWS]
    first = F.coalesce(*[F.when(status[i] != 0, i) for i in removing], F.lit(len(columns)))
    at_first = F.coalesce(*[F.when(status[i] != 0, status[i]) for i in removing], F.lit(0))
    opened = [status[i].alias(f"s{i}") for i, a in enumerate(actions) if a is None]
    drops = [(i, 2 if columns[i] in strings else 1) for i, a in enumerate(actions) if a == DROP_COLUMN]
    rows = df.select(first.alias("first"), at_first.alias("at_first"), *opened,
                     *[(status[i] == bad).alias(f"m{i}") for i, bad in drops])
    keys = ["first", "at_first", *[f"s{i}" for i, a in enumerate(actions) if a is None]]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[
        F.count_if(F.col(f"m{i}") & (F.col("first") > i)).alias(f"m{i}") for i, _ in drops]).collect()


def _replayed(counts: list[Row], columns, strings, actions, at: int, protected) -> tuple[list[Decision], int]:
    """The ordered rule on the counts: decisions (positions from ``at``) and
    the rows they leave."""
    decisions = []
    for i, c in enumerate(columns):
        bad = 2 if c in strings else 1
        here = [r for r in counts if r["first"] >= i]
        seen = sum(r["n"] for r in here)
        if actions[i] == DROP_ROWS:
            missing = sum(r["n"] for r in here if r["first"] == i and r["at_first"] == bad)
        elif actions[i] == DROP_COLUMN:
            missing = sum(r[f"m{i}"] for r in here)
        else:
            missing = sum(r["n"] for r in here if r[f"s{i}"] == bad)
        action = _decide(c, seen, missing, protected)
        if actions[i] is None and action == DROP_ROWS:
            counts = [r for r in counts if r[f"s{i}"] == 0]
        decisions.append(Decision(at + i, c, seen, missing, action))
    return decisions, sum(r["n"] for r in counts if r["first"] == len(columns))


def fit_missing_policy(df: DataFrame, columns=None, protected=()) -> MissingPolicy:
    """``df`` is read twice (more often only beyond ``MAX_OPEN``), so it should
    be a table or a frame that is cheap to read."""
    columns = list(columns or df.columns)
    strings = frozenset(c for c in columns if _is_string(df, c))
    decisions: list[Decision] = []
    left = None
    while len(decisions) < len(columns):
        rest = columns[len(decisions):]
        actions = settled(sorted(missing_profile(df, rest).collect(), key=lambda r: r["position"]), strings)
        opened = [i for i, a in enumerate(actions) if a is None]
        # an open column has others before it, so every round gets further
        end = opened[MAX_OPEN] if len(opened) > MAX_OPEN else len(rest)
        rest, actions = rest[:end], actions[:end]
        counts = _counted(df, rest, strings, actions)
        more, left = _replayed(counts, rest, strings, actions, len(decisions), protected)
        decisions += more
        df = _without_missing(df, more, strings)
    if left is None:
        left = df.count()
    elif left == 0:
        raise PolicyError("the missing-value policy leaves no rows")
    return MissingPolicy(tuple(decisions), strings, left)
