"""Rows that cannot be mapped, and what to do with them.

A rule names a reason and a condition.  The first rule that holds gives the row its reason; what happens next depends on
the reason alone, so it is decided per row inside the plan.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.plans.skew import stored

REASON = "reason"


def key_rules(key: str) -> dict[str, Column]:
    """A single row key must be set."""
    return {"null_row_key": F.col(key).isNull()}


def counter_rules(cells: DataFrame) -> dict[str, Column]:
    """Rules over mapped increments: key, counter name and amount must be set."""
    return {
        "null_row_key": F.col("row_key").isNull(),
        "null_counter_column": F.col("column_name").isNull(),
        "null_amount": F.col("amount").isNull(),
    }


def keyspace_rules(keyspaces: list[str]) -> dict[str, Column]:
    """The keyspace must be known; names are compared in lower case."""
    known = [k.lower() for k in keyspaces]
    return {"unknown_keyspace": ~F.coalesce(F.lower("keyspace").isin(known), F.lit(False))}


def with_reason(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add the reason a row cannot be used; null for a good row."""
    reasons = [F.when(F.coalesce(broken, F.lit(False)), F.lit(reason)) for reason, broken in rules.items()]
    return df.withColumn(REASON, F.coalesce(*reasons, F.lit(None).cast("string")))


def split_rejects(df: DataFrame, rules: Mapping[str, Column], write_once: bool = False) -> tuple[DataFrame, DataFrame]:
    """The good rows, and the rejected ones with their reason.

    Each of the two reads the input; with ``write_once`` the marked rows are written to the shared folder and divided
    there, so an input that is costly to compute is computed once.
    """
    marked = with_reason(df, rules)
    marked = stored(marked) if write_once else marked
    return marked.where(F.col(REASON).isNull()).drop(REASON), marked.where(F.col(REASON).isNotNull())


FAIL, REJECT, IGNORE, EMPTY = "fail", "reject", "ignore", "empty"


@dataclass(frozen=True)
class ErrorPolicy:
    """What happens to a row, by its reason.

    ``fail`` stops the job, and a stream replays its batch after a restart; ``reject`` hands the row to the caller;
    ``ignore`` drops it; ``empty`` lets it pass with empty results.  Only the exact reason counts; unnamed reasons take
    ``default``.
    """

    actions: Mapping[str, str] = field(default_factory=dict)
    default: str = IGNORE

    def __post_init__(self):
        for action in (*self.actions.values(), self.default):
            if action not in (FAIL, REJECT, IGNORE, EMPTY):
                raise ValueError(f"unknown action {action!r}")

    def _on(self, action: str, *reasons: str) -> ErrorPolicy:
        for r in reasons:
            if self.actions.get(r, action) != action:
                raise ValueError(f"reason {r!r} has already been given the action {self.actions[r]!r}")
        return ErrorPolicy({**self.actions, **dict.fromkeys(reasons, action)}, self.default)

    def fail_on(self, *reasons: str) -> ErrorPolicy:
        return self._on(FAIL, *reasons)

    def reject_on(self, *reasons: str) -> ErrorPolicy:
        return self._on(REJECT, *reasons)

    def ignore_on(self, *reasons: str) -> ErrorPolicy:
        return self._on(IGNORE, *reasons)

    def empty_on(self, *reasons: str) -> ErrorPolicy:
        return self._on(EMPTY, *reasons)

    def with_default(self, action: str) -> ErrorPolicy:
        return ErrorPolicy(self.actions, action)

    def action(self) -> Column:
        """The action for the ``reason`` of a row, as a column; null for a good row."""
        chosen = F.lit(self.default)
        for reason, action in self.actions.items():
            chosen = F.when(F.col(REASON) == reason, F.lit(action)).otherwise(chosen)
        return F.when(F.col(REASON).isNotNull(), chosen)

    def apply(self, df: DataFrame, rules: Mapping[str, Column], write_once: bool = False) -> dict[str, DataFrame]:
        """The rows to go on with (``good``), to report (``reject``) and to pass with empty results (``empty``).

        A row whose action is ``fail`` raises as soon as any of the three is computed.  ``write_once`` is that of
        ``split_rejects``.
        """
        marked = with_reason(df, rules).withColumn("__action", self.action())
        stop = F.raise_error(F.concat(F.lit("row refused: "), F.col(REASON))).cast("string")
        marked = marked.withColumn("__action", F.when(F.col("__action") == FAIL, stop).otherwise(F.col("__action")))
        marked = stored(marked) if write_once else marked
        part = lambda test: marked.where(test).drop("__action")
        return {
            "good": part(F.col("__action").isNull()).drop(REASON),
            "reject": part(F.col("__action") == REJECT),
            "empty": part(F.col("__action") == EMPTY),
        }


def lookup_or_empty(requests: DataFrame, rules: Mapping[str, Column], policy: ErrorPolicy, lookup, outputs: list[str]):
    """Answer the good requests with ``lookup``; refused ones under ``empty`` come out once with empty strings."""
    parts = policy.apply(requests, rules)
    empty = parts["empty"].drop(REASON).select(*requests.columns, *[F.lit("").alias(o) for o in outputs])
    return lookup(parts["good"]).select(*requests.columns, *outputs).unionByName(empty)
