"""Write, audit, publish: key and reference checks between writing a load and switching to it.

A repeated primary key stops the load, as the target database would. Rows that refer to no row of
their parent go to a quarantine table with the load's folder and are counted; what is published is
the rest. Parents come first, so a row whose parent is quarantined is quarantined, too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starpipe.operators.audits import duplicate_keys, orphans
from starpipe.schemas import FOREIGN_KEYS, LOAD_ORDER

ForeignKey = tuple[str, str, str, str]


class DuplicateKeys(ValueError):
    """A primary key occurs more than once; ``report`` has the number of such values by table."""

    def __init__(self, report: dict[str, int]):
        self.report = report
        super().__init__(f"repeated primary keys: {report}")


@dataclass(frozen=True)
class Gate:
    """``unknown``: a key value that stands for "unknown" and needs no parent; none, if null.

    ``keys``: the references to enforce; by default those between loaded tables.
    """

    unknown: int | None = 0
    keys: tuple[ForeignKey, ...] = field(
        default=tuple(key for key in FOREIGN_KEYS if key[2] in LOAD_ORDER)
    )

    def check_keys(self, tables: Mapping[str, DataFrame]) -> None:
        """Raise ``DuplicateKeys`` if a table repeats a key; one partial aggregate per table."""
        rows = duplicate_keys(tables, tables).where("duplicadas > 0").collect()
        if rows:
            raise DuplicateKeys({row["tabla"]: row["duplicadas"] for row in rows})

    def references(self, table: str) -> list[ForeignKey]:
        return [key for key in self.keys if key[0] == table]

    def missing(self, df: DataFrame, parents: Mapping[str, DataFrame], table: str) -> DataFrame | None:
        """(columna, valor): the values of each reference without a parent; null if none is enforced.

        Values are counted per key before they meet the parent, so a hot key is one row.
        """
        found = [
            orphans(df, column, parents[parent], parent_column)
            .where(F.lit(True) if self.unknown is None else F.col("valor") != self.unknown)
            .select(F.lit(column).alias("columna"), "valor")
            for _, column, parent, parent_column in self.references(table)
            if parent in parents
        ]
        return None if not found else _union(found)

    def split(
        self, df: DataFrame, missing: DataFrame, table: str
    ) -> tuple[DataFrame, DataFrame]:
        """Rows that may be published, and the others with ``motivo``, the columns that refer to nothing."""
        columns = [column for _, column, _, _ in self.references(table)]
        marked = df
        for column in columns:
            values = missing.where(F.col("columna") == column).select(
                F.col("valor").alias(f"__valor_{column}"), F.lit(True).alias(f"__sin_{column}")
            )
            marked = marked.join(
                values, F.col(column).cast("bigint") == F.col(f"__valor_{column}"), "left"
            ).drop(f"__valor_{column}")
        wrong: Column = F.lit(False)
        for column in columns:
            wrong = wrong | F.coalesce(f"__sin_{column}", F.lit(False))
        reasons = F.concat_ws(",", *[F.when(F.col(f"__sin_{c}"), F.lit(c)) for c in columns])
        return (
            marked.where(~wrong).select(*df.columns),
            marked.where(wrong).select(*df.columns, reasons.alias("motivo")),
        )


def parents_first(names: Iterable[str], keys: Iterable[ForeignKey]) -> list[str]:
    """Tables in an order in which a reference's parent precedes its child."""
    names, keys = list(names), list(keys)
    order = sorted(names, key=lambda name: LOAD_ORDER.index(name) if name in LOAD_ORDER else -1)
    done: list[str] = []
    while order:
        ready = [n for n in order if not any(c == n and p in order and p != n for c, _, p, _ in keys)]
        if not ready:
            raise ValueError(f"references in a circle among {order}")
        done += ready
        order = [n for n in order if n not in ready]
    return done


def pass_gate(
    gate: Gate,
    written: Mapping[str, DataFrame],
    present: Mapping[str, DataFrame],
    store: Callable[[str, DataFrame, bool], DataFrame],
) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """The tables that may be published and the rows quarantined by table.

    ``written``: the load's tables as they lie in their unpublished folders; ``present``: rows that stay
    published beside them, of the same tables (an append) or of others. ``store`` writes a frame
    (table, frame, quarantined) and gives it back as read; a table without orphans isn't written again.
    """

    def all_rows(name: str) -> DataFrame:
        if name not in present:
            return result[name]
        return present[name].unionByName(result[name]) if name in result else present[name]

    result = dict(written)
    gate.check_keys({name: all_rows(name) for name in written})
    parents = {name: all_rows(name) for name in {*written, *present}}
    held: dict[str, int] = {}
    for name in parents_first(written, gate.keys):
        missing = gate.missing(result[name], parents, name)
        if missing is None or missing.isEmpty():
            continue
        good, bad = gate.split(result[name], missing, name)
        result[name] = store(name, good, False)
        parents[name] = all_rows(name)
        held[name] = store(name, bad, True).count()
    return result, held


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole

