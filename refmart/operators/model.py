"""Relationships of a model and how filters travel along them (inventory JOI10).

A relationship leads from a table's column to a key of another one. A filter on the key's
side reduces the other side; with ``both`` it travels the other way, too (one-to-one and
both-direction relationships). A filtered table reduces its neighbours, these theirs, and
so on: each step is a semi-join on the neighbour's keys. What a table sends to a neighbour
leaves out what came from there, so on a graph without ambiguous paths (checked) the
passes end, and every table holds exactly the rows that all filters together leave.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Relationship:
    """``table.column`` -> ``to.key``; ``both``: filters travel both ways."""
    table: str
    column: str
    to: str
    key: str
    both: bool = False


class Model:
    def __init__(self, tables: dict[str, DataFrame], relationships: list[Relationship]):
        self.tables = tables
        # neighbours[a]: (b, column of b, column of a) for every b whose filters reach a
        self.neighbours: dict[str, list[tuple[str, str, str]]] = {t: [] for t in tables}
        for r in relationships:
            self.neighbours[r.table].append((r.to, r.key, r.column))
            if r.both:
                self.neighbours[r.to].append((r.table, r.column, r.key))
        for t in tables:
            self._check_paths(t)

    def _check_paths(self, start: str) -> None:
        """A filter may reach a table along one path only."""
        seen, todo = {start}, [(start, None)]
        while todo:
            at, came = todo.pop()
            for t, near in self.neighbours.items():
                for source, _, _ in near:
                    if source == at and t != came:
                        if t in seen:
                            raise ValueError(f"filters of {start} reach {t} along more than one path")
                        seen.add(t)
                        todo.append((t, at))

    def filtered(self, filters: dict[str, Column]) -> dict[str, DataFrame]:
        """Every table with the rows that its own and all arriving filters leave."""
        return {t: self._reduced(t, None, filters)[0] for t in self.tables}

    def _reduced(self, table: str, leave_out: str | None, filters: dict[str, Column]) -> tuple[DataFrame, bool]:
        """The table under its own filter and what arrives from all neighbours but one; whether
        anything reduced it."""
        df, touched = self.tables[table], table in filters
        if touched:
            df = df.where(filters[table])
        for source, their, mine in self.neighbours[table]:
            if source == leave_out:
                continue
            sent, reduced = self._reduced(source, table, filters)
            if reduced:
                keys = sent.select(F.col(their).alias("__key")).distinct()
                df = df.join(keys, df[mine] == keys["__key"], "left_semi")
                touched = True
        return df, touched
