"""Incremental upkeep of aggregates over joins.

A model that joins several sources and groups by a key can be kept current at the
cost of what changed. :class:`JoinAggregate` says how the sources hang together;
from the changed rows of any source the touched keys are derived along the joins,
each source is cut to the rows of these keys by semi joins, the model runs over
that part alone, and the target's groups of these keys are replaced::

    spec = JoinAggregate(
        keys={"customer": ["c_custkey"], "orders": ["o_custkey"]},
        links={"lineitem": ("orders", [("l_orderkey", "o_orderkey")])},
        key=["id"], model=lambda s: customer_insight(s["customer"], s["orders"], s["lineitem"]))
    next_version = spec.refresh(target, sources, {"lineitem": late_lines})

A changed row is any row that came, went or has another value: of an update both
images are given, so that a key which lost its row is touched as well. A touched
group without rows left is removed. Groups whose key is NULL are kept current like
others; link columns match as the model's joins do, so NULL links to nothing.

At scale: the touched keys are distinct and small against the sources; every source
is read once for the touched part, through semi joins that shuffle on the join keys
only (or broadcast the keys where Spark measures them small, with run-time filters on
the scan). Nothing grows with the untouched groups but the target's own copy, and
that is as small as the partitions touched with ``partition_scoped`` targets.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Sources = Mapping[str, DataFrame]


@dataclass
class JoinAggregate:
    """``keys``: the columns of a source that are the group key, in the order of ``key``; a source without
    them is in ``links`` with the source it is joined to and the (own, other) columns of that join.
    ``model`` maps the sources to the aggregate, whose group columns are ``key``; it must be a function
    of each group's own rows (no ranks or shares across groups)."""

    keys: Mapping[str, Sequence[str]]
    key: Sequence[str]
    model: Callable[[Sources], DataFrame]
    links: Mapping[str, tuple[str, Sequence[tuple[str, str]]]] = field(default_factory=dict)

    def __post_init__(self):
        both = set(self.keys) & set(self.links)
        if both or not self.keys:
            raise ValueError(f"each source has either keys or a link, and one has keys; both: {sorted(both)}")
        for name in self.keys:
            if len(self.keys[name]) != len(self.key):
                raise ValueError(f"{name}: {len(self.keys[name])} key columns, the model has {len(self.key)}")
        for name in self.links:
            self._way(name)

    def _way(self, name: str) -> list[str]:
        """The sources from ``name`` along the links to one with keys."""
        way = [name]
        while way[-1] not in self.keys:
            after = self.links.get(way[-1], (None,))[0]
            if after is None or after in way:
                raise ValueError(f"{name}: no link leads to a source with keys")
            way.append(after)
        return way

    def touched_keys(self, sources: Sources, changes: Sources) -> DataFrame:
        """The distinct group keys of the changed rows of any source."""
        unknown = set(changes) - set(self.keys) - set(self.links)
        if unknown or not changes:
            raise ValueError(f"changes of unknown sources: {sorted(unknown)}" if unknown else "no changes given")
        found = None
        for name, rows in changes.items():
            way = self._way(name)
            for here, after in zip(way, way[1:], strict=False):
                pairs = self.links[here][1]
                # Of rows on either side, those before and after the change count.
                there = sources[after] if after not in changes else sources[after].unionByName(changes[after].select(*sources[after].columns))
                rows = _matching(there, rows.select(*[F.col(a).alias(b) for a, b in pairs]), [b for _, b in pairs])
            part = rows.select(*[F.col(c).alias(k) for c, k in zip(self.keys[way[-1]], self.key, strict=True)])
            found = part if found is None else found.unionByName(part)
        return found.distinct()

    def touched_part(self, sources: Sources, keys: DataFrame) -> dict[str, DataFrame]:
        """The rows of each source that belong to the groups of ``keys``."""
        part: dict[str, DataFrame] = {}

        def cut(name: str) -> DataFrame:
            if name not in part:
                if name in self.keys:
                    own = self.keys[name]
                    part[name] = _matching(sources[name], keys.select(*[F.col(k).alias(c) for c, k in zip(own, self.key, strict=True)]), own, null_safe=True)
                else:
                    after, pairs = self.links[name]
                    part[name] = _matching(sources[name], cut(after).select(*[F.col(b).alias(a) for a, b in pairs]), [a for a, _ in pairs])
            return part[name]

        return {name: cut(name) for name in sources}

    def refresh(self, target: DataFrame | None, sources: Sources, changes: Sources | None) -> DataFrame:
        """The target's next version; without a target or changes the whole model."""
        if target is None or changes is None:
            return self.model(sources)
        keys = self.touched_keys(sources, changes)
        fresh = self.model(self.touched_part(sources, keys))
        kept = _matching(target, keys, list(self.key), null_safe=True, how="left_anti")
        return kept.unionByName(fresh.select(*target.columns))


def _matching(rows: DataFrame, other: DataFrame, columns: Sequence[str], null_safe: bool = False, how: str = "left_semi") -> DataFrame:
    """Rows whose ``columns`` occur in ``other`` (or do not, with ``left_anti``)."""
    named = other.select(*[F.col(c).alias(f"__{i}") for i, c in enumerate(columns)])
    cond = None
    for i, c in enumerate(columns):
        same = F.col(c).eqNullSafe(F.col(f"__{i}")) if null_safe else F.col(c) == F.col(f"__{i}")
        cond = same if cond is None else cond & same
    return rows.join(named.distinct(), cond, how)
