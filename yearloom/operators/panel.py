"""Indicators per entity and period, and the master table built from them.

Each fact is reduced to sums and counts per (entity, period) in one pass over its
rows.  Everything else (yearly values, entity-wide values, the spine, gap filling)
is computed from those small states, so no fact is read twice and no row-level
data is joined.  Partial aggregation makes the size of a single group harmless.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yearloom.functions import safe_double
from yearloom.operators.joins import ROWS, size_checked_join
from yearloom.operators.reconcile import matched, reconcile
from yearloom.session import store
from yearloom.specs import FactSpec, Measure, PanelSpec

_SPINE = "__in_spine"


def _sum(m: Measure) -> str:
    return f"{m.name}__sum"


def _n(m: Measure) -> str:
    return f"{m.name}__n"


def _state_columns(fact: FactSpec) -> list[str]:
    return [c for m in fact.measures for c in ([_sum(m), _n(m)] if m.how == "avg" else [_n(m)])]


def fact_state(df: DataFrame, fact: FactSpec, keys: list[str]) -> DataFrame:
    """Sums and counts of the fact's measures per key; rows without an entity drop out."""
    aggregates = []
    for m in fact.measures:
        if m.how == "avg":
            value = safe_double(F.col(f"`{m.column}`"))
            aggregates += [F.sum(value).alias(_sum(m)), F.count(value).alias(_n(m))]
        else:
            aggregates.append(F.count(F.lit(1)).alias(_n(m)))
    return df.where(F.col(keys[0]).isNotNull()).groupBy(*keys).agg(*aggregates)


def _merge(states: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    return states.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in columns])


def _value(m: Measure, of=F.col) -> Column:
    """The measure's value from its state; ``of`` maps a state column to an expression."""
    if m.how == "avg":
        return F.try_divide(of(_sum(m)), of(_n(m)).cast("double"))
    return of(_n(m))


def named_state(
    df: DataFrame,
    fact: FactSpec,
    panel: PanelSpec,
    name_column: str,
    names: DataFrame,
    fits: bool | None = None,
) -> DataFrame:
    """States per raw name and period, with their entity, of rows that have no entity yet.

    The rows are aggregated by raw name first, so that names are cleaned and looked up
    (see ``reconcile``) once per distinct name and period, not once per row.  An entity may
    have several names; what follows adds its states up, see ``merged_state``.
    """
    state = fact_state(df, fact, [name_column, panel.period])
    return matched(reconcile(state, names, name_column, fits), panel.entity)


def merged_state(state: DataFrame, fact: FactSpec, panel: PanelSpec) -> DataFrame:
    """One state per entity and period."""
    return _merge(state, _state_columns(fact), [panel.entity, panel.period])


def renamed_state(
    state: DataFrame, fact: FactSpec, panel: PanelSpec, name_column: str, names: DataFrame,
    fits: bool | None = None,
) -> DataFrame:
    """``named_state`` of rows that were reduced before they had a name."""
    reduced = _merge(state, _state_columns(fact), [name_column, panel.period])
    return matched(reconcile(reduced, names, name_column, fits), panel.entity)


def state_kpis(state: DataFrame, fact: FactSpec, keys: list[str]) -> DataFrame:
    """The fact's indicators per ``keys``, from a state with one row for each of them."""
    return state.select(*keys, *[_value(m).alias(m.name) for m in fact.measures])


def fact_kpis(df: DataFrame, fact: FactSpec, panel: PanelSpec) -> DataFrame:
    """The fact's indicators per entity and period."""
    keys = [panel.entity, panel.period]
    return state_kpis(fact_state(df, fact, keys), fact, keys)


def entity_kpis(state: DataFrame, fact: FactSpec, panel: PanelSpec) -> DataFrame:
    """The fact's indicators per entity, over the rows of all periods.

    Sums and counts are added up, so every row weighs the same; averaging the yearly
    averages would not do.
    """
    keys = [panel.entity]
    return state_kpis(_merge(state, _state_columns(fact), keys), fact, keys)


def period_spine(facts: dict[str, DataFrame], panel: PanelSpec) -> DataFrame:
    """The (entity, period) pairs of the facts (or their states) that are in the spine."""
    keys = [panel.entity, panel.period]
    pairs = [_pairs(facts[f.name], keys) for f in panel.facts if f.in_spine]
    return reduce(DataFrame.unionByName, pairs).distinct()


def _pairs(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.where(F.col(keys[0]).isNotNull()).select(*keys)


def master_table(facts: dict[str, DataFrame], panel: PanelSpec) -> DataFrame:
    """One row per (entity, period) of the spine, with the indicators of all facts.

    A NULL period is a row of its own but has no indicators of its own: it only
    takes filled values.  The result is not sorted; see ``sorted_master``.
    """
    keys = [panel.entity, panel.period]
    states = {f.name: fact_state(facts[f.name], f, keys) for f in panel.facts}
    return master_of_states(states, panel)


def master_of_states(
    states: dict[str, DataFrame], panel: PanelSpec, only: str | None = None
) -> DataFrame:
    """The master table from the facts' states; ``only`` restricts it to one fact's indicators."""
    keys = [panel.entity, panel.period]
    shown = [f for f in panel.facts if only in (None, f.name)]
    columns = [_SPINE, *[c for f in shown for c in _state_columns(f)]]
    parts = []
    for fact in panel.facts:
        if fact in shown or fact.in_spine:
            kept = _state_columns(fact) if fact in shown else []
            in_spine = F.lit(int(fact.in_spine)).alias(_SPINE)
            parts.append(states[fact.name].select(*keys, in_spine, *kept))
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    # Placed by entity, the states need no further shuffle: neither to be merged per
    # name and period nor for the window, in which an entity has one state per period.
    merged = _merge(union.repartition(panel.entity), columns, keys)
    everything = Window.partitionBy(panel.entity)
    filled = merged.select(
        *keys,
        _SPINE,
        *[
            _filled(m, fact, panel, everything).alias(m.name)
            for fact in shown
            for m in fact.measures
        ],
    )
    return filled.where(F.col(_SPINE) > 0).drop(_SPINE)


def _filled(m: Measure, fact: FactSpec, panel: PanelSpec, everything) -> Column:
    own = F.when(F.col(panel.period).isNotNull(), _value(m))
    if not fact.gap_fill:
        return own
    overall = _value(m, lambda c: F.sum(c).over(everything))
    if m.how == "count" and panel.count_fill != "total":
        if panel.count_fill == "zero":
            overall = F.lit(0).cast("long")
        else:
            periods = F.count(_n(m)).over(everything)
            overall = F.round(F.try_divide(overall.cast("double"), periods)).cast("long")
    return F.coalesce(own, overall)


def sorted_master(master: DataFrame, panel: PanelSpec) -> DataFrame:
    return master.orderBy(panel.entity, panel.period)


def mean_fill(
    df: DataFrame, group: str, columns: list[str], fits: bool | None = None
) -> DataFrame:
    """Replace NULLs in row-level ``columns`` by the mean of the row's group.

    Equal to ``coalesce(x, avg(x) over (partition by group))``, but a group of any
    size is only ever seen in parts: the means are aggregated, stored and joined.
    """
    means = store(
        df.groupBy(group).agg(
            F.count(F.lit(1)).alias(ROWS),
            *[F.avg(safe_double(F.col(f"`{c}`"))).alias(f"__mean_{c}") for c in columns],
        ),
        "group-means",
    )
    joined = size_checked_join(
        df, means.drop(ROWS), [group], "left", null_safe=True, fits=fits, counts=means
    )
    return joined.withColumns(
        {c: F.coalesce(safe_double(F.col(f"`{c}`")), F.col(f"`__mean_{c}`")) for c in columns}
    ).drop(*[f"__mean_{c}" for c in columns])


def carried_forward(df: DataFrame, group: str, order: list[str], columns: list[str]) -> DataFrame:
    """Replace NULLs in ``columns`` by the group's last known value before the row in ``order``.

    Equal to ``last_value(x ignore nulls)`` over the group, but a group of any size is cut: rows are placed by
    ranges of group and order, and stored.  The last values of a group's ranges, one row for each, tell what every range
    begins with; each range then only looks at its own rows.  ``order`` has to tell the rows of a group apart.
    """
    placed = df.repartitionByRange(F.col(f"`{group}`"), *[F.col(f"`{c}`") for c in order])
    placed = store(placed.withColumn("__range", F.spark_partition_id()), "ranges")
    keys = [F.col(f"`{group}`").alias("__group"), F.col("__range")]
    position = F.struct(*[F.col(f"`{c}`") for c in order])
    last = [F.max_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), position)).alias(f"__last_{i}") for i, c in enumerate(columns)]
    ends = placed.groupBy(*keys).agg(*last)
    before = Window.partitionBy("__group").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    begins = ends.select(
        F.col("__group"),
        F.col("__range").alias("__begins"),
        *[F.last(f"__last_{i}", ignorenulls=True).over(before).alias(f"__carry_{i}") for i in range(len(columns))],
    )
    begins = store(begins, "range-begins")
    own = Window.partitionBy(group, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = placed.withColumns({f"__own_{i}": F.last(F.col(f"`{c}`"), ignorenulls=True).over(own) for i, c in enumerate(columns)})
    same = F.col(f"`{group}`").eqNullSafe(F.col("__group")) & (F.col("__range") == F.col("__begins"))
    joined = filled.join(begins, same, "left")
    return joined.select(
        *[
            F.coalesce(f"__own_{columns.index(c)}", f"__carry_{columns.index(c)}").alias(c) if c in columns else F.col(f"`{c}`")
            for c in df.columns
        ]
    )
