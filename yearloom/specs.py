"""Declarations shared by the operators: datasets, facts, panels and models."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class PeriodSpec:
    """Where a record's year comes from.

    ``kind`` is ``"column"`` (rename one), ``"parts"`` (year, month and day
    columns, in that order) or ``"filename"`` (a pattern whose first group is
    the year, searched in the path of the source file).
    """

    kind: str
    columns: tuple[str, ...] = ()
    pattern: str = ""
    date_column: str = "opened_date"

    def __post_init__(self):
        wanted = {"column": 1, "parts": 3, "filename": 0}
        if self.kind not in wanted:
            raise ValueError(f"unknown period kind {self.kind!r}")
        if len(self.columns) != wanted[self.kind]:
            raise ValueError(f"period kind {self.kind!r} takes {wanted[self.kind]} columns")
        if self.kind == "filename" and not self.pattern:
            raise ValueError("period kind 'filename' needs a pattern")


@dataclass(frozen=True)
class DatasetSpec:
    """One raw dataset: where it lies, its schema (DDL text), how to format it.

    ``multi_line`` says that fields of a CSV file may hold line breaks; then a file is one
    task.  A record that does not fit the schema is an error, unless ``corrupt_column``
    names a column that takes its text; such a record has NULL in the other columns.
    """

    name: str
    format: str
    glob: str
    schema: str
    name_column: str
    period: PeriodSpec
    options: dict = field(default_factory=dict)
    multi_line: bool = True
    corrupt_column: str | None = None


@dataclass(frozen=True)
class LookupSpec:
    """A file that reconciles raw names with stable identifiers."""

    file: str
    name_column: str
    id_column: str
    schema: str


@dataclass(frozen=True)
class Measure:
    """One indicator: the ``avg`` of a column, or the ``count`` of rows."""

    name: str
    how: str
    column: str | None = None

    def __post_init__(self):
        if self.how not in ("avg", "count"):
            raise ValueError(f"unknown measure {self.how!r}")
        if (self.how == "avg") != (self.column is not None):
            raise ValueError("avg takes a column, count takes none")


@dataclass(frozen=True)
class FactSpec:
    """The indicators of one dataset.

    ``in_spine``: its (entity, period) pairs make rows of the master table.
    ``gap_fill``: periods without own values take the entity's overall value.
    """

    name: str
    measures: tuple[Measure, ...]
    in_spine: bool = True
    gap_fill: bool = False


@dataclass(frozen=True)
class PanelSpec:
    """A master table: its keys, its facts, and how filled counts are made.

    ``count_fill`` is ``"total"`` (the entity's rows over all periods),
    ``"mean"`` (that total per period that has rows) or ``"zero"``.
    """

    facts: tuple[FactSpec, ...]
    entity: str = "entity_id"
    period: str = "year"
    count_fill: str = "total"

    def __post_init__(self):
        if self.count_fill not in ("total", "mean", "zero"):
            raise ValueError(f"unknown count_fill {self.count_fill!r}")
        names = [m.name for f in self.facts for m in f.measures]
        if len(set(names)) != len(names):
            raise ValueError("measure names must be unique within a panel")

    def fact(self, name: str) -> FactSpec:
        for fact in self.facts:
            if fact.name == name:
                return fact
        raise KeyError(name)


@dataclass(frozen=True)
class Family:
    """A kind of regressor and its parameter grid.

    ``kind`` is ``"linear"``, ``"forest"``, or ``"row_forest"``: a forest whose samples are drawn by row
    and tree, so that it needs no layout; it is fitted tree by tree.
    """

    name: str
    kind: str
    grid: tuple[tuple[str, tuple], ...]


@dataclass(frozen=True)
class ModelSpec:
    """A regression task.

    ``keys`` identify a row; split and folds are hashes of them.
    ``all_null`` says what to do with a feature that has no value in some
    training part: ``"raise"``, ``"drop"`` the feature, or fill it with
    ``"zero"``.  ``partitions`` may give the number of tasks that the rows are hashed to for
    forests, whose samples depend on it; else it follows from the number of rows.  ``split`` and ``fold``
    may give SQL expressions in place of the hashes: whether a row is trained on, and the
    number of its fold, never NULL.
    """

    experiment: str
    model_name: str
    label: str
    features: tuple[str, ...]
    required: tuple[str, ...]
    keys: tuple[str, ...]
    families: tuple[Family, ...]
    folds: int
    min_rows: int
    train_percent: int = 80
    seed: int = 42
    all_null: str = "raise"
    partitions: int | None = None
    parallelism: int = 4
    split: str | None = None
    fold: str | None = None

    def __post_init__(self):
        if self.all_null not in ("raise", "drop", "zero"):
            raise ValueError(f"unknown all_null {self.all_null!r}")
        if self.label not in self.required:
            raise ValueError("the label must be among the required columns")
