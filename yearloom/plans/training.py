"""Cross-validated regression on a frame of rows with keys, features and a label.

The frame is kept; split and folds are hashes of the keys, or given expressions.  For
forests it is laid out once by its rows, in a number of tasks that follows from how many they are.  So
the same rows give the same models, whatever the input's layout and the session's settings, and a task that
runs twice sees the same rows in the same order.

All grid points of linear families are cross-validated from sums gathered in one pass, see
``gram``.  For forests, missing values are imputed and the vector is assembled once per fold, and all
grid points are fitted on that frame and scored in one pass.  Of points that differ in depth only, the
deepest is fitted and the others are cut from it, see ``shallow``.  Where many rows share few intervals of the
features, the same forests are grown from merged rows, see ``merged``.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.operators import frames
from yearloom.plans import bagging, gram, merged, shallow
from yearloom.specs import Family, ModelSpec

log = logging.getLogger(__name__)

_SPLIT, _FOLD = "__split", "__fold"
TRAIN, VALIDATION = "train", "validation"


@dataclass(frozen=True)
class Candidate:
    """The best model of one family and how it did.

    ``params`` are the tuned parameters, ``settings`` all parameters of the regressor.
    """

    family: str
    order: int
    run_id: str
    features: list[str]
    params: dict[str, float]
    settings: dict[str, str]
    rmse: float | None
    model: PipelineModel
    validation: DataFrame


@dataclass(frozen=True)
class GridPoint:
    """Mean error over the folds of one family at one point of its grid."""

    family: str
    params: dict[str, float]
    avg_rmse: float | None
    fold_rmse: list[float | None]


@dataclass(frozen=True)
class Training:
    spec: ModelSpec
    rows: dict[str, int]
    folds: list[int]  # that had rows and were used
    grid: list[GridPoint]
    candidates: list[Candidate]

    @property
    def champion(self) -> Candidate | None:
        """The lowest validation error; the first of equal ones; None if none is a number."""
        scored = [c for c in self.candidates if c.rmse is not None and c.rmse < float("inf")]
        return min(scored, key=lambda c: c.rmse, default=None)


def model_frame(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """The complete rows, marked with split and fold, with features and label as doubles."""
    numbers = [*dict.fromkeys([*spec.features, spec.label])]
    keys = list(spec.keys)
    complete = frames.complete_rows(df, list(spec.required))
    if spec.split is None:
        split = frames.key_split(complete, keys, spec.train_percent, spec.seed, name=_SPLIT)
    else:
        part = F.when(F.expr(spec.split), TRAIN).otherwise(VALIDATION)
        split = complete.withColumn(_SPLIT, part)
    hashed = frames.key_bucket(keys, spec.seed + 1, spec.folds)
    marked = split.withColumn(_FOLD, F.expr(spec.fold).cast("int") if spec.fold else hashed)
    for key in keys:  # a key may also be a feature
        marked = marked.withColumn(f"__key_{key}", F.col(f"`{key}`"))
    return frames.as_doubles(marked, numbers)


TASK_ROWS = 100_000  # of a task; more than MANY_TASKS are only for rows that need them
MANY_TASKS, MOST_ROWS = 2_000, 10_000_000


def layout_tasks(rows: int) -> int:
    """In how many tasks so many rows are laid out for forests."""
    return max(1, min(-(-rows // TASK_ROWS), max(MANY_TASKS, -(-rows // MOST_ROWS))))


def _laid_out(marked: DataFrame, spec: ModelSpec) -> DataFrame:
    """Features, label and marks; for forests in a layout that only depends on the rows.

    Each row then goes to a task by a hash of its keys, features and label, and is sorted there, so
    neither the input's layout nor the session's settings change what trees are sampled.  The number of
    tasks follows from the number of rows, or is given.  Rows that share keys are spread; full copies are not.
    """
    keys = [f"__key_{k}" for k in spec.keys]
    numbers = [*dict.fromkeys([*spec.features, spec.label])]
    frame = marked.select(*keys, *numbers, _SPLIT, _FOLD)
    if any(f.kind == "row_forest" for f in spec.families):
        frame = frame.withColumn(bagging.HASH, F.xxhash64(*keys, *numbers))
    if not any(f.kind == "forest" for f in spec.families):
        return frame.drop(*keys)
    tasks = spec.partitions or layout_tasks(marked.count())
    laid = frame.repartition(tasks, *keys, *numbers)
    return laid.sortWithinPartitions(*keys, *numbers).drop(*keys)


@dataclass(frozen=True)
class _Census:
    rows: dict[str, int]
    fold_rows: dict[int, int]
    known: dict[int, dict[str, int]]
    means: dict[str, float]  # of all known values
    fingerprint: str


def _census(frame: DataFrame, spec: ModelSpec) -> _Census:
    """Rows and known feature values per split and fold, in one pass.

    The result has a row per split and fold, whatever the size of the frame.
    """
    value_hash = F.xxhash64(*spec.features, spec.label).cast("decimal(20,0)")
    counts = [
        F.count(F.when(~F.isnan(F.col(c)), F.col(c))).alias(f"known_{i}")
        for i, c in enumerate(spec.features)
    ]
    columns = [*dict.fromkeys([*spec.features, spec.label])]
    means = [F.avg(F.when(~F.isnan(c), F.col(c))).alias(f"mean_{i}") for i, c in enumerate(columns)]
    groups = (
        frame.groupBy(_SPLIT, _FOLD)
        .agg(F.count(F.lit(1)).alias("rows"), F.sum(value_hash).alias("hash"), *counts, *means)
        .collect()
    )
    rows, fold_rows, known = {TRAIN: 0, VALIDATION: 0}, {}, {}
    middle = {}
    for g in groups:
        for i, c in enumerate(columns):
            if g[f"mean_{i}"] is not None:
                middle[c] = middle.get(c, 0.0) + g[f"mean_{i}"] * g["rows"] / sum(x["rows"] for x in groups)
        if g[_SPLIT] == TRAIN and g[_FOLD] is None and spec.fold:
            raise ValueError(f"{g['rows']} rows of {spec.experiment} have no fold: {spec.fold} is NULL")
        rows[g[_SPLIT]] += g["rows"]
        if g[_SPLIT] == TRAIN:
            fold_rows[g[_FOLD]] = g["rows"]
            known[g[_FOLD]] = {c: g[f"known_{i}"] for i, c in enumerate(spec.features)}
    content = sorted((g[_SPLIT], g[_FOLD], g["rows"], str(g["hash"])) for g in groups)
    text = json.dumps([asdict(spec), content], sort_keys=True)
    return _Census(rows, fold_rows, known, middle, hashlib.sha256(text.encode()).hexdigest())


def _usable_folds(census: _Census) -> list[int]:
    """Folds with rows of their own and rows outside."""
    folds = sorted(census.fold_rows)
    return folds if len(folds) > 1 else []


def _warn_of_folds(spec: ModelSpec, folds: list[int]) -> None:
    if not folds:
        log.warning(
            "%s: fewer than two folds have rows, so nothing is cross-validated and each "
            "family's first grid point is taken", spec.experiment,
        )
    elif len(folds) < spec.folds:
        log.warning("%s: only %d of %d folds have rows", spec.experiment, len(folds), spec.folds)


def _apply_null_policy(frame: DataFrame, spec: ModelSpec, census: _Census):
    """Deal with features that have no value in the whole or in some fold's training part."""
    folds = _usable_folds(census)
    parts = [list(census.known)] + [[f for f in census.known if f != fold] for fold in folds]
    empty = [
        c
        for c in spec.features
        if any(sum(census.known[f][c] for f in part) == 0 for part in parts)
    ]
    if not empty:
        return frame, list(spec.features)
    if spec.all_null == "raise":
        raise ValueError(f"features without any value in a training part: {', '.join(empty)}")
    if spec.all_null == "zero":
        known = {c: F.when(~F.isnan(c), F.col(c)) for c in empty}
        filled = {c: F.coalesce(value, F.lit(0.0)) for c, value in known.items()}
        return frame.withColumns(filled), list(spec.features)
    kept = [c for c in spec.features if c not in empty]
    if not kept:
        raise ValueError("no feature has a value in every training part")
    log.warning("features left out for lack of values: %s", ", ".join(empty))
    return frame, kept


def preparation(features: list[str]) -> Pipeline:
    """Mean imputation and vector assembly."""
    imputed = [c + frames.IMPUTED for c in features]
    assembler = VectorAssembler(inputCols=imputed, outputCol="features")
    return Pipeline(stages=[frames.mean_imputer(features), assembler])


def regressor(family: Family, label: str, seed: int, params: dict | None = None) -> Estimator:
    if family.kind == "linear":
        base = LinearRegression(featuresCol="features", labelCol=label)
    elif family.kind in ("forest", "row_forest"):
        base = RandomForestRegressor(featuresCol="features", labelCol=label, seed=seed)
    else:
        raise ValueError(f"unknown family {family.kind!r}")
    return base.copy({base.getParam(k): v for k, v in (params or {}).items()})


def grid_points(family: Family) -> list[dict]:
    names = [name for name, _ in family.grid]
    return [dict(zip(names, values)) for values in itertools.product(*[v for _, v in family.grid])]


def _fit_all(estimators: list[Estimator], frame: DataFrame, parallelism: int) -> list:
    fit = inheritable_thread_target(frame.sparkSession)(lambda e: e.fit(frame))
    with ThreadPoolExecutor(max_workers=min(parallelism, len(estimators))) as pool:
        return list(pool.map(fit, estimators))


# Rows of the fits that run at the same time.  Each keeps its rows in memory, in a form of its own; one of
# more rows than this fills a cluster alone.
TOGETHER_ROWS = 2_000_000


def _at_once(spec: ModelSpec, rows: int) -> int:
    """How many fits on so many rows run at the same time."""
    return max(1, min(spec.parallelism, TOGETHER_ROWS // max(1, rows)))


def _errors(models: list, frame: DataFrame, label: str, cut: list[Column] = ()) -> list[float | None]:
    """Validation errors of several models, then of other predictions, in one pass over the frame."""
    scored = frame
    for i, model in enumerate(models):
        scored = model.setPredictionCol(f"prediction_{i}").transform(scored)
    scored = scored.withColumns({f"prediction_{i}": column for i, column in enumerate(cut, len(models))})
    row = scored.agg(
        *[frames.rmse(label, f"prediction_{i}").alias(f"e{i}") for i in range(len(models) + len(cut))]
    ).first()
    return list(row)


# The parameters of a grid that sums can answer.
_PENALTIES = {"regParam", "elasticNetParam"}


def _by_sums(family: Family) -> bool:
    """Whether a family is cross-validated without fitting it."""
    return family.kind == "linear" and {name for name, _ in family.grid} <= _PENALTIES


def _sums_errors(
    train: DataFrame, spec: ModelSpec, features: list[str], folds: list[int], census: _Census, points: list[dict]
) -> list[list[float | None]]:
    parts = gram.sums(train, features, spec.label, _FOLD, census.means)
    penalties = [(float(p.get("regParam", 0.0)), float(p.get("elasticNetParam", 0.0))) for p in points]
    return gram.fold_errors(parts, folds, penalties)


def _row_forest(imputed: DataFrame, spec: ModelSpec, features: list[str], params: dict) -> PipelineModel:
    """A forest whose samples belong to the rows; see ``bagging``."""
    columns = [c + frames.IMPUTED for c in features]
    return bagging.fit(imputed, columns, spec.label, params, spec.seed, spec.parallelism)


def _fits_errors(
    train: DataFrame, spec: ModelSpec, features: list[str], folds: list[int], census: _Census, points: list[tuple[Family, dict]]
) -> list[list[float | None]]:
    out: list[list[float | None]] = [[] for _ in points]
    rowwise = [i for i, (f, _) in enumerate(points) if f.kind == "row_forest"]
    others = [i for i in range(len(points)) if i not in rowwise]
    source = [shallow.sources(points)[i] if f.kind == "forest" else i for i, (f, _) in enumerate(points)]
    fitted = [i for i in others if source[i] == i]
    others = [*fitted, *(i for i in others if source[i] != i)]
    columns = [c + frames.IMPUTED for c in features]
    forests = [i for i in others if points[i][0].kind == "forest"]
    for fold in folds:
        inside, outside = train.where(F.col(_FOLD) != fold), train.where(F.col(_FOLD) == fold)
        prepare = preparation(features).fit(inside)
        for i in rowwise:
            model = _row_forest(prepare.transform(inside).drop("features"), spec, features, points[i][1])
            scored = model.transform(prepare.transform(outside).drop("features"))
            out[i].append(scored.agg(frames.rmse(spec.label, "prediction")).first()[0])
        if not others:
            continue
        # Each fit keeps a copy in a form of its own; vectors are made again from the kept frame.
        ready = prepare.transform(inside).select("features", spec.label)
        held_out = prepare.transform(outside).select("features", *columns, spec.label)
        estimators = {i: regressor(points[i][0], spec.label, spec.seed, points[i][1]) for i in fitted}
        rows = sum(n for other, n in census.fold_rows.items() if other != fold)
        found = _cells_errors(ready, held_out, estimators, {i: (source[i], points[i][1]) for i in forests}, rows, census, spec)
        left = [i for i in others if i not in found]
        fits = [i for i in left if source[i] == i]
        models = _fit_all([estimators[i] for i in fits], ready, _at_once(spec, rows)) if fits else []
        whole = dict(zip(fits, models, strict=True))
        cut = [shallow.prediction(whole[source[i]], points[i][1][shallow.DEPTH], columns) for i in left[len(fits) :]]
        if left:
            found |= zip(left, _errors(models, held_out, spec.label, cut), strict=True)
        for i in others:
            out[i].append(found[i])
    return out


def _cells_errors(
    ready: DataFrame,
    held_out: DataFrame,
    estimators: dict[int, Estimator],
    forests: dict[int, tuple[int, dict]],
    rows: int,
    census: _Census,
    spec: ModelSpec,
) -> dict[int, float | None]:
    """Errors of forests, each with the one that it is cut from and its parameters, by ``merged``; none if that does not suit."""
    grown = [i for i, (source, _) in forests.items() if source == i]
    parameters = {name for _, params in forests.values() for name in params}
    if not grown or not merged.suits([estimators[i] for i in grown], parameters, rows):
        return {}
    found = merged.grow(ready, [estimators[i] for i in grown], rows)
    if found is None:
        return {}
    whole, cuts = dict(zip(grown, found[0], strict=True)), found[1]
    origin = census.means.get(spec.label, 0.0)
    cells = merged.cell_sums(held_out.select("features", spec.label), estimators[grown[0]], cuts, origin)
    said = [
        merged.prediction(whole[source], params.get(shallow.DEPTH, whole[source].depth), cuts)
        for source, params in forests.values()
    ]
    return dict(zip(forests, merged.errors(cells, said, origin), strict=True))


def _cross_validate(
    frame: DataFrame, spec: ModelSpec, features: list[str], folds: list[int], census: _Census
) -> list[GridPoint]:
    points = [(family, params) for family in spec.families for params in grid_points(family)]
    train = frame.where(F.col(_SPLIT) == TRAIN)
    quick = [i for i, (family, _) in enumerate(points) if _by_sums(family)]
    slow = [i for i in range(len(points)) if i not in quick]
    errors: list[list[float | None]] = [[] for _ in points]
    if folds and quick:
        found = _sums_errors(train, spec, features, folds, census, [points[i][1] for i in quick])
        for i, own in zip(quick, found, strict=True):
            errors[i] = own
    if folds and slow:
        found = _fits_errors(train, spec, features, folds, census, [points[i] for i in slow])
        for i, own in zip(slow, found, strict=True):
            errors[i] = own
    result = []
    for (family, params), own in zip(points, errors, strict=True):
        mean = sum(own) / len(own) if own and None not in own else None
        result.append(GridPoint(family.name, params, mean, own))
    return result


def best_point(points: list[GridPoint]) -> GridPoint:
    """The first point with the lowest mean error; the first of all if none has one."""
    scored = [p for p in points if p.avg_rmse is not None and p.avg_rmse == p.avg_rmse]
    return min(scored, key=lambda p: p.avg_rmse, default=points[0])


def train(df: DataFrame, spec: ModelSpec) -> Training:
    """Tune each family by cross-validation, refit its best point, score it on the rest."""
    marked = model_frame(df, spec)
    frame = _laid_out(marked, spec).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _train(frame, marked, spec)
    finally:
        frame.unpersist()


def tune(df: DataFrame, spec: ModelSpec) -> list[GridPoint]:
    """The errors of every grid point by cross-validation, and nothing else."""
    frame = _laid_out(model_frame(df, spec), spec).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        census, frame, features, folds = _prepared(frame, spec)
        return _cross_validate(frame, spec, features, folds, census)
    finally:
        frame.unpersist()


def _prepared(frame: DataFrame, spec: ModelSpec) -> tuple[_Census, DataFrame, list[str], list[int]]:
    """Counts of the frame, the frame after the null policy, its features, and the folds to use."""
    census = _census(frame, spec)
    total = sum(census.rows.values())
    if total < spec.min_rows:
        log.warning("only %d rows, below %d: errors may not be reliable", total, spec.min_rows)
    if census.rows[TRAIN] == 0:
        raise ValueError(f"no rows to train {spec.experiment} on")
    frame, features = _apply_null_policy(frame, spec, census)
    folds = _usable_folds(census)
    _warn_of_folds(spec, folds)
    return census, frame, features, folds


def _train(frame: DataFrame, marked: DataFrame, spec: ModelSpec) -> Training:
    census, frame, features, folds = _prepared(frame, spec)
    grid = _cross_validate(frame, spec, features, folds, census)

    rows = frame.where(F.col(_SPLIT) == TRAIN)
    prepare = preparation(features).fit(rows)
    ready = prepare.transform(rows).select("features", spec.label)
    best = [best_point([p for p in grid if p.family == f.name]) for f in spec.families]
    chosen = list(zip(spec.families, best, strict=True))
    estimators = [regressor(f, spec.label, spec.seed, b.params) for f, b in chosen if f.kind != "row_forest"]
    fitted = iter(_fit_all(estimators, ready, _at_once(spec, census.rows[TRAIN])) if estimators else [])
    held_out = prepare.transform(frame.where(F.col(_SPLIT) == VALIDATION))
    wholes, settings = [], []
    for family, point in chosen:
        if family.kind == "row_forest":
            model = _row_forest(prepare.transform(rows).drop("features"), spec, features, point.params)
            wholes.append(PipelineModel([*prepare.stages[:-1], *model.stages]))
            settings.append({k: str(v) for k, v in point.params.items()})
        else:
            model = next(fitted).setPredictionCol("prediction")
            wholes.append(PipelineModel([*prepare.stages, model]))
            settings.append(_settings(regressor(family, spec.label, spec.seed), model))
    plain = frame.where(F.col(_SPLIT) == VALIDATION)
    simple = [w.stages[-1] for w, (f, _) in zip(wholes, chosen, strict=True) if f.kind != "row_forest"]
    found = iter(_errors(simple, held_out.select("features", spec.label), spec.label) if simple else [])
    errors = [
        w.transform(plain).agg(frames.rmse(spec.label, "prediction")).first()[0] if f.kind == "row_forest" else next(found)
        for w, (f, _) in zip(wholes, chosen, strict=True)
    ]
    for w in simple:
        w.setPredictionCol("prediction")  # the errors were taken under other names
    # What is handed out is read from the input again, as the kept frame is released.
    keys = [f"__key_{k}" for k in spec.keys]
    source = marked.where(F.col(_SPLIT) == VALIDATION).drop(_SPLIT, _FOLD, *keys)
    source, _ = _apply_null_policy(source, spec, census)
    candidates = []
    for order, (family, point, whole, own, error) in enumerate(
        zip(spec.families, best, wholes, settings, errors, strict=True)
    ):
        run_id = hashlib.sha256(f"{census.fingerprint}/{family.name}".encode()).hexdigest()[:32]
        candidates.append(
            Candidate(
                family=family.name,
                order=order,
                run_id=run_id,
                features=features,
                params=point.params,
                settings=own,
                rmse=error,
                model=whole,
                validation=score(whole, source),
            )
        )
    return Training(spec, census.rows, folds, grid, candidates)


def _settings(estimator: Estimator, model: Model) -> dict[str, str]:
    """Values of the estimator's parameters as the fitted model holds them."""
    values = {p.name: v for p, v in model.extractParamMap().items()}
    return {p.name: str(values[p.name]) for p in estimator.params if p.name in values}


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The rows with their ``prediction``; helper columns of the model are dropped."""
    kept = df.columns
    return model.transform(df).select(*kept, "prediction")


def cv_table(spark: SparkSession, spec: ModelSpec, grid: list[GridPoint]) -> DataFrame:
    """One row per grid point: family, parameters, mean error, the folds' errors, and whether it is its family's best."""
    best = [best_point([p for p in grid if p.family == f.name]) for f in spec.families]
    rows = [
        (
            spec.experiment,
            p.family,
            {k: float(v) for k, v in p.params.items()},
            p.avg_rmse,
            p.fold_rmse,
            any(p is b for b in best),
        )
        for p in grid
    ]
    return spark.createDataFrame(
        rows,
        "experiment string, model_type string, params map<string,double>, "
        "avg_rmse double, fold_rmse array<double>, best boolean",
    )

