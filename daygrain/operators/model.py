"""Risk model on the entity-day table with Spark ML, and its evaluation as DataFrames."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce
from operator import add

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import (
    ElementwiseProduct,
    OneHotEncoder,
    OneHotEncoderModel,
    StandardScaler,
    StandardScalerModel,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daygrain.functions.order_stats import ranked_values, slice_borders, with_slice
from daygrain.functions.scalars import bin_column, safe_ratio
from daygrain.functions.storage import reliable
from daygrain.names import GENERIC, Names

TARGET = "has_fatality"
RISK = "predicted_risk"
LABEL = "predicted_label"
# Columns that leak the outcome, thresholds tried, risk bands, split share and minimum dates.
LEAKS = ("fatalities", "injuries", "accidents", "severe", "severe_rate")
THRESHOLDS = tuple(round(0.15 + 0.025 * i, 3) for i in range(25))
BAND_EDGES = (-0.01, 0.20, 0.50, 0.75, 1.0)
BAND_LABELS = ("Low", "Medium", "High", "Critical")
TEST_SHARE = 0.25
MIN_DATES = 8
AUC_SLICES = 256
MAX_LISTED = 512  # categories of a column that a plain expression may list

TEMPORAL = "Temporal holdout"
STRATIFIED = "Stratified random split"
RARE = "Random split (rare target class forced into train)"


def feature_columns(df: DataFrame, target: str = TARGET, names: Names = GENERIC) -> list[str]:
    left_out = {*names.grain, target, *LEAKS}
    return [c for c in df.columns if c not in left_out]


def _class_counts(df: DataFrame, target: str) -> dict[int, int]:
    rows = df.where(F.col(target).isNotNull()).groupBy(F.col(target).cast("int").alias("y")).count().collect()
    return {row["y"]: row["count"] for row in rows}


def temporal_split(
    df: DataFrame, target: str = TARGET, test_size: float = TEST_SHARE, day: str = "date"
) -> tuple[DataFrame, DataFrame] | None:
    """The last quarter of the distinct days is the test set; none if it cannot hold both classes.

    One row per day and class reaches the driver, nothing else.
    """
    return _split_at(df, _first_test_day(_day_classes(df, target, day), test_size), day)


def _day_classes(df: DataFrame, target: str, day: str) -> list[Row]:
    """(d, y, n): rows per day and class, nulls included."""
    return df.groupBy(F.to_date(day).alias("d"), F.col(target).cast("int").alias("y")).agg(F.count("*").alias("n")).collect()


def _first_test_day(rows: Sequence[Row], test_size: float) -> date | None:
    days = sorted({r["d"] for r in rows if r["d"] is not None})
    if len(days) < MIN_DATES:
        return None
    first = days[len(days) - max(1, int(len(days) * test_size))]
    known = [(r["d"] >= first, r["y"]) for r in rows if r["d"] is not None and r["y"] is not None]
    both = all(len({y for late, y in known if late is side}) > 1 for side in (False, True))
    return first if both else None


def _split_at(df: DataFrame, first: date | None, day: str) -> tuple[DataFrame, DataFrame] | None:
    if first is None:
        return None
    return df.where(F.to_date(day) < F.lit(first)), df.where(F.to_date(day) >= F.lit(first))


def _take(rows: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """Exactly ``n`` of rows that may all be equal, and the others. Rows are counted off range by range of the stored table."""
    place = F.monotonically_increasing_id()
    fixed = reliable(rows.withColumns({"_part": F.shiftright(place, 33), "_at": place.bitwiseAND(F.lit((1 << 33) - 1))}))
    sizes = fixed.groupBy("_part").agg(F.count("*").alias("_c"))  # one row per range
    starts = sizes.select("_part", (F.sum("_c").over(W.orderBy("_part")) - F.col("_c")).alias("_before"))
    both = fixed.join(F.broadcast(starts), "_part").withColumn("_taken", F.col("_before") + F.col("_at") < n)
    return both.where("_taken").select(*rows.columns), both.where(~F.col("_taken")).select(*rows.columns)


def _split_by_hash(
    df: DataFrame, target: str, keys: Sequence[str], seed: int, wanted: dict[int, int]
) -> tuple[DataFrame, DataFrame]:
    """The ``wanted`` number of rows per class with the smallest hash is the test set.

    The border hash per class is an exact order statistic, so no class is ever
    sorted in one task. The hash is of the keys first and of the whole row, so that rows which
    share a key are told apart; of equal rows at the border as many as needed are taken.
    """
    others = [c for c, kind in df.dtypes if "map<" not in kind and c not in keys]
    hashed = reliable(
        df.withColumn("_y", F.col(target).cast("int")).withColumn("_h", F.xxhash64(*keys, F.lit(seed), *others))
    )
    last = F.lit(-1)
    for label, n in wanted.items():
        last = F.when(F.col("_y") == label, F.lit(n - 1)).otherwise(last)
    borders = reliable(ranked_values(hashed.select("_y", "_h"), ["_y"], "_h", {"_border": last}).select("_y", "_border"))
    both = hashed.join(F.broadcast(borders), "_y", "left")
    below = both.where(F.col("_h") < F.col("_border"))
    before = {r["_y"]: r["n"] for r in below.groupBy("_y").agg(F.count("*").alias("n")).collect()}  # a row per class
    at_border = both.where(F.col("_h") == F.col("_border"))
    train = both.where(F.coalesce(F.col("_h") > F.col("_border"), F.lit(True))).select(*df.columns)
    test = below.select(*df.columns)
    for label, n in wanted.items():
        taken, rest = _take(at_border.where(F.col("_y") == label).select(*df.columns), n - before.get(label, 0))
        test, train = test.unionByName(taken), train.unionByName(rest)
    return train, test


def stratified_split(
    df: DataFrame,
    target: str = TARGET,
    test_size: float = TEST_SHARE,
    seed: int = 42,
    keys: Sequence[str] = ("entity_id", "date"),
) -> tuple[DataFrame, DataFrame]:
    """The same share of each class goes to the test set, reproducible by key hash and seed."""
    counts = _class_counts(df, target)
    wanted = {label: max(1, round(n * test_size)) for label, n in counts.items()}
    return _split_by_hash(df, target, keys, seed, wanted)


def rare_class_split(
    df: DataFrame,
    target: str = TARGET,
    test_size: float = TEST_SHARE,
    seed: int = 42,
    keys: Sequence[str] = ("entity_id", "date"),
) -> tuple[DataFrame, DataFrame]:
    """A class with a single row stays in train; the other rows give the test set."""
    counts = _class_counts(df, target)
    usable = {label: n for label, n in counts.items() if n >= 2}
    rows = sum(usable.values())
    if rows < 2:
        raise ValueError("too little target variation for a train/test split; use more data")
    if len(usable) == len(counts) or len(counts) < 2:
        raise ValueError("rare_class_split needs two classes, one of them with a single row")
    n_test = min(max(1, round(sum(counts.values()) * test_size)), rows - 1)
    (label,) = usable
    return _split_by_hash(df, target, keys, seed, {label: n_test})


def split_train_test(
    df: DataFrame,
    target: str = TARGET,
    test_size: float = TEST_SHARE,
    seed: int = 42,
    names: Names = GENERIC,
) -> tuple[DataFrame, DataFrame, str]:
    """Temporal split if possible, else stratified, else with the rare class kept in train."""
    first, counts = None, {}
    if names.day in df.columns:  # one count per day and class gives the classes and the cut
        rows = _day_classes(df, target, names.day)
        first = _first_test_day(rows, test_size)
        for r in rows:
            if r["y"] is not None:
                counts[r["y"]] = counts.get(r["y"], 0) + r["n"]
    else:
        counts = _class_counts(df, target)
    if len(counts) < 2:
        raise ValueError("the target needs two classes to train the model")
    split = _split_at(df, first, names.day)
    if split:
        return *split, TEMPORAL
    keys = [c for c in names.grain if c in df.columns]
    if min(counts.values()) >= 2:
        return *stratified_split(df, target, test_size, seed, keys), STRATIFIED
    return *rare_class_split(df, target, test_size, seed, keys), RARE


def _population(rows: int) -> float:
    """Sample deviation divided by population deviation."""
    return (rows / (rows - 1)) ** 0.5 if rows > 1 else 1.0


def encode_features(
    df: DataFrame, target: str = TARGET, names: Names = GENERIC, rows: int | None = None
) -> Pipeline:
    """Numbers standardised by population deviation, one-hot categories; a category unseen in training is all zeros."""
    features = feature_columns(df, target, names)
    if not features:
        raise ValueError("no usable feature columns")
    types = dict(df.dtypes)
    rows = df.count() if rows is None else rows
    text = [c for c in features if types[c] == "string"]
    numeric = [c for c in features if c not in text]
    stages, inputs = [], []
    if numeric:
        stages += [
            VectorAssembler(inputCols=numeric, outputCol="_numeric"),
            StandardScaler(inputCol="_numeric", outputCol="_by_sample", withMean=True, withStd=True),
            # the scaler divides by the sample deviation
            ElementwiseProduct(inputCol="_by_sample", outputCol="_scaled", scalingVec=[_population(rows)] * len(numeric)),
        ]
        inputs.append("_scaled")
    if text:
        indexed, hot = [f"_ix_{c}" for c in text], [f"_hot_{c}" for c in text]
        stages += [
            StringIndexer(
                inputCols=text, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"
            ),
            OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True),
        ]
        inputs += hot
    stages.append(VectorAssembler(inputCols=inputs, outputCol="_features"))
    return Pipeline(stages=stages)


def class_weights(df: DataFrame, target: str = TARGET) -> DataFrame:
    """One row per class: balanced weight n / (classes * class rows). Rows without target are in no class."""
    counts = df.where(F.col(target).isNotNull()).groupBy(F.col(target).cast("int").alias("label")).agg(F.count("*").alias("n"))
    shape = counts.agg(F.struct(F.sum("n").alias("rows"), F.count("*").alias("classes")).alias("s")).scalar()
    return counts.withColumn("weight", shape["rows"] / (shape["classes"] * F.col("n"))).select("label", "n", "weight")


def train_risk_model(
    train: DataFrame, target: str = TARGET, names: Names = GENERIC, max_iter: int = 1000, tol: float = 1e-12
) -> PipelineModel:
    """L2 logistic regression with balanced classes.

    The weights sum to the row count, so an unscaled penalty of 1 is ``regParam = 1 / n``.
    """
    weights = class_weights(train, target)  # one row per class
    weight = F.broadcast(weights.select("label", F.col("weight").alias("_weight")))
    columns = dict.fromkeys([*feature_columns(train, target, names), target])
    # stored once: the scaler, the indexer and the regression each read it; rows without target drop out
    labelled = reliable(train.select(*columns).withColumn("label", F.col(target).cast("int")).join(weight, "label"))
    n = labelled.count()
    regression = LogisticRegression(
        featuresCol="_features",
        labelCol="label",
        weightCol="_weight",
        regParam=1.0 / n,
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=tol,
    )
    stages = encode_features(train, target, names, n).getStages()
    return Pipeline(stages=[*stages, regression]).fit(labelled)


def score_risk(model: PipelineModel, df: DataFrame, col: str = RISK) -> DataFrame:
    """Append the probability of the positive class.

    Models of ``train_risk_model`` are written out as one plain expression: the stages of a pipeline hand a vector from one
    function to the next for each row. Others are applied as they are.
    """
    risk = risk_column(model)
    if risk is not None:
        return df.select("*", risk.alias(col))
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(col))


def risk_column(model: PipelineModel) -> Column | None:
    """The probability of the positive class as an expression over the feature columns, in the model's own order of steps.

    None for stages other than those of ``encode_features``, more than two classes or a column of very many categories.
    A number that is null or NaN is an error, an unseen category counts nothing, as in the model.
    """
    vectors: dict[str, list[Column | tuple[Column, Sequence[str], int]]] = {}  # numbers, or (category, labels, width)
    indexed: dict[str, tuple[Column, Sequence[str]]] = {}
    *stages, last = model.stages
    for stage in stages:
        if isinstance(stage, VectorAssembler) and stage.getHandleInvalid() == "error":
            plain = [c for c in stage.getInputCols() if c not in vectors]
            vectors |= {c: [F.col(f"`{c}`").cast("double")] for c in plain}
            vectors[stage.getOutputCol()] = [part for c in stage.getInputCols() for part in vectors[c]]
        elif isinstance(stage, StandardScalerModel) and stage.getWithMean() and stage.getWithStd():
            shapes = zip(vectors[stage.getInputCol()], stage.mean.toArray(), stage.std.toArray(), strict=True)
            scaled = [(x - F.lit(float(m))) * F.lit(1.0 / float(d) if d else 0.0) for x, m, d in shapes]
            vectors[stage.getOutputCol()] = scaled
        elif isinstance(stage, ElementwiseProduct):
            factors = zip(vectors[stage.getInputCol()], stage.getScalingVec().toArray(), strict=True)
            vectors[stage.getOutputCol()] = [x * F.lit(float(f)) for x, f in factors]
        elif isinstance(stage, StringIndexerModel) and stage.getHandleInvalid() == "keep":
            for source, to, labels in zip(stage.getInputCols(), stage.getOutputCols(), stage.labelsArray, strict=True):
                indexed[to] = (F.col(f"`{source}`").cast("string"), labels)
        elif isinstance(stage, OneHotEncoderModel) and stage.getDropLast():
            for source, to, size in zip(stage.getInputCols(), stage.getOutputCols(), stage.categorySizes, strict=True):
                vectors[to] = [(*indexed[source], size - 1)]
        else:
            return None
    if not isinstance(last, LogisticRegressionModel) or last.numClasses != 2:
        return None
    coefficients, parts, at = last.coefficients.toArray(), [F.lit(0.0)], 0
    for part in vectors[last.getFeaturesCol()]:
        if isinstance(part, Column):
            parts.append(part * F.lit(float(coefficients[at])))
            at += 1
            continue
        category, labels, width = part
        if len(labels) > MAX_LISTED:
            return None
        pairs = [F.lit(v) for i, label in enumerate(labels[:width]) for v in (label, float(coefficients[at + i]))]
        if pairs:
            parts.append(F.coalesce(F.try_element_at(F.create_map(*pairs), category), F.lit(0.0)))
        at += width
    margin = reduce(add, parts) + F.lit(float(last.intercept))
    risk = F.lit(1.0) - F.lit(1.0) / (F.lit(1.0) + F.exp(margin))
    # one test of the sum instead of one a feature keeps the compiled method small
    gap = F.coalesce(F.isnan(margin) | margin.isNull(), F.lit(True))
    return F.when(gap, F.raise_error(F.lit("a feature to score is null or NaN")).cast("double")).otherwise(risk)


def choose_threshold(
    scored: DataFrame,
    target: str = TARGET,
    score: str = RISK,
    thresholds: Sequence[float] = THRESHOLDS,
) -> DataFrame:
    """One row ``threshold, f1``: the first threshold with the best F1.

    Each row is binned by how many thresholds it reaches; the counts per bin are
    accumulated from the top, one row per threshold.
    """
    y = F.col(target).cast("int")
    reached = sum(((F.col(score) >= F.lit(t)).cast("int") for t in thresholds), F.lit(0))
    bins = scored.groupBy(reached.alias("_bin")).agg(
        F.sum(y).alias("_pos"), F.sum(1 - y).alias("_neg")
    )
    all_pos = bins.agg(F.sum("_pos")).scalar()
    slots = F.array(*[F.struct(F.lit(i + 1).alias("slot"), F.lit(t).alias("threshold")) for i, t in enumerate(thresholds)])
    # every bin row counts toward the thresholds it reaches: at most 26 rows times 25
    counted = bins.select("_bin", "_pos", "_neg", F.inline(slots)).groupBy("threshold").agg(
        F.sum(F.when(F.col("_bin") >= F.col("slot"), F.col("_pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("_bin") >= F.col("slot"), F.col("_neg")).otherwise(0)).alias("fp"),
    )
    f1 = safe_ratio(2 * F.col("tp"), F.col("tp") + F.col("fp") + all_pos)
    ranked = counted.withColumn("f1", f1)
    best = F.max(F.struct(F.col("f1"), (-F.col("threshold")).alias("minus"))).alias("b")
    return ranked.agg(best).select((-F.col("b.minus")).alias("threshold"), F.col("b.f1").alias("f1"))


def _confusion(y: Column, pred: Column) -> list[Column]:
    return [
        F.count("*").alias("n"),
        F.sum(y).alias("_p"),
        F.sum(pred).alias("_pp"),
        F.sum(y * pred).alias("_tp"),
    ]


def classification_metrics(
    scored: DataFrame, threshold: float | Column, target: str = TARGET, score: str = RISK
) -> DataFrame:
    """One row: rows, positive rate, F1, precision and recall at a threshold."""
    y = F.col(target).cast("int")
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    pred = (F.col(score) >= limit).cast("int")
    return (
        scored.withColumns({"_y": y, "_hit": pred})
        .agg(*_confusion(F.col("_y"), F.col("_hit")))
        .select(
            F.col("n").alias("rows"),
            safe_ratio("_p", "n").alias("positive_rate"),
            safe_ratio(2 * F.col("_tp"), F.col("_p") + F.col("_pp")).alias("f1"),
            safe_ratio("_tp", "_pp").alias("precision"),
            safe_ratio("_tp", "_p").alias("recall"),
        )
    )


def auc(
    scored: DataFrame,
    group: Sequence[str] = (),
    target: str = TARGET,
    score: str = RISK,
    slices: int = AUC_SLICES,
) -> DataFrame:
    """Exact area under the ROC curve per group, null where only one class occurs."""
    y = F.col(target).cast("int")
    counts = scored.groupBy(*group, F.col(score).alias("_score")).agg(
        F.sum(y).alias("_pos"), F.sum(1 - y).alias("_neg")
    )
    result = auc_of_counts(counts, group, slices)
    return result if group else result.select("auc")


def auc_of_counts(counts: DataFrame, group: Sequence[str], slices: int = AUC_SLICES) -> DataFrame:
    """AUC from (group, _score, _pos, _neg).

    Positives beat the negatives below them. Scores are cut into slices so that no
    task orders a whole group: pairs inside a slice, plus pairs between slices from
    the slice totals (at most ``slices`` rows per group).
    """
    keys = list(group) or ["_all"]
    rows = counts if group else counts.withColumn("_all", F.lit(0))
    cells = with_slice(rows, "_score", slice_borders(rows, "_score", slices))
    below = W.partitionBy(*keys, "_slice").orderBy("_score").rowsBetween(W.unboundedPreceding, -1)
    inner = cells.withColumn("_below", F.coalesce(F.sum("_neg").over(below), F.lit(0)))
    wins = F.col("_pos") * (F.col("_below") + 0.5 * F.col("_neg").cast("double"))
    per_slice = inner.groupBy(*keys, "_slice").agg(
        F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"), F.sum(wins).alias("_wins")
    )
    lower = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    stacked = per_slice.withColumn("_below", F.coalesce(F.sum("_neg").over(lower), F.lit(0)))
    all_wins = F.sum(F.col("_wins") + F.col("_pos").cast("double") * F.col("_below"))
    pairs = F.sum("_pos").cast("double") * F.sum("_neg").cast("double")
    return stacked.groupBy(*keys).agg(F.try_divide(all_wins, pairs).alias("auc"))


def group_metrics(
    scored: DataFrame, cols: Sequence[str], target: str = TARGET, score: str = RISK, label: str = LABEL
) -> DataFrame:
    """(group_col, group) rows: size, rates, AUC, F1 and recall for each value of each column.

    Rows are first counted per distinct (columns, score, label); only those counts are
    repeated once per grouping column.
    """
    y = F.col(target).cast("int")
    counts = scored.groupBy(*cols, F.col(score).alias("_score"), F.col(label).cast("int").alias("_hit")).agg(
        F.sum(y).alias("_pos"), F.sum(1 - y).alias("_neg")
    )
    fields = F.array(
        *[F.struct(F.lit(c).alias("group_col"), F.col(c).cast("string").alias("group")) for c in cols]
    )
    long = counts.select("_score", "_hit", "_pos", "_neg", F.inline(fields)).where("group is not null")
    keys = ["group_col", "group"]
    by_score = long.groupBy(*keys, "_score").agg(F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
    size = F.col("_pos") + F.col("_neg")
    sums = long.groupBy(*keys).agg(
        F.sum(size).alias("n"),
        F.sum("_pos").alias("_p"),
        F.sum(size * F.col("_hit")).alias("_pp"),
        F.sum(F.col("_pos") * F.col("_hit")).alias("_tp"),
    )
    return sums.join(auc_of_counts(by_score, keys), keys, "left").select(
        *keys,
        "n",
        safe_ratio("_p", "n").alias("positive_rate"),
        safe_ratio("_pp", "n").alias("pred_positive_rate"),
        "auc",
        safe_ratio(2 * F.col("_tp"), F.col("_p") + F.col("_pp")).alias("f1"),
        safe_ratio("_tp", "_p").alias("recall"),
    )


INTERCEPT = "(intercept)"


def model_coefficients(model: PipelineModel, df: DataFrame, intercept: bool = False) -> DataFrame:
    """(feature, coef) rows, read from the fitted model and the vector metadata; with ``intercept`` a row for that as well."""
    attributes = model.transform(df.limit(0)).schema["_features"].metadata["ml_attr"]["attrs"]
    slots = {a["idx"]: a["name"] for kind in attributes.values() for a in kind}
    numeric = next((s.getInputCols() for s in model.stages if isinstance(s, VectorAssembler)), [])
    rows = []
    for i, coef in enumerate(model.stages[-1].coefficients.toArray()):
        name = slots.get(i, str(i))
        if name.startswith("_scaled_"):
            name = numeric[int(name.removeprefix("_scaled_"))]
        rows.append((name.removeprefix("_hot_"), float(coef)))
    if intercept:
        rows.append((INTERCEPT, float(model.stages[-1].intercept)))
    return df.sparkSession.createDataFrame(rows, "feature string, coef double")


def feature_scales(train: DataFrame, target: str = TARGET, names: Names = GENERIC) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each numeric feature over the rows with a target."""
    numeric = [c for c in feature_columns(train, target, names) if dict(train.dtypes)[c] != "string"]
    labelled = train.where(F.col(target).isNotNull())
    sums = [f(F.col(c).cast("double")).alias(f"{k}{i}") for i, c in enumerate(numeric) for k, f in (("m", F.avg), ("s", F.stddev_pop))]
    row = labelled.agg(*sums).first() if sums else {}
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(numeric)}


def encoded_values(
    df: DataFrame, scales: Mapping[str, tuple[float, float]], target: str = TARGET, names: Names = GENERIC
) -> Column:
    """A row's features as (feature, value) pairs under the names of ``model_coefficients``: numbers standardised, each
    category one, the intercept one. This is the encoding of ``encode_features`` in plain expressions."""
    pair = lambda name, value: F.struct(name.alias("feature"), value.alias("value"))
    pairs = [pair(F.lit(INTERCEPT), F.lit(1.0))]
    for c in feature_columns(df, target, names):
        if c in scales:
            mean, deviation = scales[c]
            value = (F.col(c).cast("double") - F.lit(mean)) / F.lit(deviation) if deviation else F.lit(0.0)
            pairs.append(pair(F.lit(c), value))
        else:
            pairs.append(pair(F.concat(F.lit(f"{c}_"), F.col(c)), F.lit(1.0)))
    return F.array(*pairs)


def with_logistic_risk(df: DataFrame, coefficients: DataFrame, values: str, col: str = RISK) -> DataFrame:
    """``df`` with the probability from (feature, coef) rows, a few for each column of the table, and the pairs in ``values``.
    A feature without coefficient adds nothing."""
    table = coefficients.agg(F.map_from_entries(F.collect_list(F.struct("feature", "coef")))).scalar()
    held = df.withColumn("_coefs", table)
    add = lambda z, x: z + F.coalesce(F.try_element_at("_coefs", x["feature"]), F.lit(0.0)) * x["value"]
    return held.withColumn(col, 1.0 / (1.0 + F.exp(-F.aggregate(values, F.lit(0.0), add)))).drop("_coefs")


def loss_gradient(
    coefficients: DataFrame, train: DataFrame, target: str = TARGET, names: Names = GENERIC, penalty: float = 1.0
) -> DataFrame:
    """(feature, gradient) of the mean class-weighted log loss with the L2 penalty at the coefficients, intercept included.

    All zeros where the coefficients are the model's optimum, whatever found them. The sums are combined before the shuffle.
    """
    labelled = train.where(F.col(target).isNotNull())
    scales = feature_scales(train, target, names)
    weights = class_weights(train, target).select(F.col("label").alias("_label"), F.col("weight").alias("_weight"))
    rows = labelled.select(F.col(target).cast("int").alias("_label"), encoded_values(labelled, scales, target, names).alias("_x"))
    encoded = rows.join(F.broadcast(weights), "_label")  # one row per class
    residual = F.col("_weight") * (F.col("_p") - F.col("_label"))
    sums = (
        with_logistic_risk(encoded, coefficients, "_x", "_p")
        .select(residual.alias("_r"), F.inline("_x"))
        .groupBy("feature")
        .agg(F.sum(F.col("_r") * F.col("value")).alias("_sum"))
    )
    n = labelled.agg(F.count("*").alias("n")).scalar()
    pull = F.when(F.col("feature") == INTERCEPT, 0.0).otherwise(penalty * F.coalesce("coef", F.lit(0.0)))
    return coefficients.join(sums, "feature", "full").select(
        "feature", ((F.coalesce("_sum", F.lit(0.0)) + pull) / n).alias("gradient")
    )


def feature_fingerprint(df: DataFrame, target: str = TARGET, names: Names = GENERIC) -> str:
    """Digest of what a model is fitted on: target, names and types of the feature columns."""
    kinds = dict(df.dtypes)
    listed = [f"{c}:{'text' if kinds[c] == 'string' else 'number'}" for c in feature_columns(df, target, names)]
    return hashlib.sha256("\n".join([target, *listed]).encode()).hexdigest()


def top_features(model: PipelineModel, df: DataFrame, k: int = 15) -> DataFrame:
    """The ``k`` features with the largest coefficients by size."""
    return model_coefficients(model, df).orderBy(F.desc(F.abs("coef")), "feature").limit(k)


def holdout_scores(
    scored: DataFrame,
    threshold: float | Column,
    target: str = TARGET,
    score: str = RISK,
    names: Names = GENERIC,
) -> DataFrame:
    """Keys, actual flag, risk, predicted label and risk band, highest risk first."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return scored.select(
        *names.grain,
        names.region,
        names.city,
        names.kind,
        target,
        F.col(score).alias(RISK),
        (F.col(score) >= limit).cast("int").alias(LABEL),
        bin_column(score, BAND_EDGES, BAND_LABELS).alias("risk_band"),
    ).orderBy(F.desc(RISK), *names.grain)
