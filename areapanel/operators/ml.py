"""Spark ML for panels: preprocessing, stacking, importance, selection."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import save
from .evaluate import average_precision, best_threshold, classification_metrics, roc_auc, time_folds
from .scan import scan


def preprocessor(counts: list[str], numeric: list[str], categorical: list[str], scale: bool = True) -> list:
    """Stages that make ``features``: zeros for counts, medians, one-hot categories (unknown ones kept apart)."""
    stages: list = []
    if numeric:
        stages.append(Imputer(strategy="median", inputCols=numeric, outputCols=[f"{c}_imp" for c in numeric]))
    for c in categorical:
        stages += [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep"), OneHotEncoder(inputCol=f"{c}_idx", outputCol=f"{c}_hot")]
    parts = [*counts, *[f"{c}_imp" for c in numeric], *[f"{c}_hot" for c in categorical]]
    stages.append(VectorAssembler(inputCols=parts, outputCol="raw_features" if scale else "features", handleInvalid="keep"))
    if scale:
        stages.append(StandardScaler(inputCol="raw_features", outputCol="features"))
    return stages


def base_models(phase: str = "select", seed: int = 42) -> dict:
    """Learners for the stack; the final phase grows more trees."""
    trees = 20 if phase == "select" else 100
    return {
        "lr": LogisticRegression(regParam=0.01, elasticNetParam=0.0, maxIter=30), "lr_l1": LogisticRegression(regParam=0.01, elasticNetParam=1.0, maxIter=30),
        "rf": RandomForestClassifier(numTrees=trees, maxDepth=6, seed=seed), "gbt": GBTClassifier(maxIter=trees, maxDepth=4, seed=seed), "svc": LinearSVC(regParam=0.01, maxIter=20),
    }


def _score(df: DataFrame, out: str) -> DataFrame:
    """Probability of class 1; the sigmoid of the margin where a learner has none."""
    p = vector_to_array("probability")[1] if "probability" in df.columns else 1 / (1 + F.exp(-vector_to_array("rawPrediction")[1]))
    return df.withColumn(out, p).drop("probability", "rawPrediction", "prediction")


def _fit_all(fits: list, at_once: int) -> list:
    """What the functions return, in their order; ``at_once`` of them run side by side, each a series of Spark jobs."""
    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        return list(pool.map(lambda f: f(), fits))


def oof_predict(df: DataFrame, stages: list, models: dict, folds: int, keys: list[str], date: str = "date", label: str = "label", at_once: int = 4) -> DataFrame:
    """Out-of-fold scores of each model over expanding time folds: ``keys``, label, ``p_<model>``; rows of the first run are left out.

    The features of each fold are made once and kept in the shared folder;
    ``at_once`` models are fitted side by side on them.  There are as many fits
    as folds times models; keep both few.
    """
    with_folds = time_folds(df, folds, date)
    kept = [*dict.fromkeys([*keys, label]), "features"]
    ready = []
    for k in range(1, folds + 1):
        train, test = with_folds.where(F.col("fold") < k), with_folds.where(F.col("fold") == k)
        prepared = Pipeline(stages=stages).fit(train)
        ready.append((save(prepared.transform(train).select(label, "features"), "fold-train"), save(prepared.transform(test).select(*kept), "fold-test")))
    fitted = iter(_fit_all([lambda m=m, a=a: m.copy({}).setLabelCol(label).fit(a) for a, _ in ready for m in models.values()], at_once))
    out = None
    for _, b in ready:
        for name in models:
            b = _score(next(fitted).transform(b), f"p_{name}")
        part = b.drop("features")
        out = part if out is None else out.unionByName(part)
    return save(out, "fold-scores")


def meta_models(seed: int = 42) -> dict:
    """Learners that may stand over the others."""
    return {"lr": LogisticRegression(), "gbt": GBTClassifier(maxIter=20, maxDepth=3, seed=seed)}


def fit_meta(oof: DataFrame, label: str = "label", learner=None) -> PipelineModel:
    """A learner (logistic regression by default) over the out-of-fold scores."""
    inputs = [c for c in oof.columns if c.startswith("p_")]
    learner = LogisticRegression() if learner is None else learner.copy({})
    return Pipeline(stages=[VectorAssembler(inputCols=inputs, outputCol="features"), learner.setLabelCol(label)]).fit(oof)


def evaluate_meta(oof: DataFrame, metas: dict, keys: list[str], label: str = "label", folds: int = 3, at_once: int = 4) -> list[dict]:
    """Metrics of each meta learner on out-of-fold rows that it was not fitted on, the best ``average_precision`` first (in the order given where they tie).

    Rows are dealt to ``folds`` by the hash of their keys; the fits run side by side.
    """
    dealt = oof.withColumn("_fold", F.pmod(F.xxhash64(*keys, F.lit("meta")), F.lit(folds)))
    fitted = iter(_fit_all([lambda m=m, k=k: fit_meta(dealt.where(F.col("_fold") != k), label, m) for m in metas.values() for k in range(folds)], at_once))
    out = []
    for name in metas:
        held = None
        for k in range(folds):
            part = _score(next(fitted).transform(dealt.where(F.col("_fold") == k)), "score").select(label, "score")
            held = part if held is None else held.unionByName(part)
        out.append({"meta": name, **model_metrics(save(held, "meta-scores"), label).first().asDict()})
    return sorted(out, key=lambda r: -round(r["average_precision"] or 0.0, 9))


class Stack:
    """A fitted preprocessor, base models and meta model."""

    def __init__(self, prepared: PipelineModel, models: dict[str, Transformer], meta: PipelineModel, threshold: float):
        self.prepared, self.models, self.meta, self.threshold = prepared, models, meta, threshold

    def score(self, df: DataFrame) -> DataFrame:
        """The input's columns and ``score``."""
        keep = df.columns
        out = self.prepared.transform(df)
        for name, model in self.models.items():
            out = _score(model.transform(out), f"p_{name}")
        return _score(self.meta.transform(out.drop("features")), "score").select(*keep, "score")

    def save(self, path: str) -> None:
        """All models, their names and the threshold."""
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(list(self.models), float(self.threshold))], "models array<string>, threshold double").coalesce(1).write.mode("overwrite").json(f"{path}/stack")
        self.prepared.write().overwrite().save(f"{path}/prepared")
        self.meta.write().overwrite().save(f"{path}/meta")
        for name, model in self.models.items():
            PipelineModel([model]).write().overwrite().save(f"{path}/model_{name}")

    @classmethod
    def load(cls, path: str, names: list[str] | None = None, threshold: float | None = None) -> Stack:
        """A saved stack; ``names`` and ``threshold`` replace those that were saved with it."""
        kept = SparkSession.getActiveSession().read.schema("models array<string>, threshold double").json(f"{path}/stack").first()
        models = {n: PipelineModel.load(f"{path}/model_{n}").stages[0] for n in (kept.models if names is None else names)}
        return cls(PipelineModel.load(f"{path}/prepared"), models, PipelineModel.load(f"{path}/meta"), kept.threshold if threshold is None else threshold)

    def decide(self, df: DataFrame) -> DataFrame:
        """The input's columns, ``score`` and ``predicted`` (1 if the score reaches the threshold)."""
        return self.score(df).withColumn("predicted", (F.col("score") >= self.threshold).cast("int"))


def fit_stack(df: DataFrame, stages: list, models: dict, folds: int, keys: list[str], date: str = "date", label: str = "label", at_once: int = 4, metas: dict | None = None) -> Stack:
    """Out-of-fold scores, meta model and threshold from them, then all base models on all rows, ``at_once`` of them side by side.

    Of several ``metas`` the one with the best average precision on rows that it
    was not fitted on is taken (:func:`evaluate_meta`); logistic regression by default.

    The rows are computed once and kept in the shared folder.
    """
    df = save(df, "stack-rows")
    oof = oof_predict(df, stages, models, folds, keys, date, label, at_once)
    best = evaluate_meta(oof, metas, keys, label, at_once=at_once)[0]["meta"] if metas and len(metas) > 1 else None
    meta = fit_meta(oof, label, metas[best] if best else next(iter((metas or {}).values()), None))
    threshold = best_threshold(_score(meta.transform(oof), "score"), label=label).first().threshold
    prepared = Pipeline(stages=stages).fit(df)
    ready = save(prepared.transform(df).select(label, "features"), "stack-features")
    fitted = _fit_all([lambda m=m: m.copy({}).setLabelCol(label).fit(ready) for m in models.values()], at_once)
    return Stack(prepared, dict(zip(models, fitted, strict=True)), meta, threshold)


def model_metrics(scored: DataFrame, label: str = "label") -> DataFrame:
    """All metrics in one row."""
    return classification_metrics(scored, label=label).crossJoin(average_precision(scored, label=label)).crossJoin(roc_auc(scored, label=label))


def model_importance(model, columns: list[str]) -> list[tuple[str, float]]:
    values = model.featureImportances.toArray() if hasattr(model, "featureImportances") else abs(model.coefficients.toArray())
    return sorted(zip(columns, map(float, values), strict=True), key=lambda x: (-x[1], x[0]))


def shuffled(df: DataFrame, column: str, seed: int, key: str) -> DataFrame:
    """The column's values dealt to other rows: rows are numbered in order of a hash, and each value moves on by the same number of places.

    Ranges of the hash are numbered in parallel; no row keeps its own value if there are others.
    """
    h = F.xxhash64(key, F.lit(seed))
    numbered = scan(df.withColumn("_h", h), [], ["_h", key], {"_i": (F.lit(1), "sum")}, "shuffled").drop("_h")
    numbered = numbered.crossJoin(F.broadcast(numbered.agg(F.count(F.lit(1)).alias("_rows"))))
    step = 1 + F.pmod(F.xxhash64(F.lit(seed)), F.greatest(F.col("_rows") - 1, F.lit(1)))
    source = numbered.select(F.col(column).alias("_v"), F.pmod(F.col("_i") + step, F.col("_rows")).alias("_place"))
    to = numbered.withColumn("_place", F.pmod("_i", "_rows")).drop(column, "_i", "_rows")
    return to.join(source, "_place").withColumnRenamed("_v", column).drop("_place").select(df.columns)


def permutation_importance(stack, df: DataFrame, columns: list[str], key: str, repeats: int = 5, label: str = "label") -> list[tuple[str, float]]:
    """Mean loss of average precision when a column is shuffled."""
    base = average_precision(stack(df), label=label).first()[0]
    loss = {c: sum(base - average_precision(stack(shuffled(df, c, 2 * r, key)), label=label).first()[0] for r in range(repeats)) / repeats for c in columns}
    return sorted(loss.items(), key=lambda x: (-x[1], x[0]))


def forward_select(df: DataFrame, ranked: list[str], evaluate, most: int = 10) -> list[tuple[int, float]]:
    """Score of the first k ranked columns for each k; ``evaluate`` fits and scores a list of columns."""
    return [(k, evaluate(df, ranked[:k])) for k in range(1, min(most, len(ranked)) + 1)]


def select_k(df: DataFrame, ranked: list[str], evaluate, grid: range = range(10, 75, 5)) -> tuple[int, float]:
    """The best k of a grid, the least of those that tie."""
    return max(((k, evaluate(df, ranked[:k])) for k in grid if k <= len(ranked)), key=lambda x: (x[1], -x[0]))


def unsupervised_rank(df: DataFrame, columns: list[str], ks: tuple[int, ...] = (2, 3, 4), seed: int = 42) -> list[tuple[str, float]]:
    """Importance for telling the clusters of the best silhouette."""
    data = VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="skip").transform(df)
    fits = [KMeans(k=k, seed=seed).fit(data).transform(data) for k in ks]
    best = max(fits, key=ClusteringEvaluator().evaluate).withColumn("label", F.col("prediction").cast("double")).drop("prediction")
    return model_importance(RandomForestClassifier(numTrees=20, seed=seed).fit(best), columns)


def supervised_rank(df: DataFrame, columns: list[str], key: list[str], label: str = "label", trees: int = 40, folds: int = 3, grid: range | list[int] | None = None, seed: int = 42) -> tuple[list[tuple[str, float]], list[str]]:
    """Features by importance, and the selected ones.

    The importance is that of a random forest fitted on all rows.  The first k
    features are then selected, for the k of ``grid`` (all k by default) whose
    model has the best average precision on rows that it was not fitted on;
    the least k of those that tie.  Rows are dealt to ``folds`` by the hash of
    their key.
    """
    data = df.withColumn("_fold", F.pmod(F.xxhash64(*key), F.lit(folds))).withColumn("_label", F.col(label).cast("double"))
    forest = lambda: RandomForestClassifier(labelCol="_label", numTrees=trees, seed=seed)
    vector = lambda some: VectorAssembler(inputCols=some, outputCol="features", handleInvalid="skip")
    ranked = sorted(model_importance(forest().fit(vector(columns).transform(data)), columns), key=lambda x: (-x[1], x[0]))
    names = [c for c, _ in ranked]

    def evaluate(rows: DataFrame, some: list[str]) -> float:
        model = forest().fit(vector(some).transform(rows.where("_fold > 0")))
        scored = _score(model.transform(vector(some).transform(rows.where("_fold = 0"))), "score")
        return round(average_precision(scored, label="_label").first()[0] or 0.0, 9)

    k, _ = select_k(data, names, evaluate, range(1, len(names) + 1) if grid is None else grid)
    return ranked, names[:k]


def type_model(positives: DataFrame, columns: list[str], category: str = "category") -> PipelineModel:
    """Multinomial model of the category of events."""
    return Pipeline(stages=[StringIndexer(inputCol=category, outputCol="_type", handleInvalid="keep"), VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="keep"), LogisticRegression(labelCol="_type", family="multinomial", maxIter=20)]).fit(positives)


def type_risk(model: PipelineModel, df: DataFrame, score: str = "score") -> DataFrame:
    """``risk_<category>``: chance of the category times the score."""
    names = model.stages[0].labels
    out = PipelineModel(model.stages[1:]).transform(df)
    p = vector_to_array("probability")
    return out.select(*df.columns, *[(p[i] * F.col(score)).alias(f"risk_{n}") for i, n in enumerate(names)])


def horizon_models(df: DataFrame, columns: list[str], horizons: list[int], keys: list[str], order: str, label: str = "label", seed: int = 42) -> dict:
    """A model for each horizon that predicts the label so many rows ahead."""
    from .windows import lead_targets

    led = VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="keep").transform(lead_targets(df, label, horizons, keys, order))
    return {h: GBTClassifier(labelCol=f"{label}_h{h}", maxIter=5, maxDepth=3, seed=seed).fit(led.where(F.col(f"{label}_h{h}").isNotNull())) for h in horizons}


def score_horizons(df: DataFrame, models: dict, columns: list[str], keep: list[str]) -> DataFrame:
    """Scores of all horizons, stacked with a ``horizon`` column."""
    ready = VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="keep").transform(df)
    out = None
    for h, model in models.items():
        part = _score(model.transform(ready), "score").select(*keep, F.lit(h).alias("horizon"), "score")
        out = part if out is None else out.unionByName(part)
    return out
