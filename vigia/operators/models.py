"""Boosted models of coming alerts, silence and pressure: fitted side by side, measured once, stored, chosen by family, explained."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.measures import bins
from ..sources.stages import drop, written
from .predict import ORDER, best_threshold, metrics, temporal_split

#: What the models look at, as far as a panel has it.
RISK = [
    "positividade", "positividade_trend", "risco_composto", "tests", "notificacoes", "indice_vulnerabilidade", "tests_trend", "incidencia_100k", "tests_ma8", "positividade_ma8", "precipitation_sum_mm", "temperature_2m_max",
    "n_eventos_climaticos", "cnes_estabelecimentos", "cnes_leitos_total", "cnes_equipes_esf", "vizinhos_em_alerta", "confianca_dado", "gap_sinan_sem_exame", "exames_por_notif", "tests_pct_estadual", "semanas_consec_sem_exame",
]
SILENCE = [
    "tests", "tests_ma8", "notificacoes", "semanas_sem_exame", "semanas_consec_sem_exame", "indice_vulnerabilidade", "solicitacoes_100k", "positividade", "vizinhos_em_alerta", "silencio_com_vizinho_alerta", "confianca_dado",
    "gap_sinan_sem_exame", "cnes_estabelecimentos", "exames_por_notif",
]
PRESSURE = [
    "tests", "tests_lag1", "tests_ma4", "tests_ma8", "tests_trend", "tests_pct_estadual", "notificacoes", "notificacoes_ma4", "precipitation_sum_mm", "temperature_2m_max", "n_eventos_climaticos", "cnes_estabelecimentos", "cnes_leitos_total",
    "cnes_equipes_esf", "vizinhos_em_alerta", "confianca_dado", "tat_p90_dias", "tat_mediano_dias", "pct_liberado_48h", "pct_liberado_7d", "pct_rejeitado", "backlog_estimado", "volume_norm", "backlog_norm", "tat_p90_norm", "rejeicao_norm", "indice_pressao_proxy",
]
#: Trees, their depth and rate; rows below which there is no model, no model of a family (training, held out), no calibration, no measure of a family.
TREES, DEPTH, RATE, SEED = 80, 3, 0.08, 42
LEAST_ROWS, LEAST_FAMILY, LEAST_CALIBRATED, LEAST_MEASURED = 50, (80, 15), 200, 30
#: The cut-off of a model that names none, and bounds and names of the bands of a predicted alert and silence.
OPERATIONAL = 0.25
RISK_BANDS = [0.15, 0.30, 0.50], ["baixo", "moderado", "alto", "muito_alto"]
SILENCE_BANDS = [0.35, 0.55, 0.75], ["sem_silencio_aparente", "silencio_moderado", "silencio_provavel", "silencio_critico"]
PRESSURE_BANDS = [0.25, 0.40, 0.60], ["baixa", "moderada", "alta", "critica"]
#: Rows of a partition of the training matrix.
ROWS_A_PARTITION = 100_000


@dataclass(frozen=True)
class Task:
    """What is predicted: its name, its 0/1 label, its columns, and whether families have models of their own."""

    name: str
    label: str
    columns: tuple[str, ...]
    by_family: bool = False


TASKS = (Task("risco", "y_alerta", tuple(RISK), True), Task("silencio", "y_silencio", tuple(SILENCE)))
PRESSURE_TASK = Task("pressao", "y_pressao_alta", tuple(PRESSURE))


@dataclass
class Bundle:
    """A fitted model with what is needed to use it: columns, cut-off, importances (the highest first), and whether it is calibrated."""

    name: str
    family: str
    columns: list[str]
    model: PipelineModel
    importance: list[tuple[str, float]]
    calibrated: bool
    threshold: float = OPERATIONAL
    n_train: int = 0

    @property
    def tag(self) -> str:
        return f"{self.name}_{self.family}"


@dataclass
class Trained:
    """Models, the scores of the weeks that no fit has seen (and of those that calibrated), the cut-offs, and what was left out and why."""

    bundles: list[Bundle]
    scores: DataFrame
    thresholds: DataFrame
    skipped: list[tuple[str, str, str]] = field(default_factory=list)


def matrix(rows: DataFrame, tasks: tuple[Task, ...], keys: list[str]) -> DataFrame:
    """keys, week, the columns of all tasks as doubles (what isn't known is 0), labels, and ``fase``: 'ajuste' and 'calibracao' (four fifths of the weeks,
    the last fifth of these being the second) and 'teste'. Written once, in partitions of ``ROWS_A_PARTITION`` rows."""
    columns = list(dict.fromkeys(c for t in tasks for c in t.columns if c in rows.columns))
    found = rows.select(*keys, *ORDER, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns], *[F.col(t.label).cast("int").alias(t.label) for t in tasks])
    first = written(found, "training-rows")
    weeks = temporal_split(first.select(*ORDER).distinct())
    inner = temporal_split(weeks.where("treino").drop("treino")).withColumnRenamed("treino", "_ajuste")
    phase = F.when(F.col("_ajuste"), "ajuste").when(F.col("treino"), "calibracao").otherwise("teste")
    phases = weeks.join(inner, ORDER, "left").select(*ORDER, phase.alias("fase"))  # a row for each week
    parts = max(1, -(-first.count() // ROWS_A_PARTITION))
    out = written(first.join(F.broadcast(phases), ORDER).repartition(parts), "training-matrix")
    drop(first)
    return out


def _counts(rows: DataFrame, tasks: tuple[Task, ...], by: list[str]) -> list:
    """Rows and positives by family and phase: a handful of rows."""
    return rows.groupBy(*by, "fase").agg(F.count(F.lit(1)).alias("n"), *[F.sum(t.label).alias(t.label) for t in tasks]).collect()


def _fit(rows: DataFrame, task: Task, family: str, calibrate: bool, trees: int) -> Bundle:
    """Fits on ``rows`` of the matrix; columns of the stages carry the model's name, so that several models can be applied to one row."""
    used, tag = [c for c in task.columns if c in rows.columns], f"{task.name}_{family}"
    names = {k: f"_{k}_{tag}" for k in ("features", "raw", "probability", "prediction")}
    assembler = VectorAssembler(inputCols=used, outputCol=names["features"], handleInvalid="keep")
    booster = GBTClassifier(featuresCol=names["features"], labelCol=task.label, predictionCol=names["prediction"], maxDepth=DEPTH, maxIter=trees, stepSize=RATE, seed=SEED).setRawPredictionCol(names["raw"]).setProbabilityCol(names["probability"])
    ready = assembler.transform(rows.withColumn(task.label, F.col(task.label).cast("double"))).select("fase", task.label, names["features"])
    fitted = booster.fit(ready.where(F.col("fase") == "ajuste") if calibrate else ready)
    stages = [assembler, fitted]
    if calibrate:
        late = fitted.transform(ready.where(F.col("fase") == "calibracao"))
        stages.append(IsotonicRegression(featuresCol=names["probability"], featureIndex=1, labelCol=task.label, predictionCol=f"_prob_{tag}").fit(late))
    weights = sorted(zip(used, fitted.featureImportances.toArray().tolist(), strict=True), key=lambda x: -x[1])
    return Bundle(task.name, family, used, PipelineModel(stages=stages), [(c, round(v, 5)) for c, v in weights[:15]], calibrate)


def apply(rows: DataFrame, bundle: Bundle) -> DataFrame:
    """``rows`` with the model's probability in ``_prob_<tag>``. Columns that ``rows`` lacks, and nulls, count as 0."""
    lacking = {c: F.lit(0.0) for c in bundle.columns if c not in rows.columns}
    own = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in bundle.columns if c in rows.columns}
    kept = {f"_kept_{c}": F.col(c) for c in own}  # the assembler reads the filled columns; the others come back after
    out = bundle.model.transform(rows.withColumns(kept).withColumns(lacking | own))
    if not bundle.calibrated:
        out = out.withColumn(f"_prob_{bundle.tag}", vector_to_array(f"_probability_{bundle.tag}")[1])
    return out.select(*[F.col(f"_kept_{c}").alias(c) if c in own else F.col(c) for c in rows.columns], f"_prob_{bundle.tag}")


def train(rows: DataFrame, tasks: tuple[Task, ...] = TASKS, keys: tuple[str, ...] = ("target", "municipio", "familia"), trees: int = TREES, at_once: int = 8) -> Trained:
    """O139: a model of each task over all rows and, where the task asks for it, of each family; fits run side by side in threads.

    ``rows`` has keys, week, columns and labels. A model needs ``LEAST_ROWS`` training rows of both classes, that of a family ``LEAST_FAMILY`` rows for
    training and held out. From ``LEAST_CALIBRATED`` training rows on it is fitted on the earlier weeks and calibrated on the later ones; with fewer, or
    with one class in either part, it is fitted on all of them. Cut-offs are those of the highest F1 on the later training weeks. Every
    row is scored once by each model that is meant for it, and the scores are written.
    """
    spark, keys = rows.sparkSession, list(keys)
    by = ["familia"] if "familia" in keys else []
    data = matrix(rows, tasks, keys)
    plans, skipped = [], []
    counted = _counts(data, tasks, by)
    for task in tasks:
        for family in ["global", *(sorted({r["familia"] for r in counted}) if task.by_family and by else [])]:
            mine = [r for r in counted if family == "global" or r["familia"] == family]
            n = lambda *phases, mine=mine: sum(r["n"] for r in mine if r["fase"] in phases)
            mixed = lambda *phases, mine=mine, task=task, n=n: 0 < sum(r[task.label] for r in mine if r["fase"] in phases) < n(*phases)
            total, test = n("ajuste", "calibracao"), n("teste")
            if family != "global" and (total < LEAST_FAMILY[0] or test < LEAST_FAMILY[1]):
                skipped.append((task.name, family, "amostra insuficiente"))
            elif total < LEAST_ROWS or not mixed("ajuste", "calibracao"):
                skipped.append((task.name, family, "pouca variabilidade ou amostra"))
            else:
                plans.append((task, family, total, total >= LEAST_CALIBRATED and n("calibracao") > 20 and mixed("ajuste") and mixed("calibracao")))
    of = lambda family: data if family == "global" else data.where(F.col("familia") == family)

    def fit(plan):
        task, family, total, calibrate = plan
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{task.name}_{family}")
        bundle = _fit(of(family).where("fase != 'teste'"), task, family, calibrate, trees)
        bundle.n_train = total
        return bundle

    with ThreadPoolExecutor(max(1, at_once)) as threads:
        bundles = list(threads.map(inheritable_thread_target(spark)(fit), plans))
    label = {t.name: t.label for t in tasks}
    shape = [F.lit(None).cast("string").alias("modelo"), F.lit(None).cast("string").alias("familia_modelo"), *keys, *ORDER, "fase", F.lit(None).cast("int").alias("y"), F.lit(None).cast("double").alias("prob")]
    scores = data.limit(0).select(*shape)
    for b in bundles:
        scores = scores.unionByName(apply(of(b.family).where("fase != 'ajuste'"), b).select(F.lit(b.name).alias("modelo"), F.lit(b.family).alias("familia_modelo"), *keys, *ORDER, "fase", F.col(label[b.name]).alias("y"), F.col(f"_prob_{b.tag}").alias("prob")))
    scores = written(scores, "model-scores")
    cuts = written(best_threshold(scores.where("fase = 'calibracao'"), ["modelo", "familia_modelo"]), "model-cuts")
    found = {(r["modelo"], r["familia_modelo"]): r["threshold"] for r in cuts.collect()}  # a row for each model
    for b in bundles:
        b.threshold = found.get((b.name, b.family), OPERATIONAL)
    return Trained(bundles, scores, cuts, skipped)


def backtest(trained: Trained, operational: float = 0.5) -> DataFrame:
    """O143: measures on the held-out weeks: each global model at its own cut-off, at 0.5 and at ``operational``, the global model within each family of
    ``LEAST_MEASURED`` rows and two classes at the family's own cut-off, and the families' models at theirs. What was left out has a row that says why."""
    spark = trained.scores.sparkSession
    test = trained.scores.where("fase = 'teste'")
    ident = F.concat_ws("|", *[F.col(c).cast("string") for c in trained.scores.columns if c not in ("modelo", "familia_modelo", "fase", "y", "prob")])
    rows = test.join(F.broadcast(trained.thresholds.select("modelo", "familia_modelo", "threshold")), ["modelo", "familia_modelo"], "left").withColumn("id", ident)
    whole = F.col("familia_modelo") == "global"
    own = F.coalesce("threshold", F.lit(OPERATIONAL))
    cut = lambda method, value: F.struct(F.lit(method).alias("metodo"), value.alias("limiar"))
    several = F.when(whole, F.array(cut("calibrado", own), cut("fixo", F.lit(0.5)), cut("operacional", F.lit(operational)))).otherwise(F.array(cut("calibrado", own)))
    scope = F.when(whole, F.lit("global")).otherwise(F.concat(F.lit("modelo:"), "familia_modelo"))
    every = rows.select("modelo", scope.alias("escopo"), "y", "prob", "id", F.explode(several).alias("c")).select("modelo", "escopo", "c.*", "y", "prob", "id")
    if "familia" in trained.scores.columns:
        within = trained.scores.where((F.col("familia_modelo") == "global") & F.col("modelo").isin("risco"))
        cuts = best_threshold(within.where("fase = 'calibracao'"), ["modelo", "familia"])
        enough = within.where("fase = 'teste'").groupBy("modelo", "familia").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos")).where((F.col("n") >= LEAST_MEASURED) & (F.col("pos") > 0) & (F.col("pos") < F.col("n")))
        named = enough.join(cuts, ["modelo", "familia"], "left").select("modelo", "familia", F.coalesce("threshold", F.lit(OPERATIONAL)).alias("limiar"))
        part = rows.where(whole).join(F.broadcast(named), ["modelo", "familia"])
        every = every.unionByName(part.select("modelo", F.concat(F.lit("familia:"), "familia").alias("escopo"), F.lit("calibrado").alias("metodo"), "limiar", "y", "prob", "id"))
    found = metrics(written(every, "measured"), ["modelo", "escopo", "metodo", "limiar"], F.col("limiar")).withColumn("status", F.lit("ok"))
    left = spark.createDataFrame([(m, "global" if f == "global" else f"modelo:{f}", f"sem modelo: {why}") for m, f, why in trained.skipped], "modelo string, escopo string, status string")
    return found.unionByName(left, allowMissingColumns=True)


def save(bundles: list[Bundle], folder: str) -> None:
    """Stores models in ``folder``, each with a row of ``meta`` that says how to use it."""
    spark = SparkSession.active()
    for b in bundles:
        b.model.write().overwrite().save(f"{folder}/{b.tag}")
    rows = [(b.name, b.family, b.columns, float(b.threshold), [{"feature": c, "importance": float(v)} for c, v in b.importance], b.calibrated, b.n_train) for b in bundles]
    schema = "name string, family string, columns array<string>, threshold double, importance array<struct<feature:string,importance:double>>, calibrated boolean, n_train long"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/meta")


def load(spark: SparkSession, folder: str, name: str | None = None) -> list[Bundle]:
    """The models stored in ``folder``, or those of one task."""
    rows = spark.read.parquet(f"{folder}/meta").orderBy("name", "family").collect()  # a row for each model
    return [
        Bundle(r["name"], r["family"], list(r["columns"]), PipelineModel.load(f"{folder}/{r['name']}_{r['family']}"), [(x["feature"], x["importance"]) for x in r["importance"]], r["calibrated"], r["threshold"], r["n_train"])
        for r in rows if name in (None, r["name"])
    ]


def drivers(columns: list[str], importance: Column, top: int = 5) -> Column:
    """O140: the ``top`` columns by |value| x importance (a map from column to importance), those that come first in ``columns`` of equals: feature, valor, importancia."""
    value = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    weight = lambda c: F.coalesce(F.element_at(importance, F.lit(c)), F.lit(0.0))
    parts = F.array(*[F.struct((-F.round(F.abs(value(c)) * (weight(c) + 1e-6), 12)).alias("k"), F.lit(i).alias("i"), F.lit(c).alias("feature"), value(c).alias("valor"), weight(c).alias("importancia")) for i, c in enumerate(columns)])
    return F.transform(F.slice(F.array_sort(parts), 1, top), lambda x: F.struct(x["feature"].alias("feature"), x["valor"].alias("valor"), x["importancia"].alias("importancia")))


def spelled(found: Column) -> Column:
    """Drivers as one line."""
    return F.array_join(F.transform(found, lambda x: F.format_string("%s=%.3f (imp=%.3f)", x["feature"], x["valor"], x["importancia"])), "; ")


def importances(bundle: Bundle) -> Column:
    """A map literal: a model has fifteen importances at most."""
    if not bundle.importance:
        return F.create_map().cast("map<string,double>")
    return F.create_map(*[F.lit(x) for pair in bundle.importance for x in pair])


def predicted(rows: DataFrame, bundles: list[Bundle], name: str, fallback: Column, fallback_threshold: float, levels: tuple[list[float], list[str]]) -> DataFrame:
    """O140: ``rows`` with prob, limiar, acima_limiar, faixa, metodo and drivers, in one pass: by the model of the row's family, else by that of all, else by ``fallback``.

    Every model adds its column to the row, and the row takes the one that is meant for it; nothing is read twice, shuffled or collected."""
    mine = [b for b in bundles if b.name == name]
    out = rows
    for b in mine:
        out = apply(out, b)
    by_family = [b for b in mine if b.family != "global"] if "familia" in rows.columns else []
    whole = [b for b in mine if b.family == "global"][:1]

    def chosen(of, otherwise: Column) -> Column:
        last = of(whole[0]) if whole else otherwise
        if not by_family:
            return last
        start = F
        for b in by_family:
            start = start.when(F.col("familia") == b.family, of(b))
        return start.otherwise(last)

    prob = chosen(lambda b: F.col(f"_prob_{b.tag}"), fallback)
    limit = chosen(lambda b: F.lit(float(b.threshold)), F.lit(float(fallback_threshold)))
    method = chosen(lambda b: F.lit("familia" if b.family != "global" else "global"), F.lit("logit"))
    why = chosen(lambda b: spelled(drivers([c for c in b.columns if c in rows.columns], importances(b))), F.lit(""))
    found = out.select(*rows.columns, F.round(prob, 4).alias("prob"), limit.alias("limiar"), method.alias("metodo"), why.alias("drivers"))
    return found.withColumns({"acima_limiar": F.col("prob") >= F.col("limiar"), "faixa": bins(F.col("prob"), *levels)})


def pressure_logit(rows: DataFrame) -> DataFrame:
    """O39, O140: the score of a coming high pressure that stands in for a model, with what it looks at."""
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    total = -1.8 + 2.5 * zero("indice_pressao_proxy") / 100.0 + 0.8 * zero("tests_pct_estadual") + 0.35 * F.tanh(zero("tests_trend") / 10.0)
    why = F.format_string("proxy=%.1f; pct_estadual=%.2f; trend_tests=%.2f", zero("indice_pressao_proxy"), zero("tests_pct_estadual"), zero("tests_trend"))
    return rows.select("*", (1 / (1 + F.exp(-F.greatest(F.least(total, F.lit(20.0)), F.lit(-20.0))))).alias("prob"), why.alias("drivers"))
