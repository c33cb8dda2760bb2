"""Forecasts, anomalies, features, labels, models and their measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import average_rank_share, clip, ratio, rolling, sigmoid
from ..functions.weeks import advance
from ..sources.stages import written
from .aggregates import SERIES
from .ranks import cumulated, value_ranks
from .territory import recent

ORDER = ["epi_year", "epi_week"]


def _history(panel: DataFrame, keys: list[str]) -> DataFrame:
    """Series of tests by ``keys`` as arrays in the order of weeks. A series has a row a week, so that its arrays are short."""
    weekly = panel.groupBy(*keys, *ORDER).agg(F.sum("tests").cast("double").alias("tests"))
    row = F.struct("epi_year", "epi_week", "tests")
    return weekly.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("h"))


def median_of(values: Column) -> Column:
    """Median of an array; null of an empty one."""
    s, n = F.array_sort(values), F.size(values)
    return F.when(n > 0, (F.element_at(s, F.floor((n + 1) / 2).cast("int")) + F.element_at(s, F.floor(n / 2 + 1).cast("int"))) / 2)


def forecast_seasonal(panel: DataFrame, horizon: int = 4, seasonal: float = 0.4, keys: tuple[str, ...] = ("target",), tail: int = 4) -> DataFrame:
    """O131, O132: step by step: (1 - seasonal) * median of the last ``tail`` values + seasonal * median of the same week so far.

    Predictions join the history that the next steps look at. One fold over the array of a series, no loop over rows.
    """
    hist = _history(panel, list(keys))
    last = F.element_at("h", -1)
    start = F.struct(F.transform("h", lambda r: F.struct(r["epi_week"].alias("w"), r["tests"].alias("v"))).alias("seen"), F.array().cast("array<struct<step:int,y:bigint,w:bigint,pred:double,season:double,near:double>>").alias("out"))

    def step(state: Column, k: Column) -> Column:
        y, w = advance(last["epi_year"], last["epi_week"], k)
        same = F.transform(F.filter(state["seen"], lambda x: x["w"] == w), lambda x: x["v"])
        near = F.transform(F.slice(state["seen"], F.greatest(F.size(state["seen"]) - (tail - 1), F.lit(1)), tail), lambda x: x["v"])
        s, r = median_of(same), median_of(near)
        pred = F.greatest(F.coalesce((1 - seasonal) * r + seasonal * s, r, s), F.lit(0.0))
        row = F.struct(k.cast("int").alias("step"), y.alias("y"), w.alias("w"), pred.alias("pred"), s.alias("season"), r.alias("near"))
        return F.struct(F.concat(state["seen"], F.array(F.struct(w.alias("w"), pred.alias("v")))).alias("seen"), F.concat(state["out"], F.array(row)).alias("out"))

    folded = hist.select(*keys, F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step, lambda s: s["out"]).alias("f"))
    rows = folded.select(*keys, F.explode("f").alias("f"))
    return rows.select(*keys, F.col("f.step").cast("long").alias("forecast_step"), F.col("f.y").alias("forecast_epi_year"), F.col("f.w").alias("forecast_epi_week"), F.col("f.pred").alias("forecast_tests"), F.col("f.season").alias("seasonal_median"), F.col("f.near").alias("recent_median"))


def forecast_flat(panel: DataFrame, steps: int = 4, least: int = 8) -> DataFrame:
    """O133: the median of the last eight weeks, for every step; series of fewer weeks have none."""
    hist = _history(panel, ["target"]).where(F.size("h") >= least)
    last, tail = F.element_at("h", -1), F.transform(F.slice("h", -8, 8), lambda r: r["tests"])
    steps_ = hist.select("target", median_of(tail).alias("forecast_tests"), last.alias("l"), F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("k"))
    y, w = advance(F.col("l.epi_year"), F.col("l.epi_week"), F.col("k"))
    return steps_.select("target", F.col("k").cast("long").alias("forecast_step"), y.alias("forecast_epi_year"), w.alias("forecast_epi_week"), "forecast_tests")


STATE = ["tests", "positividade", "incidencia_100k", "notificacoes_100k", "mortalidade_100k"]


def state_rates(panel: DataFrame) -> DataFrame:
    """All towns of a (target, week), with the rates of the sums; a rate without a denominator is null."""
    sums = panel.groupBy("target", *ORDER).agg(*[F.sum(c).cast("double").alias(c) for c in ("tests", "positives", "notificacoes", "obitos", "populacao")])
    rate = lambda c: ratio(F.col(c), F.col("populacao"), 1e5)
    return sums.select("*", ratio(F.col("positives"), F.col("tests")).alias("positividade"), rate("positives").alias("incidencia_100k"), rate("notificacoes").alias("notificacoes_100k"), rate("obitos").alias("mortalidade_100k"))


def forecast_statewide(panel: DataFrame, horizon: int = 4, seasonal: float = 0.4, least: int = 12, tail: int = 8) -> DataFrame:
    """O132: volume, positivity, incidence, notifications and mortality of a target of at least ``least`` weeks, each on its own:
    (1 - seasonal) * median of the last ``tail`` values and all steps so far + seasonal * median of the same week so far. What is not
    known counts in neither; where one of the two is not known, the other stands alone."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("indicador"), F.col(c).alias("v")) for c in STATE])).alias("c")
    tall = state_rates(panel).select("target", *ORDER, cells).select("target", *ORDER, "c.*")
    hist = tall.groupBy("target", "indicador").agg(F.array_sort(F.collect_list(F.struct(*ORDER, "v"))).alias("h")).where(F.size("h") >= least)
    last = F.element_at("h", -1)
    numbers = lambda a: F.filter(F.transform(a, lambda r: r["v"]), lambda v: v.isNotNull())
    seen = F.transform("h", lambda r: F.struct(r["epi_week"].alias("w"), r["v"].alias("v")))
    start = F.struct(seen.alias("seen"), numbers(F.slice("h", F.greatest(F.size("h") - (tail - 1), F.lit(1)), tail)).alias("recent"), F.array().cast("array<struct<step:int,y:bigint,w:bigint,pred:double>>").alias("out"))

    def step(state: Column, k: Column) -> Column:
        y, w = advance(last["epi_year"], last["epi_week"], k)
        s, r = median_of(numbers(F.filter(state["seen"], lambda x: x["w"] == w))), median_of(state["recent"])
        pred = F.coalesce((1 - seasonal) * r + seasonal * s, r, s)
        row = F.struct(k.cast("int").alias("step"), y.alias("y"), w.alias("w"), pred.alias("pred"))
        return F.struct(F.concat(state["seen"], F.array(F.struct(w.alias("w"), pred.alias("v")))).alias("seen"), F.array_compact(F.concat(state["recent"], F.array(pred))).alias("recent"), F.concat(state["out"], F.array(row)).alias("out"))

    folded = hist.select("target", "indicador", F.explode(F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step, lambda s: s["out"])).alias("f"))
    rows = folded.select("target", "indicador", F.col("f.step").cast("long").alias("forecast_step"), F.col("f.y").alias("forecast_epi_year"), F.col("f.w").alias("forecast_epi_week"), F.col("f.pred").alias("pred"))
    return rows.groupBy("target", "forecast_step", "forecast_epi_year", "forecast_epi_week").agg(*[F.max(F.when(F.col("indicador") == c, F.col("pred"))).alias(f"forecast_{c}") for c in STATE])


def forecast_ewma(panel: DataFrame, horizon: int = 4, span: int = 4, least: int = 6) -> DataFrame:
    """O134: exponentially weighted means (weights kept over gaps) of the last eight weeks: tests, with their deviation as the band, positivity
    (0 if never known) and notifications, for which tests stand where the panel has none."""
    alpha = 2.0 / (span + 1)
    noted = "notificacoes" if "notificacoes" in panel.columns else "tests"
    weekly = panel.groupBy("target", *ORDER).agg(F.sum("tests").cast("double").alias("tests"), F.sum("positives").alias("_pos"), F.sum(noted).cast("double").alias("notificacoes")).withColumn("positividade", ratio(F.col("_pos"), F.col("tests")))
    named = ("tests", "positividade", "notificacoes")
    hist = weekly.groupBy("target").agg(F.array_sort(F.collect_list(F.struct(*ORDER, *named))).alias("h")).where(F.size("h") >= least)
    last = F.slice("h", F.greatest(F.size("h") - 7, F.lit(1)), 8)
    tails = hist.select("target", F.element_at("h", -1).alias("l"), *[last.getField(c).alias(c) for c in named])

    def step(s: Column, x: Column) -> Column:
        w = s["w"] * (1 - alpha)
        y = F.when(s["y"].isNull(), x).when(x.isNull(), s["y"]).otherwise((w * s["y"] + alpha * x) / (w + alpha))
        return F.struct(y.alias("y"), F.when(x.isNull(), F.when(s["y"].isNull(), 1.0).otherwise(w)).otherwise(1.0).alias("w"))

    mean = lambda c: F.aggregate(c, F.struct(F.lit(None).cast("double").alias("y"), F.lit(1.0).alias("w")), step, lambda s: s["y"])
    avg = F.aggregate("tests", F.lit(0.0), lambda a, x: a + x) / F.size("tests")
    smooth = tails.select("target", "l", "tests", avg.alias("_avg"), mean("tests").alias("m"), F.coalesce(mean("positividade"), F.lit(0.0)).alias("p"), mean("notificacoes").alias("n"))
    spread = smooth.withColumn("sd", F.sqrt(F.aggregate("tests", F.lit(0.0), lambda a, x: a + (x - F.col("_avg")) * (x - F.col("_avg"))) / F.size("tests")))
    rows = spread.select("target", "l", "m", "sd", "p", "n", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("k"))
    y, w = advance(F.col("l.epi_year"), F.col("l.epi_week"), F.col("k"))
    return rows.select(
        "target", F.col("k").cast("long").alias("forecast_step"), y.alias("forecast_epi_year"), w.alias("forecast_epi_week"), F.col("m").alias("forecast_tests"), F.greatest(F.col("m") - F.col("sd"), F.lit(0.0)).alias("forecast_tests_low"),
        (F.col("m") + F.col("sd")).alias("forecast_tests_high"), F.col("p").alias("forecast_positividade"), F.col("n").alias("forecast_notificacoes"))


#: What lags, means and trends are taken of, as far as a panel has it.
METRICS = [
    "tests", "positives", "positividade", "notificacoes", "obitos", "incidencia_100k", "risco_composto", "indice_vulnerabilidade", "solicitacoes_100k",
    "precipitation_sum_mm", "temperature_2m_max", "relative_humidity_2m_min", "n_eventos_climaticos", "cnes_estabelecimentos", "cnes_leitos_total", "cnes_equipes_esf",
]


def features(panel: DataFrame, metrics: list[str] | None = None, weeks: int | None = None) -> DataFrame:
    """O93, O95, O97, O135: of each metric the value before, means of 4 and 8 observed weeks and their trend (of tests, four values before);
    weeks without an exam, exams a notification, and the rank of the week's tests. ``weeks``: only the last so many observed weeks.

    All windows but the rank share the partitioning and order of a series: one shuffle, one sort."""
    metrics = metrics or [c for c in METRICS if c in panel.columns]
    panel = recent(panel, weeks) if weeks else panel
    w = Window.partitionBy(*SERIES).orderBy(*ORDER)
    lags = [F.lag(c, k).over(w).alias(f"{c}_lag{k}") for c in metrics for k in ((1, 2, 3, 4) if c == "tests" else (1,))]
    means = [rolling(F.col(c), w, n, max(2, n // 2)).alias(f"{c}_ma{n}") for c in metrics for n in (4, 8)]
    trends = [(rolling(F.col(c), w, 4, 2) - rolling(F.col(c), w, 8, 4)).alias(f"{c}_trend") for c in metrics]
    few, none = (F.col("tests") <= 1).cast("long"), (F.coalesce("tests", F.lit(0)) <= 0).cast("long")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    seen = panel.select("*", *lags, *means, *trends, (F.sum(few).over(upto) * few).alias("semanas_zero"), F.sum(1 - few).over(upto).alias("_run"), (F.sum(none).over(upto) * none).alias("semanas_consec_sem_exame"))
    quiet = F.coalesce(F.col("tests_ma8"), F.lit(0.0)) < 0.5
    seen = seen.select(
        "*", (none + F.when(quiet, 4).otherwise(0)).alias("semanas_sem_exame"), ratio(F.col("tests"), F.col("notificacoes")).alias("exames_por_notif"), average_rank_share(F.col("tests"), [F.col(c) for c in ORDER]).alias("tests_pct_estadual"))
    return seen.withColumn("semanas_zero_seguidas", (F.sum(few).over(Window.partitionBy(*SERIES, "_run").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)) * few)).drop("_run")


def with_context(rows: DataFrame, silent: DataFrame | None = None, quality: DataFrame | None = None) -> DataFrame:
    """O135: what is known of a town (neighbours in alert, trust in its data), with the values that stand where nothing is known."""
    defaults = {"vizinhos_em_alerta": 0, "silencio_com_vizinho_alerta": 0, "confianca_dado": 0.5, "gap_sinan_sem_exame": 0}
    for side, columns in ((silent, ["vizinhos_em_alerta", "silencio_com_vizinho_alerta"]), (quality, ["confianca_dado", "gap_sinan_sem_exame"])):
        if side is not None:
            one = side.groupBy("municipio").agg(*[F.max(F.col(c).cast("double" if c == "confianca_dado" else "long")).alias(c) for c in columns])
            rows = rows.join(one, "municipio", "left")
        else:
            rows = rows.withColumns({c: F.lit(defaults[c]) for c in columns})
    return rows.fillna(defaults)


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """O100: the last row of each series, by a grouping that combines before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*ORDER)).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def anomalies(rows: DataFrame, metrics: tuple[str, ...] = ("tests", "positividade", "incidencia_100k", "notificacoes")) -> DataFrame:
    """O130: metrics of the latest rows that are half off their mean of eight weeks, up or down; tests also when twice the mean (five at least),
    positivity also when 0.35 at least and 0.15 over it."""
    named = F.explode(F.array(*[F.struct(F.lit(c).alias("metrica"), F.col(c).cast("double").alias("valor"), F.col(f"{c}_ma8").cast("double").alias("base")) for c in metrics])).alias("m")
    tall = latest(rows, SERIES).select(*SERIES, *ORDER, named).select(*SERIES, *ORDER, "m.*")
    off = tall.withColumn("desvio", (F.col("valor") - F.col("base")) / F.greatest(F.abs("base"), F.lit(1e-6)))
    x, base = F.col("valor"), F.col("base")
    more = ((F.col("metrica") == "tests") & (x >= 5) & (x >= base * 2.0)) | ((F.col("metrica") == "positividade") & (x >= 0.35) & (x - base >= 0.15))
    kept = off.where((F.abs("desvio") >= 0.5) | more)
    severity = F.when(F.abs("desvio") >= 1.0, "alta").when(F.abs("desvio") >= 0.5, "moderada").otherwise("baixa")
    return kept.select("*", F.when(F.col("desvio") >= 0, "alta_atipica").otherwise("queda_atipica").alias("tipo_anomalia"), severity.alias("severidade"))


def labels(rows: DataFrame, drop_unresolved: bool = False) -> DataFrame:
    """O94, O137: what the next two observed weeks of a series bring: an alert, a week without exams, and such a week although there are notifications
    (or, where ``rows`` has it, neighbours in alert). Weeks that aren't there count as 0, unless the last rows are dropped."""
    w = Window.partitionBy(*SERIES).orderBy(*ORDER)
    ahead = [("tests", 1), ("tests", 2), ("positives", 1), ("positividade", 1), ("positividade", 2), ("risco_composto", 1), ("notificacoes", 1)]
    nxt = rows.select("*", *[F.lead(c, k).over(w).alias(f"_{c}{k}") for c, k in ahead])
    if drop_unresolved:
        nxt = nxt.where("_tests1 is not null")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    tests, positives = zero("_tests1"), zero("_positives1")
    alert = (
        (zero("_risco_composto1") >= 1.2) | ((zero("_positividade1") >= 0.25) & (tests >= 2)) | ((zero("_positividade2") >= 0.25) & (zero("_tests2") >= 2)) | (positives >= 2)
        | ((positives > zero("positives")) & (positives >= 1) & (tests >= 2)) | ((zero("_notificacoes1") >= 3) & (tests >= 1) & (zero("_positividade1") >= 0.15)))
    near = zero("vizinhos_em_alerta") > 0 if "vizinhos_em_alerta" in rows.columns else F.lit(False)
    silent = tests <= 0
    return nxt.select(*rows.columns, alert.cast("int").alias("y_alerta"), silent.cast("int").alias("y_silencio"), (silent & ((zero("_notificacoes1") > 0) | near)).cast("int").alias("y_silencio_epi"))


def risk_logit(rows: DataFrame) -> DataFrame:
    """O39, O140: the readable score that stands in for a model: seven terms through a sigmoid, with the three that weigh most."""
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    terms = [
        ("positividade", 2.8 * zero("positividade")), ("tendencia_pos", 1.5 * F.tanh(zero("positividade_trend") * 5)), ("risco", 0.35 * F.least(zero("risco_composto"), F.lit(10.0))), ("volume", 0.15 * F.log1p(zero("tests"))),
        ("notificacoes", 0.12 * F.log1p(zero("notificacoes"))), ("vulnerabilidade", 0.25 * clip(zero("indice_vulnerabilidade"), -3, 3)), ("tendencia", 0.4 * F.tanh(zero("tests_trend") / 5.0)),
    ]
    total = F.lit(-2.2)
    for _, t in terms:
        total = total + t
    parts = F.array(*[F.struct((-F.round(F.abs(t), 9)).alias("k"), F.lit(n).alias("n")) for n, t in terms])
    drivers = F.array_join(F.transform(F.slice(F.array_sort(parts), 1, 3), lambda x: x["n"]), ", ")
    return rows.select("*", sigmoid(total).alias("prob"), drivers.alias("explicacao"))


def silence_logit(rows: DataFrame) -> DataFrame:
    """O140: the score of a coming silence that stands in for a model; ``vizinhos_em_alerta`` counts where it is there."""
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    total = (
        -1.0 + 0.55 * clip(zero("semanas_sem_exame"), 0, 12) + 0.8 * (zero("tests") <= 0).cast("double") + 0.35 * (zero("tests_ma8") < 1).cast("double") + 0.25 * F.log1p(zero("notificacoes"))
        + 0.2 * clip(zero("indice_vulnerabilidade"), -3, 3) - 0.15 * F.log1p(F.greatest(zero("solicitacoes_100k"), F.lit(0.0))))
    if "vizinhos_em_alerta" in rows.columns:
        total = total + 0.35 * clip(zero("vizinhos_em_alerta"), 0, 6)
    return rows.withColumn("prob_silencio", sigmoid(total))


def bands(rows: DataFrame, keys: list[str], threshold: float = 0.25) -> DataFrame:
    """O129: the band by severity (risk, positivity, tests, level, and whether ``prob`` passes ``threshold``), the band by the rank of ``prob``
    within ``keys`` (a lone row is in the middle), the higher of the two, and which one decided. Ranks are taken in sorted ranges."""
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    r, pos, tests, over, level = zero("risco_composto"), zero("positividade"), zero("tests"), F.coalesce(F.col("prob") >= threshold, F.lit(False)), F.coalesce("nivel_risco", F.lit(""))
    fixed = (
        F.when((level == "alto_alerta") | (r >= 3) | (over & (r >= 2) & (pos >= 0.35) & (tests >= 3)), 3).when((level == "alerta") | (r >= 2) | over | ((pos >= 0.50) & (tests >= 2)), 2)
        .when((level == "atencao") | (r >= 1) | ((pos >= 0.25) & (tests >= 1)), 1).otherwise(0))
    ranks = value_ranks(rows.where(F.col("prob").isNotNull()), keys, "prob").select(*keys, "prob", "n", "avg_rank")
    sizes = ranks.groupBy(*keys).agg(F.sum("n").alias("_size"))
    joined = rows.join(ranks.drop("n"), [*keys, "prob"], "left").join(sizes, keys, "left")
    share = F.when(F.col("_size") == 1, 50.0).otherwise(F.col("avg_rank") / F.col("_size") * 100.0)
    placed = joined.select(*rows.columns, fixed.alias("_fixed"), F.coalesce(F.round(share, 1), F.lit(0.0)).alias("percentil"))
    relative = F.when(F.col("percentil") >= 90, 3).when(F.col("percentil") >= 75, 2).when(F.col("percentil") >= 50, 1).otherwise(0)
    name = lambda c: F.element_at(F.array(*[F.lit(b) for b in ("Baixo", "Moderado", "Alto", "Crítico")]), c + 1)
    criterion = F.when(F.col("_fixed") > relative, "absoluto").when(relative > F.col("_fixed"), "percentil").otherwise("ambos")
    return placed.select("*", name(F.col("_fixed")).alias("banda_absoluta"), name(relative).alias("banda_percentil"), name(F.greatest(F.col("_fixed"), relative)).alias("banda"), criterion.alias("criterio_banda")).drop("_fixed")


def temporal_split(rows: DataFrame, share: float = 0.8) -> DataFrame:
    """O138: the first ``share`` of the distinct weeks is for training. The cut is found on the table of weeks and joined as one row."""
    weeks = rows.select(*ORDER).distinct()
    placed = weeks.withColumn("_i", F.row_number().over(Window.orderBy(*ORDER))).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))))
    cut = placed.where(F.col("_i") == F.greatest(F.floor(F.col("_n") * share), F.lit(1))).select(F.col("epi_year").alias("_y"), F.col("epi_week").alias("_w"))
    train = (F.col("epi_year") < F.col("_y")) | ((F.col("epi_year") == F.col("_y")) & (F.col("epi_week") <= F.col("_w")))
    return rows.join(F.broadcast(cut), F.lit(True)).withColumn("treino", train).drop("_y", "_w")


def metrics(scored: DataFrame, keys: list[str], threshold: float | Column, k: int = 20, wide: int = 50) -> DataFrame:
    """O105, O142: precision, recall, Brier, AUC by rank sums, share of positives and precision among the k (and ``wide``) highest, by ``keys`` (y 0/1, prob, id).

    Rows are added up by score before any rank is taken, and the distinct scores are ranked in sorted ranges, so that a key
    of any size is no single task. Of the highest scores each task keeps ``wide`` rows before they meet."""
    by = [F.col(c) for c in keys] or [F.lit(1)]
    hit, pos = F.col("prob") >= threshold, F.col("y") == 1
    scores = scored.groupBy(*keys, "prob").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(pos).alias("_pos"), F.count_if(hit & pos).alias("_tp"), F.count_if(hit).alias("_hit"), F.sum((F.col("prob") - F.col("y")) * (F.col("prob") - F.col("y"))).alias("_miss"))
    ranked = cumulated(scores, keys, "prob", ["_n"]).withColumn("_rank", (F.col("_n_before") + (F.col("_n") + 1) / 2.0) * F.col("_pos"))
    sums = ranked.groupBy(*keys).agg(F.sum("_n").alias("n"), F.sum("_pos").alias("n_pos"), F.sum("_tp").alias("_tp"), F.sum("_hit").alias("_hit"), (F.sum("_miss") / F.sum("_n")).alias("brier"), F.sum("_rank").alias("_ranks"))
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("prob"), "id"))
    first = scored.select(*keys, "y", place.alias("_place")).where(F.col("_place") <= wide)
    share = lambda m: F.avg(F.when(F.col("_place") <= m, F.col("y").cast("double")))
    first = first.groupBy(*keys).agg(share(k).alias("precision_at_k"), share(wide).alias(f"precision_at_{wide}"))
    joined = sums.join(first, keys, "left") if keys else sums.join(F.broadcast(first), F.lit(True), "left")
    np_, nn = F.col("n_pos"), F.col("n") - F.col("n_pos")
    return joined.select(
        *keys, "n", "n_pos", F.when(F.col("_hit") > 0, F.col("_tp") / F.col("_hit")).alias("precision"), F.when(np_ > 0, F.col("_tp") / np_).alias("recall"), "brier", F.when((np_ > 0) & (nn > 0), (F.col("_ranks") - np_ * (np_ + 1) / 2) / (np_ * nn)).alias("auc"),
        "precision_at_k", f"precision_at_{wide}", (np_ / F.col("n")).alias("pos_rate"), F.col("_hit").alias("n_alerta_emitido"), F.col("_tp").alias("n_confirmado"))


#: The cut-offs that are tried.
THRESHOLDS = [round(0.05 + 0.05 * i, 2) for i in range(17)]


def best_threshold(scored: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """O141: by ``keys`` the cut-off with the highest F1, the lowest of equals. Each row counts towards every cut-off, and the counts are combined at once."""
    keys = keys or []
    cuts = F.array(*[F.lit(t) for t in THRESHOLDS])
    counts = scored.select(*keys, "y", "prob", F.explode(cuts).alias("threshold")).groupBy(*keys, "threshold").agg(F.count_if((F.col("prob") >= F.col("threshold")) & (F.col("y") == 1)).alias("tp"), F.count_if(F.col("prob") >= F.col("threshold")).alias("hit"), F.count_if(F.col("y") == 1).alias("pos"))
    f1 = F.when(F.col("hit") + F.col("pos") > 0, 2.0 * F.col("tp") / (F.col("hit") + F.col("pos"))).otherwise(0.0)
    best = counts.select(*keys, "threshold", f1.alias("f1")).groupBy(*keys).agg(F.max(F.struct(F.round("f1", 9).alias("f1"), (-F.col("threshold")).alias("t"))).alias("b"))
    return best.select(*keys, (-F.col("b.t")).alias("threshold"), F.col("b.f1").alias("f1"))


def rank_correlation(tall: DataFrame, keys: list[str], least: int = 20) -> DataFrame:
    """Spearman's coefficient of x and y by ``keys`` over rows where both are known; null where one of them has a single value.

    Equal pairs are counted first; ranks are those of distinct values in sorted ranges, so that no task sees all rows of a key."""
    pairs = written(tall.where(F.col("x").isNotNull() & F.col("y").isNotNull()).groupBy(*keys, "x", "y").agg(F.count(F.lit(1)).alias("_n")), "pairs")
    ranks = {}
    for v in ("x", "y"):
        values = pairs.groupBy(*keys, v).agg(F.sum("_n").alias("n"))
        ranks[v] = cumulated(values, keys, v, ["n"]).select(*keys, v, (F.col("n_before") + (F.col("n") + 1) / 2.0).alias(f"_r{v}"))
    sizes = pairs.groupBy(*keys).agg(F.sum("_n").alias("n"))
    ranked = pairs.join(ranks["x"], [*keys, "x"]).join(ranks["y"], [*keys, "y"]).join(sizes, keys)
    a, b = (F.col(f"_r{v}") - (F.col("n") + 1) / 2.0 for v in ("x", "y"))  # the mean of ranks is known
    total = lambda c: F.sum(c * F.col("_n"))
    sums = ranked.groupBy(*keys, "n").agg(total(a * b).alias("_ab"), total(a * a).alias("_aa"), total(b * b).alias("_bb"))
    rho = F.when((F.col("_aa") > 0) & (F.col("_bb") > 0), F.col("_ab") / F.sqrt(F.col("_aa") * F.col("_bb")))
    return sums.where(F.col("n") >= least).select(*keys, "n", rho.alias("rho"))


def climate_association(rows: DataFrame, variables: list[str], least: int = 20, known: int = 10) -> DataFrame:
    """By target and weather variable the rows that know it (at least ``least``), and Spearman's coefficient with five indicators, each over
    the rows that know both, where more than ``known`` do; a constant has none."""
    cells = F.explode(F.array(*[F.struct(F.lit(x).alias("climate_var"), F.lit(y).alias("indicador"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")) for x in variables for y in STATE])).alias("c")
    keys = ["target", "climate_var", "indicador"]
    tall = rows.select("target", cells).select("target", "c.*").where("x is not null")
    counted = tall.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_obs")).where(F.col("n_obs") >= least)
    rho = rank_correlation(tall, keys, known + 1).select(*keys, "rho")
    joined = counted.join(rho, keys, "left")
    return joined.groupBy("target", "climate_var").agg(F.max("n_obs").alias("n_obs"), *[F.max(F.when(F.col("indicador") == y, F.col("rho"))).alias(f"spearman_{y}") for y in STATE])


def lagged(rows: DataFrame, x: str, ys: list[str], keys: list[str], lags: int = 4) -> DataFrame:
    """Rows (keys…, indicador, lag, x, y) with x taken ``lag`` observed rows earlier in its town."""
    w = Window.partitionBy(*SERIES).orderBy(*ORDER)
    moved = rows.select(*keys, *ys, *[F.lag(x, k).over(w).alias(f"_x{k}") if k else F.col(x).alias("_x0") for k in range(lags + 1)])
    cells = F.explode(F.array(*[F.struct(F.lit(y).alias("indicador"), F.lit(k).cast("long").alias("lag"), F.col(f"_x{k}").cast("double").alias("x"), F.col(y).cast("double").alias("y")) for y in ys for k in range(lags + 1)])).alias("c")
    return moved.select(*keys, cells).select(*keys, "c.*")


def lagged_climate(panel: DataFrame, weather: DataFrame, variables: list[str], ys: list[str], lags: int = 4, least: int = 12) -> DataFrame:
    """Spearman's coefficient of each weather variable, up to ``lags`` of the town's observed weeks earlier, with each of ``ys``, by target: over at least
    ``least`` rows that know both and, on either side, two values. ``weather`` has municipio, epi_week (and epi_year, if the panel is to meet it by year too)."""
    when = [c for c in ORDER if c in weather.columns]
    w = Window.partitionBy("municipio").orderBy(*when)
    moved = weather.select("municipio", *when, *[F.lag(v, k).over(w).alias(f"_{v}_{k}") for v in variables for k in range(lags + 1)])
    joined = panel.select("target", "municipio", *when, *ys).join(moved, ["municipio", *when])
    cells = F.explode(F.array(*[F.struct(F.lit(v).alias("climate_var"), F.lit(y).alias("indicador"), F.lit(k).cast("long").alias("lag"), F.col(f"_{v}_{k}").cast("double").alias("x"), F.col(y).cast("double").alias("y")) for v in variables for y in ys for k in range(lags + 1)])).alias("c")
    keys = ["target", "climate_var", "indicador", "lag"]
    return rank_correlation(joined.select("target", cells).select("target", "c.*"), keys, least).where("rho is not null")
