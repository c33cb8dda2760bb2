"""Queries of the emergency card, of demographic tables, of weather with a delay and of panels under other names, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import measures, rules, text, weeks
from ..operators import aggregates, emergency, models, normalise, panel, predict, pressure, selection
from ..sources import tables
from ..sources.stages import written
from ..streaming import weekly as stream
from . import bindings as b
from .decisions import _CARD, _FAMILIES, _FAMILY, _NORMS, _SPEAR, _pressure_sql, card_of
from .learning import _WEATHER, weather_of
from .registry import query
from .surveillance import _NET, _TAT, PANEL, network_of, panel_of, rounded, scored_of

_BASE = """pc AS (SELECT *, CASE WHEN sla_crise AND faixa_pressao = 'critica' THEN 'CRÍTICO' WHEN sla_crise OR silencio_gal_vs_vizinhos OR silencio_gal_alerta OR divergente THEN 'ALTO' WHEN faixa_pressao IN ('alta', 'critica') THEN 'MODERADO' ELSE 'MONITORAMENTO' END AS p0,
  CASE WHEN sla_crise THEN 'risco' WHEN silencio_gal_alerta THEN 'silencio' WHEN divergente THEN 'utilizacao' WHEN faixa_pressao IN ('critica', 'alta') THEN 'risco' ELSE 'padrao' END AS sinal FROM card)"""
_FIELD = {f: "CASE protocolo " + " ".join(f"WHEN '{p[0]}' THEN '{p[k]}'" for p in rules.PROTOCOLS) + " END" for k, f in ((1, "responsavel"), (2, "prazo"), (3, "acao"), (4, "checklist"))}
_OF = {p[0]: p for p in rules.PROTOCOLS}


@query(f"""WITH {_CARD}, {_BASE}, norms AS (SELECT municipio, {_NORMS} FROM network), fam AS (SELECT * FROM scored), {_pressure_sql('municipio', '', 0.5)}, lp AS (SELECT * FROM pp QUALIFY row_number() OVER (PARTITION BY municipio ORDER BY epi_year DESC, epi_week DESC) = 1),
ps AS (SELECT municipio, round(1 / (1 + exp(-greatest(least(-1.8::DOUBLE + 2.5::DOUBLE * coalesce(indice_pressao_proxy, 0) / 100 + 0.8::DOUBLE * coalesce(tests_pct_estadual, 0) + 0.35::DOUBLE * tanh(coalesce(tests_ma4 - tests_ma8, 0) / 10), 20), -20))), 4) >= 0.40 AS up FROM lp),
pk AS (SELECT *, CASE WHEN sla_crise THEN 'emergencia' ELSE sinal END AS protocolo, coalesce(up, false) AS pressao_predita_acima_limiar FROM pc LEFT JOIN ps USING (municipio)),
p1 AS (SELECT *, CASE WHEN pressao_predita_acima_limiar AND p0 = 'MONITORAMENTO' THEN 'MODERADO' ELSE p0 END AS p1 FROM pk)
SELECT municipio, sinal, protocolo, pressao_predita_acima_limiar, CASE WHEN pressao_predita_acima_limiar AND p1 = 'MODERADO' AND faixa_pressao IN ('alta', 'critica') THEN 'ALTO' ELSE p1 END AS prioridade,
  CASE WHEN silencio_gal_alerta THEN '{_OF["silencio"][2]}' WHEN sla_crise THEN '24–48h' ELSE {_FIELD["prazo"]} END AS prazo_acao, CASE WHEN silencio_gal_alerta THEN '{_OF["silencio"][1]}' WHEN sla_crise THEN '{_OF["risco"][1]}' ELSE {_FIELD["responsavel"]} END AS responsavel,
  CASE WHEN silencio_gal_alerta THEN '{rules.SILENCE_ACTION}' WHEN sla_crise THEN '{rules.CRISIS_ACTION[0]}' ELSE {_FIELD["acao"]} END AS acao_sugerida, CASE WHEN sla_crise THEN '{rules.CRISIS_ACTION[1]}' ELSE {_FIELD["checklist"]} END AS checklist_operacional FROM p1""")
def emergency_card(spark, sf_dir):
    """O116, O120: priorities with their protocols and what a crisis or a silence changes in them, raised where the pressure predicted for the next week is high."""
    latest = models.pressure_logit(predict.latest(pressure.pressure_panel(scored_of(spark, sf_dir), network_of(spark, sf_dir)), ["municipio"]))
    predicted = latest.select("municipio", (F.round("prob", 4) >= 0.40).alias("pressao_predita_acima_limiar"))
    card = emergency.escalated(emergency.protocolled(emergency.priority(card_of(spark, sf_dir))), predicted)
    return card.select("municipio", "sinal", "protocolo", "pressao_predita_acima_limiar", "prioridade", "prazo_acao", "responsavel", "acao_sugerida", "checklist_operacional")


@query(f"""WITH {_TAT}, fm AS (SELECT {_FAMILY} AS familia, {_NET} FROM tat GROUP BY 1), q AS (SELECT coalesce(quantile_cont(pct_liberado_48h, 0.25), 0.5) AS q48, coalesce(quantile_cont(tat_p90_dias, 0.75), 90) AS p75 FROM fm)
SELECT familia, exames, pct_liberado_48h, tat_p90_dias, coalesce(pct_liberado_48h <= q48, false) OR coalesce(tat_p90_dias, 0) >= p75 AS sla_crise FROM fm, q""")
def family_crisis(spark, sf_dir):
    """O118: by family."""
    family = rules.family(F.col("target"), "outros", _FAMILIES)
    net = rounded(aggregates.network(aggregates.turnaround(b.exams(spark, sf_dir)).withColumn("familia", family), ["familia"]))
    return emergency.family_crisis(net).select("familia", "exames", "pct_liberado_48h", "tat_p90_dias", "sla_crise")


#: What a market segment, a priority and a state stand for: sex, race and the text of the disease, schooling.
_TEXTS = {"1-URGENT": "Dengue clássica", "2-HIGH": "Hepatite B", "3-MEDIUM": "Tuberculose pulmonar", "4-NOT SPECIFIED": "", "5-LOW": "Influenza A"}
_RACES = {"1-URGENT": "Parda", "2-HIGH": "branca ", "3-MEDIUM": "Indígena", "4-NOT SPECIFIED": "?", "5-LOW": "PRETA"}


def _pick(column, table):
    return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), column)


def persons_of(spark, sf_dir, rows):
    """Notifications with the person's attributes as raw texts; the age is the customer's number modulo 95."""
    customer = b.read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    joined = rows.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("municipio", "event_date", _pick(F.col("agravo"), _TEXTS).alias("agravo_texto"), F.initcap("c_mktsegment").alias("sexo"), _pick(F.col("agravo"), _RACES).alias("raca_cor"), F.col("o_orderstatus").alias("escolaridade"), (F.col("o_custkey") % 95).cast("double").alias("idade"))


_CASES = lambda table, column: "CASE agravo " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + " END"
_AGE = "CASE WHEN i < 1 THEN '<1' " + " ".join(f"WHEN i <= {top} THEN '{n}'" for top, n in text.AGE_GROUPS) + " ELSE '80+' END"
_TARGET_OF = {"1-URGENT": "dengue", "2-HIGH": "hepatite_b_hbv", "3-MEDIUM": "tuberculose", "4-NOT SPECIFIED": "nao_classificado", "5-LOW": "influenza_a"}
_RACE_OF = {"1-URGENT": "PARDA", "2-HIGH": "BRANCA", "3-MEDIUM": "INDIGENA", "4-NOT SPECIFIED": "IGNORADO", "5-LOW": "PRETA"}
_PERSON = f"""pe AS (SELECT year(event_date) AS ano, {_CASES(_TARGET_OF, 'agravo')} AS target, municipio, CASE WHEN c_mktsegment LIKE 'F%' THEN 'FEMININO' WHEN c_mktsegment LIKE 'M%' THEN 'MASCULINO' ELSE 'IGNORADO' END AS sexo, o_custkey % 95 AS i, {_CASES(_RACE_OF, 'agravo')} AS raca_cor, o_orderstatus AS escolaridade
  FROM {{source}} JOIN customer ON o_custkey = c_custkey), g AS (SELECT ano, target, municipio, sexo, {_AGE} AS faixa_etaria, raca_cor, escolaridade FROM pe) SELECT *, count(*) AS {{name}} FROM g GROUP BY ALL"""


@query(f"WITH {b.NOTIF}, {_PERSON.format(source='notif', name='notificacoes')}")
def notified_by_person(spark, sf_dir):
    """By seven keys."""
    return aggregates.by_person(persons_of(spark, sf_dir, b.notifications(spark, sf_dir)))


@query(f"WITH {b.NOTIF}, {b.DEATHS}, {_PERSON.format(source='obito', name='obitos')}")
def deaths_by_person(spark, sf_dir):
    """By seven keys."""
    return aggregates.by_person(persons_of(spark, sf_dir, b.deaths(spark, sf_dir)), "obitos")


@query("""WITH d AS (SELECT o_orderpriority AS p, CAST(o_orderdate AS DATE) AS d FROM orders), few AS (SELECT make_date(year(d), 7, 1) AS e FROM d), most AS (SELECT d AS e FROM d WHERE p <> '1-URGENT')
SELECT 'poucas datas' AS fonte, isoyear(e) AS epi_year, week(e) AS epi_week, count(*) AS obitos FROM few GROUP BY ALL UNION ALL SELECT 'quase todas', isoyear(e), week(e), count(*) FROM most GROUP BY ALL""")
def deaths_without_dates(spark, sf_dir):
    """A source that mostly lacks dates (only urgent orders have one) counts at mid-year; one that mostly has them loses the rows without."""
    orders = b.read(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("ano"), F.col("o_orderdate").cast("date").alias("d"), (F.col("o_orderpriority") == "1-URGENT").alias("u"))
    out = None
    for name, known in (("poucas datas", F.col("u")), ("quase todas", ~F.col("u"))):
        dated = aggregates.with_fallback_date(orders.select("ano", F.when(known, F.col("d")).alias("event_date")))
        counted = dated.groupBy(F.lit(name).alias("fonte"), weeks.epi_year(F.col("event_date")).alias("epi_year"), weeks.epi_week(F.col("event_date")).alias("epi_week")).agg(F.count(F.lit(1)).alias("obitos"))
        out = counted if out is None else out.unionByName(counted)
    return out


_VARIABLES = ["temperature_2m_max", "precipitation_sum_mm", "n_eventos_climaticos"]


@query(f"""WITH {PANEL}, {b.READING}, {_WEATHER}, wl AS (SELECT municipio, epi_week, {", ".join(f"lag({v}, {k}) OVER (PARTITION BY municipio ORDER BY epi_week) AS {v}_{k}" for v in _VARIABLES for k in range(5))} FROM wt),
t AS ({" UNION ALL ".join(f"SELECT target, '{v}' AS climate_var, '{y}' AS indicador, {k}::BIGINT AS lag, {v}_{k}::DOUBLE AS x, {y}::DOUBLE AS y FROM panel JOIN wl USING (municipio, epi_week)" for v in _VARIABLES for y in ("tests", "positividade") for k in range(5))}), v AS (SELECT * FROM t WHERE x IS NOT NULL AND y IS NOT NULL),
r AS (SELECT *, {_SPEAR.format(k="target, climate_var, indicador, lag", c="x")} AS rx, {_SPEAR.format(k="target, climate_var, indicador, lag", c="y")} AS ry FROM v)
SELECT target, climate_var, indicador, lag, count(*) AS n, round(corr(rx, ry), 6) AS rho FROM r GROUP BY ALL HAVING count(*) >= 12 AND count(DISTINCT rx) > 1 AND count(DISTINCT ry) > 1""")
def lagged_climate(spark, sf_dir):
    """The town's weather up to four weeks earlier against exams and positivity; a single value on either side gives no row."""
    found = predict.lagged_climate(panel_of(spark, sf_dir), weather_of(spark, sf_dir), _VARIABLES, ["tests", "positividade"])
    return rounded(found)


_OTHER = "SELECT target AS alvo, 'Município de ' || municipio AS mun, epi_year AS ano, epi_week AS semana, tests AS exames, positives AS detectados, CAST(notificacoes AS VARCHAR) AS casos, obitos AS mortes, populacao AS pop FROM panel"


@query(f"""WITH {PANEL}, o AS (SELECT target, municipio, epi_year, epi_week, tests::DOUBLE AS tests, positives::DOUBLE AS positives, notificacoes::DOUBLE AS notificacoes, obitos::DOUBLE AS obitos, populacao::DOUBLE AS populacao, CASE WHEN tests <> 0 THEN positives / tests::DOUBLE END AS positividade, 1 AS g FROM panel),
{b.robust_z_sql('o', {'tests': 'zt', 'positividade': 'zp', 'notificacoes': 'zn'}, 'g', 'oz')}
SELECT target, municipio, epi_year, epi_week, tests, positives, notificacoes, obitos, populacao, round(positividade, 9) AS positividade, round(CASE WHEN populacao > 0 THEN notificacoes / populacao * 1e5 END, 9) AS incidencia_100k, round((zt + zp + zn) / 3, 9) AS risco_composto, printf('%04d-SE%02d', epi_year, epi_week) AS periodo, CAST(CAST(epi_year || '-01-04' AS DATE) - CAST(isodow(CAST(epi_year || '-01-04' AS DATE)) - 1 AS INTEGER) + CAST(7 * (epi_week - 1) AS INTEGER) AS VARCHAR) AS periodo_data FROM oz""")
def harmonised(spark, sf_dir):
    """O40, O146: the panel under other names, some of its numbers as text, without positivity, rates or risk."""
    p = panel_of(spark, sf_dir)
    other = written(p.select(F.col("target").alias("alvo"), F.concat(F.lit("Município de "), "municipio").alias("mun"), F.col("epi_year").alias("ano"), F.col("epi_week").alias("semana"), F.col("tests").alias("exames"), F.col("positives").alias("detectados"), F.col("notificacoes").cast("string").alias("casos"), F.col("obitos").alias("mortes"), F.col("populacao").alias("pop")), "other-names")
    found = panel.harmonise(other).withColumn("periodo_data", F.col("periodo_data").cast("string"))
    return rounded(found.select("target", F.regexp_replace("municipio", "^MUNICIPIO DE ", "").alias("municipio"), "epi_year", "epi_week", "tests", "positives", "notificacoes", "obitos", "populacao", "positividade", "incidencia_100k", "risco_composto", "periodo", "periodo_data"), 9)


@query(f"WITH {b.EXAM}, {b.WEEKLY} SELECT target, epi_year AS ano, sum(tests)::DOUBLE AS testes, sum(positives)::DOUBLE AS positivos, 0.0::DOUBLE AS notificacoes, 0.0::DOUBLE AS obitos, round(sum(positives) / sum(tests)::DOUBLE, 6) AS positividade_media, NULL::DOUBLE AS incidencia_100k, NULL::DOUBLE AS risco_max FROM weekly GROUP BY 1, 2")
def harmonised_annual(spark, sf_dir):
    """O146: the yearly form; what isn't there is 0 or unknown."""
    year = aggregates.weekly(b.exams(spark, sf_dir)).groupBy(F.col("target").alias("agravo"), F.col("epi_year").alias("year")).agg(F.sum("tests").alias("solicitacoes"), F.sum("positives").alias("positives"))
    return rounded(panel.harmonise_annual(year))


@query("""WITH p AS (SELECT o_orderkey AS record_id, o_orderstatus AS s, o_orderpriority AS o FROM orders UNION ALL SELECT o_orderkey, '~', o_orderpriority FROM orders WHERE o_orderstatus = 'F'), d AS (SELECT record_id, min((s, o)) AS m FROM p GROUP BY 1)
SELECT m[1] AS sexo, count(*) AS exames FROM lineitem JOIN d ON l_orderkey = record_id GROUP BY 1""")
def exams_with_persons(spark, sf_dir):
    """Attributes by record, of which some records have two sets: no exam is doubled."""
    orders = b.read(spark, sf_dir, "orders")
    people = orders.select(F.col("o_orderkey").alias("record_id"), F.col("o_orderstatus").alias("sexo"), F.col("o_orderpriority").alias("raca"))
    people = people.unionByName(people.where("sexo = 'F'").withColumn("sexo", F.lit("~")))
    return normalise.with_demographics(b.exams(spark, sf_dir), people).groupBy("sexo").agg(F.count(F.lit(1)).alias("exames"))


@query("SELECT p_brand AS marca, p_partkey, round(CASE WHEN max(p_retailprice) OVER w > min(p_retailprice) OVER w THEN 7 + (p_retailprice - min(p_retailprice) OVER w) / (max(p_retailprice) OVER w - min(p_retailprice) OVER w) * 17 ELSE 15.5 END, 6) AS tamanho FROM part WINDOW w AS (PARTITION BY p_brand)")
def marker_sizes(spark, sf_dir):
    """Values scaled to sizes from 7 to 24."""
    return rounded(b.read(spark, sf_dir, "part").select(F.col("p_brand").alias("marca"), "p_partkey", measures.min_max(F.col("p_retailprice"), 7.0, 24.0, ["p_brand"]).alias("tamanho")))


@query("SELECT count(*) AS n, count(DISTINCT o_orderkey) AS chaves, CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS primeira, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS ultima, count(*) FILTER (o_orderpriority = '1-URGENT') AS mojibake FROM orders")
def raw_columns(spark, sf_dir):
    """Orders as a CSV beside no Parquet, under names that are nearly the canonical ones, dates in three spellings, texts whose UTF-8 was read as Latin-1."""
    base = f"{stream.work_folder(spark, 'raw')}/exames"
    orders = b.read(spark, sf_dir, "orders")
    d = F.col("o_orderdate").cast("date")
    spelled = F.when(F.col("o_orderkey") % 3 == 0, F.date_format(d, "yyyyMMdd")).when(F.col("o_orderkey") % 3 == 1, F.date_format(d, "yyyy-MM-dd")).otherwise(F.date_format(d, "dd/MM/yyyy"))
    broken = F.when(F.col("o_orderpriority") == "1-URGENT", "MunicÃ­pio").otherwise("Outro")
    orders.select(F.col("o_orderkey").cast("string").alias("SEQUENCIAL"), spelled.alias("Data Coleta"), broken.alias("Município")).write.option("header", True).option("sep", ";").csv(f"{base}.csv")
    raw = tables.scan_table(spark, base, ["SEQUENCIAL", "Data Coleta", "Município"])
    named = tables.resolve(raw, {"sequencial": [], "data_coleta": ["DATA COLETA"], "municipio": ["municipio"], "falta": []})
    day = text.date_of(F.col("data_coleta"))
    return named.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("sequencial").alias("chaves"), F.min(day).cast("string").alias("primeira"), F.max(day).cast("string").alias("ultima"), F.count_if(text.fix_mojibake(F.col("municipio")) == "Município").alias("mojibake"))


#: Groups of the targets at hand.
_GROUPS = {"Promoções": ["promo"], "Tamanhos": ["large", "medium", "small"]}


@query(f"""WITH {PANEL}, s AS (SELECT * FROM panel WHERE (target LIKE '%large%' OR target LIKE '%medium%' OR target LIKE '%small%') AND municipio IN ('NATION_3', 'NATION_7', 'NATION_11') AND epi_year BETWEEN 1997 AND 1999 AND epi_week BETWEEN 10 AND 30)
SELECT epi_year, epi_week, target, sum(tests)::BIGINT AS tests, sum(positives)::BIGINT AS positives, sum(notificacoes)::BIGINT AS notificacoes, sum(obitos)::BIGINT AS obitos, round(avg(incidencia_100k), 6) AS incidencia_100k, round(sum(positives) / sum(tests)::DOUBLE, 6) AS positividade FROM s GROUP BY ALL""")
def selected_series(spark, sf_dir):
    """The series of a group of targets in three towns, some weeks of three years: what is asked for is what the operator is for."""
    chosen = selection.selected(panel_of(spark, sf_dir), "Tamanhos", ["NATION_3", "NATION_7", "NATION_11"], years=(1997, 1999), weeks=(10, 30), groups=_GROUPS)
    return rounded(selection.series(chosen))


@query(f"WITH {b.EXAM}, {b.WEEKLY}, t AS (SELECT target, sum(tests) AS n FROM weekly GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5) SELECT target, epi_year, sum(tests)::BIGINT AS tests, sum(positives)::BIGINT AS positives, round(sum(positives) / sum(tests)::DOUBLE, 6) AS positividade, any_value(n)::BIGINT AS tests_total FROM weekly JOIN t USING (target) GROUP BY 1, 2")
def annual_top_targets(spark, sf_dir):
    """O89, O104: the years of the five targets with the most exams."""
    return rounded(selection.annual_top(aggregates.weekly(b.exams(spark, sf_dir))))


@query(f"WITH {b.READING}, {_WEATHER} SELECT epi_week, round(avg(temperature_2m_max), 6) AS temperature_2m_max, round(avg(precipitation_sum_mm), 6) AS precipitation_sum_mm, round(avg(n_eventos_climaticos), 6) AS n_eventos_climaticos FROM wt GROUP BY 1")
def climate_series(spark, sf_dir):
    """O89."""
    return rounded(selection.climate_series(weather_of(spark, sf_dir), _VARIABLES))
