"""The surveillance relations over the tables at hand, in DataFrames and, for the oracles, in SQL.

An order line is an exam: its part type is the target, the customer's nation the town, the
return flag the outcome (of a rejected exam it is negative), the line status the state of the exam. A sample is received after a
quarter of the days from request to release. Orders are notifications,
and costly finished ones deaths; suppliers are facilities; events are weather readings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import weeks
from ..functions.rules import first_match
from ..sources.stages import path_of

#: Target of an exam, and the disease that is notified; one target has none.
DISEASES = [("promo", "1-URGENT"), ("economy", "2-HIGH"), ("standard", "3-MEDIUM"), ("large", "4-NOT SPECIFIED"), ("small", "5-LOW")]
DEATH_PRICE = 300_000.0


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Stored bytes that one task of a large join takes; up to which a table counts as small, and its join is left to Spark.
TASK_BYTES, SMALL_BYTES = 4 << 20, 2 << 20


def stored_bytes(spark: SparkSession, sf_dir: str, name: str) -> int:
    """What a table, a file or a folder, takes in its store."""
    fs, at = path_of(spark, f"{sf_dir}/{name}.parquet")
    return fs.getContentSummary(at).getLength()


def tasks_for(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Tasks over which a table is dealt, in proportion to its size, so that the memory of one stays the same; 0 for a small one."""
    held = stored_bytes(spark, sf_dir, name)
    return 0 if held <= 2 * TASK_BYTES else max(-(-held // TASK_BYTES), spark.sparkContext.defaultParallelism)


def dealt(df: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """Rows by hash of ``keys`` over so many tasks; as they are if there are none to name."""
    return df.repartition(tasks, *keys) if tasks else df


def joined(left: DataFrame, right: DataFrame, left_key: str, right_key: str, tasks: int) -> DataFrame:
    """An equal join, both sides dealt alike over so many tasks."""
    left, right = dealt(left, tasks, left_key), dealt(right, tasks, right_key)
    return left.join(right, left[left_key] == right[right_key])


def towns(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", F.col("n_name").alias("municipio"), F.col("r_name").alias("regional"))


def requests(spark: SparkSession, sf_dir: str, district: bool = False) -> DataFrame:
    """Orders with the town of their customer; as ``district`` each customer is a town of its own."""
    orders, customer = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name")
    tasks = tasks_for(spark, sf_dir, "orders") if stored_bytes(spark, sf_dir, "customer") > SMALL_BYTES else 0
    found = joined(orders, customer, "o_custkey", "c_custkey", tasks).join(towns(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
    return (found.withColumn("municipio", F.col("c_name")) if district else found).drop("c_name")


def asked_lines(spark: SparkSession, sf_dir: str, line: DataFrame, asked: DataFrame) -> DataFrame:
    """Order lines with their part and their order. Where the lines are many, they are dealt over as many tasks as their size asks for, those of an order
    together: what counts or compares the lines of an order needs no other shuffle."""
    part, tasks = read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand"), tasks_for(spark, sf_dir, "lineitem")
    typed = joined(line, part, "l_partkey", "p_partkey", (tasks + 1) // 2 if stored_bytes(spark, sf_dir, "part") > SMALL_BYTES else 0)  # nothing is grouped here
    return joined(typed, asked, "l_orderkey", "o_orderkey", tasks)


def exams(spark: SparkSession, sf_dir: str, district: bool = False) -> DataFrame:
    line = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate", "l_quantity")
    asked = requests(spark, sf_dir, district).select("o_orderkey", "municipio", "regional", "o_orderdate")
    released, asked_on = F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date")
    received = F.date_add(asked_on, F.floor(F.datediff(released, asked_on) / 4).cast("int"))
    return asked_lines(spark, sf_dir, line, asked).select(
        F.col("l_orderkey").alias("record_id"), F.col("l_linenumber").cast("long").alias("field_index"), "municipio", "regional",
        F.lower("p_type").alias("target"), F.col("p_brand").alias("exame"), released.alias("event_date"), asked_on.alias("dt_coleta"), received.alias("dt_recebimento"),
        F.when(F.col("l_returnflag") == "R", "positive").when(F.col("l_returnflag") == "A", "negative").otherwise("inconclusive").alias("outcome"),
        F.when(F.col("l_linestatus") == "F", "liberado").otherwise("pendente").alias("status"), (F.col("l_returnflag") == "A").alias("rejeitado"), F.year(released).cast("long").alias("year"),
        weeks.epi_year(released).alias("epi_year"), weeks.epi_week(released).alias("epi_week"), "l_quantity",
    )


#: The arbovirus that a part type stands for, and the method by the supplier's number modulo four.
ARBOVIRUSES = [("promo", "dengue"), ("economy", "zika"), ("standard", "chikungunya")]
METHODS = ["RT-PCR em tempo real", "Enzimaimunoensaio IgM", "IgG", "Teste rápido"]


def result_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as fields of long results: an order is the request, its open and its closed lines two samples of the order's day, the supplier's
    number the method, the return flag the value, which is positive but for 'A'."""
    line = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity")
    asked = requests(spark, sf_dir).select("o_orderkey", "municipio", "o_orderdate", "o_orderpriority")
    method = F.element_at(F.array(*[F.lit(m) for m in METHODS]), (F.col("l_suppkey") % 4 + 1).cast("int"))
    return asked_lines(spark, sf_dir, line, asked).select(
        F.col("l_orderkey").alias("record_id"), F.col("l_linenumber").cast("long").alias("field_index"), F.col("l_orderkey").alias("requisicao"), F.concat("l_orderkey", F.lit("-"), "l_linestatus").alias("codigo_amostra"),
        F.col("o_orderdate").cast("date").alias("event_date"), "municipio", first_match(F.lower("p_type"), ARBOVIRUSES, F.lit("outro")).alias("target"), F.col("o_orderpriority").alias("agravo"), F.col("p_brand").alias("exame"), method.alias("metodologia"),
        F.lit("resultado").alias("field_label"), F.concat(F.lit("reagente "), "l_returnflag").alias("field_value"), (F.col("l_quantity") > 5).alias("field_has_real_value"), (F.col("l_quantity") < 48).alias("is_released"),
        (F.col("l_returnflag") != "A").alias("is_positive_like"), F.when(F.col("l_linenumber") == 7, "observation").otherwise("qualitative_result").alias("measure_role"),
    )


def notifications(spark: SparkSession, sf_dir: str, district: bool = False) -> DataFrame:
    d = F.col("o_orderdate").cast("date")
    return requests(spark, sf_dir, district).select("municipio", F.col("o_orderpriority").alias("agravo"), d.alias("event_date"), weeks.epi_year(d).alias("epi_year"), weeks.epi_week(d).alias("epi_week"), "o_orderstatus", (F.col("o_orderstatus") == "F").alias("encerrado"), "o_totalprice", "c_nationkey", "o_custkey")


def deaths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notifications(spark, sf_dir).where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > DEATH_PRICE))


def disease_of(target):
    return first_match(target, DISEASES, F.lit(""))


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(municipio, ano, populacao) for 1995 to 2001; one town is not in it."""
    people = read(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    known = people.join(towns(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")).where("n_nationkey != 24")
    known = known.select("municipio", "n", F.explode(F.sequence(F.lit(1995).cast("long"), F.lit(2001).cast("long"))).alias("ano"))
    return known.select("municipio", "ano", (1000 * F.col("n") + 10 * (F.col("ano") - 1995)).cast("long").alias("populacao"))


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    return towns(spark, sf_dir).select(
        "municipio", "regional", (-19.0 + (k % 11) * 0.9).alias("latitude"), (-63.0 + (k * 7 % 12) * 0.8).alias("longitude"),
        (0.6 + 0.01 * (k % 20)).alias("idh"), (0.4 + 0.005 * (k % 17)).alias("gini"), ((k * 3 % 23) / 100.0).alias("extrema_pobreza_pct"), (1000.0 + 37.0 * k).alias("pea_2010"),
    )


def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = read(spark, sf_dir, "supplier")
    return supplier.join(towns(spark, sf_dir), supplier.s_nationkey == F.col("n_nationkey")).select("municipio", "s_suppkey", "s_acctbal")


def capacity_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Facilities, beds, equipment and teams: a supplier's balance says how many it has, and of what kind."""
    f = facilities(spark, sf_dir)
    bal = F.col("s_acctbal")
    all_beds, intensive = F.floor(F.greatest(bal, F.lit(0.0)) / 100).cast("long"), F.when(bal > 5000, F.floor(bal / 1000)).otherwise(0).cast("long")
    kinds = F.explode(F.array(F.struct(F.lit("UTI adulto").alias("tipo"), intensive.alias("existentes")), F.struct(F.lit("Clínico").alias("tipo"), (all_beds - intensive).alias("existentes"))))
    beds = f.select("municipio", kinds.alias("k")).select("municipio", "k.tipo", "k.existentes", F.col("k.existentes").alias("sus"))
    equipment = f.select("municipio", F.when(bal < 0, "Ventilador").otherwise("Mesa").alias("tipo"), F.lit(1).cast("long").alias("existentes"), (F.col("s_suppkey") % 2).alias("uso"))
    teams = f.select("municipio", F.when(F.col("s_suppkey") % 3 == 0, "ESF").otherwise("EAP").alias("tipo"), F.lit(1).cast("long").alias("quantidade"))
    return f, beds, equipment, teams


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather: town by number of user, week of the reading, value, severity."""
    events = read(spark, sf_dir, "events")
    d = F.col("ts").cast("date")
    severity = F.when(F.col("event_type") == "error", 3).when(F.col("event_type") == "purchase", 2).when(F.col("event_type") == "signup", 1).otherwise(0).cast("long")
    return events.select((F.col("user_id") % 25).alias("n_nationkey"), "event_id", "event_type", "value", "ts", weeks.epi_year(d).alias("epi_year"), weeks.epi_week(d).alias("epi_week"), severity.alias("severidade"))


EXAM = """exam AS (
  SELECT l_orderkey AS record_id, CAST(l_linenumber AS BIGINT) AS field_index, n_name AS municipio, r_name AS regional, lower(p_type) AS target, p_brand AS exame,
    CAST(l_shipdate AS DATE) AS event_date, CAST(o_orderdate AS DATE) AS dt_coleta,
    CAST(o_orderdate AS DATE) + CAST(floor((CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE)) / 4) AS INTEGER) AS dt_recebimento, l_returnflag = 'A' AS rejeitado,
    CASE l_returnflag WHEN 'R' THEN 'positive' WHEN 'A' THEN 'negative' ELSE 'inconclusive' END AS outcome,
    CASE l_linestatus WHEN 'F' THEN 'liberado' ELSE 'pendente' END AS status, year(l_shipdate) AS year,
    isoyear(l_shipdate) AS epi_year, week(l_shipdate) AS epi_week, l_quantity
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
_ARBO = "CASE " + " ".join(f"WHEN lower(p_type) LIKE '%{t}%' THEN '{d}'" for t, d in ARBOVIRUSES) + " END"
ARBO_POSITIVE = f"""pos0 AS (
  SELECT l_orderkey AS record_id, CAST(l_linenumber AS BIGINT) AS field_index, l_orderkey AS requisicao, l_orderkey || '-' || l_linestatus AS codigo_amostra, CAST(o_orderdate AS DATE) AS event_date, n_name AS municipio, {_ARBO} AS target,
    o_orderpriority AS agravo, p_brand AS exame, {METHODS}[l_suppkey % 4 + 1] AS metodologia, 'reagente ' || l_returnflag AS field_value,
    ['aguda_confirmatoria', 'aguda_provavel', 'exposicao_previa', 'positivo_sem_classificacao'][l_suppkey % 4 + 1] AS classe_positividade
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE {_ARBO} IS NOT NULL AND l_quantity < 48 AND l_quantity > 5 AND l_returnflag <> 'A' AND l_linenumber <> 7),
pos AS (SELECT * FROM pos0 QUALIFY row_number() OVER (PARTITION BY record_id, target, exame, metodologia, field_value, classe_positividade ORDER BY field_index, codigo_amostra) = 1)"""
NOTIF = """notif AS (
  SELECT n_name AS municipio, o_orderpriority AS agravo, CAST(o_orderdate AS DATE) AS event_date, isoyear(o_orderdate) AS epi_year, week(o_orderdate) AS epi_week,
    o_orderstatus, o_totalprice, c_nationkey, o_custkey
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
DEATHS = f"obito AS (SELECT * FROM notif WHERE o_orderstatus = 'F' AND o_totalprice > {DEATH_PRICE})"
POPULATION = """pop AS (
  SELECT n_name AS municipio, ano, CAST(1000 * n + 10 * (ano - 1995) AS BIGINT) AS populacao
  FROM (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) JOIN nation ON c_nationkey = n_nationkey, (SELECT unnest(range(1995, 2002)) AS ano) WHERE n_nationkey <> 24)"""
MASTER = """master AS (
  SELECT n_name AS municipio, r_name AS regional, CAST(-19.0 AS DOUBLE) + (n_nationkey % 11) * CAST(0.9 AS DOUBLE) AS latitude, CAST(-63.0 AS DOUBLE) + (n_nationkey * 7 % 12) * CAST(0.8 AS DOUBLE) AS longitude,
    CAST(0.6 AS DOUBLE) + CAST(0.01 AS DOUBLE) * (n_nationkey % 20) AS idh, CAST(0.4 AS DOUBLE) + CAST(0.005 AS DOUBLE) * (n_nationkey % 17) AS gini,
    (n_nationkey * 3 % 23) / CAST(100 AS DOUBLE) AS extrema_pobreza_pct, CAST(1000 AS DOUBLE) + 37 * n_nationkey AS pea_2010
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""
FACILITY = "facility AS (SELECT n_name AS municipio, s_suppkey, s_acctbal FROM supplier JOIN nation ON s_nationkey = n_nationkey)"
READING = """reading AS (
  SELECT user_id % 25 AS n_nationkey, event_id, event_type, value, ts, isoyear(ts) AS epi_year, week(ts) AS epi_week,
    CAST(CASE event_type WHEN 'error' THEN 3 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 1 ELSE 0 END AS BIGINT) AS severidade FROM events)"""
WEEKLY = """weekly AS (
  SELECT target, municipio, epi_year, epi_week, count(DISTINCT record_id) AS tests,
    least(count(DISTINCT record_id), count(*) FILTER (outcome = 'positive')) AS positives, count(*) FILTER (outcome = 'negative') AS negatives
  FROM exam GROUP BY ALL)"""
DISEASE = "CASE " + " ".join(f"WHEN target LIKE '%{t}%' THEN '{d}'" for t, d in DISEASES) + " ELSE '' END"


def wilson_sql(pos: str, n: str) -> tuple[str, str]:
    p, z = f"(CAST({pos} AS DOUBLE) / {n})", "1.96::DOUBLE"
    center = f"(({p} + {z} * {z} / (2 * {n})) / (1 + {z} * {z} / {n}))"
    half = f"({z} * sqrt(({p} * (1 - {p}) + {z} * {z} / (4.0::DOUBLE * {n})) / {n}) / (1 + {z} * {z} / {n}))"
    return f"CASE WHEN {n} > 0 THEN greatest({center} - {half}, 0) END", f"CASE WHEN {n} > 0 THEN least({center} + {half}, 1) END"


def poisson_sql(count: str, pop: str) -> tuple[str, str]:
    error = f"(1.96::DOUBLE * (CASE WHEN {count} > 0 THEN sqrt({count}::DOUBLE) ELSE 1 END) / {pop})"
    rate = f"({count}::DOUBLE / {pop})"
    return f"CASE WHEN {pop} > 0 THEN greatest({rate} - {error}, 0) * 100000 END", f"CASE WHEN {pop} > 0 THEN ({rate} + {error}) * 100000 END"


def robust_z_sql(relation: str, columns: dict[str, str], keys: str, out: str) -> str:
    """CTEs that add robust z-scores of ``columns`` by ``keys`` to ``relation`` as ``out``."""
    med = ", ".join(f"median({c}) OVER w AS med_{c}" for c in columns)
    mad = ", ".join(f"median(abs({c} - med_{c})) OVER w AS mad_{c}" for c in columns)
    z = ", ".join(f"CASE WHEN mad_{c} > 0 THEN 0.6745::DOUBLE * ({c} - med_{c}) / mad_{c} WHEN stddev_pop({c}) OVER w > 1e-12 THEN ({c} - avg({c}) OVER w) / stddev_pop({c}) OVER w ELSE 0 END AS {z}" for c, z in columns.items())
    drop = ", ".join(f"med_{c}, mad_{c}" for c in columns)
    return f"{out}_1 AS (SELECT *, {med} FROM {relation} WINDOW w AS (PARTITION BY {keys})), {out}_2 AS (SELECT *, {mad} FROM {out}_1 WINDOW w AS (PARTITION BY {keys})), {out} AS (SELECT * EXCLUDE ({drop}), {z} FROM {out}_2 WINDOW w AS (PARTITION BY {keys}))"
