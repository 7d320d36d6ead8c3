"""The health analyses on inputs that Spark derives from the driver tables.

Nations stand for provinces and world regions for regions; an order is a case,
its status the gender and its customer's segment the age band; customers are
the population; ordered parts are the causes of death.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episeries.functions import domains as d
from episeries.plans import analyses, ingest
from episeries.workloads.registry import last_days, rounded, table, workload

AS_OF = "2000-06-15"

# --- derived inputs ---------------------------------------------------------

BANDS = {"MACHINERY": "0-9", "FURNITURE": "20-29", "BUILDING": "40-49", "AUTOMOBILE": "60-69"}
FIVE_YEARS = {
    "MACHINERY": ("De 0 a 4 años", "De 5 a 9 años"),
    "FURNITURE": ("De 20 a 24 años", "De 25 a 29 años"),
    "BUILDING": ("De 40 a 44 años", "De 45 a 49 años"),
    "AUTOMOBILE": ("De 60 a 64 años", "De 65 a 69 años"),
    "HOUSEHOLD": ("De 80 a 84 años", "90 y más años"),
}


def places(spark, sf) -> DataFrame:
    """Nation key, province and region."""
    return table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(
        "n_nationkey", F.col("n_name").alias("province"), F.col("r_name").alias("autonomous_region")
    )


def provinces(spark, sf) -> DataFrame:
    return places(spark, sf).select(
        F.col("province").alias("iso"), F.col("autonomous_region").alias("comunidad autónoma")
    )


def daily_counts(spark, sf) -> DataFrame:
    """One case per order; priorities tell how it went."""
    band = F.coalesce(
        F.try_element_at(
            F.create_map(*[F.lit(x) for pair in BANDS.items() for x in pair]),
            F.col("c_mktsegment"),
        ),
        F.lit("80+"),
    )
    priority = F.col("o_orderpriority")
    return (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("n_name").alias("provincia_iso"),
            F.when(F.col("o_orderstatus") == "F", "H").when(F.col("o_orderstatus") == "O", "M")
            .otherwise("NC").alias("sexo"),
            F.when(F.col("c_custkey") % 40 == 0, "NC").otherwise(band).alias("grupo_edad"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("fecha"),
            F.lit(1).cast("long").alias("num_casos"),
            (priority == "1-URGENT").cast("long").alias("num_def"),
            (priority == "2-HIGH").cast("long").alias("num_hosp"),
            (priority == "3-MEDIUM").cast("long").alias("num_uci"),
        )
    )


def population_file(spark, sf) -> DataFrame:
    """Customers as inhabitants, with every total the population file prints."""
    pair = F.create_map(*[
        x for segment, (low, high) in FIVE_YEARS.items()
        for x in (F.lit(segment), F.array(F.lit(low), F.lit(high)))
    ])
    people = (
        table(spark, sf, "customer")
        .join(places(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("autonomous_region").alias("region"),
            F.element_at(
                F.try_element_at(pair, F.col("c_mktsegment")),
                (F.col("c_custkey") % 2 + 1).cast("int"),
            ).alias("age"),
            F.when(F.floor(F.col("c_custkey") / 2) % 2 == 0, "Hombres").otherwise("Mujeres")
            .alias("sex"),
        )
        .groupBy("region", "age", "sex").agg(F.count("*").alias("n"))
    )

    def or_total(name: str, total: str):
        return F.when(F.grouping(name) == 1, F.lit(total)).otherwise(F.col(name))

    return people.cube("region", "age", "sex").agg(
        or_total("region", "Total Nacional").alias("Comunidades y ciudades autonomas"),
        or_total("age", "Total").alias("Grupo quinquenal de edad"),
        or_total("sex", "Ambos sexos").alias("Sexo"),
        F.lit("Total").alias("Nacionalidad"),
        F.lit(d.POPULATION_PERIOD).alias("Periodo"),
        F.sum("n").alias("Total"),
    ).drop("region", "age", "sex")


def deaths_file(spark, sf) -> DataFrame:
    """Ordered parts as deaths by cause, with totals."""
    ages = ["Menos de 1 año", "De 1 a 4 años", "De 20 a 24 años", "De 25 a 29 años",
            "De 60 a 64 años", "De 65 a 69 años", "95 y más años"]
    lines = table(spark, sf, "lineitem").groupBy(
        F.col("l_partkey").alias("p_partkey"), "l_returnflag", "l_linenumber"
    ).agg(F.count("*").alias("n"))
    dead = lines.join(table(spark, sf, "part"), "p_partkey").select(
        F.concat(F.lit("001-102  I-XXII."), F.col("p_brand")).alias("cause"),
        F.when(F.col("l_returnflag") == "A", "Hombres").otherwise("Mujeres").alias("sex"),
        F.element_at(F.array(*map(F.lit, ages)), F.col("l_linenumber")).alias("age"), "n",
    ).groupBy("cause", "sex", "age").agg(F.sum("n").alias("n"))

    def or_total(name: str, total: str):
        return F.when(F.grouping(name) == 1, F.lit(total)).otherwise(F.col(name))

    return dead.cube("cause", "sex", "age").agg(
        or_total("cause", "001-102  I-XXII.Todas las causas").alias("Causa de muerte"),
        or_total("sex", "Total").alias("Sexo"),
        or_total("age", "Todas las edades").alias("Edad"),
        F.lit(d.DEATHS_PERIOD).alias("Periodo"),
        F.sum("n").alias("Total"),
    ).drop("cause", "sex", "age")


def tests_file(spark, sf) -> DataFrame:
    """Shipped lines as tests; returned ones are the positives."""
    units = F.col("l_quantity").cast("long")
    returned, antigen = F.col("l_returnflag") == "R", F.col("l_linestatus") == "F"
    lines = table(spark, sf, "lineitem").groupBy(
        F.col("l_suppkey").alias("s_suppkey"), F.to_date("l_shipdate").alias("day")
    ).agg(*[
        F.sum(F.when(condition, units).otherwise(0)).alias(name)
        for name, condition in {
            "N_ANT_POSITIVOS": antigen & returned, "N_ANT": antigen,
            "N_PCR_POSITIVOS": ~antigen & returned, "N_PCR": ~antigen,
        }.items()
    ])
    return (
        lines.join(table(spark, sf, "supplier"), "s_suppkey")
        .join(places(spark, sf), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("province").alias("PROVINCIA"),
            F.upper(F.date_format("day", "ddMMMyyyy")).alias("FECHA_PRUEBA"),
            "N_ANT_POSITIVOS", "N_ANT", "N_PCR_POSITIVOS", "N_PCR",
        )
    )


def region_days(spark, sf) -> DataFrame:
    """Orders by day and region: all, urgent, high and low priority."""
    priority = F.col("o_orderpriority")
    per_customer = table(spark, sf, "orders").groupBy(
        F.col("o_custkey").alias("c_custkey"), F.to_date("o_orderdate").alias("date")
    ).agg(
        F.count("*").alias("n"), F.count_if(priority == "1-URGENT").alias("urgent"),
        F.count_if(priority == "2-HIGH").alias("high"), F.count_if(priority == "5-LOW").alias("low"),
    )
    return (
        per_customer.join(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), "c_custkey")
        .join(places(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("date", "autonomous_region")
        .agg(*[F.sum(c).alias(c) for c in ("n", "urgent", "high", "low")])
    )


OLD_SHEET = ["Unnamed: 0", "Dosis entregadas Pfizer (1)", "Dosis entregadas Moderna (1)",
             "Dosis entregadas (1)", "Dosis administradas (2)", "% sobre entregadas",
             "Nº Personas vacunadas(pauta completada)"]
NEW_SHEET = ["Unnamed: 0", "Dosis entregadas Pfizer (1)", "Dosis entregadas Janssen (1)",
             "Total Dosis entregadas (1)", "Dosis administradas (2)", "% sobre entregadas",
             "Nº Personas vacunadas(pauta completada)", "Nº Personas con al menos 1 dosis"]


def vaccination_sheets(spark, sf) -> DataFrame:
    """A workbook per day; its columns change in 1999."""
    days = region_days(spark, sf)
    national = days.groupBy("date").agg(
        F.lit("Totales").alias("autonomous_region"),
        *[F.sum(c).alias(c) for c in ("n", "urgent", "high", "low")],
    )
    new = F.year("date") >= 1999
    share = F.floor(F.col("urgent") * 10000 / F.col("n")) / 10000
    cells = [F.col("autonomous_region"), F.col("urgent"), F.col("high"), F.col("n"), F.col("low"),
             share, F.col("n") - F.col("low")]
    text = [c.cast("string") for c in cells]
    return days.unionByName(national).select(
        F.concat(F.lit("Informe_"), F.date_format("date", "yyyyMMdd"), F.lit(".ods"))
        .alias("file_name"),
        F.lit(0).alias("sheet_no"), F.lit(1).alias("sheets"),
        F.when(new, F.array(*map(F.lit, NEW_SHEET))).otherwise(F.array(*map(F.lit, OLD_SHEET)))
        .alias("header"),
        F.when(new, F.array(*text, F.col("n").cast("string"))).otherwise(F.array(*text))
        .alias("cells"),
    )


# --- the same inputs in SQL -------------------------------------------------

BAND_CASE = "CASE c_mktsegment " + " ".join(
    f"WHEN '{segment}' THEN '{band}'" for segment, band in BANDS.items()
) + " ELSE '80+' END"
COUNTS = ingest.COUNTS
SERIES = "PARTITION BY autonomous_region, gender, age_range ORDER BY date"


def named(column: str, total: str, alias: str) -> str:
    return f"CASE WHEN GROUPING({column}) = 1 THEN '{total}' ELSE {column} END AS {alias}"


PANEL = f"""
    case_ AS (
        SELECT r_name AS r, CASE o_orderstatus WHEN 'F' THEN 'M' WHEN 'O' THEN 'F' ELSE 'unknown' END AS g,
               CASE WHEN c_custkey % 40 = 0 THEN 'NC' ELSE {BAND_CASE} END AS a,
               CAST(o_orderdate AS DATE) AS date, o_orderpriority AS p
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey),
    cube_ AS (
        SELECT date, {named('r', 'España', 'autonomous_region')}, {named('g', 'total', 'gender')},
               {named('a', 'total', 'age_range')}, COUNT(*) AS new_cases,
               CAST(SUM(CASE WHEN p = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS new_deaths,
               CAST(SUM(CASE WHEN p = '2-HIGH' THEN 1 ELSE 0 END) AS BIGINT) AS new_hospitalizations,
               CAST(SUM(CASE WHEN p = '3-MEDIUM' THEN 1 ELSE 0 END) AS BIGINT)
                 AS new_ic_hospitalizations
        FROM case_ GROUP BY date, CUBE (r, g, a)),
    panel AS (SELECT *, {', '.join(
        f"CAST(SUM(new_{c}) OVER ({SERIES} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total_{c}"
        for c in COUNTS)} FROM cube_)
"""
FIVE_CASE = "CASE c_mktsegment " + " ".join(
    f"WHEN '{s}' THEN CASE c_custkey % 2 WHEN 0 THEN '{low}' ELSE '{high}' END"
    for s, (low, high) in {
        "MACHINERY": ("0-4", "5-9"), "FURNITURE": ("20-24", "25-29"), "BUILDING": ("40-44", "45-49"),
        "AUTOMOBILE": ("60-64", "65-69"), "HOUSEHOLD": ("80-84", "≥90"),
    }.items()
) + " END"
POPULATION = f"""
    person AS (SELECT r_name AS r, {FIVE_CASE} AS a, {BAND_CASE} AS b,
                      CASE WHEN c_custkey // 2 % 2 = 0 THEN 'M' ELSE 'F' END AS g
               FROM customer JOIN nation ON c_nationkey = n_nationkey
               JOIN region ON n_regionkey = r_regionkey),
    people AS (SELECT {named('r', 'España', 'autonomous_region')}, {named('b', 'total', 'age_range')},
                      {named('g', 'total', 'gender')}, COUNT(*) AS population
               FROM person GROUP BY CUBE (r, b, g)),
    everyone AS (SELECT autonomous_region, population FROM people
                 WHERE age_range = 'total' AND gender = 'total')
"""
JOINED = f"{PANEL}, {POPULATION}, joined AS (SELECT * FROM panel JOIN people USING (autonomous_region, gender, age_range))"
KEYS = "date, autonomous_region, gender, age_range"


def rate(count: str) -> str:
    return f"1e5 * {count} / NULLIF(population, 0)"


def over(expression: str, days: int) -> str:
    return f"{expression} OVER ({SERIES} {last_days(days)})"


def safe(part: str, whole: str) -> str:
    return (f"CASE WHEN {whole} = 0 AND {part} <> 0 THEN NULL WHEN {whole} = 0 THEN 0 "
            f"ELSE 1e2 * (CAST({part} AS DOUBLE) / {whole}) END")


def change(first: str, last: str) -> str:
    return f"CASE WHEN {first} = 0 THEN 0 ELSE 1e2 * (CAST({last} - {first} AS DOUBLE) / {first}) END"


def rounded_sql(columns: dict[str, str], digits: int = 4) -> str:
    return ", ".join(f"ROUND({sql}, {digits}) AS {name}" for name, sql in columns.items())


def _panel(spark, sf) -> DataFrame:
    return ingest.daily_panel(daily_counts(spark, sf), provinces(spark, sf))


def _population(spark, sf) -> DataFrame:
    return ingest.population(population_file(spark, sf))


def _joined(spark, sf) -> DataFrame:
    return analyses.with_population(_panel(spark, sf), _population(spark, sf))


# --- queries ----------------------------------------------------------------

@workload("analysis_daily_panel", f"WITH {PANEL} SELECT * FROM panel")
def analysis_daily_panel(spark, sf):
    return _panel(spark, sf)


@workload("analysis_panel_population", f"WITH {JOINED} SELECT * FROM joined")
def analysis_panel_population(spark, sf):
    return _joined(spark, sf)


@workload("analysis_cases", f"""
    WITH {JOINED},
      s AS (SELECT *, CAST({over('SUM(new_cases)', 14)} AS BIGINT) AS s14,
              {over('AVG(new_cases)', 8)} AS m8, {over('AVG(new_cases)', 15)} AS m15,
              {over('AVG(new_cases)', 7)} AS m7, {over('AVG(new_cases)', 14)} AS m14,
              {over('AVG(new_cases)', 60)} AS m60 FROM joined),
      l AS (SELECT *, LAG(m7, 1) OVER ({SERIES}) AS l7, LAG(m14, 7) OVER ({SERIES}) AS l14,
              LAG(m60, 30) OVER ({SERIES}) AS l60, {rate('s14')} AS ci FROM s)
    SELECT {KEYS}, new_cases, total_cases, {rounded_sql({
        'new_cases_per_population': rate('new_cases'),
        'total_cases_per_population': rate('total_cases'),
        'ci_last_14_days': 'ci',
        'inverted_ci': 'CASE WHEN ci > 10 THEN 1e5 / ci ELSE 1e4 END',
        'new_cases_ma_1w': rate('m8'), 'new_cases_ma_2w': rate('m15'),
        'daily_increase': change('l7', 'm7'), 'weekly_increase': change('l14', 'm14'),
        'monthly_increase': change('l60', 'm60'),
    })} FROM l
""")
def analysis_cases(spark, sf):
    return rounded(analyses.cases(_joined(spark, sf)), 4)


@workload("analysis_deaths", f"""
    WITH {JOINED},
      s AS (SELECT *, {', '.join(f"{over('FIRST_VALUE(new_deaths)', n)} AS f{n}" for n in (2, 8, 15, 31))},
              {over('AVG(new_deaths)', 8)} AS m8, {over('AVG(new_deaths)', 15)} AS m15,
              {over('AVG(new_cases)', 15)} AS c15 FROM joined)
    SELECT {KEYS}, new_deaths, total_deaths, {rounded_sql({
        'new_deaths_per_population': rate('new_deaths'),
        'total_deaths_per_population': rate('total_deaths'),
        'daily_increase': change('f2', 'new_deaths'), 'weekly_increase': change('f8', 'new_deaths'),
        'two_weeks_increase': change('f15', 'new_deaths'),
        'monthly_increase': change('f31', 'new_deaths'),
        'new_deaths_ma_1w': rate('m8'), 'new_deaths_ma_2w': rate('m15'),
        'mortality_2w': safe('m15', 'c15'), 'mortality_total': safe('total_deaths', 'total_cases'),
    })} FROM s
""")
def analysis_deaths(spark, sf):
    return rounded(analyses.deaths(_joined(spark, sf)), 4)


def _admissions(name: str, increase: str, average: str, ratio: str) -> dict[str, str]:
    new, tag = f"new_{name}", f"{average}_"
    return {
        f"{new}_per_population": rate(new), f"total_{name}_per_population": rate(f"total_{name}"),
        **{f"{increase}_{span}_increase": change(f"{tag}f{n}", new)
           for span, n in (("daily", 2), ("weekly", 8), ("two_weeks", 15), ("monthly", 31))},
        f"{average}_ma_1w": rate(f"{tag}m8"), f"{average}_ma_2w": rate(f"{tag}m15"),
        f"{ratio}_2w": safe(f"{tag}m15", "c15"), f"{ratio}_total": safe(f"total_{name}", "total_cases"),
    }


def _admission_windows(name: str, average: str) -> str:
    firsts = [f"{over(f'FIRST_VALUE(new_{name})', n)} AS {average}_f{n}" for n in (2, 8, 15, 31)]
    means = [f"{over(f'AVG(new_{name})', n)} AS {average}_m{n}" for n in (8, 15)]
    return ", ".join(firsts + means)


@workload("analysis_hospitalizations", f"""
    WITH {JOINED},
      s AS (SELECT *, {_admission_windows('hospitalizations', 'new_hospitalizations')},
              {_admission_windows('ic_hospitalizations', 'new_ic')},
              {over('AVG(new_cases)', 15)} AS c15 FROM joined)
    SELECT {KEYS}, new_hospitalizations, total_hospitalizations, new_ic_hospitalizations,
      total_ic_hospitalizations, {rounded_sql({
        **_admissions('hospitalizations', 'hospitalizations', 'new_hospitalizations',
                      'hospitalization_ratio'),
        **_admissions('ic_hospitalizations', 'ic', 'new_ic', 'hospitalization_ic_ratio'),
    })} FROM s
""")
def analysis_hospitalizations(spark, sf):
    return rounded(analyses.hospitalizations(_joined(spark, sf)), 4)


@workload("analysis_population", f"""
    WITH {POPULATION}, c AS (
        SELECT {named('r', 'España', 'autonomous_region')}, {named('a', 'total', 'age_range')},
               {named('g', 'total', 'g')}, COUNT(*) AS n FROM person GROUP BY CUBE (r, a, g))
    SELECT autonomous_region, age_range, MAX(CASE WHEN g = 'M' THEN n END) AS M,
           MAX(CASE WHEN g = 'F' THEN n END) AS F, MAX(CASE WHEN g = 'total' THEN n END) AS total
    FROM c GROUP BY ALL
""")
def analysis_population(spark, sf):
    return _population(spark, sf)


AGE_CASE = ("CASE l_linenumber WHEN 1 THEN '0-1' WHEN 2 THEN '1-4' WHEN 3 THEN '20-24' WHEN 4 THEN '25-29' "
            "WHEN 5 THEN '60-64' WHEN 6 THEN '65-69' ELSE '95+' END")
DECADE_CASE = ("CASE WHEN l_linenumber <= 2 THEN '0-9' WHEN l_linenumber <= 4 THEN '20-29' "
               "WHEN l_linenumber <= 6 THEN '60-69' ELSE '80+' END")
DEAD = f"""
    dead AS (SELECT p_brand AS c, CASE l_returnflag WHEN 'A' THEN 'M' ELSE 'F' END AS g,
                    {AGE_CASE} AS a, {DECADE_CASE} AS b
             FROM lineitem JOIN part ON l_partkey = p_partkey),
    causes AS (SELECT {named('c', 'Todas las causas', 'death_cause')}, {named('g', 'total', 'gender')},
                      {named('b', 'total', 'age_range')}, COUNT(*) AS total_deaths
               FROM dead GROUP BY CUBE (c, g, b))
"""


@workload("analysis_death_causes", f"""
    WITH {DEAD}
    SELECT {named('c', 'Todas las causas', 'death_cause')}, {named('g', 'total', 'gender')},
           {named('a', 'total', 'age_range')}, COUNT(*) AS total_deaths
    FROM dead GROUP BY CUBE (c, g, a)
""")
def analysis_death_causes(spark, sf):
    return ingest.death_causes(deaths_file(spark, sf))


COVID = f"""
    d AS (SELECT * FROM joined WHERE autonomous_region = 'España'),
    covid AS (SELECT a.age_range, a.gender,
                     CAST(a.total_deaths - b.total_deaths AS DOUBLE) AS total_deaths
              FROM d a LEFT JOIN d b ON a.age_range = b.age_range AND a.gender = b.gender
                                    AND b.date = DATE '{AS_OF}' - 365
              WHERE a.date = DATE '{AS_OF}')
"""


def _year_deaths(spark, sf) -> DataFrame:
    """Year-on-year deaths; the derived series predates the first COVID deaths."""
    from episeries.operators.combine import snapshot_difference

    national = analyses.deaths(_joined(spark, sf)).filter(
        F.col("autonomous_region") == d.NATIONAL
    )
    return snapshot_difference(
        national, ["age_range", "gender"], "date", "total_deaths", AS_OF
    ).withColumn("total_deaths", F.col("total_deaths").cast("double"))


@workload("analysis_year_deaths", f"WITH {JOINED}, {COVID} SELECT * FROM covid")
def analysis_year_deaths(spark, sf):
    return _year_deaths(spark, sf)


@workload("analysis_top_death_causes", f"""
    WITH {JOINED}, {COVID}, {DEAD}, every AS (
        SELECT age_range, gender, 'COVID-19' AS death_cause, total_deaths FROM covid
        UNION ALL SELECT age_range, gender, death_cause, CAST(total_deaths AS DOUBLE) FROM causes
        WHERE death_cause <> 'Todas las causas'),
      r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY age_range, gender
              ORDER BY total_deaths DESC NULLS LAST, death_cause) AS rn FROM every)
    SELECT age_range, gender, death_cause, CAST(round_even(total_deaths, 0) AS BIGINT) AS total_deaths
    FROM r WHERE rn <= 10
""")
def analysis_top_death_causes(spark, sf):
    causes = ingest.death_causes(deaths_file(spark, sf))
    return analyses.top_death_causes(causes, _year_deaths(spark, sf))


VERSUS = f"""
    versus AS (SELECT age_range, gender, covid.total_deaths AS covid_deaths,
                      causes.total_deaths AS other_deaths
               FROM covid JOIN causes USING (age_range, gender) WHERE death_cause = 'Todas las causas')
"""


@workload("analysis_covid_vs_all", f"""
    WITH {JOINED}, {COVID}, {DEAD}, {VERSUS}
    SELECT *, ROUND(1e2 * (covid_deaths / (covid_deaths + other_deaths)), 6) AS covid_percentage
    FROM versus
""")
def analysis_covid_vs_all(spark, sf):
    causes = ingest.death_causes(deaths_file(spark, sf))
    return rounded(analyses.covid_vs_all_deaths(causes, _year_deaths(spark, sf)))


@workload("analysis_population_pyramid", f"""
    WITH {JOINED}, {COVID}, {DEAD}, {VERSUS}
    SELECT age_range, gender, population - covid_deaths AS alive_population, covid_deaths
    FROM versus JOIN people USING (age_range, gender) WHERE autonomous_region = 'España'
""")
def analysis_population_pyramid(spark, sf):
    causes = ingest.death_causes(deaths_file(spark, sf))
    versus = analyses.covid_vs_all_deaths(causes, _year_deaths(spark, sf))
    return analyses.population_pyramid(_population(spark, sf), versus)


TESTS = """
    tests AS (
        SELECT CAST(l_shipdate AS DATE) AS date, r_name AS autonomous_region,
               CAST(SUM(CASE WHEN l_linestatus = 'F' AND l_returnflag = 'R' THEN l_quantity ELSE 0 END)
                 AS BIGINT) AS antigens_positive,
               CAST(SUM(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS BIGINT)
                 AS antigens_total,
               CAST(SUM(CASE WHEN l_linestatus <> 'F' AND l_returnflag = 'R' THEN l_quantity ELSE 0 END)
                 AS BIGINT) AS pcr_positive,
               CAST(SUM(CASE WHEN l_linestatus <> 'F' THEN l_quantity ELSE 0 END) AS BIGINT) AS pcr_total
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey GROUP BY ALL),
    diagnostic AS (SELECT *, antigens_total + pcr_total AS total_diagnostic_tests,
        1e2 * (CAST(antigens_positive + pcr_positive AS DOUBLE)
               / NULLIF(antigens_total + pcr_total, 0)) AS positivity FROM tests)
"""


@workload("analysis_tests_extract", f"""
    WITH {TESTS} SELECT * EXCLUDE (positivity), ROUND(positivity, 6) AS positivity FROM diagnostic
""")
def analysis_tests_extract(spark, sf):
    return rounded(ingest.diagnostic_tests(tests_file(spark, sf), places(spark, sf)))


BY_REGION = "PARTITION BY autonomous_region ORDER BY date"


@workload("analysis_diagnostic_tests", f"""
    WITH {TESTS}, {POPULATION}, every AS (
        SELECT date, autonomous_region, antigens_positive, antigens_total, pcr_positive, pcr_total,
               total_diagnostic_tests AS n, positivity FROM diagnostic
        UNION ALL SELECT date, 'España', NULL, NULL, NULL, NULL,
               CAST(SUM(total_diagnostic_tests) AS BIGINT), AVG(positivity) FROM diagnostic GROUP BY date),
      w AS (SELECT *, CAST(SUM(n) OVER ({BY_REGION} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total,
              AVG(n) OVER ({BY_REGION} {last_days(14)}) AS n_ma,
              AVG(positivity) OVER ({BY_REGION} {last_days(14)}) AS p_ma,
              AVG(positivity) OVER ({BY_REGION} ROWS UNBOUNDED PRECEDING) AS p_mean FROM every)
    SELECT date, autonomous_region, antigens_positive, antigens_total, pcr_positive, pcr_total,
      n AS new_diagnostic_tests, total AS total_diagnostic_tests, {rounded_sql({
        'positivity': 'positivity', 'positivity_ma_14d': 'p_ma', 'new_diagnostic_tests_ma_14d': 'n_ma',
        'average_positivity': 'p_mean', 'total_tests_per_population': rate('total'),
    })} FROM w JOIN everyone USING (autonomous_region)
""")
def analysis_diagnostic_tests(spark, sf):
    tests = ingest.diagnostic_tests(tests_file(spark, sf), places(spark, sf))
    return rounded(analyses.diagnostic_tests_progress(tests, _population(spark, sf)), 4)


REGION_DAYS = """
    days AS (SELECT CAST(o_orderdate AS DATE) AS date, r_name AS autonomous_region, COUNT(*) AS n,
                    COUNT(*) FILTER (o_orderpriority = '1-URGENT') AS urgent,
                    COUNT(*) FILTER (o_orderpriority = '2-HIGH') AS high,
                    COUNT(*) FILTER (o_orderpriority = '5-LOW') AS low
             FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)
"""


@workload("analysis_hospital_pressure", f"""
    WITH {REGION_DAYS}, detail AS (
        SELECT date, autonomous_region, n AS hospitalized_patients,
               CASE WHEN urgent > 0 THEN urgent END AS ic_patients,
               1e2 * (CAST(high AS DOUBLE) / n) AS beds_percentage,
               CASE WHEN low > 0 THEN 1e2 * (CAST(low AS DOUBLE) / n) END AS ic_beds_percentage FROM days),
      every AS (SELECT * FROM detail UNION ALL
        SELECT date, 'España', CAST(SUM(hospitalized_patients) AS BIGINT),
               CAST(COALESCE(SUM(ic_patients), 0) AS BIGINT), AVG(beds_percentage),
               AVG(ic_beds_percentage) FROM detail GROUP BY date)
    SELECT date, autonomous_region, hospitalized_patients, ic_patients, {rounded_sql({
        'beds_percentage': 'beds_percentage', 'ic_beds_percentage': 'ic_beds_percentage',
        'beds_percentage_ma_14d': f'AVG(beds_percentage) OVER ({BY_REGION} {last_days(14)})',
        'ic_beds_percentage_ma_14d': f'AVG(ic_beds_percentage) OVER ({BY_REGION} {last_days(14)})',
    })} FROM every
""")
def analysis_hospital_pressure(spark, sf):
    days = region_days(spark, sf)
    extracted = days.select(
        "date", "autonomous_region", F.col("n").alias("hospitalized_patients"),
        F.when(F.col("urgent") > 0, F.col("urgent")).alias("ic_patients"),
        (F.lit(100.0) * (F.col("high") / F.col("n"))).alias("beds_percentage"),
        F.when(F.col("low") > 0, F.lit(100.0) * (F.col("low") / F.col("n")))
        .alias("ic_beds_percentage"),
    )
    return rounded(analyses.hospital_pressure(extracted), 4)


@workload("analysis_transmission", f"""
    WITH {REGION_DAYS}, detail AS (
        SELECT date, autonomous_region, 1e2 * (CAST(low AS DOUBLE) / n) AS c,
               CAST(urgent AS DOUBLE) AS i, 1e2 - 1e2 * (CAST(high AS DOUBLE) / n) AS a FROM days),
      every AS (SELECT * FROM detail UNION ALL
        SELECT date, 'España', AVG(c), AVG(i), AVG(a) FROM detail GROUP BY date)
    SELECT date, autonomous_region, {rounded_sql({
        'cases_unknown_contact': 'c', 'identified_contacts_per_case': 'i',
        'asymptomatic_percentage': 'a'})} FROM every
""")
def analysis_transmission(spark, sf):
    days = region_days(spark, sf)
    share = F.lit(100.0) * (F.col("low") / F.col("n"))
    extracted = days.select("date", "autonomous_region", F.struct(
        F.struct(F.col("n").alias("total"), share.alias("percentage"))
        .alias("cases_unknown_contact"),
        F.struct(F.col("urgent").alias("median")).alias("identified_contacts_per_case"),
        (F.lit(100.0) - F.lit(100.0) * (F.col("high") / F.col("n")))
        .alias("asymptomatic_percentage"),
    ).alias("transmission_indicators"))
    return rounded(analyses.transmission_indicators(extracted), 4)


@workload("analysis_symptoms", """
    WITH x AS (SELECT event_type, COUNT(*) AS n, COUNT(*) FILTER (value > 20) AS h
               FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15' GROUP BY ALL)
    SELECT CASE event_type WHEN 'click' THEN 'Tos' WHEN 'view' THEN 'Fiebre' WHEN 'error' THEN 'Disnea'
           ELSE event_type END AS symptom, ROUND(1e2 * (CAST(h AS DOUBLE) / n), 6) AS percentage FROM x
""")
def analysis_symptoms(spark, sf):
    codes = {"click": "cough", "view": "fever", "error": "dyspnoea"}
    name = F.col("event_type")
    symptom = F.coalesce(*[F.when(name == k, F.lit(v)) for k, v in codes.items()], name)
    high = F.count_if(F.col("value") > 20)
    clinic = table(spark, sf, "events").groupBy(
        F.to_date("ts").alias("date"), symptom.alias("symptom")
    ).agg(F.struct(F.struct(
        F.count("*").alias("number"),
        (F.lit(100.0) * (high.cast("double") / F.count("*"))).alias("percentage"),
    ).alias("total")).alias("patients"))
    return rounded(analyses.symptoms(clinic, "2024-01-15"))


SHEETS = f"""
    {REGION_DAYS}, every AS (SELECT * FROM days UNION ALL
        SELECT date, 'España', CAST(SUM(n) AS BIGINT), CAST(SUM(urgent) AS BIGINT),
               CAST(SUM(high) AS BIGINT), CAST(SUM(low) AS BIGINT) FROM days GROUP BY date),
    general AS (SELECT date, autonomous_region, n AS total, urgent AS pfizer,
        CASE WHEN year(date) < 1999 THEN high END AS moderna,
        CASE WHEN year(date) >= 1999 THEN high END AS janssen, low AS applied_doses,
        1e2 * (FLOOR(urgent * 10000 / n) / 10000) AS percentage_applied_doses,
        CASE WHEN year(date) >= 1999 THEN n END AS number_at_least_single_dose_people,
        n - low AS number_fully_vaccinated_people FROM every)
"""


def _flat_doses(df: DataFrame) -> DataFrame:
    return df.select(
        *[c for c in df.columns if c != "received_doses"],
        F.col("received_doses").getItem("total").alias("total"),
        *[F.col("received_doses").getItem(b).alias(b.lower())
          for b in ("Pfizer", "Moderna", "Janssen")],
    )


@workload("analysis_vaccination_general", f"""
    WITH {SHEETS}
    SELECT * EXCLUDE (percentage_applied_doses),
           ROUND(percentage_applied_doses, 6) AS percentage_applied_doses FROM general
""")
def analysis_vaccination_general(spark, sf):
    return rounded(_flat_doses(ingest.vaccination_general(vaccination_sheets(spark, sf))))


@workload("analysis_vaccination_progress", f"""
    WITH {SHEETS}, {POPULATION}, j AS (
        SELECT *, number_fully_vaccinated_people
                  - LAG(number_fully_vaccinated_people) OVER ({BY_REGION}) AS new_vaccinations
        FROM general JOIN everyone USING (autonomous_region))
    SELECT * EXCLUDE (population, percentage_applied_doses), {rounded_sql({
        'percentage_applied_doses': 'percentage_applied_doses',
        'percentage_fully_vaccinated':
            '1e2 * (CAST(number_fully_vaccinated_people AS DOUBLE) / population)',
        'percentage_at_least_single_dose':
            '1e2 * (CAST(number_at_least_single_dose_people AS DOUBLE) / population)',
        'new_vaccinations_ma_7d': f'AVG(new_vaccinations) OVER ({BY_REGION} {last_days(7)})',
    })} FROM j
""")
def analysis_vaccination_progress(spark, sf):
    general = ingest.vaccination_general(vaccination_sheets(spark, sf))
    progress = analyses.vaccination_progress(general, _population(spark, sf))
    return rounded(_flat_doses(progress), 4)


def age_sheets(spark, sf) -> DataFrame:
    """A row of a two-layout age sheet per customer; one in ten has a gap."""
    def percent(i: int):
        return F.format_string("%.3f", (F.col("c_custkey") * (i + 3) % 1000) / 1000)

    def sheet(groups: int, width: int, last: str) -> list[str]:
        names, marks = ["Unnamed: 0"], 0
        for g in range(groups):
            names += [f"n{g}", f"pop{g}"][:width - 1] + ["%" if marks == 0 else f"%.{marks}"]
            marks += 1
        return names + [last]

    # Wide sheets: number, population, share per band, old bands, then a total.
    wide = sheet(7, 3, "Total n") + ["Total pop", "Total %"]
    # Narrow sheets: share before number per band, new bands, three more columns.
    narrow = ["Unnamed: 0"]
    for g in range(8):
        narrow += ["n20-29" if g == 6 else f"n{g}", "%" if g == 0 else f"%.{g}"]
    narrow += ["x", "y", "z"]

    def values(header: list[str]) -> list:
        out, seen = [], 0
        for i, name in enumerate(header):
            if i == 0:
                out.append(F.concat(F.col("c_name"), F.lit(" ")))
            elif "%" in name:
                out.append(F.when((F.col("c_custkey") % 10 == 3) & (F.lit(seen) == 2), None)
                           .otherwise(percent(seen)))
                seen += 1
            else:
                out.append(F.lit("5"))
        return out

    is_wide = F.col("c_nationkey") % 2 == 0
    return table(spark, sf, "customer").select(
        F.lit("Informe_20210715.ods").alias("file_name"), F.lit(3).alias("sheet_no"),
        F.lit(5).alias("sheets"),
        F.when(is_wide, F.array(*map(F.lit, wide))).otherwise(F.array(*map(F.lit, narrow)))
        .alias("header"),
        F.when(is_wide, F.array(*values(wide))).otherwise(F.array(*values(narrow))).alias("cells"),
    )


@workload("layout_unpivot", """
    WITH band AS (SELECT * FROM (VALUES
        (0, 0, '80+'), (0, 1, '70-79'), (0, 2, '60-69'), (0, 3, '50-59'), (0, 4, '25-49'),
        (0, 5, '18-24'), (0, 6, '16-17'), (0, 7, 'total'),
        (1, 0, '80+'), (1, 1, '70-79'), (1, 2, '60-69'), (1, 3, '50-59'), (1, 4, '40-49'),
        (1, 5, '30-39'), (1, 6, '20-29'), (1, 7, '12-19')) AS b(layout, i, age_range))
    SELECT DATE '2021-07-15' AS date, c_name AS autonomous_region, age_range,
           ROUND(100 * CAST(printf('%.3f', (c_custkey * (i + 3) % 1000) / 1000) AS DOUBLE), 6)
             AS percentage
    FROM customer JOIN band ON layout = c_nationkey % 2
    WHERE c_custkey % 10 <> 3
""")
def layout_unpivot(spark, sf):
    return rounded(ingest.vaccination_ages(age_sheets(spark, sf), "single"))
