"""Report parsing on page texts that Spark renders from ``lineitem``.

Every order is a report; its lines, summed per line number (at most seven rows
per report, whatever the data), become the rows of the printed table. Parsing
the text must give back what SQL reads from the lines directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episeries.functions import domains as d
from episeries.plans import reports
from episeries.workloads.registry import rounded, table, workload

FIRST_DAY = "2021-01-01"
SLOT_REGIONS = d.REGIONS[:7]

LINES = """
    line AS (SELECT l_orderkey AS report_id, l_linenumber AS slot,
                    CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q,
                    CAST(SUM(l_partkey) AS BIGINT) AS p, CAST(SUM(l_suppkey) AS BIGINT) AS s,
                    CAST(SUM(CAST(ROUND(l_discount * 100) AS BIGINT)) AS BIGINT) AS c,
                    CAST(SUM(CAST(ROUND(l_tax * 100) AS BIGINT)) AS BIGINT) AS t
             FROM lineitem GROUP BY ALL)
"""
REGION_CASE = "CASE slot " + " ".join(
    f"WHEN {i} THEN '{name}'" for i, name in enumerate(SLOT_REGIONS, 1)
) + " END"
# Tables start at the first region, so reports without it have no rows.
READABLE = """
    readable AS (SELECT * FROM line WHERE report_id IN (SELECT report_id FROM line WHERE slot = 1))
"""


def _lines(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy(
        F.col("l_orderkey").alias("report_id"), F.col("l_linenumber").alias("slot")
    ).agg(
        F.sum(F.col("l_quantity").cast("long")).alias("q"),
        F.sum("l_partkey").alias("p"), F.sum("l_suppkey").alias("s"),
        F.sum(F.round(F.col("l_discount") * 100).cast("long")).alias("c"),
        F.sum(F.round(F.col("l_tax") * 100).cast("long")).alias("t"),
    )


def _int(name: str):
    # formatting costs far more than a cast, which is enough below a thousand
    return F.when(F.col(name).between(0, 999), F.col(name).cast("string")).otherwise(
        F.translate(F.format_number(name, 0), ",", "."))


def _tenths(whole: str, tenth: str):
    return F.concat(F.col(whole), F.lit(","), F.col(tenth) % 10, F.lit("%"))


def tenths_sql(whole: str, tenth: str) -> str:
    return f"CAST(CONCAT({whole}, '.', {tenth} % 10) AS DOUBLE)"


def _words(*parts):
    return F.concat_ws(" ", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def _slot(values: list[str]):
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("slot"))


def _body(lines: DataFrame, row, part=None) -> DataFrame:
    """The rows of each report in slot order; one column per part."""
    def rows(here):
        entry = F.when(here, F.struct("slot", row.alias("r")))
        return F.concat_ws(" ", F.sort_array(F.collect_list(entry))["r"])

    if part is None:
        return lines.groupBy("report_id").agg(rows(F.lit(True)).alias("body"))
    return lines.groupBy("report_id").agg(
        rows(part == 0).alias("body"), rows(part == 1).alias("body2")
    )


def _pages(df: DataFrame, *texts) -> DataFrame:
    """A cover and the given pages for every report."""
    cover = F.lit("Informe diario \n de situación")
    return df.select(
        "report_id",
        F.date_add(F.lit(FIRST_DAY).cast("date"), (F.col("report_id") % 500).cast("int"))
        .alias("report_date"),
        F.posexplode(F.array(cover, *texts)).alias("page_no", "text"),
    )


DAY_BEFORE = f"DATE '{FIRST_DAY}' + CAST(report_id % 500 AS INTEGER) - 1"
REPORT_DAY = f"DATE '{FIRST_DAY}' + CAST(report_id % 500 AS INTEGER)"


def _by_region(spark, sf, row) -> DataFrame:
    lines = _lines(spark, sf).withColumn("ar", _slot(SLOT_REGIONS))
    return _body(lines, row)


def hospital_pages(spark, sf) -> DataFrame:
    """Three column layouts; alone on the page, or left or right of a table."""
    layout, side = F.col("report_id") % 3, F.col("report_id") % 4
    ic, beds = _tenths("t", "c"), _tenths("c", "t")
    cells = F.when(layout == 0, _words(_int("q"), _int("p"), beds)).when(
        layout == 1, _words(_int("q"), beds, _int("p"), ic)
    ).otherwise(_words(_int("q"), "7,5", beds, _int("p"), "3,25", ic))
    ours = _words(F.col("ar"), cells, _int("s"), F.col("slot"))
    other = _words(F.col("ar"), "9", "8", "7")
    row = F.when(side == 0, _words(ours, other)).when(side == 1, _words(other, ours)).otherwise(ours)
    text = _words(
        "Informe \n con datos.",
        F.when(side == 1, "Tabla 1. Resumen previo."),
        F.concat(F.lit("Tabla "), F.when(side == 1, "2").otherwise("1"),
                 F.lit(". Situación capacidad asistencial")),
        F.when(side == 0, "Tabla 2. Otra."),
        F.when(layout >= 1, d.IC_BEDS_PHRASE),
        F.when(layout == 2, d.PER_INHABITANTS_PHRASE),
        "CCAA", F.col("body"), "ESPAÑA 1 2 3",
    )
    return _pages(_by_region(spark, sf, row), text)


@workload("report_hospital_pressure", f"""
    WITH {LINES}, {READABLE}
    SELECT report_id, {DAY_BEFORE} AS date, {REGION_CASE} AS autonomous_region,
           q AS hospitalized_patients, {tenths_sql('c', 't')} AS beds_percentage, p AS ic_patients,
           CASE WHEN report_id % 3 >= 1 THEN {tenths_sql('t', 'c')} END AS ic_beds_percentage,
           s AS admissions, CAST(slot AS BIGINT) AS discharges
    FROM readable
""")
def report_hospital_pressure(spark, sf):
    return reports.hospital_pressure(hospital_pages(spark, sf))


@workload("report_rejected", f"""
    WITH {LINES} SELECT DISTINCT report_id, 'hospital_pressure' AS table_name, 'no row read' AS reason
    FROM line WHERE report_id NOT IN (SELECT report_id FROM line WHERE slot = 1)
""")
def report_rejected(spark, sf):
    read = reports.read_hospital_pressure(hospital_pages(spark, sf))
    return reports.rejects(read, "hospital_pressure").filter("row IS NULL").select(
        "report_id", "table_name", "reason")


@workload("report_hospital_cases", f"""
    WITH {LINES}, {READABLE}, wide AS (
        SELECT *, 7 - p % 3 AS size, MAX(7 - p % 3) OVER (PARTITION BY report_id) AS width FROM readable)
    SELECT report_id, {DAY_BEFORE} AS date, {REGION_CASE} AS autonomous_region,
           CASE WHEN report_id % 2 = 0 THEN p ELSE q END AS total_hospitalized_cases,
           CASE WHEN width - size <> 1 THEN CASE WHEN report_id % 2 = 0 THEN s ELSE p END END
             AS total_ic_cases
    FROM wide WHERE width - size <> 2
""")
def report_hospital_cases(spark, sf):
    missing = F.col("p") % 3
    row = _words(
        F.col("ar"), _int("q"), "1", _int("p"), _int("s"),
        F.when(missing < 2, "2"), F.when(missing < 1, "3"),
    )
    text = _words(
        "Tabla 4. Casos de COVID-19 que han precisado hospitalización, ingreso en UCI",
        F.when(F.col("report_id") % 2 == 0, "IA"), F.col("body"), "Total 5 6",
    )
    rows = reports.hospital_cases(_pages(_by_region(spark, sf, row), text))
    return rows.select("report_id", "date", "autonomous_region", "hospitalizations.*")


SCOPES = ["Centro educativo", "Centro sanitario", "Familiar", "Mixto", "Laboral", "Social", "Otros"]
SCOPE_CASE = "CASE slot " + " ".join(
    f"WHEN {i} THEN '{name}'" for i, name in enumerate([*SCOPES[:6], "Otro"], 1)
) + " END"


def outbreak_pages(spark, sf) -> DataFrame:
    """Two pages; scopes with sub-rows, of six or ten cells."""
    def cells(number: str, infected: str):
        return F.when(
            F.col("report_id") % 2 == 0, _words(_int(number), _int(infected), "1,5 2 3 4,5")
        ).otherwise(_words(_int(number), "0 ", _int(infected), "0 1,5 2 3 4,5 6 7"))

    below = F.when(F.col("slot") == 1, _words(
        "Colegio (infantil, primaria)", cells("s", "q")
    )).when(F.col("slot") == 5, _words(
        "Centro sanitario", cells("q", "q"), "Matadero, cárnica y/o similar", cells("c", "p")
    )).when(F.col("slot") == 7, _words("Otros", cells("s", "q")))
    row = _words(_slot(SCOPES), cells("q", "p"), below)
    lines = _lines(spark, sf)
    bodies = _body(lines, row, part=F.when(F.col("slot") <= 4, 0).otherwise(1))
    return _pages(
        bodies,
        _words("Tabla 3. Distribución del nº de brotes y casos por ámbito Brotes Casos Casos/brote",
               F.col("body")),
        _words("Brotes Casos Casos/brote", F.col("body2"),
               "1 A efectos de notificación se agrupan, los de un mismo domicilio."),
    )


@workload("report_outbreaks", f"""
    WITH {LINES}, r AS (
        SELECT report_id, {SCOPE_CASE} AS scope, 'Total' AS label, q AS number, p AS cases FROM line
        UNION ALL
        SELECT report_id, {SCOPE_CASE}, CASE slot WHEN 1 THEN 'Colegio' ELSE 'Otros' END, s, q
        FROM line WHERE slot IN (1, 7)
        UNION ALL
        SELECT report_id, 'Laboral', 'Matadero/cárnica/similar', c, p FROM line WHERE slot = 5)
    SELECT report_id, {DAY_BEFORE} AS date, scope, CONCAT(scope, ' - ', label) AS subscope, number, cases,
           ROUND(CAST(cases AS DOUBLE) / NULLIF(number, 0), 9) AS cases_per_outbreak
    FROM r
""")
def report_outbreaks(spark, sf):
    rows = reports.outbreaks(outbreak_pages(spark, sf))
    return rounded(rows.select("report_id", "date", "scope", "subscope", "outbreaks.*"), 9)


SYMPTOMS = [
    "fiebre o reciente historia de fiebre", "tos", "dolor de garganta", "disnea", "vómitos",
    "diarrea", "otros síntomas",
]
SYMPTOM_CASE = "CASE slot " + " ".join(
    f"WHEN {i} THEN '{dict(d.SYMPTOM_PHRASES)[name]}'" for i, name in enumerate(SYMPTOMS, 1)
) + " END"


def patients_sql(name: str, number: str, percent: str) -> str:
    return f"""
        CASE WHEN {percent} > 0 THEN CAST(FLOOR({number} / ({percent} / 1e2)) AS BIGINT) END
          AS {name}_samples, {number} AS {name}_number, {percent} AS {name}_percentage"""


@workload("report_symptoms", f"""
    WITH {LINES}
    SELECT report_id, {REPORT_DAY} AS date, {SYMPTOM_CASE} AS symptom,
      {patients_sql('total', 'p', tenths_sql('c', 't'))},
      {patients_sql('women', 'q', tenths_sql('t', 'c'))},
      {patients_sql('men', 's', tenths_sql('q', 'p'))}
    FROM line
""")
def report_symptoms(spark, sf):
    women = _words(_int("q"), _tenths("t", "c"))
    men = _words(_int("s"), _tenths("q", "p"))
    women_first, samples = F.col("report_id") % 2 == 0, F.col("report_id") % 4 >= 2
    row = _words(
        _slot(SYMPTOMS), F.when(samples, "77"), _int("p"), _tenths("c", "t"),
        F.when(women_first, _words(women, men)).otherwise(_words(men, women)),
    )
    text = _words(
        "Tabla 2. Descripción de los casos. Características", F.when(samples, "n"), "Total",
        F.when(women_first, "Mujeres Hombres").otherwise("Hombres Mujeres"), "Síntomas",
        F.col("body"), "Enfermedad de base y factores de riesgo 1 2",
    )
    pages = _pages(_body(_lines(spark, sf), row), text)
    rows = reports.clinic_description(pages, numbers=None)
    fields = [
        F.col(f"patients.{who}.{what}").alias(f"{who}_{what}")
        for who in ("total", "women", "men") for what in ("samples", "number", "percentage")
    ]
    return rows.select("report_id", "date", "symptom", *fields)


@workload("report_transmission", f"""
    WITH {LINES}, {READABLE}
    SELECT report_id, {REPORT_DAY} AS date, {REGION_CASE} AS autonomous_region,
           p AS unknown_total, {tenths_sql('t', 'c')} AS unknown_percentage, c AS contacts,
           CAST(1 AS BIGINT) AS contacts_low, q AS contacts_high, s AS days,
           CASE WHEN slot < 5 THEN CAST(slot AS BIGINT) END AS days_low,
           CASE WHEN slot < 5 THEN q END AS days_high,
           ROUND(100 - {tenths_sql('c', 't')}, 6) AS asymptomatic
    FROM readable
""")
def report_transmission(spark, sf):
    spread = F.when(
        F.col("slot") < 5, F.concat(F.lit("("), F.col("slot"), F.lit("-"), F.col("q"), F.lit(")"))
    ).otherwise("-")
    row = _words(
        F.col("ar"), _int("q"), _tenths("c", "t"), "4", "5", _int("s"), spread, _int("p"),
        _tenths("t", "c"), _int("c"), F.concat(F.lit("(1-"), F.col("q"), F.lit(")")),
    )
    title = F.element_at(
        F.array(*map(F.lit, ["Tabla 6a. ", "Tabla 6. ", "Tabla 6, "])),
        (F.col("report_id") % 3 + 1).cast("int"),
    )
    text = F.concat(title, F.lit("Indicadores "), F.col("body"), F.lit(" Total 1 2"))
    rows = reports.transmission_indicators(
        _pages(_by_region(spark, sf, row), text), first=None
    )
    ti = "transmission_indicators"
    return rounded(rows.select(
        "report_id", "date", "autonomous_region",
        F.col(f"{ti}.cases_unknown_contact.total").alias("unknown_total"),
        F.col(f"{ti}.cases_unknown_contact.percentage").alias("unknown_percentage"),
        F.col(f"{ti}.identified_contacts_per_case.median").alias("contacts"),
        F.col(f"{ti}.identified_contacts_per_case.iq.low").alias("contacts_low"),
        F.col(f"{ti}.identified_contacts_per_case.iq.high").alias("contacts_high"),
        F.col(f"{ti}.days_until_diagnostic.median").alias("days"),
        F.col(f"{ti}.days_until_diagnostic.iq.low").alias("days_low"),
        F.col(f"{ti}.days_until_diagnostic.iq.high").alias("days_high"),
        F.col(f"{ti}.asymptomatic_percentage").alias("asymptomatic"),
    ))


@workload("report_dates", """
    SELECT o_orderkey AS report_id,
           CASE WHEN CAST(o_orderdate AS DATE) >= DATE '2000-01-01'
                THEN CAST(o_orderdate + INTERVAL 20 YEARS AS DATE) END AS report_date
    FROM orders
""")
def report_dates(spark, sf):
    """Covers with every lead phrase and date format; years before 202x are unreadable."""
    day = F.to_date(F.add_months(F.to_date("o_orderdate"), 240))
    month = F.element_at(F.array(*map(F.lit, d.MONTHS)), F.month(day))
    form, lead = F.col("o_orderkey") % 3, F.col("o_orderkey") % len(d.DATE_LEADS)
    written = F.when(form == 0, F.concat_ws(" de ", F.day(day), month, F.year(day))).when(
        form == 1, F.concat(F.day(day), F.lit(" "), F.initcap(month), F.lit(" de "), F.year(day))
    ).otherwise(F.date_format(day, "dd-MM-yyyy"))
    leads = F.array(*[F.lit(phrase + "47."[:skipped]) for phrase, skipped in d.DATE_LEADS])
    pages = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("report_id"), F.lit(0).alias("page_no"),
        F.concat(
            F.lit("Equipo \n de vigilancia. "), F.element_at(leads, (lead + 1).cast("int")),
            F.lit(" "), written, F.lit(". Resumen 1 de 2"),
        ).alias("text"),
    )
    return reports.report_dates(pages)
