"""Raw files to stored tables to answers, on invented files."""

import datetime
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from episeries.plans import analyses, daily_run, ingest, paging, reports, serving
from episeries.sources import files, links, storage
from episeries.streaming.intake import process_new_files, publish_batch, published

D = datetime.date


@pytest.fixture()
def folder(spark):
    return storage.shared_folder(spark)


def write_text(spark, path, lines, encoding="UTF-8"):
    """Lines in order into one file."""
    (spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string")
     .coalesce(1).sortWithinPartitions("i").select("value")
     .write.option("encoding", encoding).option("quote", "\u0000").option("sep", "\u0001")
     .option("escape", "").csv(path))
    return path


@pytest.fixture(scope="module")
def raw(spark):
    root = storage.shared_folder(spark)
    daily = ["provincia_iso,sexo,grupo_edad,fecha,num_casos,num_hosp,num_uci,num_def"]
    rows = [("NA", "H", "0-9", "2021-01-01", 2, 1, 0, 0), ("NA", "M", "0-9", "2021-01-03", 4, 0, 0, 1),
            ("BI", "H", "0-9", "2021-01-01", 3, 0, 0, 0), ("VI", "H", "80+", "2021-01-01", 5, 2, 1, 2),
            ("", "H", "0-9", "2021-01-01", 100, 0, 0, 0), ("BI", "NC", "NC", "2021-01-01", 7, 0, 0, 0)]
    daily += [",".join(map(str, r)) for r in rows]
    provinces = ["provincia,iso,comunidad autónoma", "NAVARRA,NA,Navarra", "BIZKAIA,BI,País Vasco",
                 "ARABA,VI,País Vasco"]
    tests = ["PROVINCIA;FECHA_PRUEBA;N_ANT_POSITIVOS;N_ANT;N_PCR_POSITIVOS;N_PCR",
             "Álava;14JUL2021;1;10;4;10", "Navarra;14JUL2021;0;0;0;0", "Navarra;15JUL2021;5;50;0;50"]
    test_provinces = ["province;autonomous_region", "Álava;País Vasco", "Navarra;Navarra"]
    population = ["Comunidades y ciudades autonomas;Grupo quinquenal de edad;Sexo;Nacionalidad;Periodo;Total"]
    for region, factor in (("Total Nacional", 2), ("15 Navarra, Comunidad Foral de", 1),
                           ("16 País Vasco", 1)):
        for age in ("De 0 a 4 años", "De 5 a 9 años", "90 y más años", "Total"):
            for sex, n in (("Hombres", 1000), ("Mujeres", 1000), ("Ambos sexos", 2000)):
                total = f"{n * factor:,}".replace(",", ".")
                population.append(f"{region};{age};{sex};Total;1 de enero de 2020;{total}")
    population.append("16 País Vasco;Total;Hombres;Total;1 de enero de 2019;9")
    population.append("16 País Vasco;Total;Hombres;Extranjera;1 de enero de 2020;9")
    causes = ["Causa de muerte;Sexo;Edad;Periodo;Total",
              "001-102  I-XXII.Todas las causas;Total;Todas las edades;2018;1.000",
              "001-102  I-XXII.Todas las causas;Total;Todas las edades;2017;1",
              "001-102  I-XXII.Todas las causas;Hombres;De 1 a 4 años;2018;10",
              "053-061 IX.Enfermedades;Total;Todas las edades;2018;600",
              "053-061 IX.Enfermedades;Total;95 y más años;2018;6"]
    paths = {
        name: write_text(spark, f"{root}/{name}", lines, "ISO-8859-1" if name == "tests" else "UTF-8")
        for name, lines in {
            "daily": daily, "provinces": provinces, "tests": tests,
            "test_provinces": test_provinces, "population": population, "causes": causes,
        }.items()
    }
    counts = ("num_casos", "num_hosp", "num_uci", "num_def")
    sheets = []
    for date, header, cells in (
        ("20210210", ["Unnamed: 0", "Dosis entregadas Pfizer (1)", "Dosis entregadas (1)",
                      "Dosis administradas (2)", "% sobre entregadas",
                      "Nº Personas vacunadas(pauta completada)"],
         [["Navarra", "70", "100", "90", "0.9", "40"], ["Totales", "7", "10", "9", "0.9", None]]),
        ("20210211", ["Unnamed: 0", "Dosis entregadas Janssen (1)", "Total Dosis entregadas (1)",
                      "Dosis administradas (2)", "% sobre entregadas",
                      "Nº Personas vacunadas(pauta completada)", "Nº Personas con al menos 1 dosis"],
         [["Navarra", "5", "105", "95", "0.95", "50", "60"]]),
    ):
        sheets += [(f"Informe_{date}.ods", 0, 5, header, c) for c in cells]
    narrow = ["Unnamed: 0"]
    for i in range(8):
        narrow += ["20-29 n" if i == 6 else f"n{i}", "%" if i == 0 else f"%.{i}"]
    narrow += ["x", "y", "z"]
    wide = ["Unnamed: 0"]
    for i in range(7):
        wide += [f"n{i}", f"p{i}", "%" if i == 0 else f"%.{i}"]
    wide += ["tn", "tp", "t%"]
    for sheet_no, header in ((3, narrow), (4, wide)):
        value = ["0.5"] * (len(header) - 1)
        sheets += [("Informe_20210715.ods", sheet_no, 5, header, c) for c in (
            ["Navarra ", *value], ["Fuerzas Armadas", *value], ["Total España", *value],
            ["Galicia", None, None, None, *value[3:]],
        )]
    day = D(2021, 7, 14)
    pressure = "Tabla 3. Situación capacidad asistencial Andalucía 10 5 50,5% 1 2 Aragón 20 6 40,5% 3 4 Total"
    outbreak = "Tabla 4. Distribución del nº de brotes y casos por ámbito Casos/brote Social 2 6 3,0 1 1 1,0"
    symptoms = "Tabla 2. Características Total Hombres Mujeres Síntomas Tos 10 50% 4 40% 6 60% " \
               "Enfermedades y factores de riesgo"
    transmission = "Tabla 6. Indicadores Andalucía 10 60,5% 3 4 2 (1-3) 1.500 40% 3 (2-5) Total 1"
    page = "report_id long, page_no int, text string"
    return {
        "daily_counts": files.read_delimited(
            spark, paths["daily"], numbers=dict.fromkeys(counts, "long")),
        "provinces": files.read_lookup(spark, paths["provinces"]),
        "tests": files.read_delimited(
            spark, paths["tests"], separator=";", encoding="ISO-8859-1",
            numbers=dict.fromkeys(("N_ANT_POSITIVOS", "N_ANT", "N_PCR_POSITIVOS", "N_PCR"), "long")),
        "test_provinces": files.read_lookup(spark, paths["test_provinces"], ";"),
        "population": files.read_delimited(
            spark, paths["population"], separator=";", decimal=",", thousands=".",
            numbers={"Total": "long"}),
        "death_causes": files.read_delimited(
            spark, paths["causes"], separator=";", decimal=",", thousands=".",
            numbers={"Total": "long", "Periodo": "long"}),
        "vaccination_sheets": spark.createDataFrame(sheets, files.SHEET_ROWS),
        "daily_report_pages": spark.createDataFrame(
            [(60, 0, pressure, day), (60, 1, outbreak, day),
             (60, 2, "Casos/brote Familiar 1 4 4,0 1 1 1,0", day)],
            page + ", report_date date"),
        "weekly_report_pages": spark.createDataFrame(
            [(20, 0, "Fecha del informe: 29 de mayo de 2020."), (20, 1, symptoms),
             (40, 0, "Informe COVID-19 nº 40. 3 de junio de 2021"), (40, 1, transmission)], page),
    }


def test_daily_panel(raw):
    panel = ingest.daily_panel(raw["daily_counts"], raw["provinces"])
    rows = {(r["date"], r["autonomous_region"], r["gender"], r["age_range"]): r
            for r in panel.collect()}
    assert len(rows) == panel.count()  # one row per key
    first = D(2021, 1, 1)
    assert rows[first, "Navarra", "M", "0-9"]["new_cases"] == 2  # NA is a code, a blank is not
    assert rows[first, "España", "total", "total"]["new_cases"] == 17
    assert rows[first, "País Vasco", "M", "total"]["new_cases"] == 8
    assert rows[first, "País Vasco", "unknown", "NC"]["new_cases"] == 7
    third = rows[D(2021, 1, 3), "Navarra", "total", "total"]
    assert (third["new_cases"], third["total_cases"], third["total_deaths"]) == (4, 6, 1)


def test_population_and_causes(raw):
    people = {(r["autonomous_region"], r["age_range"]): (r["M"], r["F"], r["total"])
              for r in ingest.population(raw["population"]).collect()}
    assert people["País Vasco", "total"] == (1000, 1000, 2000)
    assert people["España", "≥90"] == (2000, 2000, 4000)
    causes = {tuple(r) for r in ingest.death_causes(raw["death_causes"])
              .select("death_cause", "gender", "age_range", "total_deaths").collect()}
    assert ("Todas las causas", "total", "total", 1000) in causes
    assert ("Todas las causas", "M", "1-4", 10) in causes
    assert ("Enfermedades", "total", "95+", 6) in causes and len(causes) == 4


def test_tests_keep_zero_days(raw):
    rows = {(r["date"], r["autonomous_region"]): (r["total_diagnostic_tests"], r["positivity"])
            for r in ingest.diagnostic_tests(raw["tests"], raw["test_provinces"]).collect()}
    assert rows == {(D(2021, 7, 14), "País Vasco"): (20, 25.0),
                    (D(2021, 7, 14), "Navarra"): (0, None), (D(2021, 7, 15), "Navarra"): (100, 5.0)}


def test_vaccination_tables(raw):
    rows = {(r["date"], r["autonomous_region"]): r
            for r in ingest.vaccination_general(raw["vaccination_sheets"]).collect()}
    assert rows[D(2021, 2, 10), "Navarra"]["received_doses"] == {"Pfizer": 70, "total": 100}
    assert rows[D(2021, 2, 11), "Navarra"]["received_doses"] == {"Janssen": 5, "total": 105}
    assert rows[D(2021, 2, 10), "España"]["number_fully_vaccinated_people"] is None
    assert rows[D(2021, 2, 11), "Navarra"]["percentage_applied_doses"] == 95.0
    single = ingest.vaccination_ages(raw["vaccination_sheets"], "single").collect()
    assert {(r["autonomous_region"], r["age_range"]) for r in single} == {
        (region, band) for region in ("Navarra", "España")  # a gap and the armed forces are dropped
        for band in ("80+", "70-79", "60-69", "50-59", "40-49", "30-39", "20-29", "12-19")}
    complete = ingest.vaccination_ages(raw["vaccination_sheets"], "complete").collect()
    assert {r["age_range"] for r in complete if r["autonomous_region"] == "Navarra"} == {
        "80+", "70-79", "60-69", "50-59", "25-49", "18-24", "16-17", "total"}
    assert {r["percentage"] for r in complete} == {50.0}
    assert "Galicia" not in {r["autonomous_region"] for r in complete}  # a gap drops the row


def test_annualised_before_a_full_year(spark):
    deaths = spark.createDataFrame(
        [(D(2020, 3, 25), "España", "total", "total", 2), (D(2020, 3, 25), "Navarra", "total", "total", 9)],
        "date date, autonomous_region string, gender string, age_range string, total_deaths long")
    got = analyses.covid_deaths_of_year(deaths, "2020-03-25").collect()
    assert [r["total_deaths"] for r in got] == [73.0]


def test_refresh_and_queries(spark, raw, folder):
    daily_run.refresh(spark, folder, raw, as_of="2021-01-03")
    root = f"{folder}/{daily_run.ANALYSED}"
    for table in serving.TABLES:
        assert spark.read.parquet(f"{storage.current_version(spark, root)}/{table}").columns, table

    cases = serving.query_table(spark, root, "cases", {
        "autonomous_region": "Navarra", "gender": "total", "age_range": "total", "date": ""})
    assert [(r["date"].day, r["new_cases"], r["total_cases_per_population"], r["ci_last_14_days"])
            for r in cases.orderBy("date").collect()] == [(1, 2, 100.0, 100.0), (3, 4, 300.0, 300.0)]
    assert serving.query_table(spark, root, "cases", {"gender": "unknown"}).count() == 0

    deaths = serving.query_table(spark, root, "deaths", {
        "autonomous_region": "España", "gender": "total", "age_range": "total"}).orderBy("date").collect()
    assert [(r["daily_increase"], r["weekly_increase"]) for r in deaths] == [(0.0, 0.0), (0.0, -50.0)]
    assert deaths[0]["mortality_total"] == pytest.approx(100 * 2 / 17)

    admissions = serving.query_table(spark, root, "hospitalizations", {
        "autonomous_region": "España", "gender": "total", "age_range": "total", "date": "2021-01-01"})
    row = admissions.first()
    assert row["hospitalization_ratio_total"] == pytest.approx(100 * 3 / 17)
    assert row["hospitalization_ic_ratio_2w"] == pytest.approx(100 * 1 / 17)

    doses = serving.query_table(spark, root, "vaccination_general",
                                fields=["received_doses.total", "new_vaccinations", "date"])
    assert set(doses.columns) == {"date", "received_doses", "new_vaccinations"}
    got = {(r["date"].day, tuple(r["received_doses"].items()), r["new_vaccinations"])
           for r in doses.collect()}
    assert got == {(10, (("total", 100),), None), (11, (("total", 105),), 10),
                   (10, (("total", 10),), None)}

    outbreaks = serving.query_table(spark, root, "outbreaks_description", {"scope": "Social"},
                                    "outbreaks.number").collect()
    assert [r.asDict(True) for r in outbreaks] == [{"outbreaks": {"number": 2}}]
    pressure = serving.query_table(spark, root, "hospitals_pressure",
                                   {"autonomous_region": "España", "date": "2021-07-13"}).first()
    assert (pressure["hospitalized_patients"], pressure["beds_percentage"]) == (30, 45.5)
    assert [tuple(r) for r in serving.query_table(spark, root, "symptoms").collect()] == [("Tos", 50.0)]
    ti = serving.query_table(spark, root, "transmission_indicators").collect()
    assert {(r["autonomous_region"], r["cases_unknown_contact"]) for r in ti} == {
        ("Andalucía", 40.0), ("España", 40.0)}
    tests = {(r["date"].day, r["autonomous_region"]): r for r in
             serving.query_table(spark, root, "diagnostic_tests").collect()}
    assert tests[14, "España"]["new_diagnostic_tests"] == 20
    assert tests[15, "Navarra"]["average_positivity"] == 5.0
    assert tests[15, "España"]["total_diagnostic_tests"] == 120
    with pytest.raises(KeyError):
        serving.query_table(spark, root, "vaccination")


@pytest.mark.parametrize("size", [1, 7, 10_000])
def test_pages_cover_all_rows_once(spark, size):
    rows = [(D(2021, 1, 1 + i % 3) if i % 5 else None, f"r{i % 4}" if i % 7 else None, i // 2)
            for i in range(11)]
    df = spark.createDataFrame(rows, "date date, autonomous_region string, n long")
    order = ["-date", "autonomous_region"]
    whole = [tuple(r) for r in df.orderBy(F.desc("date"), "autonomous_region", "n").collect()]
    for counts in (None, paging.page_counts(df, ["autonomous_region", "date"])):
        pages = [tuple(r) for p in range(11 // size + 2)
                 for r in serving.paged(df, order, str(size), str(p), counts).collect()]
        assert pages == whole
    assert serving.paged(df, order, page=3).count() == 11  # a page without a limit is ignored
    assert serving.leading_integer("10 rows") == 10 and serving.leading_integer("x") == 0


@pytest.mark.parametrize("descending", [False, True])
def test_pages_of_a_column_with_many_keys(spark, descending, monkeypatch):
    monkeypatch.setattr(paging, "PIVOTS", 3)
    df = spark.range(200).select((F.col("id") * 37 % 101).cast("double").alias("x"), "id")
    found = [r["x"] for p in (0, 6, 28) for r in
             serving.paged(df, ["-x" if descending else "x"], 7, p).collect()]
    whole = sorted((float(i * 37 % 101) for i in range(200)), reverse=descending)
    assert found == whole[:7] + whole[42:49] + whole[196:]


def test_a_page_reads_its_range_and_writes_nothing(spark, folder):
    spark.range(5000).select((F.col("id") % 50).alias("k"), "id").write.parquet(f"{folder}/t")
    page = serving.paged(spark.read.parquet(f"{folder}/t"), ["k"], 10, 250)
    plan = page._jdf.queryExecution().optimizedPlan().toString()
    assert ">= 25" in plan and "<= 25" in plan and "Limit 10" in plan
    assert [r["k"] for r in page.collect()] == [25] * 10


def test_tables_are_listed_with_their_filters(spark):
    listed = {r["table_name"]: r["filters"] for r in serving.available_tables(spark).collect()}
    assert len(listed) == 14
    assert listed["hospitals_pressure"] == ["autonomous_region", "date"] and listed["symptoms"] == []


def test_projection_ignores_unknown_fields(spark):
    df = spark.createDataFrame([((1, (2, 3)), "x")], "a struct<b:int,c:struct<d:int,e:int>>, z string")
    got = serving.projected(df, ["a.c.e", "nothing.here", "z"]).first()
    assert got.asDict(True) == {"a": {"c": {"e": 3}}, "z": "x"}
    assert serving.projected(df, ["a", "a.b"]).first().asDict(True) == {
        "a": {"b": 1, "c": {"d": 2, "e": 3}}}


def test_filter_reaches_the_file_scan(spark, folder):
    storage.write_table(spark.range(5).select(
        F.to_date(F.lit("2021-01-01")).alias("date"), F.col("id").cast("string").alias("autonomous_region"),
        F.col("id").alias("n"), F.lit(1).alias("unused")), f"{folder}/cases", "cases")
    df = serving.answer(spark.read.parquet(f"{folder}/cases"), "cases",
                        {"autonomous_region": "3"}, ["n"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(autonomous_region,3)" in plan
    assert "ReadSchema: struct<autonomous_region:string,n:bigint>" in plan
    assert [r["n"] for r in df.collect()] == [3]


def test_json_rows_show_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert json.loads(storage.json_rows(df).first()["json"]) == {"a": 1, "b": None}


def test_links(spark):
    def anchor(number, name):
        return f'<a class="x" href="/QueHacemos/{name}.pdf"><b>Informe&nbsp;n&ordm; {number}</b>. Situación</a>'

    rows = [(0, anchor(1, "old1") + anchor(2, "first2") + anchor(2, "last2") + '<a href="/x">y</a>'),
            (1, anchor(1, "new1") + anchor(3, "new3") + '<a href="/QueHacemos/z.pdf">Otro</a>')]
    df = spark.createDataFrame(rows, "page int, html string")
    got = {r["number"]: r["href"] for r in links.link_table(df, "page").collect()}
    assert got == {1: "/QueHacemos/old1.pdf", 2: "/QueHacemos/last2.pdf", 3: "/QueHacemos/new3.pdf"}


def test_stream_sees_each_file_once(spark, folder):
    source, target, marks = (f"{folder}/{n}" for n in ("in", "out", "marks"))

    def run():
        process_new_files(spark, source, "id long", lambda df: df, target, marks)
        return sorted(r["id"] for r in spark.read.parquet(target).collect())

    spark.range(0, 3).write.parquet(source)
    assert run() == [0, 1, 2] and run() == [0, 1, 2]
    spark.range(3, 5).write.mode("append").parquet(source)
    assert run() == [0, 1, 2, 3, 4]


def _page_files(folder, pages):
    os.makedirs(folder, exist_ok=True)
    for name, text in pages.items():
        with open(f"{folder}/{name}.txt", "w", encoding="utf-8") as file:
            file.write(text)


def test_reports_are_taken_in_once_with_rejects(spark, folder):
    pressure = ("Tabla 3. Situación capacidad asistencial % Camas Ocupadas UCI COVID "
                "Andalucía 1.234 5,5% 67 8,25% 9 1,2,3 Total 1")
    source, root = f"{folder}/in", f"{folder}/out"
    _page_files(source, {"60-0_20210714": pressure,
                         "61-0_20210715": "Tabla 3. Situación capacidad asistencial sin filas",
                         "62-0": pressure})

    def run():
        daily_run.take_reports(spark, root, "daily", source)
        rows = published(spark, f"{root}/reports/daily", "hospitals_pressure").collect()
        lost = published(spark, f"{root}/reports/daily", "rejects").collect()
        return (sorted((r["report_id"], r["date"], r["hospitalized_patients"]) for r in rows),
                sorted((r["report_id"], r["row"] or "", r["cell"] or "", r["reason"]) for r in lost))

    first = [(60, D(2021, 7, 13), 1234)]
    lost = [(60, "Andalucía", "1,2,3", "unreadable cell"), (61, "", "", "no row read"),
            (62, "", "", "no report date")]
    assert run() == (first, lost) and run() == (first, lost)
    seen = set(os.listdir(f"{root}/reports/daily/rejects"))
    # the next run reads the new file only: the old ones may be gone
    for name in os.listdir(source):
        os.remove(f"{source}/{name}")
    _page_files(source, {"63-0_20210716": pressure.replace("1.234", "7").replace("1,2,3", "10")})
    assert run() == ([*first, (63, D(2021, 7, 15), 7)], lost)
    assert len(set(os.listdir(f"{root}/reports/daily/rejects")) - seen) == 1


def test_a_batch_that_runs_twice_is_published_once(spark, folder):
    def tables(df):
        return {"even": df.filter("id % 2 = 0"), "odd": df.filter("id % 2 = 1")}

    for _ in range(2):
        publish_batch(spark.range(5), 7, tables, folder)
    publish_batch(spark.range(5, 8), 8, tables, folder)
    assert sorted(r["id"] for r in published(spark, folder, "even").collect()) == [0, 2, 4, 6]
    assert sorted(r["id"] for r in published(spark, folder, "odd").collect()) == [1, 3, 5, 7]


def test_dates_of_reports_in_order_of_their_sources(spark):
    cover = "Fecha del informe: 29 de mayo de 2020."
    rows = [(1, 0, cover, D(2020, 1, 1), D(2020, 1, 2)), (2, 0, cover, None, D(2020, 1, 2)),
            (3, 0, "x", None, D(2020, 1, 2)), (4, 1, cover, None, None)]
    df = spark.createDataFrame(rows, "report_id long, page_no int, text string, report_date date, "
                                     "file_date date")
    got = {r["report_id"]: r["report_date"] for r in reports.with_dates(df).collect()}
    assert got == {1: D(2020, 1, 1), 2: D(2020, 5, 29), 3: D(2020, 1, 2), 4: None}
    assert [r["report_id"] for r in reports.undated(reports.with_dates(df)).collect()] == [4]


def test_sheet_cells_are_exact(spark):
    df = spark.createDataFrame([("9007199254740993",), ("12.9",), ("12.0",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(ingest._cell_long(F.col("v"))).collect()] == [
        9007199254740993, None, 12, None, None]


def test_report_pages_and_sheets_from_files(spark, folder):
    rows = [("Informe_20210715.ods", 0, 3, ["a"], ["1"])]
    spark.createDataFrame(rows, files.SHEET_ROWS).write.json(f"{folder}/sheets")
    assert [tuple(r) for r in files.read_sheet_rows(spark, f"{folder}/sheets").collect()] == rows
    assert files.read_report_pages(spark, f"{folder}/sheets").columns == ["report_id", "page_no", "text"]
    names = spark.createDataFrame([("59.pdf", "I_20210210.ods")], "a string, b string")
    got = names.select(files.number_in_name(F.col("a")), files.date_in_name(F.col("b"))).first()
    assert tuple(got) == (59, D(2021, 2, 10))


def test_high_water(spark):
    df = spark.range(5)
    assert files.high_water(df, "id", 2).first()["high_water"] == 4
    assert files.high_water(df, "id", 9).first()["high_water"] == 9
    assert files.above_high_water(df, "id", 2).count() == 2


def test_windows_of_an_analysis_share_one_exchange(spark, folder):
    rows = [(D(2021, 1, 1), "r", "M", "0-9", 1, 1, 1, 1, 10)]
    spark.createDataFrame(rows, "date date, autonomous_region string, gender string, age_range string, "
                                "new_cases long, total_cases long, new_deaths long, total_deaths long, "
                                "population long").write.parquet(f"{folder}/panel")
    panel = spark.read.parquet(f"{folder}/panel")
    for analysis in (analyses.cases, analyses.deaths):
        plan = analysis(panel)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1, plan
        assert plan.count("+- Sort [") == 1, plan


def test_overwrite_and_append(spark, folder):
    path = f"{folder}/{uuid.uuid4().hex}"
    storage.write_table(spark.range(3), path)
    storage.write_table(spark.range(2), path)
    storage.write_table(spark.range(2), path, overwrite=False)
    assert files.read_table(spark, path).count() == 4
    assert files.read_table(spark, path, {"id": 1}, ["id"]).count() == 2


@pytest.mark.parametrize("marks, texts, wanted", [
    ({}, ("1,234", "1,234.5"), (1234, 1234.5)),
    ({"decimal": ","}, ("12,5", "1.234,5"), (None, 1234.5)),
    ({"thousands": "."}, ("1.234", "1.234"), (1234, 1234.0)),
    ({"decimal": ",", "thousands": "."}, ("1.234", "12,5"), (1234, 12.5)),
])
def test_number_marks_of_delimited_files(spark, tmp_path, marks, texts, wanted):
    (tmp_path / "a.csv").write_text("n;x\n" + ";".join(texts) + "\n")
    df = files.read_delimited(spark, str(tmp_path), separator=";", numbers={"n": "long", "x": "double"},
                              **marks)
    assert tuple(df.first()) == wanted


def test_a_bad_sheet_costs_itself_only(spark):
    header = ["Unnamed: 0", "Dosis entregadas (1)", "Total Dosis entregadas (1)", None,
              "Dosis entregadas Pfizer (1)", "% sobre entregadas"]
    sheets = spark.createDataFrame([
        ("Informe_Comunicacion_20210101.ods", 0, 1, header, ["Madrid", "10", "11", "x", "NaN", "NaN"]),
        ("Informe_Comunicacion_20210101.ods", 0, 1, header, ["Galicia", "1e30"]),
        ("Informe_Comunicacion_20210101.ods", 0, 1, [], []),
    ], files.SHEET_ROWS)
    rows = {r.autonomous_region: r for r in ingest.vaccination_general(sheets).collect()}
    assert len(rows) == 3
    assert rows["Madrid"].received_doses == {"total": 10, "Pfizer": None}
    assert rows["Madrid"].percentage_applied_doses is None
    assert rows["Galicia"].received_doses == {"total": None, "Pfizer": None}


def test_a_date_filter_takes_the_whole_value(spark):
    df = spark.sql("SELECT DATE'2021-07-14' AS date, 1 AS n")
    for value, n in (("2021-07-14", 1), ("2021-07-14T00:00:00", 1), ("2021-07-14garbage", 0)):
        assert serving.filtered(df, ["date"], {"date": value}).count() == n
