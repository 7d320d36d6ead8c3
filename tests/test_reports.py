"""Invented page texts, one per layout."""

import datetime

import pytest

from episeries.plans import reports

DAY = datetime.date(2021, 7, 14)
BEFORE = datetime.date(2021, 7, 13)


def pages(spark, *texts, report=60):
    return spark.createDataFrame(
        [(report, DAY, i, text) for i, text in enumerate(texts)],
        "report_id long, report_date date, page_no int, text string",
    )


TITLE = "Tabla 3. Situación capacidad asistencial "
ROWS_IC = "Andalucía 1.234 5,5% 67 8,25% 9 10 Castilla-La Mancha 20 1,5% 3 2% 4 5 ESPAÑA 1 2 3 4 5 6"


def pressure(df):
    return {r["autonomous_region"]: (
        r["date"], r["hospitalized_patients"], r["beds_percentage"], r["ic_patients"],
        r["ic_beds_percentage"], r["admissions"], r["discharges"],
    ) for r in reports.hospital_pressure(df).collect()}


@pytest.mark.parametrize("page, andalusia", [
    (TITLE + "% Camas Ocupadas UCI COVID " + ROWS_IC, (1234, 5.5, 67, 8.25, 9, 10)),
    (TITLE + "Andalucía 1.234 67 5,5% 9 10 Total 1 2 3 4 5", (1234, 5.5, 67, None, 9, 10)),
    (TITLE + "% Camas Ocupadas UCI COVID Tasa de ocupación hospitalaria por 100.000 "
     "Andalucía 1.234 14,6 5,5% 67 0,8 8,25% 9 10 Total 1", (1234, 5.5, 67, 8.25, 9, 10)),
])
def test_pressure_layouts(spark, page, andalusia):
    got = pressure(pages(spark, "cubierta", page.replace("Situación", "Si\ntuación", 1)))
    assert got["Andalucía"] == (BEFORE, *andalusia)


def test_pressure_region_names_and_end_of_table(spark):
    got = pressure(pages(spark, TITLE + "% Camas Ocupadas UCI COVID " + ROWS_IC))
    assert set(got) == {"Andalucía", "Castilla-La Mancha"}
    assert got["Castilla-La Mancha"] == (BEFORE, 20, 1.5, 3, 2.0, 4, 5)


@pytest.mark.parametrize("page, patients", [
    (TITLE + "Tabla 4. Otra. Andalucía 1 2 3,5 4 5 Andalucía 9 9 9 9 9 Aragón 6 7 8,5 9 10 Aragón 0 0",
     {"Andalucía": 1, "Aragón": 6}),
    ("Tabla 2. Otra. " + TITLE + "Andalucía 9 9 9 9 9 Andalucía 1 2 3,5 4 5 Aragón 0 0 Aragón 6 7 8,5 9 10",
     {"Andalucía": 1, "Aragón": 6}),
])
def test_side_by_side_tables(spark, page, patients):
    got = pressure(pages(spark, page))
    assert {k: v[1] for k, v in got.items()} == patients


def test_titles_point_to_pages(spark):
    df = pages(spark, "Tabla 3. a Tabla 4b. b", "ver Tabla 3, c", TITLE)
    index = {(r["table_no"], r["page_no"]) for r in reports.numbered_tables(df).collect()}
    assert index == {(3, 2), (4, 0)}
    found = reports.located_table(df, reports.d.TABLE_TITLES["hospital_pressure"]).collect()
    assert [(r["table_no"], r["page_no"], r["position"]) for r in found] == [(3, 2, 0)]


def test_a_bad_report_does_not_stop_the_others(spark):
    good = pages(spark, TITLE + "Andalucía 1 2 3,5 4 5 Total", report=61)
    bad = pages(spark, TITLE + "sin filas", report=62)
    df = good.union(bad)
    parsed = reports.hospital_pressure(df)
    assert {r["report_id"] for r in parsed.collect()} == {61}
    lost = reports.rejected_reports(
        df, parsed, "hospital_pressure", reports.d.TABLE_TITLES["hospital_pressure"]
    ).collect()
    assert [(r["report_id"], r["table_name"]) for r in lost] == [(62, "hospital_pressure")]


def test_outbreaks(spark):
    first = (
        "Tabla 5. Distribución del nº de brotes y casos por ámbito Brotes Casos/brote "
        "Centro sanitario 10 50 5,0 1 2 2,0 Hospital (planta, urgencias) 4 20 5,0 1 2 2,0 "
        "Laboral 1.100 5.500 5,0 10 20 2,0 Centro sanitario 7 70 10 1 2 2,0 "
        "Matadero, cárnica y/o similar 3 30 10 1 2 2,0"
    )
    second = (
        "sigue Casos/brote Social 6 12 2,0 Familiar 8 0 16 0 2,0 1 1 1,0 1 1 "
        "Otros 5 10 2,0 1 2 2,0 Otros 0 4 2,0 1 2 2,0 "
        "1 A efectos de notificación se cuentan los casos de un mismo domicilio."
    )
    rows = reports.outbreaks(pages(spark, "cubierta", first, second)).collect()
    got = {r["subscope"]: (r["scope"], *r["outbreaks"]) for r in rows}
    assert got == {  # the social row is neither six nor ten cells wide
        "Centro sanitario - Total": ("Centro sanitario", 10, 50, 5.0),
        "Centro sanitario - Hospital": ("Centro sanitario", 4, 20, 5.0),
        "Laboral - Total": ("Laboral", 1100, 5500, 5.0),
        "Laboral - Matadero/cárnica/similar": ("Laboral", 3, 30, 10.0),
        "Familiar - Total": ("Familiar", 8, 16, 2.0),
        "Otro - Total": ("Otro", 5, 10, 2.0),
        "Otro - Otros": ("Otro", 0, 4, None),
    }
    assert {r["date"] for r in rows} == {BEFORE}


def test_outbreaks_need_a_scope_first_and_a_second_page(spark):
    page = "Tabla 5. Distribución del nº de brotes y casos por ámbito Casos/brote "
    assert reports.outbreaks(pages(spark, page + "Social 1 2 2,0 1 2 2,0")).count() == 0
    orphan = pages(spark, page + "Hospital 1 2 2,0 1 2 2,0", "Casos/brote Social 1 2 2,0 1 2 2,0")
    assert reports.outbreaks(orphan).count() == 0


CASES = "Tabla 4. Casos de COVID-19 que han precisado hospitalización, ingreso en UCI "


@pytest.mark.parametrize("mark, expected", [
    ("IA ", {"Andalucía": (3, 4), "Aragón": (9, None)}),
    ("", {"Andalucía": (1, 3), "Aragón": (7, None)}),
])
def test_hospital_cases(spark, mark, expected):
    text = CASES + mark + "Andalucía 1 2 3 4 5 6 Aragón 7 8 9 10 11 Asturias 1 2 3 4 Total 9"
    rows = reports.hospital_cases(pages(spark, text)).collect()
    assert {r["autonomous_region"]: tuple(r["hospitalizations"]) for r in rows} == expected


@pytest.mark.parametrize("head, cells", [
    ("Características Total Hombres Mujeres", "1.000 50% 300 20,5% 700 0%"),
    ("Características n Total Mujeres Hombres", "88 1.000 50% 700 0% 300 20,5%"),
])
def test_symptoms(spark, head, cells):
    text = f"Tabla 2. {head} Síntomas Tos {cells} Fiebre o reciente historia de fiebre {cells} " \
           "Enfermedades y factores de riesgo Tos 9 9 9 9 9 9"
    rows = reports.clinic_description(pages(spark, text, report=20)).collect()
    assert {r["symptom"] for r in rows} == {"cough", "fever"}
    for r in rows:
        assert r["date"] == DAY
        assert tuple(r["patients"]["total"]) == (2000, 1000, 50.0)
        assert tuple(r["patients"]["women"]) == (None, 700, 0.0)
        assert tuple(r["patients"]["men"]) == (1463, 300, 20.5)
    assert reports.clinic_description(pages(spark, text, report=34)).count() == 0


@pytest.mark.parametrize("title", ["Tabla 6a. ", "Tabla 6. ", "Tabla 6, "])
def test_transmission(spark, title):
    text = title + "Indicadores Andalucía 10 60,5% 3 4 2 (1-3) 1.500 40% 3 (2-5) " \
        "C. Valenciana 10 60% 3 4 2 - 15 4% 3 - Total 1"
    rows = reports.transmission_indicators(pages(spark, text)).collect()
    got = {r["autonomous_region"]: r["transmission_indicators"] for r in rows}
    one, two = got["Andalucía"], got["Comunidad Valenciana"]
    assert tuple(one["cases_unknown_contact"]) == (1500, 40.0)
    assert one["identified_contacts_per_case"]["median"] == 3
    assert tuple(one["identified_contacts_per_case"]["iq"]) == (2, 5)
    assert tuple(one["days_until_diagnostic"]["iq"]) == (1, 3)
    assert one["asymptomatic_percentage"] == 39.5
    assert tuple(two["identified_contacts_per_case"]["iq"]) == (None, None)
    assert reports.transmission_indicators(pages(spark, text, report=33)).count() == 0


def test_report_dates(spark):
    df = pages(spark, "Equipo Fecha del informe: 3 de junio \nde 2021 y más", "otra")
    assert [r["report_date"] for r in reports.report_dates(df).collect()] == [
        datetime.date(2021, 6, 3)
    ]


def test_a_table_number_beyond_int_stops_nothing(spark):
    pages = spark.createDataFrame(
        [(1, 1, "Tabla 99999999999. Too large"), (1, 2, "Tabla 2. Fine")],
        "report_id long, page_no int, text string")
    assert [r.table_no for r in reports.numbered_tables(pages).collect()] == [2]


def titled(spark):
    rows = [
        (1, 0, "Tabla 2. Antes. Tabla 3. Situación capacidad asistencial"),
        (1, 1, "Tabla 4. Otra."), (1, 1, "Tabla 4. Otra."), (1, 2, "sin título"),
        (2, 5, "Tabla 3. Situación capacidad asistencial Tabla 4. Otra."),
        (2, 6, "Tabla 3, repetida"), (2, 7, "Tabla 4. repetida"),
        (3, 1, "Tabla 1. Situación capacidad asistencial"),
        (3, 1, "Tabla 2. Situación capacidad asistencial"), (3, 1, None), (3, 2, None),
        (4, 0, "Tabla 2147483647. Otra. Tabla 99999999999. Situación capacidad asistencial"),
        (5, None, "Tabla 1. Situación capacidad asistencial"), (6, 0, "sin título"),
        (None, 0, "Tabla 1. Situación capacidad asistencial"),
    ]
    return spark.createDataFrame(rows, "report_id long, page_no int, text string")


@pytest.mark.parametrize("following", [0, 1])
def test_pages_of_a_table_are_those_that_located_table_names(spark, following):
    df = titled(spark)
    target = reports.located_table(df, reports.d.TABLE_TITLES["hospital_pressure"])
    expected = [
        (t["report_id"], t["page_no"] + part, p["text"], t["table_no"], t["position"], part)
        for t in target.collect() for part in range(following + 1) for p in df.collect()
        if (p["report_id"], p["page_no"]) == (t["report_id"], (t["page_no"] or 0) + part)
        and None not in (t["report_id"], t["page_no"]) and (following or "Tabla " in (p["text"] or ""))
    ]
    got = [tuple(r) for r in
           reports.pages_of_named_table(df, "hospital_pressure", following).collect()]
    assert len(got) > 3
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_pages_are_read_once(spark, tmp_path):
    pages(spark, TITLE + ROWS_IC).write.parquet(f"{tmp_path}/pages")
    df = spark.read.parquet(f"{tmp_path}/pages")
    for read in (reports.hospital_pressure, reports.hospital_cases, reports.outbreaks):
        plan = read(df)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Join" not in plan


def test_a_title_is_found_by_one_window_and_wanted_cells_are_parsed(spark):
    df = pages(spark, TITLE + ROWS_IC)
    windows = {reports.hospital_pressure: 2, reports.hospital_cases: 3}
    for read, number in windows.items():
        plan = read(df)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Window [") == number
    for read, numbers in ((reports.hospital_pressure, ["_counts", "_shares"]),
                          (reports.hospital_cases, ["_counts"])):
        plan = read(df)._jdf.queryExecution().optimizedPlan().toString()
        assert [c for c in ("_counts", "_shares") if f" AS {c}#" in plan] == numbers
        assert "transform(cells#" not in plan


def test_words_of_a_page_are_not_copied_for_each_symptom(spark):
    text = "Tabla 2. Características Total Mujeres Hombres Síntomas tos 1 2 3 4 5 6 Enfermedad de " \
        "base y factores de riesgo"
    plan = reports.clinic_description(pages(spark, text), None)
    written = plan._jdf.queryExecution().optimizedPlan().toString()
    assert written.count("Generate ") == 2  # the titled page, then the rows
    assert "Generate explode(array_intersect" not in written and "Generate inline(" in written


def test_rows_end_at_the_first_word_that_is_no_region(spark):
    text = TITLE + "(datos) Aragón 1 1 1 1 1 Andalucía 1 2 3,5 % 4 5  Aragón! 6 7 8,5 9 10 " \
        "Nota Asturias 1 2 3,5 4 5"
    assert {k: v[1] for k, v in pressure(pages(spark, text)).items()} == {
        "Andalucía": 1, "Aragón": 6}
