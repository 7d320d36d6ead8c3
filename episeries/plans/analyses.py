"""Extracted tables to the analysed ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episeries.functions import domains as d
from episeries.functions import measures as m
from episeries.operators import windows as w
from episeries.operators.combine import lookup_join, snapshot_difference, union_rows
from episeries.operators.recode import constant, different_from, equal_to, flatten, recode
from episeries.operators.reshape import unpivot
from episeries.operators.totals import append_national, expand_national, group_sum

SERIES_KEYS = ["autonomous_region", "gender", "age_range"]
KEYS = ["date", *SERIES_KEYS]
# Days looked back at by the increases of deaths and admissions.
INCREASE_DAYS = {"daily": 2, "weekly": 8, "two_weeks": 15, "monthly": 31}


def population_by_gender(population: DataFrame) -> DataFrame:
    """Population in the panel's age bands, one row per gender."""
    bands = group_sum(
        recode(population, "age_range", d.decade_bands()),
        ["age_range", "autonomous_region"], d.GENDERS,
    )
    return unpivot(bands, ["autonomous_region", "age_range"], d.GENDERS, "gender", "population")


def with_population(panel: DataFrame, population: DataFrame) -> DataFrame:
    """The panel rows that have a population, with it."""
    return lookup_join(panel, population_by_gender(population), SERIES_KEYS)


def _rate(count: Column) -> Column:
    return m.per_population(count, F.col("population"))


def _rates(*measures: str) -> dict[str, Column]:
    return {
        f"{kind}_{name}_per_population": _rate(F.col(f"{kind}_{name}"))
        for name in measures for kind in ("new", "total")
    }


# Population is constant within a series, so a mean of rates is the rate of the
# mean; taking the window over the counts keeps it exact.

def cases(panel: DataFrame) -> DataFrame:
    """Incidence of cases. ``panel`` comes from :func:`with_population`."""
    window = w.series(*SERIES_KEYS)
    new = F.col("new_cases")
    df = w.with_day(panel.select(*KEYS, "new_cases", "total_cases", "population"))
    df = df.withColumns({
        **_rates("cases"),
        "ci_last_14_days": _rate(w.rolling_sum(new, window, 14)),
        "new_cases_ma_1w": _rate(w.rolling_mean(new, window, 8)),
        "new_cases_ma_2w": _rate(w.rolling_mean(new, window, 15)),
    })
    df = w.smoothed_changes(df, "new_cases", window, {
        "daily_increase": (7, 1), "weekly_increase": (14, 7), "monthly_increase": (60, 30),
    })
    return df.withColumn("inverted_ci", m.inverted_rate(F.col("ci_last_14_days"))).drop(
        w.DAY, "population"
    )


def deaths(panel: DataFrame) -> DataFrame:
    """Deaths and mortality."""
    window = w.series(*SERIES_KEYS)
    new = F.col("new_deaths")
    df = w.with_day(panel.select(
        *KEYS, "new_deaths", "total_deaths", "new_cases", "total_cases", "population"
    ))
    df = df.withColumns({
        **_rates("deaths"),
        **{f"{span}_increase": w.range_change(new, window, days)
           for span, days in INCREASE_DAYS.items()},
        "new_deaths_ma_1w": _rate(w.rolling_mean(new, window, 8)),
        "new_deaths_ma_2w": _rate(w.rolling_mean(new, window, 15)),
        "mortality_2w": m.safe_percentage(
            w.rolling_mean(new, window, 15), w.rolling_mean(F.col("new_cases"), window, 15)
        ),
        "mortality_total": m.safe_percentage(F.col("total_deaths"), F.col("total_cases")),
    })
    return df.drop(w.DAY, "new_cases", "total_cases", "population")


def hospitalizations(panel: DataFrame) -> DataFrame:
    """Hospital and intensive-care admissions and their ratios to cases."""
    window = w.series(*SERIES_KEYS)
    names = {
        "hospitalizations": ("hospitalizations", "new_hospitalizations", "hospitalization_ratio"),
        "ic_hospitalizations": ("ic", "new_ic", "hospitalization_ic_ratio"),
    }
    df = w.with_day(panel.select(
        *KEYS, *[f"{kind}_{name}" for name in names for kind in ("new", "total")],
        "new_cases", "total_cases", "population",
    ))
    cases_mean = w.rolling_mean(F.col("new_cases"), window, 15)
    derived = _rates(*names)
    for name, (increase, average, ratio) in names.items():
        new = F.col(f"new_{name}")
        derived |= {
            **{f"{increase}_{span}_increase": w.range_change(new, window, days)
               for span, days in INCREASE_DAYS.items()},
            f"{average}_ma_1w": _rate(w.rolling_mean(new, window, 8)),
            f"{average}_ma_2w": _rate(w.rolling_mean(new, window, 15)),
            f"{ratio}_2w": m.safe_percentage(w.rolling_mean(new, window, 15), cases_mean),
            f"{ratio}_total": m.safe_percentage(F.col(f"total_{name}"), F.col("total_cases")),
        }
    return df.withColumns(derived).drop(w.DAY, "new_cases", "total_cases", "population")


def _all_ages(population: DataFrame) -> DataFrame:
    return equal_to(population, {"age_range": d.TOTAL}).select(
        "autonomous_region", F.col("total").alias("population")
    )


def vaccination_progress(general: DataFrame, population: DataFrame) -> DataFrame:
    """Vaccinated shares of the population and daily progress by region."""
    window = w.series("autonomous_region")
    people = F.col("population")
    df = w.with_day(lookup_join(general, _all_ages(population), "autonomous_region"))
    df = df.withColumns({
        "percentage_fully_vaccinated":
            m.percentage(F.col("number_fully_vaccinated_people"), people),
        "percentage_at_least_single_dose":
            m.percentage(F.col("number_at_least_single_dose_people"), people),
        "new_vaccinations": w.day_delta(F.col("number_fully_vaccinated_people"), window),
    })
    return df.withColumn(
        "new_vaccinations_ma_7d", w.rolling_mean(F.col("new_vaccinations"), window, 7)
    ).drop(w.DAY, "population")


def symptoms(clinic: DataFrame, date: str = d.SYMPTOMS_DATE) -> DataFrame:
    """Share of patients per symptom in one report."""
    snapshot = clinic.filter(F.col("date") == F.to_date(F.lit(date))).select("symptom", "patients")
    return recode(
        flatten(snapshot, {"percentage": "patients.total.percentage"}),
        "symptom", d.SYMPTOM_LABELS,
    )


def covid_deaths_of_year(deaths_table: DataFrame, as_of: str) -> DataFrame:
    """National deaths in the 365 days to ``as_of``, by age and gender.

    Before a full year has passed since the first deaths, the count so far is
    scaled to a year.
    """
    import datetime

    national = equal_to(deaths_table, {"autonomous_region": d.NATIONAL})
    start = datetime.date.fromisoformat(d.FIRST_DEATHS_DATE)
    if (datetime.date.fromisoformat(as_of) - start).days >= 365:
        return snapshot_difference(
            national, ["age_range", "gender"], "date", "total_deaths", as_of
        ).withColumn("total_deaths", F.col("total_deaths").cast("double"))
    now = F.to_date(F.lit(as_of))
    return national.filter(F.col("date") == now).select(
        "age_range", "gender",
        m.annualise(
            F.col("total_deaths"), F.to_date(F.lit(d.FIRST_DEATHS_DATE)), now
        ).alias("total_deaths"),
    )


def _causes_by_decade(causes: DataFrame) -> DataFrame:
    return group_sum(
        recode(causes, "age_range", d.decade_bands()),
        ["age_range", "death_cause", "gender"], ["total_deaths"],
    )


def top_death_causes(causes: DataFrame, covid: DataFrame, n: int = 10) -> DataFrame:
    """The leading causes of death in every age band and gender."""
    columns = ["age_range", "gender", "death_cause", "total_deaths"]
    every = union_rows(
        constant(covid, death_cause=d.COVID_CAUSE).select(*columns),
        different_from(_causes_by_decade(causes), "death_cause", d.ALL_CAUSES)
        .select(*columns).withColumn("total_deaths", F.col("total_deaths").cast("double")),
    )
    top = w.top_rows(
        every, ["age_range", "gender"],
        [F.col("total_deaths").desc_nulls_last(), F.col("death_cause")], n,
    )
    return top.withColumn("total_deaths", m.round_to_long(F.col("total_deaths")))


def covid_vs_all_deaths(causes: DataFrame, covid: DataFrame) -> DataFrame:
    """COVID deaths against all other deaths."""
    # Only the all-causes rows are needed, so they are picked before the sum.
    others = group_sum(
        recode(equal_to(causes, {"death_cause": d.ALL_CAUSES}), "age_range", d.decade_bands()),
        ["age_range", "gender"], ["total_deaths"],
    ).withColumnRenamed("total_deaths", "other_deaths")
    joined = lookup_join(
        covid.select("age_range", "gender", F.col("total_deaths").alias("covid_deaths")),
        others, ["age_range", "gender"],
    )
    return joined.withColumn(
        "covid_percentage", m.share_of_sum(F.col("covid_deaths"), F.col("other_deaths"))
    )


def population_pyramid(population: DataFrame, versus: DataFrame) -> DataFrame:
    """National population by age and gender less the COVID deaths."""
    national = equal_to(population, {"autonomous_region": d.NATIONAL})
    people = population_by_gender(national).drop("autonomous_region")
    joined = lookup_join(
        people, versus.select("age_range", "gender", "covid_deaths"), ["age_range", "gender"]
    )
    return joined.select(
        "age_range", "gender",
        (F.col("population") - F.col("covid_deaths")).alias("alive_population"),
        "covid_deaths",
    )


def diagnostic_tests_progress(tests: DataFrame, population: DataFrame) -> DataFrame:
    """Tests and positivity by region and nationwide, smoothed and cumulated."""
    window = w.series("autonomous_region")
    panel = expand_national(
        tests, ["date"], "autonomous_region", d.NATIONAL,
        sums=["total_diagnostic_tests"], means=["positivity"],
    ).withColumnRenamed("total_diagnostic_tests", "new_diagnostic_tests")
    new = F.col("new_diagnostic_tests")
    df = lookup_join(panel, _all_ages(population), "autonomous_region")
    df = w.with_day(df).withColumns({
        "positivity_ma_14d": w.rolling_mean(F.col("positivity"), window, 14),
        "total_diagnostic_tests": w.running_total(F.coalesce(new, F.lit(0)), window),
        "new_diagnostic_tests_ma_14d": w.rolling_mean(new, window, 14),
        "average_positivity": w.running_mean(F.col("positivity"), window),
    })
    return df.withColumn(
        "total_tests_per_population", _rate(F.col("total_diagnostic_tests"))
    ).drop(w.DAY, "population")


def hospital_pressure(extracted: DataFrame) -> DataFrame:
    """Patients and bed use by region and nationwide, with 14-day means."""
    window = w.series("autonomous_region")
    patients = ["hospitalized_patients", "ic_patients"]
    beds = ["beds_percentage", "ic_beds_percentage"]
    panel = append_national(
        extracted.select("date", "autonomous_region", *patients, *beds),
        ["date"], "autonomous_region", d.NATIONAL, sums=patients, means=beds,
    )
    return w.with_day(panel).withColumns({
        f"{c}_ma_14d": w.rolling_mean(F.col(c), window, 14) for c in beds
    }).drop(w.DAY)


def transmission_indicators(extracted: DataFrame) -> DataFrame:
    """Contact tracing indicators by region and their plain national mean."""
    root = "transmission_indicators"
    fields = {
        "cases_unknown_contact": f"{root}.cases_unknown_contact.percentage",
        "identified_contacts_per_case": f"{root}.identified_contacts_per_case.median",
        "asymptomatic_percentage": f"{root}.asymptomatic_percentage",
    }
    flat = flatten(extracted.select("date", "autonomous_region", root), fields)
    flat = flat.withColumns({c: F.col(c).cast("double") for c in fields})
    return append_national(
        flat, ["date"], "autonomous_region", d.NATIONAL, means=list(fields)
    )
