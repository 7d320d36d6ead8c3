"""Raw inputs to the extracted tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episeries.functions import domains as d
from episeries.functions.measures import percentage
from episeries.functions.textnum import bind, iso_date, month_name_date
from episeries.operators.combine import lookup_join
from episeries.operators.recode import (
    equal_to, recode, recode_patterns, recoded, rename, strip_prefix,
)
from episeries.operators.reshape import pivot_unique
from episeries.operators.totals import cube_totals, group_sum
from episeries.operators.windows import DAY, running_total, series, with_day
from episeries.sources.files import date_in_name

SERIES_KEYS = ["autonomous_region", "gender", "age_range"]
COUNTS = ["cases", "deaths", "hospitalizations", "ic_hospitalizations"]


def daily_panel(counts: DataFrame, provinces: DataFrame) -> DataFrame:
    """Daily counts per region, gender and age with all totals and running sums.

    ``counts`` has the columns of the daily file, ``provinces`` maps ``iso`` to
    ``comunidad autónoma``.
    """
    raw = rename(counts, {
        "sexo": "gender", "provincia_iso": "province", "grupo_edad": "age_range",
        "fecha": "date", "num_casos": "new_cases", "num_def": "new_deaths",
        "num_hosp": "new_hospitalizations", "num_uci": "new_ic_hospitalizations",
    })
    raw = recode(raw, "gender", d.DAILY_GENDER_CODES).withColumn("date", iso_date(F.col("date")))
    regions = provinces.select(
        F.col("iso").alias("province"), F.col("comunidad autónoma").alias("autonomous_region")
    )
    new = [f"new_{c}" for c in COUNTS]
    cube = cube_totals(
        lookup_join(raw, regions, "province"),
        fixed=["date"],
        members={"autonomous_region": d.NATIONAL, "gender": d.TOTAL, "age_range": d.TOTAL},
        measures=new,
    )
    window = series(*SERIES_KEYS)
    return with_day(cube).withColumns({
        f"total_{c}": running_total(F.col(f"new_{c}"), window) for c in COUNTS
    }).drop(DAY)


def diagnostic_tests(tests: DataFrame, provinces: DataFrame) -> DataFrame:
    """Daily tests and positivity per region.

    ``provinces`` maps ``province`` to ``autonomous_region``.
    """
    raw = rename(tests, {
        "PROVINCIA": "province", "FECHA_PRUEBA": "date",
        "N_ANT_POSITIVOS": "antigens_positive", "N_ANT": "antigens_total",
        "N_PCR_POSITIVOS": "pcr_positive", "N_PCR": "pcr_total",
    })
    raw = raw.withColumn("date", month_name_date(F.col("date")))
    daily = group_sum(
        lookup_join(raw, provinces.select("province", "autonomous_region"), "province"),
        ["date", "autonomous_region"],
        ["antigens_positive", "antigens_total", "pcr_positive", "pcr_total"],
    )
    total = F.col("antigens_total") + F.col("pcr_total")
    return daily.withColumns({
        "total_diagnostic_tests": total,
        "positivity": percentage(F.col("antigens_positive") + F.col("pcr_positive"), total),
    })


def population(raw: DataFrame) -> DataFrame:
    """Inhabitants per region and age band, one column per gender."""
    kept = equal_to(raw, {"Periodo": d.POPULATION_PERIOD, "Nacionalidad": "Total"})
    named = kept.select(
        F.col("Comunidades y ciudades autonomas").alias("autonomous_region"),
        F.trim("Grupo quinquenal de edad").alias("age_range"),
        F.col("Sexo").alias("gender"),
        F.col("Total").alias("population"),
    )
    named = recode(named, "autonomous_region", d.POPULATION_REGION_LABELS)
    named = recode(named, "gender", d.POPULATION_GENDER_LABELS)
    named = recode_patterns(named, "age_range", d.POPULATION_AGE_PATTERNS)
    return pivot_unique(
        named, ["autonomous_region", "age_range"], "gender", d.GENDERS, "population"
    )


def death_causes(raw: DataFrame) -> DataFrame:
    """Deaths by cause, gender and age in the reference year."""
    named = rename(equal_to(raw, {"Periodo": d.DEATHS_PERIOD}).drop("Periodo"), {
        "Causa de muerte": "death_cause", "Sexo": "gender", "Edad": "age_range",
        "Total": "total_deaths",
    })
    named = recode_patterns(named, "age_range", d.DEATHS_AGE_PATTERNS)
    named = strip_prefix(named, "death_cause", d.CAUSE_CODE_PATTERN)
    return recode(named, "gender", d.DEATHS_GENDER_LABELS)


def _cell_long(value: Column) -> Column:
    """A whole number, exactly; NULL for a fraction and for anything else."""
    number = value.try_cast("decimal(38,9)")
    return F.when(number == F.floor(number), number.try_cast("long"))


def _cell_percentage(value: Column) -> Column:
    """A share as a percentage; NULL if it is no finite number."""
    share = value.try_cast("double")
    return F.when(F.abs(share) < float("inf"), F.lit(100.0) * share)


def vaccination_general(sheets: DataFrame) -> DataFrame:
    """Doses and vaccinated people from the first sheet of every workbook."""
    prefix = "received_doses."
    # The first of repeated names counts, and missing cells are NULL: a bad sheet costs itself only.
    cells = bind(
        F.transform("header", lambda h: recoded(h, d.VACCINATION_COLUMNS)),
        lambda names: F.map_from_entries(F.array_compact(F.transform(names, lambda n, i: F.when(
            F.array_position(names, n) == i + 1, F.struct(n, F.get("cells", i)))))),
    )
    rows = sheets.filter(F.col("sheet_no") == 0).select("file_name", cells.alias("row"))

    def cell(name: str) -> Column:
        return F.col("row").getItem(name)

    received = F.transform_values(
        F.transform_keys(
            F.map_filter("row", lambda k, _: F.startswith(k, F.lit(prefix))),
            lambda k, _: F.regexp_replace(k, r"^received_doses\.", ""),
        ),
        lambda _, v: _cell_long(v),
    )
    return rows.select(
        date_in_name(F.col("file_name")).alias("date"),
        recoded(cell("autonomous_region"), d.SHEET_REGION_LABELS).alias("autonomous_region"),
        received.alias("received_doses"),
        _cell_long(cell("applied_doses")).alias("applied_doses"),
        _cell_percentage(cell("percentage_applied_doses"))
        .alias("percentage_applied_doses"),
        _cell_long(cell("number_at_least_single_dose_people"))
        .alias("number_at_least_single_dose_people"),
        _cell_long(cell("number_fully_vaccinated_people"))
        .alias("number_fully_vaccinated_people"),
    )


def kept_positions(header: Column) -> Column:
    """0-based positions a sheet layout keeps; wide sheets drop other columns."""
    dropped = F.when(
        F.size(header) > d.WIDE_SHEET_OVER, F.array(*map(F.lit, d.WIDE_SHEET_DROPS))
    ).otherwise(F.array(*map(F.lit, d.NARROW_SHEET_DROPS)))
    every = F.sequence(F.lit(0), F.size(header) - 1)
    return F.array_except(every, dropped)


def band_names(header: Column) -> Column:
    """Header names as age bands, by the layout the header shows."""
    new = F.exists(header, lambda h: F.contains(h, F.lit(d.AGE_BANDS_NEW_MARK)))

    def names(bands: dict[str, str]) -> Column:
        return F.transform(header, lambda h: F.when(
            h == F.element_at(header, -1), F.lit(d.TOTAL)
        ).otherwise(recoded(h, bands)))

    return F.when(new, names(d.AGE_BANDS_NEW)).otherwise(names(d.AGE_BANDS_OLD))


def vaccination_ages(sheets: DataFrame, doses: str) -> DataFrame:
    """Vaccinated share by age band; ``doses`` is ``single`` or ``complete``.

    Only workbooks of more than three sheets carry ages; the last two sheets
    hold them.
    """
    from_end = {"single": 2, "complete": 1}[doses]
    rows = sheets.filter(
        (F.col("sheets") > 3) & (F.col("sheet_no") == F.col("sheets") - from_end)
    )
    def kept(header: Column, cells: Column, bands: Column) -> Column:
        return F.transform(
            kept_positions(header),
            lambda i: F.struct(
                F.get(bands, i).alias("age_range"), F.get(cells, i).alias("cell")
            ),
        )

    def entries(row: Column) -> Column:
        region = recoded(F.get(row, F.lit(0))["cell"], d.SHEET_REGION_LABELS)
        bands = F.slice(row, 2, F.size(row))
        usable = (region != d.ARMED_FORCES) & ~F.exists(bands, lambda b: b["cell"].isNull())
        return F.when(usable, F.transform(bands, lambda b: F.struct(
            F.trim(region).alias("autonomous_region"), b["age_range"].alias("age_range"),
            b["cell"].alias("cell"),
        )))

    # Arrays are bound, or a lambda would rebuild them per cell; unusable rows
    # become NULL, which explodes to nothing, as a filter would be evaluated
    # apart from the projection.
    pairs = bind(F.col("header"), lambda header: bind(F.col("cells"), lambda cells: bind(
        band_names(header), lambda bands: kept(header, cells, bands)
    )))
    return rows.select(
        date_in_name(F.col("file_name")).alias("date"),
        F.inline(bind(pairs, entries)),
    ).select(
        "date", "autonomous_region", "age_range",
        _cell_percentage(F.col("cell")).alias("percentage"),
    )


def rejected_sheets(sheets: DataFrame) -> DataFrame:
    """Rejects, in the form of the report rejects, for workbooks whose name holds no date."""
    return sheets.filter(date_in_name(F.col("file_name")).isNull()).select(
        F.lit(None).cast("long").alias("report_id"), F.lit("vaccination").alias("table_name"),
        F.col("file_name").alias("row"), F.lit(None).cast("string").alias("cell"),
        F.lit("no date in the file name").alias("reason")).distinct()
