"""One refresh: extracted tables, then analysed ones, each written once as a new version.

Every table is written before the next step reads it, so steps share no long
lineage and the three analyses of the daily panel do not recompute it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from episeries.plans import analyses, ingest, reports, serving
from episeries.sources import files
from episeries.sources.storage import copy_table, new_version, stored, write_table
from episeries.streaming.intake import publish_batch, publish_new_files, published

EXTRACTED = "extracted"
ANALYSED = "analysed"
REPORTS = "reports"
REJECTS = "rejects"

#: What each series of reports holds: the table and its reader.
SERIES = {
    "daily": {
        "hospitals_pressure": reports.read_hospital_pressure,
        "outbreaks_description": reports.read_outbreaks,
    },
    "weekly": {
        "clinic_description": reports.read_clinic_description,
        "transmission_indicators": reports.read_transmission_indicators,
    },
}


def report_tables(series: str) -> Callable[[DataFrame], dict[str, DataFrame]]:
    """The tables of some pages of a series, and what could not be read of them."""
    def tables(pages: DataFrame) -> dict[str, DataFrame]:
        # read once from where it was written; every table selects from this copy
        pages = stored(reports.with_dates(pages))
        known = pages.filter("report_date IS NOT NULL")
        found, lost = {}, [reports.undated(pages)]
        for table, reader in SERIES[series].items():
            read = stored(reader(known))
            found[table] = reports.good_rows(read)
            lost.append(reports.rejects(read, table))
        return found | {REJECTS: reduce(DataFrame.unionByName, lost)}

    return tables


def take_reports(spark: SparkSession, root: str, series: str, pages: DataFrame | str) -> None:
    """Publish a series' tables and rejects under ``root``.

    A folder of page files is taken in as a stream: each run reads only the files that no
    earlier run has read. Pages of a report must come in one run. A DataFrame is all there is:
    it replaces what was published before.
    """
    target = f"{root}/{REPORTS}/{series}"
    if isinstance(pages, str):
        publish_new_files(
            spark, pages, report_tables(series), target, f"{target}/_intake", "text",
            "value string", {"wholetext": "true"}, prepare=files.named_pages)
    else:
        publish_batch(pages, 0, report_tables(series), target)


def refresh(spark: SparkSession, root: str, raw: Mapping[str, DataFrame | str], as_of: str) -> None:
    """Write a new version of all tables under ``root``; it counts once all of it is there.

    ``raw`` holds the inputs: daily_counts, provinces, tests, test_provinces,
    population, death_causes, vaccination_sheets, daily_report_pages and
    weekly_report_pages; the two last may also be folders of page files, of which each run
    reads the new ones only. What could not be read is in the table ``extracted/rejects``.
    """
    for series in SERIES:
        take_reports(spark, root, series, raw[f"{series}_report_pages"])
    with new_version(spark, f"{root}/{EXTRACTED}") as extracted, new_version(
            spark, f"{root}/{ANALYSED}") as analysed:
        write_tables(spark, {EXTRACTED: extracted, ANALYSED: analysed},
                     f"{root}/{REPORTS}", raw, as_of)


def write_tables(
    spark: SparkSession, folders: Mapping[str, str], published_reports: str,
    raw: Mapping[str, DataFrame | str], as_of: str,
) -> None:
    """Write the extracted and the analysed tables to the folder of each layer."""
    def path(layer: str, table: str) -> str:
        return f"{folders[layer]}/{table}"

    def extracted(table: str) -> DataFrame:
        return spark.read.parquet(path(EXTRACTED, table))

    def analysed(table: str) -> DataFrame:
        return spark.read.parquet(path(ANALYSED, table))

    def store(layer: str, table: str, df: DataFrame) -> None:
        write_table(df, path(layer, table), table)

    def reported(series: str, table: str) -> DataFrame:
        return published(spark, f"{published_reports}/{series}", table)

    sheets = raw["vaccination_sheets"]
    for table, df in {
        "daily_data": ingest.daily_panel(raw["daily_counts"], raw["provinces"]),
        "diagnostic_tests": ingest.diagnostic_tests(raw["tests"], raw["test_provinces"]),
        "population_ar": ingest.population(raw["population"]),
        "death_causes": ingest.death_causes(raw["death_causes"]),
        "vaccination_general": ingest.vaccination_general(sheets),
        "vaccination_ages_single": ingest.vaccination_ages(sheets, "single"),
        "vaccination_ages_complete": ingest.vaccination_ages(sheets, "complete"),
        **{table: reported(series, table).drop("report_id")
           for series, tables in SERIES.items() for table in tables},
        REJECTS: reduce(DataFrame.unionByName, [
            *[reported(series, REJECTS) for series in SERIES], ingest.rejected_sheets(sheets)]),
    }.items():
        store(EXTRACTED, table, df)

    population = extracted("population_ar")
    panel = analyses.with_population(extracted("daily_data"), population)
    store(ANALYSED, "cases", analyses.cases(panel))
    store(ANALYSED, "deaths", analyses.deaths(panel))
    store(ANALYSED, "hospitalizations", analyses.hospitalizations(panel))
    store(ANALYSED, "vaccination_general",
          analyses.vaccination_progress(extracted("vaccination_general"), population))
    for table in ("vaccination_ages_single", "vaccination_ages_complete",
                  "outbreaks_description"):
        copy_table(spark, path(EXTRACTED, table), path(ANALYSED, table), table)
    store(ANALYSED, "symptoms", analyses.symptoms(extracted("clinic_description")))
    store(ANALYSED, "diagnostic_tests",
          analyses.diagnostic_tests_progress(extracted("diagnostic_tests"), population))
    store(ANALYSED, "hospitals_pressure",
          analyses.hospital_pressure(extracted("hospitals_pressure")))
    store(ANALYSED, "transmission_indicators",
          analyses.transmission_indicators(extracted("transmission_indicators")))

    # Deaths come before causes, and causes before the pyramid.
    causes = extracted("death_causes")
    covid = analyses.covid_deaths_of_year(analysed("deaths"), as_of)
    store(ANALYSED, "top_death_causes", analyses.top_death_causes(causes, covid))
    store(ANALYSED, "covid_vs_all_deaths", analyses.covid_vs_all_deaths(causes, covid))
    store(ANALYSED, "population_pyramid_variation",
          analyses.population_pyramid(population, analysed("covid_vs_all_deaths")))

    for table in serving.TABLES:
        serving.store_counts(spark, folders[ANALYSED], table)
