"""Report page texts to tables.

Input: ``pages(report_id, report_date, page_no, text)``. Every page is read once;
those with a title are brought together by report, where windows over their title
numbers pick the wanted ones. The text of a table is cut into rows by one split,
and only rows, not words, meet array functions.

Each table has a reader (``read_…``) that gives a value or a reason: a row with its label and
the cells it could not read, or, for a report of which no row could be read, one row that says
why. :func:`good_rows` and :func:`rejects` are two selections of that one result, so nothing
that is lost stops the other reports, and nothing is lost unseen.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episeries.functions import domains as d
from episeries.functions.measures import complement, sample_size
from episeries.functions.textnum import (
    after_last, at, bind, cover_date, locale_double, locale_long, normalise,
    numeric_range, replace_literals, replace_patterns, replace_words, spaced, whole_number,
)
from episeries.operators.recode import recoded

REGION_WORDS = {d.joined(name): name for name in d.REGIONS}
TABLE_PAGE = ["report_id", "report_date", "table_no", "position", "text"]

# Why something was not read.
NO_ROW, NO_NEXT_PAGE, NO_DATE, BAD_CELL = (
    "no row read", "following page missing", "no report date", "unreadable cell")
REJECT = "report_id long, table_name string, row string, cell string, reason string"


def normalised(pages: DataFrame) -> DataFrame:
    return pages.withColumn("text", normalise(F.col("text")))


# --- where a table is -----------------------------------------------------

def numbered_tables(pages: DataFrame, pattern: str = d.NUMBERED_TITLE) -> DataFrame:
    """(report_id, table_no, page_no): the last page that titles each number."""
    numbers = F.array_distinct(F.regexp_extract_all("text", F.lit(pattern), F.lit(1)))
    return (
        pages.select("report_id", "page_no", F.explode(numbers).alias("_n"))
        .groupBy("report_id", whole_number(F.col("_n"), "int").alias("table_no"))
        .agg(F.max("page_no").alias("page_no"))
        .filter("table_no IS NOT NULL")  # no table has a number beyond int
    )


def named_tables(pages: DataFrame, titles: dict[str, str] = d.TABLE_TITLES) -> DataFrame:
    """(report_id, table_name, table_no): number on the first page with the title."""
    hits = F.filter(
        F.array(*[
            F.struct(
                F.lit(name).alias("table_name"),
                whole_number(
                    F.regexp_extract(F.regexp_extract("text", title, 0), r"^Tabla ([0-9]+)", 1),
                    "int",
                ).alias("table_no"),
            )
            for name, title in titles.items()
        ]),
        lambda hit: hit["table_no"].isNotNull(),
    )
    return (
        pages.select("report_id", "page_no", F.inline(hits))
        .groupBy("report_id", "table_name")
        .agg(F.min_by("table_no", "page_no").alias("table_no"))
    )


def with_position(index: DataFrame) -> DataFrame:
    """Add -1 if the next-numbered table shares the page, 1 if the previous does."""
    by_number = Window.partitionBy("report_id").orderBy("table_no")

    def shares_page(neighbour: Callable[[str], Column], step: int) -> Column:
        return (neighbour("table_no").over(by_number) == F.col("table_no") + step) & (
            neighbour("page_no").over(by_number) == F.col("page_no")
        )

    return index.withColumn(
        "position",
        F.when(shares_page(F.lead, 1), -1).when(shares_page(F.lag, -1), 1).otherwise(0),
    )


def located_table(pages: DataFrame, title: str) -> DataFrame:
    """(report_id, table_no, page_no, position) of the table with the title.

    The same answer as picking from :func:`named_tables`, looking up
    :func:`numbered_tables` and adding :func:`with_position`, but the page
    texts are scanned once. The windows run over title numbers, not pages.
    """
    number = F.regexp_extract(F.regexp_extract("text", title, 0), r"^Tabla ([0-9]+)", 1)
    numbers = F.array_distinct(F.regexp_extract_all("text", F.lit(d.NUMBERED_TITLE), F.lit(1)))
    titles = pages.select(
        "report_id", "page_no", number.alias("_named"), F.explode(numbers).alias("_n")
    )
    index = titles.groupBy("report_id", whole_number(F.col("_n"), "int").alias("table_no")).agg(
        F.max("page_no").alias("page_no"),
        F.min(F.when(F.col("_n") == F.col("_named"), F.col("page_no"))).alias("_first"),
    ).filter("table_no IS NOT NULL")
    report = Window.partitionBy("report_id")
    return (
        with_position(index)
        .withColumn("_earliest", F.min("_first").over(report))
        .filter(F.col("_first") == F.col("_earliest"))
        .drop("_first", "_earliest")
    )


def pages_of_named_table(pages: DataFrame, name: str, following: int = 0) -> DataFrame:
    """Page of a named table per report, with the pages that follow it.

    The pages that :func:`located_table` names, found in one pass: the pages of a report
    meet once, with their title numbers beside them. Pages without any title are dropped
    before that unless a following page is wanted.
    """
    others = [c for c in pages.columns if c not in ("report_id", "page_no")]
    if not following:
        pages = pages_where(pages, lambda text: F.contains(text, F.lit("Tabla ")))
    named = F.regexp_extract(
        F.regexp_extract("text", d.TABLE_TITLES[name], 0), r"^Tabla ([0-9]+)", 1)
    numbers = F.array_distinct(F.regexp_extract_all("text", F.lit(d.NUMBERED_TITLE), F.lit(1)))
    report = Window.partitionBy("report_id")
    table = Window.partitionBy("report_id", "table_no")
    place = F.col("page_no")

    def last_page(step: int) -> Column:
        number = F.col("table_no").cast("long") + step
        return F.max(F.when(F.array_contains("_numbers", number), place)).over(table)

    read = pages.filter("report_id IS NOT NULL").select(
        "report_id", "page_no", *others, whole_number(named, "int").alias("_named"),
        F.transform(numbers, lambda n: whole_number(n, "int").cast("long")).alias("_numbers"))
    titled = F.when(F.col("_named").isNotNull() & place.isNotNull(),
                    F.struct(place.alias("page"), F.col("_named").alias("number")))
    found = read.withColumn("_titled", F.collect_set(titled).over(report)).select(
        "report_id", "page_no", *others, "_numbers",
        F.explode(on_first_page(F.col("_titled"))).alias("table_no"))
    last = found.select("*", last_page(0).alias("_last"), last_page(1).alias("_next"),
                        last_page(-1).alias("_previous"))
    position = F.when(F.col("_next") == F.col("_last"), -1).when(
        F.col("_previous") == F.col("_last"), 1).otherwise(0)
    part = place - F.col("_last")
    return last.filter(part.between(0, following)).select(
        "report_id", "page_no", *others, "table_no", position.alias("position"),
        part.cast("int").alias("part"))


def on_first_page(titled: Column) -> Column:
    """The table numbers that the least page names, of (page, number)."""
    return bind(F.array_min(titled)["page"], lambda first: F.transform(
        F.filter(titled, lambda t: t["page"] == first), lambda t: t["number"]))


def pages_where(pages: DataFrame, wanted: Callable[[Column], Column]) -> DataFrame:
    """The pages with such a text. A plain filter would be pushed below the step that made the
    text, which would then be made twice."""
    others = [c for c in pages.columns if c != "text"]
    return pages.select(
        *others, F.explode(F.filter(F.array("text"), wanted)).alias("text")).select(*pages.columns)


def pages_of_table(pages: DataFrame, table_no: int) -> DataFrame:
    """Last page that titles the given number, per report."""
    titled = pages_where(pages, lambda text: text.rlike(rf"Tabla {table_no}[a-z]?[.,]"))
    return titled.groupBy("report_id").agg(
        F.max_by(F.struct("report_date", "text"), "page_no").alias("_p")
    ).select(
        "report_id", "_p.report_date", F.lit(table_no).alias("table_no"),
        F.lit(0).alias("position"), "_p.text",
    )


# --- words of a page to rows ----------------------------------------------

def marked_text(text: Column, table_no: Column) -> Column:
    """Words of a page with region names joined and the table title marked, one blank on either
    side of each."""
    marker = F.concat(F.lit("_TABLA"), table_no.cast("string"), F.lit("_"))
    title = F.concat(F.lit("Tabla "), table_no.cast("string"), F.lit("."))
    joined = F.replace(replace_literals(text, d.REGION_PHRASES), title, marker)
    clean = F.trim(F.regexp_replace(joined, f"{d.PAGE_NOISE}+", ""))
    single = bind(clean, lambda t: F.when(
        F.contains(t, F.lit("  ")), F.regexp_replace(t, " {2,}", " ")).otherwise(t))
    return F.concat(F.lit(" "), single, F.lit(" "))


def text_from(text: Column, word: Column) -> Column:
    """What :func:`from_word` gives, of words with a blank on either side; NULL without it."""
    return bind(text, lambda t: bind(
        F.position(F.concat(F.lit(" "), word, F.lit(" ")), t),
        lambda p: F.when(p > 0, F.substr(t, p)),
    ))


def from_word(words: Column, word: Column) -> Column:
    """The words from the first occurrence of ``word``; NULL without it."""
    return bind(words, lambda t: bind(
        F.array_position(t, word),
        lambda p: F.when(p > 0, F.slice(t, p.cast("int"), F.size(t))),
    ))


def segment(words: Column, is_head: Callable[[Column], Column],
            is_end: Callable[[Column], Column]) -> Column:
    """Split words into rows: a head opens a row, the first end closes the table."""
    def rows(t: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(t))
        end = F.coalesce(
            F.array_min(F.filter(places, lambda i: is_end(F.element_at(t, i)))), F.size(t) + 1
        )
        return bind(end, lambda e: bind(
            F.filter(places, lambda i: (i < e) & is_head(F.element_at(t, i))),
            lambda heads: F.transform(
                heads, lambda h, k: F.slice(t, h, F.coalesce(F.get(heads, k + 1), e) - h)
            ),
        ))

    return bind(words, lambda t: F.when(F.size(t) > 0, rows(t)))


def alternate(df: DataFrame, row_no: str = "row_no", position: str = "position") -> DataFrame:
    """Of two interleaved tables, keep the rows of the wanted one."""
    side = F.when(F.col(position) == 1, 1).otherwise(0)
    return df.filter((F.col(position) == 0) | F.col(row_no).isNull()
                     | (F.col(row_no) % 2 == side))


def region_rows(table_pages: DataFrame) -> DataFrame:
    """Rows (cells array, region first) of a table that is keyed by region.

    A page without any gives one row whose cells are NULL.
    """
    number = F.col("table_no").cast("string")
    text = text_from(
        text_from(
            marked_text(F.col("text"), F.col("table_no")),
            F.concat(F.lit("_TABLA"), number, F.lit("_")),
        ),
        F.lit(d.joined(d.REGIONS[0])),
    )

    def rows(pieces: Column) -> Column:
        # every word that starts like one opens a row, the first that is no region ends the table
        known = F.transform(pieces, lambda p: F.substring_index(p, " ", 1).isin(*REGION_WORDS))
        return bind(F.array_position(known, False).cast("int"), lambda end: F.slice(
            pieces, F.lit(1), F.when(end > 0, end - 1).otherwise(F.size(pieces))))

    found = bind(F.split(F.trim(text), f" (?={d.WORD_START.removeprefix('^')})"), rows)
    kept = [c for c in table_pages.columns if c != "text"]
    return table_pages.select(*kept, F.posexplode_outer(found).alias("row_no", "_piece")).select(
        *kept, "row_no", F.split("_piece", " ").alias("cells"))


def with_numbers(rows: DataFrame, counts: dict[str, Column], shares: dict[str, Column]
                 ) -> tuple[DataFrame, Callable[[str], Column], Callable[[str], Column]]:
    """Parse the named cells, as counts and as shares; the rows, and a column for each name.

    A row has cells that no result shows, so the wanted ones are picked first. Parsing inside
    an array function keeps the generated row code small enough for the JVM to compile it; a
    parser inlined per column is not.
    """
    def reader(cells: dict[str, Column], column: str) -> Callable[[str], Column]:
        places = {name: place for place, name in enumerate(cells)}
        return lambda name: F.get(column, F.lit(places[name]))

    parsed = {
        "_counts": F.transform(F.array(*counts.values()), lambda c: locale_long(c)),
        "_shares": F.transform(F.array(*shares.values()), lambda c: locale_double(c)),
    }
    wanted = [c for c, cells in (("_counts", counts), ("_shares", shares)) if cells]
    return (rows.withColumns({c: parsed[c] for c in wanted}),
            reader(counts, "_counts"), reader(shares, "_shares"))


def checked(rows: DataFrame, *columns: Column, label: Column, first: int = 2,
            reason: Column | None = None) -> DataFrame:
    """The columns with ``_row`` (what the row is about), ``_unread`` (cells from place
    ``first`` on that are neither number, share nor range) and ``_reason`` (NULL for a row)."""
    def unread(cell: Column, place: Column) -> Column:
        known = locale_long(cell).isNotNull() | locale_double(cell).isNotNull()
        return (place >= first - 1) & ~known & (cell != "") & numeric_range(cell)["low"].isNull()

    none = F.when(F.col("cells").isNull(), F.lit(NO_ROW))
    return rows.select(
        *columns, label.alias("_row"), F.filter("cells", unread).alias("_unread"),
        (F.coalesce(reason, none) if reason is not None else none).alias("_reason"),
    )


def good_rows(read: DataFrame) -> DataFrame:
    """The rows that could be read; a cell that could not is NULL."""
    return read.filter("_reason IS NULL").drop("_row", "_unread", "_reason")


def rejects(read: DataFrame, table: str) -> DataFrame:
    """What could not be read: whole reports, and single cells of rows."""
    whole = F.when(F.col("_reason").isNotNull(), F.array(F.struct(
        F.lit(None).cast("string").alias("cell"), F.col("_reason").alias("reason"))))
    cells = F.transform("_unread", lambda c: F.struct(
        c.alias("cell"), F.lit(BAD_CELL).alias("reason")))
    return read.select("report_id", F.lit(table).alias("table_name"), F.col("_row").alias("row"),
                       F.inline(F.coalesce(whole, cells)))


def _region() -> Column:
    return recoded(at(F.col("cells"), 1), REGION_WORDS).alias("autonomous_region")


def _cell(place: int) -> Column:
    return at(F.col("cells"), place)


def _day_before() -> Column:
    return F.date_sub("report_date", 1).alias("date")


# --- the tables -------------------------------------------------------------

def hospital_pressure(pages: DataFrame) -> DataFrame:
    """Hospital occupation per region."""
    return good_rows(read_hospital_pressure(pages))


def read_hospital_pressure(pages: DataFrame) -> DataFrame:
    """Hospital occupation per region; three column layouts."""
    found = pages_of_named_table(normalised(pages), "hospital_pressure").withColumns({
        "_ic": F.contains("text", F.lit(d.IC_BEDS_PHRASE)),
        "_rates": F.contains("text", F.lit(d.PER_INHABITANTS_PHRASE)),
    }).select(*TABLE_PAGE, "_ic", "_rates")
    ic, both = F.col("_ic"), F.col("_ic") & F.col("_rates")
    rows, count, share = with_numbers(
        alternate(region_rows(found)),
        counts={
            "hospitalized_patients": _cell(2),
            "ic_patients": F.when(both, _cell(-5)).otherwise(_cell(-4)),
            "admissions": _cell(-2), "discharges": _cell(-1),
        },
        shares={
            "beds_percentage":
                F.when(both, _cell(-6)).when(ic, _cell(-5)).otherwise(_cell(-3)),
            "ic_beds_percentage": F.when(ic, _cell(-3)),
        },
    )
    return checked(
        rows, F.col("report_id"), _day_before(), _region(),
        *[read(name).alias(name) for read, name in (
            (count, "hospitalized_patients"), (share, "beds_percentage"), (count, "ic_patients"),
            (share, "ic_beds_percentage"), (count, "admissions"), (count, "discharges"))],
        label=_region(),
    )


def hospital_cases(pages: DataFrame) -> DataFrame:
    """Hospitalised cases per region."""
    return good_rows(read_hospital_cases(pages))


def read_hospital_cases(pages: DataFrame) -> DataFrame:
    """Hospitalised cases per region; short rows lack the newest columns."""
    found = pages_of_named_table(normalised(pages), "hospital_cases").select(
        *TABLE_PAGE,
        F.when(F.contains("text", F.lit("IA")), True).otherwise(
            F.contains(F.regexp_replace("text", f"{d.PAGE_NOISE}+", ""), F.lit("IA"))
        ).alias("_ia"),
    )
    whole = Window.partitionBy("report_id")
    rows = alternate(region_rows(found)).withColumn(
        "_missing", F.max(F.size("cells")).over(whole) - F.size("cells")
    ).filter(F.col("cells").isNull() | (F.col("_missing") != 2))
    ia = F.col("_ia")
    rows, count, _ = with_numbers(rows, counts={
        "total_hospitalized_cases": F.when(ia, _cell(4)).otherwise(_cell(2)),
        "total_ic_cases":
            F.when(F.col("_missing") != 1, F.when(ia, _cell(5)).otherwise(_cell(4))),
    }, shares={})
    return checked(
        rows, F.col("report_id"), _day_before(), _region(),
        F.struct(*[count(name).alias(name) for name in (
            "total_hospitalized_cases", "total_ic_cases")]).alias("hospitalizations"),
        label=_region(),
    )


def outbreak_entries(first: Column, second: Column) -> Column:
    """Entries of the two-page outbreak table: arrays of a label, joined to one word, and cells."""
    text = F.concat(
        after_last(first, d.OUTBREAK_HEADER), F.lit(" "), after_last(second, d.OUTBREAK_HEADER)
    )
    words = F.concat(F.lit(" "), F.trim(replace_patterns(text, d.OUTBREAK_REPAIRS)))
    # every word with a letter is a label; what stands before the first belongs to none
    pieces = F.split(words, r"\s+(?=[^\s\p{L}]*\p{L})")
    return bind(pieces, lambda t: F.transform(
        F.slice(t, F.lit(2), F.size(t)), lambda piece: F.split(piece, r"\s+")))


def outbreak_rows(entries: Column) -> Column:
    """Array of (scope, label, cells); NULL if a label precedes every scope."""
    centre, labour = "Centro_sanitario", "Laboral"

    def last_before(places: Column, limit: Column) -> Column:
        return F.array_max(F.filter(places, lambda g: g <= limit))

    def labels(t: Column) -> Column:
        """The labels; the last but one "Otros" is the scope."""
        plain = F.transform(t, lambda words: F.get(words, F.lit(0)))
        return bind(plain, lambda names: bind(
            at(F.filter(F.sequence(F.lit(1), F.size(names)),
                        lambda i: F.element_at(names, i) == "Otros"), -2),
            lambda p: F.transform(names, lambda name, k: F.when(
                k + 1 == p, F.lit("Otro")).otherwise(name)),
        ))

    def rows(t: Column, names: Column) -> Column:
        def label(i: Column) -> Column:
            return F.element_at(names, i.cast("int"))

        def genuine(marked: Column) -> Column:
            # A health centre listed under the labour scope is no scope of its own.
            others = F.filter(marked, lambda i: label(i) != centre)
            return F.filter(marked, lambda i: (label(i) != centre) | F.coalesce(
                label(last_before(others, i)) != labour, F.lit(True)
            ))

        def listed(heads: Column) -> Column:
            every = F.transform(t, lambda words, k: F.struct(
                label(last_before(heads, k + 1)).alias("scope"),
                label(k + 1).alias("label"),
                F.slice(words, F.lit(2), F.size(words)).alias("cells"),
                (label(k + 1).isin(*d.OUTBREAK_SCOPES) & ~F.array_contains(heads, k + 1))
                .alias("skipped"),
            ))
            kept = F.filter(
                every,
                lambda e: ~e["skipped"] & F.size(e["cells"]).isin(6, 10),
            )
            return F.when(F.get(heads, F.lit(0)) == 1, kept)

        marked = F.filter(F.sequence(F.lit(1), F.size(names)),
                          lambda i: label(i).isin(*d.OUTBREAK_SCOPES))
        return bind(marked, lambda found: bind(genuine(found), listed))

    return bind(entries, lambda t: F.when(
        F.size(t) > 0, bind(labels(t), lambda names: rows(t, names))))


def outbreaks(pages: DataFrame) -> DataFrame:
    """Outbreaks and their cases by scope and sub-scope."""
    return good_rows(read_outbreaks(pages))


def read_outbreaks(pages: DataFrame) -> DataFrame:
    """Outbreaks and their cases; the table goes on on the following page."""
    found = pages_of_named_table(normalised(pages), "outbreaks_description", following=1)
    # Two pages per report at most: the group is bounded by construction.
    both = found.groupBy("report_id").agg(
        F.max(F.when(F.col("part") == 0, F.col("report_date"))).alias("report_date"),
        F.max(F.when(F.col("part") == 0, F.col("text"))).alias("_first"),
        F.max(F.when(F.col("part") == 1, F.col("text"))).alias("_second"),
    )
    rows, count, _ = with_numbers(both.select(
        "report_id", _day_before(), F.col("_second").isNull().alias("_alone"),
        F.inline_outer(outbreak_rows(outbreak_entries(F.col("_first"), F.col("_second")))),
    ), counts={
        "number": _cell(1),
        "cases": F.when(F.size("cells") == 6, _cell(2)).otherwise(_cell(3)),
    }, shares={})
    scope = F.col("scope")
    label = F.when(scope == F.col("label"), F.lit("Total")).otherwise(F.col("label"))
    number, infected = count("number"), count("cases")
    return checked(
        rows, F.col("report_id"), F.col("date"), spaced(scope).alias("scope"),
        F.concat(spaced(scope), F.lit(" - "), spaced(label)).alias("subscope"),
        F.struct(
            number.alias("number"), infected.alias("cases"),
            F.try_divide(infected.cast("double"), number).alias("cases_per_outbreak"),
        ).alias("outbreaks"),
        label=spaced(F.col("label")), first=1,
        reason=F.when(F.col("_alone"), F.lit(NO_NEXT_PAGE)),
    )


def clinic_description(
    pages: DataFrame, numbers: tuple[int, int] | None = d.SYMPTOM_REPORTS
) -> DataFrame:
    """Symptoms by gender, from the report numbers that print them legibly."""
    return good_rows(read_clinic_description(pages, numbers))


def read_clinic_description(
    pages: DataFrame, numbers: tuple[int, int] | None = d.SYMPTOM_REPORTS
) -> DataFrame:
    """Symptoms by gender; NULL for ``numbers`` reads all reports."""
    if numbers:
        pages = pages.filter(F.col("report_id").between(*numbers))
    found = pages_of_table(normalised(pages), 2)
    text = F.lower(F.regexp_replace("text", f"{d.SYMPTOM_NOISE}+", ""))
    text = replace_words(replace_literals(text, d.ILLNESS_PHRASES), d.SYMPTOM_PHRASES)
    pages_words = found.select("report_id", "report_date", F.split(text, " +").alias("_w"))
    return read_symptoms(pages_words)


def symptom_rows(words: DataFrame) -> DataFrame:
    """Symptom rows of tokenised pages ``(report_id, report_date, _w)``."""
    return good_rows(read_symptoms(words))


def read_symptoms(words: DataFrame) -> DataFrame:
    """Symptom rows of tokenised pages, or why there are none."""
    codes = F.array(*[F.lit(c) for c in dict.fromkeys(c for _, c in d.SYMPTOM_PHRASES)])
    w = F.col("_w")
    table = bind(
        from_word(w, F.lit("síntomas")),
        lambda t: bind(
            F.array_position(t, F.lit("enfermedades_previas")),
            lambda e: F.when(e > 0, F.slice(t, F.lit(2), (e - 2).cast("int"))),
        ),
    )
    total = F.array_position(w, F.lit("total"))
    rows = words.select(
        "report_id", "report_date", table.alias("_t"),
        F.when(at(w, F.nullif(total - 1, F.lit(0)).cast("int")) == "características", 0)
        .otherwise(1).alias("_samples"),
        F.array_position(w, F.lit("hombres")).alias("_men"),
        F.array_position(w, F.lit("mujeres")).alias("_women"),
    )
    both = (F.col("_men") > 0) & (F.col("_women") > 0)

    def entries(t: Column) -> Column:
        # cells are cut out here, as the words of the page would else be copied for each symptom
        return F.transform(F.when(both, F.array_intersect(codes, t)), lambda name: F.struct(
            name.alias("symptom"),
            F.slice(t, (F.array_position(t, name) + F.col("_samples")).cast("int") + 1, F.lit(6))
            .alias("cells"),
        ))

    rows = rows.select(
        "report_id", F.col("report_date").alias("date"),
        (F.col("_women") < F.col("_men")).alias("_women_first"),
        F.inline_outer(bind(F.col("_t"), entries)),
    )
    first = F.col("_women_first")
    places = {"total": (_cell(1), _cell(2)), **{
        who: tuple(F.when(here, _cell(place)).otherwise(_cell(place + 2)) for place in (3, 4))
        for who, here in (("women", first), ("men", ~first))}}
    parsed, count, share = with_numbers(
        rows, counts={who: number for who, (number, _) in places.items()},
        shares={who: percent for who, (_, percent) in places.items()})

    def group(name: str) -> Column:
        number, percent = count(name), share(name)
        return F.struct(
            sample_size(percent, number).alias("samples"),
            number.alias("number"), percent.alias("percentage"),
        ).alias(name)

    return checked(
        parsed, F.col("report_id"), F.col("date"), F.col("symptom"),
        F.struct(*map(group, ("total", "women", "men"))).alias("patients"),
        label=F.col("symptom"), first=1,
        reason=F.when(F.col("symptom").isNull(), F.lit(NO_ROW)),
    )


# Spellings of the title of table 6.
TITLE_6 = [("6a. ", "6. "), ("6 a.", "6. "), ("6, ", "6. ")]


def transmission_indicators(
    pages: DataFrame, first: int | None = d.TRANSMISSION_FIRST_REPORT
) -> DataFrame:
    """Contact tracing indicators per region, from report number ``first`` on."""
    return good_rows(read_transmission_indicators(pages, first))


def read_transmission_indicators(
    pages: DataFrame, first: int | None = d.TRANSMISSION_FIRST_REPORT
) -> DataFrame:
    """Contact tracing indicators per region; NULL for ``first`` reads all reports."""
    if first is not None:
        pages = pages.filter(F.col("report_id") >= first)
    found = pages_of_table(normalised(pages), 6).withColumn(
        "text", replace_literals(F.col("text"), TITLE_6)
    )
    rows, count, share = with_numbers(
        region_rows(found),
        counts={"unknown": _cell(-4), "contacts": _cell(-2), "days": _cell(6)},
        shares={"unknown": _cell(-3), "asymptomatic": _cell(3)},
    )

    def spread(median: str, quartiles: int) -> Column:
        return F.struct(
            count(median).alias("median"), numeric_range(_cell(quartiles)).alias("iq"))

    return checked(
        rows, F.col("report_id"), F.col("report_date").alias("date"), _region(),
        F.struct(
            F.struct(count("unknown").alias("total"), share("unknown").alias("percentage"))
            .alias("cases_unknown_contact"),
            spread("contacts", -1).alias("identified_contacts_per_case"),
            spread("days", 7).alias("days_until_diagnostic"),
            complement(share("asymptomatic")).alias("asymptomatic_percentage"),
        ).alias("transmission_indicators"),
        label=_region(),
    )


def report_dates(pages: DataFrame) -> DataFrame:
    """(report_id, report_date) from the cover page of each report."""
    cover = normalised(pages.filter(F.col("page_no") == 0))
    return cover.select("report_id", cover_date(F.col("text")).alias("report_date"))


def with_dates(pages: DataFrame) -> DataFrame:
    """Each report's date: the stamp its pages carry (``report_date``), else the cover page's,
    else the one in its file names (``file_date``); NULL if there is none.

    One small index per report is joined; page texts are not exchanged for it where it proves
    small.
    """
    cover = F.when(F.col("page_no") == 0, cover_date(normalise(F.col("text"))))
    found = {c: F.max(c) for c in ("report_date", "file_date") if c in pages.columns}
    in_order = [found.get("report_date"), F.max(cover), found.get("file_date")]
    index = pages.groupBy("report_id").agg(
        F.coalesce(*[c for c in in_order if c is not None]).alias("report_date"))
    return pages.drop("report_date", "file_date").join(index, "report_id", "left")


def undated(pages: DataFrame) -> DataFrame:
    """Rejects for the reports that :func:`with_dates` found no date for."""
    return pages.filter("report_date IS NULL").select("report_id").distinct().select(
        "report_id", F.lit(None).cast("string").alias("table_name"),
        F.lit(None).cast("string").alias("row"), F.lit(None).cast("string").alias("cell"),
        F.lit(NO_DATE).alias("reason"))


def rejected_reports(pages: DataFrame, parsed: DataFrame, table: str, title: str) -> DataFrame:
    """Reports that title a table of which no row could be read."""
    titled = normalised(pages).filter(F.col("text").rlike(title)).select("report_id").distinct()
    return titled.join(parsed.select("report_id").distinct(), "report_id", "left_anti").select(
        "report_id", F.lit(table).alias("table_name"), F.lit("no row read").alias("reason")
    )
