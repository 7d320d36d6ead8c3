"""Text, number and link operators on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from episeries.functions import domains as d
from episeries.functions import measures as m
from episeries.functions import textnum as t
from episeries.plans import reports
from episeries.sources.files import date_in_name, number_in_name
from episeries.sources.links import link_table
from episeries.workloads.registry import rounded, table, workload

# The blanks of BLANKS, spelt out for an engine without Unicode classes.
BLANKS = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
    r"\x{202f}\x{205f}\x{3000}]+"
)
CLEAN = f"trim(regexp_replace(replace(text, chr(10), ''), '{BLANKS}', ' ', 'g'))"


@workload("date_parse", """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS iso, CAST(o_orderdate AS DATE) AS month_name,
           CAST(o_orderdate AS DATE) AS compact, CAST(o_orderdate AS DATE) AS creation,
           CAST(o_orderdate AS DATE) AS in_name, o_orderkey AS number,
           CAST(o_orderdate AS DATE) - 1 AS day_before, CAST(NULL AS DATE) AS broken
    FROM orders
""")
def date_parse(spark, sf):
    day = F.to_date("o_orderdate")
    compact = F.date_format(day, "yyyyMMdd")
    text = table(spark, sf, "orders").select(
        "o_orderkey", F.date_format(day, "yyyy-MM-dd").alias("iso"),
        F.upper(F.date_format(day, "ddMMMyyyy")).alias("month_name"),
        compact.alias("compact"),
        F.concat(F.lit("D:"), compact, F.lit("093000+02'00'")).alias("creation"),
        F.concat(F.lit("Informe_"), compact, F.lit(".ods")).alias("dated_file"),
        F.concat(F.col("o_orderkey"), F.lit(".pdf")).alias("numbered_file"),
    )
    return text.select(
        "o_orderkey", t.iso_date(F.col("iso")).alias("iso"),
        t.month_name_date(F.col("month_name")).alias("month_name"),
        t.compact_date(F.col("compact")).alias("compact"),
        t.pdf_creation_date(F.col("creation")).alias("creation"),
        date_in_name(F.col("dated_file")).alias("in_name"),
        number_in_name(F.col("numbered_file")).alias("number"),
        F.date_sub(t.iso_date(F.col("iso")), 1).alias("day_before"),
        t.iso_date(F.col("compact")).alias("broken"),
    )


@workload("text_normalise", f"""
    SELECT doc_id, md5({CLEAN}) AS digest, CAST(length({CLEAN}) AS INTEGER) AS size,
           md5(regexp_replace(lower({CLEAN}), '{d.SYMPTOM_NOISE}', '', 'g')) AS plain
    FROM documents
""")
def text_normalise(spark, sf):
    text = table(spark, sf, "documents").select("doc_id", t.normalise(F.col("text")).alias("_t"))
    return text.select(
        "doc_id", F.md5("_t").alias("digest"), F.length("_t").alias("size"),
        F.md5(F.regexp_replace(F.lower("_t"), d.SYMPTOM_NOISE, "")).alias("plain"),
    )


@workload("text_phrases", f"""
    WITH c AS (SELECT doc_id, {CLEAN} AS t FROM documents),
         r AS (SELECT doc_id, replace(replace(replace(t, 'en la', 'en_la'), 'in the', 'in_the'),
                                      ' de ', ' of ') AS t FROM c)
    SELECT doc_id, md5(regexp_replace(t, '([A-zÀ-ú]) ([A-zÀ-ú])', '\\1_\\2', 'g')) AS joined,
           md5(replace(t, '_', ' ')) AS spaced, md5(string_split(t, '. ')[-1]) AS tail,
           t LIKE '%in_the%' ESCAPE '$' AS has_phrase
    FROM r
""")
def text_phrases(spark, sf):
    text = table(spark, sf, "documents").select(
        "doc_id",
        t.replace_words(
            t.replace_literals(
                t.normalise(F.col("text")), [("en la", "en_la"), ("in the", "in_the")]
            ),
            [("de", "of")],
        ).alias("_t"),
    )
    return text.select(
        "doc_id",
        F.md5(t.replace_patterns(F.col("_t"), [(r"([A-zÀ-ú]) ([A-zÀ-ú])", "$1_$2")]))
        .alias("joined"),
        F.md5(t.spaced(F.col("_t"))).alias("spaced"),
        F.md5(t.after_last(F.col("_t"), ". ")).alias("tail"),
        F.col("_t").like("%in_the%").alias("has_phrase"),
    )


@workload("tokens", f"""
    WITH w AS (SELECT doc_id, string_split({CLEAN}, ' ') AS t FROM documents)
    SELECT doc_id, CAST(len(t) AS INTEGER) AS words, t[1] AS first, t[-2] AS next_to_last,
           md5(array_to_string(list_filter(t, lambda x, i: i % 2 = 1), ' ')) AS even_places,
           md5(array_to_string(list_filter(t, lambda x, i: i % 2 = 0), ' ')) AS odd_places
    FROM w
""")
def tokens(spark, sf):
    words = table(spark, sf, "documents").select(
        "doc_id", t.tokens(t.normalise(F.col("text"))).alias("_w")
    )
    return words.select(
        "doc_id", F.size("_w").alias("words"), t.at(F.col("_w"), 1).alias("first"),
        t.at(F.col("_w"), -2).alias("next_to_last"),
        F.md5(F.concat_ws(" ", t.every_second(F.col("_w"), 0))).alias("even_places"),
        F.md5(F.concat_ws(" ", t.every_second(F.col("_w"), 1))).alias("odd_places"),
    )


@workload("locale_number", """
    SELECT l_orderkey, l_linenumber, CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS whole,
           ROUND(l_extendedprice, 2) AS price, ROUND(l_discount * 100, 2) AS share,
           CAST(NULL AS BIGINT) AS broken, CAST(NULL AS DOUBLE) AS missing
    FROM lineitem
""")
def locale_number(spark, sf):
    comma = F.translate(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), ".", ",")
    text = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.translate(
            F.format_number(F.round(F.col("l_extendedprice") * 100).cast("long"), 0), ",", "."
        ).alias("whole"),
        comma.alias("price"),
        F.concat(
            F.translate((F.col("l_discount") * 100).cast("decimal(18,2)").cast("string"), ".", ","),
            F.lit("%"),
        ).alias("share"),
        F.col("l_returnflag").alias("letter"),
    )
    return text.select(
        "l_orderkey", "l_linenumber", t.locale_long(F.col("whole")).alias("whole"),
        t.locale_double(F.col("price")).alias("price"),
        F.round(t.locale_double(F.col("share")), 2).alias("share"),
        t.locale_long(F.col("letter")).alias("broken"),
        t.nan_to_null(F.lit("NaN").cast("double")).alias("missing"),
    )


@workload("numeric_range", """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_linenumber < 7 THEN CAST(l_linenumber AS BIGINT) END AS low,
           CASE WHEN l_linenumber < 7 THEN CAST(l_suppkey AS BIGINT) END AS high
    FROM lineitem
""")
def numeric_range(spark, sf):
    text = F.when(F.col("l_linenumber") < 7, F.concat(
        F.lit("("), F.col("l_linenumber"), F.lit("-"), F.col("l_suppkey"), F.lit(")")
    )).otherwise(F.lit("-"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", t.numeric_range(text).alias("_r")
    ).select("l_orderkey", "l_linenumber", "_r.low", "_r.high")


@workload("sample_size", """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_discount > 0
                THEN CAST(FLOOR(CAST(l_quantity AS BIGINT) / (l_discount * 100 / 1e2)) AS BIGINT) END
             AS samples,
           CAST(round_even(l_quantity / 2, 0) AS BIGINT) AS half
    FROM lineitem
""")
def sample_size(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        m.sample_size(F.col("l_discount") * 100, F.col("l_quantity").cast("long")).alias("samples"),
        m.round_to_long(F.col("l_quantity") / 2).alias("half"),
    )


@workload("link_extract", r"""
    WITH a AS (SELECT page_id, unnest(regexp_extract_all(html,
                 '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 1)) AS href,
                 unnest(regexp_extract_all(html,
                 '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 2)) AS title,
                 generate_subscripts(regexp_extract_all(html,
                 '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>'), 1) AS pos
               FROM pages),
         c AS (SELECT page_id, replace(replace(replace(href, '&ordm;', 'º'), '&#186;', 'º'), '&amp;', '&')
                        AS href, pos,
                      replace(replace(replace(replace(replace(replace(
                        regexp_replace(title, '<[^>]*>', '', 'g'), '&nbsp;', ' '), '&#160;', ' '),
                        chr(160), ' '), '&ordm;', 'º'), '&#186;', 'º'), '&amp;', '&') AS title FROM a),
         r AS (SELECT lower(title) AS number, href, ROW_NUMBER() OVER (
                 PARTITION BY lower(title) ORDER BY page_id, pos DESC) AS rn
               FROM c WHERE regexp_matches(href, '^/'))
    SELECT number, href FROM r WHERE rn = 1
""")
def link_extract(spark, sf):
    return link_table(
        table(spark, sf, "pages").select("page_id", "html"), "page_id", "^/", key=F.lower
    )


def line_pages(spark, sf):
    """Each line of a document as a page whose title number is its length."""
    lines = table(spark, sf, "documents").select(
        F.col("doc_id").alias("report_id"), F.lit("2021-01-01").cast("date").alias("report_date"),
        F.posexplode(F.split("text", "\n")).alias("page_no", "line"),
    )
    number = (F.length("line") % 9 + 1).cast("string")
    named = F.when(F.length("line") % 4 == 0, F.lit("Situación capacidad asistencial "))
    return lines.select(
        "report_id", "report_date", "page_no",
        F.concat(F.lit("Tabla "), number, F.lit(". "), F.coalesce(named, F.lit("")), F.col("line"))
        .alias("text"),
    )


LINES = """
    split AS (SELECT doc_id AS report_id, unnest(string_split(text, chr(10))) AS line,
                     generate_subscripts(string_split(text, chr(10)), 1) - 1 AS page_no FROM documents),
    pages_ AS (SELECT report_id, CAST(page_no AS INTEGER) AS page_no,
                      CAST(length(line) % 9 + 1 AS INTEGER) AS table_no,
                      length(line) % 4 = 0 AS named, line FROM split),
    idx AS (SELECT report_id, table_no, MAX(page_no) AS page_no FROM pages_ GROUP BY ALL),
    pos AS (SELECT a.report_id, a.table_no, a.page_no,
                   CASE WHEN n.page_no = a.page_no THEN -1 WHEN p.page_no = a.page_no THEN 1 ELSE 0 END
                     AS position
            FROM idx a LEFT JOIN idx n ON n.report_id = a.report_id AND n.table_no = a.table_no + 1
            LEFT JOIN idx p ON p.report_id = a.report_id AND p.table_no = a.table_no - 1)
"""


@workload("table_index", f"WITH {LINES} SELECT * FROM idx")
def table_index(spark, sf):
    return reports.numbered_tables(line_pages(spark, sf))


@workload("named_tables", f"""
    WITH {LINES} SELECT report_id, 'hospital_pressure' AS table_name,
                        arg_min(table_no, page_no) AS table_no
    FROM pages_ WHERE named GROUP BY report_id
""")
def named_tables(spark, sf):
    return reports.named_tables(line_pages(spark, sf))


@workload("named_page", f"""
    WITH {LINES}, named AS (SELECT report_id, arg_min(table_no, page_no) AS table_no
                            FROM pages_ WHERE named GROUP BY report_id)
    SELECT report_id, table_no, pos.page_no, position, md5(line) AS digest
    FROM named JOIN pos USING (report_id, table_no) JOIN pages_ USING (report_id, page_no, table_no)
""")
def named_page(spark, sf):
    found = reports.pages_of_named_table(line_pages(spark, sf), "hospital_pressure")
    line = F.regexp_replace("text", r"^Tabla \d\. (Situación capacidad asistencial )?", "")
    return found.select(
        "report_id", "table_no", "page_no", "position", F.md5(line).alias("digest")
    )


# Two lines make a page here, so that tables can share one.
@workload("neighbours", """
    WITH split AS (SELECT doc_id AS report_id, unnest(string_split(text, chr(10))) AS line,
                          generate_subscripts(string_split(text, chr(10)), 1) - 1 AS no FROM documents),
    idx AS (SELECT report_id, CAST(length(line) % 9 + 1 AS INTEGER) AS table_no,
                   CAST(MAX(no // 2) AS INTEGER) AS page_no FROM split GROUP BY ALL)
    SELECT a.report_id, a.table_no, a.page_no,
           CASE WHEN n.page_no = a.page_no THEN -1 WHEN p.page_no = a.page_no THEN 1 ELSE 0 END
             AS position
    FROM idx a LEFT JOIN idx n ON n.report_id = a.report_id AND n.table_no = a.table_no + 1
    LEFT JOIN idx p ON p.report_id = a.report_id AND p.table_no = a.table_no - 1
""")
def neighbours(spark, sf):
    pages = line_pages(spark, sf).withColumn("page_no", F.floor(F.col("page_no") / 2).cast("int"))
    return reports.with_position(reports.numbered_tables(pages))


HEADS = ["de", "la", "the", "of", "and", "der", "die", "und", "el", "en"]
SEGMENTS = f"""
    w AS (SELECT doc_id, string_split({CLEAN}, ' ') AS t FROM documents),
    u AS (SELECT doc_id, unnest(t) AS word, generate_subscripts(t, 1) AS pos FROM w),
    e AS (SELECT *, MIN(CASE WHEN length(word) >= 16 THEN pos END) OVER (PARTITION BY doc_id) AS stop
          FROM u),
    k AS (SELECT *, SUM(CASE WHEN word IN ({', '.join(f"'{h}'" for h in HEADS)}) THEN 1 ELSE 0 END)
            OVER (PARTITION BY doc_id ORDER BY pos) AS n FROM e WHERE stop IS NULL OR pos < stop),
    s AS (SELECT doc_id, CAST(n - 1 AS INTEGER) AS row_no, arg_min(word, pos) AS head,
                 CAST(COUNT(*) AS INTEGER) AS cells, md5(string_agg(word, ' ' ORDER BY pos)) AS digest
          FROM k WHERE n > 0 GROUP BY doc_id, n)
"""


def _segments(spark, sf):
    heads = F.array(*[F.lit(h) for h in HEADS])
    rows = reports.segment(
        t.tokens(t.normalise(F.col("text"))),
        lambda word: F.array_contains(heads, word),
        lambda word: F.length(word) >= 16,
    )
    return table(spark, sf, "documents").select(
        "doc_id", F.posexplode(rows).alias("row_no", "_c")
    ).select(
        "doc_id", "row_no", t.at(F.col("_c"), 1).alias("head"), F.size("_c").alias("cells"),
        F.md5(F.concat_ws(" ", "_c")).alias("digest"),
    )


@workload("row_segments", f"WITH {SEGMENTS} SELECT * FROM s")
def row_segments(spark, sf):
    return _segments(spark, sf)


@workload("alternate_rows", f"""
    WITH {SEGMENTS} SELECT * FROM s
    WHERE CASE doc_id % 3 WHEN 0 THEN TRUE WHEN 1 THEN row_no % 2 = 1 ELSE row_no % 2 = 0 END
""")
def alternate_rows(spark, sf):
    side = F.when(F.col("doc_id") % 3 == 2, -1).otherwise(F.col("doc_id") % 3)
    return reports.alternate(_segments(spark, sf).withColumn("position", side)).drop("position")
