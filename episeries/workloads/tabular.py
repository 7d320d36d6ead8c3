"""Projection, recode, join, total and reshape operators on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episeries.functions import domains as d
from episeries.functions import measures as m
from episeries.operators import combine, recode, reshape, totals
from episeries.operators.windows import DAY, series, running_total, top_rows, with_day
from episeries.plans import paging, serving
from episeries.sources import files, storage
from episeries.streaming.intake import process_new_files
from episeries.workloads.registry import rounded, table, workload


@workload("scan_project_filter", """
    SELECT o_orderkey AS order_id, o_totalprice AS price, 'orders' AS origin
    FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IS DISTINCT FROM '5-LOW'
""")
def scan_project_filter(spark: SparkSession, sf: str) -> DataFrame:
    df = files.read_table(
        spark, f"{sf}/orders.parquet", {"o_orderstatus": "F"},
        ["o_orderkey", "o_totalprice", "o_orderpriority"],
    )
    df = recode.different_from(df, "o_orderpriority", "5-LOW").drop("o_orderpriority")
    df = recode.rename(df, {"o_orderkey": "order_id", "o_totalprice": "price", "absent": "x"})
    return recode.constant(df, origin="orders")


@workload("recode_map", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'M' WHEN 'O' THEN 'F'
           ELSE o_orderstatus END AS gender FROM orders
""")
def recode_map(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("gender"))
    return recode.recode(df, "gender", {"F": "M", "O": "F"})


def _size_band():
    low = (F.floor(F.col("p_size") / 5) * 5).cast("int")
    return low, low + 4


@workload("band_coarsen", """
    SELECT CONCAT(p_size // 10 * 10, '-', p_size // 10 * 10 + 9) AS age_range,
           COUNT(*) AS parts, CAST(SUM(CAST(ROUND(p_retailprice * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM part GROUP BY p_size // 10
""")
def band_coarsen(spark, sf):
    low, high = _size_band()
    df = table(spark, sf, "part").select(
        F.concat_ws("-", low, high).alias("age_range"),
        F.lit(1).cast("long").alias("parts"),
        F.round(F.col("p_retailprice") * 100).cast("long").alias("cents"),
    )
    return totals.group_sum(
        recode.recode(df, "age_range", d.decade_bands()), ["age_range"], ["parts", "cents"]
    )


@workload("regex_recode", """
    SELECT p_partkey, CONCAT(p_size // 5 * 5, '-', p_size // 5 * 5 + 4) AS age_range,
           p_brand AS brand FROM part
""")
def regex_recode(spark, sf):
    low, high = _size_band()
    df = table(spark, sf, "part").select(
        "p_partkey",
        F.concat(F.lit(" De "), low, F.lit(" a "), high, F.lit(" años*")).alias("age_range"),
        F.concat(F.lit("001-102 X."), F.col("p_brand")).alias("brand"),
    )
    df = recode.recode_patterns(df, "age_range", d.POPULATION_AGE_PATTERNS)
    return recode.strip_prefix(df, "brand", d.CAUSE_CODE_PATTERN)


@workload("strip_priority", """
    SELECT o_orderkey, regexp_replace(o_orderpriority, '^[0-9]-', '') AS priority FROM orders
""")
def strip_priority(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("priority"))
    return recode.strip_prefix(df, "priority", "^[0-9]-")


@workload("lookup_join_sum", """
    SELECT r_name AS region, c_mktsegment AS segment, COUNT(*) AS customers,
           CAST(SUM(CAST(ROUND(c_acctbal * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY ALL
""")
def lookup_join_sum(spark, sf):
    df = combine.lookup_join(
        table(spark, sf, "customer").withColumnRenamed("c_nationkey", "n_nationkey"),
        table(spark, sf, "nation"), "n_nationkey",
    )
    df = combine.lookup_join(
        df.withColumnRenamed("n_regionkey", "r_regionkey"), table(spark, sf, "region"),
        "r_regionkey",
    )
    df = df.select(
        F.col("r_name").alias("region"), F.col("c_mktsegment").alias("segment"),
        F.lit(1).cast("long").alias("customers"),
        F.round(F.col("c_acctbal") * 100).cast("long").alias("cents"),
    )
    return totals.group_sum(df, ["region", "segment"], ["customers", "cents"])


@workload("composite_join_rate", """
    WITH people AS (SELECT c_nationkey AS nation, c_mktsegment AS segment, COUNT(*) AS population
                    FROM customer GROUP BY ALL),
         fact AS (SELECT c_nationkey AS nation, c_mktsegment AS segment, COUNT(*) AS n
                  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
    SELECT nation, segment, n, population, ROUND(1e5 * n / population, 4) AS rate
    FROM fact JOIN people USING (nation, segment)
""")
def composite_join_rate(spark, sf):
    # Orders are counted per customer before they meet the customers: a
    # customer with very many orders is one row by then.
    orders = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n")
    )
    people = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    )
    keys = ["nation", "segment"]
    counts = totals.group_sum(combine.lookup_join(orders, people, "c_custkey"), keys, ["n"])
    population = people.groupBy(*keys).agg(F.count("*").alias("population"))
    df = combine.lookup_join(counts, population, keys)
    return rounded(df.withColumn("rate", m.per_population(F.col("n"), F.col("population"))), 4)


@workload("cube_totals", """
    SELECT CAST(o_orderdate AS DATE) AS date,
           CASE WHEN GROUPING(o_orderstatus) = 1 THEN 'total' ELSE o_orderstatus END AS gender,
           CASE WHEN GROUPING(o_orderpriority) = 1 THEN 'all' ELSE o_orderpriority END AS age_range,
           CASE WHEN GROUPING(o_custkey % 7) = 1 THEN 'España'
                ELSE CAST(o_custkey % 7 AS VARCHAR) END AS autonomous_region,
           COUNT(*) AS n
    FROM orders
    GROUP BY CAST(o_orderdate AS DATE), CUBE (o_custkey % 7, o_orderstatus, o_orderpriority)
""")
def cube_totals(spark, sf):
    df = table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("date"), F.col("o_orderstatus").alias("gender"),
        F.col("o_orderpriority").alias("age_range"),
        (F.col("o_custkey") % 7).cast("string").alias("autonomous_region"),
        F.lit(1).cast("long").alias("n"),
    )
    return totals.cube_totals(
        df, ["date"], {"autonomous_region": "España", "gender": "total", "age_range": "all"}, ["n"]
    )


DAILY_EVENTS = """
    daily AS (SELECT CAST(ts AS DATE) AS date, event_type, COUNT(*) AS n,
                     100.0::DOUBLE * CAST(SUM(CASE WHEN value > 20 THEN 1 ELSE 0 END) AS DOUBLE)
                       / COUNT(*) AS high_share
              FROM events GROUP BY ALL)
"""


def _daily_events(spark, sf):
    high = F.count_if(F.col("value") > 20)
    return table(spark, sf, "events").groupBy(
        F.to_date("ts").alias("date"), "event_type"
    ).agg(F.count("*").alias("n"), m.percentage(high, F.count("*")).alias("high_share"))


NATIONAL_SQL = f"""
    WITH {DAILY_EVENTS}
    SELECT date, event_type, n, ROUND(high_share, 6) AS high_share FROM daily
    UNION ALL
    SELECT date, 'España', CAST(SUM(n) AS BIGINT), ROUND(AVG(high_share), 6) FROM daily GROUP BY date
"""


@workload("national_row", NATIONAL_SQL)
def national_row(spark, sf):
    return rounded(totals.append_national(
        _daily_events(spark, sf), ["date"], "event_type", "España", ["n"], ["high_share"]
    ))


@workload("national_row_one_pass", NATIONAL_SQL)
def national_row_one_pass(spark, sf):
    return rounded(totals.expand_national(
        _daily_events(spark, sf), ["date"], "event_type", "España", ["n"], ["high_share"]
    ))


@workload("national_mean", f"""
    WITH {DAILY_EVENTS}
    SELECT date, event_type, ROUND(high_share, 6) AS high_share FROM daily
    UNION ALL SELECT date, 'España', ROUND(AVG(high_share), 6) FROM daily GROUP BY date
""")
def national_mean(spark, sf):
    df = _daily_events(spark, sf).drop("n")
    return rounded(
        totals.append_national(df, ["date"], "event_type", "España", means=["high_share"])
    )


@workload("top10_per_group", """
    WITH t AS (SELECT p_type, l_returnflag, p_brand, SUM(CAST(l_quantity AS BIGINT)) AS total
               FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
         r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY p_type, l_returnflag
                                           ORDER BY total DESC, p_brand) AS rn FROM t)
    SELECT p_type, l_returnflag, p_brand, CAST(round_even(total / 4, 0) AS BIGINT) AS quarter
    FROM r WHERE rn <= 10
""")
def top10_per_group(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy(
        F.col("l_partkey").alias("p_partkey"), "l_returnflag"
    ).agg(F.sum(F.col("l_quantity").cast("long")).alias("total"))
    df = combine.lookup_join(lines, table(spark, sf, "part"), "p_partkey")
    keys = ["p_type", "l_returnflag"]
    df = totals.group_sum(df, [*keys, "p_brand"], ["total"])
    top = top_rows(df, keys, [F.col("total").desc(), F.col("p_brand")], 10)
    return top.select(*keys, "p_brand", m.round_to_long(F.col("total") / 4).alias("quarter"))


@workload("inverted_rate", """
    SELECT l_partkey, l_returnflag, COUNT(*) AS n,
           ROUND(CASE WHEN COUNT(*) > 10 THEN 1e5 / COUNT(*) ELSE 1e4 END, 6) AS inverted
    FROM lineitem GROUP BY ALL
""")
def inverted_rate(spark, sf):
    df = table(spark, sf, "lineitem").groupBy("l_partkey", "l_returnflag").agg(
        F.count("*").alias("n")
    )
    return rounded(df.withColumn("inverted", m.inverted_rate(F.col("n"))))


@workload("safe_ratio", """
    WITH c AS (SELECT o_custkey, SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS a,
                      SUM(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END) AS b
               FROM orders GROUP BY o_custkey)
    SELECT o_custkey,
           ROUND(CASE WHEN b = 0 AND a <> 0 THEN NULL WHEN b = 0 THEN 0
                      ELSE 1e2 * (CAST(a AS DOUBLE) / b) END, 6) AS ratio,
           ROUND(1e2 * (CAST(a AS DOUBLE) / NULLIF(a + b, 0)), 6) AS share,
           ROUND(1e2 - 1e2 * (CAST(a AS DOUBLE) / NULLIF(a + b, 0)), 6) AS rest
    FROM c
""")
def safe_ratio(spark, sf):
    df = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("a"),
        F.count_if(F.col("o_orderpriority") == "2-HIGH").alias("b"),
    )
    share = m.share_of_sum(F.col("a"), F.col("b"))
    return rounded(df.select(
        "o_custkey", m.safe_percentage(F.col("a"), F.col("b")).alias("ratio"),
        share.alias("share"), m.complement(share).alias("rest"),
    ))


RUNNING_ORDERS = """
    day AS (SELECT o_orderpriority AS priority, CAST(o_orderdate AS DATE) AS date, COUNT(*) AS n
            FROM orders GROUP BY ALL),
    run AS (SELECT priority, date, CAST(SUM(n) OVER (PARTITION BY priority ORDER BY date
                   ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM day)
"""


def _running_orders(spark, sf):
    daily = table(spark, sf, "orders").groupBy(
        F.col("o_orderpriority").alias("priority"), F.to_date("o_orderdate").alias("date")
    ).agg(F.count("*").alias("n"))
    total = running_total(F.col("n"), series("priority"))
    return with_day(daily).select("priority", "date", total.alias("total"))


@workload("snapshot_diff", f"""
    WITH {RUNNING_ORDERS}
    SELECT a.priority, a.total - b.total AS total
    FROM run a LEFT JOIN run b ON a.priority = b.priority AND b.date = DATE '2000-06-15' - 365
    WHERE a.date = DATE '2000-06-15'
""")
def snapshot_diff(spark, sf):
    return combine.snapshot_difference(
        _running_orders(spark, sf), ["priority"], "date", "total", "2000-06-15"
    )


@workload("annualise", f"""
    WITH {RUNNING_ORDERS}
    SELECT priority, date,
           ROUND(total * (CAST(365 AS DOUBLE) / NULLIF(date_diff('day', DATE '1995-01-01', date), 0)), 4)
             AS yearly
    FROM run
""")
def annualise(spark, sf):
    yearly = m.annualise(F.col("total"), F.lit("1995-01-01").cast("date"), F.col("date"))
    return rounded(
        _running_orders(spark, sf).select("priority", "date", yearly.alias("yearly")), 4
    )


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PIVOT_SQL = ", ".join(
    f"CAST(SUM(CASE WHEN c_mktsegment = '{s}' THEN 1 END) AS BIGINT) AS {s}" for s in SEGMENTS
)


def _segments(spark, sf):
    counts = table(spark, sf, "customer").groupBy("c_nationkey", "c_mktsegment").agg(
        F.count("*").alias("n")
    )
    return reshape.pivot_unique(counts, ["c_nationkey"], "c_mktsegment", SEGMENTS, "n")


@workload("pivot_segments", f"SELECT c_nationkey, {PIVOT_SQL} FROM customer GROUP BY c_nationkey")
def pivot_segments(spark, sf):
    return _segments(spark, sf)


@workload("unpivot_segments", f"""
    WITH p AS (SELECT c_nationkey, {PIVOT_SQL} FROM customer GROUP BY c_nationkey)
    SELECT c_nationkey, segment, n
    FROM p UNPIVOT INCLUDE NULLS (n FOR segment IN ({', '.join(SEGMENTS)}))
""")
def unpivot_segments(spark, sf):
    return reshape.unpivot(_segments(spark, sf), ["c_nationkey"], SEGMENTS, "segment", "n")


@workload("drop_scale_complete", """
    SELECT c_custkey, c_acctbal * 100 AS c_acctbal, c_mktsegment FROM customer
    WHERE c_acctbal IS NOT NULL AND c_mktsegment IS NOT NULL
""")
def drop_scale_complete(spark, sf):
    df = recode.drop_positions(table(spark, sf, "customer"), [1, 2])
    return recode.complete_rows(recode.scale(df, ["c_acctbal"]))


@workload("nest_unnest", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           length(props) AS size, value FROM events
""")
def nest_unnest(spark, sf):
    flat = table(spark, sf, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").cast("long").alias("props.k"),
        F.length("props").cast("long").alias("props.size"), "value",
    )
    nested = recode.nest_dotted(flat)
    return recode.flatten(nested, {"k": "props.k", "size": "props.size"})


@workload("schema_drift_union", """
    SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS date, o_totalprice AS amount,
           CAST(NULL AS VARCHAR) AS kind FROM orders
    UNION ALL
    SELECT event_id, CAST(ts AS DATE), NULL, event_type FROM events
""")
def schema_drift_union(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("date"),
        F.col("o_totalprice").alias("amount"),
    )
    events = table(spark, sf, "events").select(
        F.col("event_type").alias("kind"), F.to_date("ts").alias("date"),
        F.col("event_id").alias("id"),
    )
    return combine.union_rows(orders, events)


@workload("anti_new_inputs", """
    SELECT doc_id, source FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def anti_new_inputs(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return combine.new_inputs(docs, table(spark, sf, "labels").select("doc_id"), "doc_id")


@workload("high_water", "SELECT GREATEST(MAX(doc_id), 10) AS high_water FROM documents")
def high_water(spark, sf):
    return files.high_water(table(spark, sf, "documents"), "doc_id", 10)


@workload("above_high_water", """
    SELECT doc_id, lang FROM documents WHERE doc_id > (SELECT MAX(page_id) FROM pages)
""")
def above_high_water(spark, sf):
    mark = files.high_water(table(spark, sf, "pages"), "page_id", 0).first()["high_water"]
    return files.above_high_water(
        table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", mark
    )


@workload("write_read_roundtrip", """
    SELECT date, autonomous_region, n FROM (
        SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS autonomous_region,
               COUNT(*) AS n FROM orders GROUP BY ALL)
    UNION ALL
    SELECT DATE '2002-01-01', n_name, CAST(n_nationkey AS BIGINT) FROM nation
""")
def write_read_roundtrip(spark, sf):
    root = storage.shared_folder(spark)
    daily = table(spark, sf, "orders").groupBy(
        F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("autonomous_region")
    ).agg(F.count("*").alias("n"))
    more = table(spark, sf, "nation").select(
        F.lit("2002-01-01").cast("date").alias("date"), F.col("n_name").alias("autonomous_region"),
        F.col("n_nationkey").cast("long").alias("n"),
    )
    storage.write_table(daily, f"{root}/one", "cases")
    storage.write_table(more, f"{root}/one", "cases", overwrite=False)
    storage.copy_table(spark, f"{root}/one", f"{root}/two", "cases")
    return files.read_table(spark, f"{root}/two")


@workload("delimited_roundtrip", """
    SELECT c_custkey, c_mktsegment AS segment, ROUND(c_acctbal, 2) AS balance,
           c_custkey * 1000 AS big FROM customer
""")
def delimited_roundtrip(spark, sf):
    path = f"{storage.shared_folder(spark)}/customers"
    comma = F.translate(F.format_string("%.2f", F.round("c_acctbal", 2)), ".", ",")
    table(spark, sf, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("segment"),
        comma.alias("balance"),
        F.translate(F.format_number(F.col("c_custkey") * 1000, 0), ",", ".").alias("big"),
    ).write.option("sep", ";").option("header", True).option("encoding", "ISO-8859-1").csv(path)
    df = files.read_delimited(
        spark, path, separator=";", decimal=",", thousands=".", encoding="ISO-8859-1",
        numbers={"c_custkey": "long", "balance": "double", "big": "long"},
        columns="c_custkey string, segment string, balance string, big string",
    )
    return df


@workload("rows_to_json", """
    SELECT CAST(to_json({'o_orderkey': o_orderkey, 'o_orderstatus': o_orderstatus,
                         'late': CASE WHEN o_orderpriority = '5-LOW' THEN o_custkey END}) AS VARCHAR)
             AS json
    FROM orders
""")
def rows_to_json(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus",
        F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_custkey")).alias("late"),
    )
    return storage.json_rows(df)


def _as_cases(spark, sf):
    return table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("date"), F.col("o_orderstatus").alias("gender"),
        F.col("o_orderpriority").alias("age_range"),
        (F.col("o_custkey") % 19).cast("string").alias("autonomous_region"),
        F.col("o_orderkey").alias("new_cases"), "o_totalprice",
    )


CASES_SQL = """
    SELECT CAST(o_orderdate AS DATE) AS date, o_orderstatus AS gender,
           o_orderpriority AS age_range, CAST(o_custkey % 19 AS VARCHAR) AS autonomous_region,
           o_orderkey AS new_cases, o_totalprice FROM orders
"""
PAGE_ORDER = "date DESC, autonomous_region, age_range, gender, new_cases, o_totalprice"


@workload("paged_query", f"""
    SELECT date, new_cases FROM ({CASES_SQL}) WHERE gender = 'F'
    ORDER BY {PAGE_ORDER} LIMIT 50 OFFSET 100
""")
def paged_query(spark, sf):
    return serving.answer(
        _as_cases(spark, sf), "cases", {"gender": "F", "age_range": "", "unlisted": "x"},
        ["date", "new_cases", "absent"], limit="50", page="2",
    )


@workload("deep_page_query", f"""
    SELECT * FROM ({CASES_SQL}) ORDER BY {PAGE_ORDER} LIMIT 500 OFFSET 1000
""")
def deep_page_query(spark, sf):
    return serving.paged(
        _as_cases(spark, sf), ["-date", "autonomous_region", "age_range", "gender"],
        limit=500, page=2,
    )


@workload("counted_page_query", f"""
    SELECT * FROM ({CASES_SQL}) WHERE gender = 'F' ORDER BY {PAGE_ORDER} LIMIT 70 OFFSET 350
""")
def counted_page_query(spark, sf):
    cases = _as_cases(spark, sf)
    counts = paging.page_counts(cases, serving.TABLES["cases"])
    return serving.answer(cases, "cases", {"gender": "F"}, limit=70, page=5, counts=counts)


@workload("value_page_query", """
    SELECT * FROM (SELECT l_extendedprice, l_orderkey, l_linenumber FROM lineitem)
    ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 40 OFFSET 2000
""")
def value_page_query(spark, sf):
    # a leading column of nearly as many keys as rows
    lines = table(spark, sf, "lineitem").select("l_extendedprice", "l_orderkey", "l_linenumber")
    return serving.paged(lines, ["-l_extendedprice", "l_orderkey"], limit=40, page=50)


@workload("dated_query", f"SELECT * FROM ({CASES_SQL}) WHERE date = DATE '1998-10-03'")
def dated_query(spark, sf):
    return serving.answer(_as_cases(spark, sf), "cases", {"date": "1998-10-03"})


@workload("projected_query", """
    SELECT n_name AS scope, r_regionkey AS number, r_name AS label
    FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def projected_query(spark, sf):
    nested = combine.lookup_join(
        table(spark, sf, "nation").withColumnRenamed("n_regionkey", "r_regionkey"),
        table(spark, sf, "region"), "r_regionkey",
    ).select(
        F.col("n_name").alias("scope"), F.lit("x").alias("subscope"),
        F.struct(
            F.col("r_regionkey").alias("number"), F.col("n_nationkey").alias("cases"),
            F.struct(F.col("r_name").alias("label"), F.lit(1).alias("one")).alias("deep"),
        ).alias("outbreaks"),
    )
    found = serving.answer(
        nested, "outbreaks_description",
        fields=["outbreaks.number", "outbreaks.deep.label", "scope"],
    )
    return recode.flatten(found, {"number": "outbreaks.number", "label": "outbreaks.deep.label"})


@workload("stream_new_inputs", """
    SELECT doc_id, lang, CAST(length(text) AS INTEGER) AS size FROM documents
""")
def stream_new_inputs(spark, sf):
    root = storage.shared_folder(spark)
    for _ in range(2):  # the second run finds nothing new
        process_new_files(
            spark, f"{sf}/documents*.parquet",
            "doc_id long, text string, lang string",
            lambda df: df.select("doc_id", "lang", F.length("text").alias("size")),
            f"{root}/table", f"{root}/checkpoint",
        )
    return spark.read.parquet(f"{root}/table")
