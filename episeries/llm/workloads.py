"""One query per operator over its whole table, beside its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from episeries.llm import (
    chosen_path,
    decontamination,
    exact_dedup,
    html_extraction,
    license_scan,
    mixing,
    quality,
    secret_scan,
    simhash,
    spelling_variants,
    substring_dedup,
    token_alignment,
    toxicity,
)
from episeries.llm.common import ALNUM, LOWER, SPACED, UPPER, Workload, table

#: Where the public tokenizers' files lie on the driver.
TOKENIZERS = "/opt/tokenizers"

LLM_WORKLOADS: dict[str, Workload] = {}


def register(name: str, sql: str | None = None):
    def add(run):
        LLM_WORKLOADS[name] = Workload(run, sql)
        return run

    return add


@register("op7_exact_dedup", f"""
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
    FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
    WINDOW same AS (PARTITION BY t)
""")
def exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


DECONTAMINATION_SQL = f"""
    WITH item AS (
        SELECT item_id, w, least(len(w), 10) AS l FROM (
            SELECT item_id, regexp_extract_all(
                translate(text, '{UPPER}', '{LOWER}'), '{ALNUM}') AS w FROM benchmark)
        WHERE len(w) > 0),
    win AS (
        SELECT DISTINCT item_id, l, array_to_string(w[s:s + l - 1], ' ') AS span
        FROM (SELECT item_id, w, l, unnest(range(1, len(w) - l + 2)) AS s FROM item)),
    doc AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ALNUM}') AS w FROM documents),
    lens AS (SELECT DISTINCT l FROM win),
    spans AS (
        SELECT doc_id, s, l, array_to_string(w[s:s + l - 1], ' ') AS span
        FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS s FROM doc, lens)),
    hit AS (SELECT doc_id, s, l, item_id FROM spans JOIN win USING (l, span)),
    pos AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
        SELECT doc_id, unnest(range(s, s + l)) AS p FROM hit) GROUP BY doc_id),
    per AS (SELECT doc_id, count(DISTINCT item_id) AS n, array_to_string(
        list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS ids FROM hit GROUP BY doc_id)
"""


@register("op10_decontamination", DECONTAMINATION_SQL + """
    SELECT doc_id, len(w) AS n_words, coalesce(pos.n, 0) AS n_hit, coalesce(per.n, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(pos.n, 0) > 0 AS contaminated
    FROM doc LEFT JOIN pos USING (doc_id) LEFT JOIN per USING (doc_id)
""")
def decontaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op8_simhash")
def near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents")).drop("text_sha256")


@register("op9_mixing", mixing.mixed_sql(mixing.Mix(), SPACED))
def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


@register("op2_substring_dedup", f"""
    WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{SPACED}') AS w
                 FROM documents),
    win AS (SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS span
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM doc)),
    later AS (SELECT doc_id, s FROM win
              QUALIFY row_number() OVER (PARTITION BY span ORDER BY doc_id, s) > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM later),
    word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM doc),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
             FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
           sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM doc LEFT JOIN kept USING (doc_id)
""")
def substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats_removed(table(spark, sf_dir, "documents"), with_text=False)


@register("op4_toxicity")
def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op3_quality")
def good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op6_html_extraction")
def extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extracted(table(spark, sf_dir, "pages"))


@register("op5_license_scan", license_scan.licenses_sql())
def licensed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licenses(table(spark, sf_dir, "documents"))


@register("op1_secret_scan")
def secret(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(spark, sf_dir, "documents")).drop("value")


# The CRC-32 of a text from its rule: eight shifts a byte, reflected polynomial.
CRC_SQL = """
    byte AS (SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i:
                 CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
             FROM (SELECT unnest(range(256)) AS b)),
    crc AS (SELECT list(c ORDER BY b) AS t FROM byte)
"""


@register("op13_spelling_variants", f"""
    WITH RECURSIVE {CRC_SQL},
    run AS (
        SELECT doc_id, w, count(*) AS n FROM (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(text, '{UPPER}', '{LOWER}'), '[A-Za-zÀ-ÿ]+')) AS w FROM documents)
        WHERE length(w) >= 6 GROUP BY ALL),
    coded AS (
        SELECT w, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)) AS x
        FROM run),
    digested AS (
        SELECT w, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
            range(1, length(x), 2), lambda i: CAST('0x' || x[i:i + 1] AS BIGINT))),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
        FROM coded, crc),
    vocab AS (
        SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
            SELECT n, CASE WHEN h % 199 = 0
                THEN w[1:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word
            FROM digested)
        WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
    cut AS (
        SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest
        FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab)),
    near AS (
        SELECT a.word, b.word AS near, b.n AS near_n FROM cut AS a JOIN cut AS b
            ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
        UNION SELECT a.word, b.word, b.n FROM cut AS a JOIN vocab AS b ON a.rest = b.word
        UNION SELECT b.word, a.word, a.n FROM cut AS a JOIN vocab AS b ON a.rest = b.word),
    best AS (
        SELECT word, count(*) AS n_near,
               min(struct_pack(m := -near_n, w := near)) AS b FROM near GROUP BY word),
    formed AS (
        SELECT word, n, coalesce(n_near, 0) AS n_near,
               CASE WHEN -b.m >= 5 * n THEN b.w END AS form,
               CASE WHEN -b.m >= 5 * n THEN -b.m END AS form_n
        FROM vocab LEFT JOIN best USING (word)),
    path AS (
        SELECT word, word AS at FROM formed
        UNION SELECT path.word, formed.form FROM path JOIN formed ON path.at = formed.word
        WHERE formed.form IS NOT NULL)
    SELECT formed.word, formed.form, path.at AS root, formed.n, formed.n_near, formed.form_n
    FROM formed JOIN path USING (word) JOIN formed AS last ON last.word = path.at
    WHERE last.form IS NULL
""")
def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(table(spark, sf_dir, "documents"))


@register("op11_token_alignment")
def token_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment(
        table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json",
        f"{TOKENIZERS}/piece_bpe_32k.model")


@register("op12_chosen_path", f"""
    WITH RECURSIVE doc AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SPACED}') AS w FROM documents),
    shingle AS (
        SELECT DISTINCT doc_id, array_to_string(w[s:s + 2], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS s
              FROM doc WHERE len(w) > 0)),
    size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
    same AS (
        SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS i
        FROM shingle AS a JOIN shingle AS b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
    link AS (
        SELECT u, v FROM same JOIN size AS a ON a.doc_id = u JOIN size AS b ON b.doc_id = v
        WHERE 100 * i >= 85 * (a.n + b.n - i)),
    reach AS (
        SELECT doc_id AS u, doc_id AS v FROM doc
        UNION SELECT reach.u, link.v FROM reach JOIN link ON reach.v = link.u),
    least AS (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM least LEFT JOIN size USING (doc_id)
""")
def near_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_groups(table(spark, sf_dir, "documents"))
