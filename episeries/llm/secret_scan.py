"""Secret scan: candidates from the text, a random forest removes false positives.

A word is cut at quotes, brackets and the marks of assignments and lists. Every piece of a word
may hold candidates: what is assigned to a name that speaks of a secret (``password=``,
``"token": ``, also over the space between words) is one from four characters on, whatever it is made of; else each run of
at least twelve letters, digits and ``+ / _ - . ~`` that holds a digit or begins like a known
format. The body of a private-key block is one candidate, and its lines are none.

The forest reads a candidate's length, how often its characters change their kind, how much of it is made
of dictionary words, the path it was found under and the words beside it. It is trained from
labelled findings: ``FINDINGS`` texts that Spark derives from row numbers, secrets of common formats
and look-alikes (commit and file digests, numbers, identifiers, placeholders, values that are
names). Some shapes are secrets or not by their path or by the word that follows alone.

The dictionary is the corpus's own: the ``DICTIONARY`` letter runs that the most documents hold, counted over
all texts. All of it is DataFrame functions and Spark's own forest.

Defined cases: NULL and empty texts have no candidate; a NULL source is a path without hints. A
candidate that stands twice in a text is two findings, those of one word have one ``pos``. A key block
without an end runs to the end of the text. Repeated rows give repeated findings. Empty tables
give no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from episeries.llm.common import SPACE_GAP, words_of
from episeries.sources.storage import cut_lineage

FINDINGS = 4_200
DICTIONARY = 5_000
TREES = 24
THRESHOLD = 0.5

#: Characters of a candidate, assigned or not.
SHORTEST, SHORTEST_RUN = 4, 12
#: Pieces of the same word that count as beside a candidate.
BESIDE = 6

# Formats of keys, and words that speak for or against a secret.
MARKS = r"=:;,&?|\"'`(){}<>\[\]"
PIECE_ENDS = rf"(?<=[{MARKS}])(?=[^{MARKS}])|(?<=[^{MARKS}])(?=[{MARKS}])"
RUN = rf"[A-Za-z0-9+/_.~-]{{{SHORTEST_RUN},}}"
PADDING = r"^={1,2}"
FORMATS = r"^(?:AKIA[A-Z2-7]|gh[pousr]_|sk_live_|xox[abp]-|AIza|glpat-|eyJ)"
FOR = r"(?i)passw|pwd|token|secret|api.?key|auth|bearer|credential|private|access.?key"
ASSIGNED = rf"(?:{FOR})[A-Za-z0-9_.-]*[\"'`\])]*\s*(?::?=|:|=>)\s*[\"'`]*$"
AGAINST = (r"(?i)commit|sha|md5|checksum|hash|uuid|guid|digest|revision|etag|version|isbn|"
           r"order|phone|invoice|card|build|file|image|\bid\b")
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|your|x{4}|1234567|(.)\1{4}"
TEST_PATH, LIVE_PATH = r"(?i)test|example|sample|doc|fixture|mock", r"(?i)config|env|setting|prod|secret"


def key_blocks(words: Column) -> Column:
    """(start, end) of each private-key block: its first line's last word, its end line's first.

    Found from the ends on, so that each block is cut once.
    """
    def said(w: Column, i: Column, previous: str) -> Column:
        return F.coalesce(F.get(words, i - 1) == previous, F.lit(False)) & (w == "KEY-----")

    starts = F.filter(F.transform(words, lambda w, i: F.when(said(w, i, "PRIVATE"), i)),
                      lambda i: i.isNotNull())
    ends = F.filter(F.transform(words, lambda w, i: F.when(w == "-----END", i)),
                    lambda i: i.isNotNull())
    blocks = F.transform(starts, lambda start: F.struct(
        start.alias("start"), F.coalesce(F.get(F.filter(ends, lambda end: end > start), F.lit(0)),
                                         F.size(words)).alias("end")))
    # the end line says KEY----- as well
    return F.filter(blocks, lambda b: F.coalesce(
        ~F.array_join(F.slice(words, F.greatest(b["start"] - 3, F.lit(1)), 4), " ")
        .contains("-----END"), F.lit(True)))


def candidate_words(docs: DataFrame) -> DataFrame:
    """doc_id, path, pos (word number), raw word or key block, and its neighbours."""
    words = docs.select("doc_id", F.col("source").alias("path"),
                        words_of(F.col("text"), SPACE_GAP).alias("words"))
    blocked = words.withColumn("blocks", F.when(
        F.array_contains("words", "KEY-----"), key_blocks(F.col("words"))))
    w = F.col("words")

    def before(i: Column) -> Column:
        return F.concat_ws(" ", *[F.get(w, i - k) for k in (3, 2, 1)])

    def marked(word: Column) -> Column:
        return F.coalesce(word.contains("=") | word.contains(":"), F.lit(False))

    def worth(word: Column, i: Column) -> Column:
        long = (F.length(word) >= SHORTEST_RUN) & word.rlike(f"[0-9]|{FORMATS[1:]}")
        inside = marked(word) & word.rlike(FOR)
        follows = (marked(word) | marked(F.get(w, i - 1))) & before(i).rlike(FOR)
        return long | inside | follows

    def free(i: Column) -> Column:
        return F.coalesce(~F.exists("blocks", lambda b: (i > b["start"]) & (i < b["end"])), F.lit(True))

    at = blocked.withColumn("at", F.filter(F.transform(
        "words", lambda word, i: F.when(worth(word, i), i)), lambda i: i.isNotNull() & free(i)))
    single = F.transform("at", lambda i: F.struct(
        i.alias("pos"), F.get(w, i).alias("raw"), F.get(w, i + 1).alias("after"),
        before(i).alias("before"), F.lit(False).alias("block")))
    blocks = F.transform(F.coalesce("blocks", F.array()), lambda b: F.struct(
        b["start"].alias("pos"),
        F.array_join(F.slice(w, b["start"] + 2, b["end"] - b["start"] - 1), "\n").alias("raw"),
        F.get(w, b["end"]).alias("after"), before(b["start"] + 1).alias("before"),
        F.lit(True).alias("block")))
    return at.select("doc_id", "path", F.inline(F.concat(single, blocks)))


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, path, pos, value, lead (what stands before it) and after; made inside each row."""
    parts = candidate_words(docs).withColumn("parts", F.when(
        F.col("block"), F.array("raw")).otherwise(F.split("raw", PIECE_ENDS)))
    p = F.col("parts")

    def lead(j: Column) -> Column:
        near = F.array_join(F.slice(p, F.greatest(j - BESIDE + 1, F.lit(1)), F.least(j, F.lit(BESIDE))), "")
        return F.when(j <= BESIDE, F.concat_ws(" ", "before", near)).otherwise(near)

    def value_piece(j: Column) -> Column:
        return (F.length(F.get(p, j)) >= SHORTEST) & ~F.get(p, j).rlike(f"^[{MARKS}]")

    pieces = parts.select("doc_id", "path", "pos", "after", "block", F.inline(F.transform(
        F.filter(F.transform("parts", lambda _, j: j), value_piece),
        lambda j: F.struct(
            F.get(p, j).alias("piece"), lead(j).alias("lead"),
            # padding is part of a value unless a value follows it
            F.when((j + 2 >= F.size("parts")) | F.get(p, j + 1).rlike(r"^={1,2}[;,&)}\]]"),
                   F.regexp_extract(F.get(p, j + 1), PADDING, 0)).alias("padding")))))
    whole = F.col("block") | F.col("lead").rlike(ASSIGNED)
    values = pieces.withColumn("assigned", whole).select(
        "*", F.explode(F.when(F.col("assigned"), F.array("piece")).otherwise(
            F.regexp_extract_all("piece", F.lit(RUN), F.lit(0)))).alias("run"))
    padded = F.when(F.col("piece").endswith(F.col("run")), F.concat(
        "run", F.coalesce("padding", F.lit("")))).otherwise(F.col("run"))
    return values.filter(F.col("assigned") | F.col("run").rlike(f"[0-9]|{FORMATS}")).select(
        "doc_id", "path", "pos", padded.alias("value"), "lead", "after")


def dictionary(docs: DataFrame, size: int = DICTIONARY) -> DataFrame:
    """The letter runs of three letters or more that the most documents hold."""
    runs = docs.select(F.explode(F.array_distinct(
        words_of(F.lower("text"), r"[^\p{L}]+"))).alias("run"))
    return runs.filter("length(run) BETWEEN 3 AND 24").groupBy("run").agg(
        F.count("*").alias("n")).filter("n > 1").orderBy(F.desc("n"), "run").limit(size)


def covered(found: DataFrame, known: DataFrame) -> DataFrame:
    """Add ``covered``: the share of the value's characters in dictionary words."""
    keyed = found.withColumn("row", F.monotonically_increasing_id())
    keyed = cut_lineage(keyed)  # fixes the row numbers
    runs = keyed.select("row", F.explode(words_of(
        F.lower(F.regexp_replace("value", "([a-z])([A-Z])", "$1 $2")), r"[^\p{L}]+")).alias("run"))
    # a dictionary of a stated size
    share = runs.join(F.broadcast(known), "run").groupBy("row").agg(
        F.sum(F.length("run")).alias("letters"))
    return keyed.join(share, "row", "left").withColumn(
        "covered", F.coalesce("letters", F.lit(0)) / F.length("value")).drop("row", "letters")


def features(found: DataFrame) -> DataFrame:
    """Add ``__vector``: what the forest reads."""
    value, size = F.col("value"), F.length("value")

    def share(pattern: str) -> Column:
        return 1 - F.length(F.regexp_replace(value, pattern, "")) / size

    def says(column: Column, pattern: str) -> Column:
        return F.coalesce(column.rlike(pattern), F.lit(False)).cast("double")

    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        value, "[A-Z]", "A"), "[a-z]", "b"), "[0-9]", "1"), "[^Ab1]", ".")
    changes = F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) - 1
    path, lead, after = F.coalesce("path", F.lit("")), F.col("lead"), F.coalesce("after", F.lit(""))
    columns = [
        F.least(size, F.lit(200)), changes / size, F.col("covered"),
        share("[0-9]"), share("[A-Z]"), share("[a-z]"), share("[0-9a-f]"), share("[+/=]"),
        share("[-_.~]"), share(r"[^A-Za-z0-9+/=_.~-]"), F.size(F.array_distinct(F.split(value, ""))) / size,
        says(value, FORMATS), says(lead, "PRIVATE KEY-----$"), says(lead, FOR), says(lead, AGAINST), says(lead, ASSIGNED),
        says(value, PLACEHOLDER), says(after, FOR), says(after, AGAINST),
        says(path, TEST_PATH), says(path, LIVE_PATH),
    ]
    return found.withColumn("__vector", array_to_vector(
        F.array(*[c.cast("double") for c in columns])))


def labelled_findings(spark: SparkSession, n: int = FINDINGS) -> DataFrame:
    """``n`` candidates with ``label``, from texts derived from row numbers."""
    def random(alphabet: str, length: str) -> str:
        return (f"array_join(transform(sequence(1, {length}), i -> substr('{alphabet}', "
                f"CAST(pmod(xxhash64(id, i, '{length}'), {len(alphabet)}) AS int) + 1, 1)), '')")

    upper32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    letters = "abcdefghijklmnopqrstuvwxyz"
    base62 = upper32[:26] + letters + "0123456789"
    hexes, digits = "0123456789abcdef", "0123456789"
    word = f"concat({random(letters, '3 + pmod(id, 5)')}, ' ', {random(letters, '4 + pmod(id, 7)')})"
    some = "element_at(array('{}'), CAST(pmod(xxhash64(id, 9), {}) AS int) + 1)"

    def one_of(*names: str) -> str:
        return some.format("', '".join(names), len(names))

    symbols = base62 + "!@#%^*+"
    neutral = f"concat({one_of('was', 'has', 'the', 'set')}, ' ', {one_of('value', 'here', 'now', 'found')})"
    # raw word, words before it, label; 2: a secret by its path alone, 3: by the
    # word after it, 4: unless its path is a test's
    kinds = [
        (f"concat('AKIA', {random(upper32, '16')})", word, 1),
        (f"concat({random(hexes, '40')})", f"concat({one_of('commit', 'sha1', 'revision', 'etag')}, ' ')", 0),
        (f"concat({one_of('password=', 'passwd=', 'pwd=')}, {random(hexes, '12 + pmod(id, 16)')})", word, 1),
        (f"concat('4', {random(digits, '15')})", word, 0),
        (f"concat('\"', {random(hexes, '40')}, '\"')", f"concat({one_of('token', 'secret', 'auth_token')}, ' =')", 1),
        (f"concat({random(hexes, '64')})", f"concat({one_of('checksum', 'sha256:', 'digest:')}, ' ')", 0),
        (f"concat({one_of('api_key=', 'apiKey:', 'ACCESS_KEY=')}, {random(base62, '32')})", word, 1),
        (f"concat({random(hexes, '8')}, '-', {random(hexes, '4')}, '-4', {random(hexes, '3')}, '-', {random(hexes, '12')})",
         f"concat({one_of('uuid', 'id', 'guid:', 'order')}, ' ')", 0),
        (f"concat({one_of('ghp_', 'sk_live_', 'glpat-')}, {random(base62, '36')})", word, 1),
        ("concat('the', initcap('of'), 'And', pmod(id, 100), 'FromThis', 'Config')", word, 0),
        (f"concat('\"', {random(base62 + '+/', '40')}, '\"')", f"concat({one_of('secret:', 'private_key =', 'credential =')}, ' ')", 1),
        (f"concat({one_of('EXAMPLE', 'changeme', 'xxxxxxxx', 'your')}, '1234567', {random(letters, '4')})",
         f"concat({one_of('token', 'password', 'api_key')}, ' =')", 0),
        (f"concat('eyJ', {random(base62, '60')}, '.', {random(base62, '40')})", "'authorization bearer'", 1),
        (f"concat({one_of('build-', 'img_', 'release-', 'file_')}, '2021', {random(digits, '4')}, '_', {random(digits, '6')})", word, 0),
        (f"concat({random(hexes, '40')})", neutral, 2),
        (f"concat({random(hexes, '40')})", neutral, 3),
        (f"concat({random(base62, '24')}, '7')", neutral, 2),
        (f"concat({random(base62, '24')}, '7')", neutral, 3),
        (f"concat({one_of('password=', 'passwd:', 'pwd=')}, {random(letters, '5 + pmod(id, 9)')}, CAST(pmod(id, 100) AS string))", word, 4),
        (f"concat('https://', {random(letters, '5')}, '.org/?', {one_of('token=', 'api_key=', 'secret=')}, {random(base62, '15 + pmod(id, 20)')}, '&v=1')", word, 1),
        (f"concat('{{\"', {one_of('token', 'apiKey', 'client_secret')}, '\":\"', {random(base62, '20 + pmod(id, 20)')}, '\",\"region\":\"eu\"}}')", word, 1),
        (f"concat({one_of('password=', 'passwd:', 'secret=')}, {random(symbols, '8 + pmod(id, 12)')})", word, 1),
        (f"concat({one_of('password=', 'secret:', 'auth_token=')}, {random(letters, '8 + pmod(id, 12)')})", word, 1),
        (one_of('None', 'null', 'true', 'string', 'required', 'undefined', 'optional', 'getpass', 'String', 'False'),
         f"concat({one_of('token', 'password', 'secret', 'api_key')}, {one_of(':', ' =', '=')})", 0),
        (f"concat('https://', {random(letters, '6')}, '.org/', {random(letters, '7')}, '/', {random(digits, '5')})", word, 0),
        (f"concat('-----BEGIN RSA PRIVATE KEY----- MII', {random(base62 + '+/', '61')}, ' ', {random(base62 + '+/', '60 + pmod(id, 5)')}, ' -----END RSA PRIVATE KEY-----')", word, 1),
        (f"concat('-----BEGIN CERTIFICATE----- MII', {random(base62 + '+/', '61')}, ' -----END CERTIFICATE-----')", word, 0),
    ]
    chosen = f"pmod(id, {len(kinds)})"
    cases = [" ".join(f"WHEN {i} THEN {k[at]}" for i, k in enumerate(kinds)) for at in range(3)]
    raw, before, kind = (f"CASE {chosen} {c} END" for c in cases)
    drawn = spark.range(n).select(
        "id", F.expr(raw).alias("raw"), F.expr(before).alias("before"), F.expr(kind).alias("kind"),
        F.expr("pmod(xxhash64(id, 5), 2)").alias("either"), F.expr("pmod(xxhash64(id, 6), 10)").alias("chance"))
    label = F.when(F.col("kind") > 1, F.col("either")).otherwise(F.col("kind"))
    live, test, other = (F.expr(one_of(*names)) for names in (
        ("src/config/app.env", "prod/settings.py", "deploy/secrets.yml", "config/live.json"),
        ("tests/fixtures", "docs/readme", "examples/run.py", "mocks/data.json"),
        ("src0", "src7", "lib/core.py", "web")))
    says_for, says_against, plain = (F.expr(one_of(*names)) for names in (
        ("token", "secret", "password", "credential", "apikey"),
        ("commit", "checksum", "digest", "revision", "uuid"), ("and", "then", "with", "over")))
    # where nothing else tells, path or following word always does; elsewhere they lean to it
    path = F.when((F.col("kind") == 2) & (label == 1), live).when(F.col("kind") == 2, test).when(
        (F.col("kind") == 4) & (label == 0), test).when(F.col("chance") > 2, other).otherwise(F.when(label == 1, live).otherwise(test))
    after = F.when((F.col("kind") == 3) & (label == 1), says_for).when(
        F.col("kind") == 3, says_against).when(F.col("chance") != 5, plain).otherwise(
        F.when(label == 1, says_for).otherwise(says_against))
    texts = drawn.select(F.struct("id", label.alias("label")).alias("doc_id"), path.alias("source"),
                         F.concat_ws(" ", "before", "raw", after).alias("text"))
    return candidates(texts).withColumn("label", F.col("doc_id.label"))


def forest(spark: SparkSession, known: DataFrame, n: int = FINDINGS):
    """The forest, trained from the labelled findings."""
    rows = cut_lineage(features(covered(labelled_findings(spark, n), known)).select(
        "label", "__vector"))
    return RandomForestClassifier(
        labelCol="label", featuresCol="__vector", predictionCol="__class", numTrees=TREES,
        maxDepth=7, seed=11).setProbabilityCol("__chance").setRawPredictionCol("__raw").fit(rows)


def secrets(docs: DataFrame) -> DataFrame:
    """One row per candidate: doc_id, pos, length, value_sha256, score, is_secret."""
    known = cut_lineage(dictionary(docs))
    model = forest(docs.sparkSession, known)
    found = model.transform(features(covered(candidates(docs), known)))
    return found.select(
        "doc_id", F.col("pos").cast("long").alias("pos"),
        F.length("value").cast("long").alias("length"),
        F.sha2("value", 256).alias("value_sha256"),
        vector_to_array("__chance")[1].alias("score"), "value",
    ).withColumn("is_secret", F.col("score") >= THRESHOLD)
