"""Mixing sources to target weights: hierarchical budgets, then seeded token prefixes.

Documents hang on a tree of domain, language and source. A token budget flows from the root
down: children share their parent's budget by weight, a child that holds less than its share
is used up, and what it lacks goes to its siblings by weight. A node holds what its leaves
hold, each up to ``max_epochs`` times, so a shortage leaves a node only when all leaves below
it are used up: siblings come before ancestors. Shares are whole tokens, rounded down.

A leaf takes full epochs first. The rest is a prefix of one more epoch: documents in the order
of a digest of seed, epoch and id, as long as their tokens fit. The prefix ends at one digest
per leaf. It is found by sums over 4,096 digest ranges, then 4,096 ranges inside the one where
the budget ends, then row by row inside that one, so no leaf is ever sorted as a whole.

Tokens are words between ASCII white space. Defined cases: NULL text has no tokens; NULL language or
source is the name ''; repeated rows share a digest and are taken or left together; names
without a weight have weight 1 and a weight of 0 takes nothing; an empty table gives no rows.
Other columns are not read; ``select`` passes them through.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episeries.llm.common import small, words_of
from episeries.sources.storage import cut_lineage

LEVELS = ["domain", "lang", "source"]


@dataclass(frozen=True)
class Mix:
    """Weights by name and level, the budget as a share of all tokens, seed and repeats."""

    weights: dict[str, dict[str, int]] = field(default_factory=lambda: {
        "domain": {"crawl": 4, "forum": 3, "books": 2, "reference": 3},
        "lang": {"en": 6, "de": 2, "fr": 2, "es": 2},
        "source": {},
    })
    share: tuple[int, int] = (4, 5)
    max_epochs: int = 4
    seed: int = 17


def domain_of(source: Column) -> Column:
    """The domain a source belongs to: src0 is the crawl, others go by their number."""
    number = F.coalesce(F.regexp_extract(source, r"^src([0-9]{1,9})$", 1), F.lit(""))
    kind = F.when(number == "", F.lit("other")).otherwise(
        F.element_at(F.array(*map(F.lit, ["books", "forum", "reference"])),
                     F.coalesce(number.try_cast("int"), F.lit(0)) % 3 + 1))
    return F.when(number == "0", F.lit("crawl")).otherwise(kind)


def tree_place(df: DataFrame) -> DataFrame:
    """Add the leaf's names as ``__domain``, ``__lang`` and ``__source``."""
    return df.withColumns({
        "__domain": domain_of(F.coalesce("source", F.lit(""))),
        "__lang": F.coalesce("lang", F.lit("")), "__source": F.coalesce("source", F.lit("")),
    })


def weight(level: str, mix: Mix) -> Column:
    known = mix.weights.get(level, {})
    pairs = [F.when(F.col(level) == name, F.lit(w)) for name, w in known.items()]
    return F.coalesce(*pairs, F.lit(1)).cast("decimal(18,0)")


def fill(nodes: DataFrame, parents: list[str], level: str, mix: Mix) -> DataFrame:
    """Share ``budget`` of each parent among its children by weight, up to their ``held``.

    Children are taken in the order of held tokens per weight: one whose holding is below its
    share of what is left is used up; from the first that is not, all get their share.
    """
    # a parent has as many rows here as it has children; the root's are the domains
    among = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    rank = among.orderBy("ratio", level)
    before = rank.rowsBetween(Window.unboundedPreceding, -1)
    shared = (
        nodes.withColumn("weight", weight(level, mix))
        .withColumn("held", F.when(F.col("weight") > 0, F.col("held")).otherwise(0)
                    .cast("decimal(18,0)"))
        .withColumn("ratio", F.when(F.col("weight") > 0, F.col("held").cast("double")
                                    / F.col("weight").cast("double")).otherwise(0.0))
        .withColumn("rank", F.row_number().over(rank))
        .withColumn("left", F.col("budget").cast("decimal(18,0)")
                    - F.coalesce(F.sum("held").over(before), F.lit(0)))
        .withColumn("weights", F.sum("weight").over(among)
                    - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("left", F.col("left").cast("decimal(18,0)"))
        .withColumn("weights", F.col("weights").cast("decimal(18,0)"))
        .withColumn("stop", F.min(F.expr(
            "IF(held * weights > left * weight, struct(rank, left, weights), NULL)")).over(among))
    )
    return shared.withColumn("budget", F.expr(
        "CAST(IF(stop IS NULL OR rank < stop.rank, held, stop.left * weight div stop.weights)"
        " AS bigint)")).drop("weight", "ratio", "rank", "left", "weights", "stop")


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """Add ``budget`` to leaves (domain, lang, source, tokens); sums of names, not of rows."""
    leaves = leaves.withColumn("held", F.col("tokens") * mix.max_epochs)
    budget = leaves.agg(F.expr(
        f"coalesce(sum(tokens), 0) * {mix.share[0]} div {mix.share[1]}").alias("budget"))
    for depth, level in enumerate(LEVELS):
        parents = LEVELS[:depth]
        nodes = leaves.groupBy(*LEVELS[:depth + 1]).agg(F.sum("held").alias("held"))
        # the root's budget is one row; below it the parents' shares are joined by name
        nodes = nodes.join(budget, parents) if parents else nodes.join(F.broadcast(budget))
        budget = fill(nodes, parents, level, mix).drop("held")
    return leaves.drop("held").join(budget, LEVELS)


def digest(mix: Mix, epoch: Column) -> Column:
    return F.md5(F.concat_ws(
        ":", F.lit(str(mix.seed)), epoch.cast("string"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))


def leaf_cutoffs(rows: DataFrame, mix: Mix) -> DataFrame:
    """Per leaf its full epochs and the last digest of the partial one; materialised.

    ``rows`` has domain, lang, source, doc_id and tokens of every document.
    """
    leaves = rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    budgets = leaf_budgets(cut_lineage(leaves), mix).withColumns({
        "epochs": F.expr("IF(tokens > 0, budget div tokens, 0)"),
        "rest": F.expr("IF(tokens > 0, budget % tokens, 0)"),
    }).select(*LEVELS, "epochs", "rest", "budget")
    at = small(cut_lineage(budgets.withColumns({"prefix": F.lit(""), "passed": F.lit(0)})))
    keyed = rows.join(
        at.select(*LEVELS, "epochs"), LEVELS).withColumn("digest", digest(mix, F.col("epochs")))
    keyed = keyed.drop("epochs")
    for _ in range(2):  # narrow down to the range of digests in which the budget ends
        inside = keyed.join(at, LEVELS).filter("rest > 0 AND startswith(digest, prefix)")
        ranges = inside.groupBy(*LEVELS, F.expr("substr(digest, 1, length(prefix) + 3)").alias("to"),
                                "passed").agg(F.sum("tokens").alias("n"))
        up_to = Window.partitionBy(*LEVELS).orderBy("to")
        # at most 4,096 ranges of a leaf
        ends = ranges.withColumn("sum", F.col("passed") + F.sum("n").over(up_to)).join(
            at.select(*LEVELS, "rest"), LEVELS).filter("sum > rest").groupBy(*LEVELS).agg(
            F.min("to").alias("to"), F.min("sum").alias("sum"), F.min_by("n", "to").alias("n"))
        at = small(cut_lineage(at.join(ends, LEVELS, "left").select(
            *LEVELS, "epochs", "rest", "budget", F.coalesce("to", "prefix").alias("prefix"),
            F.coalesce(F.expr("sum - n"), "passed").alias("passed"))))
    running = Window.partitionBy(*LEVELS).orderBy("digest").rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    last = keyed.join(at, LEVELS).filter("prefix <> '' AND startswith(digest, prefix)").withColumn(
        "sum", F.col("passed") + F.sum("tokens").over(running)
    ).filter("sum <= rest").groupBy(*LEVELS).agg(F.max("digest").alias("last"))
    # no prefix: the budget ends in no range, as only without a rest
    cutoff = F.expr("CASE WHEN rest = 0 THEN '' ELSE coalesce(last, prefix) END")
    return cut_lineage(at.join(last, LEVELS, "left").select(
        *LEVELS, "epochs", "budget", cutoff.alias("cutoff")))


def with_copies(df: DataFrame, cutoffs: DataFrame, mix: Mix) -> DataFrame:
    """Add ``copies``: how often each row is taken. Each row decides by itself."""
    ends = small(cutoffs).select(
        *[F.col(c).alias(f"__{c}") for c in LEVELS], F.col("epochs").alias("__epochs"),
        F.col("cutoff").alias("__cutoff"))
    taken = F.col("__epochs") + (digest(mix, F.col("__epochs")) <= F.col("__cutoff")).cast("int")
    return df.join(ends, [f"__{c}" for c in LEVELS]).withColumn("copies", taken.cast("long"))


def measured(docs: DataFrame) -> DataFrame:
    return cut_lineage(tree_place(docs.select("doc_id", "lang", "source", "text")).select(
        "doc_id", *[F.col(f"__{c}").alias(c) for c in LEVELS],
        F.size(words_of(F.col("text"))).cast("long").alias("tokens")))


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:  # noqa: B008
    """One row per document: its leaf, tokens and how many copies the mix takes."""
    rows = measured(docs)
    named = rows.withColumns({f"__{c}": F.col(c) for c in LEVELS})
    return with_copies(named, leaf_cutoffs(rows, mix), mix).select(
        "doc_id", *LEVELS, "tokens", "copies")


def select(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:  # noqa: B008
    """The documents that the mix takes, with all their columns and ``copies``, which takes the
    place of a column of that name."""
    docs = docs.drop("copies")
    found = with_copies(tree_place(docs), leaf_cutoffs(measured(docs), mix), mix)
    return found.filter("copies > 0").select(*[F.col(f"`{c}`") for c in docs.columns], "copies")


def fill_sql(name: str, parents: list[str], level: str, mix: Mix) -> str:
    """SQL of one level, for comparison: ``name`` gets the shares of its children."""
    known = " ".join(f"WHEN '{k}' THEN {w}" for k, w in mix.weights.get(level, {}).items())
    w = f"CASE {level} {known} ELSE 1 END" if known else "1"
    among = f"PARTITION BY {', '.join(parents)}" if parents else ""
    path = ", ".join([*parents, level])
    before = f"{among} ORDER BY ratio, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    above = f"JOIN fill_{parents[-1]} USING ({', '.join(parents)})" if parents else ", root"
    return f"""
    {name} AS (
        WITH n AS (SELECT *, held::DOUBLE / weight AS ratio FROM (
                SELECT {path}, CAST(sum(tokens * {mix.max_epochs}) AS HUGEINT) AS held,
                       CAST({w} AS HUGEINT) AS weight FROM leaf GROUP BY ALL)),
        o AS (SELECT n.*, budget - coalesce(sum(held) OVER ({before}), 0)::HUGEINT AS rem,
                   (sum(weight) OVER ({among}) - coalesce(sum(weight) OVER ({before}), 0))::HUGEINT
                       AS weights, row_number() OVER ({among} ORDER BY ratio, {level}) AS rank
              FROM n {above}),
        s AS (SELECT *, min(CASE WHEN held * weights > rem * weight THEN rank END)
                  OVER ({among}) AS stop FROM o)
        SELECT {path}, CASE WHEN stop IS NULL OR rank < stop THEN held
            ELSE max(CASE WHEN rank = stop THEN rem END) OVER ({among}) * weight
                // max(CASE WHEN rank = stop THEN weights END) OVER ({among}) END AS budget
        FROM s)"""


def mixed_sql(mix: Mix, words: str) -> str:
    """SQL of ``mixed`` over ``documents``; ``words`` is the pattern of a token."""
    levels = reduce(lambda out, i: out + [fill_sql(
        f"fill_{LEVELS[i]}", LEVELS[:i], LEVELS[i], mix)], range(len(LEVELS)), [])
    names = ", ".join(LEVELS)
    return f"""
    WITH doc AS (
        SELECT doc_id, CASE WHEN number = '0' THEN 'crawl' WHEN number = '' THEN 'other'
            ELSE ['books', 'forum', 'reference'][CAST(number AS INTEGER) % 3 + 1] END AS domain,
            lang, source, tokens
        FROM (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract(coalesce(source, ''), '^src([0-9]+)$', 1) AS number,
                  len(regexp_extract_all(coalesce(text, ''), '{words}')) AS tokens
              FROM documents)),
    leaf AS (SELECT {names}, sum(tokens)::BIGINT AS tokens FROM doc GROUP BY ALL),
    root AS (SELECT CAST(sum(tokens) AS HUGEINT) * {mix.share[0]} // {mix.share[1]} AS budget
             FROM leaf),
    {','.join(levels)},
    part AS (SELECT {names}, budget // tokens AS epochs, budget % tokens AS rest
             FROM leaf JOIN fill_source USING ({names}) WHERE tokens > 0),
    run AS (SELECT doc.*, epochs, rest, sum(doc.tokens) OVER (PARTITION BY {names} ORDER BY
                md5(concat_ws(':', '{mix.seed}', epochs, coalesce(doc_id::VARCHAR, '')))) AS total
            FROM doc LEFT JOIN part USING ({names}))
    SELECT doc_id, {names}, tokens, CAST(coalesce(epochs, 0) + CASE WHEN rest > 0 AND total <= rest
        THEN 1 ELSE 0 END AS BIGINT) AS copies FROM run"""
