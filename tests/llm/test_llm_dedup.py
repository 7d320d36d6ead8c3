"""Copies, repeats and leaks against brute force, on a table full of edge cases."""

import hashlib
import os
import random
import re
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from check import database, difference, spark_rows, sql_rows
from episeries.llm import decontamination, exact_dedup, mixing, simhash, substring_dedup
from episeries.llm.workloads import LLM_WORKLOADS

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, "
          "hit_doc string, sha string, row_id int, copies string, kept boolean")
PASSAGE = " ".join(f"shared{i}" for i in range(60))
ITEMS = [(1, " ".join(f"Quiz{i}" for i in range(14))), (2, "two words"), (3, None), (4, ""),
         (None, "nameless item text"), (5, "one two three four five six seven eight nine ten eleven")]


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)] + ["Ünï", "Straße", "a.b"]

    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    texts = [None, "", "", "  \t\n", "one", "Two WORDS", "two words", "x" * 70_000]
    for _ in range(25):
        base = words(rng.randint(3, 120))
        texts += [" ".join(base), " ".join(base).upper(), " \n".join(base)]
        if len(base) > 30:
            base[7] = "changed"
            texts.append(" ".join(base))
    texts += [f"{' '.join(words(9))} {PASSAGE} {' '.join(words(9))}" for _ in range(4)]
    texts += [f"{PASSAGE} {PASSAGE}", "again " * 90, "again " * 45]
    texts += [f"so {ITEMS[0][1].lower()} there", "nameless, ITEM text!", ITEMS[5][1][4:], ITEMS[5][1][:40]]
    texts += [" ".join(words(30_000)) + ". And so on\n"]
    out = [(i, t, rng.choice(["en", "de", None]), rng.choice(["src0", "src1", None, "odd"]),
            len(t or ""), 0.5, "h", "s", 1, "c", True) for i, t in enumerate(texts)]
    return out + [out[9], (None, texts[10], None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
@pytest.mark.parametrize("name", sorted(n for n, w in LLM_WORKLOADS.items() if w.sql))
def test_query_agrees_with_sql(spark, name):
    work = LLM_WORKLOADS[name]
    assert difference(spark_rows(work.run(spark, SF)), sql_rows(database(SF), work.sql)) == ""


def exact_expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[lowered(r[1])].append(-1 if r[0] is None else r[0])
    return sorted((-1 if r[0] is None else r[0], max(groups[lowered(r[1])]),
                   len(groups[lowered(r[1])]), hashlib.sha256(lowered(r[1]).encode()).hexdigest())
                  for r in rows), len(groups)


def exact_found(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, -1 if r.keep_id is None else r.keep_id,
                   r.group_size, r.text_sha256) for r in df.collect())


def test_exact_groups(docs, rows, nothing):
    expected, groups = exact_expected(rows)
    found = exact_dedup.exact_groups(docs)
    assert exact_found(found) == expected
    assert found.filter("kept").count() == groups
    left = exact_dedup.keep(docs)
    assert left.columns == docs.columns and left.count() == groups
    assert exact_dedup.keep(nothing).count() == 0


def test_identifiers_that_clash_are_not_used(docs, rows):
    narrow = (lambda chunk: F.length(chunk).cast("long"), exact_dedup.IDENTIFIERS[1])
    assert exact_found(exact_dedup.exact_groups(docs, narrow)) == exact_expected(rows)[0]
    with pytest.raises(ValueError):
        exact_dedup.exact_groups(docs, narrow[:1])


def test_chunks_join_to_the_text(docs):
    text = exact_dedup.normalised(F.col("text"))
    assert docs.filter(F.array_join(exact_dedup.chunks_of(text), "") != text).count() == 0


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def component_of(points, distance=4):
    """Least id by fingerprint, reached over steps of at most ``distance`` bits."""
    least = dict(points)
    changed = True
    while changed:
        changed = False
        for a in least:
            for b in least:
                if (a ^ b).bit_count() <= distance and least[b] < least[a]:
                    least[a], changed = least[b], True
    return least


def test_fingerprints_and_components(docs, rows, nothing):
    prints = [slow_fingerprint(r[1]) for r in rows]
    points = {}
    for r, p in zip(rows, prints, strict=True):
        if r[0] is not None:
            points[p] = min(points.get(p, r[0]), r[0])
    least = component_of(points)
    expected = sorted((str(r[0]), f"{p:016x}", least[p]) for r, p in zip(rows, prints, strict=True))
    for most in (1_000, 1):  # the second takes the crowded way everywhere
        found = simhash.near_groups(docs, most=most)
        assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in found.collect()) == expected
    left = simhash.keep(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(least.values()))
    assert simhash.near_groups(nothing).count() == 0


@pytest.mark.parametrize("most", [1_000, 2])
def test_links_find_every_close_pair(spark, most):
    rng = random.Random(8)
    values = {rng.getrandbits(64) for _ in range(20)}
    for v in list(values):
        for _ in range(12):
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                v ^= 1 << bit
            values.add(v)
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    classes = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    links = simhash.hashed_links(classes, 4, 7, most)
    root = {r.node: r.root for r in simhash.components(links).collect()}
    least = component_of({v: signed[v] for v in values})
    assert {signed[v]: least[v] for v in values} == {s: root.get(s, s) for s in signed.values()}


def repeats_expected(rows):
    """n_words, n_removed, kept digest of each row; copies of one id are one document."""
    key = lambda r: 2**63 if r[0] is None else r[0]
    first, out = {}, []
    split = {id(r): re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in rows}
    for r in sorted(rows, key=key):
        w = split[id(r)]
        for s in range(len(w) - 19):
            first.setdefault(tuple(w[s:s + 20]), (key(r), s))
    for r in rows:
        w = split[id(r)]
        gone = set()
        for s in range(len(w) - 19):
            if first[tuple(w[s:s + 20])] < (key(r), s):
                gone.update(range(s, s + 20))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((str(r[0]), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out)


def test_repeated_passages(docs, rows, nothing):
    distinct = [r for i, r in enumerate(rows) if r not in rows[:i]]
    found = substring_dedup.repeats_removed(docs.dropDuplicates(["doc_id"]))
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256, r.kept)
                  for r in found.collect()) == repeats_expected(distinct)
    assert substring_dedup.repeats_removed(docs).count() == len(rows)
    assert substring_dedup.repeats_removed(nothing).count() == 0


def test_contamination(docs, items, rows, nothing):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = defaultdict(set)
    for item, text in ITEMS:
        w = re.findall(pattern, lowered(text))
        for s in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[s:s + 10])].add(item)
    expected, clean = [], 0
    for r in rows:
        w, hit, ids = re.findall(pattern, lowered(r[1])), set(), set()
        for window, found in windows.items():
            for s in range(len(w) - len(window) + 1):
                if tuple(w[s:s + len(window)]) == window:
                    hit.update(range(s, s + len(window)))
                    ids |= found
        names = ",".join(sorted(str(i) for i in ids if i is not None))
        expected.append((str(r[0]), len(w), len(hit), len(ids - {None}),
                         hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
        clean += not hit
    found = decontamination.contamination(docs, items)
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
                  for r in found.collect()) == sorted(expected)
    left = decontamination.keep(docs, items)
    assert left.columns == docs.columns and left.count() == clean < len(rows)
    assert decontamination.contamination(nothing, items).count() == 0
    assert decontamination.keep(docs, items.limit(0)).count() == len(rows)


def test_mixing(docs, rows, nothing):
    found = mixing.mixed(docs).collect()
    assert len(found) == len(rows)
    tokens = sum(r.tokens for r in found)
    assert tokens == sum(len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows)
    assert sum(r.tokens * r.copies for r in found) <= tokens * 4 // 5
    assert max(r.copies for r in found) <= 4
    left = mixing.select(docs)
    assert left.columns == [c for c in docs.columns if c != "copies"] + ["copies"]
    assert left.count() == sum(r.copies > 0 for r in found)
    assert mixing.mixed(nothing).count() == mixing.select(nothing).count() == 0


def test_a_shortage_goes_to_siblings_before_ancestors(spark):
    # two domains of equal weight; in the first, one of two languages is short
    mix = mixing.Mix(weights={"domain": {}, "lang": {}}, share=(1, 1), max_epochs=2)
    sizes = {("src0", "en"): 100, ("src0", "de"): 4, ("src1", "en"): 300}
    docs = spark.createDataFrame(
        [(i * 1000 + j, "word", lang, source) for i, ((source, lang), n) in enumerate(sizes.items())
         for j in range(n)], "doc_id long, text string, lang string, source string")
    taken = {(r.source, r.lang): r.n for r in mixing.mixed(docs, mix).groupBy("source", "lang").agg(
        F.sum("copies").alias("n")).collect()}
    # 404 tokens: 202 for each domain; de holds 8 with repeats, en takes the other 194
    assert taken == {("src0", "de"): 8, ("src0", "en"): 194, ("src1", "en"): 202}
