"""Near-duplicates by a chosen-path set similarity join with exact confirmation.

A document is the set of its word shingles. Equal sets are one class. In each of several
independent trees a node chooses one or two of the minwise tokens (on average the inverse of the
wanted similarity), and every member goes to the child of its token at that place; so members of
one node agree on every token chosen on the way. Sets as similar as wanted stay together in a
tree with a known probability, and as many trees grow as the recall asks for. All sets take the
first two levels, on narrow rows; nodes of one member go then, nodes of up to ``LEAF`` members are compared exhaustively, larger ones branch
on. Within a node, members that pairs of often enough agreeing tokens connect form a group; the
same group found in several trees is one. Its full sets meet in one task, where all
intersections are counted and only links that join something leave: a family of documents that
just fail to be alike costs as many rows as it has members, not pairs.

Groups of very many near copies would not shrink by branching. Their members are compared with a
few pivots first, and nodes whose members are all connected by confirmed links are done: a
further link inside says nothing new about components. What is still crowded at the last level
is cut into blocks, and every pair of blocks is compared but for those within the component that
most of the node belongs to.

A token comparison drops a pair of the wanted similarity only if the estimate is four
deviations too low. ``components`` therefore joins exactly the documents that confirmed links
connect, and a link is missed with a probability of at most ``1 - recall``.

Defined cases: NULL and empty texts and texts without words have an empty set and are linked
with nothing. A text with fewer words than a shingle is one shingle. Repeated rows get the same
answer. A NULL ``doc_id`` is ignored for ``component_id`` unless nothing else is in the
component. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from math import ceil, log, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episeries.llm.common import perhaps_in, small
from episeries.llm.simhash import components
from episeries.llm.tiles import starts_of, whole_groups
from episeries.sources.storage import cut_lineage, stored

SHINGLE = 3
#: Wanted similarity in hundredths, and the chance that a tree set finds a link that just has it.
PERCENT, RECALL = 85, 0.999
#: Minwise tokens of a set, levels that all sets take, and levels of crowded nodes below.
TOKENS, FIRST_LEVELS, LEVELS = 128, 2, 4
#: Members of a node that are compared exhaustively; pivots of a larger one; rows of a tile.
LEAF, PIVOTS, TILE = 128, 4, 96
#: Components are found again once there is a new link for so many classes that share nodes.
RELABEL = 8
#: Shingles hashed at a time, and words whose hash a task remembers.
STEP, KNOWN_WORDS = 4_096, 500_000

#: Odd factors of the minwise hashes, from one seed.
FACTORS = np.random.default_rng(12).integers(
    0, 1 << 63, (TOKENS, 1), np.uint64) << np.uint64(1) | np.uint64(1)
_MIX = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)]

ROWS = "cls binary, n long, sig array<int>, at long"


class WordHashes(dict):
    """Hash of each word, computed once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = hashed = xxhash.xxh64_intdigest(word)
        return hashed


def shingle_ids(text: bytes | None, hashes: WordHashes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit ids of a text's shingles."""
    words = (text or b"").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    word = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(shingle, len(word))
    ids = np.full(len(word) - size + 1, size, np.uint64)
    for place in range(size):
        ids = (ids ^ word[place:len(word) - size + 1 + place]) * _MIX[0]
        ids = (ids ^ (ids >> np.uint64(29))) * _MIX[1]
        ids ^= ids >> np.uint64(32)
    return np.unique(ids)


def minwise(ids: np.ndarray) -> np.ndarray:
    """The set's minwise tokens."""
    least = np.full((TOKENS, 1), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(ids), STEP):
        hashed = ids[None, at:at + STEP] * FACTORS
        np.minimum(least, hashed.min(axis=1, keepdims=True), out=least)
    return (least[:, 0] >> np.uint64(32)).astype(np.uint32).view(np.int32)


def set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, cls, n, sig, at) of (doc_id, text, at): the set's digest, size and tokens."""
    hashes = WordHashes()
    for batch in batches:
        sets = [shingle_ids(t.as_py(), hashes) for t in batch.column("text")]
        sizes = [len(s) for s in sets]
        digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
        tokens = [minwise(s) for s in sets if len(s)]
        offsets = np.cumsum([0, *(TOKENS if n else 0 for n in sizes)], dtype=np.int32)
        flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), batch.column("at")],
            ["doc_id", "cls", "n", "sig", "at"])


def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cls, ids) of (text)."""
    hashes = WordHashes()
    for batch in batches:
        for text in batch.column("text"):
            ids = shingle_ids(text.as_py(), hashes)
            if len(ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([xxhash.xxh3_128_digest(ids.tobytes())], pa.binary()),
                     pa.array([ids.view(np.int64)], pa.list_(pa.int64()))], ["cls", "ids"])


def trees_for(percent: int, levels: int, recall: float) -> int:
    """Trees after which a link of just the wanted similarity is missed with ``1 - recall``.

    A pair that shares a node goes on with the wanted similarity at each chosen place; the
    pair dies out by the last level with the probability that this iteration gives.
    """
    alike, second = percent / 100, 100 / percent - 1
    dies = 0.0
    for _ in range(levels):
        one = 1 - alike + alike * dies
        dies = (1 - second) * one + second * one * one
    return ceil(log(1 - recall) / log(dies))


def children(node: Column, percent: int) -> Column:
    """The node's children for its members' tokens ``sig``: one place, or two."""
    place = F.pmod(F.xxhash64(node, F.lit(1)), F.lit(TOKENS))
    further = F.pmod(place + 1 + F.pmod(F.xxhash64(node, F.lit(2)), F.lit(TOKENS - 1)),
                     F.lit(TOKENS))
    two = F.pmod(F.xxhash64(node, F.lit(3)), F.lit(1_000_000)) < round(1e8 / percent - 1e6)

    def child(at: Column) -> Column:
        return F.xxhash64(node, at, F.element_at("sig", (at + 1).cast("int")))

    return F.when(two, F.array(child(place), child(further))).otherwise(F.array(child(place)))


def least_agreeing(percent: int) -> int:
    """Tokens that two sets of the wanted similarity have in common but for four deviations."""
    alike = percent / 100
    return int(TOKENS * (alike - 4 * sqrt(alike * (1 - alike) / TOKENS)))


def mixed_nodes(nodes: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(node, cls, label, members, main) of the nodes that hold more than one component.

    ``main`` is the most frequent label with its ``own`` number of members.
    """
    if labels is None:
        labelled = nodes.withColumn("label", F.col("cls"))
        parts = labelled.withColumn("own", F.lit(1).cast("long"))
    else:
        labelled = nodes.join(small(labels), "cls", "left").select(
            "node", "cls", F.coalesce("label", "cls").alias("label"))
        parts = labelled.groupBy("node", "label").agg(F.count("*").alias("own"))
    sizes = parts.groupBy("node").agg(
        F.sum("own").alias("members"), F.min("label").alias("a"), F.max("label").alias("b"),
        F.max(F.struct("own", "label")).alias("main")
    ).filter("a <> b").select("node", "members", "main")
    return labelled.join(sizes, "node")


def whole_tiles(nodes: DataFrame) -> DataFrame:
    """Every member of small nodes with its node as the tile that compares it."""
    return nodes.select(F.xxhash64("node").alias("tile"), "cls", "label", F.lit(0).alias("block"),
                        F.lit(False).alias("two"))


def tiles(nodes: DataFrame) -> DataFrame:
    """Every member of crowded nodes in each tile that compares it.

    Members of a node's most frequent label and all others are cut into blocks each. Two blocks
    meet unless both are of that label, so only the others meet many blocks.
    """
    is_main = F.col("label") == F.col("main.label")
    first = F.ceil(F.col("main.own") / LEAF).cast("int")
    rest = F.ceil((F.col("members") - F.col("main.own")) / LEAF).cast("int")
    cut = nodes.select(
        "node", "cls", "label", is_main.alias("is_main"), first.alias("first"), rest.alias("rest"))
    place = F.xxhash64("cls")
    cut = cut.withColumn("block", F.when(F.col("is_main"), F.pmod(place, F.col("first"))).otherwise(
        F.col("first") + F.pmod(place, F.col("rest"))).cast("int"))
    met = F.explode(F.sequence(F.when(F.col("is_main"), F.col("first")).otherwise(0),
                               F.col("first") + F.col("rest") - 1)).alias("other")
    low, high = F.least("block", "other"), F.greatest("block", "other")
    return cut.select("node", "cls", "label", "block", met).select(
        F.xxhash64("node", low, high).alias("tile"), "cls", "label", "block",
        (low != high).alias("two"))


def agreeing(sig: np.ndarray, step: int = 64) -> np.ndarray:
    """Number of equal tokens for every two rows."""
    same = np.empty((len(sig), len(sig)), np.int32)
    for at in range(0, len(sig), step):
        same[at:at + step] = (sig[at:at + step, None, :] == sig[None, :, :]).sum(axis=2)
    return same


def joined(label: np.ndarray, pairs: Iterable[tuple[int, int]]) -> tuple[list, Callable]:
    """Pairs that join two labels no earlier ones have joined, and each label's place then."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    taken = []
    for i, j in pairs:
        a, b = top(int(label[i])), top(int(label[j]))
        if a != b:
            root[a] = b
            taken.append((i, j))
    return taken, top


def groups_in_tiles(percent: int) -> Callable:
    """(tile, cls, label): the groups that may hold links, from rows sorted by tile.

    Members of different labels are connected if their sizes and tokens allow a link. A group
    is named by its members.
    """
    least = least_agreeing(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            table = table.combine_chunks()
            tile, n, block, two = (table[c].to_numpy() for c in ("tile", "n", "block", "two"))
            sig = table["sig"].combine_chunks().flatten().to_numpy().reshape(-1, TOKENS)
            cls, names = table["cls"].to_pylist(), table["label"].to_pylist()
            label = np.unique(np.array(names, "V16"), return_inverse=True)[1]
            starts, begin, rows = starts_of(tile), 0, []
            for place in range(1, len(starts)):
                end = int(starts[place])
                if end - begin < TILE and place < len(starts) - 1:
                    continue
                i, j = np.nonzero(np.triu(agreeing(sig[begin:end]) >= least, 1))
                i, j = i + begin, j + begin
                own = (tile[i] == tile[j]) & (label[i] != label[j]) & (
                    ~two[i] | (block[i] != block[j])) & (
                    100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
                i, j = i[own], j[own]
                _, top = joined(np.arange(len(tile)), zip(i.tolist(), j.tolist(), strict=True))
                groups: dict[int, list[int]] = {}
                for member in sorted({*i.tolist(), *j.tolist()}):
                    groups.setdefault(top(member), []).append(member)
                for members in groups.values():
                    name = xxhash.xxh64_intdigest(b"".join(sorted(cls[m] for m in members)))
                    rows += [(name - (1 << 63), cls[m], names[m]) for m in members]
                begin = end
            if rows:
                columns = [pa.array(c, k) for c, k in zip(
                    zip(*rows, strict=True), (pa.int64(), pa.binary(), pa.binary()), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["tile", "cls", "label"])

    return run


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of every two sets."""
    member = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    found, place = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(place, kind="stable")
    member, place = member[order], place[order]
    shared = np.zeros((len(sets), len(sets)), np.int64)
    for at in range(0, len(found), STEP):
        first, after = np.searchsorted(place, [at, at + STEP])
        holds = np.zeros((len(sets), STEP), np.float32)
        holds[member[first:after], place[first:after] - at] = 1
        shared += (holds @ holds.T).astype(np.int64)
    return shared


def links_in_groups(percent: int) -> Callable:
    """(u, v): links of the full sets that connect what a group's links connect."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            starts = starts_of(table["tile"].to_numpy())
            cls = table["cls"].to_pylist()
            label = np.unique(np.array(table["label"].to_pylist(), "V16"), return_inverse=True)[1]
            ids = table["ids"].combine_chunks()
            ends, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
            found = []
            for begin, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                sets = [flat[ends[k]:ends[k + 1]] for k in range(begin, end)]
                size = np.array([len(s) for s in sets])
                shared = intersections(sets)
                linked = 100 * shared >= percent * (size[:, None] + size[None, :] - shared)
                i, j = np.nonzero(np.triu(linked, 1))
                found += joined(label, zip((i + begin).tolist(), (j + begin).tolist(),
                                           strict=True))[0]
            if found:
                pairs = [sorted((cls[i], cls[j])) for i, j in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(side, pa.binary()) for side in zip(*pairs, strict=True)], ["u", "v"])

    return run


def candidate_groups(met: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(tile, cls, label) of the members of the tiles that may link, each group once."""
    rows = met.join(classes.select("cls", "n", "sig"), "cls")
    return rows.repartition("tile").sortWithinPartitions("tile").mapInArrow(
        groups_in_tiles(percent), "tile long, cls binary, label binary").distinct()


def group_links(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    # in the order of names, so that overlapping groups choose the same links
    rows = groups.join(sets, "cls")
    return rows.repartition("tile").sortWithinPartitions("tile", "cls").mapInArrow(
        links_in_groups(percent), "u binary, v binary")


def with_pivots(nodes: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(cls, pivot): each member of the nodes with the pivot that it agrees with most."""
    drawn = Window.partitionBy("node").orderBy(F.xxhash64("node", "cls"), "cls")
    rows = nodes.join(classes.select("cls", "n", "sig"), "cls")
    pivots = rows.withColumn("rank", F.row_number().over(drawn)).filter(
        F.col("rank") <= PIVOTS).select("node", *[F.col(c).alias(f"p_{c}") for c in
                                                  ("cls", "n", "sig", "label")])
    same = F.size(F.filter(F.zip_with("sig", "p_sig", lambda a, b: a == b), lambda x: x))
    fits = (100 * F.least("n", "p_n") >= percent * F.greatest("n", "p_n")) & (
        F.col("label") != F.col("p_label"))
    met = rows.join(small(cut_lineage(pivots)), "node").filter(fits).select(
        "node", "cls", "p_cls", same.alias("same")).filter(F.col("same") >= least_agreeing(percent))
    return met.groupBy("node", "cls").agg(
        F.max(F.struct("same", "p_cls")).alias("best")
    ).select("cls", F.col("best.p_cls").alias("pivot"))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v): the materialised pairs that the full sets link."""
    # few classes are pivots, so no other full set meets the members'
    pivots = sets.join(small(pairs.select(F.col("pivot").alias("cls")).distinct()), "cls",
                       "left_semi")
    both = small(pairs).join(sets.withColumnRenamed("ids", "left"), "cls").join(
        pivots.select(F.col("cls").alias("pivot"), F.col("ids").alias("right")), "pivot")
    shared = F.size(F.array_intersect("left", "right"))
    counted = both.select(F.least("cls", "pivot").alias("u"), F.greatest("cls", "pivot").alias("v"),
                          shared.alias("i"), (F.size("left") + F.size("right")).alias("total"))
    return counted.filter(100 * F.col("i").cast("long")
                          >= percent * (F.col("total") - F.col("i")).cast("long")).select("u", "v")


def connected(classes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int,
              recall: float) -> DataFrame:
    """(cls, label) of the classes that links connect.

    ``sets_of`` gives the full sets of some classes.
    """
    trees = trees_for(percent, FIRST_LEVELS + LEVELS, recall)
    tree = F.explode(F.sequence(F.lit(1), F.lit(trees))).alias("tree")
    nodes = classes.select("cls", "sig", tree).select(
        "cls", "sig", F.xxhash64(F.lit("tree"), F.col("tree")).alias("node"))
    for _ in range(FIRST_LEVELS):
        nodes = nodes.select("cls", "sig",
                             F.explode(children(F.col("node"), percent)).alias("node"))
    nodes = nodes.select("node", "cls")
    sets = labels = links = None
    pending = 0
    for level in range(LEVELS + 1):
        mixed = stored(mixed_nodes(nodes, labels))
        # the tokens of whoever shares a node go on, all others' stay
        classes = stored(classes.join(mixed.select("cls").distinct(), "cls", "left_semi"))
        tokens = small(classes) if level else classes
        few, crowded = (mixed.filter(F.col("members") <= LEAF),
                        mixed.filter(F.col("members") > LEAF))
        beyond = not crowded.isEmpty()
        more = level < LEVELS and beyond
        met = whole_tiles(few).unionAll(tiles(crowded)) if beyond and not more else whole_tiles(few)
        groups = stored(candidate_groups(met, tokens, percent))
        if sets is None:
            # whoever may be linked at this level, or be compared further down
            sets = sets_of(groups.select("cls").unionAll(crowded.select("cls")).distinct())
        found = group_links(small(groups) if level else groups, sets, percent)
        if more:
            pairs = stored(with_pivots(crowded, tokens, percent))
            found = found.unionAll(confirmed(pairs, sets, percent))
        found = stored(found.distinct())
        links = found if links is None else links.unionAll(found)
        pending += found.count()
        # until many links are new the labels stay: finer ones only cost comparisons
        if labels is None or pending * RELABEL > classes.count() or (pending and not more):
            labels, pending = stored(components(links).select(
                F.col("node").alias("cls"), F.col("root").alias("label"))), 0
            if more:
                crowded = mixed_nodes(crowded.select("node", "cls"), labels)
        if not more:
            break
        nodes = crowded.join(tokens.select("cls", "sig"), "cls").select(
            "cls", F.explode(children(F.col("node"), percent)).alias("node"))
    return labels


def near_groups(docs: DataFrame, percent: int = PERCENT, recall: float = RECALL) -> DataFrame:
    """One row per document: its set's size, the least doc_id it is connected with, and whether
    it is that one."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"),
                        F.xxhash64("text").alias("at"))
    rows = stored(texts.mapInArrow(set_rows, f"doc_id {kind}, {ROWS}"))
    classes = stored(rows.filter("cls IS NOT NULL").groupBy("cls").agg(
        F.min("n").alias("n"), F.first("sig").alias("sig"), F.min("doc_id").alias("least"),
        F.min(F.struct("doc_id", "at")).alias("one")))

    def sets_of(some: DataFrame) -> DataFrame:
        # one row of each class is read again
        wanted = cut_lineage(classes.join(some, "cls", "left_semi").select("one.*"))
        near, wanted = perhaps_in(texts, wanted, ["doc_id", "at"]), small(wanted)
        same = near["doc_id"].eqNullSafe(wanted["doc_id"]) & (near["at"] == wanted["at"])
        found = near.join(wanted, same, "left_semi").select("text").mapInArrow(
            full_sets, "cls binary, ids array<long>")
        return stored(found.groupBy("cls").agg(F.first("ids").alias("ids")))

    labels = connected(classes, sets_of, percent, recall)
    labelled = classes.join(labels, "cls", "left").select(
        "cls", "least", F.coalesce("label", "cls").alias("label"))
    ids = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    found = stored(labelled.join(ids, "label").select("cls", "component_id"))
    linked = rows.filter("cls IS NOT NULL").select("doc_id", "n", "cls").join(found, "cls")
    alone = rows.filter("cls IS NULL").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return linked.select("doc_id", "n", "component_id").unionAll(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
