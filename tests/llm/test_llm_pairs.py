"""Spelling variants, token alignment and the chosen-path join against brute force."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from episeries.llm import chosen_path, spelling_variants, spill_runs, token_alignment
from episeries.llm.common import perhaps_in

A_PATH, B_PATH = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
DOCS = "doc_id long, text string, word string, tile int, bucket int"


def docs(spark, rows):
    """Documents with columns that clash with inner names."""
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], DOCS)


def invented(seed, n, letters="abcd"):
    draw = random.Random(seed)
    words = ["".join(draw.choices(letters, k=draw.randint(4, 8))) for _ in range(60)]
    return [" ".join(draw.choices(words, k=draw.randint(1, 120))) for _ in range(n)]


# --- spelling variants -----------------------------------------------------

def edits(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants_by_hand(rows):
    count = Counter()
    for doc_id, text in rows:
        run = ""
        for sign in (text or "") + " ":
            if sign.isascii() and sign.isalpha() or "À" <= sign <= "ÿ":
                run += sign.lower() if sign.isascii() else sign
                continue
            if run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                word = run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run
                if len(word) >= 6:
                    count[word] += 1
            run = ""
    vocab = {w: n for w, n in count.items() if n >= 5}
    near = {w: [v for v in vocab if edits(w, v)] for w in vocab}
    form = {}
    for w, n in vocab.items():
        best = min(near[w], key=lambda v: (-vocab[v], v), default=None)
        form[w] = best if best and vocab[best] >= 5 * n else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n, len(near[w]), form[w] and vocab[form[w]])
            for w, n in vocab.items()}


@pytest.mark.parametrize("block", [2, 512])
def test_variants_agree_with_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(spelling_variants, "BLOCK", block)
    rows = [*enumerate(invented(1, 60, "abÉ"))]
    rows += [(900 + i, "aaaaaa " * 3 ** i * 2 + "aaaaab " * 4 + "aaacab aaaaab" * (i < 1)) for i in range(5)]
    rows += [(None, "MuchoS×÷ À " + "ab" * 4000), (7, None), (8, ""), (9, "aaaaaa" * 30), (9, "aaaaaa" * 30)]
    rows += [(40 + i, "ab" * 4000 + " " + "ab" * 3999 + "a") for i in range(6)]
    got = [tuple(r) for r in spelling_variants.variants(docs(spark, rows)).select(
        "word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(set(got)) and set(got) == variants_by_hand(rows)
    assert any(r[1] for r in got)


def test_variants_of_nothing(spark):
    assert spelling_variants.variants(docs(spark, [])).count() == 0
    assert spelling_variants.variants(docs(spark, [(1, None), (2, "")])).count() == 0


# --- token alignment -------------------------------------------------------

def alignment_by_hand(rows):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a_model, b_model = Tokenizer.from_file(A_PATH), SentencePieceProcessor(model_file=B_PATH)
    a_model.encode_special_tokens = True
    signs = token_alignment.byte_signs()
    names = {v: k for k, v in a_model.get_vocab().items()}
    links, out = [], []
    for doc_id, text in rows:
        a = a_model.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        sides = ([bytes(signs[c] for c in names[i]) for i in a],
                 [bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i)
                  else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b])
        if not text or any(b"".join(s) != f" {text}".encode() for s in sides):
            links.append([])
            out.append((doc_id, 0, 0, 0, ""))
            continue
        groups, mine = [], []
        ends = [dict(zip(np.cumsum([len(t) for t in s]).tolist(), range(len(s)), strict=True))
                for s in sides]
        i = j = 0
        for end in sorted(ends[0].keys() & ends[1].keys()):
            x, y = ends[0][end], ends[1][end]
            mine.append((a[x], b[y]))
            groups.append(",".join(map(str, a[i:x + 1])) + "|" + ",".join(map(str, b[j:y + 1])))
            i, j = x + 1, y + 1
        links.append(mine)
        out.append((doc_id, len(a), len(b), len(mine),
                    hashlib.sha256(";".join(groups).encode()).hexdigest()))
    count = Counter(p for mine in links for p in mine)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(n, best.get(b, 0))
    return sorted(((i, a, b, n, n, sum(count[p] == best[p[1]] for p in mine),
                    sum(count[p] for p in mine), sha)
                   for (i, a, b, n, sha), mine in zip(out, links, strict=True)), key=str)


ODD = ["  two  spaces ", "a ", " ", "\n x", "a\n  b", "x　 y▁z ▁ a", "<|endoftext|> <s> <0x41> </s>",
       "tab\t b\r\n  c   ", "I'm you'll 're can't  's", "日本語 テキスト 🙂 é ﬁ ½", "\x00 a\x00b",
       "a" * 3000 + " " + "b" * 2000, "1234 5678.90 -- ... a_b\x1c e \x85 f", "the the the " * 400]


@pytest.mark.parametrize("records, words", [(50, 40), (2_000_000, 300_000)])
def test_alignment_agrees_with_brute_force(spark, monkeypatch, records, words):
    monkeypatch.setattr(token_alignment, "SPILL_RECORDS", records)
    monkeypatch.setattr(token_alignment, "KNOWN_WORDS", words)
    monkeypatch.setattr(spill_runs, "BLOCK", 16)
    rows = [*enumerate(ODD + invented(2, 20, "aehnt"))]
    rows += [(None, None), (500, ""), (3, "a b"), (3, "a b"), (None, "the the")]
    got = token_alignment.alignment(docs(spark, rows), A_PATH, B_PATH, bucket_bytes=2_000).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted((tuple(r) for r in got.collect()), key=str) == alignment_by_hand(rows)


def test_alignment_of_nothing(spark):
    assert token_alignment.alignment(docs(spark, []), A_PATH, B_PATH).count() == 0
    row = token_alignment.alignment(docs(spark, [(1, None)]), A_PATH, B_PATH).first()
    assert (row["n_a"], row["count_sum"], row["groups_sha256"]) == (0, 0, "")


def test_merged_runs_hold_all_records_in_order():
    draw = np.random.default_rng(3)
    runs, count = [], Counter()
    for size in (0, 1, 5, 40_000, 9_000):
        codes = np.sort(np.where(draw.random(size) < 0.4, 77, draw.integers(0, 1 << 47, size)))
        times = draw.integers(1, 9, size)
        for c, t in zip(codes.tolist(), times.tolist(), strict=True):
            count[c] += t
        runs.append(spill_runs.written_run(codes, draw.integers(0, 1 << 50, size), times))
    parts = [*spill_runs.merged(runs)]
    codes = np.concatenate([p[0] for p in parts])
    assert (np.diff(codes) >= 0).all() and len(codes) == 49_006
    found = [*spill_runs.counted(runs)]
    assert dict(zip(np.concatenate([f[0] for f in found]).tolist(),
                    np.concatenate([f[1] for f in found]).tolist(), strict=True)) == count


# --- chosen path -----------------------------------------------------------

def shingle_set(text):
    words = (text or "").encode().lower().split()
    size = min(3, len(words))
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if words else set()


def groups_by_hand(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = [*range(len(rows))]

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                root[top(i)] = top(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [r[0] for k, r in enumerate(rows) if top(k) == top(i) and r[0] is not None]
        least = min(ids, default=None)
        out.append((doc_id, len(sets[i]), least, doc_id == least))
    return sorted(out, key=str)


def near_copies(seed, n, words, changes):
    draw = random.Random(seed)
    base = [f"w{draw.randint(0, 9999)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = base.copy()
        for _ in range(draw.randint(0, changes)):
            copy[draw.randrange(words)] = f"v{draw.randint(0, 9999)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("leaf", [4, 128])
def test_near_groups_agree_with_brute_force(spark, monkeypatch, leaf):
    monkeypatch.setattr(chosen_path, "LEAF", leaf)
    texts = (near_copies(1, 25, 60, 4) + near_copies(2, 25, 200, 8) + invented(4, 30)
             + ["same text here now"] * 4 + ["SAME Text\there  now"] + ["a b", "A B", "a", "x y z"])
    rows = [*enumerate(texts, 10)]
    rows += [(1, None), (2, ""), (3, " \n"), (None, "x y z"), (10, texts[3]), (None, "only nulls here ok")]
    got = chosen_path.near_groups(docs(spark, rows)).select(
        "doc_id", "n_shingles", "component_id", "kept").collect()
    want = [r if r[0] is not None or r[2] is not None else (*r[:3], True)
            for r in groups_by_hand(rows)]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_crowded_node_compares_all_but_its_main_component(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "LEAF", 16)
    label = {f"m{i}": "main" for i in range(600)} | {f"s{i}": "side" for i in range(30)} | {
        f"o{i}": f"o{i}" for i in range(10)}
    nodes = spark.createDataFrame([(7, c.encode()) for c in label], "node long, cls binary")
    labels = spark.createDataFrame([(c.encode(), x.encode()) for c, x in label.items() if c != x],
                                   "cls binary, label binary")
    rows = chosen_path.tiles(chosen_path.mixed_nodes(nodes, labels)).collect()
    # the 40 others meet every block, the main component only their three
    assert len(rows) == 600 * 3 + 40 * (38 + 3)
    held = {}
    for row in rows:
        held.setdefault(row.tile, []).append(row)
    met = Counter(frozenset((bytes(a.cls), bytes(b.cls))) for members in held.values()
                  for k, a in enumerate(members) for b in members[:k]
                  if a.label != b.label and (not a.two or a.block != b.block))
    names = [*label]
    assert met == Counter(frozenset((a.encode(), b.encode())) for k, a in enumerate(names)
                          for b in names[:k] if label[a] != label[b])


@pytest.mark.parametrize("often", [1, 10_000])
def test_near_groups_do_not_depend_on_when_components_are_found(spark, monkeypatch, often):
    monkeypatch.setattr(chosen_path, "LEAF", 3)
    monkeypatch.setattr(chosen_path, "RELABEL", often)
    rows = [*enumerate(near_copies(3, 60, 50, 5) + near_copies(4, 5, 30, 2))]
    got = chosen_path.near_groups(docs(spark, rows)).select(
        "doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(tuple(r) for r in got) == sorted(groups_by_hand(rows))


def test_near_groups_of_nothing(spark):
    assert chosen_path.near_groups(docs(spark, [])).count() == 0
    assert [tuple(r) for r in chosen_path.near_groups(docs(spark, [(4, None)])).collect()] == [
        (4, 0, 4, True)]


def test_trees_grow_with_the_recall():
    few, many = (chosen_path.trees_for(85, 6, r) for r in (0.9, 0.999))
    assert 1 < few < many
    draw, missed, pairs = random.Random(5), 0, 2_000
    for _ in range(pairs):  # pairs of just the wanted similarity, all trees
        alive = 0
        for _ in range(few):
            level = 1
            for _ in range(6):
                chosen = sum(1 + (draw.random() < 100 / 85 - 1) for _ in range(level))
                level = sum(draw.random() < 0.85 for _ in range(chosen))
            alive += level > 0
        missed += not alive
    assert missed / pairs <= 0.1 + 0.03


def test_only_rows_that_may_be_wanted_are_kept(spark):
    rows = spark.range(40_000).selectExpr(
        "IF(id % 100 = 3, NULL, id) AS doc_id", "xxhash64(id) AS at")
    wanted = rows.filter("at % 10 = 0").localCheckpoint()
    kept = perhaps_in(rows, wanted, ["doc_id", "at"])
    number = wanted.count()
    assert kept.join(wanted, "at", "left_semi").count() == number
    assert kept.count() - number < (40_000 - number) / 12
    assert perhaps_in(rows, wanted.limit(0), ["doc_id", "at"]).count() == 0
