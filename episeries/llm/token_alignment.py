"""Alignment of two tokenizers by external spill counting.

Each text is encoded twice. Where a token of both ends at one byte, the two streams are cut:
the tokens between two cuts are a group, and the two tokens that end there are linked. How often
two ids are linked in the whole corpus says how well they fit.

The counting never holds the corpus' pairs: a task turns its links into (pair, document, times)
records, deals them to buckets by the second id's radix and the document, and spills each
bucket's records as sorted zstd runs. A bucket's runs meet in one task, where a k-way heap merge
counts each pair. Pairs are kept in the order of the second id, whose greatest count falls out
of the sums; a second merge in the same order streams every pair's count back to the documents.
A pair that a third of all documents hold is spread over buckets by document.

Defined cases: NULL and empty texts, and texts that one of the tokenizers does not give back
byte for byte, have no tokens: zeros and an empty digest. Special tokens' strings are plain
text. Repeated rows are documents of their own and count again; a NULL ``doc_id`` is passed
through. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episeries.llm.spill_runs import counted, merged, totals, written_run
from episeries.sources.storage import stored

# Where a byte-level vocabulary's texts are cut before merging, and the sign
# that stands for a space in pieces.
BYTE_LEVEL_SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
                    r"|\s+(?!\S)|\s+")
PIECE_SPACE = "▁"

#: Records a task holds before it spills, text bytes per bucket, second-id radix.
SPILL_RECORDS, BUCKET_BYTES, RADIX = 2_000_000, 16 << 20, 4
#: Bytes of text encoded at a time, and words whose tokens a task remembers.
SLICE_BYTES, KNOWN_WORDS = 1 << 20, 300_000

Encode = Callable[[list[str]], list[list[int]]]
#: No token of either side reaches over such a place.
WORD_START, SPACES = re.compile(r"(?<=\S)(?= )"), re.compile(r"\s ")


def byte_signs() -> dict[str, int]:
    """The sign by which a byte-level vocabulary writes each byte: printable Latin-1 signs
    stand for themselves, the rest are numbered on from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_level(model: str) -> tuple[Encode, list[bytes], bool]:
    """Encoder and token bytes of a byte-level BPE in the JSON form, and whether no token goes
    on over a word's start.

    Where merges are in the order of ids and texts are cut as usual, the same ids come from
    the faster of two libraries; else, and for a text it fails on, from the form's own.
    """
    from tokenizers import Tokenizer

    form, signs = json.loads(model), byte_signs()
    vocab = form["model"]["vocab"]
    special = {t["content"]: t["id"] for t in form.get("added_tokens", [])}
    tokens = [b""] * (max([*vocab.values(), *special.values()]) + 1)
    for text, number in vocab.items():
        if text not in special:
            tokens[number] = bytes(signs[c] for c in text)
    for text, number in special.items():
        tokens[number] = text.encode()
    own = Tokenizer.from_str(model)
    own.encode_special_tokens = True

    def slow(texts: list[str]) -> list[list[int]]:
        return [own.encode(t, add_special_tokens=False).ids for t in texts]

    joined = ["".join(m.split(" ") if isinstance(m, str) else m) for m in form["model"]["merges"]]
    cut = form.get("pre_tokenizer") or {}
    usual = (
        [vocab[j] for j in joined] == list(range(256, 256 + len(joined)))
        and all(len(t) == 1 for t in tokens[:256])
        and form.get("normalizer") is None and cut.get("type") == "ByteLevel"
        and not cut.get("add_prefix_space", True) and cut.get("use_regex", True)
        and not form["model"].get("ignore_merges", False)
    )
    if not usual:
        return slow, tokens, False
    import tiktoken

    fast = tiktoken.Encoding("byte_level", pat_str=BYTE_LEVEL_SPLIT, special_tokens={},
                             mergeable_ranks={t: i for i, t in enumerate(tokens)
                                              if i < 256 + len(joined)})

    def encode(texts: list[str]) -> list[list[int]]:
        try:
            return [fast.encode_ordinary(t) for t in texts]
        except BaseException as error:  # its panics are no Exception
            if isinstance(error, (KeyboardInterrupt, SystemExit)):
                raise
            return slow(texts)

    return encode, tokens, True


def pieces(model: bytes) -> tuple[Encode, list[bytes], bool]:
    """Encoder and token bytes of a piece model with byte fallback, and whether no piece has a
    space behind another sign."""
    from sentencepiece import SentencePieceProcessor

    own = SentencePieceProcessor(model_proto=model)
    tokens = [
        bytes([int(own.id_to_piece(i)[3:5], 16)]) if own.is_byte(i)
        else own.id_to_piece(i).replace(PIECE_SPACE, " ").encode()
        for i in range(own.get_piece_size())
    ]
    return (lambda texts: own.encode(texts, num_threads=1), tokens,
            not any(b" " in t.lstrip(b" ") for t in tokens))


Streams = tuple[np.ndarray, np.ndarray]


class Encoders:
    """Token streams of both sides; None for a text that one of them does not give back."""

    def __init__(self, a_model: str, b_model: bytes) -> None:
        encode_a, tokens_a, cut_a = byte_level(a_model)
        encode_b, tokens_b, cut_b = pieces(b_model)
        self.encode, self.tokens = (encode_a, encode_b), (tokens_a, tokens_b)
        self.streams = self.word_wise if cut_a and cut_b else self.text_wise
        self.known: tuple[dict[str, bytes], ...] = {}, {}

    def packed(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """The ids of `` text`` as bytes, for each text."""
        spaced = [f" {t}" for t in texts]
        streams = self.encode[0](spaced), self.encode[1](texts)
        whole = "".join(spaced).encode()
        if any(b"".join(map(tokens.__getitem__, chain.from_iterable(stream))) != whole
               for tokens, stream in zip(self.tokens, streams, strict=True)):
            if len(texts) == 1:
                return [None]
            half = len(texts) // 2  # down to the texts that are not given back
            return self.packed(texts[:half]) + self.packed(texts[half:])
        return [*zip(*map(cut_up, streams), strict=True)]

    def text_wise(self, texts: list[str]) -> Iterator[Streams | None]:
        for both in self.packed(texts):
            yield both and tuple(np.frombuffer(ids, "<i4") for ids in both)

    def word_wise(self, texts: list[str]) -> Iterator[Streams | None]:
        """Every word is encoded about once in a task.

        Words begin at a space behind a sign that is no white space. Neither side's tokens
        cross such a place, so the words' tokens in a row are the text's.
        """
        a, b = self.known
        cut = [words(t) for t in texts]
        wanted = set(chain.from_iterable(cut))
        if len(a) + len(wanted) > KNOWN_WORDS:
            a.clear()
            b.clear()
        new = [w for w in wanted if w not in a]
        for word, both in zip(new, self.packed(new), strict=True):
            a[word], b[word] = both or (None, None)
        for parts in cut:
            try:
                yield tuple(np.frombuffer(b"".join(map(side.__getitem__, parts)), "<i4")
                            for side in (a, b))
            except TypeError:  # a word that is not given back
                yield None


def cut_up(stream: list[list[int]]) -> Iterator[bytes]:
    """Each list of ids as bytes."""
    ends = np.cumsum(np.fromiter(map(len, stream), np.int64, len(stream))) * 4
    data = np.fromiter(chain.from_iterable(stream), "<i4").tobytes()
    begin = 0
    for end in ends.tolist():
        yield data[begin:end]
        begin = end


def words(text: str) -> list[str]:
    """What lies between the spaces that begin a word; no part is empty."""
    if not text.startswith(" ") and not text.endswith(" ") and not SPACES.search(text):
        return text.split(" ")
    parts = [w[1:] for w in WORD_START.split(f" {text}")]
    if not parts[-1] and len(parts) > 1:
        parts[-2:] = [parts[-2] + " "]
    return parts


@dataclass(frozen=True)
class Aligned:
    """One text: tokens of both sides, and where tokens of both end together."""

    n_a: int
    n_b: int
    groups: str
    a: np.ndarray  # the linked ids, in text order
    b: np.ndarray


class Aligner:
    """Cuts texts into groups by the bytes of both sides' tokens."""

    def __init__(self, a: list[bytes], b: list[bytes]) -> None:
        self.lengths = tuple(np.array([len(t) for t in side], np.int64) for side in (a, b))
        # each id as text with what follows it inside a group and at the group's end
        signs = [f"{i}{s}" for i in range(len(a)) for s in ",|"]
        signs += [f"{i}{s}" for i in range(len(b)) for s in ",;"]
        self.signs = np.array(signs, object)

    def aligned(self, left: np.ndarray, right: np.ndarray) -> Aligned:
        end_a, end_b = np.cumsum(self.lengths[0][left]), np.cumsum(self.lengths[1][right])
        at = np.searchsorted(end_b, end_a)
        both = end_b[at] == end_a  # the last ends are equal, so no place is beyond
        last_a = np.flatnonzero(both)
        last_b = at[both]
        return Aligned(len(left), len(right), self._groups(left, right, last_a, last_b),
                       left[last_a].astype(np.int64), right[last_b].astype(np.int64))

    def _groups(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray,
                last_b: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``: of each group first the one side, then the other."""
        out = np.empty(len(a) + len(b), np.int64)
        sizes_a, sizes_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        end = np.zeros(len(a), np.int64)
        end[last_a] = 1
        before_b = np.repeat(last_b + 1 - sizes_b, sizes_a)
        out[np.arange(len(a)) + before_b] = 2 * a + end
        end = np.zeros(len(b), np.int64)
        end[last_b] = 1
        before_a = np.repeat(last_a + 1, sizes_b)
        out[np.arange(len(b)) + before_a] = 2 * (len(self.lengths[0]) + b) + end
        return "".join(self.signs[out].tolist())[:-1]


def encoded(batches: Iterator[pa.RecordBatch], schema: pa.Schema, a_model: str, b_model: bytes,
            salts: int) -> Iterator[pa.RecordBatch]:
    """A row per document, and between them rows that hold a bucket's spilled run."""
    encoders = Encoders(a_model, b_model)
    aligner = Aligner(*encoders.tokens)
    number = TaskContext.get().partitionId() << 40
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    records = 0

    def spilled() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        codes, docs, times = (np.concatenate(c) for c in zip(*held, strict=True))
        held.clear()
        bucket = (codes >> 32) % RADIX * salts + docs % salts
        order = np.lexsort((docs, codes, bucket))
        codes, docs, times, bucket = codes[order], docs[order], times[order], bucket[order]
        begin = np.flatnonzero(np.diff(bucket, prepend=-1))
        for first, after in zip(begin.tolist(), [*begin[1:].tolist(), len(bucket)], strict=True):
            row = {"bucket": int(bucket[first]),
                   "run": written_run(codes[first:after], docs[first:after], times[first:after])}
            yield pa.RecordBatch.from_pylist([row], schema=schema)

    for batch in batches:
        for ids, texts in slices(batch):
            known = [_decoded(t) for t in texts]
            streams = iter(encoders.streams([t for t in known if t]))
            rows = []
            for text in known:
                both = next(streams) if text else None
                if both is None:
                    rows.append((number, 0, 0, 0, ""))
                else:
                    found = aligner.aligned(*both)
                    pair, times = np.unique(found.b << 32 | found.a, return_counts=True)
                    held.append((pair, np.full(len(pair), number, np.int64), times))
                    records += len(pair)
                    rows.append((number, found.n_a, found.n_b, len(found.a),
                                 hashlib.sha256(found.groups.encode()).hexdigest()))
                number += 1
                if records >= SPILL_RECORDS:
                    yield from spilled()
                    records = 0
            columns = dict(zip(("doc", "n_a", "n_b", "n_links", "groups_sha256"),
                               zip(*rows, strict=True), strict=True))
            yield pa.RecordBatch.from_arrays([
                ids if f.name == "doc_id" else pa.array(columns.get(f.name, [None] * len(rows)),
                                                        f.type)
                for f in schema], schema=schema)
    yield from spilled()


def _decoded(text: bytes | None) -> str | None:
    """None where bytes are no text: no tokenizer gives them back."""
    try:
        return text.decode() if text else None
    except UnicodeDecodeError:
        return None


def slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[bytes | None]]]:
    """(ids, texts) of the batch, a bounded number of bytes at a time."""
    ids, texts = batch.column("doc_id"), batch.column("text")
    begin = size = 0
    for at in range(batch.num_rows):
        size += len(texts[at].as_buffer() or b"") if texts[at].is_valid else 0
        if size >= SLICE_BYTES or at == batch.num_rows - 1:
            yield ids.slice(begin, at + 1 - begin), texts.slice(begin, at + 1 - begin).to_pylist()
            begin, size = at + 1, 0


def pair_counts(bucket: tuple[pa.Scalar, ...], runs: pa.Table) -> pa.Table:
    """(bucket, b, a, n): what a bucket's runs hold of each pair."""
    found = [*counted(runs["run"].to_pylist())]
    codes, sums = (np.concatenate(c) for c in zip(*found, strict=True))
    return pa.table({"bucket": pa.array(np.full(len(codes), bucket[0].as_py()), pa.int32()),
                     "b": codes >> 32, "a": codes & 0xFFFFFFFF, "n": sums})


def contributions(runs: pa.Table, pairs: pa.Table) -> pa.Table:
    """(doc, n_best, count_sum): the corpus-wide counts, streamed back to a bucket's
    documents in the order of the merge."""
    codes = pairs["b"].to_numpy() << 32 | pairs["a"].to_numpy()
    order = np.argsort(codes)
    codes, n, best = codes[order], pairs["n"].to_numpy()[order], pairs["best"].to_numpy()[order]
    parts = []
    for code, doc, times in merged(runs["run"].to_pylist()):
        place = np.searchsorted(codes, code)
        parts.append(totals(doc, times * (n[place] == best[place]), times * n[place]))
    docs, n_best, count_sum = (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else (
        np.zeros((3, 0), np.int64))
    if len(docs):
        docs, n_best, count_sum = totals(docs, n_best, count_sum)
    return pa.table({"doc": docs, "n_best": n_best, "count_sum": count_sum})


def alignment(docs: DataFrame, a_path: str, b_path: str,
              bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document: tokens, groups, links and how well the linked ids fit.

    ``a_path`` is a byte-level BPE as JSON, ``b_path`` a piece model; both are files of a few
    megabytes, read once by the driver and sent to the executors.
    """
    spark = docs.sparkSession
    with open(a_path, encoding="utf-8") as a_file, open(b_path, "rb") as b_file:
        models = spark.sparkContext.broadcast((a_file.read(), b_file.read()))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    salts = max(4, -(-size // (bucket_bytes * RADIX)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        schema = pa.schema([
            ("doc_id", first.schema.field("doc_id").type), ("doc", pa.int64()),
            ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_links", pa.int64()),
            ("groups_sha256", pa.string()), ("bucket", pa.int32()), ("run", pa.binary())])

        def again() -> Iterator[pa.RecordBatch]:
            yield first
            yield from batches

        yield from encoded(again(), schema, *models.value, salts)

    both = stored(texts.mapInArrow(
        encode, f"doc_id {kind}, doc long, n_a long, n_b long, n_links long, "
                "groups_sha256 string, bucket int, run binary"))
    runs = both.filter("bucket IS NOT NULL").select("bucket", "run").groupBy("bucket")
    parts = stored(runs.applyInArrow(pair_counts, "bucket int, b long, a long, n long"))
    pairs = parts.groupBy("b", "a").agg(F.sum("n").alias("n"))
    tops = pairs.groupBy("b").agg(F.max("n").alias("best"))
    known = parts.select("bucket", "b", "a").join(pairs.join(tops, "b"), ["b", "a"])
    given = runs.cogroup(known.groupBy("bucket")).applyInArrow(
        contributions, "doc long, n_best long, count_sum long")
    sums = given.groupBy("doc").agg(F.sum("n_best").alias("n_best"),
                                    F.sum("count_sum").alias("count_sum"))
    return both.filter("bucket IS NULL").drop("bucket", "run").join(sums, "doc", "left").select(
        "doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links",
        F.coalesce("n_best", F.lit(0).cast("long")).alias("n_best"),
        F.coalesce("count_sum", F.lit(0).cast("long")).alias("count_sum"), "groups_sha256")
