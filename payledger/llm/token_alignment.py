"""Alignment of two tokenizers: which tokens of A and B cover the same bytes.

Both tokenizers encode every document; where an A token and a B token end at the
same byte, a group ends. All A and B tokens of a group are linked. How many
documents hold an id pair linked says which B id stands for an A id.

The work inside a task is done on Arrow arrays, a block of documents at a time:

- token lists are flattened with their parent (document) indices; token lengths are
  summed up and the sum before the document is taken off: byte ends per document;
- an Acero hash join of both sides on (document, end) gives the group ends;
- links are counted with ``Table.group_by``, per document (``pairs``, ``times``) and
  per block (documents that hold a pair), a wide group by its distinct ids;
- Spark sums the counts of all blocks by pair and finds the highest count of each
  A id; the sums go back to the blocks that hold the pair (never to a driver, never
  broadcast), where a second Acero join brings them to the documents.

A block holds ``BLOCK`` bytes of text, or one longer document. A pair that every
document holds has one row a block in the shuffle, not one a document.

Results at the edges: a null or empty text has no tokens, and neither has one whose
joined token bytes are not the space and the text (U+2581 in it, say): all numbers
are 0 and the digest column is ''. Special token strings are plain text. Documents
with the same id, and repeated rows, are documents of their own and count each;
other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from payledger.llm.common import stored

#: Bytes of text in a block; links that are expanded, and groups that are written out, at once.
BLOCK, LINKS, GROUPS = 2 << 20, 1_000_000, 250_000
#: Links of a group beyond which its ids are counted before they are paired.
WIDE = 4096
#: The splitting pattern of A keeps a stack of a white-space run; beyond this length the slower library of A splits.
SPACE_RUN = 100_000

# The splitting pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]
_LINKED = ("block long, whole boolean, doc_id {0}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "pairs array<long>, times array<int>")


def byte_letters() -> dict[str, int]:
    """Letter -> byte of byte-level vocabularies: printable Latin-1 bytes stand for
    themselves, the others for the letters from 256 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Tokenizer A: a byte-level BPE vocabulary in JSON."""

    def __init__(self, data: bytes):
        import tiktoken

        self.data = data.decode()
        model = json.loads(self.data)["model"]
        letters = byte_letters()
        merged = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        vocab, first = model["vocab"], 256
        if any(vocab["".join(m)] != first + i for i, m in enumerate(merged)):
            raise ValueError("ids of the merged tokens must follow the order of the merges")
        ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if i < first + len(merged)}
        self.encoding = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.tokens = [b""] * (max(vocab.values()) + 1)
        for t, i in ranks.items():
            self.tokens[i] = t
        self.long = re.compile(r"\s{%d}" % SPACE_RUN)
        self.library = None

    def encode(self, text: str) -> list[int]:
        if len(text) < SPACE_RUN or not self.long.search(text):
            return self.encoding.encode_ordinary(text)
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.data)
            self.library.encode_special_tokens = True
        return self.library.encode(text, add_special_tokens=False).ids


class Pieces:
    """Tokenizer B: a SentencePiece model, which adds the space itself."""

    def __init__(self, data: bytes):
        import sentencepiece

        self.model = p = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.tokens = [bytes([int(p.id_to_piece(i)[3:5], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace("▁", " ").encode()
                       for i in range(p.get_piece_size())]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text)


class Side:
    """Tokens of one tokenizer over a block: flat ids, their documents and byte ends."""

    def __init__(self, tokenizer, texts: list[str]):
        self.tokenizer = tokenizer
        ids = [np.array(tokenizer.encode(t), dtype=np.int32) for t in texts]
        counts = np.array([len(i) for i in ids], dtype=np.int64)
        flat = np.concatenate([np.empty(0, np.int32), *ids])
        self.lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)])), pa.array(flat))
        self.measure()

    def measure(self) -> None:
        lengths = pa.array(np.array([len(t) for t in self.tokenizer.tokens], dtype=np.int64))
        self.ids = pc.list_flatten(self.lists)
        self.docs = pc.list_parent_indices(self.lists)
        size = pc.take(lengths, self.ids)
        total = pc.cumulative_sum(size)
        # the sum up to a document's first token is the same for all its tokens
        offsets = self.lists.offsets.to_numpy()
        sums = np.concatenate([[0], total.to_numpy()])
        self.sizes = np.diff(sums[offsets])
        self.ends = pc.subtract(total, pc.take(pa.array(sums[offsets]), self.docs))

    def bytes_equal(self, wanted: list[bytes]) -> np.ndarray:
        """Whether the joined token bytes of each document are the given ones."""
        good = self.sizes == np.array([len(w) for w in wanted], dtype=np.int64)
        tokens = pa.array(self.tokenizer.tokens, pa.large_binary())
        offsets = self.lists.offsets.to_numpy()
        for d in np.flatnonzero(good):
            joined = pc.take(tokens, self.ids.slice(offsets[d], offsets[d + 1] - offsets[d]))
            good[d] = not len(joined) or joined.buffers()[2].slice(0, len(wanted[d])).equals(pa.py_buffer(wanted[d]))
        return good

    def keep(self, good: np.ndarray) -> None:
        """Drop the tokens of the other documents."""
        if good.all():
            return
        kept = np.asarray(good)[self.docs.to_numpy()]
        counts = np.where(good, pc.list_value_length(self.lists).to_numpy(), 0)
        self.lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)])), self.ids.filter(pa.array(kept)))
        self.measure()

    def ends_table(self, row: str) -> pa.Table:
        return pa.table({"doc": self.docs, "end": self.ends, row: pa.array(np.arange(len(self.ids)))})


def group_numbers(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Group number of every A and every B token: they go up after a shared end."""
    shared = a.ends_table("row_a").join(b.ends_table("row_b"), ["doc", "end"], join_type="inner", use_threads=False)
    out = []
    for side, row in ((a, "row_a"), (b, "row_b")):
        last = np.zeros(len(side.ids), dtype=np.int64)
        last[shared[row].to_numpy()] = 1
        out.append(np.cumsum(last) - last)
    return out[0], out[1]


def distinct_in_wide(ids: np.ndarray, groups: np.ndarray, wide: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, groups, times), by group; ids of a wide group occur once, with their number."""
    ones = np.ones(len(ids), dtype=np.int64)
    at = wide[groups]
    if not at.any():
        return ids, groups, ones
    t = pa.table({"g": groups[at], "i": ids[at]}).group_by(["g", "i"], use_threads=False).aggregate([([], "count_all")])
    ids = np.concatenate([ids[~at], t["i"].to_numpy()])
    groups = np.concatenate([groups[~at], t["g"].to_numpy()])
    times = np.concatenate([ones[~at], t["count_all"].to_numpy()])
    order = np.argsort(groups, kind="stable")
    return ids[order], groups[order], times[order]


def linked_pairs(a: Side, b: Side, groups: tuple[np.ndarray, np.ndarray], doc_of: np.ndarray, n: int) -> tuple[pa.Table, np.ndarray]:
    """``doc, pair, times`` of all links (pair: A id in the upper, B id in the lower
    32 bits), and the number of links per group."""
    count_a, count_b = (np.bincount(g, minlength=n) for g in groups)
    links = count_a * count_b
    wide = links > WIDE
    ids_a, of_a, times_a = distinct_in_wide(a.ids.to_numpy().astype(np.int64), groups[0], wide)
    ids_b, of_b, times_b = distinct_in_wide(b.ids.to_numpy().astype(np.int64), groups[1], wide)
    count_b = np.bincount(of_b, minlength=n)
    start_b = np.cumsum(count_b) - count_b
    reach = count_b[of_a]
    upto = np.cumsum(reach)
    parts, low = [], 0
    while low < len(ids_a):
        high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + LINKS, side="right")))
        r = reach[low:high]
        left = np.repeat(np.arange(low, high), r)
        right = np.repeat(start_b[of_a[low:high]] - (np.cumsum(r) - r), r) + np.arange(len(left))
        t = pa.table({"doc": doc_of[of_a[left]], "pair": ids_a[left] << 32 | ids_b[right], "times": times_a[left] * times_b[right]})
        parts.append(_summed(t))
        low = high
    if not parts:
        return pa.table({k: pa.array([], pa.int64()) for k in ("doc", "pair", "times")}), links
    return parts[0] if len(parts) == 1 else _summed(pa.concat_tables(parts)), links


def _summed(t: pa.Table) -> pa.Table:
    t = t.group_by(["doc", "pair"], use_threads=False).aggregate([("times", "sum")])
    return t.rename_columns(["doc", "pair", "times"])


def group_digests(a: Side, b: Side, groups: tuple[np.ndarray, np.ndarray], first: np.ndarray) -> list[str]:
    """SHA-256 of ``a1,a2|b1;a3|b2,b3`` per document; '' without tokens. Document d
    has the groups from ``first[d]`` up to ``first[d + 1]``."""
    hashes = [hashlib.sha256() if first[d] < first[d + 1] else None for d in range(len(first) - 1)]
    names = [pa.array([str(i) for i in range(len(s.tokenizer.tokens))]) for s in (a, b)]
    for low in range(0, int(first[-1]), GROUPS):
        high = min(low + GROUPS, int(first[-1]))
        sides = []
        for side, number, name in zip((a, b), groups, names):
            cut = np.searchsorted(number, np.arange(low, high + 1))
            ids = side.ids.slice(cut[0], cut[-1] - cut[0])
            sides.append(pc.binary_join(pa.ListArray.from_arrays(pa.array((cut - cut[0]).astype(np.int32)), pc.take(name, ids)), ","))
        texts = pc.binary_join_element_wise(*sides, "|")
        here = np.flatnonzero((first[:-1] < first[1:]) & (first[:-1] < high) & (first[1:] > low))
        bounds = np.clip(np.append(first[here], first[here[-1] + 1]), low, high) - low
        for d, joined in zip(here, pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), texts), ";")):
            hashes[d].update((";" if first[d] < low else "").encode() + joined.as_py().encode())
    return [h.hexdigest() if h else "" for h in hashes]


def aligned_block(texts: list[str], tokenizer_a, tokenizer_b) -> tuple[dict, pa.Table]:
    """Numbers and digests per document of a block, and ``doc, pair, times`` by document."""
    a = Side(tokenizer_a, [" " + t if t else "" for t in texts])
    b = Side(tokenizer_b, texts)
    wanted = [(" " + t).encode() if t else b"" for t in texts]
    good = a.bytes_equal(wanted) & b.bytes_equal(wanted)
    a.keep(good)
    b.keep(good)
    groups = group_numbers(a, b)
    n = int(groups[0][-1]) + 1 if len(groups[0]) else 0
    doc_of = np.zeros(n, dtype=np.int64)
    doc_of[groups[0]] = a.docs.to_numpy()
    first = np.searchsorted(doc_of, np.arange(len(texts) + 1))
    pairs, links = linked_pairs(a, b, groups, doc_of, n)
    sums = np.concatenate([[0], np.cumsum(links)])
    numbers = {
        "n_a": pc.list_value_length(a.lists).to_numpy(), "n_b": pc.list_value_length(b.lists).to_numpy(), "n_groups": np.diff(first),
        "n_links": np.diff(sums[first]), "groups_sha256": group_digests(a, b, groups, first)}
    order = np.argsort(pairs["doc"].to_numpy(), kind="stable")
    return numbers, pairs.take(pa.array(order))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts of at most ``BLOCK`` bytes, or of one longer document."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        total, low = np.cumsum(size, dtype=np.int64), 0
        while low < len(size):
            high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + BLOCK, side="right")))
            yield batch.column("doc_id").slice(low, high - low), [t or "" for t in batch.column("text").slice(low, high - low).to_pylist()]
            low = high


def linked(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row a document (``whole`` false): its numbers, digest, and distinct linked
    ``pairs`` with their ``times``; and one row a ``block`` (``whole`` true): the
    pairs of its documents, each with the number of documents that hold it."""
    import public_tokenizers

    files = []
    for path, name in ((path_a, "byte_bpe_50k.json"), (path_b, "piece_bpe_32k.model")):
        with open(path or public_tokenizers.path(name), "rb") as f:
            files.append(f.read())
    shared = docs.sparkSession.sparkContext.broadcast(tuple(files))
    ready: list = []
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not ready:
            ready.extend((ByteLevel(shared.value[0]), Pieces(shared.value[1])))
        block = TaskContext.get().partitionId() << 32
        for doc_ids, texts in _blocks(batches):
            numbers, pairs = aligned_block(texts, *ready)
            offsets = np.searchsorted(pairs["doc"].to_numpy(), np.arange(len(texts) + 1)).astype(np.int32)
            held = pairs.group_by("pair", use_threads=False).aggregate([([], "count_all")])
            n = len(texts)
            yield pa.RecordBatch.from_pydict({
                "block": pa.array(np.full(n, block)), "whole": pa.array(np.zeros(n, dtype=bool)), "doc_id": doc_ids,
                **{k: pa.array(numbers[k], pa.int64()) for k in _NUMBERS}, "groups_sha256": pa.array(numbers["groups_sha256"], pa.string()),
                "pairs": _lists(offsets, pairs["pair"], pa.int64()), "times": _lists(offsets, pairs["times"], pa.int32())})
            all_ = np.array([0, len(held)], dtype=np.int32)
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([block], pa.int64()), "whole": pa.array([True]), "doc_id": pa.nulls(1, doc_ids.type),
                **{k: pa.nulls(1, pa.int64()) for k in _NUMBERS}, "groups_sha256": pa.nulls(1, pa.string()),
                "pairs": _lists(all_, held["pair"], pa.int64()), "times": _lists(all_, held["count_all"], pa.int32())})
            block += 1

    return stored(docs.select("doc_id", "text").mapInArrow(run, _LINKED.format(kind)), "alignment-links")


def _lists(offsets: np.ndarray, values: pa.ChunkedArray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets), values.combine_chunks().cast(kind))


def block_pairs(links: DataFrame) -> DataFrame:
    """``block, pair, docs``."""
    return links.where("whole").select("block", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "block", F.col("p.pairs").alias("pair"), F.col("p.times").cast("long").alias("docs"))


def pair_counts(links: DataFrame) -> DataFrame:
    """``a, b, pair, docs, best``: in how many documents the ids are linked, and
    whether no other B id is linked with the A id in more. An A id meets each B id
    once here, so a window holds one vocabulary at most."""
    sums = block_pairs(links).groupBy("pair").agg(F.sum("docs").alias("docs"))
    a = F.shiftright("pair", 32)
    sums = sums.select(a.cast("int").alias("a"), F.col("pair").bitwiseAND(0xFFFFFFFF).cast("int").alias("b"), "pair", "docs")
    return sums.withColumn("best", F.col("docs") == F.max("docs").over(Window.partitionBy("a")))


def scored(links: DataFrame) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    counts = pair_counts(links).select("pair", F.col("docs").alias("count"), "best")
    known = block_pairs(links).select(F.col("block").alias("held_in"), "pair").join(counts, "pair")
    kind = links.schema["doc_id"].dataType.simpleString()

    def finish(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        lists = docs["pairs"].combine_chunks()
        flat = pa.table({"doc": pc.list_parent_indices(lists).cast(pa.int64()), "pair": pc.list_flatten(lists),
                         "times": pc.list_flatten(docs["times"]).cast(pa.int64())})
        met = flat.join(pairs.select(["pair", "count", "best"]), "pair", join_type="inner", use_threads=False)
        met = met.append_column("n_best", pc.multiply(met["times"], met["best"].cast(pa.int64())))
        met = met.append_column("count_sum", pc.multiply(met["times"], met["count"]))
        per = met.group_by("doc", use_threads=False).aggregate([("n_best", "sum"), ("count_sum", "sum")])
        sums = {k: np.zeros(docs.num_rows, dtype=np.int64) for k in ("n_best", "count_sum")}
        for k, out in sums.items():
            out[per["doc"].to_numpy()] = per[f"{k}_sum"].to_numpy()
        return pa.table({"doc_id": docs["doc_id"], **{k: docs[k] for k in _NUMBERS}, **{k: pa.array(v) for k, v in sums.items()},
                         "groups_sha256": docs["groups_sha256"]})

    rows = links.where("not whole").drop("whole")
    return rows.groupBy("block").cogroup(known.groupBy("held_in")).applyInArrow(
        finish, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    return scored(linked(docs, path_a, path_b))
