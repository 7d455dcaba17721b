"""The token operators against the tokenizer libraries."""

import bisect
import os
import random
import sys
from collections import Counter

import pytest
import sentencepiece
from public_tokenizers import path as tokenizer
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402
import cases  # noqa: E402

from payledger.llm import sentencepiece_codec as S  # noqa: E402
from payledger.llm import token_alignment as T  # noqa: E402


def key(row):
    return tuple((x is None, x) for x in row)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def codec():
    return S.Codec(S.model_bytes())


@pytest.fixture(scope="module", params=["odd", "sf0.001"])
def docs(request, spark):
    if request.param == "odd":
        return spark.createDataFrame(cases.odd_documents(), cases.DOC_SCHEMA)
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def strange_texts(seed: int, n: int):
    rng = random.Random(seed)
    letters = [chr(c) for c in [*range(0x250), *range(0x400, 0x460), *range(0x4E00, 0x4E80), *range(0x1F600, 0x1F640), 0x2028, 0x2581, 0xA0, 0xFEFF, 0xFFFD]]
    parts = ["▁", " ", "the", "ing", "\n", "é", "日本", "😀", "<0x41>", "<s>", "</s>", "<unk>", "<|endoftext|>"]
    for i in range(n):
        yield "".join(rng.choice((letters, " abeinrst", " aab", parts, ["   ", "x", "        ", "the", "\n"])[i % 5]) for _ in range(rng.randrange(60)))


def test_encoding_is_the_library_s(codec, library):
    texts = ["", " ", "x", *strange_texts(1, 4000), "z" * 50_001, "ab" * 30_000, " " * 20_001, "😀é" * 20_000, "aaab" * 20_000]
    for text in texts:
        ids = codec.encode(text)
        assert ids == library.encode(text), text[:80]
        assert codec.decode(ids) == library.decode(ids), text[:80]


def test_decoding_any_ids(codec, library):
    rng = random.Random(2)
    for _ in range(4000):
        ids = [rng.choice((0, 1, 2, rng.randrange(3, 259), rng.randrange(259, 32000), 29871, 259)) for _ in range(rng.randrange(9))]
        assert codec.decode(ids) == library.decode(ids), ids


def test_merging_is_what_the_pieces_encode_to(codec, library):
    """The definition that pairs are held against, and every piece as its own encoding."""
    rng = random.Random(3)
    pieces = [p for p, n in zip(codec.model.pieces, codec.length) if n]
    for _ in range(3000):
        text = rng.choice(pieces) + rng.choice(pieces)
        want = library.encode(text.replace(S.SPACE, " "))
        got = [codec.model.ids[p] for p in S.merged(codec.model, S.SPACE + text)]
        assert got == want


def test_forgetting_changes_nothing(codec, library, monkeypatch):
    monkeypatch.setattr(S, "CUTS", 3)
    monkeypatch.setattr(S, "PAIRS", 5)
    small = S.Codec(S.model_bytes())
    for text in strange_texts(4, 300):
        assert small.encode(text) == library.encode(text)
    assert len(small.cuts) <= 3 and sum(map(len, small.follows)) <= 5


def test_unlike_models_are_refused():
    data = S.model_bytes()
    with pytest.raises(ValueError):
        S.Codec(data + bytes([S.NORMALIZER << 3 | 2, 2, 0x20, 1]))  # white space removed


def test_round_trip(docs, library):
    rows = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    want = []
    for doc_id, text in rows:
        ids = library.encode(text)
        want.append((doc_id, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(library.decode(ids))))
    assert sorted(map(tuple, S.round_trip(docs).collect()), key=key) == sorted(want, key=key)
    ids = S.encoded(docs)
    assert sorted(((r[0], list(r[1])) for r in ids.collect()), key=key) == sorted(((d, library.encode(t)) for d, t in rows), key=key)
    assert sorted(map(tuple, S.decoded(ids).collect()), key=key) == sorted(((d, library.decode(library.encode(t))) for d, t in rows), key=key)


def test_empty_table(spark):
    none = spark.createDataFrame([], cases.DOC_SCHEMA)
    assert S.round_trip(none).count() == 0 and S.encoded(none).count() == 0


# ------------------------------------------------------------- token alignment


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    with open(tokenizer("byte_bpe_50k.json"), "rb") as f, open(tokenizer("piece_bpe_32k.model"), "rb") as g:
        return a, T.ByteLevel(f.read()), T.Pieces(g.read())


def brute_groups(text, both):
    """Groups of (A ids, B ids), or none."""
    library, a, b = both
    if not text:
        return []
    ids = library.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    ends = [[], []]
    for side, tokens, out in zip(ids, (a.tokens, b.tokens), ends):
        joined = b""
        for i in side:
            joined += tokens[i]
            out.append(len(joined))
        if joined != (" " + text).encode():
            return []
    shared = sorted(set(ends[0]) & set(ends[1]))
    groups = [([], []) for _ in shared]
    for k in (0, 1):
        for i, end in zip(ids[k], ends[k]):
            groups[bisect.bisect_left(shared, end)][k].append(i)
    return groups


def brute_alignment(rows, both):
    groups = [brute_groups(t, both) for _, t in rows]
    links = [[(i, j) for ga, gb in g for i in ga for j in gb] for g in groups]
    held = Counter(p for ls in links for p in set(ls))
    most = Counter()
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    out = []
    for (doc_id, _), g, ls in zip(rows, groups, links):
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in g)
        out.append((doc_id, sum(len(ga) for ga, _ in g), sum(len(gb) for _, gb in g), len(g), len(ls), sum(held[p] == most[p[0]] for p in ls),
                    sum(held[p] for p in ls), brute.sha(text) if g else ""))
    return out


def test_a_encodes_as_its_library(both):
    library, a, _ = both
    for text in [*strange_texts(6, 3000), " " * 1_200_000, "x" + "\t " * 120_000 + "y", "z" * 50_000]:
        assert a.encode(" " + text) == library.encode(" " + text, add_special_tokens=False).ids


@pytest.mark.parametrize("limits", [{}, {"BLOCK": 3000, "LINKS": 50, "GROUPS": 7, "WIDE": 3}])
def test_alignment(docs, both, limits, monkeypatch):
    for k, v in limits.items():
        monkeypatch.setattr(T, k, v)
    extra = [(900 + i, t) for i, t in enumerate(["a▁b", "<|endoftext|> <s>", "😀é日本" * 40 + " " * 90 + "x", "1234567" * 30, " " * 40])]
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()] + extra
    df = docs.sparkSession.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted(brute_alignment(rows, both), key=key)
    got = T.align(df)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == want


def test_wide_groups_are_counted_before_they_are_paired(both, monkeypatch):
    """A group of many tokens on both sides, made by tokenizers that never meet inside."""

    class Fixed:
        tokens = [b"", b" ", b"ab", b"a", b"ba", b"b"]

        def __init__(self, ids):
            self.ids = ids

        def encode(self, text):
            return self.ids if text else []

    n = 3000
    a, b = Fixed([1] + [2] * n), Fixed([1, 3] + [4] * (n - 1) + [5])
    numbers, pairs = T.aligned_block(["ab" * n, ""], a, b)
    assert list(numbers["n_links"]) == [1 + n * (n + 1), 0] and list(numbers["n_groups"]) == [2, 0]
    assert {(p["pair"] >> 32, p["pair"] & 0xFFFF): p["times"] for p in pairs.to_pylist()} == {
        (1, 1): 1, (2, 3): n, (2, 4): n * (n - 1), (2, 5): n}


def test_alignment_of_an_empty_table(spark):
    assert T.align(spark.createDataFrame([], cases.DOC_SCHEMA)).count() == 0
