"""Token counts and byte-level BPE against the libraries run on whole texts."""

import base64
import hashlib

import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from ebbline.llm import bpe, counts

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id bigint, text string, row string, key string, n_tokens int"
LONG = "It's the year's  3rd  end,\n\n á éclair — 東京タワー 's 've <|endoftext|> can't\t" * 40
TEXTS = [
    None,
    "",
    " ",
    "\n \n",
    "Hello, World! It's 2024.",
    "same",
    "same",
    LONG,
    LONG,
    "x" * 900,
    " " * 700,
    "''" * 400 + "s 's" * 30,
    ("word " * 80 + "y" * 300) * 3,
    "́ Ï\x1c\x85  ﬁ <|startoftext|>a<|endoftext|> Σας",
    "東京" * 400,
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "clash", "clash", 7) for i, t in enumerate(TEXTS)], SCHEMA).repartition(3)


@pytest.mark.parametrize("chunk, overlap", [(100, 20), (64, 32), (32_768, 512)])
def test_counts_equal_the_library(docs, chunk, overlap):
    tokenizer = Tokenizer.from_file(WORDS)
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in counts.count(docs, counts.Vocabulary(WORDS), chunk=chunk, overlap=overlap).select("row.doc_id", "n_bytes", "n_tokens").collect()}
    want = {i: (len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(TEXTS)}
    assert got == want


def plain(text, ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}):
    """The definition: in each match of the pattern, merge the neighbours of least rank until none has one."""
    ids = []
    for match in regex.finditer(public_tokenizers.PATTERN, text):
        parts = [bytes([b]) for b in match.group().encode()]
        while len(parts) > 1:
            rank, at = min((ranks.get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 30:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        ids += [ranks[p] for p in parts]
    return ids


@pytest.mark.parametrize("chunk, overlap", [(100, 20), (40, 8), (32_768, 512)])
def test_ids_and_round_trip(docs, chunk, overlap):
    codec = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    rows = bpe.digests(docs, codec, chunk=chunk, overlap=overlap).select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    got = {r[0]: tuple(r)[1:] for r in rows}
    assert len(rows) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        ids = plain(text or "")
        said = " ".join(map(str, ids)).encode()
        assert got[i] == (len(ids), hashlib.sha256(said).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_pieces_decode_to_the_text(docs):
    codec = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    pieces = bpe.decode(bpe.encode(docs.dropDuplicates(["text"]), codec, chunk=100, overlap=20), codec)
    texts = {}
    for r in pieces.select("row.doc_id", "piece", "bytes").orderBy("doc_id", "piece").collect():
        texts[r.doc_id] = texts.get(r.doc_id, b"") + bytes(r.bytes)
    assert {t.decode() for t in texts.values()} == {t or "" for t in TEXTS}
    assert pieces.count() > len(texts) + 20


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert counts.count(none, counts.Vocabulary(WORDS)).count() == 0
    assert bpe.digests(none, bpe.Codec(RANKS, public_tokenizers.PATTERN)).count() == 0
