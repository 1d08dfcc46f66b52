"""Pieces, spans and digests against the library run on whole texts, and the normaliser against its maps."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from ebbline.llm import catalog, pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, row string, pieces string, n_tokens int"
LETTERS = " ab  cthe ▁é①🎉\n1 2in"


def said(seed: int, many: int) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choices(LETTERS, k=draw.randrange(40))) for _ in range(many)]


TEXTS = [
    None, "", " ", "   ", "a", " a  b ", "▁x▁ y", "\n\n\t x", "①②½ﬁ", "a" * 3000, "🎉 hi\x00 there", " ▁ ",
    "same", "same", "</s> <unk> <0x41>", "The  year's 東京タワー end.\n" * 300, *said(1, 300),
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "clash", "clash", 7) for i, t in enumerate(TEXTS)], SCHEMA).repartition(3)


@pytest.mark.parametrize("size", [pieces.SLICE, 5])
def test_pieces_and_spans_are_those_of_the_library(docs, library, size):
    rows = pieces.encode(docs, pieces.Model(PATH), docs.columns, size).collect()
    assert len(rows) == len(TEXTS) and all(r["row"]["pieces"] == "clash" for r in rows)
    for r in rows:
        want = library.encode_as_proto(r["row"]["text"] or "").pieces
        assert [tuple(p) for p in r["pieces"]] == [(p.id, p.begin, p.end) for p in want]


@pytest.mark.parametrize("size", [pieces.SLICE, 5])
def test_digests(docs, library, size):
    rows = pieces.digests(docs, pieces.Model(PATH), size=size).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        text = TEXTS[r["row"]["doc_id"]] or ""
        ids = library.encode(text, add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert r["n_covered"] == len(text.encode())


def test_decoding_keeps_other_columns(spark, library):
    ids = library.encode("Hello  world ①", add_eos=True)
    rows = spark.createDataFrame([(1, ids, "x"), (2, None, "y"), (3, [], "z")], "doc_id int, ids array<int>, row string")
    found = {r["doc_id"]: (r["text"], r["row"]) for r in pieces.decode(rows, pieces.Model(PATH)).collect()}
    assert found == {1: ("Hello  world ①", "x"), 2: ("", "y"), 3: ("", "z")}


@pytest.mark.parametrize(("rule", "prefix", "fold"), [("nmt_nfkc", True, True), ("nfkc_cf", True, False), ("nmt_nfkc_cf", False, True), ("identity", True, True)])
def test_compiled_maps_are_followed_with_their_offsets(rule, prefix, fold):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=prefix, remove_extra_whitespaces=fold, escape_whitespaces=True)
    own = pieces.Normaliser.of(proto.ModelProto.FromString(library.serialized_model_proto()).normalizer_spec)
    for text in ["ＡＢＣ　①  ½ ﬁ ｶﾞ é  x ", "　　", " 　a　 　b　 ", "Straße ÄÖ", "x​ y­", *said(2, 400)]:
        slices = list(own.slices(text, 5))
        want, offsets = library.normalize(text, with_offsets=True)
        assert "".join(s for s, _ in slices) == want
        raw = text.encode()
        got = [len(raw[:b].decode()) for _, at in slices for b in at[:-1].tolist()]
        assert got == list(offsets)[: len(got)]


def test_no_documents(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert pieces.digests(empty, pieces.Model(PATH)).collect() == []
    assert pieces.encode(empty, pieces.Model(PATH)).collect() == []


def test_other_kinds_of_models_are_refused(tmp_path):
    model = proto.ModelProto()
    model.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    (tmp_path / "m").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="byte fallback"):
        pieces.Model(str(tmp_path / "m"))


def test_query(spark, library, tmp_path):
    spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in catalog.QUERIES["op12_pieces"](spark, str(tmp_path)).collect()}
    assert rows[1]["n_tokens"] == len(library.encode("a b")) + 1 and rows[2]["n_tokens"] == 1
    assert rows[2]["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
