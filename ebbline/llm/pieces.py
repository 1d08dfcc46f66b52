"""SentencePiece BPE of whole texts, every piece with the bytes of the text that it stands for.

A text is normalised by longest prefixes: at each place the longest key of the model's
compiled character map (a double-array trie) that the text goes on with is replaced by
its value; where no key fits, one character is kept. Beside every character of the
normalised text stands the byte of the source it came from, so a piece, which is a run
of normalised characters, is projected to a span of source bytes. Blanks are treated as
the model says: a blank is put in front, runs of blanks fold, blanks become U+2581.

Text normalised so is merged by the library, whose own normaliser is set aside; the widths
of the pieces, added up, say which characters each stands for. Merging never crosses from
another character to U+2581 if no piece of the vocabulary does; long texts are then worked
on in slices cut in front of a blank, so a task holds one slice's characters, places and
ids at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from ebbline.llm.common import added, carried, small_batches

BLANK = "▁"
# Characters of a slice of a long text.
SLICE = 1 << 20

WORD_END = re.compile(f"[^ {BLANK}] ")
PIECES = "array<struct<id:int,begin:bigint,end:bigint>>"


class Model:
    """The model's file, small enough to travel with the tasks, and what is read off it.

    Models of merges with a byte fallback and without user-defined or unused pieces are taken; others raise.
    """

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.raw = file.read()
        model = proto.ModelProto.FromString(self.raw)
        kinds = {p.type for p in model.pieces}
        piece = proto.ModelProto.SentencePiece
        if model.trainer_spec.model_type != proto.TrainerSpec.BPE or not model.trainer_spec.byte_fallback or kinds & {piece.USER_DEFINED, piece.UNUSED}:
            raise ValueError("only merges with a byte fallback and no user-defined or unused pieces")
        if model.trainer_spec.treat_whitespace_as_suffix or not model.normalizer_spec.escape_whitespaces:
            raise ValueError("only models that write a blank as U+2581 in front of a word")


class Normaliser:
    """Longest-prefix normalisation with source bytes, by the rules of a normaliser specification."""

    def __init__(self, charsmap: bytes, prefix: bool, fold: bool):
        self.prefix, self.fold = prefix, fold
        self.units, self.values = np.zeros(0, np.uint32), b""
        if charsmap:  # length of the trie, the trie, the values, each ended by a zero byte
            size = int.from_bytes(charsmap[:4], "little")
            self.units, self.values = np.frombuffer(charsmap[4 : 4 + size], "<u4"), charsmap[4 + size :]

    @classmethod
    def of(cls, spec: proto.NormalizerSpec) -> Normaliser:
        return cls(spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces)

    def longest(self, data: bytes, at: int) -> tuple[int, int] | None:
        """(bytes taken, place of the value) of the longest key that the bytes go on with."""
        units, found = self.units, None
        node = self._child(int(units[0]))
        for k in range(at, len(data)):
            node ^= data[k]
            unit = int(units[node])
            if unit & 0x800000FF != data[k]:  # label of another node
                return found
            node ^= self._child(unit)
            if unit >> 8 & 1:  # a key ends here
                found = k + 1 - at, int(units[node]) & 0x7FFFFFFF
        return found

    @staticmethod
    def _child(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def slices(self, text: str, size: int = SLICE) -> Iterator[tuple[str, np.ndarray]]:
        """Normalised slices of a text with the source byte of each character and, last, their end.

        A slice ends at the end of a word; a model that maps characters or folds blanks takes a text in one.
        """
        if self.fold or len(self.units):  # what follows a blank may bear on what stands before it
            size = max(len(text), 1)
        begin, byte, first = 0, 0, True
        while begin < len(text):
            cut = WORD_END.search(text, begin + size - 1) if len(text) - begin > size else None
            end = cut.start() + 1 if cut else len(text)
            said, at = self._mapped(text[begin:end]) if len(self.units) else _plain(text[begin:end])
            if self.fold:
                said, at = _folded(said, at)
            if said:
                said, at = said.replace(" ", BLANK), at + byte
                if first and self.prefix:
                    said, at = BLANK + said, np.append(at[:1], at)
                first = False
                yield said, at
            byte += len(text[begin:end].encode())
            begin = end

    def _mapped(self, text: str) -> tuple[str, np.ndarray]:
        data = text.encode()
        said, places, at, size = [], [], 0, len(data)
        while at < size:
            found = self.longest(data, at)
            if found:
                taken, value = found
                put = self.values[value : self.values.index(0, value)].decode()
            else:
                first = data[at]
                taken = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                put = data[at : at + taken].decode()
            said.append(put)
            places.extend([at] * len(put))
            at += taken
        return "".join(said), np.array([*places, size], np.int64)


def _plain(text: str) -> tuple[str, np.ndarray]:
    """The text itself, with the byte each character begins at."""
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    at = np.zeros(len(code) + 1, np.int64)
    np.cumsum(1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF), out=at[1:])
    return text, at


def _folded(said: str, at: np.ndarray) -> tuple[str, np.ndarray]:
    """Without blanks at either end and with one blank in place of several."""
    stop = len(said.rstrip(" " + BLANK))
    code = np.frombuffer(said[:stop].encode("utf-32-le"), np.uint32)
    places = np.flatnonzero((code != 32) | np.append(False, code[:-1] != 32)[: len(code)])
    return "".join(map(said.__getitem__, places.tolist())), np.append(at[places], at[stop])


class Encoder:
    """What a task builds from a model: the normaliser, merges of text that is normalised already, and widths of pieces."""

    def __init__(self, raw: bytes):
        model = proto.ModelProto.FromString(raw)
        kind = proto.ModelProto.SentencePiece
        self.normaliser = Normaliser.of(model.normalizer_spec)
        self.end = model.trainer_spec.eos_id
        self.decimal = [str(i) for i in range(len(model.pieces))]
        # A piece that holds no blank, for decoding a later slice as one that begins nothing.
        self.lead = next(i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL and BLANK not in p.piece)
        # Slices end in front of a blank; no piece may reach across.
        self.apart = not any(re.search(f"[^{BLANK}]{BLANK}", p.piece) for p in model.pieces if p.type == kind.NORMAL)
        # Characters of a piece; -1 for a byte. Bytes within a character, behind its first.
        self.wide = np.array([-1 if p.type == kind.BYTE else len(p.piece) for p in model.pieces], np.int32)
        self.inner = np.array([p.type == kind.BYTE and 0x80 <= int(p.piece[3:5], 16) < 0xC0 for p in model.pieces])
        model.normalizer_spec.ClearField("precompiled_charsmap")
        model.normalizer_spec.add_dummy_prefix = model.normalizer_spec.remove_extra_whitespaces = False
        self.merge = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString()).encode_as_numpy

    def slices(self, text: str, size: int = SLICE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each slice: its ids, and the source bytes at which their pieces begin and end."""
        for said, at in self.normaliser.slices(text, size if self.apart else max(len(text), 1)):
            ids = self.merge(said)
            wide = self.wide[ids]
            # Of the bytes of a character the last one stands for the whole.
            wide[:-1] -= (wide[:-1] < 0) & self.inner[ids[1:]]
            last = np.cumsum(np.where(wide < -1, 0, abs(wide)))
            yield ids, at[np.append(0, last[:-1])], at[last]


def encode(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",), size: int = SLICE) -> DataFrame:
    """`row` and `pieces` (id, begin, end) of every text; begin and end are bytes of the text in UTF-8.

    A null or empty text has no pieces; no end id is put behind. The blank put in front
    of a text begins where its first word begins. Of the byte pieces of one character the
    last has its span, the others an empty one. Equal rows count each.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(carried(docs, keep), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model.raw)
        for batch in batches:
            parts, many = [], []
            for text in batch.column(1).to_pylist():
                found = list(encoder.slices(text, size))
                many.append(sum(len(ids) for ids, _, _ in found))
                parts += found
            columns = zip(*parts) if parts else ([], [], [])
            values = [pa.array(np.concatenate(x) if x else [], kind) for x, kind in zip(columns, (pa.int32(), pa.int64(), pa.int64()))]
            offsets = pa.array(np.cumsum([0, *many]), pa.int32())
            pieces = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(values, names=["id", "begin", "end"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pieces], names=["row", "pieces"])

    return rows.mapInArrow(run, added(rows, pieces=PIECES))


def decode(encoded: DataFrame, model: Model) -> DataFrame:
    """The text of every row of `ids`, beside the row's other columns; null ids decode to the empty text.

    An id outside the vocabulary raises.
    """
    others = [c for c in encoded.columns if c not in ("ids", "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = sentencepiece.SentencePieceProcessor(model_proto=model.raw)
        for batch in batches:
            text = [library.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], names=["row", "text"])

    rows = encoded.select(carried(encoded, others), "ids")
    return rows.mapInArrow(run, added(rows, text="string")).select("row.*", "text")


def digests(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",), size: int = SLICE) -> DataFrame:
    """`row`, n_tokens, ids_sha256, decoded_sha256 and n_covered of every text.

    Ids, the end id behind them, are hashed as decimals joined by one space, the decoded
    text as UTF-8. `n_covered` counts the bytes of the text within the spans of its
    pieces: all of them, unless the model drops blanks. A null text is an empty one.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(carried(docs, keep), F.coalesce("text", F.lit("")).alias("text"))
    kinds = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string", "n_covered": "bigint"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, library = Encoder(model.raw), sentencepiece.SentencePieceProcessor(model_proto=model.raw)
        cut = len(library.decode([encoder.lead]))
        for batch in batches:
            made: list[tuple] = []
            for text in batch.column(1).to_pylist():
                n, covered, ids_hash, text_hash = 0, 0, hashlib.sha256(), hashlib.sha256()
                for nth, (found, begin, end) in enumerate(encoder.slices(text, size)):
                    ids = found.tolist()
                    ids_hash.update("".join([encoder.decimal[i] + " " for i in ids]).encode())
                    text_hash.update((library.decode([encoder.lead, *ids])[cut:] if nth else library.decode(ids)).encode())
                    n += len(ids)
                    covered += int((end - begin).sum())
                ids_hash.update(str(encoder.end).encode())
                made.append((n + 1, ids_hash.hexdigest(), text_hash.hexdigest(), covered))
            columns = [pa.array(list(c)) for c in zip(*made)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["row", *kinds])

    return rows.mapInArrow(run, added(rows, **kinds))
