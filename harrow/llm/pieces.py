"""Operator 1: SentencePiece encoding and decoding on the tokenizers library, rebuilt from the model file."""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from .chunks import ChunkCache

SPACE = "▁"
#: Piece types and model types of the format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
_CODERS: dict[str, SentencePieces] = {}


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def wire_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one protobuf message: varints as int, the rest as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            c = data[at]
            at += 1
            value |= (c & 127) << shift
            if c < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind)
            size = varint() if size is None else size
            yield key >> 3, data[at : at + size]
            at += size


@dataclass
class Model:
    """What the backend needs of a model file."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    suffix_space: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True

    @classmethod
    def parse(cls, data: bytes) -> Model:
        out = cls()
        for number, value in wire_fields(data):
            if number == 1:
                piece, score, kind = "", 0.0, NORMAL
                for n, v in wire_fields(value):
                    if n == 1:
                        piece = v.decode("utf-8")
                    elif n == 2:
                        score = struct.unpack("<f", v)[0]
                    elif n == 3:
                        kind = v
                out.pieces.append((piece, score, kind))
            elif number == 2:
                got = dict(wire_fields(value))
                out.kind, out.byte_fallback, out.suffix_space = got.get(3, UNIGRAM), bool(got.get(35, 0)), bool(got.get(24, 0))
            elif number == 3:
                got = dict(wire_fields(value))
                out.charsmap = got.get(2, b"")
                out.dummy_prefix, out.squeeze, out.escape = bool(got.get(3, 1)), bool(got.get(4, 1)), bool(got.get(5, 1))
        if out.suffix_space or not out.escape or out.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models with a leading space marker can be rebuilt")
        return out


def merges(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """BPE merges of a scored vocabulary: every cut of a piece into two pieces, best merged score first."""
    ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER)}
    found = []
    for p, i in ids.items():
        cuts = [(ids[p[:k]], ids[p[k:]], k) for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids]
        found += [(-pieces[i][1], i, left, right, p[:k], p[k:]) for left, right, k in cuts]
    return [(x[4], x[5]) for x in sorted(found)]


def build(model: Model):
    """A tokenizers.Tokenizer with the model's normaliser, space marker, scores or merges, and byte fallback."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    unk = next((i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN), 0)
    if model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], unk_id=unk, byte_fallback=model.byte_fallback)
    else:
        vocabulary = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        core = models.BPE(vocabulary, merges(model.pieces), unk_token=model.pieces[unk][0], fuse_unk=True, byte_fallback=model.byte_fallback)
    t = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ | $"), "")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(SPACE))
    t.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", SPACE)])
    if not any(re.search(f"[^{SPACE}]{SPACE}", p) for p, _, kind in model.pieces if kind in (NORMAL, USER)):
        # no piece reaches over a marker from the left, so words can be cut there
        t.pre_tokenizer = pre_tokenizers.Split(Regex(f"{SPACE}+[^{SPACE}]*"), "isolated")
    own = [p for p, _, kind in model.pieces if kind == USER]
    if own:
        t.add_tokens([AddedToken(p, normalized=False) for p in own])
    parts = [decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()]
    t.decoder = decoders.Sequence([*parts, decoders.Strip(" ", 1, 0)] if model.dummy_prefix else parts)
    return t


class SentencePieces:
    """Encode and decode whole texts by the rebuilt tokenizer, holding every distinct piece against sentencepiece."""

    def __init__(self, path: str, threads: int = 2) -> None:
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        import sentencepiece

        with open(path, "rb") as f:
            data = f.read()
        self.model = Model.parse(data)
        self.tokenizer = build(self.model)
        self.judge = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.cuttable = not self.model.charsmap and self.model.dummy_prefix and not self.model.squeeze and self.tokenizer.pre_tokenizer is not None
        self.cache = ChunkCache(self._encode_pieces)
        self.opens = np.array([p.startswith(SPACE) for p, _, _ in self.model.pieces])

    def _encode(self, texts: list[str]) -> list[tuple[bytes, str, bool]]:
        """(ids, decoded text, whether sentencepiece has the same ids) of each text; threads share the batch."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        back = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        same = self.judge.encode(texts, num_threads=1)
        return [(np.array(i, "<u4").tobytes(), d, i == s) for i, d, s in zip(ids, back, same, strict=True)]

    def _encode_pieces(self, pieces: list[str], together: int = 256) -> list[tuple[bytes, str, bool]]:
        """_encode() of pieces without spaces, many in one text: a token with the space marker opens the next piece."""
        plain = [p for p in pieces if SPACE not in p]
        known: dict[str, tuple[bytes, str, bool]] = {}
        groups = [plain[i : i + together] for i in range(0, len(plain), together)]
        for group, (ids, back, same) in zip(groups, self._encode([" ".join(g) for g in groups]), strict=True):
            ids = np.frombuffer(ids, "<u4")
            at, texts = np.flatnonzero(self.opens[ids]), back.split(" ")
            if same and len(at) == len(group) == len(texts) and not at[0]:
                known.update(zip(group, ((x.tobytes(), t, True) for x, t in zip(np.split(ids, at[1:]), texts, strict=True)), strict=True))
        rest = [p for p in pieces if p not in known]
        known.update(zip(rest, self._encode(rest), strict=True))
        return [known[p] for p in pieces]

    def encode(self, texts: list[str]) -> list[tuple[bytes, str, bool]]:
        """_encode() of each text, from its pieces where it can be cut; texts of every 64th checksum are held against sentencepiece whole as well."""
        out = self._encode_texts(texts)
        held = [i for i, t in enumerate(texts) if zlib.crc32(t.encode("utf-8", "surrogatepass")) % 64 == 0]
        for i, ids in zip(held, self.judge.encode([texts[i] for i in held], num_threads=1), strict=True):
            out[i] = (*out[i][:2], out[i][2] and out[i][0] == np.array(ids, "<u4").tobytes())
        return out

    def _encode_texts(self, texts: list[str]) -> list[tuple[bytes, str, bool]]:
        found = self.cache.look_up([t.split(" ") if self.cuttable and SPACE not in t else [""] for t in texts])
        out = [
            (b"".join([v[0] for v in x]), " ".join([v[1] for v in x]), all([v[2] for v in x])) if x is not None else None for x in found
        ]
        whole = [i for i, x in enumerate(out) if x is None]
        for i, v in zip(whole, self._encode([texts[i] for i in whole]), strict=True):
            out[i] = v
        return out


def coder(path: str, threads: int = 2) -> SentencePieces:
    if path not in _CODERS:
        _CODERS[path] = SentencePieces(path, threads)
    return _CODERS[path]


def encode_decode(docs: DataFrame, model: str | None = None, threads: int = 2) -> DataFrame:
    """Every whole text encoded and decoded: doc_id, n_ids, ids_crc32, text_crc32, decoded_crc32, round_trip, parity.

    ids_crc32 is over little-endian 32-bit ids; decoded_crc32 over the decoded text in UTF-8; round_trip says that it
    equals the text and parity that sentencepiece gives the same ids, to every piece and, for one text in 64, to the whole text. A null text counts as empty (no ids); repeated rows
    give repeated results; columns besides doc_id and text are left out. No shuffle.
    """
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, threads)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                texts = [t or "" for t in b.column(1).to_pylist()]
                got = c.encode(texts)
                crc = lambda x: zlib.crc32(x.encode("utf-8", "surrogatepass"))
                cols = [
                    [len(i) // 4 for i, _, _ in got], [zlib.crc32(i) for i, _, _ in got], [crc(t) for t in texts], [crc(d) for _, d, _ in got],
                ]
                flags = [[d == t for (_, d, _), t in zip(got, texts, strict=True)], [p for _, _, p in got]]
                arrays = [pa.array(c, pa.int64()) for c in cols] + [pa.array(f, pa.bool_()) for f in flags]
                yield pa.RecordBatch.from_arrays([b.column(0), *arrays], names)

    names = ["doc_id", "n_ids", "ids_crc32", "text_crc32", "decoded_crc32", "round_trip", "parity"]
    kinds = [docs.schema["doc_id"].dataType] + [LongType()] * 4 + [BooleanType()] * 2
    return docs.select("doc_id", "text").mapInArrow(run, StructType([StructField(n, k) for n, k in zip(names, kinds, strict=True)]))
