"""Byte-level BPE encoding and decoding through a sentencepiece model.

The rank file of a byte-level vocabulary is turned into a sentencepiece BPE
model without training: every token's bytes become characters by a fixed
byte-to-character map, its score is the negative rank (so the merge of the
lowest rank goes first), and normalisation is the identity.  A text is cut into
pre-tokens by the vocabulary's pattern, each pre-token is encoded on its own,
and ids are decoded by the inverse map.

Null texts count as empty and give no ids.  Rows are independent, so repeated
rows repeat their result and an empty table gives an empty one; other columns
pass through, unless they have the name of an added column.
"""

from __future__ import annotations

import base64
import hashlib
from struct import pack

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as sp_pb2

from ledgerline.llm.common import annotated, map_arrow, table

#: Pre-tokens a task remembers; beyond it the memory is emptied (results stay the same).
REMEMBERED = 200_000


def byte_characters() -> list[str]:
    """One visible character for each byte: itself where printable, else from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 0x100
    for b in range(256):
        if b in printable:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and rank of a rank file (base64 token, blank, rank; one a line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def build_model(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece BPE model whose piece ids are the ranks."""
    chars = byte_characters()
    by_rank = sorted(ranks, key=ranks.get)
    if [ranks[token] for token in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must be 0 to n - 1 without gaps")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("the vocabulary must hold every single byte")
    model = sp_pb2.ModelProto()
    for rank, token in enumerate(by_rank):
        piece = model.pieces.add()
        piece.piece = "".join(chars[b] for b in token)
        piece.score = -float(rank)
        piece.type = sp_pb2.ModelProto.SentencePiece.NORMAL
    unknown = model.pieces.add()
    unknown.piece, unknown.score, unknown.type = "<unk>", 0.0, sp_pb2.ModelProto.SentencePiece.UNKNOWN
    spec = model.trainer_spec
    spec.model_type = sp_pb2.TrainerSpec.BPE
    spec.vocab_size = len(model.pieces)
    spec.unk_id, spec.bos_id, spec.eos_id, spec.pad_id = len(by_rank), -1, -1, -1
    norm = model.normalizer_spec
    norm.name = "identity"
    norm.add_dummy_prefix = norm.remove_extra_whitespaces = norm.escape_whitespaces = False
    return model.SerializeToString()


class Codec:
    """Encoder and decoder of one task."""

    def __init__(self, model: bytes, pattern: str, remembered: int = REMEMBERED):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pretokens = regex.compile(pattern).findall
        self.remembered = remembered
        chars = byte_characters()
        self.to_chars = {b: c for b, c in enumerate(chars)}
        self.blank = chars[0x20]
        back = {c: b for b, c in enumerate(chars)}
        size = self.processor.get_piece_size() - 1
        pieces = [self.processor.id_to_piece(i) for i in range(size)]
        self.bytes_of = [bytes(back[c] for c in piece) for piece in pieces]
        self.whole = {token: np.uint32(i).tobytes() for i, token in enumerate(self.bytes_of)}
        self.known: dict[str, bytes] = {}

    def _learn(self, tokens: list[str]) -> None:
        rest, mapped = [], []
        for token in tokens:
            raw = token.encode()
            ids = self.whole.get(raw)
            if ids is not None:
                self.known[token] = ids
            else:
                rest.append(token)
                if token[0] == " " and token.isascii() and token[1:].isalnum():  # the usual pre-token, without a look at each byte
                    mapped.append(self.blank + token[1:])
                else:
                    mapped.append(raw.decode("latin-1").translate(self.to_chars))
        if rest:
            for token, ids in zip(rest, self.processor.encode(mapped, out_type=int, num_threads=1)):
                self.known[token] = pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, one after the other."""
        if len(self.known) > self.remembered:
            self.known.clear()
        tokens, known = self.pretokens(text), self.known
        missing = [token for token in set(tokens) if token not in known]
        if missing:
            self._learn(missing)
        return b"".join(map(known.__getitem__, tokens))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def _texts(data: np.ndarray, offsets: np.ndarray):
    raw = data.tobytes()
    return (raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()))


def encode(docs: DataFrame, model: bytes, pattern: str = public_tokenizers.PATTERN, text: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` (array of int): the ids of the whole text."""

    def make():
        codec = Codec(model, pattern)

        def step(rows, data, offsets):
            parts = [np.frombuffer(codec.encode(t), dtype="<u4") for t in _texts(data, offsets)]
            ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
            values = pa.array(np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32))
            return [pa.ListArray.from_arrays(pa.array(ends), values)]

        return step

    return annotated(docs, text, T.StructType().add("token_ids", T.ArrayType(T.IntegerType())), make, max_rows=256)


def decode(rows: DataFrame, model: bytes, pattern: str = public_tokenizers.PATTERN, ids: str = "token_ids") -> DataFrame:
    """``rows`` with ``decoded`` (binary): the bytes that ``ids`` stand for; null ids give null."""
    base = rows.drop("decoded")
    schema = T.StructType([*base.schema.fields, T.StructField("decoded", T.BinaryType())])

    def run(batches):
        codec = Codec(model, pattern)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            out = [None if x is None else codec.decode(np.array(x, dtype="<u4").tobytes()) for x in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=schema.names)

    return map_arrow(base, run, schema)


def digests(docs: DataFrame, model: bytes, pattern: str = public_tokenizers.PATTERN, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` and SHA-256 of the ids and of the decoded bytes; ids never leave the task."""

    def make():
        codec = Codec(model, pattern)

        def step(rows, data, offsets):
            counts, of_ids, of_bytes = [], [], []
            for t in _texts(data, offsets):
                ids = codec.encode(t)
                counts.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_bytes.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            return [counts, of_ids, of_bytes]

        return step

    added = T.StructType().add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    return annotated(docs, text, added, make)


def op9_byte_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    model = build_model(read_ranks(vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")))
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text"), model).drop("text")
