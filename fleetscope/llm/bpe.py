"""Byte-level BPE through a sentencepiece model that is written directly from a vocabulary of ranks.

Every byte of the text stands for one printable character, every token of the vocabulary becomes a
piece of such characters, scored by its negative rank, and the normaliser does nothing. Then the best
merge of sentencepiece is the merge with the lowest rank, and piece numbers are token ids.

Cases: a null or empty text has no ids; texts of any length are encoded whole, cut for memory only at
single spaces that no match of the pattern crosses; other columns stay as they are; decoding takes ids
that are not in the vocabulary as an error. Repeated rows and null ids are rows like any other.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fleetscope.llm import words

MEMO_ENTRIES = 300_000
SEGMENT_CHARS = 1 << 20
_CUT = re.compile(r"(?<=\S) (?=\S)")
_SPACED = regex.compile(r" ?\S+|\s+(?!\S)|\s+")


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def byte_characters() -> list[str]:
    """One printable character for each byte: itself where it is printable in Latin-1, else one from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(spare)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """The serialised model; the piece for unknown input, which no text has, gets the last id."""
    # Fixed values of the public model format: field numbers and enum values.
    normal, unknown, bpe = 1, 2, 2
    shown = byte_characters()
    out = [
        _field(1, _field(1, "".join(shown[b] for b in token).encode()) + _field(2, float(-rank)) + _field(3, normal))
        for rank, token in enumerate(tokens)
    ]
    out.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown)))
    no_ids = b"".join(_field(n, (1 << 64) - 1) for n in (41, 42, 43))
    out.append(_field(2, _field(3, bpe) + _field(4, len(tokens) + 1) + _field(40, len(tokens)) + no_ids))
    out.append(_field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)))
    return b"".join(out)


def segments(text: str, limit: int = SEGMENT_CHARS) -> Iterator[str]:
    """The text in parts, cut only before single spaces between other characters."""
    at = 0
    while len(text) - at > limit:
        cut = _CUT.search(text, at + limit)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def _trim(memo: dict) -> None:
    """Drop the newer half of a full memo; frequent keys come early and stay."""
    if len(memo) > MEMO_ENTRIES:
        for key in list(memo)[MEMO_ENTRIES // 2 :]:
            del memo[key]


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes.

    ``pieces`` remembers what stands between two spaces, with the space before it. No match of the
    pattern crosses from one piece into the next unless nothing but white space is between two spaces;
    such texts are split by a pattern that knows white space only. ``matches`` remembers matches. What
    neither knows yet is encoded for many texts at a time: new pieces are matched in one string, and new
    matches go through the model in one string, parted by a character that no token has.
    """

    def __init__(self, model: bytes, tokens: list[bytes], pattern: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.findall = regex.compile(pattern).findall
        self.shown = dict(enumerate(byte_characters()))
        self.ranks = {token: struct.pack("<i", rank) for rank, token in enumerate(tokens)}
        self.matches: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _learn_matches(self, found: list[str]) -> None:
        """Ids of new matches: a match that is a token is its own id, else what merging by rank leaves."""
        new = []
        for match in set(found).difference(self.matches):
            whole = self.ranks.get(match.encode())
            if whole is None:
                new.append(match)
            else:
                self.matches[match] = whole
        for at in range(0, len(new), 1000):
            some = new[at : at + 1000]
            shown = "\n".join([m.encode().decode("latin-1").translate(self.shown) for m in some])
            ids = np.array(self.processor.EncodeAsIds(shown), "<i4")
            cuts = np.flatnonzero(ids == len(self.ranks)) * 4
            raw, begins = ids.tobytes(), [0, *(cuts + 4).tolist()]
            self.matches.update(zip(some, map(lambda i, j: raw[i:j], begins, [*cuts.tolist(), len(raw)])))

    def _learn_pieces(self, parts: set[str]) -> None:
        new = list(parts.difference(self.pieces))
        odd = [p for p in new if not p or p[-1].isspace()]
        plain = [p for p in new if p and not p[-1].isspace()]
        found = self.findall(" " + " ".join(plain)) if plain else []
        own = [self.findall(" " + p) for p in odd]
        self._learn_matches([*found, *(m for tokens in own for m in tokens)])
        ids = [self.matches[m] for m in found]
        begins = [i for i, m in enumerate(found) if m[0] == " "]
        for part, i, j in zip(plain, begins, [*begins[1:], len(found)]):
            self.pieces[part] = ids[i] if j == i + 1 else b"".join(ids[i:j])
        for part, tokens in zip(odd, own):
            self.pieces[part] = b"".join([self.matches[m] for m in tokens])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        _trim(self.pieces)
        _trim(self.matches)
        split = []  # per segment of a text: what stands first, and the pieces
        for number, text in enumerate(texts):
            for part in segments(text or ""):
                first, *rest = part.split(" ")
                if "" in rest or any(map(str.isspace, rest)):
                    spaced = _SPACED.findall(part)
                    split += [(number, "", [p[1:]]) if p[0] == " " else (number, p, []) for p in spaced]
                else:
                    split.append((number, first, rest))
        self._learn_pieces(set().union(*(rest for _, _, rest in split)))
        firsts = [self.findall(first) for _, first, _ in split]
        self._learn_matches([m for tokens in firsts for m in tokens])
        out: list[list[bytes]] = [[] for _ in texts]
        for (number, _, rest), tokens in zip(split, firsts):
            out[number] += map(self.matches.__getitem__, tokens)
            out[number] += map(self.pieces.__getitem__, rest)
        return [b"".join(ids) for ids in out]


def _with_column(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    at = batch.schema.get_field_index(name)
    arrays, names = list(batch.columns), list(batch.schema.names)
    if at >= 0:
        arrays[at] = column
    else:
        arrays.append(column)
        names.append(name)
    return pa.RecordBatch.from_arrays(arrays, names)


def _schema_with(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    fields = [f for f in df.schema.fields if f.name != name]
    at = df.columns.index(name) if name in df.columns else len(fields)
    return T.StructType(fields[:at] + [T.StructField(name, kind)] + fields[at:])


def encode(df: DataFrame, tokens: list[bytes], pattern: str, column: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with the token ids of ``column`` in ``out`` (array of int, empty for a null text).

    ``tokens`` has the tokens by rank (see ``read_ranks``), ``pattern`` splits texts into pre-tokens.
    A column that already has the name ``out`` is replaced.
    """
    words.use_batches(df.sparkSession)
    model = df.sparkSession.sparkContext.broadcast((sentencepiece_model(tokens), tokens))

    def run(batches):
        encoder = Encoder(*model.value, pattern)
        for whole in batches:
            for batch in words.slices(whole, column):
                rows = encoder.encode(batch.column(column).to_pylist())
                bounds = np.concatenate(([0], np.cumsum([len(r) // 4 for r in rows]))).astype(np.int64)
                ids = np.frombuffer(b"".join(rows), "<i4")
                yield _with_column(batch, out, words.list_of(ids, bounds, pa.int32()))

    return df.mapInArrow(run, _schema_with(df, out, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, tokens: list[bytes], column: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes that the ids in ``column`` stand for in ``out`` (binary; null ids: empty)."""
    table = df.sparkSession.sparkContext.broadcast(tokens)

    def run(batches):
        token = table.value.__getitem__
        for batch in batches:
            ids = batch.column(column)
            rows = [b"".join(map(token, x.values.to_numpy().tolist())) if x.is_valid else b"" for x in ids]
            yield _with_column(batch, out, pa.array(rows, pa.binary()))

    return df.mapInArrow(run, _schema_with(df, out, T.BinaryType()))
