"""Token ids as directly addressable codes, in files of whole documents in id order.

Each id is cut into chunks of ``CHUNK_BITS`` bits. Level 0 has the lowest chunk of every id; a bitmap
says whose code goes on, and level 1 has the next chunk of just those, and so on. A directory holds, for
every block of the bitmap, how many bits are set before it, so the place of a code in the next level is
one look-up and one count within a block: any id is found without decoding its neighbours.

A file row is a segment: consecutive whole documents, their places, and one code for all their ids.
Segments are rows of Parquet files in a shared folder, so that Spark's commit protocol covers lost tasks.

Cases: a null or empty text has only the end id; documents come in ascending ``doc_id`` order, null
first, rows with equal ids by text; a document is never split between segments, however long it is;
an empty table gives an empty folder with the same columns. Other columns are not written.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetscope.llm import words
from fleetscope.llm.bpe import byte_characters

CHUNK_BITS = 8
RANK_BLOCK = 512  # bits of the bitmap for each entry of the directory
SEGMENT_TOKENS = 1 << 20
MEMO_ENTRIES = 600_000
MAGIC = b"DAC1"

SEGMENT_SCHEMA = (
    "shard int, segment int, shard_tokens_before long, n_tokens long, doc_ids array<long>, "
    "doc_starts array<long>, code binary"
)


# ---- the code ------------------------------------------------------------------------------------


def pack(ids: np.ndarray) -> bytes:
    """The code of ids from 0 to 2**32 - 1."""
    rest = ids.astype(np.uint32)
    levels = []
    while True:
        more = rest >> CHUNK_BITS
        goes_on = more > 0
        chunks = (rest & ((1 << CHUNK_BITS) - 1)).astype(np.uint8)
        bits = np.packbits(goes_on, bitorder="little")
        bits = np.pad(bits, (0, -len(bits) % (RANK_BLOCK // 8)))
        ones = np.bitwise_count(bits.reshape(-1, RANK_BLOCK // 8)).sum(axis=1, dtype=np.uint32)
        ranks = np.concatenate(([0], np.cumsum(ones, dtype=np.uint32)[:-1])).astype("<u4") if len(ones) else ones
        levels.append((chunks.tobytes(), bits.tobytes(), ranks.tobytes()))
        if not goes_on.any():
            break
        rest = more[goes_on]
    head = MAGIC + struct.pack("<BQ", len(levels), len(ids))
    sizes = b"".join(struct.pack("<QQQ", *map(len, level)) for level in levels)
    return head + sizes + b"".join(part for level in levels for part in level)


class Code:
    """A packed code, read in place."""

    def __init__(self, raw: bytes):
        if raw[:4] != MAGIC:
            raise ValueError("not a directly addressable code")
        n_levels, self.length = struct.unpack_from("<BQ", raw, 4)
        at = 13 + 24 * n_levels
        self.levels = []
        for level in range(n_levels):
            views = []
            for size, kind in zip(struct.unpack_from("<QQQ", raw, 13 + 24 * level), (np.uint8, np.uint8, "<u4")):
                views.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at))
                at += size
            self.levels.append(views)

    def at(self, places: np.ndarray) -> np.ndarray:
        """The ids at the given places, each found through the directories alone."""
        places = np.asarray(places, dtype=np.int64)
        out = np.zeros(len(places), dtype=np.uint32)
        alive = np.arange(len(places))
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            out[alive] |= chunks[places].astype(np.uint32) << (CHUNK_BITS * level)
            goes_on = bits[places >> 3] >> (places & 7).astype(np.uint8) & 1 > 0
            alive, places = alive[goes_on], places[goes_on]
            if not len(alive):
                break
            block = places // RANK_BLOCK
            span = np.arange(RANK_BLOCK // 8)
            before = places % RANK_BLOCK
            step = 4096  # blocks looked at together
            found = np.empty(len(places), dtype=np.int64)
            for i in range(0, len(places), step):
                b, n = block[i : i + step, None], before[i : i + step, None]
                window = bits[b * (RANK_BLOCK // 8) + span]
                kept = np.clip(n - span * 8, 0, 8)
                found[i : i + step] = np.bitwise_count(window & ((1 << kept) - 1).astype(np.uint8)).sum(axis=1)
            places = ranks[block] + found
        return out

    def all(self) -> np.ndarray:
        """Every id, level by level."""
        out = np.zeros(self.length, dtype=np.uint32)
        alive = None
        for level, (chunks, bits, _) in enumerate(self.levels):
            if alive is None:
                out |= chunks
                alive = np.flatnonzero(np.unpackbits(bits, bitorder="little")[: len(chunks)])
            else:
                out[alive] |= chunks.astype(np.uint32) << (CHUNK_BITS * level)
                alive = alive[np.flatnonzero(np.unpackbits(bits, bitorder="little")[: len(chunks)])]
        return out


# ---- encoding texts ------------------------------------------------------------------------------


#: Words of printable ASCII and precomposed Latin letters: they are their own normal form, and every
#: library agrees on what in them is a letter.
_PLAIN = re.compile("[!-~\u00c0-\u012f\u0131-\u024f]+")


class WordEncoder:
    """Ids of whole texts by a vocabulary whose normaliser and splitter treat white space as a cut.

    Then a text's ids are those of its words, and each word is encoded once while it is remembered. Only
    white space of ASCII cuts here; A-Z count as a-z, as the vocabulary's normaliser has it. The library
    normalises and splits each new word, but plain ones, which are lower-cased and split here by the
    vocabulary's own pattern, so that only its merges remain to be done for pieces not seen before.

    Names of special tokens in a text are ordinary text; without ``names_are_text`` they are those tokens, as
    is the library's default, and a text that may have one in it is encoded by the library as it stands.
    """

    def __init__(self, vocabulary: str, names_are_text: bool = True):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.encode_special_tokens = names_are_text
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.shown = dict(enumerate(byte_characters()))
        parts = json.loads(vocabulary)
        # a name that is no special token's is found in either case
        added = [t["content"].lower().encode() for t in parts.get("added_tokens", []) if not (names_are_text and t["special"])]
        search, lead = re.compile(b"|".join(map(re.escape, added))).search, os.path.commonprefix(added)
        self.named = lambda t: bool(added) and lead in t and search(t) is not None
        kinds = [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])]
        split = (parts["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex")
        known = kinds == ["NFC", "Replace", "Lowercase"] and split
        self.split = regex.compile(f"{split}| ").findall if known else None

    def _learn_plain(self, new: list[bytes], plain: list[str]) -> None:
        found = self.split(" ".join(plain).lower())
        for piece in set(found).difference(self.pieces, " "):
            shown = piece.encode().decode("latin-1").translate(self.shown)
            ids = [token.id for token in self.tokenizer.model.tokenize(shown)]
            self.pieces[piece] = struct.pack(f"<{len(ids)}I", *ids)
        own: list[bytes] = []
        coded: list[bytes] = []
        for piece in [*found, " "]:
            if piece == " ":
                coded.append(b"".join(own))
                own = []
            else:
                own.append(self.pieces[piece])
        self.words.update(zip(new, coded, strict=True))

    def _learn(self, new: list[bytes]) -> None:
        texts = [w.decode() for w in new]
        plain = [self.split is not None and _PLAIN.fullmatch(t) is not None for t in texts]
        if any(plain):
            self._learn_plain([w for w, p in zip(new, plain) if p], [t for t, p in zip(texts, plain) if p])
        others = [t for t, p in zip(texts, plain) if not p]
        coded = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
        for text, code in zip(others, coded):
            self.words[text.encode()] = np.array(code.ids, "<u4").tobytes()

    def encode(self, texts: list[bytes | None], end: int) -> list[np.ndarray]:
        for memo in (self.words, self.pieces):
            if len(memo) > MEMO_ENTRIES:
                for key in list(memo)[MEMO_ENTRIES // 2 :]:  # frequent words come early and stay
                    del memo[key]
        lowered = [(t or b"").lower() for t in texts]
        named = [self.named(t) for t in lowered]
        split = [[] if by_library else t.split() for t, by_library in zip(lowered, named)]
        new = list(set().union(*split).difference(self.words))
        for at in range(0, len(new), 10_000):
            self._learn(new[at : at + 10_000])
        last = struct.pack("<I", end)
        coded = [np.frombuffer(b"".join([*map(self.words.__getitem__, ws), last]), "<u4") for ws in split]
        for i, by_library in enumerate(named):
            if by_library:
                ids = self.tokenizer.encode(texts[i].decode(), add_special_tokens=False).ids
                coded[i] = np.array([*ids, end], "<u4")
        return coded


_ENCODERS: dict[tuple[int, bool], WordEncoder] = {}


def encoder_for(vocabulary: str, names_are_text: bool) -> WordEncoder:
    """The encoder of this process, which goes on with the words that earlier tasks have learnt."""
    name = (hash(vocabulary), names_are_text)
    if name not in _ENCODERS:
        _ENCODERS.clear()  # one at a time, so that memory stays that of one memo
        _ENCODERS[name] = WordEncoder(vocabulary, names_are_text)
    return _ENCODERS[name]


# ---- files ---------------------------------------------------------------------------------------


def write(docs: DataFrame, vocabulary: str, path: str, end: int = 1, names_are_text: bool = False) -> None:
    """Write the ids of every whole text, with ``end`` after each document, below ``path``. Names of special
    tokens in a text are those tokens, as in the library, or with ``names_are_text`` ordinary text.

    Documents are dealt out by ranges of ``doc_id``, with the text's hash and the row's place behind it,
    so that rows of one id, or without one, need not meet in one task.
    """
    spark = docs.sparkSession
    words.use_batches(spark)
    tokens = spark.sparkContext.broadcast(vocabulary)

    def run(batches):
        encoder = encoder_for(tokens.value, names_are_text)
        shard, segment, before = TaskContext.get().partitionId(), 0, 0
        ids, doc_ids, starts, size = [], [], [], 0

        def flush():
            row = [[shard], [segment], [before], [size], [doc_ids], [starts], [pack(np.concatenate(ids))]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            arrays = [pa.array(v, k) for v, k in zip(row, [*kinds, pa.binary()])]
            return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in SEGMENT_SCHEMA.split(", ")])

        for whole in batches:
            for batch in words.slices(whole, "text"):
                texts = batch.column("text").cast(pa.binary()).to_pylist()
                for doc, own in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts, end)):
                    doc_ids.append(doc)
                    starts.append(size)
                    ids.append(own)
                    size += len(own)
                    if size >= SEGMENT_TOKENS:
                        yield flush()
                        segment, before = segment + 1, before + size
                        ids, doc_ids, starts, size = [], [], [], 0
        if doc_ids:
            yield flush()

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"))
    ordered = rows.repartitionByRange("doc_id", "h", "row").sortWithinPartitions("doc_id", "h", "row")
    ordered.select("doc_id", "text").mapInArrow(run, SEGMENT_SCHEMA).write.parquet(path)


def _read(spark: SparkSession, path: str, schema: str, columns_of: Callable) -> DataFrame:
    """doc_id, start, and the columns that ``columns_of`` makes of a segment's ids and where its documents begin.

    Shards are ranges in order, so a running total of one number per shard gives their starts.
    """
    segments = spark.read.parquet(path)
    shards = segments.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shard_start"))
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = Code(row["code"]).all()
                begins = np.array([*row["doc_starts"], len(ids)], dtype=np.int64)
                at = begins[:-1] + row["shard_tokens_before"]
                columns = [pa.array([row["shard"]] * len(at), pa.int32()), pa.array(row["doc_ids"], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(at), *columns_of(ids, begins)], ["shard", "doc_id", "at", *names])

    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(words.BATCH_BYTES))
    docs = segments.mapInArrow(run, f"shard int, doc_id long, at long, {schema}")
    # one row of two numbers for each task that wrote
    placed = docs.join(F.broadcast(starts), "shard")
    return placed.select("doc_id", (F.col("shard_start") + F.col("at")).alias("start"), *names)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files below ``path``: doc_id, start (ids of all documents before it), ids."""
    return _read(
        spark, path, "ids array<int>", lambda ids, begins: [words.list_of(ids.astype(np.int32), begins, pa.int32())]
    )


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files: doc_id, start, n_tokens and ids_crc32, the unsigned crc32 of the document's ids
    as little-endian unsigned 32-bit integers."""

    def columns_of(ids, begins):
        raw = memoryview(ids.astype("<u4").tobytes())
        sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins[:-1].tolist(), begins[1:].tolist())]
        return [pa.array(np.diff(begins)), pa.array(sums, pa.int64())]

    return _read(spark, path, "n_tokens long, ids_crc32 long", columns_of)


def lookup(spark: SparkSession, path: str, doc_id: int, places: list[int]) -> list[int]:
    """Single ids of one document, by random access: only its segment is read, and no block is decoded."""
    segment = (
        spark.read.parquet(path)
        .where(F.array_contains("doc_ids", doc_id))
        .select((F.array_position("doc_ids", doc_id) - 1).cast("int").alias("i"), "doc_starts", "code")
        .first()
    )
    if segment is None:
        raise KeyError(doc_id)
    return Code(segment["code"]).at(np.array(places) + segment["doc_starts"][segment["i"]]).tolist()
