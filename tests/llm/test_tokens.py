"""Word hashes, byte-level BPE and token files, against the libraries and round trips."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from messy import frame, rows_of, texts, words_of
from tokenizers import Tokenizer

from fleetscope.llm import bpe, dac, queries, words

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def tokens():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def plain(tokens):
    ranks = {t: i for i, t in enumerate(tokens)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


def ids_of(encoder, text):
    return np.frombuffer(encoder.encode([text])[0], "<i4").tolist()


def test_words_have_one_hash_each():
    column = [t for _, t in texts()]
    found = words.words(pa.array(column))
    assert found.counts.tolist() == [len(words_of(t)) for t in column]
    named = {}
    for word, value in zip((w for t in column for w in words_of(t)), found.hashes.tolist()):
        assert named.setdefault(word, value) == value
    assert len(set(named.values())) == len(named)


def test_shingles_stay_within_documents():
    flat, bounds = words.shingles(words.words(pa.array(["a b c", "b c", "c", None, "a b c"])), 2)
    first, second, third, fourth, fifth = (flat[a:b].tolist() for a, b in zip(bounds, bounds[1:]))
    assert first == fifth and len(first) == 2 and second == first[1:] and len(third) == 1 and fourth == []


def test_encodes_like_the_library(tokens, plain):
    encoder = bpe.Encoder(bpe.sentencepiece_model(tokens), tokens, PATTERN)
    pieces = [" ", "  ", "\n", "\t", "\xa0", "\x1c", "\x85", "a", "B", "é", "'s", "'", "1", "12", "!", "$$", "漢", "🙂", "\r\n", "\x00"]
    rng = random.Random(5)
    for text in [t or "" for _, t in texts()] + ["".join(rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(5000)]:
        assert ids_of(encoder, text) == plain.encode_ordinary(text)


def test_cuts_long_texts_where_no_match_crosses(tokens, plain, monkeypatch):
    text = "it's a  b\n \nc " * 50 + texts()[0][1]
    assert "".join(bpe.segments(text, 40)) == text and len(list(bpe.segments(text, 40))) > 5
    monkeypatch.setattr(bpe.segments, "__defaults__", (40,))
    encoder = bpe.Encoder(bpe.sentencepiece_model(tokens), tokens, PATTERN)
    assert ids_of(encoder, text) == plain.encode_ordinary(text)


def test_forgets_without_changing_ids(tokens, plain, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 20)
    encoder = bpe.Encoder(bpe.sentencepiece_model(tokens), tokens, PATTERN)
    for _, text in texts()[:6] * 2:
        assert ids_of(encoder, text) == plain.encode_ordinary(text)
    assert len(encoder.pieces) < 1000


def test_encodes_and_decodes_a_messy_table(spark, tokens, plain):
    docs = frame(spark)
    coded = bpe.decode(bpe.encode(docs, tokens, PATTERN), tokens)
    assert set(coded.columns) == {*docs.columns, "decoded"}
    expected = [(d, plain.encode_ordinary(t or ""), (t or "").encode()) for d, t in texts()]
    got = [(r["doc_id"], r["ids"], bytes(r["decoded"])) for r in coded.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert bpe.decode(bpe.encode(docs.limit(0), tokens, PATTERN), tokens).count() == 0


@pytest.mark.parametrize("ids", [[], [0], [255, 256, 65_535, 65_536, 2**32 - 1], list(range(0, 300_000, 7))])
def test_code_gives_any_id_directly(ids):
    ids = np.array(ids, dtype=np.uint32)
    code = dac.Code(dac.pack(ids))
    assert code.all().tolist() == ids.tolist()
    places = np.random.default_rng(1).permutation(len(ids))[:5000]
    assert code.at(places).tolist() == ids[places].tolist()


def test_token_files_of_a_messy_table(spark, vocabulary, tmp_path, monkeypatch):
    monkeypatch.setattr(dac, "SEGMENT_TOKENS", 500)
    path = str(tmp_path / "files")
    dac.write(frame(spark), vocabulary, path)
    library = Tokenizer.from_str(vocabulary)
    library.encode_special_tokens = True
    coded = lambda t: [*library.encode(t or "", add_special_tokens=False).ids, 1]
    got = sorted(dac.read(spark, path).collect(), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    assert [r["start"] for r in got] == np.cumsum([0, *(len(r["ids"]) for r in got)])[:-1].tolist()
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=repr) == sorted(((d, coded(t)) for d, t in texts()), key=repr)
    long = coded(dict(texts())[11])
    assert dac.lookup(spark, path, 11, [0, 77, len(long) - 1]) == [long[0], long[77], 1]
    with pytest.raises(KeyError):
        dac.lookup(spark, path, 999, [0])


def test_token_files_of_an_empty_table(spark, vocabulary, tmp_path):
    path = str(tmp_path / "none")
    dac.write(frame(spark, []), vocabulary, path)
    assert dac.read(spark, path).collect() == []


def test_queries_digest_what_the_files_hold(spark, sf_dir, vocabulary):
    library = Tokenizer.from_str(vocabulary)
    library.encode_special_tokens = True
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    start, expected = 0, []
    for row in docs:
        ids = np.array([*library.encode(row["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        expected.append((row["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = queries.registered()["op2_token_files"](spark, sf_dir)
    assert rows_of(got, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(expected, key=repr)


def test_words_are_encoded_like_whole_texts(vocabulary, monkeypatch):
    monkeypatch.setattr(dac, "MEMO_ENTRIES", 500)
    library = Tokenizer.from_str(vocabulary)
    library.encode_special_tokens = True
    pieces = ["É", "ÀÇ", "İ", "ß", "ſ", "Σ", "e\u0301", "\xa0", "\x1c", "\x85", "don't", "'S", "12", "²", "x", "!", "漢", "🙂", "<|endoftext|>", " ", "\n", "\x00"]
    rng = random.Random(6)
    column = [t or "" for _, t in texts()] + ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(5000)]
    encoder = dac.WordEncoder(vocabulary)
    got = [ids.tolist() for i in range(0, len(column), 50) for ids in encoder.encode([t.encode() for t in column[i : i + 50]], 1)]
    assert got == [[*e.ids, 1] for e in library.encode_batch(column, add_special_tokens=False)]


def test_names_of_special_tokens_are_tokens_as_in_the_library(spark, vocabulary, tmp_path):
    rows = [(1, "a <|endoftext|> b"), (2, "x<|startoftext|><|endoftext|>É  y"), (3, "<|EndOfText|> <|endoftext |>"), (4, "a b")]
    library = Tokenizer.from_str(vocabulary)
    for names_are_text in (False, True):
        library.encode_special_tokens = names_are_text
        path = str(tmp_path / f"{names_are_text}")
        dac.write(frame(spark, rows), vocabulary, path, **({"names_are_text": True} if names_are_text else {}))
        got = dict(rows_of(dac.read(spark, path), "doc_id", "ids"))
        assert got == {d: [*library.encode(t, add_special_tokens=False).ids, 1] for d, t in rows}
