import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_rows import odd  # noqa: F401

from passagemill.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [1, 31, 32, 5000, tokens.BLOCK_TOKENS, 2 * tokens.BLOCK_TOKENS + 7])
def test_rans_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 40_000).astype(np.int64)
    frequency = tokens.scaled(np.bincount(ids))
    assert frequency.sum() == 1 << tokens.BITS and (frequency[np.unique(ids)] > 0).all()
    blocks = tokens.encode(ids, frequency)
    assert (tokens.decode(blocks, frequency) == ids).all()
    if n > 5000:
        p = np.bincount(ids) / n
        entropy = -(p[p > 0] * np.log2(p[p > 0])).sum()
        # the last block is filled up to its end
        assert sum(len(b["words"]) for b in blocks) * 8 < len(blocks) * tokens.BLOCK_TOKENS * (entropy + 0.15)
        # any part decodes alone from its checkpoint: the first block without the others
        assert (tokens.decode(blocks[:1], frequency) == ids[: tokens.BLOCK_TOKENS]).all()
        blocks[0]["words"] = b"\1" + blocks[0]["words"][1:]
        with pytest.raises(ValueError, match="checksum"):
            tokens.decode(blocks, frequency)


def test_scaled_tables():
    for counts in ([1], [1, 0, 5], [1] * 1000, [10**12] + [1] * 5000, list(range(3000))):
        f = tokens.scaled(np.array(counts))
        assert f.sum() == 1 << tokens.BITS and ((f > 0) == (np.array(counts) > 0)).all()


def test_words_are_cut_as_in_whole_texts():
    texts = ["Hello, World. naïve Ünïcödé ﬁne it's 3.14 ét́ İstanbul ǅ", "<|endoftext|>a <|startoftext|>, ...", "漢字\x85かな \xa0x  ", "á ́a ' 's x.y,z", ""]
    tokenizer = Tokenizer.from_file(PATH)
    encoder = tokens.Encoder(open(PATH, encoding="utf-8").read())
    for _ in range(2):
        got = [np.frombuffer(x, encoder.kind).tolist() for x in encoder.encode([t.encode() for t in texts], 2)]
        assert got == [tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]


def _check(spark, docs, rows, path, frame_tokens):
    tokens.write_corpus(docs, path, PATH, frame_tokens=frame_tokens)
    back = tokens.read_corpus(spark, path).collect()
    tokenizer = Tokenizer.from_file(PATH)
    want = [(r.doc_id, tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]) for r in rows]
    want.sort(key=lambda x: (x[0] is not None, x[0] or 0))
    back.sort(key=lambda r: r.start)
    assert [r.doc_id for r in back] == [d for d, _ in want]
    at = 0
    for r, (d, ids) in zip(back, want):
        assert r.start == at and r.n_tokens == len(np.frombuffer(r.ids, "<u4"))
        at += r.n_tokens
    both = [sorted((str(d), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in want), sorted((str(r.doc_id), zlib.crc32(r.ids)) for r in back)]
    assert both[0] == both[1]


@pytest.mark.parametrize("frame_tokens", [tokens.FRAME_TOKENS, 3000])
def test_corpus_round_trip(spark, sf, tmp_path, frame_tokens):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    _check(spark, docs, docs.collect(), str(tmp_path / "c"), frame_tokens)


def test_awkward_rows(spark, odd, tmp_path):
    docs = odd("ids")
    _check(spark, docs, docs.collect(), str(tmp_path / "c"), 1000)
    tokens.write_corpus(odd("ids", rows=[]), str(tmp_path / "none"), PATH)
    assert tokens.read_corpus(spark, str(tmp_path / "none")).count() == 0


def test_random_strings_get_the_librarys_ids():
    """Marks, odd spaces, special tokens, letters of many scripts, in any order; with memories that turn over all the time."""
    import random

    from tokenizers import Tokenizer

    rng, content = random.Random(7), open(PATH, encoding="utf-8").read()
    whole, encoder = Tokenizer.from_str(content), tokens.Encoder(content)
    for memory in (encoder.words, encoder.stems):
        memory.most = 50
    pieces = [
        *"abcXYZéÉßøÿ×÷Ā漢字ع", *".,;:!?'\"-_/\\#*$%&|<>()[]{}0123456789", " ", "  ", "\t", "\n", "\r", "\x0b", "\x0c", "\x1c", "\x85", "\xa0", " ", "　",
        "'s", "'ll", "don't", "<|startoftext|>", "<|endoftext|>", "</w>", "the", "The,", "end.", "ﬁ", "é", "‍", "\U0001f600", "\x00", "﻿",
    ]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(30))) for _ in range(4000)]
    kind = np.dtype(tokens.id_type(whole))
    for at in range(0, len(texts), 100):
        part = texts[at : at + 100]
        got = [np.frombuffer(x, kind).tolist() for x in encoder.encode([t.encode() for t in part], tokens.END_ID)]
        assert got == [whole.encode(t, add_special_tokens=False).ids + [tokens.END_ID] for t in part]
