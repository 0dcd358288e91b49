"""Packing against the tokenizer itself and a plain concatenation."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from sparkrank.llm import packing
from sparkrank.llm.queries import QUERIES, TOKENIZER


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


def whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def check(rows, docs, tokenizer, size):
    """``rows``: doc_id, start, length, ids crc, doc_tokens, sequence_id, offset."""
    texts = defaultdict(list)
    for doc_id, text in docs:
        texts[doc_id].append(whole(tokenizer, text))
    sequences, pieces = defaultdict(list), defaultdict(list)
    for doc_id, start, length, crc, total, sequence, offset in rows:
        candidates = [ids for ids in texts[doc_id] if len(ids) == total]
        part = np.array(candidates[0][start : start + length], "<u4")
        assert len(part) == length > 0 and zlib.crc32(part.tobytes()) == crc
        sequences[sequence].append((offset, length))
        pieces[doc_id].append((start, length))
    for doc_id, lists in texts.items():
        covered = sorted(x for start, length in pieces[doc_id] for x in range(start, start + length))
        assert covered == sorted(x for ids in lists for x in range(len(ids)))
    assert sorted(sequences) == list(range(len(sequences)))
    for number, parts in sequences.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == size or number == len(sequences) - 1


def test_query(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    check([tuple(r) for r in QUERIES["op1_packing"](spark, sf_dir).collect()], docs, tokenizer, 4096)


def test_odd_rows(odd_docs, tokenizer):
    pieces = packing.pack(odd_docs.repartition(3), TOKENIZER, size=64)
    rows = [(r.doc_id, r.start, r.length, zlib.crc32(r.ids), r.doc_tokens, r.sequence_id, r.offset) for r in pieces.collect()]
    check(rows, [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()], tokenizer, 64)


def test_no_rows(no_docs):
    assert packing.pack(no_docs, TOKENIZER).count() == 0


def test_chunks_equal_whole_texts(tokenizer):
    encoder = packing.ChunkEncoder(TOKENIZER)
    for text in ["(a) Éa's!! x-y ... 12,5 ß_ß", "l'été ñandú ÿ Ÿ ǅ ﬁ \x1c\x85 a", "'s 't 're'VE don’t __a__"]:
        for _ in range(2):
            ids = np.frombuffer(encoder.encode(text.encode()), "<u4").tolist()
            assert ids == whole(tokenizer, text)[:-1]


def test_sequences_are_padded(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = packing.pack(docs, TOKENIZER, size=512)
    rows = packing.sequences(pieces, size=512).collect()
    assert all(len(r.ids) == 4 * 512 for r in rows)
    assert sum(r.length < 512 for r in rows) <= 1


def test_special_tokens_as_the_plain_call_gives_them(tokenizer):
    encode = packing.ChunkEncoder(TOKENIZER).encode
    for text in ("a<|endoftext|>b", "<|endoftext|>", "x <|startoftext|>y<|ENDOFTEXT|> z", "<|endoftext|"):
        assert np.frombuffer(encode(text.encode()), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encode(b"a<|endoftext|>b"), "<u4").tolist() == [320, 49407, 321]
