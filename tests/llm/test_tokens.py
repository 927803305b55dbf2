"""Batch tokenization against the libraries themselves."""

from __future__ import annotations

import random
from pathlib import Path

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from samples import awkward_texts
from tokenizers import Tokenizer

from martflow.llm.tokens import json_encoder, ranks_encoder

ALPHABET = [
    *["'", "s", "t", "re", "ll", "'ve", "'d", " ", "  ", "\n", "\t", "　", "\xa0", " ", "\x85", "\x1c"],
    *["a", "é", "ß", "日本", "ा", "́", "1", "²", "½", "Ⅷ", "٣", "!", "-", "_", "​", "\U0001f600", "<|endoftext|>"],
]


def read(name: str) -> bytes:
    return Path(public_tokenizers.path(name)).read_bytes()


@pytest.fixture(scope="module")
def wanted():
    tokenizer = Tokenizer.from_buffer(read("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoders():
    ranks = ranks_encoder(read("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return json_encoder(read("byte_bpe_50k.json")), ranks


def check(encoder, texts, wanted):
    ids, bounds = encoder.ids(pa.array(texts, type=pa.string()))
    for k, text in enumerate(texts):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == wanted(text), text
    assert encoder.counts(pa.array(texts, type=pa.string())).tolist() == [len(wanted(t)) for t in texts]


def test_awkward_and_random_texts(encoders, wanted):
    pick = random.Random(3)
    texts = awkward_texts() + ["".join(pick.choice(ALPHABET) for _ in range(pick.randint(1, 14))) for _ in range(3000)]
    for encoder in encoders:
        check(encoder, texts, wanted)


def test_documents(encoders, wanted, sf_dir):
    texts = pq.read_table(f"{sf_dir}/documents.parquet", columns=["text"]).column("text").to_pylist()
    for encoder in encoders:
        check(encoder, texts, wanted)
