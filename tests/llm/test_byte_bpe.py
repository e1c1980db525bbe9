import base64

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given
from hypothesis import strategies as st
from cases import ODD_TEXTS

from corpusflow.llm import byte_bpe, common

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    lines = common.vocabulary_bytes(PATH).splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids_as_the_library_and_back(odd, reference):
    found = byte_bpe.decode(byte_bpe.encode(odd, PATH, PATTERN, block_chars=100), PATH).collect()
    expected = [
        (i, reference.encode_ordinary(t or ""), (t or "").encode()) for i, t in ODD_TEXTS
    ]
    order = repr
    got = [(r["doc_id"], list(r["ids"]), bytes(r["decoded"])) for r in found]
    assert sorted(got, key=order) == sorted(expected, key=order)


def test_no_documents(none):
    assert byte_bpe.decode(byte_bpe.encode(none, PATH, PATTERN), PATH).count() == 0


def test_only_empty_documents(spark):
    docs = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert [r["ids"] for r in byte_bpe.encode(docs, PATH, PATTERN).collect()] == [[], []]


def test_blocks_are_not_shuffled(odd, plan):
    text = plan(byte_bpe.encode(odd, PATH, PATTERN))
    assert "Bucketed: true" in text


@given(st.lists(st.integers(0, 2**32 - 1)))
def test_packed_numbers(numbers):
    assert byte_bpe.unpacked(byte_bpe.packed(np.array(numbers, np.int64))).tolist() == numbers


@given(st.lists(st.binary()))
def test_packed_byte_strings(parts):
    packet = byte_bpe.from_packet(byte_bpe.as_packet(**byte_bpe.lists(parts)))
    assert byte_bpe.parts_of(packet) == parts
