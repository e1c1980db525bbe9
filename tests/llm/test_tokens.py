"""Token files and token counts."""

import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import ODD_TEXTS
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpusflow.llm import token_counts, token_store

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def few_words():
    return token_store.Words(WORDS, known_words=5)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [1]


@settings(max_examples=200)
@given(st.lists(st.integers(0, 5), max_size=300), st.integers(2, 5))
def test_grammar_round_trip(ids, least):
    ids = np.array(ids, np.int64)
    first, rules, symbols = token_store.compress(ids, min_share=0, min_count=least)
    assert token_store.expand(symbols, first, rules).tolist() == ids.tolist()
    assert len(symbols) <= len(ids)
    lengths = token_store.rule_lengths(first, rules)
    for k, length in enumerate(lengths):
        assert len(token_store.expand(np.array([first + k]), first, rules)) == length
    bound = first + len(rules)
    pairs = symbols[:-1] * bound + symbols[1:]
    assert len(pairs) == 0 or np.unique(pairs, return_counts=True)[1].max() < max(least, len(ids))


def test_frequent_pairs_shrink_a_repetitive_sequence():
    ids = np.array([1, 2, 3, 4] * 5000 + [7] * 5000, np.int64)
    first, rules, symbols = token_store.compress(ids)
    assert len(symbols) + 2 * len(rules) < len(ids) / 50
    assert token_store.expand(symbols, first, rules).tolist() == ids.tolist()


@settings(max_examples=100)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=200), st.data())
def test_any_range(ids, data):
    first, rules, symbols = token_store.compress(np.array(ids), min_share=0, min_count=2)
    shard = {
        "first_rule": first,
        "rules": rules.astype("<i4").tobytes(),
        "symbols": symbols.astype("<i4").tobytes(),
        "rule_lengths": token_store.rule_lengths(first, rules).astype("<i8").tobytes(),
    }
    start = data.draw(st.integers(0, len(ids) - 1))
    count = data.draw(st.integers(1, len(ids) - start))
    assert token_store.read_range(shard, start, count).tolist() == ids[start : start + count]


@settings(max_examples=100)
@given(st.lists(st.text(max_size=60), max_size=8))
def test_words_encode_as_texts_do(library, few_words, texts):
    texts.append("<|endoftext|>x <|startoftext|> IT'S Ünïcode İ é")
    found = token_store.encode_texts(few_words, pa.array(texts), end_id=1)
    assert [f.tolist() for f in found] == [ids_of(library, t) for t in texts]
    found = token_store.encode_texts(few_words, pa.array(texts))
    assert [f.tolist() + [1] for f in found] == [ids_of(library, t) for t in texts]


def test_each_run_of_letters_is_encoded_once(library):
    words = token_store.Words(WORDS)
    texts = ["Tree, tree. (TREE) tree!", "été tree2024; Été... ÉTÉ", "tree's İtree"]
    found = token_store.encode_texts(words, pa.array(texts), end_id=1)
    assert [f.tolist() for f in found] == [ids_of(library, t) for t in texts]
    parts = ["tree", ",", ".", "(", ")", "!", "été", "2", "0", "4", ";", "...", "tree's", "İtree"]
    assert sorted(words.newer) == sorted(parts)


def test_every_character_is_cut_as_the_library_does(library):
    words = token_store.Words(WORDS)
    odd = [0x1E9E, 0x2019, 0x2028, 0x212A, 0x3000, 0x4E00, 0xAC00, 0xF900, 0xFB01, 0x1D400, 0x1F600]
    marks = ["\u0301", "'s", "'S", "|>", "<|endoftext|>", "7", "-"]
    for code in [*range(0x900), *odd]:
        c = chr(code)
        text = f"aB{c}Cd {c} x{c} {c}y{c}{c} " + " ".join(f"{c}{m} {m}{c}" for m in marks)
        found = token_store.encode_texts(words, pa.array([text, c]), end_id=1)
        assert [f.tolist() for f in found] == [ids_of(library, text), ids_of(library, c)], code


@pytest.mark.parametrize("texts", [[""], ["", " \n"], ["a", "b", "", "é1", "1", "", " c", "d "]])
def test_parts_end_with_their_text(library, few_words, texts):
    for some in (pa.array(texts), pa.array(["x y", *texts, "z"]).slice(1, len(texts))):
        found = token_store.encode_texts(few_words, some, end_id=1)
        assert [f.tolist() for f in found] == [ids_of(library, t) for t in texts]


def test_words_stay_whole_for_other_tokenizers(tmp_path):
    other = Tokenizer.from_file(WORDS)
    other.normalizer = None
    path = str(tmp_path / "other.json")
    other.save(path)
    words = token_store.Words(path)
    texts = ["Tree, tree. É1é", "日本語 x"]
    found = token_store.encode_texts(words, pa.array(texts))
    assert [f.tolist() for f in found] == [
        [i for w in t.split() for i in other.encode(w, add_special_tokens=False).ids] for t in texts
    ]
    assert sorted(words.newer) == sorted("Tree, tree. É1é 日本語 x".split())


def test_words_that_recur_stay_known(few_words):
    few_words.newer, few_words.older = {}, {}
    for turn in range(50):
        few_words.ids(["often", f"once{turn}", f"twice{turn // 2}"])
        assert "often" in few_words.newer
        assert len(few_words.newer) + len(few_words.older) <= 2 * (few_words.limit + 3)


def test_slices_hold_every_row(monkeypatch):
    monkeypatch.setattr(token_store, "TEXT_BYTES", 10)
    texts = ["", "x" * 30, "a b", "c d e", "", "f" * 9, "g"]
    batch = pa.record_batch({"text": texts})
    slices = [s.column("text").to_pylist() for s in token_store._some_texts(batch)]
    assert slices == [["", "x" * 30], ["a b", "c d e", ""], ["f" * 9, "g"]]


@settings(max_examples=100)
@given(st.lists(st.integers(0, 30), min_size=2, max_size=400))
def test_frequent_pairs_are_exact(numbers):
    keys = np.array(numbers, np.int64)
    places, rank, found = token_store.frequent_pairs(keys, 2)
    counts = {k: numbers.count(k) for k in set(numbers)}
    assert all(counts[k] >= 2 for k in found.tolist())
    assert bool(len(found)) == (max(counts.values()) >= 2)
    assert keys[places].tolist() == found[rank].tolist()
    assert len(places) == sum(counts[k] for k in found.tolist())
    assert [counts[k] for k in found.tolist()] == sorted((counts[k] for k in found.tolist()), reverse=True)


def test_no_pair_is_left_when_rounds_go_to_the_end():
    ids = np.random.default_rng(3).zipf(1.3, 20000).clip(max=500).astype(np.int64)
    first, rules, symbols = token_store.compress(ids, min_share=0, min_count=2, min_gain=0)
    bound = first + len(rules)
    pairs, counts = np.unique(symbols[:-1] * bound + symbols[1:], return_counts=True)
    alike = pairs // bound == pairs % bound  # a run of three holds its pair twice
    assert counts[~alike].max(initial=0) < 2
    assert token_store.expand(symbols, first, rules).tolist() == ids.tolist()


@pytest.mark.parametrize("shard_tokens", [1, 40, 1 << 20])
def test_files(spark, odd, library, tmp_path, shard_tokens):
    path = str(tmp_path / "tokens")
    token_store.write_tokens(odd, path, WORDS, shard_tokens=shard_tokens)
    found = token_store.with_crc(token_store.read_tokens(spark, path)).orderBy("start").collect()
    first = sorted(ODD_TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    start, expected = 0, []
    for doc, text in first:
        ids = ids_of(library, text)
        expected.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in found] == expected


def test_no_files(spark, none, tmp_path):
    token_store.write_tokens(none, str(tmp_path / "t"), WORDS)
    assert token_store.read_tokens(spark, str(tmp_path / "t")).count() == 0


def greedy(tokens, word):
    count = 0
    while word:
        size = next((k for k in range(len(word), 0, -1) if word[:k] in tokens), 0)
        if not size:
            return 1
        word, count = word[size:], count + 1
    return count


@settings(max_examples=300)
@given(
    st.sets(st.text("abc", min_size=1, max_size=5).map(str.encode), max_size=12),
    st.lists(st.text("abc", max_size=12).map(str.encode), max_size=20),
)
def test_automaton_is_greedy_longest_match(tokens, words):
    automaton = token_counts.build(sorted(tokens))
    assert [automaton.pieces(w) for w in words] == [greedy(tokens, w) for w in words]


def test_token_counts(spark, odd, none):
    tokens = set(token_counts.read_tokens(Path(RANKS).read_bytes()))
    assert token_counts.count_tokens(none, RANKS).count() == 0
    expected = []
    for doc, text in ODD_TEXTS:
        counts = [greedy(tokens, b" " + w) for w in (text or "").encode().split()]
        expected.append((doc, len(counts), sum(counts), max(counts, default=0)))
    found = [tuple(r) for r in token_counts.count_tokens(odd, RANKS).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
