"""Greedy word-piece counts by a linear longest-match automaton.

The vocabulary is a trie over bytes. A node's failure link leads to where matching goes
on when the node has no child for the next byte; the pieces that are finished on the way
are known beforehand, so the node keeps their number only. A word is read once from left
to right, and no piece is ever built.

A word is a run without ASCII white space, with the vocabulary's word-start mark in
front. A word that the vocabulary can't cover counts as one unknown piece. Null and
empty texts have no words. Repeated rows are counted one by one, null ids are kept, and
other columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusflow.llm import common

#: Words whose counts a task keeps at hand.
KNOWN_WORDS = 400_000


@dataclass
class Automaton:
    """Children by ``node * 256 + byte``; failure links (-1: none) and popped pieces by node."""

    children: dict[int, int]
    fail: list[int]
    popped: list[int]

    def pieces(self, word: bytes) -> int:
        """The number of greedy pieces of a word; 1 if it can't be covered, 0 if empty."""
        children, fail, popped = self.children, self.fail, self.popped
        node, count = 0, 0
        for byte in word:
            child = children.get(node * 256 + byte)
            while child is None:
                count += popped[node]
                node = fail[node]
                if node < 0:
                    return 1
                child = children.get(node * 256 + byte)
            node = child
        while node:
            count += popped[node]
            node = fail[node]
            if node < 0:
                return 1
        return count


def build(tokens: Iterable[bytes]) -> Automaton:
    """The automaton of a vocabulary, level by level of its trie."""
    children: dict[int, int] = {}
    parent, last, whole = [-1], [0], [False]
    for token in tokens:
        node = 0
        for byte in token:
            key = node * 256 + byte
            if key not in children:
                children[key] = len(parent)
                parent.append(node)
                last.append(byte)
                whole.append(False)
            node = children[key]
        whole[node] = node > 0
    depth = np.zeros(len(parent), np.int64)
    for node in range(1, len(parent)):  # a parent always comes first
        depth[node] = depth[parent[node]] + 1
    fail, popped = [-1] * len(parent), [0] * len(parent)
    for node in np.argsort(depth, kind="stable").tolist()[1:]:
        if whole[node]:  # the piece ends here, and matching starts anew
            fail[node], popped[node] = 0, 1
            continue
        up = parent[node]
        at, count = fail[up], popped[up]
        while at >= 0 and at * 256 + last[node] not in children:
            count += popped[at]
            at = fail[at]
        if at >= 0:
            fail[node], popped[node] = children[at * 256 + last[node]], count
    return Automaton(children, fail, popped)


def read_tokens(data: bytes) -> list[bytes]:
    """The token bytes of a rank file."""
    return [base64.b64decode(line.split()[0]) for line in data.splitlines()]


def count_tokens(
    docs: DataFrame,
    vocabulary_path: str,
    word_start: bytes = b" ",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id_col, n_words, n_tokens, longest_word)`` of every row.

    ``longest_word`` is the largest number of pieces of a word. The automaton goes to
    every executor; its size follows the vocabulary file, whose size is checked.
    """
    automaton = build(read_tokens(common.vocabulary_bytes(vocabulary_path)))
    shared = docs.sparkSession.sparkContext.broadcast(automaton)
    source = common.id_and_text(docs, id_col, text_col)
    id_type = source.schema["id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, known = shared.value.pieces, {}
        for batch in batches:
            rows = []
            for text in common.column_bytes(batch, "text"):
                if len(known) > KNOWN_WORDS:
                    known = {}
                words = text.split()
                for word in set(words):
                    if word not in known:
                        known[word] = pieces(word_start + word)
                counts = [known[word] for word in words]
                rows.append((len(words), sum(counts), max(counts, default=0)))
            numbers = np.array(rows, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(numbers[:, k]) for k in range(3))],
                names=["id", "n_words", "n_tokens", "longest_word"],
            )

    schema = f"id {id_type}, n_words long, n_tokens long, longest_word long"
    return source.mapInArrow(count, schema).withColumnRenamed("id", id_col)
