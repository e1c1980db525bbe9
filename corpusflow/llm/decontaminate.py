"""Benchmark decontamination: shared word sequences seed alignments with test items.

The test items are taken in blocks of bounded size, and every block is held against
all documents once. The three-word sequences of an item are its seeds, however many
documents hold them: a limit on that would lose passages that were edited and then
copied, whose surviving sequences are far more frequent than the item's others. An item
and a document that share seeds are aligned around them by Smith-Waterman, which scores
edited copies too, unless the words there are too few to reach the score. The score is
the best local alignment's share of the item's alignment with itself.

Words are runs of letters, digits and underscores in lower case. An item of fewer than
three words has no sequence and matches nothing; an item is a candidate when a document
has two of its seeds (one, if it has only one). Null texts are empty. Rows with equal
ids are aligned one by one; other columns of the documents are kept.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm import common

GRAM = 3
MIN_SEEDS = 2
MIN_SCORE = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
#: Words of test items that are broadcast at a time.
BLOCK_WORDS = 200_000

_words = re.compile(r"\w+").findall


@dataclass
class Block:
    """Test items of one block: words as numbers, and the sorted keys of their sequences."""

    items: list
    words: dict[str, int]
    texts: list[np.ndarray]
    grams: np.ndarray
    #: per sequence: entries of ``item`` and ``place`` from ``starts[g]`` to ``starts[g + 1]``
    starts: np.ndarray
    item: np.ndarray
    place: np.ndarray


def gram_keys(ids: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of three known words in a row, and the key of each."""
    known = ids > 0
    places = np.flatnonzero(known[:-2] & known[1:-1] & known[2:])
    return places, (ids[places] * base + ids[places + 1]) * base + ids[places + 2]


def build_block(rows: list[tuple[object, str]]) -> Block:
    words: dict[str, int] = {}
    texts = [
        np.array([words.setdefault(w, len(words) + 1) for w in _words((text or "").lower())], np.int64)
        for _, text in rows
    ]
    base = len(words) + 1
    found = [gram_keys(ids, base) for ids in texts]
    keys = np.concatenate([k for _, k in found]) if found else np.zeros(0, np.int64)
    item = np.concatenate([np.full(len(k), i) for i, (_, k) in enumerate(found)] or [keys])
    place = np.concatenate([p for p, _ in found] or [keys])
    order = np.argsort(keys, kind="stable")
    grams, starts = np.unique(keys[order], return_index=True)
    return Block(
        [r[0] for r in rows],
        words,
        texts,
        grams,
        np.append(starts, len(keys)),
        item[order].astype(np.int64),
        place[order].astype(np.int64),
    )


def numbered(texts: list[str | None], words: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of texts, with GRAM - 1 zeros behind each, and where each text starts."""
    get, every, starts = words.get, [], []
    for text in texts:
        starts.append(len(every))
        every += [get(w, 0) for w in _words((text or "").lower())]
        every += [0] * (GRAM - 1)
    return np.array(every, np.int64), np.array(starts, np.int64)


def gram_hits(
    texts: list[str | None], block: Block
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers, and where texts start; then the place and number of each sequence found."""
    ids, starts = numbered(texts, block.words)
    empty = np.zeros(0, np.int64)
    if not len(block.grams) or len(ids) < GRAM:
        return ids, starts, empty, empty
    places, keys = gram_keys(ids, len(block.words) + 1)
    at = np.minimum(np.searchsorted(block.grams, keys), len(block.grams) - 1)
    hit = block.grams[at] == keys
    return ids, starts, places[hit], at[hit]


def text_of(starts: np.ndarray, places: np.ndarray) -> np.ndarray:
    return np.searchsorted(starts, places, "right") - 1


def align(long: np.ndarray, short: np.ndarray) -> int:
    """The best Smith-Waterman score of two word sequences; zero matches nothing."""
    if len(long) < len(short):
        long, short = short, long
    slope = -GAP * np.arange(1, len(long) + 1)
    row, best = np.zeros(len(long) + 1, np.int64), 0
    for word in short:
        step = np.where((long == word) & (word != 0), MATCH, MISMATCH)
        new = np.maximum(np.maximum(row[:-1] + step, row[1:] + GAP), 0)
        # a gap along the row: the best earlier cell, less its distance
        new = np.maximum.accumulate(new + slope) - slope
        row[1:] = new
        best = max(best, int(new.max(initial=0)))
    return best


def needed_seeds(block: Block) -> np.ndarray:
    """How many different seeds a document of each item has at least."""
    gram = np.repeat(np.arange(len(block.grams)), np.diff(block.starts))
    pairs = np.unique(np.stack([block.item, gram]), axis=1)
    return np.minimum(MIN_SEEDS, np.bincount(pairs[0], minlength=len(block.items)))


def matches_of(
    ids: np.ndarray, hits: list[tuple[int, int]], block: Block, need: np.ndarray, min_score: float
) -> list[dict]:
    """Items that one text holds; ``hits`` are places and numbers of its sequences."""
    by_item: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for place, gram in hits:
        for k in range(block.starts[gram], block.starts[gram + 1]):
            by_item[int(block.item[k])].append((place - int(block.place[k]), gram))
    found = []
    for item, shared in by_item.items():
        if len({gram for _, gram in shared}) < need[item]:
            continue
        words = block.texts[item]
        perfect = MATCH * len(words)
        # an alignment that reaches the score can't have longer gaps than this
        pad = int(perfect * (1 - min_score) / -GAP) + 1
        spans: list[list[int]] = []
        for offset in sorted({o for o, _ in shared}):
            low, high = max(0, offset - pad), min(offset + len(words) + pad, len(ids))
            if spans and low <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], high)
            else:
                spans.append([low, high])
        best = 0
        for low, high in spans:
            near = ids[low:high]
            # a score takes this many words of the item, wherever they stand
            if MATCH * np.count_nonzero(np.isin(near, words)) >= min_score * perfect:
                best = max(best, align(near, words))
        if best >= min_score * perfect:
            found.append({"item": block.items[item], "score": best / perfect})
    return found


def _blocks(items: DataFrame, block_words: int) -> Iterator[Block]:
    """Items in blocks of about ``block_words`` words, one block on the driver at a time."""
    total = items.agg(F.sum(F.size(F.split("text", r"\W+")))).first()[0] or 0
    count = -(-total // block_words)
    for k in range(count):
        part = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == k)
        yield build_block([(r["id"], r["text"]) for r in part.orderBy("id", "text").collect()])


def with_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    matches_col: str = "matches",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    min_score: float = MIN_SCORE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Adds ``matches_col``: an array of ``(item, score)``, sorted; empty for clean rows.

    A match holds ``min_score`` of an item's own alignment at least.
    """
    common.workers_find_package(docs.sparkSession)
    item_type = benchmark.schema[item_col].dataType
    matches = T.ArrayType(
        T.StructType().add("item", item_type).add("score", T.DoubleType())
    )
    items = benchmark.select(
        F.col(item_col).alias("id"), common.text_or_empty(item_text_col).alias("text")
    )
    (held,) = common.fresh(docs, "_matches")
    found = docs.withColumn(held, F.array().cast(matches))
    for block in _blocks(items, block_words):
        found = _matched(found, held, text_col, block, min_score)
    columns = [F.col(f"`{c}`") for c in docs.columns if c != matches_col]
    return found.select(*columns, F.sort_array(held).alias(matches_col))


def _matched(docs, held, text_col, block, min_score) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((block, needed_seeds(block)))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, need = shared.value
        for batch in batches:
            texts = batch.column(text_col).cast(pa.large_string()).to_pylist()
            ids, starts, places, grams = gram_hits(texts, block)
            hits = defaultdict(list)
            for k, place, gram in zip(text_of(starts, places).tolist(), places.tolist(), grams.tolist()):
                hits[k].append((place - int(starts[k]), gram))
            matches = batch.column(held).to_pylist()
            ends = np.append(starts[1:], len(ids)) - (GRAM - 1)
            for k, own in hits.items():
                words = ids[starts[k] : ends[k]]
                matches[k] += matches_of(words, own, block, need, min_score)
            field = batch.schema.field(held)
            at = batch.schema.get_field_index(held)
            yield batch.set_column(at, field, pa.array(matches, field.type))

    return docs.mapInArrow(match, docs.schema)
