"""SimHash near-duplicates by bit-sliced comparison.

Equal fingerprints are one node. Nodes within the radius agree in some choice of
bands of their bits, so each node goes to one bucket per choice and only buckets are
compared (exact, by the pigeonhole principle). Inside a bucket the fingerprints stand
vertically: one machine word holds one bit of 64 of them, and carry-save counters add
up 64 distances at a time. A block of 64 is dropped once all its distances exceed the
radius.

A bucket with many nodes is cut into parts of bounded size by a hash, and each pair
of parts is a task's row of its own; from each only a spanning forest of the links
goes on, which keeps all components.

Words are split at ASCII white space and A-Z is lower-cased. A text without words
(also null or empty) has fingerprint zero and is linked like any other; fewer words
than the shingle length make one shingle. Rows with equal ids are separate rows; a
null id takes part but never names a component unless all its ids are null. Other
columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import common
from corpusflow.llm.components import components

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
#: Bands beyond the radius that must agree; more of them make smaller buckets.
AGREEING_BANDS = 2
#: Nodes compared in one row.
BUCKET_PART = 1024
#: Shingle hashes unpacked into bits at a time.
HASHES_AT_ONCE = 1 << 16
#: Pairs of a fingerprint and a block of 64 compared at a time.
BLOCKS_AT_ONCE = 1 << 18


def simhash(text: bytes, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The unsigned fingerprint of UTF-8 text."""
    words = text.lower().split()  # both touch ASCII alone for bytes
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [words]
    else:
        shingles = zip(*(words[k:] for k in range(shingle_words)))
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = np.array([digest(join(s), seed) for s in shingles], dtype="<u8")
    set_bits = np.zeros(64, np.int64)
    for k in range(0, len(hashes), HASHES_AT_ONCE):
        octets = hashes[k : k + HASHES_AT_ONCE].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    ones = (2 * set_bits > len(hashes)).astype(np.uint8)
    return int(np.packbits(ones, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """``(id_col, bits)``; ``bits`` is the fingerprint as a signed long."""
    source = common.id_and_text(docs, id_col, text_col)
    id_type = source.schema["id"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [simhash(t, shingle_words, seed) for t in common.column_bytes(batch, "text")]
            signed = pa.array(np.array(bits, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("id"), signed], names=["id", "bits"])

    found = source.mapInArrow(hashed, f"id {id_type}, bits long")
    return found.select(F.col("id").alias(id_col), "bits")


def band_masks(radius: int) -> list[int]:
    """Signed masks: fingerprints within the radius agree under one of them."""
    bands = radius + AGREEING_BANDS
    edges = [round(64 * k / bands) for k in range(bands + 1)]
    band = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in itertools.pairwise(edges)]
    masks = [sum(chosen) for chosen in itertools.combinations(band, AGREEING_BANDS)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """Blocks of 64 fingerprints as 64 words each: word j holds bit j of all of them."""
    octets = prints.reshape(-1, 64).view(np.uint8).reshape(-1, 64, 8)
    bits = np.unpackbits(octets, axis=2, bitorder="little").transpose(0, 2, 1)
    packed = np.packbits(np.ascontiguousarray(bits), axis=2, bitorder="little")
    return packed.reshape(-1, 64, 8).view("<u8")[:, :, 0]


def lanes_within(
    asked: np.ndarray, planes: np.ndarray, block: np.ndarray, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """For ``asked[i]`` against block ``block[i]``: rows left and their lanes within the radius.

    The counter has one word per binary digit of the radius and one for overflow;
    adding a bit plane is a ripple of carries through those words.
    """
    digits = radius.bit_length()
    row = np.arange(len(asked))
    count = np.zeros((digits, len(asked)), np.uint64)
    over = np.zeros(len(asked), np.uint64)
    everything = np.uint64(0xFFFFFFFFFFFFFFFF)
    for bit in range(64):
        flip = np.uint64(0) - ((asked >> np.uint64(bit)) & np.uint64(1))
        carry = planes[block, bit] ^ flip
        for digit in range(digits):
            carry, count[digit] = count[digit] & carry, count[digit] ^ carry
        over |= carry
        if bit % 8 == 7:
            open_rows = np.flatnonzero(over != everything)
            if len(open_rows) < len(asked):
                asked, block, row = asked[open_rows], block[open_rows], row[open_rows]
                over, count = over[open_rows], count[:, open_rows]
    more = np.zeros(len(asked), np.uint64)  # counts above the radius without overflow
    same = np.full(len(asked), everything)
    for digit in reversed(range(digits)):
        if not radius >> digit & 1:
            more |= same & count[digit]
            same &= ~count[digit]
        else:
            same &= count[digit]
    return row, ~(over | more)


def roots(label: np.ndarray) -> np.ndarray:
    """Each place's root, following labels to the end."""
    while not np.array_equal(label, up := label[label]):
        label = up
    return label


def bucket_links(groups: list[np.ndarray], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside each group of distinct fingerprints."""
    sizes = np.array([len(g) for g in groups])
    blocks = -(-sizes // 64)
    first_block = np.cumsum(blocks) - blocks
    padded = np.zeros(int(blocks.sum()) * 64, np.uint64)
    real = np.zeros(len(padded), bool)
    for group, start in zip(groups, first_block):
        padded[start * 64 : start * 64 + len(group)] = group
        real[start * 64 : start * 64 + len(group)] = True
    planes = bit_planes(padded)
    lanes = np.packbits(real.reshape(-1, 64), axis=1, bitorder="little").view("<u8")[:, 0]
    place = np.flatnonzero(real)
    of_group = np.repeat(np.arange(len(groups)), sizes)
    width = blocks[of_group]
    query = np.repeat(place, width)
    ends = np.cumsum(width)
    block = np.arange(int(ends[-1])) - np.repeat(ends - width - first_block[of_group], width)
    label = np.arange(len(padded))
    for k in range(0, len(query), BLOCKS_AT_ONCE):
        part = slice(k, k + BLOCKS_AT_ONCE)
        row, near = lanes_within(padded[query[part]], planes, block[part], radius)
        near &= lanes[block[part][row]]
        bits = np.unpackbits(near.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        at, lane = np.nonzero(bits)
        u, v = query[part][row[at]], block[part][row[at]] * 64 + lane
        u, v = u[u < v], v[u < v]
        while len(u):  # hang the roots of both ends on the smaller root
            low = np.minimum(label[u], label[v])
            np.minimum.at(label, label[u], low)
            np.minimum.at(label, label[v], low)
            label = roots(label)
            still = label[u] != label[v]
            u, v = u[still], v[still]
    hung = np.flatnonzero(real & (label != np.arange(len(label))))
    return padded[hung], padded[label[hung]]


def links(nodes: DataFrame, radius: int = RADIUS, bucket_part: int = BUCKET_PART) -> DataFrame:
    """``(u, v)``: links between the distinct ``bits`` of ``nodes``, enough for components."""
    masks = band_masks(radius)
    keys = [
        F.struct(F.lit(k).alias("mask"), F.col("bits").bitwiseAND(F.lit(m)).alias("key"))
        for k, m in enumerate(masks)
    ]
    entries = nodes.select("bits", F.inline(F.array(*keys)))
    counts = entries.groupBy("mask", "key").count().filter("count > 1")
    parts = common.stored(
        counts.select("mask", "key", F.ceil(F.col("count") / bucket_part).cast("int").alias("parts")),
        "buckets",
    )
    part = F.pmod(F.xxhash64("bits", F.lit(1)), F.col("parts").cast("long")).cast("int")
    dealt = (
        entries.join(parts, ["mask", "key"])
        .withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        # the rows of one part meet those of each other part; a part alone meets itself
        .filter("parts = 1 or other != part")
        .groupBy(
            "mask", "key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")
        )
        .agg(F.collect_list("bits").alias("prints"))
        .filter(F.size("prints") > 1)
        .select("prints")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("prints")
            flat = prints.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            ends = np.cumsum(np.array([len(p) for p in prints]))
            if not len(ends):
                continue
            u, v = bucket_links(np.split(flat, ends[:-1]), radius)
            yield pa.RecordBatch.from_arrays(
                [pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"]
            )

    return dealt.mapInArrow(compare, "u long, v long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    bucket_part: int = BUCKET_PART,
) -> DataFrame:
    """``(id_col, bits, component_id)``: the smallest id reachable over links of the radius."""
    hashed = common.stored(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    nodes = common.stored(hashed.groupBy("bits").agg(F.min(id_col).alias("least_id")), "nodes")
    member = components(links(nodes.select("bits"), radius, bucket_part))
    grouped = nodes.join(member, nodes["bits"] == member["node"], "left").select(
        "bits", "least_id", F.coalesce("component", "bits").alias("component")
    )
    grouped = common.stored(grouped, "grouped")
    least = grouped.groupBy("component").agg(F.min("least_id").alias("component_id"))
    least = common.stored(least, "least")
    named = grouped.join(least, "component").select("bits", "component_id")
    named = common.stored(named, "named")
    return hashed.join(named, "bits").select(id_col, "bits", "component_id")


def hex_digits(bits: str = "bits") -> F.Column:
    """A signed fingerprint as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(F.col(bits)), 16, "0"))
