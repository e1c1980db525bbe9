"""Byte-level BPE: each distinct word of the corpus is encoded once.

1. Text is cut into pre-tokens block by block. A block keeps its documents as
   numbers into the block's own word list, and sends out each of its words once
   with its slot (block, number): the positions of a word are combined before
   anything is shuffled.
2. The words of all blocks are shuffled by a hash of the word, packed as one row for
   each block and bucket. Equal words meet in a bucket, and a word is merged into ids
   when it is first seen there.
3. The ids go back to their block, where the documents are put together by
   position. The blocks were written as a table bucketed by block, so only the ids
   move for this join.

Decoding joins the table of token bytes, which has a fixed size.

Rows with equal ids or texts are encoded one by one; a null text is empty and gives
no ids; a null document id is kept. Other columns are not read.
"""

from __future__ import annotations

import base64
import itertools
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import common
from corpusflow.sources.scratch import scratch_path

#: Characters of text whose words are numbered together; bounds a task's memory.
BLOCK_CHARS = 12 << 20
#: Words of documents in one packet.
PACKET_WORDS = 1 << 18
#: A partition may have this many blocks.
BLOCKS_PER_PARTITION = 1 << 20
#: Words of a bucket that are kept with their ids; beyond it they are merged again.
KNOWN_WORDS = 500_000


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}


def packed(codes: np.ndarray) -> bytes:
    """Numbers below 2**32, seven bits a byte."""
    codes = codes.astype(np.uint64)
    groups = np.stack([(codes >> (7 * k)) & 127 for k in range(5)], axis=1).astype(np.uint8)
    more = np.stack([codes >= (1 << (7 * (k + 1))) for k in range(4)], axis=1)
    groups[:, :4] |= more.astype(np.uint8) << 7
    used = np.concatenate([np.ones((len(codes), 1), dtype=bool), more], axis=1)
    return groups[used].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    """The inverse of ``packed``."""
    raw = np.frombuffer(data, np.uint8)
    last = np.flatnonzero(raw < 128)
    if not len(last):
        return np.zeros(0, np.int64)
    first = np.concatenate([[0], last[:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(first, last - first + 1)
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), first)


def as_packet(**columns) -> bytes:
    """Columns as one compressed binary."""
    batch = pa.record_batch(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(
        sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")
    ) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_packet(data: bytes) -> pa.Table:
    with pa.ipc.open_stream(data) as stream:
        return stream.read_all()


def numbered(numbers) -> dict[str, pa.Array]:
    """Ascending numbers as a packet's column."""
    return {"steps": pa.array([packed(np.diff(np.array(numbers), prepend=0))])}


def lists(parts: list[bytes]) -> dict[str, pa.Array]:
    """Byte strings as columns of a packet."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return {"sizes": pa.array([packed(sizes)]), "bytes": pa.array([b"".join(parts)])}


def runs(parts: list) -> dict[str, pa.Array]:
    """Lists of numbers as columns of a packet."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    every = np.fromiter(itertools.chain.from_iterable(parts), np.int64, int(sizes.sum()))
    return {"sizes": pa.array([packed(sizes)]), "numbers": pa.array([packed(every)])}


def runs_of(packet: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The lengths of a packet's lists, and all their numbers."""
    return unpacked(packet.column("sizes")[0].as_py()), unpacked(packet.column("numbers")[0].as_py())


def numbers_of(packet: pa.Table) -> np.ndarray:
    return np.cumsum(unpacked(packet.column("steps")[0].as_py()))


def parts_of(packet: pa.Table) -> list[bytes]:
    data = packet.column("bytes")[0].as_py()
    ends = np.cumsum(unpacked(packet.column("sizes")[0].as_py())).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


class _Block:
    """Documents under way and the numbers of their words."""

    def __init__(self, block: int, id_type: pa.DataType):
        self.block, self.id_type = block, id_type
        self.numbers: dict[str, int] = {}
        self.ids: list = []
        self.codes: list[np.ndarray] = []
        self.chars = 0

    def add(self, key, text: str, words: list[str]) -> None:
        numbers, number = self.numbers, self.numbers.setdefault
        self.codes.append(np.array([number(w, len(numbers)) for w in words], np.int32))
        self.ids.append(key)
        self.chars += len(text)

    def rows(self, buckets: int) -> Iterator[pa.RecordBatch]:
        """Packets of documents, then a packet of words for each bucket."""
        counts = np.zeros(len(self.numbers), np.int64)
        for codes in self.codes:
            np.add.at(counts, codes, 1)
        rank = np.empty(len(counts), np.int32)  # small numbers for frequent words
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts), dtype=np.int32)
        start, words = 0, 0
        for k, codes in enumerate(self.codes):
            words += len(codes)
            if words >= PACKET_WORDS or k == len(self.codes) - 1:
                codes = self.codes[start : k + 1]
                sizes = packed(np.array([len(c) for c in codes]))
                packet = as_packet(
                    ids=pa.array([self.ids[start : k + 1]], pa.list_(self.id_type)),
                    sizes=pa.array([sizes]),
                    numbers=pa.array([packed(rank[np.concatenate(codes)])]),
                )
                yield self._row(None, packet)
                start, words = k + 1, 0
        words, dealt = list(self.numbers), {}
        for at in np.argsort(rank).tolist():
            data = words[at].encode()
            dealt.setdefault(zlib.crc32(data) % buckets, []).append((data, int(rank[at])))
        for bucket, entries in dealt.items():
            held, numbers = zip(*entries)
            yield self._row(bucket, as_packet(**numbered(numbers), **lists(held)))

    def _row(self, bucket: int | None, packet: bytes) -> pa.RecordBatch:
        columns = ((self.block, pa.int64()), (bucket, pa.int32()), (packet, pa.binary()))
        return pa.RecordBatch.from_arrays(
            [pa.array([value], kind) for value, kind in columns], names=["block", "bucket", "data"]
        )


def blocks(docs: DataFrame, pattern: str, block_chars: int, buckets: int) -> DataFrame:
    """Packets of documents (their word numbers; no bucket), and of a block's words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = regex.compile(pattern).findall
        number = TaskContext.get().partitionId() * BLOCKS_PER_PARTITION
        block = None
        for batch in batches:
            block = block or _Block(number, batch.schema.field("id").type)
            ids, texts = batch.column("id"), batch.column("text")
            for k in range(len(ids)):
                text = texts[k].as_py()
                if block.ids and block.chars + len(text) > block_chars:
                    yield from block.rows(buckets)
                    block = _Block(block.block + 1, block.id_type)
                block.add(ids[k].as_py(), text, split(text))
        if block:
            yield from block.rows(buckets)

    return docs.mapInArrow(cut, "block long, bucket int, data binary")


def merge_words(packets: DataFrame, ranks_data, pattern: str) -> DataFrame:
    """Packets of words to packets of ids; needs the rows of a bucket side by side."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=read_ranks(ranks_data.value), special_tokens={}
        )
        bucket, known = None, {}
        for batch in batches:
            out = []
            for at, data in zip(batch.column("bucket").to_pylist(), batch.column("data").to_pylist()):
                if at != bucket or len(known) > KNOWN_WORDS:
                    bucket, known = at, {}
                packet = from_packet(data)
                words = parts_of(packet)
                for word in words:
                    if word not in known:
                        known[word] = coder._encode_single_piece(word)
                ids = runs([known[word] for word in words])
                out.append(as_packet(steps=packet.column("steps").combine_chunks(), **ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), pa.array(out, pa.binary())], names=["block", "data"]
            )

    return packets.mapInArrow(merge, "block long, data binary")


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of ``lengths[i]`` consecutive places from each ``starts[i]``."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def joined_block(docs: pa.Table, packets: pa.Table) -> pa.Table:
    """The ids of a block's documents, in the order of their words; a batch per packet."""
    tables = [from_packet(data) for data in packets.column("data").to_pylist()]
    numbers = [numbers_of(one) for one in tables]
    count = sum(map(len, numbers))
    lengths, firsts = np.zeros(count, np.int64), np.zeros(count, np.int64)
    held, total = [], 0
    for one, number in zip(tables, numbers):
        sizes, ids = runs_of(one)
        lengths[number], firsts[number] = sizes, total + np.cumsum(sizes) - sizes
        held.append(ids.astype(np.int32))
        total += len(ids)
    flat = np.concatenate([np.zeros(0, np.int32), *held])
    batches = []
    for data in docs.column("data").to_pylist():
        packet = from_packet(data)
        sizes, codes = runs_of(packet)
        wide = lengths[codes]
        values = flat[ragged(firsts[codes], wide)]
        ends = np.concatenate([[0], np.cumsum(wide)])[np.concatenate([[0], np.cumsum(sizes)])]
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
        keys = packet.column("ids").combine_chunks().flatten()
        batches.append(pa.RecordBatch.from_arrays([keys, ids], names=["id", "ids"]))
    return pa.Table.from_batches(batches)


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``(id_col, ids array<int>)`` of every row, as the rank file merges its pre-tokens."""
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(common.vocabulary_bytes(ranks_path))
    source = common.id_and_text(docs, id_col, text_col)
    id_type = source.schema["id"].dataType.simpleString()
    table, partitions = f"llm_blocks_{uuid.uuid4().hex}", common.shuffle_partitions(spark)
    (
        blocks(source, pattern, block_chars, partitions)
        .write.option("path", scratch_path(spark, "blocks"))
        .bucketBy(partitions, "block")
        .saveAsTable(table)
    )
    cut = spark.table(table)
    cut.schema  # resolves the frame, which needs no catalog from here on
    spark.sql(f"DROP TABLE {table}")  # the entry; its files stay
    packets = (
        cut.filter(F.col("bucket").isNotNull())
        .select("bucket", "block", "data")
        .repartition(partitions, "bucket")
        .sortWithinPartitions("bucket")
    )
    merged = merge_words(packets, ranks, pattern).repartition(partitions, "block")
    rows = cut.filter(F.col("bucket").isNull()).select("block", "data")
    encoded = (
        rows.groupBy("block")
        .cogroup(merged.groupBy("block"))
        .applyInArrow(joined_block, f"id {id_type}, ids array<int>")
    )
    return encoded.select(F.col("id").alias(id_col), "ids")


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded`` (binary): the bytes of the ids, by the table of token bytes.

    Null ids decode to nothing; an id outside the table is an error.
    """
    spark: SparkSession = encoded.sparkSession
    data = spark.sparkContext.broadcast(common.vocabulary_bytes(ranks_path))
    schema = encoded.withColumn("decoded", F.lit(None).cast("binary")).schema

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = {rank: piece for piece, rank in read_ranks(data.value).items()}
        table = [pieces.get(rank, b"") for rank in range(max(pieces) + 1)]
        lengths = np.fromiter(map(len, table), np.int64, len(table))
        starts, every = np.cumsum(lengths) - lengths, np.frombuffer(b"".join(table), np.uint8)
        for batch in batches:
            lists, out = batch.column(ids_col), []
            for k in range(len(lists)):  # one row's ids at a time
                values = lists[k].values
                ids = values.to_numpy() if values is not None else np.zeros(0, np.int64)
                if len(ids) and not lengths[ids].all():
                    raise ValueError("an id without a token")
                out.append(every[ragged(starts[ids], lengths[ids])].tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "decoded"]
            )

    return encoded.mapInArrow(join, schema)
