"""Token ids in files, compressed by a Re-Pair grammar per shard.

Documents are brought into ascending order of their ids and encoded. A shard is a run of
documents; in it, frequent pairs of neighbouring ids are replaced by new symbols, again
and again, until no pair is frequent. A row of the files is one shard: its documents and
their lengths, the rules, the expanded length of each rule, and what is left of the
sequence. The expanded lengths tell where any token is, so a range can be decoded alone.
The files are Parquet, so that Spark commits them and a lost executor's shards are
written again.

All frequent pairs of a round are replaced at once; where two of them overlap, the more
frequent one goes first, and a run of one symbol is paired from its left end.

Null texts are empty and hold the end id alone. Null document ids come first; rows with
equal ids are in the order of their texts. Other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from corpusflow.llm import byte_bpe, common

END_ID = 1
SHARD_TOKENS = 1 << 20
#: A pair is frequent with this share of a shard's symbols, and at least this often.
MIN_SHARE, MIN_COUNT = 1 / 16384, 4
#: Rounds end when one shortens the sequence by less than this.
MIN_GAIN = 0.01
COUNT_BITS = 20
#: Words of a generation that a worker keeps with their ids, and words encoded at a time.
KNOWN_WORDS, WORDS_AT_ONCE = 300_000, 256
#: A special token that separates words which are encoded together.
MARK = "<|startoftext|>"
#: Kinds of bytes. A word with an odd byte, or the first of two that are no letter, is not cut.
SPACE, LETTER, DIGIT, SYMBOL, ODD, LEAD = range(6)
SPACES = b" \t\n\v\f\r"
#: How a tokenizer cuts that encodes runs of letters, digits, and runs of symbols apart.
APART_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
APART_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BYTE_LEVEL = {
    "type": "ByteLevel",
    "add_prefix_space": False,
    "trim_offsets": True,
    "use_regex": False,
}
APART_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": APART_PATTERN},
            "behavior": "Removed",
            "invert": True,
        },
        BYTE_LEVEL,
    ],
}
#: Text whose words are numbered together.
TEXT_BYTES = 4 << 20
SHARD_SCHEMA = (
    "part int, part_before long, ids array<{id}>, lengths array<long>, n_tokens long, first_rule long, "
    "rules binary, rule_lengths binary, symbols binary"
)

_tokenizers: dict[str, "Words"] = {}


def _slots(keys: np.ndarray, turn: int) -> np.ndarray:
    """A hash of each key; another one each turn."""
    factor = (0x9E3779B97F4A7C15 + turn * 0xD1342543DE82EF96) % (1 << 64) | 1
    slots = keys.view(np.uint64) * np.uint64(factor)
    slots >>= np.uint64(64 - COUNT_BITS)
    return slots.view(np.int64)


def frequent_pairs(
    keys: np.ndarray, least: int, turn: int = 0
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of keys found ``least`` times or more, their ranks, and the keys by rank.

    The most frequent key has rank 0. Keys are counted by slots of a hash: where none
    reaches ``least``, no key does. Of several keys in a slot one is counted exactly and
    the others wait for the next turn, which has another hash; only if that leaves
    nothing are the keys sorted.
    """
    slots = _slots(keys, turn)
    often = np.bincount(slots, minlength=1 << COUNT_BITS) >= least
    places = np.flatnonzero(often[slots])
    used = np.flatnonzero(often)  # few slots from here on, by their numbers
    number = np.empty(1 << COUNT_BITS, np.int32)
    number[used] = np.arange(len(used))
    held, slots = keys[places], number[slots[places]]
    holder = np.zeros(len(used), np.int64)
    holder[slots] = held
    own = holder[slots] == held
    counts = np.bincount(slots[own], minlength=len(used))
    found = np.flatnonzero(counts >= least)
    if not len(found) and len(places):
        holder, slots, counts = np.unique(held, return_inverse=True, return_counts=True)
        own = np.ones(len(held), bool)
        found = np.flatnonzero(counts >= least)
    found = found[np.argsort(-counts[found], kind="stable")]
    rank_of = np.full(len(counts), -1, np.int64)
    rank_of[found] = np.arange(len(found))
    rank = np.where(own, rank_of[slots], -1)
    return places[rank >= 0], rank[rank >= 0], holder[found]


def chosen_pairs(places: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which of the pairs at ascending ``places`` to replace, none overlapping.

    Of two that overlap, the lower ``rank`` goes first; a run of one pair is taken from
    its left end.
    """
    follows = np.zeros(len(places) + 1, bool)  # overlaps the pair before it
    follows[1:-1] = places[1:] == places[:-1] + 1
    left, right = follows[:-1], follows[1:]
    before, after = np.roll(rank, 1), np.roll(rank, -1)
    edge = ~left | (before != rank)  # where a run of one pair starts
    number = np.arange(len(places))
    offset = number - np.maximum.accumulate(np.where(edge, number, 0))
    first = ~edge | ~left | (before > rank)
    return np.flatnonzero((offset % 2 == 0) & first & (~right | (after >= rank)))


def compress(
    ids: np.ndarray,
    min_share: float = MIN_SHARE,
    min_count: int = MIN_COUNT,
    min_gain: float = MIN_GAIN,
) -> tuple[int, np.ndarray, np.ndarray]:
    """The first rule's symbol, the rules as rows of two symbols, and the sequence left."""
    symbols = ids.astype(np.int64)
    first = int(symbols.max(initial=0)) + 1
    rules: list[np.ndarray] = []
    bound = first
    before = 2 * len(symbols)
    while len(symbols) > 1 and before - len(symbols) >= min_gain * before:
        before = len(symbols)
        least = max(min_count, int(len(symbols) * min_share))
        keys = symbols[:-1] * bound + symbols[1:]
        places, rank, found = frequent_pairs(keys, least, len(rules))
        if not len(found):
            break
        chosen = chosen_pairs(places, rank)
        places, rank = places[chosen], rank[chosen]
        used = np.bincount(rank, minlength=len(found)) > 0
        rules.append(np.stack([found[used] // bound, found[used] % bound], axis=1))
        keep = np.ones(len(symbols), bool)
        keep[places + 1] = False
        symbols[places] = bound + (np.cumsum(used) - 1)[rank]
        symbols = symbols[keep]
        bound += int(used.sum())
    every = np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)
    return first, every, symbols


def rule_lengths(first: int, rules: np.ndarray) -> np.ndarray:
    """Ids that each rule stands for; a rule only uses earlier ones."""
    lengths = np.ones(len(rules), np.int64)
    for k, (a, b) in enumerate(rules.tolist()):
        lengths[k] = (lengths[a - first] if a >= first else 1) + (
            lengths[b - first] if b >= first else 1
        )
    return lengths


def _expanded_by_levels(symbols: np.ndarray, first: int, rules: np.ndarray) -> np.ndarray:
    while True:
        ruled = symbols >= first
        if not ruled.any():
            return symbols
        ends = np.cumsum(1 + ruled)
        wide = np.empty(int(ends[-1]), np.int64)
        wide[ends - 1] = symbols
        pairs = rules[symbols[ruled] - first]
        wide[ends[ruled] - 2], wide[ends[ruled] - 1] = pairs[:, 0], pairs[:, 1]
        symbols = wide


def expand(
    symbols: np.ndarray, first: int, rules: np.ndarray, lengths: np.ndarray | None = None
) -> np.ndarray:
    """Symbols back to ids; ``lengths`` are those of the rules, if known.

    Where the rules stand for no more ids than the symbols, each rule is expanded once.
    """
    if first + len(rules) <= len(symbols):
        lengths = rule_lengths(first, rules) if lengths is None else lengths
        sizes = np.concatenate([np.ones(first, np.int64), lengths])
        wide = sizes[symbols]
        if first + int(lengths.sum()) <= int(wide.sum()):
            every = _expanded_by_levels(np.arange(first + len(rules)), first, rules)
            return every[byte_bpe.ragged((np.cumsum(sizes) - sizes)[symbols], wide)]
    return _expanded_by_levels(symbols, first, rules)


def read_range(shard: dict, start: int, count: int) -> np.ndarray:
    """Ids ``start`` to ``start + count`` of a shard, expanding only the symbols they are in."""
    first = shard["first_rule"]
    rules = np.frombuffer(shard["rules"], "<i4").reshape(-1, 2).astype(np.int64)
    symbols = np.frombuffer(shard["symbols"], "<i4").astype(np.int64)
    lengths = np.frombuffer(shard["rule_lengths"], "<i8")
    size = np.ones(len(symbols), np.int64)
    size[symbols >= first] = lengths[symbols[symbols >= first] - first]
    ends = np.cumsum(size)
    low = int(np.searchsorted(ends, start, "right"))
    high = int(np.searchsorted(ends, start + count, "left")) + 1
    before = int(ends[low - 1]) if low else 0
    ids = expand(symbols[low:high], first, rules, lengths)
    return ids[start - before : start - before + count]


class Cuts:
    """Cuts texts into parts whose ids are the text's ids, in order.

    A part is a word, or if the tokenizer allows it, a run of letters in lower case, a
    digit or a run of symbols in a word: many words share them. Words with other
    characters, apostrophes or parts of special tokens stay whole, as they are.
    """

    def __init__(self, tokenizer: Tokenizer):
        self.kinds = np.full(256, LETTER, np.uint8)
        self.kinds[list(SPACES)] = SPACE
        self.lower = np.arange(256, dtype=np.uint8)
        self.points = np.zeros(0x800, np.uint16)
        #: The letters that parts hold, as a pattern; none if words stay whole.
        self.letters: re.Pattern | None = None
        if self._apart(tokenizer):
            self._ask(tokenizer)

    @staticmethod
    def _apart(tokenizer: Tokenizer) -> bool:
        def state(part) -> dict | None:
            return part and json.loads(part.__getstate__())

        special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        return (
            state(tokenizer.normalizer) == APART_NORMALIZER
            and state(tokenizer.pre_tokenizer) == APART_PRE_TOKENIZER
            and getattr(tokenizer.model, "dropout", None) is None
            and all("|" in content for content in special)
        )

    def _ask(self, tokenizer: Tokenizer) -> None:
        """The letters of one or two bytes whose lower case is as long, as the library has it."""
        self.kinds[self.kinds == LETTER] = ODD
        for code in range(0x21, 0x7F):
            self.kinds[code] = SYMBOL
        self.kinds[[ord("'"), ord("|")]] = ODD
        self.kinds[ord("0") : ord("9") + 1] = DIGIT
        self.kinds[0xC0:0xE0] = LEAD
        found = set()
        for code in [*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x800)]:
            lower = tokenizer.normalizer.normalize_str(f"a{chr(code)}a")[1:-1]
            whole = f"a{lower}a"
            if (
                len(lower) == 1
                and (ord(lower) < 0x80) == (code < 0x80)
                and ord(lower) < 0x800
                and lower.isalpha()
                and tokenizer.normalizer.normalize_str(whole) == whole
                and len(tokenizer.pre_tokenizer.pre_tokenize_str(whole)) == 1
            ):
                found.add(lower)
                if code < 0x80:
                    self.kinds[code], self.lower[code] = LETTER, ord(lower)
                else:
                    self.points[code] = ord(lower)
        self.letters = re.compile(f"[{''.join(sorted(found))}]+")

    def parts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The parts of all texts, and how many there are up to the end of each text."""
        texts = texts.cast(pa.large_string())
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        raw = data.tobytes()  # translate is much faster than an index
        kinds = np.frombuffer(bytearray(raw.translate(self.kinds.tobytes())), np.uint8)
        lower = np.frombuffer(bytearray(raw.translate(self.lower.tobytes())), np.uint8)
        leads = np.flatnonzero(kinds == LEAD)
        nexts = data[np.minimum(leads + 1, len(data) - 1)]
        points = self.points[(data[leads] & 0x1F).astype(np.int64) << 6 | nexts & 0x3F]
        known = (points > 0) & (nexts & 0xC0 == 0x80)
        leads, points = leads[known], points[known]
        kinds[leads] = kinds[leads + 1] = LETTER
        lower[leads], lower[leads + 1] = 0xC0 | points >> 6, 0x80 | points & 0x3F

        # Runs of one kind, those of spaces too; no run goes on in the next text.
        opens = kinds == DIGIT
        opens[1:] |= kinds[1:] != kinds[:-1]
        opens[ends[:-1][ends[:-1] < len(data)]] = True
        firsts = np.flatnonzero(opens)
        stops = np.append(firsts, len(data))[1:]
        kind = kinds[firsts]
        if (kind >= ODD).any():
            opens = kind != SPACE  # a word
            new = np.searchsorted(firsts, ends[:-1])
            follows = np.append(False, opens[:-1])
            follows[new[new < len(firsts)]] = False
            opens &= ~follows
            word = np.cumsum(opens)
            whole = np.zeros(len(firsts) + 1, bool)
            whole[word[kind >= ODD]] = True
            whole = whole[word] & (kind != SPACE)
            inside = byte_bpe.ragged(firsts[whole], (stops - firsts)[whole])
            lower[inside] = data[inside]
            first = np.flatnonzero((kind != SPACE) & (opens | ~whole))
            # A whole word goes on to the run before the next part or spaces.
            last = np.flatnonzero((kind != SPACE) & np.append((opens | ~whole | (kind == SPACE))[1:], True))
            firsts, stops = firsts[first], stops[last]
        else:
            firsts, stops = firsts[kind != SPACE], stops[kind != SPACE]
        values = lower.tobytes().translate(None, SPACES)
        places = np.concatenate([[0], np.cumsum(stops - firsts)])
        counts = np.searchsorted(firsts, ends[1:])
        buffers = [None, pa.py_buffer(places), pa.py_buffer(values)]
        return pa.Array.from_buffers(pa.large_string(), len(firsts), buffers), counts


class Words:
    """A worker's tokenizer and the ids of words it has met, in two generations.

    When the newer generation is full it becomes the older one; words met again move to
    the newer one, so that those which recur stay and memory is bounded. A word is a part
    as ``Cuts`` makes them.
    """

    def __init__(self, path: str, known_words: int = KNOWN_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks take the cores
        self.tokenizer, self.limit = Tokenizer.from_file(path), known_words
        self.mark = self.tokenizer.token_to_id(MARK)
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.cuts = Cuts(self.tokenizer)
        # Letters in lower case need no normalizer, and no pattern to find them between spaces.
        model = self.tokenizer.model
        self.bare = Tokenizer(model)
        self.bare.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.Split(" ", "removed"),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        #: Which ids end a run of letters, if the model tells.
        self.last: np.ndarray | None = None
        suffix = getattr(model, "end_of_word_suffix", None)
        if self.cuts.letters and suffix:
            vocabulary = self.tokenizer.get_vocab()
            self.last = np.zeros(max(vocabulary.values()) + 1, bool)
            self.last[[n for token, n in vocabulary.items() if token.endswith(suffix)]] = True

    def ids(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words as little-endian 32-bit integers; unmet ones are encoded."""
        if len(self.newer) > self.limit:
            self.newer, self.older = {}, self.newer
        newer, older = self.newer, self.older
        found = list(map(newer.get, words))
        missing = [k for k, ids in enumerate(found) if ids is None]
        unmet = []
        for k in missing:
            ids = older.get(words[k])
            if ids is None:
                unmet.append(k)
            else:
                found[k] = newer[words[k]] = ids
        if self.last is not None:
            runs = [k for k in unmet if self.cuts.letters.fullmatch(words[k])]
            for start in range(0, len(runs), WORDS_AT_ONCE):
                some = runs[start : start + WORDS_AT_ONCE]
                for k, ids in zip(some, self._encoded_runs([words[k] for k in some])):
                    found[k] = newer[words[k]] = ids
            unmet = [k for k in unmet if found[k] is None]
        for start in range(0, len(unmet), WORDS_AT_ONCE):
            some = unmet[start : start + WORDS_AT_ONCE]
            for k, ids in zip(some, self._encoded([words[k] for k in some])):
                found[k] = newer[words[k]] = ids
        return found

    def _encoded_runs(self, words: list[str]) -> list[bytes]:
        """Runs of letters as one text, between spaces.

        The ids that end a run tell them apart; if there are not as many, they go as other
        words do.
        """
        one = self.bare.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0]
        every = np.array(one.ids, "<u4")
        stops = (4 * np.flatnonzero(self.last[every]) + 4).tolist()
        data = every.tobytes()
        if len(stops) != len(words) or stops[-1] != len(data):
            return self._encoded(words)
        return [data[a:b] for a, b in zip([0, *stops], stops)]

    def _encoded(self, words: list[str]) -> list[bytes]:
        """Words as one text, between marks that have an id of their own.

        Words that hold a part of the mark, or all if there is no mark, go alone.
        """
        plain = [w for w in words if "<|" not in w and "|>" not in w] if self.mark is not None else []
        ids = {}
        if plain:
            one = self.tokenizer.encode_batch_fast([MARK.join(plain)], add_special_tokens=False)[0]
            every = np.array(one.ids, "<u4")
            cuts = np.flatnonzero(every == self.mark).tolist()
            if len(cuts) != len(plain) - 1:
                raise ValueError("a word's ids hold the mark")
            data = every.tobytes()
            for word, a, b in zip(plain, [-1, *cuts], [*cuts, len(every)]):
                ids[word] = data[4 * a + 4 : 4 * b]
        for word in words:
            if word not in ids:
                one = self.tokenizer.encode(word, add_special_tokens=False)
                ids[word] = np.array(one.ids, "<u4").tobytes()
        return [ids[word] for word in words]


def _words(path: str) -> Words:
    if path not in _tokenizers:
        _tokenizers[path] = Words(path)
    return _tokenizers[path]


def encode_texts(words: Words, texts: pa.Array, end_id: int | None = None) -> list[np.ndarray]:
    """The ids of each text, with ``end_id`` behind them.

    The tokenizer never merges across white space, so a text's ids are those of its words
    in order, and those of their parts. The texts' parts are numbered by Arrow and each of
    them is looked up once.
    """
    parts, ends = words.cuts.parts(texts)
    numbers = parts.dictionary_encode()
    coded = words.ids(numbers.dictionary.to_numpy(zero_copy_only=False).tolist())
    codes = numbers.indices.to_numpy()
    if end_id is not None:
        codes = np.insert(codes, ends, len(coded))
        ends = ends + np.arange(1, len(ends) + 1)
        coded = [*coded, np.array([end_id], "<u4").tobytes()]
    sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
    wide = sizes[codes]
    flat = np.frombuffer(b"".join(coded), "<u4")
    ids = flat[byte_bpe.ragged((np.cumsum(sizes) - sizes)[codes], wide)]
    cuts = np.concatenate([[0], np.cumsum(wide)])[np.concatenate([[0], ends]).astype(np.int64)]
    return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def _some_texts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``TEXT_BYTES`` of text, or one row."""
    sizes = pc.binary_length(batch.column("text")).to_numpy()
    start, held = 0, 0
    for k, size in enumerate(sizes.tolist()):
        if held and held + size > TEXT_BYTES:
            yield batch.slice(start, k - start)
            start, held = k, 0
        held += size
    yield batch.slice(start)


def _shard_row(
    part: int, before: int, ids: list, id_type, tokens: list[np.ndarray]
) -> pa.RecordBatch:
    lengths = [len(t) for t in tokens]
    every = np.concatenate(tokens)
    first, rules, symbols = compress(every)
    columns = {
        "part": pa.array([part], pa.int32()),
        "part_before": pa.array([before], pa.int64()),
        "ids": pa.array([ids], pa.list_(id_type)),
        "lengths": pa.array([lengths], pa.list_(pa.int64())),
        "n_tokens": pa.array([len(every)], pa.int64()),
        "first_rule": pa.array([first], pa.int64()),
        "rules": pa.array([rules.astype("<i4").tobytes()], pa.binary()),
        "rule_lengths": pa.array([rule_lengths(first, rules).astype("<i8").tobytes()], pa.binary()),
        "symbols": pa.array([symbols.astype("<i4").tobytes()], pa.binary()),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Encodes documents, with ``end_id`` behind each, into the files of ``path``."""
    source = common.id_and_text(docs, id_col, text_col)
    id_type = source.schema["id"].dataType.simpleString()
    ordered = source.repartitionByRange("id").sortWithinPartitions("id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        words = _words(tokenizer_path)
        ids, tokens, held, kind = [], [], 0, pa.null()
        for batch in batches:
            kind = batch.schema.field("id").type
            for some in _some_texts(batch) if batch.num_rows else ():
                coded = encode_texts(words, some.column("text"), end_id)
                for key, data in zip(some.column("id").to_pylist(), coded):
                    ids.append(key)
                    tokens.append(data)
                    held += len(data)
                    if held >= shard_tokens:
                        yield _shard_row(part, before, ids, kind, tokens)
                        before, ids, tokens, held = before + held, [], [], 0
                pa.default_memory_pool().release_unused()
        if ids:
            yield _shard_row(part, before, ids, kind, tokens)

    rows = ordered.mapInArrow(encode, SHARD_SCHEMA.format(id=id_type))
    rows.write.option("compression", "zstd").parquet(path)


def read_tokens(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """``(id, start, ids array<int>)`` per document: ``start`` counts the ids before it."""
    shards = spark.read.schema(SHARD_SCHEMA.format(id=id_type)).parquet(path)
    # One row per writing task comes to the driver, as its own record of the tasks did.
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    starts, total = {}, 0
    for row in totals:
        starts[row["part"]] = total
        total += row["n"]
    shared = spark.sparkContext.broadcast(starts)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                shard = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
                ids = read_range(shard, 0, shard["n_tokens"]).astype(np.int32)
                ends = np.cumsum([0, *shard["lengths"]])
                kind = batch.schema.field("ids").type.value_type
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard["ids"], kind),
                        pa.array(starts[shard["part"]] + shard["part_before"] + ends[:-1]),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                    ],
                    names=["id", "start", "ids"],
                )

    return shards.mapInArrow(decode, f"id {id_type}, start long, ids array<int>")


def with_crc(tokens: DataFrame) -> DataFrame:
    """``(id, start, n_tokens, ids_crc32)`` of documents that were read back."""
    id_type = tokens.schema["id"].dataType.simpleString()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            arrays = [lists[k].values.to_numpy() for k in range(len(lists))]
            sums = [zlib.crc32(a.astype("<u4").tobytes()) for a in arrays]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("start"),
                    pa.array([len(a) for a in arrays], pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                names=["id", "start", "n_tokens", "ids_crc32"],
            )

    return tokens.mapInArrow(check, f"id {id_type}, start long, n_tokens long, ids_crc32 long")
