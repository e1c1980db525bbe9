"""Which files may match a pattern: the trigrams of each file's texts as a bitmap.

Trigrams are of letters a-z, digits and spaces after folding case, so there are few enough
for an exact set of 8 KiB a file.  A pattern's plain runs of such characters must occur in
every match; files without one of their trigrams are not read.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALPHABET = string.ascii_lowercase + string.digits + " "
BITMAP_BITS = 32768
#: Escapes of one character that stand for a class or a place.
_CLASSES = set("dDwWsSbBAzZGRnrtfaehHvVX")
#: What a pattern that ignores case takes for one of the letters s, k and i.
_FOLDED = ("ſKıİ", "skii")


def _codes(trigrams: Column) -> Column:
    size = len(ALPHABET)

    def place(t: Column, k: int) -> Column:
        return F.instr(F.lit(ALPHABET), F.substring(t, k, 1)) - 1

    return F.transform(
        trigrams, lambda t: (place(t, 1) * size + place(t, 2)) * size + place(t, 3)
    )


def file_index(files: DataFrame, texts: Sequence[str]) -> DataFrame:
    """``(file, part, bits)``: the trigrams of all ``texts`` columns in each file read.

    ``files`` is a frame over files.  A text is read once, and a task returns a bitmap of
    each of its files.
    """
    known = [F.col(f"`{name}`").cast("string") for name in texts]
    folded = F.lower(F.translate(F.concat_ws("\n", *known), *_FOLDED))
    found = F.regexp_extract_all(folded, F.lit(f"(?=([{ALPHABET}]{{3}}))"), F.lit(1))
    codes = _codes(F.array_distinct(found))
    rows = files.select(F.col("_metadata.file_path").alias("file"), F.explode_outer(codes).alias("code"))
    position = F.coalesce("code", F.lit(0)) + 1
    bit = F.when(F.col("code").isNotNull(), F.bitmap_bit_position(position))
    parts = rows.select(
        "file", (F.bitmap_bucket_number(position) - 1).cast("int").alias("part"), bit.alias("bit")
    )
    # Without any trigram a file still has a row, with an empty bitmap.  Equal bits of a
    # file are combined first, by hash: bitmaps are built from sorted rows.
    return parts.distinct().groupBy("file", "part").agg(F.bitmap_construct_agg("bit").alias("bits"))


def required_trigrams(pattern: str) -> set[str]:
    """Trigrams that every text matched by ``pattern`` has, whatever their case.

    Only plain runs outside of groups, classes and alternatives count; for a pattern with
    anything unusual there are none.
    """
    runs, run, at = [], "", 0

    def skipped(start: int, close: str) -> int:
        """Behind the bracket that closes the one at ``start``; -1 if there is none."""
        depth, k = 0, start
        while k < len(pattern):
            c = pattern[k]
            if c == "\\":
                k += 1
            elif c == pattern[start]:
                depth += 1
            elif c == close:
                depth -= 1
                if not depth:
                    return k + 1
            elif c == "[" and close == ")":
                k = skipped(k, "]") - 1
                if k < 0:
                    return -1
            k += 1
        return -1

    while at < len(pattern):
        c, after = pattern[at], pattern[at + 1 : at + 2]
        if c == "|" or pattern.startswith(("(?", "(*"), at) or (c == "\\" and not after):
            return set()
        if c == "\\":
            if after.isalnum() and after not in _CLASSES:
                return set()
            runs, run, at = [*runs, run], "", at + 2
        elif c in "([{":
            end = skipped(at, {"(": ")", "[": "]", "{": "}"}[c])
            if end < 0:
                return set()
            runs, run, at = [*runs, run], "", end
        elif c.lower() in ALPHABET and c.isascii():
            if after in ("?", "*", "{"):
                runs, run = [*runs, run], ""
            elif after == "+":
                runs, run = [*runs, run + c.lower()], ""
            else:
                run += c.lower()
            at += 1
        else:
            runs, run, at = [*runs, run], "", at + 1
    return {r[k : k + 3] for r in [*runs, run] for k in range(len(r) - 2)}


def candidate_files(index: DataFrame, pattern: str) -> DataFrame:
    """``(file)``: the indexed files that may hold a match."""
    size = len(ALPHABET)
    tests: dict[int, Column] = {}
    for a, b, c in sorted(required_trigrams(pattern)):
        code = (ALPHABET.index(a) * size + ALPHABET.index(b)) * size + ALPHABET.index(c)
        part, bit = divmod(code, BITMAP_BITS)
        byte = F.conv(F.hex(F.substring("bits", bit // 8 + 1, 1)), 16, 10).cast("int")
        is_set = byte.bitwiseAND(F.lit(1 << bit % 8)) != 0
        tests[part] = tests[part] & is_set if part in tests else is_set
    fits = F.lit(True)
    for part, test in tests.items():
        fits &= F.bool_or((F.col("part") == part) & test)
    return index.groupBy("file").agg(fits.alias("fits")).filter("fits").select("file")
