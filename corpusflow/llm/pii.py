"""Personal data: base rules as seeds, and bootstrapped contextual patterns beyond them.

Every text is read once. The base rules find e-mail addresses, IP addresses, card and
telephone numbers. Their spans are seeds: the words before a seed are a lexical
pattern. Looser shapes give candidates that the base rules do not take, such as
numbers without a plus sign or addresses with a written-out at sign. Patterns and
values form a graph that is scored in rounds until no value is added: a pattern is as good as the share of its
distinct values that are known to be of one kind, leaving out those that could yet turn
out to be. The values of the seeds are known from the start, wherever they are met; a
candidate value becomes known when a good pattern with enough known values stands before
it, and keeps its kind from then on. In the end, loose occurrences of known values behind
a good pattern for their kind are added. Base spans always stay.

Spans count code points, end exclusive. A null or empty text has no spans. Rows that
repeat an id and its text are the same document and get the same result each; null ids
and other columns are no obstacle. Only built-in functions, joins, windows inside a
document and aggregations are used. The expressions are written with possessive
repeats and look-behinds, so that a long run of letters or digits is read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm import common

KINDS = ("email", "ip", "card", "phone")
LOOSE_EMAIL, LOOSE_NUMBER = 4, 5
_LOCAL = "A-Za-z0-9._%+-"
#: Shapes by kind number, and what a text must hold to be searched for it.
SHAPES = (
    (
        rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "contains({t}, '@')",
    ),
    (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"{t} rlike '[0-9]\\.[0-9]'"),
    (r"[0-9](?:[\x20-]?+[0-9])++", "{t} rlike '[0-9]'"),
    (r"\+[0-9][\x20().0-9-]+[0-9]", r"{t} rlike '\\+[0-9]'"),
    (
        rf"(?<![{_LOCAL}])[{_LOCAL}]++\x20?+(?:@|\(at\)|\[at\])\x20?+[A-Za-z0-9-]++"
        r"(?:(?:\.|\x20?+(?:\(dot\)|\[dot\])\x20?+)[A-Za-z0-9-]++)++",
        "(contains({t}, '(at)') or contains({t}, '[at]') or contains({t}, '@'))",
    ),
    (r"(?<![0-9])[0-9](?:[\x20().-]{0,2}+[0-9])++", "{t} rlike '[0-9]'"),
)
#: Digits that a loose number may have, by the kind it is taken for.
LOOSE_DIGITS = {"card": (12, 19), "phone": (7, 15)}
CONTEXT_CHARS = 64
#: Rounds end when no value is found anew; so many without an end are an error.
MAX_ROUNDS = 1000
#: A pattern counts for a kind with this share of its values, and this many known ones.
MIN_CONFIDENCE = 0.95
MIN_KNOWN = 8


def _hits(text: str, kind: int) -> Column:
    """Matches of a shape: number, length of the gap before, the match, and its context."""
    shape, test = SHAPES[kind]
    literal = shape.replace("\\", "\\\\").replace("'", "\\'")
    gaps, hits = f"split({text}, '{literal}', -1)", f"regexp_extract_all({text}, '{literal}', 0)"
    entry = (
        f"struct({kind} as kind, k, int(char_length(x.`0`)) as gap, x.`1` as hit, "
        f"right(x.`0`, {CONTEXT_CHARS}) as before)"
    )
    found = f"filter(arrays_zip({gaps}, {hits}), x -> x.`1` is not null)"
    return F.expr(f"if({test.format(t=text)}, transform({found}, (x, k) -> {entry}), array())")


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, h, hits)`` per row: a hash of the text and the matches of all shapes."""
    source = common.id_and_text(docs, id_col, text_col)
    hits = F.concat(*(_hits("text", kind) for kind in range(len(SHAPES))))
    return source.select("id", F.xxhash64("text").alias("h"), hits.alias("hits"))


def _luhn(digits: str) -> Column:
    """Whether the digits' check sum holds; every second digit from the right counts twice."""
    digit = f"int(substr({digits}, length({digits}) + 1 - i, 1))"
    worth = f"if(i % 2 = 1, {digit}, if({digit} > 4, 2 * {digit} - 9, 2 * {digit}))"
    return F.expr(f"aggregate(sequence(1, length({digits})), 0, (a, i) -> a + {worth}) % 10 = 0")


def spans(scanned: DataFrame) -> DataFrame:
    """``(id, h, kind, start, end, hit, before, digits)`` of matches that pass their check."""
    rows = scanned.filter(F.size("hits") > 0).select("id", "h", F.inline("hits"))
    rows = rows.repartition("id", "h", "kind").dropDuplicates(["id", "h", "kind", "k"])
    running = Window.partitionBy("id", "h", "kind").orderBy("k")
    length = F.char_length("hit")
    placed = (
        rows.withColumn("end", F.sum(F.col("gap") + length).over(running))
        .withColumn("start", F.col("end") - length)
        .withColumn("digits", F.regexp_replace("hit", "[^0-9]", ""))
    )
    n = F.length("digits")
    parts = F.forall(F.split("hit", r"\."), lambda part: part.cast("double") <= 255)
    card = F.when(n.between(13, 19), _luhn("digits")).otherwise(False)
    valid = (
        F.when(F.col("kind") == KINDS.index("ip"), parts)
        .when(F.col("kind") == KINDS.index("card"), card)
        .when(F.col("kind") == KINDS.index("phone"), n.between(9, 15))
        .when(F.col("kind") == LOOSE_NUMBER, n.between(7, 19))
        .otherwise(True)
    )
    return placed.filter(valid).select(
        "id", "h", "kind", "start", "end", "hit", "before", "digits"
    )


def _occurrences(found: DataFrame) -> DataFrame:
    """Seeds and candidates with their values and patterns: ``known`` is a seed's kind."""
    base = F.col("kind") < len(KINDS)
    before = Window.partitionBy("id", "h").orderBy("start", "end")
    ahead = before.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ended = F.max(F.when(base, F.col("end"))).over(before) > F.col("start")
    begun = F.min(F.when(base, F.col("start"))).over(ahead) < F.col("end")
    overlaps = F.coalesce(ended, F.lit(False)) | F.coalesce(begun, F.lit(False))
    rows = found.withColumn("clash", overlaps).filter(base | ~F.col("clash"))
    words = F.filter(
        F.split(F.lower(F.regexp_replace("before", "[0-9]+", "0")), f"[{common.SPACE_CLASS}]+"),
        lambda word: word != "",
    )
    rows = rows.withColumn("words", words)
    one, two = F.element_at("words", -1), F.array_join(F.slice("words", -2, 2), " ")
    patterns = (
        F.when(F.size("words") >= 2, F.array(one, two))
        .when(F.size("words") == 1, F.array(one))
        .otherwise(F.array())
    )
    kind = F.get(F.array(*map(F.lit, KINDS)), F.when(base, F.col("kind")))
    spelled = F.lower("hit")
    for written, sign in ((r"\x20?(?:@|\(at\)|\[at\])\x20?", "@"), (r"\x20?(?:\(dot\)|\[dot\])\x20?", ".")):
        spelled = F.regexp_replace(spelled, written, sign)
    by_digits = F.col("kind").isin(KINDS.index("card"), KINDS.index("phone"), LOOSE_NUMBER)
    value = F.when(by_digits, F.col("digits")).otherwise(spelled)
    return rows.select(
        "id",
        "h",
        "start",
        "end",
        value.alias("value"),
        kind.alias("known"),
        _could_be().alias("kinds"),
        F.explode(patterns).alias("pattern"),
    )


def _could_be() -> Column:
    """The kinds that a candidate may turn out to be."""
    n = F.length("digits")
    number = F.filter(
        F.array(
            *(
                F.when(n.between(low, high), F.lit(kind))
                for kind, (low, high) in LOOSE_DIGITS.items()
            )
        ),
        lambda kind: kind.isNotNull(),
    )
    return (
        F.when(F.col("kind") == LOOSE_NUMBER, number)
        .when(F.col("kind") == LOOSE_EMAIL, F.array(F.lit("email")))
        .otherwise(F.array().cast("array<string>"))
    )


def seed_values(occurrences: DataFrame) -> DataFrame:
    """Distinct ``(value, kind)`` that the base rules found, behind whatever pattern."""
    seeds = occurrences.filter("known is not null")
    return seeds.select("value", F.col("known").alias("kind")).distinct()


def bootstrap(
    occurrences: DataFrame,
    max_rounds: int = MAX_ROUNDS,
    min_confidence: float = MIN_CONFIDENCE,
    min_known: int = MIN_KNOWN,
) -> tuple[DataFrame, DataFrame]:
    """Good patterns ``(pattern, kind, confidence, known)``, and candidate values they found.

    Edges are distinct pairs of pattern and value, counted before they are shuffled, so
    a pattern with a large part of all matches is reduced first.
    """
    edges = common.stored(
        occurrences.groupBy("pattern", "value").agg(
            F.max("known").alias("known"), F.max("kinds").alias("kinds")
        ),
        "edges",
    )
    seeds = edges.filter("known is not null").select("pattern", F.col("known").alias("kind"))
    totals = edges.groupBy("pattern").agg(F.count("*").alias("values"))
    totals = common.stored(totals, "totals")
    loose = edges.filter("known is null").select(
        "pattern", "value", F.explode("kinds").alias("kind")
    )
    known = seed_values(occurrences).withColumn("seeded", F.lit(1))
    candidates = loose.join(known, ["value", "kind"], "left").withColumn(
        "seeded", F.coalesce("seeded", F.lit(0))
    )
    candidates = common.stored(candidates, "candidates")
    one, none = F.lit(1).alias, F.lit(0).alias
    votes = seeds.select("pattern", "kind", one("seed"), none("open"), none("met"))
    votes = votes.unionByName(
        candidates.select("pattern", "kind", none("seed"), one("open"), F.col("seeded").alias("met"))
    )
    rest = candidates.filter("seeded = 0")
    found, count = None, 0
    for _ in range(max_rounds):
        cast = votes
        if found is not None:
            met = rest.join(found, ["value", "kind"], "left_semi")
            cast = votes.unionByName(
                met.select("pattern", "kind", none("seed"), none("open"), one("met"))
            )
        support = cast.groupBy("pattern", "kind").agg(
            F.sum(F.col("seed") + F.col("met")).alias("known"),
            F.sum(F.col("open") - F.col("met")).alias("open"),
        )
        scored = support.join(totals, "pattern").withColumn(
            "confidence", F.col("known") / (F.col("values") - F.col("open"))
        )
        good = scored.filter((F.col("confidence") >= min_confidence) & (F.col("known") >= min_known))
        good = common.stored(good.select("pattern", "kind", "confidence", "known"), "patterns")
        # a value with two kinds goes to the more confident one
        best = rest.join(good, ["pattern", "kind"]).groupBy("value").agg(
            F.max_by("kind", F.struct("confidence", "known", "kind")).alias("kind")
        )
        if found is not None:
            best = found.unionByName(best.join(found, "value", "left_anti"))
        found = common.stored(best, "found")
        before, count = count, found.count()
        if count == before:
            return good, found
    raise RuntimeError(f"no end after {max_rounds} rounds")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, spans)`` per row: a sorted array of ``(kind, start, end, base)``.

    ``kind`` is the number in ``KINDS``; ``base`` is false for spans that the patterns
    added.
    """
    scanned = common.stored(scan(docs, id_col, text_col), "scanned")
    placed = common.stored(spans(scanned), "spans")
    occurrences = common.stored(_occurrences(placed), "occurrences")
    good, found = bootstrap(occurrences)
    behind = occurrences.filter("known is null").drop("known").join(good, "pattern")
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")) - 1
    new = (
        behind.filter(F.expr("array_contains(kinds, kind)"))
        .join(seed_values(occurrences).unionByName(found), ["value", "kind"], "left_semi")
        .groupBy("id", "h", "start", "end")
        .agg(F.max_by(number, F.struct("confidence", "known", "kind")).alias("kind"))
        .select("id", "h", F.col("kind").cast("int").alias("kind"), "start", "end", F.lit(False).alias("base"))
    )
    base = placed.filter(F.col("kind") < len(KINDS)).select(
        "id", "h", "kind", "start", "end", F.lit(True).alias("base")
    )
    per_doc = (
        base.unionByName(new)
        .groupBy(F.col("id").alias("of_id"), F.col("h").alias("of_h"))
        .agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end", "base"))).alias("spans"))
    )
    same = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("h") == F.col("of_h"))
    joined = scanned.select("id", "h").join(per_doc, same, "left")
    empty = F.array().cast(per_doc.schema["spans"].dataType)
    return joined.select(F.col("id").alias(id_col), F.coalesce("spans", empty).alias("spans"))


def span_list(spans_col: str = "spans", base_only: bool = False) -> Column:
    """``kind:start:end`` of the spans by kind, then start, joined by commas."""
    chosen = F.filter(spans_col, lambda s: s["base"]) if base_only else F.col(spans_col)
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            chosen,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )
