"""Quality rules as a ledger: measured once, judged by any policy later.

``with_ledger`` reads a text once and keeps its measurements and one bit per failed
rule. A policy is a version and the mask of the rules that it enforces, so a new
version, or an ablation of each rule, is bit arithmetic on the ledger: no text is read
again, and ablations need one count per distinct bit pattern only.

Everything is built-in expressions in a document's row, without a shuffle. Words are
separated by ASCII white space. A null or empty text has no words and fails
``few_words``. Repeated rows are judged one by one; null ids and other columns are
kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import common

WINDOW_WORDS = 8
MEASURES = (
    "n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words n_upper".split()
)
#: Rules in the order of their bits; each is a condition on the measurements that fails
#: a document, valid in Spark SQL and in DuckDB.
RULES = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 12 * n_words",
    "upper_case": "2 * n_upper > word_chars",
}
#: Versions of the policy: the rules that each one enforces.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": tuple(RULES),
}


def mask(rules) -> int:
    """The bits of some rules."""
    order = list(RULES)
    return sum(1 << order.index(rule) for rule in rules)


def _covered(starts: str) -> Column:
    """Words covered by windows at ascending ``starts``."""
    return F.expr(
        f"aggregate(transform({starts}, (p, i) -> "
        f"least({WINDOW_WORDS}, coalesce(get({starts}, i + 1), p + {WINDOW_WORDS}) - p)), "
        "0L, (a, b) -> a + b)"
    )


def with_ledger(docs: DataFrame, text_col: str = "text", ledger_col: str = "ledger") -> DataFrame:
    """Adds ``ledger_col``: a struct of the measurements and ``failed_rules`` (bits)."""
    text, words, windows, ranked, starts, lines = common.fresh(
        docs, "_text", "_words", "_windows", "_ranked", "_starts", "_lines"
    )
    space = f"[{common.SPACE_CLASS}]+".replace("\\", "\\\\")
    measured = (
        docs.withColumn(text, common.text_or_empty(text_col))
        .withColumn(words, F.expr(f"array_remove(split({text}, '{space}'), '')"))
        .withColumn(
            windows,
            F.expr(
                f"if(size({words}) < {WINDOW_WORDS}, array(), transform("
                f"sequence(1, greatest(1, size({words}) - {WINDOW_WORDS - 1})), "
                f"i -> xxhash64(slice({words}, i, {WINDOW_WORDS}))))"
            ),
        )
        # most texts repeat no window: only the others sort theirs
        .withColumn(
            ranked,
            F.expr(
                f"if(size(array_distinct({windows})) = size({windows}), array(), "
                f"sort_array(transform({windows}, (h, i) -> struct(h, i))))"
            ),
        )
        .withColumn(
            starts,
            F.expr(
                f"sort_array(transform(filter({ranked}, (x, k) -> "
                f"get({ranked}, k - 1).h <=> x.h or get({ranked}, k + 1).h <=> x.h), x -> x.i))"
            ),
        )
        .withColumn(
            lines, F.expr(f"filter(split({text}, '\\n'), l -> l rlike '[^{space[1:-2]}]')")
        )
    )
    kept = "[^#*$%&|<>]+"
    values = {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, kept, "")).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": _covered(starts),
        "n_upper": F.length(F.regexp_replace(text, "[^\\p{Lu}]+", "")).cast("long"),
    }
    measured = measured.withColumn(
        ledger_col, F.struct(*(values[name].alias(name) for name in MEASURES))
    )
    bits = F.lit(0).cast("long")
    for bit, rule in enumerate(RULES.values()):
        for name in sorted(MEASURES, key=len, reverse=True):
            rule = rule.replace(name, f"@{MEASURES.index(name)}")
        for k, name in enumerate(MEASURES):
            rule = rule.replace(f"@{k}", f"{ledger_col}.{name}")
        bits = bits + F.when(F.expr(rule), F.lit(1 << bit)).otherwise(0)
    # A filter on the ledger must not be pushed below the steps that measure: each would be
    # written out many times over. It is not pushed past an expression that is called
    # nondeterministic, as this one is, although a row number is never negative.
    bits = F.when(F.monotonically_increasing_id() < 0, F.lit(-1)).otherwise(bits)
    return measured.withColumn(
        ledger_col, F.col(ledger_col).withField("failed_rules", bits)
    ).select(*(f"`{c}`" for c in docs.columns if c != ledger_col), ledger_col)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, measurements, failed_rules)``, without the texts."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = with_ledger(slim, "text", "ledger")
    return found.select(F.col("id").alias(id_col), "ledger.*")


def passes(failed_rules: str | Column, policy: str = "v1") -> Column:
    """Whether a version of the policy keeps a document."""
    bits = F.col(failed_rules) if isinstance(failed_rules, str) else failed_rules
    return bits.bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def kept_documents(docs: DataFrame, policy: str = "v1", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that a version of the policy keeps, with their columns."""
    (held,) = common.fresh(docs, "_ledger")
    kept = with_ledger(docs, text_col, held).filter(passes(F.col(f"{held}.failed_rules"), policy))
    return kept.select(*(f"`{c}`" for c in docs.columns))


def ablation(entries: DataFrame, policy: str = "v1") -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone, and that the
    policy without the rule would keep. An empty ledger gives zeros.

    ``entries`` is a ledger; it is reduced to one count per bit pattern first (at most
    2 to the number of rules rows), and those are combined by bitwise tests.
    """
    enforced = mask(POLICIES[policy])
    patterns = entries.groupBy(F.col("failed_rules").bitwiseAND(F.lit(enforced)).alias("bits"))
    counts = patterns.agg(F.count("*").alias("n"))
    rules = [(r, 1 << b) for b, r in enumerate(RULES) if r in POLICIES[policy]]
    sums = []
    for rule, bit in rules:
        fails = F.col("bits").bitwiseAND(F.lit(bit)) != 0
        alone = F.col("bits") == bit
        kept = F.col("bits").bitwiseAND(F.lit(enforced & ~bit)) == 0
        sums += [
            F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0)).alias(f"{rule}:{name}")
            for name, test in (("failed", fails), ("failed_alone", alone), ("kept_without", kept))
        ]
    rows = F.array(
        *(
            F.struct(
                F.lit(rule).alias("rule"),
                *(F.col(f"`{rule}:{n}`").alias(n) for n in ("failed", "failed_alone", "kept_without")),
            )
            for rule, _ in rules
        )
    )
    return counts.agg(*sums).select(F.inline(rows))
