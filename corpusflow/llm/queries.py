"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import (
    byte_bpe,
    common,
    decontaminate,
    exact_dedup,
    hard_negatives,
    line_dedup,
    pii,
    quality,
    simhash,
    token_counts,
    token_store,
    url_filters,
    vector_codes,
    warc,
)
from corpusflow.sources.scratch import scratch_path

BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"
ENGLISH_RANKS = "byte_bpe_50k.tiktoken"
WORD_TOKENIZER = "word_bpe_49k.json"
#: Payloads of fewer bytes are archived in full each time.
REVISIT_BYTES = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    common.workers_find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return common.spread(table(spark, sf_dir, "documents"), "doc_id")


def byte_bpe_digests(docs: DataFrame) -> DataFrame:
    """Counts and digests of the ids of every document, and of what they decode to."""
    ranks = public_tokenizers.path(BYTE_RANKS)
    encoded = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    joined = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return byte_bpe.decode(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test items that documents hold."""
    items = table(spark, sf_dir, "benchmark")
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = decontaminate.with_matches(docs, items).select("doc_id", F.inline("matches"))
    return found.select("doc_id", F.col("item").alias("item_id"), "score")


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents in order, read back and summed up."""
    path = scratch_path(spark, "tokens")
    docs = table(spark, sf_dir, "documents")
    token_store.write_tokens(docs, path, public_tokenizers.path(WORD_TOKENIZER))
    tokens = token_store.read_tokens(spark, path, docs.schema["doc_id"].dataType.simpleString())
    return token_store.with_crc(tokens).withColumnRenamed("id", "doc_id")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(ENGLISH_RANKS)
    return token_counts.count_tokens(documents(spark, sf_dir), ranks)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe_digests(documents(spark, sf_dir))


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data; the counts are of base spans."""
    found = pii.personal_data(documents(spark, sf_dir))
    base = F.transform(F.filter("spans", lambda s: s["base"]), lambda s: s["kind"])
    counts = [
        (F.size(base) - F.size(F.array_remove(base, k))).cast("long").alias(f"n_{kind}")
        for k, kind in enumerate(pii.KINDS)
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.span_list(base_only=True).cast("binary"), 256).alias("base_sha256"),
        pii.span_list().alias("spans"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without later copies of lines, and where the first copies are."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return line_dedup.drop_repeated_lines(docs, report=("n_removed", "first_copies"))


OP2_SQL = f"""WITH raw AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
            generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS raw_no
        FROM documents),
    worded AS (
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY raw_no) AS n
        FROM raw WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
    runs AS (
        SELECT *, CASE WHEN lead(n, {line_dedup.MIN_LINES - 1}) OVER ahead IS NOT NULL
            THEN {" || chr(10) || ".join(f"lead(line, {k}) OVER ahead" for k in range(line_dedup.MIN_LINES))}
            END AS run
        FROM worded WINDOW ahead AS (PARTITION BY doc_id ORDER BY n)),
    firsts AS (
        SELECT *, min((doc_id, n)) OVER (PARTITION BY line) AS first_line,
            min((doc_id, n)) OVER (PARTITION BY run) AS first_run
        FROM runs),
    later AS (
        SELECT doc_id, n, raw_no,
            CASE WHEN first_line < (doc_id, n) AND length(line) >= {line_dedup.LONG_LINE_CHARS}
                THEN first_line[1] END AS lone,
            CASE WHEN run IS NOT NULL AND first_run < (doc_id, n) THEN first_run[1] END AS run_id
        FROM firsts),
    gone AS (
        SELECT doc_id, raw_no, coalesce(lone, min(run_id) OVER (PARTITION BY doc_id ORDER BY n
            ROWS BETWEEN {line_dedup.MIN_LINES - 1} PRECEDING AND CURRENT ROW)) AS first_id
        FROM later),
    kept AS (
        SELECT doc_id, string_agg(line, chr(10) ORDER BY raw_no) FILTER (first_id IS NULL) AS kept,
            count(first_id) AS n_removed,
            list_sort(coalesce(list(DISTINCT first_id) FILTER (first_id IS NOT NULL), [])) AS first_copies
        FROM raw LEFT JOIN gone USING (doc_id, raw_no) GROUP BY doc_id)
SELECT doc_id, CASE WHEN n_removed = 0 THEN text ELSE coalesce(kept, '') END AS text,
    n_removed, first_copies
FROM documents JOIN kept USING (doc_id)"""


def archive_records(pages: DataFrame) -> DataFrame:
    """A WARC record per page; a repeated payload refers to the smallest page that has it.

    A null ``html`` is an empty payload; pages without an id, and rows that repeat an id, are
    responses of their own. No pages give no records; other columns are not read.
    """
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        "page_id",
        F.col("url").alias("target_uri"),
        html.alias("payload"),
        F.sha2(html, 256).alias("digest"),
        F.octet_length(html).cast("long").alias("payload_length"),
    )
    large = rows.filter(F.col("payload_length") >= REVISIT_BYTES)
    firsts = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    firsts = firsts.filter("n > 1 and first is not null").select("digest", "first")
    rows = rows.join(common.stored(firsts, "firsts"), "digest", "left")
    revisit = (F.col("payload_length") >= REVISIT_BYTES) & (F.col("page_id") > F.col("first"))

    def record_id(column: str) -> F.Column:
        return F.concat(F.lit("<urn:page:"), F.col(column).cast("string"), F.lit(">"))

    return rows.select(
        record_id("page_id").alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.lit("2024-01-01T00:00:00Z").alias("date"),
        F.when(revisit, record_id("first")).alias("refers_to"),
        F.concat(F.lit("sha256:"), F.col("digest")).alias("payload_digest"),
        "payload_length",
        F.when(~F.coalesce(revisit, F.lit(False)), F.col("payload")).alias("payload"),
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to archives and read back: what each record says of its payload."""
    warc.register(spark)
    path = scratch_path(spark, "warc")
    archive_records(table(spark, sf_dir, "pages")).write.format("warc").mode("append").save(path)
    archive = spark.read.format("warc")
    responses = archive.load(path).filter("record_type = 'response'")
    revisits = archive.option("payload", "false").load(path).filter("record_type = 'revisit'")
    records = responses.unionByName(revisits)
    held = F.col("payload").isNotNull()
    stated = F.substring_index("payload_digest", ":", -1)
    return records.select(
        F.expr("try_cast(regexp_extract(record_id, '([0-9-]+)', 1) as bigint)").alias("page_id"),
        F.when(held, F.octet_length("payload")).otherwise(F.col("payload_length")).cast("long").alias("payload_bytes"),
        F.when(held, F.sha2("payload", 256)).otherwise(stated).alias("payload_digest"),
        "record_type",
        F.expr("try_cast(regexp_extract(refers_to, '([0-9-]+)', 1) as bigint)").alias("refers_to"),
    )


OP3_SQL = f"""WITH sized AS (
        SELECT page_id, encode(coalesce(html, '')) AS payload,
            sha256(coalesce(html, '')) AS payload_digest FROM pages),
    firsts AS (
        SELECT *, octet_length(payload) AS payload_bytes,
            min(page_id) OVER (PARTITION BY payload_digest) AS first FROM sized)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= {REVISIT_BYTES} AND page_id > first
        THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= {REVISIT_BYTES} AND page_id > first THEN first END AS refers_to
FROM firsts"""


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored ledger under the current policy; what is beyond the contract comes last."""
    entries = common.stored(quality.ledger(documents(spark, sf_dir)), "ledger")
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return entries.select(
        "doc_id",
        *base,
        (~quality.passes("failed_rules", "base")).alias("base_failed"),
        quality.passes("failed_rules").alias("kept"),
        *(name for name in entries.columns if name not in ("doc_id", *base)),
    )


QUALITY_MEASURES_SQL = r"""
    split AS (
        SELECT doc_id, coalesce(text, '') AS text,
            list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                        lambda w: w <> '') AS words,
            list_filter(string_split(coalesce(text, ''), chr(10)),
                        lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
        FROM documents),
    windows AS (
        SELECT doc_id, unnest(range(1, len(words) - 6)) AS i,
            unnest(list_transform(range(1, len(words) - 6),
                                  lambda k: array_to_string(words[k:k + 7], ' '))) AS w
        FROM split),
    found AS (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows),
    covered AS (
        SELECT doc_id, count(DISTINCT k) AS n_repeat_words
        FROM (SELECT doc_id, unnest(range(i, i + 8)) AS k FROM found WHERE n > 1)
        GROUP BY doc_id),
    measured AS (
        SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
            length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
            len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
            coalesce(n_repeat_words, 0) AS n_repeat_words,
            length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) AS n_upper
        FROM split LEFT JOIN covered USING (doc_id))"""
_BITS = " + ".join(
    f"CASE WHEN {rule} THEN {1 << bit} ELSE 0 END"
    for bit, rule in enumerate(quality.RULES.values())
)
OP4_SQL = f"""WITH {QUALITY_MEASURES_SQL},
    judged AS (SELECT *, {_BITS} AS failed_rules FROM measured)
SELECT *, failed_rules & {quality.mask(quality.POLICIES["base"])} <> 0 AS base_failed,
    failed_rules & {quality.mask(quality.POLICIES["v1"])} = 0 AS kept
FROM judged"""


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select(
        "doc_id", simhash.hex_digits().alias("fingerprint"), "component_id"
    )


def list_entries(pages: DataFrame) -> DataFrame:
    """A dated list made of the pages: each reports its host, or its site, on its day."""
    host = url_filters.host_of("url")
    site = F.substring_index(host, ".", -3)
    action = F.get(F.array(*map(F.lit, ("block", "allow", "lift"))), (F.col("page_id") % 3).cast("int"))
    return pages.select(
        F.when(F.col("page_id") % 8 == 0, site).otherwise(host).alias("pattern"),
        action.alias("action"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 365).cast("int")).alias("day"),
        F.col("page_id").alias("entry_id"),
    )


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a capture, judged by the list as of its fetch day."""
    pages = table(spark, sf_dir, "pages")
    fetched = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 7 % 365).cast("int"))
    captures = pages.select("page_id", "url", fetched.alias("day"))
    return url_filters.judge(captures, list_entries(pages)).drop("url")


OP10_SQL = """WITH hosted AS (
        SELECT page_id, nullif(rtrim(lower(regexp_extract(url,
            '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '.'), '') AS host
        FROM pages),
    reported AS (
        SELECT CASE WHEN page_id % 8 = 0
                THEN array_to_string(string_split(host, '.')[-3:], '.') ELSE host END AS pattern,
            ['block', 'allow', 'lift'][page_id % 3 + 1] AS action,
            DATE '2024-01-01' + (page_id % 365)::INT AS day, page_id
        FROM hosted WHERE host IS NOT NULL),
    daily AS (
        SELECT pattern, day, arg_max(action, page_id) AS action FROM reported GROUP BY ALL),
    valid AS (
        SELECT pattern, action, day AS since,
            lead(day) OVER (PARTITION BY pattern ORDER BY day) AS until FROM daily),
    captures AS (
        SELECT page_id, host, DATE '2024-01-01' + (page_id * 7 % 365)::INT AS day FROM hosted),
    met AS (
        SELECT page_id, action, pattern, since,
            row_number() OVER (PARTITION BY page_id ORDER BY length(pattern) DESC) AS n
        FROM captures JOIN valid
            ON (host = pattern OR suffix(host, '.' || pattern))
            AND since <= day AND (until IS NULL OR day < until)
        WHERE action <> 'lift')
SELECT page_id, day, host, coalesce(action, 'none') AS verdict, pattern, since
FROM captures LEFT JOIN (SELECT * FROM met WHERE n = 1) USING (page_id)"""


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors, their errors, and the codebooks' digest."""
    found, codebooks = vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))
    return found.withColumn("codebooks_sha256", F.lit(codebooks.digest()))


def _op11_sql() -> str:
    """Each round of the codebooks is a pair of subqueries."""
    parts, size, rounds = vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS
    assign = """near{r} AS MATERIALIZED (
        SELECT vec_id, p, gap, place
        FROM (SELECT vec_id, p, place,
                list_sum(list_transform(list_zip(x, e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT
                    AS gap
            FROM parts JOIN book{r} USING (p))
        QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY gap, place) = 1),"""
    update = """means{r} AS (
        SELECT p, place, d, floor(sum(x[d]) / count(*))::BIGINT AS c
        FROM near{r} JOIN parts USING (vec_id, p), generate_series(1, len(x)) g(d)
        GROUP BY p, place, d),
    book{next} AS MATERIALIZED (
        SELECT p, place, coalesce(m.e, b.e) AS e
        FROM book{r} b LEFT JOIN (
            SELECT p, place, list(c ORDER BY d) AS e FROM means{r} GROUP BY p, place) m
        USING (p, place)),"""
    steps = [
        assign.format(r=r) + ("\n    " + update.format(r=r, next=r + 1) if r < rounds else "")
        for r in range(rounds + 1)
    ]
    return f"""WITH kept AS MATERIALIZED (
        SELECT vec_id, label, list_transform(embedding,
            lambda x: floor({vector_codes.SCALE} * x::DOUBLE)::BIGINT) AS v,
            row_number() OVER (ORDER BY vec_id) - 1 AS n
        FROM embeddings
        WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
    parts AS MATERIALIZED (
        SELECT vec_id, p, n, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS x
        FROM kept, generate_series(0, {parts - 1}) g(p)),
    book0 AS MATERIALIZED (SELECT p, n AS place, x AS e FROM parts WHERE n < {size}),
    {" ".join(steps)}
    coded AS (
        SELECT vec_id, string_agg(format('{{:02x}}', place), '' ORDER BY p) AS code,
            sum(gap)::BIGINT AS error
        FROM near{rounds} GROUP BY vec_id)
SELECT vec_id, code, error,
    (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
    (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY p, place)) FROM book{rounds})
        AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)"""


OP11_SQL = _op11_sql()


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth row; every seventh has a label moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.hard_negatives(rows, F.col("id") % 100 == 0)


OP12_SQL = f"""WITH kept AS MATERIALIZED (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor({hard_negatives.SCALE} * x::DOUBLE)) AS v
        FROM embeddings
        WHERE label IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
    scored AS MATERIALIZED (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
            list_dot_product(a.v, b.v)::BIGINT AS score
        FROM kept a JOIN kept b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id)
            <= {hard_negatives.POSITIVES})
SELECT anchor_id, positive_id,
    (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INT
        AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND {hard_negatives.LEAST_PERCENT} * positive_score <= 100 * score
    AND score <= positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
    <= {hard_negatives.NEGATIVES}"""


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


OP13_SQL = """WITH hashed AS (
        SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))
            AS text_sha256
        FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM hashed WINDOW same AS (PARTITION BY text_sha256)"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_personal_data": op1_personal_data,
    "op2_line_dedup": op2_line_dedup,
    "op3_warc": op3_warc,
    "op4_quality_rules": op4_quality_rules,
    "op5_decontaminate": op5_decontaminate,
    "op6_token_store": op6_token_store,
    "op7_token_counts": op7_token_counts,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_simhash": op9_simhash,
    "op10_url_filters": op10_url_filters,
    "op11_vector_codes": op11_vector_codes,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_exact_dedup": op13_exact_dedup,
}

SQL: dict[str, str] = {
    "op2_line_dedup": OP2_SQL,
    "op3_warc": OP3_SQL,
    "op4_quality_rules": OP4_SQL,
    "op10_url_filters": OP10_SQL,
    "op11_vector_codes": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_exact_dedup": OP13_SQL,
}
