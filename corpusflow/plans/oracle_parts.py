"""SQL building blocks for the DuckDB checks.

Written from the rules, not from the Spark expressions: suffixes are tested one
by one, sentences are split by inserting and deleting marks, edges come from a
plain token join and ranks from a recursive query.
"""

from __future__ import annotations

from corpusflow.functions.words import GENERIC_KEYWORDS, STOP_WORDS, TOPIC_STOP_WORDS

WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"
NOT_SPACE = r"[^\t-\r\x1c-\x20\x85\p{Z}]"
STAMP = rf"\p{{Nd}}+\.\p{{Nd}}+pm?{SPACE}+BST"


def quoted(words) -> str:
    return ", ".join("'" + word.replace("'", "''") + "'" for word in words)


STOP = quoted(STOP_WORDS)
TOPIC_STOP = quoted(TOPIC_STOP_WORDS)
GENERIC = quoted(GENERIC_KEYWORDS)

ARTICLES = """articles AS (
  SELECT doc_id AS "ID",
         split_part(text, chr(10), 1) AS "Title",
         'https://example.com/' || doc_id AS "Url",
         source AS "Section",
         strftime(TIMESTAMP '2024-01-01 00:00:00'
                  + to_hours(CAST(doc_id % 8760 AS INTEGER)),
                  '%Y-%m-%d %H:%M:%S') AS "Published Date",
         CASE WHEN doc_id % 7 <> 0 THEN upper(lang) || ' desk' END AS "Author",
         text AS "Content"
  FROM documents)"""


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def words(c: str) -> str:
    return f"len(regexp_extract_all(coalesce({c}, ''), '{NOT_SPACE}+'))"


def strip_html(c: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(coalesce({c}, ''), '<[^>]+>', '', 'g'),"
        f" '{SPACE}+', ' ', 'g'))"
    )


def clean(c: str) -> str:
    untagged = f"regexp_replace(coalesce({c}, ''), '<[^>]+>', '', 'g')"
    kept = rf"regexp_replace({untagged}, '[^\p{{L}}\p{{N}}_\t-\r\x1c-\x20\x85\p{{Z}}]', ' ', 'g')"
    return f"lower(trim(regexp_replace({kept}, '{SPACE}+', ' ', 'g')))"


def tokens(c: str) -> str:
    return f"regexp_extract_all(lower(coalesce({c}, '')), '{WORD}+')"


def no_stop(lst: str) -> str:
    return f"list_filter({lst}, lambda t: t NOT IN ({STOP}))"


def stem_one(t: str) -> str:
    return f"""CASE
      WHEN ends_with({t}, 'ing') AND length({t}) > 5 THEN left({t}, length({t}) - 3)
      WHEN ends_with({t}, 'ed') AND length({t}) > 4 THEN left({t}, length({t}) - 2)
      WHEN ends_with({t}, 'er') AND length({t}) > 4 THEN left({t}, length({t}) - 2)
      WHEN ends_with({t}, 'est') AND length({t}) > 5 THEN left({t}, length({t}) - 3)
      WHEN ends_with({t}, 'ly') AND length({t}) > 4 THEN left({t}, length({t}) - 2)
      WHEN ends_with({t}, 's') AND length({t}) > 3 AND NOT ends_with({t}, 'ss')
        THEN left({t}, length({t}) - 1)
      ELSE {t} END"""


def stems(lst: str) -> str:
    return f"list_transform({lst}, lambda t: {stem_one('t')})"


def processed_list(c: str) -> str:
    return stems(no_stop(tokens(c)))


def joined(lst: str) -> str:
    return f"coalesce(array_to_string({lst}, ' '), '')"


def sentence_list(c: str) -> str:
    marked = rf"regexp_replace(coalesce({c}, ''), '([.?!])({SPACE})', '\1' || chr(1) || '\2', 'g')"
    marked = rf"regexp_replace({marked}, '({WORD}\.{WORD}[.?!])' || chr(1), '\1', 'g')"
    marked = rf"regexp_replace({marked}, '([A-Z][a-z]\.)' || chr(1), '\1', 'g')"
    trimmed = f"list_transform(string_split({marked}, chr(1)), lambda s: {strip('s')})"
    return f"list_filter({trimmed}, lambda s: s <> '')"


def sentence_rows(name: str, source: str, text: str) -> str:
    """CTE ``name(ID, pos, s)``: one row per sentence of ``source.text``."""
    return f"""{name} AS (
  SELECT "ID", unnest(generate_series(0, len(l) - 1)) AS pos, unnest(l) AS s
  FROM (SELECT "ID", {sentence_list(text)} AS l FROM {source}) WHERE len(l) > 0)"""


def scored(name: str, source: str) -> str:
    """CTE ``name(ID, pos, s, score, idx)`` over sentence rows, best first."""
    return f"""{name}_m AS (
  SELECT "ID", pos, s, {words('s')} AS w,
         len(regexp_extract_all(s, '{STAMP}')) AS stamps
  FROM {source}),
{name}_k AS (
  SELECT *,
         least(w * 0.1::DOUBLE, 5.0::DOUBLE)
         + CASE WHEN regexp_matches(s, '^\\p{{Lu}}') THEN 1.0::DOUBLE ELSE 0 END
         + CASE WHEN right(s, 1) IN ('.', '!', '?') THEN 1.0::DOUBLE ELSE 0 END
         - stamps * 0.5::DOUBLE
         + CASE WHEN starts_with(s, 'Here''s') OR starts_with(s, 'Updated at')
                  OR starts_with(s, 'Judges''') OR starts_with(s, 'Best dance')
                THEN 0 ELSE 1.0::DOUBLE END AS score
  FROM {name}_m
  WHERE w >= 10
    AND NOT regexp_matches(s, '^{STAMP}')
    AND NOT regexp_matches(s, '^Updated at {STAMP}')
    AND NOT (stamps > 0 AND w < 20)
    AND NOT (starts_with(s, 'Here''s') AND w < 15)),
{name} AS (
  SELECT "ID", pos, s, score,
         row_number() OVER (PARTITION BY "ID" ORDER BY score DESC, pos) - 1 AS idx
  FROM {name}_k)"""


def edges(prefix: str, source: str) -> str:
    """CTEs ``prefix_nodes(ID, node, n)`` and ``prefix_edges(ID, src, dst, weight)``
    over sentence rows ``source(ID, pos, s)``."""
    return f"""{prefix}_nodes AS MATERIALIZED (
  SELECT "ID", pos AS node, count(*) OVER (PARTITION BY "ID") AS n,
         list_distinct({processed_list('s')}) AS toks
  FROM {source}),
{prefix}_toks AS MATERIALIZED (
  SELECT "ID", node, len(toks) AS size, unnest(toks) AS tok FROM {prefix}_nodes),
{prefix}_edges AS MATERIALIZED (
  SELECT "ID", src, dst, c / (sa + sb - c) AS weight
  FROM (SELECT a."ID" AS "ID", a.node AS src, b.node AS dst, a.size AS sa,
               b.size AS sb, count(*)::DOUBLE AS c
        FROM {prefix}_toks a JOIN {prefix}_toks b
          ON a."ID" = b."ID" AND a.tok = b.tok AND a.node < b.node
        GROUP BY ALL)
  WHERE c / (sa + sb - c) > 0.1::DOUBLE)"""


def ranks(prefix: str) -> str:
    """CTE ``prefix_ranks(ID, node, x)`` by power iteration; needs WITH RECURSIVE."""
    return f"""{prefix}_both AS (
  SELECT "ID", src, dst, weight FROM {prefix}_edges
  UNION ALL SELECT "ID", dst, src, weight FROM {prefix}_edges),
{prefix}_links AS MATERIALIZED (
  SELECT "ID", src, dst,
         weight / sum(weight) OVER (PARTITION BY "ID", src) AS share
  FROM {prefix}_both),
{prefix}_start AS MATERIALIZED (
  SELECT v."ID" AS "ID", v.node AS node, v.n AS n,
         NOT EXISTS (SELECT 1 FROM {prefix}_both b
                     WHERE b."ID" = v."ID" AND b.src = v.node) AS isolated
  FROM {prefix}_nodes v WHERE v.n >= 2),
{prefix}_power AS (
  SELECT 0 AS k, "ID", node, n, isolated, 1.0::DOUBLE / n AS x,
         NULL::DOUBLE AS change
  FROM {prefix}_start
  UNION ALL
  SELECT k, "ID", node, n, isolated, x,
         sum(abs(x - old)) OVER (PARTITION BY "ID") AS change
  FROM (
    SELECT p.k + 1 AS k, p."ID" AS "ID", p.node AS node, p.n AS n,
           p.isolated AS isolated, p.x AS old,
           0.15::DOUBLE / p.n + 0.85::DOUBLE * (
             coalesce(f.inflow, 0)
             + sum(CASE WHEN p.isolated THEN p.x ELSE 0 END)
                 OVER (PARTITION BY p."ID") / p.n) AS x
    FROM {prefix}_power p
    LEFT JOIN (SELECT l."ID" AS "ID", l.dst AS dst, sum(q.x * l.share) AS inflow
               FROM {prefix}_power q
               JOIN {prefix}_links l ON l."ID" = q."ID" AND l.src = q.node
               GROUP BY l."ID", l.dst) f
      ON f."ID" = p."ID" AND f.dst = p.node
    WHERE p.k < 100 AND (p.change IS NULL OR p.change >= p.n * 1e-6::DOUBLE))),
{prefix}_ranks AS (
  SELECT "ID", node, x FROM {prefix}_power
  QUALIFY k = max(k) OVER (PARTITION BY "ID"))"""


def summaries(
    source: str, name: str = "summaries", share: float = 0.1, fixed: int | None = None
) -> str:
    """CTE ``name(ID, summary, summary_length, compression_ratio)`` for ``source``.

    The number of sentences follows from ``share``, or is ``fixed``.
    """
    by_share = f"""CASE WHEN total > 1 THEN least(total, greatest(1, floor(
           greatest(1, floor(w * {share}::DOUBLE)) / (w / total::DOUBLE))::BIGINT))
           ELSE 1 END"""
    wanted = by_share if fixed is None else str(fixed)
    whole = "total <= 1" if fixed is None else "total = 0"
    return f"""sm_raw AS (
  SELECT "ID", "Content" AS c, {words('"Content"')} AS w FROM {source}),
{sentence_rows('sm_sents', source, '"Content"')},
sm_count AS (
  SELECT "ID", count(*) AS total,
         string_agg(s, ' ' ORDER BY pos) FILTER (pos < 3) AS head
  FROM sm_sents GROUP BY "ID"),
{scored('sm_scored', 'sm_sents')},
sm_kept AS (
  SELECT "ID", count(*) AS kept, string_agg(s, ' ' ORDER BY idx) AS txt
  FROM sm_scored GROUP BY "ID"),
sm_plan AS (
  SELECT r."ID" AS "ID", c, w, coalesce(total, 0) AS total, head,
         coalesce(kept, 0) AS kept, txt,
         {wanted} AS wanted
  FROM sm_raw r LEFT JOIN sm_count USING ("ID") LEFT JOIN sm_kept USING ("ID")),
sm_rank_in AS (
  SELECT "ID", txt FROM sm_plan WHERE kept > wanted),
{sentence_rows('sm_resplit', 'sm_rank_in', 'txt')},
{edges('sm', 'sm_resplit')},
{ranks('sm')},
sm_top AS (
  SELECT r."ID" AS "ID", r.node AS idx FROM (
    SELECT "ID", node, row_number() OVER (
      PARTITION BY "ID" ORDER BY round(x, 9) DESC, node) AS rn FROM sm_ranks) r
  JOIN sm_plan p USING ("ID") WHERE r.rn <= p.wanted
  UNION ALL
  SELECT s."ID", s.idx FROM sm_scored s JOIN sm_plan p USING ("ID")
  WHERE s.idx < p.wanted AND s."ID" NOT IN (SELECT "ID" FROM sm_ranks)),
sm_ranked AS (
  SELECT t."ID" AS "ID", string_agg(s.s, ' ' ORDER BY s.idx) AS ranked
  FROM sm_top t JOIN sm_scored s ON s."ID" = t."ID" AND s.idx = t.idx GROUP BY t."ID"),
sm_text AS (
  SELECT p."ID" AS "ID", w,
         CASE WHEN c IS NULL THEN '' WHEN {whole} THEN c
              WHEN kept = 0 THEN head WHEN kept <= wanted THEN txt
              ELSE ranked END AS summary
  FROM sm_plan p LEFT JOIN sm_ranked USING ("ID")),
{name} AS (
  SELECT "ID", summary, {words('summary')} AS summary_length,
         CASE WHEN w > 0 THEN {words('summary')} / w::DOUBLE ELSE 0 END
           AS compression_ratio
  FROM sm_text)"""
