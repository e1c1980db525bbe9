"""Sentence graphs: one graph per article, ranked by weighted PageRank.

Three physical forms give the same ranks:

* *Row-local*: an article with few sentences is ranked where its row is, with the others
  of its batch.  No shuffle at all; the bulk of any news corpus goes here.
* *Joined*: an article whose sentence count may exceed ``Limits.row_local`` is spread over the cluster by ``(article, token)`` and its edges are found by
  an equi-join, so that one long text is never one long task.

* *Spread*: beyond ``Limits.row_ranked`` the rounds of PageRank are joins too, on
  stored edges, so that the edges of one article never have to fit a task.

The split is made on a bound that is cheap to compute and proven:
``max_sentences`` (sentence-ending marks plus one) is never below the real
sentence count.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusflow.functions.expr import bind, sql_let, sql_runs
from corpusflow.functions.sentences import max_sentences, split_sentences
from corpusflow.functions.sentences import token_sets as sentence_sets
from corpusflow.operators import pagerank
from corpusflow.operators.pagerank import DAMPING, MAX_ROUNDS, MIN_SIMILARITY, TOLERANCE
from corpusflow.sources import buckets, files, workers
from corpusflow.sources.scratch import fixed, kept, passing, scratch_path, without_shuffles

#: Sentences of one token that are one key of a join.
BLOCK_SENTENCES = 1000
#: Rounds of joins between two writes of the ranks.
ROUNDS_A_WRITE = 5


def sentences(df: DataFrame, text: str = "Content", key: str = "ID") -> DataFrame:
    """One row per sentence: ``(key, pos, sentence)``."""
    return df.select(
        key, F.posexplode(split_sentences(F.col(text))).alias("pos", "sentence")
    )


def token_sets(text: Column) -> Column:
    """Distinct processed tokens per sentence: ``array<array<string>>``."""
    return sentence_sets(split_sentences(text))


def _sql_entries(sets: str) -> str:
    """All ``struct<token, node>`` of a graph, sorted."""
    return f"""sort_array(flatten(transform({sets}, (ts, i) ->
        transform(ts, t -> named_struct('token', t, 'node', i)))))"""


def sql_edges(sets: str) -> str:
    """``edges_of`` as SQL text."""
    n = f"cast(size({sets}) as bigint)"
    pairs = """flatten(transform(near, (u, k) ->
        transform(slice(near, k + 2, size(near)), v -> u * nn + v)))"""
    near = sql_let("slice(ns, r.start + 1, r.length)", "near", pairs)
    shared_tokens = f"filter({sql_runs('es.token', 'a')}, r -> r.length > 1)"
    codes = f"flatten(transform({shared_tokens}, r -> {near}))"
    codes = sql_let(_sql_entries(sets), "es", sql_let("es.node", "ns", codes))
    pair = """named_struct('src', cast(c div nn as int), 'dst', cast(c % nn as int),
                           'shared', r.length)"""
    overlaps = f"""transform({sql_runs('cs', 'b')}, r ->
        {sql_let('get(cs, r.start)', 'c', pair)})"""
    weighted = f"""transform({overlaps}, o -> named_struct(
        'src', o.src, 'dst', o.dst, 'weight',
        o.shared / (size({sets}[o.src]) + size({sets}[o.dst]) - o.shared)))"""
    edges = f"filter({weighted}, e -> e.weight > {MIN_SIMILARITY}D)"
    return sql_let(n, "nn", sql_let(f"sort_array({codes})", "cs", edges))


def edges_of(sets: Column) -> Column:
    """Edges of one graph, each once: ``array<struct<src, dst, weight>>``.

    Works on sorted arrays: the (token, node) entries sorted by token give, run
    by run, the sentences that share a token; the pairs of each run, sorted,
    give the number of shared tokens as a run length.  Pairs without a shared
    token are never looked at.
    """
    return bind(sets, "sets", sql_edges("sets"))


@dataclass(frozen=True)
class Limits:
    """How articles are worked on by size; the results are the same.

    ``row_local``: at most this many sentences squared are compared inside one row.
    ``row_ranked``: up to this many sentences the edges of one article are ranked in one
    task; beyond it the rounds of PageRank are joins as well.
    """

    row_local: int = 400
    row_ranked: int = 2000


LIMITS = Limits()


@dataclass(frozen=True)
class BySize:
    """Articles by the way they are worked on; ``joined`` and ``spread`` have a ``row`` id."""

    local: DataFrame
    joined: DataFrame | None
    spread: DataFrame | None


def by_size(df: DataFrame, text: str, row: str, limits: Limits = LIMITS) -> BySize:
    """Row-local, joined and spread articles; None if there are none.

    The few long articles are written once, with an id of their own in column ``row``, so
    that later joins neither read the texts again nor rely on a key of the input.
    """
    most = F.coalesce(max_sentences(F.col(text)), F.lit(0))
    long = df.filter(most > limits.row_local)
    long = fixed(long.withColumn(row, F.monotonically_increasing_id()), "long")
    local = df.filter(most <= limits.row_local)
    huge = most > max(limits.row_ranked, limits.row_local)
    sizes = {r["huge"] for r in long.select(huge.alias("huge")).distinct().collect()}
    return BySize(
        local,
        long.filter(~huge) if False in sizes else None,
        long.filter(huge) if True in sizes else None,
    )


# --- long articles ---------------------------------------------------------


def shared_ids(sets: Column, block: int = BLOCK_SENTENCES) -> Column:
    """Tokens as numbers, rarest first: ``array<struct<node, size, ids, at>>``.

    ``size`` counts all tokens of the sentence.  Only tokens of at least two
    sentences get a number, in order of how many sentences have them; a sentence
    without such a token is left out.  The sentences of a token are cut into blocks
    of ``block`` in their order: ``at`` has, for each of ``ids``, the sentence's
    ``block`` and how many ``blocks`` the token has.
    """
    runs = f"filter({sql_runs('es.token', 'a')}, r -> r.length > 1)"
    rarest_first = f"""sort_array(transform({runs}, r ->
        named_struct('length', r.length, 'start', r.start)))"""
    pairs = f"""sort_array(flatten(transform({rarest_first}, (r, id) ->
        transform(slice(es, r.start + 1, r.length), (e, i) ->
            named_struct('node', e.node, 'id', id,
                'block', cast(i div {block} as int),
                'blocks', cast((r.length - 1) div {block} + 1 as int))))))"""
    sentence = """named_struct('node', ns[r.start], 'size', size(sets[ns[r.start]]),
        'ids', slice(ids, r.start + 1, r.length),
        'at', transform(slice(ps, r.start + 1, r.length),
            p -> named_struct('block', p.block, 'blocks', p.blocks)))"""
    per_node = f"transform({sql_runs('ns', 'b')}, r -> {sentence})"
    listed = sql_let("ps.node", "ns", sql_let("ps.id", "ids", per_node))
    numbered = sql_let(_sql_entries("sets"), "es", sql_let(pairs, "ps", listed))
    return bind(sets, "sets", numbered)


def sentence_nodes(df: DataFrame, text: str, key: str) -> DataFrame:
    """``(key, sets)``: the token sets of each article."""
    return df.select(key, token_sets(F.col(text)).alias("sets"))


def pair_entries(nodes: DataFrame, key: str, block: int = BLOCK_SENTENCES) -> tuple:
    """Both sides of ``joined_edges``: ``(key, node, size, ids, token, left, low, high)``.

    ``left`` counts the sentence's numbered tokens from this one on.

    A token's sentences meet as pairs of its blocks, ``low <= high``: a sentence of the
    left side meets its own block and all later ones, one of the right side its own and
    all earlier ones.  So a pair of blocks has at most ``block`` rows a side, however
    many sentences share the token, and no pair of sentences meets twice.
    """
    return _sides(_entries(nodes, key, block), key)


def _entries(nodes: DataFrame, key: str, block: int) -> DataFrame:
    """``(key, node, size, ids, token, left, block, blocks)``: what sentences are met by."""
    ids = shared_ids(F.col("sets"), block)
    # Written once: it is read several times, and the texts need no second look.
    listed = kept(nodes.select(key, F.inline(ids).alias("node", "size", "ids", "at")), "entries")
    # Tokens of one sentence only come first and match nothing: skip them.
    prefix = F.size("ids") - F.floor(F.col("size") / 10).cast("int")
    first = F.slice(F.arrays_zip("ids", "at"), F.lit(1), F.greatest(prefix, F.lit(0)))
    entries = listed.select(key, "node", "size", "ids", F.posexplode(first).alias("place", "entry"))
    return entries.select(
        key,
        "node",
        "size",
        "ids",
        F.col("entry.ids").alias("token"),
        (F.size("ids") - F.col("place")).alias("left"),
        F.col("entry.at.block").alias("block"),
        F.col("entry.at.blocks").alias("blocks"),
    )


def _sides(entries: DataFrame, key: str) -> tuple:
    own, count = F.col("block"), F.col("blocks")

    def side(low: Column, high: Column) -> DataFrame:
        pair = F.explode(F.sequence(low, high)).alias("other")
        return entries.select(*columns, own.alias("own"), pair)

    columns = [key, "node", "size", "ids", "token", "left"]
    left = side(own, count - 1).select(*columns, F.col("own").alias("low"), F.col("other").alias("high"))
    right = side(F.lit(0), own).select(*columns, F.col("other").alias("low"), F.col("own").alias("high"))
    return left, right


def joined_edges(nodes: DataFrame, key: str, block: int = BLOCK_SENTENCES) -> DataFrame:
    """``(key, src, dst, weight)``, each edge once with ``src < dst``.

    A prefix join.  Similarity above 0.1 means that more than a tenth of the
    larger token set is shared.  So in any order common to all sentences, the
    first shared token of an edge is among the first ``size - floor(size / 10)``
    tokens of both ends; with the rarest token first, the tokens most sentences
    have are the ones left out.  A pair is accepted only at its *first* shared
    token, so each edge is found exactly once, and the similarity test is part of
    the join condition, so pairs that are not edges never leave the join.  The tokens
    behind the first shared one bound how many are shared, so most pairs that meet at a
    token of many sentences are turned down by their sizes alone.  A token of very many
    sentences is many keys of the join, see ``pair_entries``.
    """
    entries = _entries(nodes, key, block)
    # Both sides of most tokens are the same rows, which move once for both.
    alone = entries.filter("blocks = 1").drop("block", "blocks")
    found = _met(alone, alone, key, ["token"])
    several = _sides(entries.filter("blocks > 1"), key)
    return found.unionByName(_met(*several, key, ["token", "low", "high"]))


def _met(left: DataFrame, right: DataFrame, key: str, by: list[str]) -> DataFrame:
    """The edges between entries of two sides that are equal in ``key`` and ``by``."""
    # Never broadcast: the size of the exploded side is not known when planning.
    a, b = left.alias("a").hint("merge"), right.alias("b")
    shared = F.array_intersect("a.ids", "b.ids")
    sizes = F.col("a.size") + F.col("b.size")
    # shared / (sizes - shared) > 0.1, in whole numbers
    condition = (
        reduce(and_, (F.col(f"a.{name}") == F.col(f"b.{name}") for name in (key, *by)))
        & (F.col("a.node") < F.col("b.node"))
        & (F.least("a.left", "b.left") * 11 > sizes)
        & (F.get(shared, F.lit(0)) == F.col("a.token"))
        & (F.size(shared) * 11 > sizes)
    )
    overlap = F.size(shared)
    return a.join(b, condition).select(
        F.col(f"a.{key}").alias(key),
        F.col("a.node").alias("src"),
        F.col("b.node").alias("dst"),
        (overlap / (sizes - overlap)).alias("weight"),
    )


def linked_edges(nodes: DataFrame, key: str) -> DataFrame:
    """``(key, linked)``: the edges of an article that has any, in no certain order."""
    edge = F.struct("src", "dst", "weight")
    return joined_edges(nodes, key).groupBy(key).agg(F.collect_list(edge).alias("linked"))


# --- huge articles ---------------------------------------------------------


def _round(state: DataFrame, shares: DataFrame, key: str) -> DataFrame:
    """One round: the newest of ``xs`` and ``zs`` moved along the shares and appended.

    Shares stay where they are, and one aggregation brings each node its inflow together
    with its own row, dealt out as the next round needs it.  That row travels as single
    numbers: an aggregation of arrays would have to sort all that moves.
    """
    mine = F.col("share").isNull()
    places = range(ROUNDS_A_WRITE)  # no more are in ``xs`` before a round
    numbers = {"n": F.col("n"), "alone": F.col("alone")}
    numbers |= {f"{c}{i}": F.get(f"{c}s", F.lit(i)) for c in "xz" for i in places}
    moved = shares.join(state.hint("shuffle_hash"), [key, "node"]).select(
        key,
        F.col("to").alias("node"),
        (F.element_at("xs", -1) * F.col("share")).alias("flow"),
        *(F.when(mine, number).alias(name) for name, number in numbers.items()),
    )
    met = moved.groupBy(key, "node").agg(
        F.sum("flow").alias("inflow"), *(F.max(name).alias(name) for name in numbers)
    )
    row = met.select(
        key,
        "node",
        "inflow",
        "n",
        "alone",
        *(F.array_compact(F.array(*(f"{c}{i}" for i in places))).alias(f"{c}s") for c in "xz"),
    )
    passed = F.col("alone") * F.element_at("zs", -1) * DAMPING
    base = (F.lit(1.0 - DAMPING) + passed) / F.col("n")
    return row.select(
        key,
        "node",
        "n",
        "alone",
        F.array_append("xs", base + F.col("inflow") * DAMPING).alias("xs"),
        F.array_append("zs", base).alias("zs"),
    )


def _last_rounds(state: DataFrame, key: str, rounds: int, end: bool) -> DataFrame:
    """``(key, last)``: after which of the latest ``rounds`` an article stops; null: goes on."""
    changes = [
        F.sum(F.abs(F.get("xs", F.lit(r + 1)) - F.get("xs", F.lit(r))))
        + F.max(F.col("alone") * F.abs(F.get("zs", F.lit(r + 1)) - F.get("zs", F.lit(r))))
        for r in range(rounds)
    ]
    small = [F.when(c < F.max("n") * F.lit(TOLERANCE), r + 1) for r, c in enumerate(changes)]
    at_end = F.lit(rounds if end else None).cast("int")
    return state.groupBy(key).agg(F.coalesce(*small, at_end).alias("last"))


def _shares(edges: DataFrame, key: str, parts: int) -> DataFrame:
    """``(key, node, to, share)``, dealt out by ``(key, node)``: how rank flows along the edges.

    A share of null to itself carries a node's own row along.  Edges move once, and all of a
    node meet there.
    """
    both = edges.select(
        key,
        F.inline(
            F.array(
                F.struct(F.col("src").alias("node"), F.col("dst").alias("to"), "weight"),
                F.struct(F.col("dst").alias("node"), F.col("src").alias("to"), "weight"),
            )
        ),
    )
    node = Window.partitionBy(key, "node")
    weighed = both.repartition(parts, key, "node").select(
        key,
        "node",
        "to",
        (F.col("weight") / F.sum("weight").over(node)).alias("share"),
        F.row_number().over(node.orderBy("to")).alias("number"),
    )
    own = F.struct("to", "share")
    itself = F.struct(F.col("node").alias("to"), F.lit(None).cast("double").alias("share"))
    listed = F.when(F.col("number") == 1, F.array(own, itself)).otherwise(F.array(own))
    return weighed.select(key, "node", F.inline(listed))


def spread_ranks(nodes: DataFrame, key: str) -> DataFrame:
    """``(key, n, linked, rest)``: the rules of ``pagerank.ranks`` as rounds of joins.

    ``linked`` is ``array<struct<node, rank>>`` for the nodes with neighbours, and
    ``rest`` is the rank of each of the others.  Articles without any edge do not
    appear.  An article stops at its own last round.

    The shares of rank that flow along the edges are written once, in buckets of their
    source, and never move again.  ``ROUNDS_A_WRITE`` rounds are one plan; the ranks of
    all its rounds are written, and one aggregation over them finds where each article
    stops.  What later rounds do not read is deleted.
    """
    spark = nodes.sparkSession
    root = scratch_path(spark, "ranks")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with passing(spark):  # the edges and what they are found by go when the shares are there
        shares = _shares(kept(joined_edges(nodes, key), "edges"), key, parts)
        buckets.write_bucketed(shares, f"{root}/shares", [key, "node"], parts, in_buckets=True)
    shares = buckets.read_bucketed(spark, f"{root}/shares", shares.schema, [key, "node"], parts)

    connected = shares.filter("share IS NULL").select(key, "node")
    known = connected.groupBy(key).agg(F.count("*").alias("connected"))
    # One row per article.
    sizes = nodes.select(key, F.size("sets").cast("double").alias("n")).join(known, key)
    start = F.array(1.0 / F.col("n"))
    state = connected.join(sizes, key).select(
        key,
        "node",
        "n",
        (F.col("n") - F.col("connected")).alias("alone"),
        start.alias("xs"),
        start.alias("zs"),
    )
    state = _kept(state, f"{root}/0", None)
    done, number, before = 0, 0, f"{root}/0"
    ended = spark.createDataFrame([], state.drop("xs", "zs").schema.add("x", "double").add("z", "double"))
    ended.write.parquet(f"{root}/ended")
    while done < MAX_ROUNDS:
        rounds = min(ROUNDS_A_WRITE, MAX_ROUNDS - done)
        for _ in range(rounds):
            state = _round(state, shares, key)
        number, done = number + 1, done + rounds
        state = _kept(state, f"{root}/{number}", before)
        before = f"{root}/{number}"
        last = kept(_last_rounds(state, key, rounds, done >= MAX_ROUNDS), "last")
        with without_shuffles(spark):
            kinds = {r["on"] for r in last.select(F.isnull("last").alias("on")).distinct().collect()}
        marked = state.join(last, key)
        if False in kinds:
            stopped = marked.filter("last IS NOT NULL").select(
                key,
                "node",
                "n",
                "alone",
                F.get("xs", F.col("last")).alias("x"),
                F.get("zs", F.col("last")).alias("z"),
            )
            with without_shuffles(spark):
                stopped.write.mode("append").option("compression", "zstd").parquet(f"{root}/ended")
        if True not in kinds:
            break
        state = marked.filter("last IS NULL").select(
            key,
            "node",
            "n",
            "alone",
            F.slice("xs", -1, 1).alias("xs"),
            F.slice("zs", -1, 1).alias("zs"),
        )
    files.delete(spark, before)
    files.delete(spark, f"{root}/shares")
    # Linear in the article's text, which is one row already.
    nodes_of = F.collect_list(F.struct("node", F.col("x").alias("rank")))
    ranked = spark.read.schema(ended.schema).parquet(f"{root}/ended")
    return ranked.groupBy(key).agg(
        F.max("n").cast("int").alias("n"),
        F.sort_array(nodes_of).alias("linked"),
        F.max("z").alias("rest"),
    )


def _kept(state: DataFrame, path: str, before: str | None) -> DataFrame:
    """``state`` written and read again; what it was made from goes."""
    with without_shuffles(state.sparkSession):
        state.write.option("compression", "zstd").parquet(path)
    if before is not None:
        files.delete(state.sparkSession, before)
    return state.sparkSession.read.schema(state.schema).parquet(path)


def dense_ranks(n: Column, linked: Column, rest: Column) -> Column:
    """All ranks by node from the columns of ``spread_ranks``.

    Without them (null), all ``n`` nodes have the same rank.
    """
    bare = """transform(array_repeat(0, v.n), (_, i) ->
        named_struct('node', i, 'bare', 1, 'rank', v.rest))"""
    known = """transform(v.linked, e ->
        named_struct('node', e.node, 'bare', 0, 'rank', e.rank))"""
    first = f"transform({sql_runs('es.node', 'a')}, r -> es[r.start].rank)"
    every = sql_let(f"sort_array(concat({known}, {bare}))", "es", first)
    some = F.coalesce(linked, F.array().cast("array<struct<node:int,rank:double>>"))
    even = F.coalesce(rest, F.try_divide(F.lit(1.0), n))
    value = F.struct(n.alias("n"), some.alias("linked"), even.alias("rest"))
    return bind(value, "v", f"if(v.n >= 2, {every}, null)")


# --- operators -------------------------------------------------------------


def sentence_edges(
    df: DataFrame, text: str = "Content", key: str = "ID", limits: Limits = LIMITS
) -> DataFrame:
    """Edges of every article's sentence graph: ``(key, src, dst, weight)``.

    Articles with equal keys have graphs of their own.
    """
    most = F.coalesce(max_sentences(F.col(text)), F.lit(0))
    edges = edges_of(token_sets(F.col(text)))
    short = df.filter(most <= limits.row_local).select(key, F.inline(edges))
    row = F.struct(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"))
    rest = df.filter(most > limits.row_local).withColumn("_row", row)
    long = joined_edges(sentence_nodes(rest, text, "_row"), "_row")
    return short.unionByName(long.select(F.col("_row.key").alias(key), "src", "dst", "weight"))


def pagerank_by_doc(
    df: DataFrame, text: str = "Content", key: str = "ID", limits: Limits = LIMITS
) -> DataFrame:
    """``(key, node, rank)`` of every article with at least two sentences."""
    content = F.col(text)
    workers.find_package(df.sparkSession)
    sized = by_size(df.select(key, text), text, "_row", limits)
    ranks = [sized.local.select(key, pagerank.ranks_of_sets(token_sets(content)).alias("ranks"))]
    n = F.size(split_sentences(content)).alias("n")
    if sized.joined is not None:
        linked = linked_edges(sentence_nodes(sized.joined, text, "_row"), "_row")
        rows = sized.joined.select("_row", key, n).join(linked, "_row", "left")
        dense = pagerank.ranks_of_edges(F.col("n"), F.col("linked"))
        ranks.append(rows.select(key, dense.alias("ranks")))
    if sized.spread is not None:
        found = spread_ranks(sentence_nodes(sized.spread, text, "_row"), "_row").drop("n")
        rows = sized.spread.select("_row", key, n).join(found, "_row", "left")
        dense = dense_ranks(F.col("n"), F.col("linked"), F.col("rest"))
        ranks.append(rows.select(key, dense.alias("ranks")))

    every = [
        part.select(key, F.posexplode(bind(F.col("ranks"), "rk", "rk")).alias("node", "rank"))
        for part in ranks
    ]
    result = every[0]
    for part in every[1:]:
        result = result.unionByName(part)
    return result
