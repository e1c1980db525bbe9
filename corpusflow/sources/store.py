"""The article store: immutable Parquet folders under one path, and a log of versions.

``articles/write=<id>/batch=<label>/``    the article rows of one write, by batch
``statistics/write=<id>/``                that write's counts and bounds, by batch and section
``terms/part=<id>/write=<id>/batch=<label>/``  term counts, made when first needed
``index/part=<id>/``                      trigrams of files, made when first searched
``keys/part=<id>/``                       least and largest ID of files, made when first updated
``base/write=<id>/``                      consolidated rows, bucketed by ``ID``
``topics/run=<label>/``                   ``(ID, Topic)`` of one topic run, bucketed as the base
``metadata/run=<label>/``                 that run's parameters and keywords
``log/``                                  numbered commits that name the folders of each version

An update writes new folders and leaves earlier ones alone.  What no commit names is not
read, so a half-written batch does not exist; repeating a label replaces its batch.  Any
number of writers may append at a time.
"""

from __future__ import annotations

import dataclasses
import datetime
import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

from corpusflow.operators import features, search, stats
from corpusflow.operators.windows import assign_ids
from corpusflow.sources import buckets, exports, files, log, text_index
from corpusflow.sources.scratch import without_shuffles

BATCH = "batch"
WRITE = "write"
#: The text whose terms are counted.
TERMS_OF = "processed_text"
#: The texts that a search reads.
SEARCHED = ("Title", "Content")
#: Characters of each text that order new rows.
ORDER_CHARS = 64
#: Articles of a bucket that consolidation aims at.
BUCKET_ARTICLES = 1 << 20
#: How article rows are written.  The token arrays are most of a store, and their words repeat
#: all over it: with 1 MB, the default, a file's dictionary is soon full and given up.
WRITTEN = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "6",  # 3, the default, takes 5 % more
    "parquet.dictionary.page.size": str(8 << 20),
}
LABELS = StructType([StructField("ID", LongType()), StructField("Topic", IntegerType())])


def new_label() -> str:
    """Sorts by time; unique without looking at the store."""
    now = datetime.datetime.now(datetime.timezone.utc)
    return f"{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def store_exists(spark: SparkSession, path: str) -> bool:
    state = log.read(spark, path)
    return bool(state.batches or state.base)


def current_version(spark: SparkSession, path: str) -> int:
    """A snapshot: this number reads what the store holds now, whatever is written later."""
    return log.read(spark, path).version


# --- reading -----------------------------------------------------------------


def store_schema(state: log.State) -> StructType:
    """All columns of all parts, in order of first appearance."""
    numbers = [b["schema"] for b in state.batches.values()]
    numbers = ([state.base["schema"]] if state.base else []) + numbers
    fields: dict[str, StructField] = {}
    for number in dict.fromkeys(numbers):
        for field in StructType.fromJson(json.loads(state.schemas[number])).fields:
            fields.setdefault(field.name, field)
    return StructType(list(fields.values()))


def batch_places(state: log.State) -> dict[str, list[str]]:
    """Where the rows of batches lie under ``articles``, and the files there that have none."""
    return {
        f"{WRITE}={write}/{BATCH}={label}": gone
        for label, b in state.batches.items()
        for write, gone in b["parts"]
    }


def batch_paths(spark: SparkSession, path: str, state: log.State) -> list[str]:
    """Folders of the batches; the single files of a folder that has replaced ones."""
    found = []
    for place, gone in batch_places(state).items():
        folder = f"{path}/articles/{place}"
        names = set(files.data_names(spark, folder)) - set(gone) if gone else None
        found += [folder] if names is None else [f"{folder}/{name}" for name in sorted(names)]
    return found


def base_folder(path: str, state: log.State) -> str:
    return f"{path}/base/{WRITE}={state.base['folder']}"


def base_names(state: log.State) -> list[str]:
    """The files of the base's folder that this version reads."""
    return sorted(name for names in state.base["files"].values() for name in names)


def recent_rows(spark: SparkSession, path: str, state: log.State) -> DataFrame:
    """Rows of the batches that are not consolidated, with their ``batch``."""
    columns = StructType([*store_schema(state).fields, StructField(BATCH, StringType())])
    read = spark.read.schema(StructType([*columns.fields, StructField(WRITE, StringType())]))
    folders = batch_paths(spark, path, state)
    rows = read.option("basePath", f"{path}/articles").parquet(*folders) if folders else None
    if rows is None:
        return spark.createDataFrame([], columns)
    return rows.select(*(F.col(f"`{name}`") for name in columns.names))


def base_schema(state: log.State) -> StructType:
    own = StructType.fromJson(json.loads(state.schemas[state.base["schema"]]))
    return StructType([*own.fields, StructField(BATCH, StringType())])


def base_rows(spark: SparkSession, path: str, state: log.State) -> DataFrame:
    """Rows of the consolidated part, bucketed, with their ``batch``."""
    folder, names = base_folder(path, state), base_names(state)
    rows = buckets.read_bucketed(spark, folder, base_schema(state), ["ID"], state.base["buckets"])
    if files.data_names(spark, folder) == names:
        return rows
    # Other versions have other files there.
    return rows.filter(F.col("_metadata.file_name").isin(names)).select(*rows.columns)


def _parts(spark: SparkSession, path: str, state: log.State) -> list[DataFrame]:
    parts = [base_rows(spark, path, state)] if state.base else []
    return parts + ([recent_rows(spark, path, state)] if state.batches or not parts else [])


def _together(parts: list[DataFrame], columns: list[str]) -> DataFrame:
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows.select(*(F.col(f"`{name}`") for name in columns))


def read_batches(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Article rows with their ``batch``; columns that a batch lacks are null."""
    state = log.read(spark, path, version)
    return _together(_parts(spark, path, state), [*store_schema(state).names, BATCH])


def latest_run(spark: SparkSession, path: str, version: int | None = None) -> str | None:
    runs = log.read(spark, path, version).runs
    return runs[-1]["label"] if runs else None


def _labels(spark: SparkSession, path: str, run: dict) -> DataFrame:
    folder = f"{path}/topics/run={run['folder']}"
    if run["buckets"]:
        return buckets.read_bucketed(spark, folder, LABELS, ["ID"], run["buckets"])
    return spark.read.schema(LABELS).parquet(folder)


def read_labels(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """``(ID, Topic)`` of the latest topic run, without reading articles."""
    runs = log.read(spark, path, version).runs
    return _labels(spark, path, runs[-1]) if runs else None


def read_store(
    spark: SparkSession, path: str, topics: bool = True, version: int | None = None
) -> DataFrame:
    """All articles, with ``Topic`` of the latest run unless not wanted.

    Consolidated articles meet their labels bucket by bucket and stay where they are;
    only the rows of batches that came later are moved to their labels.
    """
    state = log.read(spark, path, version)
    columns = store_schema(state).names
    parts = _parts(spark, path, state)
    if not topics or not state.runs:
        return _together(parts, columns)
    labels = _labels(spark, path, state.runs[-1])
    # A hash table of one bucket's labels: the articles are not even sorted.
    labelled = [part.drop("Topic").join(labels.hint("shuffle_hash"), "ID", "left") for part in parts]
    rest = [name for name in columns if name not in ("ID", "Topic")]
    return _together(labelled, ["ID", *rest, "Topic"])


def read_run_metadata(
    spark: SparkSession, path: str, version: int | None = None
) -> DataFrame | None:
    run = latest_run(spark, path, version)
    if run is None:
        return None
    return exports.read_topic_metadata(spark, f"{path}/metadata/run={run}")


def largest_id(spark: SparkSession, path: str) -> int:
    """Largest ID given away so far; 0 when none is.  Taken from the log alone."""
    return log.read(spark, path).next_id


# --- statistics and terms by parts ---------------------------------------------


def read_statistics(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The parts of ``stats.section_parts`` of all live batches: no article is read."""
    state = log.read(spark, path, version)
    writes = sorted({b["write"] for b in state.batches.values()})
    if state.base:
        writes.append(state.base["write"])
    if not writes:
        return spark.createDataFrame([], stats.SECTION_PARTS)
    schema = f"{stats.SECTION_PARTS}, {WRITE} string"
    read = spark.read.schema(schema).option("basePath", f"{path}/statistics")
    rows = read.parquet(*(f"{path}/statistics/{WRITE}={w}" for w in writes))
    # Replaced batches of a write that has others still in use are left out.
    live = [f"{b['write']}/{label}" for label, b in state.batches.items()]
    place = F.concat_ws("/", WRITE, BATCH)
    alive = place.isin(live) if live else F.lit(False)
    if state.base:
        alive |= F.col(WRITE) == state.base["write"]
    return rows.filter(alive).drop(WRITE)


def column_names(spark: SparkSession, path: str) -> list[str]:
    return store_schema(log.read(spark, path)).names


def term_counts(spark: SparkSession, path: str) -> DataFrame:
    """``(term, df, tf)`` over the store, merged from counts kept for each batch.

    Only texts of batches without counts are read, which are those written since the last
    call; the counts of all others are there already.
    """
    state = log.read(spark, path)
    if TERMS_OF not in store_schema(state).names:
        raise ValueError(f"no column {TERMS_OF}")
    _count_terms(spark, path, state)
    return _merged_terms(spark, path, state)


def _count_terms(spark: SparkSession, path: str, state: log.State) -> None:
    """Counts the terms of the batches that have no counts, in one pass; adds to ``state``."""
    open_ = {k: b for k, b in state.batches.items() if b["texts"] not in state.terms}
    if not open_:
        return
    texts = recent_rows(spark, path, dataclasses.replace(state, batches=open_, base=None))
    if TERMS_OF not in texts.columns:
        texts = texts.withColumn(TERMS_OF, F.lit(None).cast("string"))
    writes = F.create_map(*(F.lit(x) for k, b in open_.items() for x in (k, b["texts"])))
    texts = texts.withColumn(WRITE, F.element_at(writes, F.col(BATCH)))
    counts = features.term_document_counts(texts, TERMS_OF, (WRITE, BATCH))
    part = f"part={uuid.uuid4().hex}"
    counts.write.partitionBy(WRITE, BATCH).parquet(f"{path}/terms/{part}")
    found = [
        {"do": "terms", "write": write, "folder": f"{part}/{WRITE}={write}"}
        for write in sorted({b["texts"] for b in open_.values()})
    ]
    log.commit(spark, path, lambda _: found)
    for action in found:
        state.apply(action)


def _merged_terms(spark: SparkSession, path: str, state: log.State) -> DataFrame:
    folders = [
        f"{path}/terms/{state.terms[b['texts']]}/{BATCH}={label}"
        for label, b in state.batches.items()
    ]
    if state.base:
        folders.append(f"{path}/terms/{state.terms[state.base['texts']]}")
    # A batch without any term has no folder.
    there = [folder for folder in folders if files.exists(spark, folder)]
    kind = "term string, df bigint, tf bigint"
    if not there:
        return spark.createDataFrame([], kind)
    counts = spark.read.schema(kind).parquet(*there).groupBy("term")
    return counts.agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))


# --- search ------------------------------------------------------------------


def _index_files(spark: SparkSession, path: str, state: log.State) -> None:
    """Indexes the files of writes that have no index, in one pass; adds to ``state``."""
    known = state.indexes
    parts = {w for b in state.batches.values() for w, _ in b["parts"]} - known.keys()
    open_ = {k: {**b, "parts": [p for p in b["parts"] if p[0] in parts]} for k, b in state.batches.items()}
    folders = batch_paths(spark, path, dataclasses.replace(state, batches=open_))
    base = {w: n for w, n in state.base["files"].items() if w not in known} if state.base else {}
    folders += [f"{base_folder(path, state)}/{name}" for names in base.values() for name in names]
    if not folders:
        return
    texts = [name for name in SEARCHED if name in store_schema(state).names]
    schema = StructType([StructField(name, StringType()) for name in texts])
    folder = f"part={uuid.uuid4().hex}"
    index = text_index.file_index(spark.read.schema(schema).parquet(*folders), texts)
    index.write.parquet(f"{path}/index/{folder}")
    writes = sorted(parts | base.keys())
    found = [{"do": "index", "write": write, "folder": folder} for write in writes]
    log.commit(spark, path, lambda _: found)
    for action in found:
        state.apply(action)


def own_name(file: Column | str) -> Column:
    """The part of a file's name that the store gave it."""
    return F.regexp_extract(file, rf"((?:articles|base)/{WRITE}=.*)$", 1)


def is_live(state: log.State) -> Column:
    """Whether this version reads the file named in column ``file``."""
    places = batch_places(state)
    place = F.regexp_extract("file", rf"articles/({WRITE}=[^/]*/{BATCH}=[^/]*)/[^/]*$", 1)
    gone = [f"articles/{place}/{name}" for place, names in places.items() for name in names]
    live = place.isin(list(places)) & ~own_name("file").isin(gone)
    if state.base:
        merged = f"base/{WRITE}={state.base['folder']}"
        live |= own_name("file").isin([f"{merged}/{name}" for name in base_names(state)])
    return live


def matching_files(spark: SparkSession, path: str, term: str) -> tuple[list[str], int]:
    """Files of the store that may match a pattern, and how many files there are.

    Texts are read once, when their files are first searched; after that the index of
    8 KiB a file is.
    """
    state = log.read(spark, path)
    _index_files(spark, path, state)
    writes = {write for b in state.batches.values() for write, _ in b["parts"]}
    writes |= state.base["files"].keys() if state.base else set()
    folders = sorted({state.indexes[write] for write in writes})
    if not folders:
        return [], 0
    kind = "file string, part int, bits binary"
    index = spark.read.schema(kind).parquet(*(f"{path}/index/{folder}" for folder in folders))
    index = index.filter(is_live(state))
    # As many names come to the driver as a scan of these files would list there.  Only
    # the store's own part of a name is taken, in which nothing is encoded.
    found = text_index.candidate_files(index, term).select(own_name("file").alias("file")).collect()
    names = sorted(f"{path}/{row['file']}" for row in found)
    return names, index.select("file").distinct().count()


def search_store(spark: SparkSession, path: str, term: str) -> DataFrame:
    """``search.search_articles`` over the store, reading only files that may match."""
    state = log.read(spark, path)
    if not term or not text_index.required_trigrams(term):
        return search.search_articles(read_store(spark, path, topics=False), term)
    files_, _ = matching_files(spark, path, term)
    columns = store_schema(state)
    if not files_:
        return spark.createDataFrame([], columns)
    return search.search_articles(spark.read.schema(columns).parquet(*files_), term)


# --- writing -----------------------------------------------------------------


def write_batch(df: DataFrame, path: str, label: str, alone: bool = False) -> None:
    """Write (or replace) one batch.

    ``alone``: it has IDs of its own choice, so there must be no other batch.
    """
    if not re.fullmatch(r"[A-Za-z0-9._-]+", label):
        raise ValueError(f"not a batch label: {label}")

    def check(state: log.State) -> None:
        if alone and (state.base or state.batches.keys() - {label}):
            raise log.Conflict("another batch was written first")

    # One folder of one batch: its rows need not be sorted by batch.
    df, write = df.drop(BATCH), uuid.uuid4().hex
    with without_shuffles(df.sparkSession):
        df.write.options(**WRITTEN).parquet(f"{path}/articles/{WRITE}={write}/{BATCH}={label}")
    _commit_write(df, path, write, check)


def write_batches(
    df: DataFrame, path: str, check: Callable[[log.State], None] | None = None
) -> None:
    """Write (or replace) all batches that ``df`` has rows of, in one commit.

    ``check`` sees the state that the commit follows and may raise ``log.Conflict``.
    """
    write = uuid.uuid4().hex
    with without_shuffles(df.sparkSession):
        df.write.options(**WRITTEN).partitionBy(BATCH).parquet(f"{path}/articles/{WRITE}={write}")
    _commit_write(df.drop(BATCH), path, write, check)


def _commit_write(
    df: DataFrame, path: str, write: str, check: Callable[[log.State], None] | None
) -> None:
    spark, columns = df.sparkSession, df.schema
    folder = f"{path}/articles/{WRITE}={write}"
    if not any(name.startswith(f"{BATCH}=") for name in files.child_names(spark, folder)):
        return  # no rows
    written = StructType([*columns.fields, StructField(BATCH, StringType())])
    largest = write_statistics(spark.read.schema(written).parquet(folder), path, write)

    def change(state: log.State) -> list[log.Action]:
        if check is not None:
            check(state)
        done = set(state.base["labels"]) & largest.keys() if state.base else ()
        if done:
            raise log.Conflict(f"already consolidated: {sorted(done)}")
        return [
            {"do": "batch", "label": k, "write": write, "schema": columns.json(), "largest": n}
            for k, n in sorted(largest.items())
        ]

    log.commit(spark, path, change)


def write_statistics(rows: DataFrame, path: str, write: str) -> dict[str, int]:
    """Keep the statistics of written rows; returns the largest ID of each batch."""
    folder = f"{path}/statistics/{WRITE}={write}"
    stats.section_parts(rows, BATCH).write.parquet(folder)
    kept = rows.sparkSession.read.schema(stats.SECTION_PARTS).parquet(folder)
    # One row a batch.
    found = kept.groupBy(BATCH).agg(F.max("largest").alias("largest")).collect()
    return {row[BATCH]: row["largest"] or 0 for row in found}


def reserve(spark: SparkSession, path: str, label: str, count: int) -> int:
    """The ID after which ``count`` rows of a batch are numbered; no other batch gets them.

    A batch that is written again gets the IDs that it had, if they are enough.
    """

    def change(state: log.State) -> list[log.Action]:
        if state.ranges.get(label, (0, -1))[1] >= count:
            return []
        others = state.base or (state.batches.keys() | state.ranges.keys()) - {label}
        start = state.next_id if others or label not in state.batches else 0
        return [{"do": "reserve", "label": label, "start": start, "count": count}]

    return log.commit(spark, path, change)[0].ranges[label][0]


def number_new(df: DataFrame, start: int | Callable[[int], int]) -> DataFrame:
    """New rows with IDs ``start + 1 ...`` in their own order.

    Without IDs of their own they are ordered by how their columns begin, then by a hash
    of all of them: whole texts are neither compared nor sampled.
    """
    if "ID" in df.columns:
        return assign_ids(df, start, ["ID"])
    kinds = {f.name: f.dataType for f in df.schema.fields}
    order = [
        F.left(F.col(f"`{name}`"), F.lit(ORDER_CHARS)) if isinstance(kind, StringType) else F.col(f"`{name}`")
        for name, kind in kinds.items()
        if not isinstance(kind, (ArrayType, MapType))
    ]
    return assign_ids(df, start, order)


def append_articles(store: DataFrame | None, new: DataFrame) -> DataFrame:
    """All rows of both, nothing de-duplicated; missing columns are null.

    New rows get IDs after the store's largest one (0 in a store without IDs).
    Without a store the new rows are the store and keep the IDs they have.
    """
    if store is None:
        return new if "ID" in new.columns else number_new(new, 0)
    largest = store.agg(F.max("ID")).first()[0] if "ID" in store.columns else 0
    return store.unionByName(number_new(new, largest or 0), allowMissingColumns=True)


def write_topics(df: DataFrame, metadata: DataFrame, path: str) -> None:
    """Publish one topic run; the commit, made last, makes it current.

    Labels lie in the buckets of the consolidated articles, if there are any.
    """
    spark = df.sparkSession
    label = new_label()
    exports.write_topic_metadata(metadata, f"{path}/metadata/run={label}")
    labels = df.select("ID", F.col("Topic").cast("int").alias("Topic"))
    state = log.read(spark, path)
    count = state.base["buckets"] if state.base else 0
    log.commit(spark, path, lambda _: [_write_run(labels, path, label, count)])


def _write_run(labels: DataFrame, path: str, label: str, count: int) -> log.Action:
    folder = uuid.uuid4().hex
    if count:
        buckets.write_bucketed(labels, f"{path}/topics/run={folder}", ["ID"], count)
    else:
        labels.write.parquet(f"{path}/topics/run={folder}")
    return {"do": "run", "label": label, "folder": folder, "buckets": count}


def consolidate(spark: SparkSession, path: str, count: int | None = None) -> None:
    """Merge all batches into the base: one file for each of ``count`` buckets of IDs.

    The statistics, the term counts and the labels of the latest run come along, so that
    reading the store with topics moves no article.  Batches written meanwhile stay beside
    the base; a batch or a base replaced meanwhile is a conflict.
    """
    state = log.read(spark, path)
    if not state.batches:
        return
    if count is None:
        articles = read_statistics(spark, path, state.version).agg(F.sum("articles")).first()[0]
        count = -(-articles // BUCKET_ARTICLES)
    rows = read_batches(spark, path, state.version)
    write = uuid.uuid4().hex
    _count_terms(spark, path, state)
    terms = f"part={uuid.uuid4().hex}/{WRITE}={write}"
    _merged_terms(spark, path, state).write.parquet(f"{path}/terms/{terms}")
    _replace_base(rows, path, state, sorted(state.batches), write, count, terms)


def rewrite_base(rows: DataFrame, path: str, state: log.State) -> None:
    """The rows of the base as ``rows``, which have the same texts: the terms stay."""
    terms = state.terms[state.base["texts"]]
    count = state.base["buckets"]
    _replace_base(rows, path, state, [], uuid.uuid4().hex, count, terms)


def _replace_base(
    rows: DataFrame,
    path: str,
    state: log.State,
    labels: list[str],
    write: str,
    count: int,
    terms: str,
) -> None:
    spark = rows.sparkSession
    columns = rows.drop(BATCH).schema
    buckets.write_bucketed(rows, f"{path}/base/{WRITE}={write}", ["ID"], count)
    written = buckets.read_bucketed(
        spark, f"{path}/base/{WRITE}={write}", rows.schema, ["ID"], count
    )
    kept = stats.section_parts(written.withColumn(BATCH, F.lit("base")), BATCH)
    kept.write.parquet(f"{path}/statistics/{WRITE}={write}")
    base = {"do": "base", "write": write, "buckets": count, "schema": columns.json(), "labels": labels}
    names = files.data_names(spark, f"{path}/base/{WRITE}={write}")
    place = {"folder": write, "files": {write: names}, "texts": write}
    actions = [{**base, **place}, {"do": "terms", "write": write, "folder": terms}]
    if state.runs and state.runs[-1]["buckets"] != count:
        run = state.runs[-1]
        actions.append(_write_run(_labels(spark, path, run), path, run["label"], count))

    def change(now: log.State) -> list[log.Action]:
        same = all(now.batches.get(k) == state.batches[k] for k in labels)
        if not same or now.base != state.base:
            raise log.Conflict("the store was changed meanwhile")
        newer = now.runs[len(state.runs) :]
        return [a for a in actions if a["do"] != "run" or not newer]

    log.commit(spark, path, change)


def vacuum(spark: SparkSession, path: str, version: int) -> list[str]:
    """Delete the folders that only versions before ``version`` use; returns them.

    Folders that no commit names yet may belong to a writer at work and stay.
    """
    last = log.read(spark, path)
    needed, known, replaced = set(), set(), {}
    for number in range(last.version + 1):
        state = log.read(spark, path, number)
        named = set(_named_places(state))
        known |= named
        if number >= version:
            needed |= named
            # Of a folder in use, the files that no kept version reads.
            for place, names in batch_places(state).items():
                replaced[place] = replaced.get(place, set(names)) & set(names)
    gone = known - needed
    gone |= {f"articles/{place}/{name}" for place, names in replaced.items() for name in names}
    for name in sorted(gone):
        files.delete(spark, f"{path}/{name}")
    return sorted(gone)


def _named_places(state: log.State) -> list[str]:
    places = [f"articles/{place}" for place in batch_places(state)]
    parts = {write for b in state.batches.values() for write, _ in b["parts"]}
    writes = {b["write"] for b in state.batches.values()}
    texts = {b["texts"] for b in state.batches.values()}
    if state.base:
        writes.add(state.base["write"])
        texts.add(state.base["texts"])
        parts |= state.base["files"].keys()
        merged = f"base/{WRITE}={state.base['folder']}"
        places += [merged, *(f"{merged}/{name}" for name in base_names(state))]
    places += [f"statistics/{WRITE}={write}" for write in writes]
    places += [f"terms/{state.terms[write]}" for write in texts if write in state.terms]
    places += [f"index/{state.indexes[write]}" for write in parts if write in state.indexes]
    places += [f"keys/{state.keys[write]}" for write in parts if write in state.keys]
    return places + [f"topics/run={run['folder']}" for run in state.runs]


def snapshot(spark: SparkSession, path: str) -> str | None:
    """Copy the articles to ``<path>.backup_<time>``; None without a store.

    A full copy for use outside the store, so only made when asked for; inside it
    ``current_version`` is enough.
    """
    if not store_exists(spark, path):
        return None
    target = f"{path}.backup_{datetime.datetime.now():%Y%m%d_%H%M%S}"
    read_store(spark, path).write.parquet(target)
    return target
