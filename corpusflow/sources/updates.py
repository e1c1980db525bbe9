"""Changes of stored articles by ``ID``: only the files that hold them are written again.

Files of batches are chosen by their least and largest ID, which are kept beside the store;
files of the consolidated part by the bucket of an ID.  The ``ID`` column of these files
alone tells which of them really hold a changed article.  Their rows are written to new
files, and one commit swaps the files: readers see all changes of a call or none, and older
versions keep the files they have.
"""

from __future__ import annotations

import dataclasses
import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from corpusflow.operators import stats
from corpusflow.operators.joins import replace_by_key
from corpusflow.sources import buckets, files, log, store
from corpusflow.sources.scratch import scratch_path

#: Ranges that changed IDs are put together to, to compare them with those of files.
INTERVALS = 1024
#: Changes of at most this many characters in JSON are sent to the rows' tasks.
SENT_CHARS = 4 << 20


def update_articles(changes: DataFrame, path: str) -> list[str]:
    """Replace columns of stored articles; returns the files that were replaced.

    ``changes`` has ``ID`` and the columns to replace, null where an article shall lose a
    value; columns that the store lacks are added.  All rows with a changed ID change.
    An ID that is null, repeated or not stored is an error, and nothing is changed.  If
    another writer changes one of the batches meanwhile, ``log.Conflict`` is raised.

    Terms and trigrams are kept for what did not change: the words of a batch are counted
    anew only if the text they are counted in is replaced.
    """
    spark = changes.sparkSession
    state = log.read(spark, path)
    if not state.batches and not state.base:
        raise ValueError(f"no store at {path}")
    scratch = scratch_path(spark, "changes")
    known = {f.name: f.dataType for f in store.store_schema(state).fields}
    names = [name for name in changes.columns if name != "ID"]
    if "ID" not in changes.columns or not names or store.BATCH in names:
        raise ValueError(f"changes need ID and columns of articles, not {changes.columns}")
    typed = [F.col(f"`{c}`").cast(known.get(c, changes.schema[c].dataType)).alias(c) for c in ["ID", *names]]
    try:
        changes.select(*typed).write.parquet(scratch)
        fixed = spark.read.parquet(scratch)
        return _update(fixed, names, path, state)
    finally:
        files.delete(spark, scratch)


def _update(changes: DataFrame, names: list[str], path: str, state: log.State) -> list[str]:
    wrong = changes.groupBy("ID").count().filter("ID is null or count > 1")
    if not wrong.isEmpty():
        raise ValueError("an ID of the changes is null or repeated")
    held = _holding(changes, path, state)
    if not held:
        return []
    size = changes.agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0] or 0
    last = changes.select("ID", F.struct(*(F.col(f"`{c}`") for c in names)).alias("_update"))
    small = size <= SENT_CHARS
    merged = [name for name in held if name.startswith("base/")]
    recent = [name for name in held if not name.startswith("base/")]
    actions = _rewrite_batches(last, names, path, state, recent, small) if recent else []
    labels = [action["label"] for action in actions]
    if merged:
        actions += _rewrite_buckets(last, names, path, state, merged)

    def change(now: log.State) -> list[log.Action]:
        same = all(now.batches.get(k) == state.batches[k] for k in labels)
        if not same or (merged and now.base != state.base):
            raise log.Conflict("the store was changed meanwhile")
        return actions

    log.commit(changes.sparkSession, path, change)
    return held


# --- which files -----------------------------------------------------------------


def _key_files(path: str, state: log.State, spark) -> None:
    """Keeps the ranges of files of writes that have none, in one pass; adds to ``state``."""
    parts = {w for b in state.batches.values() for w, _ in b["parts"]} - state.keys.keys()
    if not parts:
        return
    open_ = {k: {**b, "parts": [p for p in b["parts"] if p[0] in parts]} for k, b in state.batches.items()}
    paths = store.batch_paths(spark, path, dataclasses.replace(state, batches=open_))
    ids = spark.read.schema(_id_alone(state)).parquet(*paths)
    ranges = ids.groupBy(store.own_name(F.col("_metadata.file_path")).alias("file")).agg(
        F.min("ID").alias("least"), F.max("ID").alias("most")
    )
    folder = f"part={uuid.uuid4().hex}"
    ranges.write.parquet(f"{path}/keys/{folder}")
    found = [{"do": "keys", "write": write, "folder": folder} for write in sorted(parts)]
    log.commit(spark, path, lambda _: found)
    for action in found:
        state.apply(action)


def _id_alone(state: log.State) -> StructType:
    return StructType([StructField("ID", store.store_schema(state)["ID"].dataType)])


def _in_range(changes: DataFrame, path: str, state: log.State) -> list[str]:
    """Files of batches whose range of IDs has a changed one, or one close to it.

    Changed IDs are put together to ``INTERVALS`` ranges at most, so what each file is
    compared with does not grow.
    """
    spark = changes.sparkSession
    _key_files(path, state, spark)
    parts = {w for b in state.batches.values() for w, _ in b["parts"]}
    folders = sorted({state.keys[write] for write in parts})
    low, high = changes.agg(F.min("ID"), F.max("ID")).first()
    if not folders or low is None:
        return []
    width = (high - low) // INTERVALS + 1
    ranges = changes.groupBy(F.floor((F.col("ID") - F.lit(low)) / F.lit(width)).alias("range")).agg(
        F.min("ID").alias("low"), F.max("ID").alias("high")
    )
    keys = spark.read.schema(f"file string, least {_id_kind(state)}, most {_id_kind(state)}")
    keys = keys.parquet(*(f"{path}/keys/{folder}" for folder in folders))
    meets = (F.col("least") <= F.col("high")) & (F.col("most") >= F.col("low"))
    near = keys.filter(store.is_live(state)).join(F.broadcast(ranges), meets, "left_semi")
    return [row["file"] for row in near.select("file").collect()]


def _id_kind(state: log.State) -> str:
    return _id_alone(state)["ID"].dataType.simpleString()


def _in_buckets(changes: DataFrame, state: log.State) -> list[str]:
    """Files of the consolidated part in the buckets of changed IDs."""
    if not state.base:
        return []
    bucket = F.pmod(F.hash("ID"), F.lit(state.base["buckets"])).alias("bucket")
    touched = {row["bucket"] for row in changes.select(bucket).distinct().collect()}
    folder = f"base/{store.WRITE}={state.base['folder']}"
    return [
        f"{folder}/{name}"
        for name in store.base_names(state)
        if int(re.search(r"_(\d+)(?:\.|$)", name)[1]) in touched
    ]


def _holding(changes: DataFrame, path: str, state: log.State) -> list[str]:
    """The files that hold a changed article.  Only names come to the driver."""
    spark = changes.sparkSession
    near = _in_range(changes, path, state) + _in_buckets(changes, state)
    ids = changes.select("ID")
    if not near:
        if not ids.isEmpty():
            raise ValueError("a changed ID is not stored")
        return []
    rows = spark.read.schema(_id_alone(state)).parquet(*(f"{path}/{name}" for name in near))
    rows = rows.select("ID", store.own_name(F.col("_metadata.file_path")).alias("file"))
    if not ids.join(rows, "ID", "left_anti").isEmpty():
        raise ValueError("a changed ID is not stored")
    held = rows.join(ids, "ID", "left_semi").select("file").distinct()
    return sorted(row["file"] for row in held.collect())


# --- writing them again ------------------------------------------------------------


def _rewrite_batches(
    last: DataFrame, names: list[str], path: str, state: log.State, held: list[str], small: bool
) -> list[log.Action]:
    """New files for those of batches, and the actions that name them."""
    spark, write = last.sparkSession, uuid.uuid4().hex
    replaced: dict[str, dict[str, list[str]]] = {}
    for name in held:
        found = re.fullmatch(rf"articles/{store.WRITE}=([^/]*)/{store.BATCH}=([^/]*)/(.*)", name)
        replaced.setdefault(found[2], {}).setdefault(found[1], []).append(found[3])
    columns = store.store_schema(state)
    kinds = StructType([*columns.fields, StructField(store.BATCH, StringType())])
    read = spark.read.schema(StructType([*kinds.fields, StructField(store.WRITE, StringType())]))
    rows = read.option("basePath", f"{path}/articles").parquet(*(f"{path}/{name}" for name in held))
    rows = replace_by_key(rows.drop(store.WRITE), F.broadcast(last) if small else last, names)
    if not small:
        # The join dealt the rows out by hash: files get narrow ranges of IDs again.
        rows = rows.repartitionByRange(len(held), store.BATCH, "ID")
    rows.write.partitionBy(store.BATCH).parquet(f"{path}/articles/{store.WRITE}={write}")
    schema = rows.drop(store.BATCH).schema.json()
    batches = {}
    for label, gone in replaced.items():
        old = state.batches[label]
        # A part that has no file left stays in the list until the batch is written anew.
        parts = [[w, sorted({*names_, *gone.get(w, ())})] for w, names_ in old["parts"]]
        batches[label] = {
            **old,
            "write": write,
            "schema": state.schema_number(schema),
            "parts": [*parts, [write, []]],
            "texts": write if store.TERMS_OF in names else old["texts"],
        }
    now = store.recent_rows(spark, path, dataclasses.replace(state, batches=batches, base=None))
    store.write_statistics(now, path, write)
    return [
        {"do": "batch", "label": label, **b, "schema": schema} for label, b in sorted(batches.items())
    ]


def _rewrite_buckets(
    last: DataFrame, names: list[str], path: str, state: log.State, held: list[str]
) -> list[log.Action]:
    """New files of the same buckets of the consolidated part.

    Articles stay in their buckets: only changes are moved, to where their articles are.
    """
    spark, write = last.sparkSession, uuid.uuid4().hex
    folder, count = store.base_folder(path, state), state.base["buckets"]
    rows = buckets.read_bucketed(spark, folder, store.base_schema(state), ["ID"], count)
    columns = rows.columns
    # Files of other buckets are not opened.
    held_here = F.col("_metadata.file_name").isin([name.rsplit("/", 1)[1] for name in held])
    rows = rows.filter(held_here).select(*columns)
    rows = replace_by_key(rows, last.repartition(count, "ID").hint("shuffle_hash"), names)
    beside = f"{path}/base/{store.WRITE}={write}"
    buckets.write_bucketed(rows, beside, ["ID"], count, in_buckets=True)
    new = files.data_names(spark, beside)
    # No version names these files yet, so none sees them in the folder.
    for name in new:
        files.move_into(spark, beside, name, folder)
    files.delete(spark, beside)
    gone = {name.rsplit("/", 1)[1] for name in held}
    kept = {w: [n for n in found if n not in gone] for w, found in state.base["files"].items()}
    schema = rows.drop(store.BATCH).schema.json()
    base = {
        **state.base,
        "write": write,
        "schema": state.schema_number(schema),
        "files": {**{w: found for w, found in kept.items() if found}, write: new},
        "texts": write if store.TERMS_OF in names else state.base["texts"],
    }
    now = store.base_rows(spark, path, dataclasses.replace(state, base=base))
    parts = stats.section_parts(now.withColumn(store.BATCH, F.lit("base")), store.BATCH)
    parts.write.parquet(f"{path}/statistics/{store.WRITE}={write}")
    actions = [{**base, "do": "base", "schema": schema, "labels": []}]
    if store.TERMS_OF in names:
        actions.append(_base_terms(now, path, write))
    return actions


def _base_terms(rows: DataFrame, path: str, write: str) -> log.Action:
    """Term counts of the whole consolidated part, which are kept for all of it at once."""
    folder = f"part={uuid.uuid4().hex}/{store.WRITE}={write}"
    store.features.term_document_counts(rows, store.TERMS_OF).write.parquet(f"{path}/terms/{folder}")
    return {"do": "terms", "write": write, "folder": folder}
