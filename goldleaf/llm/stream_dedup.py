"""Exact deduplication by a streaming query with disk-backed keyed state.

1. Every row becomes a fingerprint: digest of the normalised text, identifier, and the locator of
   its content (file and row in the file). Texts are equal when they are identical after each run of
   white space is replaced by one space.
2. A streaming query reads the stored fingerprints and keeps one state entry per digest in RocksDB,
   without expiry: the smallest identifier, the locator of that row, and the number of rows seen.
   Equal digests are reduced on the map side first, so a digest that a third of all rows share
   reaches its state as one row per task.
3. Each hit (a row whose digest belongs to another row) is checked: its full text is compared with the
   text at the locator of the row that stays. Rows that differ in spite of an equal digest are
   grouped by their text itself.

The row with the smallest identifier stays; rows without identifier come last; among rows of one
identifier the first by file and row stays. Null text counts as empty, so null and empty texts are one
group (as are texts of nothing but one run of white space: they become one space). Texts are compared
whole. An empty table gives an empty result. Only the identifier and the text are read, so other
columns may have any name.

With ``state_folder`` the state outlives the run: see ``classes_so_far``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import Workspace, free_name
from goldleaf.sources.tables import folders

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "100",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    # many small stores: do not reserve megabytes of disk for each one's logs
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}

# What one micro-batch reads of the fingerprints.
BYTES_PER_BATCH = 4 << 30


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def located(docs: DataFrame, work: Workspace, at: str = "_at") -> DataFrame:
    """The rows with a locator that stays the same: file and row. Rows not read from files are stored first."""

    def placed(rows: DataFrame) -> DataFrame:
        # not the column of that name, which the table may have too
        file = rows.metadataColumn("_metadata")
        return rows.select("*", F.struct(file["file_path"].alias("file"), file["row_index"].alias("row")).alias(at))

    try:
        return placed(docs)
    except AnalysisException:
        return placed(work.keep(docs, "content"))


def fingerprints(
    content: DataFrame, id_column: str, text_column: str, digest: Callable[[Column], Column], at: str = "_at"
) -> DataFrame:
    text = normalised(F.col(text_column))
    columns = [F.col(id_column).alias("id"), F.col(at).alias("at"), digest(text).alias("digest")]
    if digest is not sha256:
        columns.append(sha256(text).alias("sha"))
    return content.select(*columns)


def first_place(identifier: str, at: str) -> Column:
    """Orders rows: with identifier first, smallest identifier first, then by locator."""
    return F.struct(F.col(identifier).isNull().alias("unnamed"), F.col(identifier).alias("id"), F.col(at).alias("at"))


def advance_state(stored: DataFrame, state_folder: str, bytes_per_batch: int) -> None:
    """Let the stream take in all fingerprints that it has not seen yet. Those of numbered batches also
    leave the place of one row of the first batch that had the digest."""
    spark = stored.sparkSession
    seen = [F.min(first_place("id", "at")).alias("first"), F.count(F.lit(1)).alias("n")]
    if "batch" in stored.columns:
        # the greatest of negative numbers: the state names its fields after the functions, which must differ
        seen.append(F.max(F.struct((-F.col("batch")).alias("batch"), "at")).alias("anchor"))
    before = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    stream = spark.readStream.schema(stored.schema).option("maxBytesPerTrigger", bytes_per_batch)
    kept = stream.parquet(stored._stored_at).groupBy("digest").agg(*seen)
    try:
        for key, value in STATE_SETTINGS.items():
            spark.conf.set(key, value)
        running = (
            kept.writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", state_folder)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    running.awaitTermination()


def read_state(content: DataFrame, state_folder: str) -> DataFrame:
    """One row per digest: where its first row is, how many rows had it, and for numbered batches its anchor."""
    state = content.sparkSession.read.format("statestore").load(state_folder)
    fields = zip(state.schema["value"].dataType.names, ("first", "n", "anchor"))
    return state.select(F.col("key.digest").alias("digest"), *(F.col(f"value.{field}").alias(name) for field, name in fields))


def classes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    digest: Callable[[Column], Column] = sha256,
    state_folder: str | None = None,
    bytes_per_batch: int = BYTES_PER_BATCH,
    batch: str | None = None,
) -> DataFrame:
    """One row per input row: id, at (its locator), keep_id, group_size, kept, sha (of its text).

    With ``state_folder`` the rows are a batch held against all batches before, see ``classes_so_far``.
    """
    work = Workspace(docs.sparkSession, "stream-dedup")
    plain = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    if state_folder is not None:
        return classes_so_far(plain, work, state_folder, digest, bytes_per_batch, batch)
    return classes_of(located(plain, work), work, "id", "text", digest, bytes_per_batch)


def classes_of(
    content: DataFrame, work: Workspace, id_column: str = "doc_id", text_column: str = "text",
    digest: Callable[[Column], Column] = sha256, bytes_per_batch: int = BYTES_PER_BATCH, at: str = "_at",
) -> DataFrame:
    """The same for rows that have their locator as ``at``."""
    prints = work.keep(fingerprints(content, id_column, text_column, digest, at), "fingerprints")
    state_folder = work.path("state")
    advance_state(prints, state_folder, bytes_per_batch)
    state = read_state(prints, state_folder)

    repeated = prints.join(state.where("n > 1"), "digest").select("at", "digest", F.col("first.at").alias("first_at"))
    repeated = work.keep(repeated, "repeated")
    text = normalised(F.col(text_column))
    # the repeated rows grow with the input, so they are never broadcast
    whole = content.select(F.col(at).alias("at"), text.alias("text"))
    texts = work.keep(whole.join(repeated.hint("merge"), "at"), "texts")
    stays = texts.where("at = first_at").select("digest", F.col("text").alias("first_text"))
    strays = texts.where("at <> first_at").join(stays, "digest").where("text <> first_text").select("at", "digest", "text")
    strays = work.keep(strays, "strays")

    columns = ["digest", "id", "at", F.col("digest").alias("sha") if digest is sha256 else "sha"]
    found = prints.select(*columns).join(state.select("digest", "first", "n"), "digest")
    if strays.isEmpty():
        groups = found.select("id", "at", "sha", "first", "n")
    else:
        # equal digests, different texts: the text itself is the key
        known = strays.join(prints.select("at", "id"), "at")
        by_text = known.groupBy("digest", "text").agg(F.min(first_place("id", "at")).alias("own"), F.count(F.lit(1)).alias("own_n"))
        own = known.select("at", "digest", "text").join(by_text, ["digest", "text"]).select("at", "own", "own_n")
        less = strays.groupBy("digest").agg(F.count(F.lit(1)).alias("gone"))
        groups = (
            found.join(own, "at", "left").join(less, "digest", "left")
            .select(
                "id", "at", "sha", F.coalesce("own", "first").alias("first"),
                F.coalesce("own_n", F.col("n") - F.coalesce("gone", F.lit(0))).alias("n"),
            )
        )
    return described(groups)


def described(groups: DataFrame) -> DataFrame:
    return groups.select(
        "id", "at", F.col("first.id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("at") == F.col("first.at")).alias("kept"), F.lower(F.hex("sha")).alias("sha"),
    )


def written_once(df: DataFrame, folder: str) -> DataFrame:
    """Rows stored in a folder, unless an earlier call has completed that."""
    spark = df.sparkSession
    if "_SUCCESS" not in folders(spark, folder):
        df.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def texts_at(places: DataFrame, work: Workspace, like: DataFrame) -> DataFrame:
    """``places`` (with ``at``) and the normalised text found there. Only files that are named are read; their names come to the driver."""
    files = [row[0] for row in places.select("at.file").distinct().collect()]
    reader = like.sparkSession.read.schema(like.drop("at").schema)
    content = located(reader.parquet(*files), work, "at") if files else like.limit(0)
    return content.select("at", normalised(F.col("text")).alias("text")).join(places.hint("merge"), "at")


def classes_so_far(
    docs: DataFrame, work: Workspace, state_folder: str, digest: Callable[[Column], Column] = sha256,
    bytes_per_batch: int = BYTES_PER_BATCH, batch: str | None = None,
) -> DataFrame:
    """The classes of one batch's rows (``id``, ``text``) among all rows of all batches given with this state folder.

    Sizes and the row that stays are those over all batches so far: a later row with a smaller identifier takes the place
    of one that stayed before. A batch that is given again under its name (after a lost driver, say) is not counted
    twice, and gets its classes as they are by then; without a name each call is a batch of its own. One call at a time.

    The folder holds each batch's texts and fingerprints beside the stream's checkpoint, so that a locator stays good whatever
    becomes of the input. Each row whose digest was seen is compared with the text at the digest's anchor, a row
    of the first batch that had it, so every two rows of a digest are compared through it; earlier texts are read from
    the files their locators name. A digest whose texts differ is remembered, and its rows of all batches
    are grouped by their text.
    """
    spark = docs.sparkSession
    known = {name.split("-", 1)[1]: name for name in folders(spark, f"{state_folder}/content")}
    batch = batch or uuid.uuid4().hex
    place = known.get(batch, f"{len(known):06d}-{batch}")
    content = located(written_once(docs, f"{state_folder}/content/{place}"), work, "at")
    numbered = fingerprints(content, "id", "text", digest, "at").withColumn("batch", F.lit(int(place.split("-", 1)[0])))
    prints = written_once(numbered, f"{state_folder}/fingerprints/{place}")
    prints._stored_at = f"{state_folder}/fingerprints/*"
    advance_state(prints, f"{state_folder}/state", bytes_per_batch)
    state = read_state(prints, f"{state_folder}/state")

    repeated = prints.join(state.where("n > 1"), "digest").select("at", "digest", F.col("anchor.at").alias("anchor_at"))
    repeated = work.keep(repeated, "repeated")
    own = content.select("at", normalised(F.col("text")).alias("text")).join(repeated.hint("merge"), "at")
    anchors = texts_at(repeated.select(F.col("anchor_at").alias("at"), "digest").distinct(), work, content)
    differing = own.where("at <> anchor_at").join(anchors.select("digest", F.col("text").alias("anchor_text")), "digest")
    differing.where("text <> anchor_text").select("digest").distinct().write.mode("overwrite").parquet(
        f"{state_folder}/conflicts/{place}"
    )
    conflicts = work.keep(spark.read.schema("digest binary").parquet(f"{state_folder}/conflicts/*").distinct(), "conflicts")

    found = prints.select("id", "at", "digest", F.col("digest").alias("sha") if digest is sha256 else "sha")
    found = found.join(state.select("digest", "first", "n"), "digest")
    if conflicts.isEmpty():
        return described(found)
    # equal digests, different texts: the text itself is the key, over all batches
    everywhere = spark.read.schema(prints.schema).parquet(f"{state_folder}/fingerprints/*")
    places = work.keep(everywhere.join(conflicts, "digest").select("at", "id", "digest"), "conflicting")
    texts = work.keep(texts_at(places, work, content), "conflicting-texts")
    by_text = texts.groupBy("digest", "text").agg(F.min(first_place("id", "at")).alias("own"), F.count(F.lit(1)).alias("own_n"))
    by_row = texts.select("at", "digest", "text").join(by_text, ["digest", "text"]).select("at", "own", "own_n")
    return described(
        found.join(by_row, "at", "left")
        .select("id", "at", "sha", F.coalesce("own", "first").alias("first"), F.coalesce("own_n", "n").alias("n"))
    )


def kept_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    work = Workspace(docs.sparkSession, "stream-dedup")
    at = free_name(docs, "_at")
    content = located(docs, work, at)
    gone = classes_of(content, work, id_column, text_column, at=at).where(~F.col("kept")).select(F.col("at").alias(at))
    return content.join(gone, at, "left_anti").select(*docs.columns)
