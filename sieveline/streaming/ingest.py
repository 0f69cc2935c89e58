"""Incremental corpus build: chunk documents as their files arrive."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from sieveline.config import MAX_TOKENS, STRIDE
from sieveline.operators.corpus import chunk_documents, clean_docs

RAW_SCHEMA = (
    "doc_id string, orig_id string, domain string, title string, text string, ingest_seq long"
)
_COLUMNS = ["doc_id", "orig_id", "domain", "title", "text", "ingest_seq"]
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: All stores of an executor share one bound of memory, and commits write changes alone.
_ROCKSDB_SETTINGS = {
    "changelogCheckpointing.enabled": "true",
    "boundedMemoryUsage": "true",
    "maxMemoryUsageMB": "256",
}


class FirstCopy(StatefulProcessor):
    """Per document id: the copy with the smallest ``ingest_seq`` among those that come first.

    The state of an id is the ``ingest_seq`` that went out. Copies that come in a later
    micro-batch are late and dropped, whatever their number. With ``ttl_ms`` an id is forgotten
    that long after it was stored, which bounds the state; a copy after that counts as new.
    """

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = StructType([StructField("ingest_seq", LongType())])
        self.sent = handle.getValueState("sent", schema, self.ttl_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:  # noqa: N802, N803
        if self.sent.exists():
            for _ in rows:
                pass
            return
        first = None
        for row in rows:
            order = (row["ingest_seq"], row["text"], row["title"])
            if first is None or order < first[0]:
                first = (order, row)
        if first is not None:
            self.sent.update((first[0][0],))
            yield Row(**{c: first[1][c] for c in _COLUMNS})

    def handleInitialState(self, key: tuple, initialState: Row, timerValues: object) -> None:  # noqa: N802, N803
        self.sent.update((initialState["ingest_seq"],))

    def close(self) -> None:
        pass


def _known(spark: SparkSession, sink: str) -> DataFrame | None:
    """Ids that the sink holds; None before anything was written. Other errors end the start."""
    try:
        return spark.read.parquet(sink).groupBy("doc_id").agg(F.lit(-1).cast("long").alias("ingest_seq"))
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(target)


def ingest_stream(
    spark: SparkSession,
    source: str,
    sink: str,
    checkpoint: str,
    max_tokens: int = MAX_TOKENS,
    stride: int = STRIDE,
    files_per_trigger: int = 1000,
    ttl_ms: int | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Drain the files waiting under ``source`` into chunks under ``sink``.

    Ids that went out are keyed state in RocksDB (``FirstCopy``), so a micro-batch reads its
    own files and never the sink; the sink equals the batch build when copies arrive in
    ``ingest_seq`` order. A micro-batch replaces its own folder (columns ``run`` and
    ``batch`` of the sink), so one that is run again after a failure adds nothing twice. With a new
    checkpoint the ids of an existing sink are the initial state, read once.

    Each of ``state_partitions`` (by default the shuffle partitions of the session) is a store of
    its own with some megabytes of files; their number stays as it was when the checkpoint was made.
    """
    partitions = state_partitions or spark.conf.get("spark.sql.shuffle.partitions")
    spark = spark.newSession()  # the settings below are for this stream alone
    spark.conf.set(_PROVIDER, _ROCKSDB)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    for name, value in _ROCKSDB_SETTINGS.items():
        spark.conf.set(f"spark.sql.streaming.stateStore.rocksdb.{name}", value)
    fresh = not _exists(spark, f"{checkpoint}/commits")
    known = _known(spark, sink) if fresh else None
    run = hashlib.md5(f"{checkpoint}".encode()).hexdigest()[:12]
    stream = (
        spark.readStream.schema(RAW_SCHEMA)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(source)
    )
    first = (
        clean_docs(stream)
        .select(_COLUMNS)
        .groupBy("doc_id")
        .transformWithState(
            FirstCopy(ttl_ms),
            outputStructType=RAW_SCHEMA,
            outputMode="Append",
            timeMode="None" if ttl_ms is None else "ProcessingTime",
            initialState=known.groupBy("doc_id") if known is not None else None,
        )
    )

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/run={run}/batch={number}")

    return (
        chunk_documents(first, max_tokens, stride)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
