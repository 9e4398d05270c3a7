"""A lasting record of streaming progress.

The engine remembers a query's latest batches only. The listener here writes every progress
under the id of its query, which a restart from the same checkpoint keeps, and its batch.
A record is a small file that never changes. When a block of batches is over, its records are
copied to one file, and the small files go when the next block is over, so that a reader who
has listed them can still read them. Of a batch that is run again the latest record counts.
"""

import json
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from chartloom import schemas
from chartloom.operators.shaping import keep_latest
from chartloom.registry import Lake
from chartloom.sinks.batches import Files

BLOCK = 64


class ProgressRecord(StreamingQueryListener):
    """Add it to `spark.streams`; `records` reads what it wrote."""

    def __init__(self, spark: SparkSession, path: str, block: int = BLOCK) -> None:
        self.files, self.path, self.block = Files(spark, path), path, block
        self._at: dict[str, int] = {}  # the block each query is in
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.note({
            "query_id": str(p.id), "batch_id": p.batchId, "rows": p.numInputRows,
            "processing_ms": float(dict(p.durationMs).get("triggerExecution", 0)),
            "throughput_rows_per_sec": float(p.processedRowsPerSecond or 0.0), "ts": p.timestamp, "run_id": str(p.runId), "name": p.name,
        })

    def note(self, record: dict) -> None:
        """Store a record; the first one of a block has the earlier blocks put together."""
        query, batch_id = record["query_id"], record["batch_id"]
        with self._lock:
            self.files.write(f"{query}/b{batch_id:012d}-{uuid.uuid4().hex}.json", json.dumps(record) + "\n")
            if self._at.get(query) != batch_id // self.block:
                self._at[query] = batch_id // self.block
                self._fold(query, batch_id // self.block)

    def _fold(self, query: str, current: int) -> None:
        names, small = self.files.names(query), {}
        for name in names:
            if name.startswith("b") and int(name[1:13]) // self.block < current:
                small.setdefault(int(name[1:13]) // self.block, []).append(name)
        for block, own in small.items():
            whole = f"f{block:012d}.json"
            if whole in names:
                for name in own:
                    self.files.delete(f"{query}/{name}")
            else:
                self.files.write(f"{query}/{whole}", "".join(self.files.read(f"{query}/{name}") or "" for name in own))


_RECORDING: dict[tuple[str, str], ProgressRecord] = {}


def record_progress(spark: SparkSession, lake: Lake) -> ProgressRecord:
    """Record the session's streaming queries in the lake from now on; asking again changes nothing."""
    key = (spark.sparkContext.applicationId, progress_path(lake))
    if key not in _RECORDING:
        _RECORDING[key] = ProgressRecord(spark, progress_path(lake))
        spark.streams.addListener(_RECORDING[key])
    return _RECORDING[key]


def progress_path(lake: Lake) -> str:
    return f"{lake.root.rstrip('/')}/progress"


def records(spark: SparkSession, path: str) -> DataFrame:
    """query_id, batch_id, rows, times and rates of every batch that was recorded."""
    if not Files(spark, path).names(""):
        return spark.createDataFrame([], schemas.PROGRESS_SCHEMA)
    every = spark.read.schema(schemas.PROGRESS_SCHEMA).option("recursiveFileLookup", "true").json(path)
    rest = [F.col(c).desc_nulls_last() for c in every.columns if c not in ("query_id", "batch_id", "ts")]
    return keep_latest(every, ["query_id", "batch_id"], [F.col("ts").desc_nulls_last(), *rest])
