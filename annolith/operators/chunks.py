"""Chunks as a log of events: state, views and reports. A log row is (chunk_id, seq, event, worker); ``seq`` orders a chunk's events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The state that each event leads to.
LEADS_TO = {"add": "pending", "assign": "assigned", "complete": "completed", "fail": "failed", "retry": "pending", "release": "pending"}


def add_chunks(known: DataFrame, offered: DataFrame, key: str = "chunk_id") -> DataFrame:
    """The offered chunks that are not known yet, each once; known ones are never overwritten. Null keys are left out."""
    return offered.where(F.col(key).isNotNull()).dropDuplicates([key]).join(known.select(key).distinct(), key, "left_anti")


def chunk_states(log: DataFrame) -> DataFrame:
    """(chunk_id, status, worker, n_assigned, was_completed) after the last event of each chunk that was added.

    Unknown events change nothing; a chunk that is pending or failed has no worker. Partial aggregation keeps long logs of one
    chunk from gathering in one task; of events with equal ``seq`` the last by name counts.
    """
    status = F.lit(None).cast("string")
    for event, state in LEADS_TO.items():
        status = F.when(F.col("event") == event, state).otherwise(status)
    rows = log.withColumn("status", status).where("status is not null")
    last = F.max(F.struct("seq", "event", "status", "worker"))
    out = rows.groupBy("chunk_id").agg(last.alias("l"), F.count_if(F.col("event") == "assign").alias("n_assigned"), F.bool_or(F.col("event") == "complete").alias("was_completed"), F.bool_or(F.col("event") == "add").alias("_a"))
    holds = F.col("l.status").isin("assigned", "completed")
    return out.where("_a").select("chunk_id", F.col("l.status").alias("status"), F.when(holds, F.col("l.worker")).alias("worker"), "n_assigned", "was_completed")


def released(states: DataFrame, worker: str) -> DataFrame:
    """States after a worker left: what it was assigned is pending again, what it completed stays."""
    gone = (F.col("worker") == worker) & (F.col("status") == "assigned")
    return states.withColumns({"status": F.when(gone, "pending").otherwise(F.col("status")), "worker": F.when(gone, None).otherwise(F.col("worker"))})


def shard_completion(states: DataFrame, shard: Column) -> DataFrame:
    """(shard, n_chunks, n_pending, is_complete): complete where all chunks are; shards without chunks have no row and count as incomplete."""
    done = F.col("status") == "completed"
    return states.groupBy(shard.alias("shard")).agg(F.count("*").alias("n_chunks"), F.count_if(F.col("status") == "pending").alias("n_pending"), F.bool_and(done).alias("is_complete"))


def processor_stats(states: DataFrame) -> DataFrame:
    """One row: total, pending, assigned, completed, failed chunks and the workers that hold any."""
    count = lambda s: F.count_if(F.col("status") == s).alias(s)
    return states.agg(F.count("*").alias("total"), *map(count, ("pending", "assigned", "completed", "failed")), F.countDistinct(F.when(F.col("status") == "assigned", F.col("worker"))).alias("workers"))


def jobs_by_chunk(jobs: DataFrame, parsed: str = "p") -> DataFrame:
    """(shard, chunk, n_jobs, lowest, highest) of parsed job ids; invalid ones are left out."""
    p = lambda f: F.col(f"{parsed}.{f}")
    rows = jobs.where(p("valid"))
    return rows.groupBy(p("shard").alias("shard"), p("chunk").alias("chunk")).agg(F.count("*").alias("n_jobs"), F.min(p("idx")).alias("lowest"), F.max(p("idx")).alias("highest"))


def gap_report(untiled: DataFrame, key: str = "shard") -> DataFrame:
    """(key, n_gaps, report): a line for each chunk that does not begin where the one before ends."""
    line = F.format_string("chunk at %d, expected %d", F.col("start"), F.col("expected"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("start", line.alias("line")))), lambda s: s["line"])
    return untiled.groupBy(key).agg(F.count("*").alias("n_gaps"), F.array_join(lines, "\n").alias("report"))


def log_gate(seconds_since: Column, rows_since: Column, *, least_seconds: float = 10, least_rows: int = 50) -> Column:
    """Whether a flush is worth a line: long enough after the last one, or enough rows since."""
    return (seconds_since >= least_seconds) | (rows_since >= least_rows)
