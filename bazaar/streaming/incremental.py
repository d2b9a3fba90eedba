"""Incremental enrichment of raw tables with Structured Streaming.

The six intermediate models are stateless one-row-in, one-row-out
projections, so the very same functions run on a file stream: raw Parquet
files landing in a table's folder are typed, normalised and flagged, then
appended to the enriched table. Progress (which files were processed) lives
in a checkpoint under the shared checkpoint folder, so a restarted or
failed query resumes without reprocessing or losing files.

No watermark or state is needed: nothing is aggregated across rows. The job
facts and scorecards aggregate across payouts and adjustments that arrive
days after a job (the late adjustments of the reconciliation), so they stay
batch recomputations over the enriched tables.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from bazaar.operators import intermediate as im
from bazaar.session import checkpoint_dir
from bazaar.sources import RAW_SCHEMAS, staged

ENRICH = {
    "users": (im.users_enriched, "int_users_enriched"),
    "contractor_profiles": (im.contractor_profiles_enriched, "int_contractor_profiles_enriched"),
    "services": (im.services_enriched, "int_services_enriched"),
    "jobs": (im.jobs_enriched, "int_jobs_enriched"),
    "adjustments": (im.adjustments_enriched, "int_adjustments_enriched"),
    "payouts": (im.payouts_enriched, "int_payouts_enriched"),
}


def enriched_stream(spark: SparkSession, table: str, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of the enriched rows of one raw table folder."""
    reader = spark.readStream.schema(RAW_SCHEMAS[table])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.parquet(os.path.join(source_dir, f"{table}.parquet"))
    enrich, _ = ENRICH[table]
    return enrich(staged(raw, table))


def start_enrichment(
    spark: SparkSession,
    table: str,
    source_dir: str,
    sink_dir: str,
    checkpoint: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Append enriched rows of ``table`` to ``sink_dir/<model>`` as Parquet.

    ``available_now`` processes everything present and stops (a scheduled
    incremental run); otherwise the query keeps polling for new files.
    """
    _, model = ENRICH[table]
    sink = os.path.join(sink_dir, model)
    # progress belongs to one source and one sink: another pair must not resume from it
    pair = hashlib.sha256(f"{source_dir}|{sink}".encode()).hexdigest()[:16]
    location = checkpoint or os.path.join(checkpoint_dir(spark), "streams", f"{model}-{pair}")
    writer = (
        enriched_stream(spark, table, source_dir)
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", location)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.queryName(f"enrich_{table}").start()
