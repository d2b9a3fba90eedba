"""The streaming enrichment equals the batch intermediate model."""

from __future__ import annotations

import os
import tempfile

from conftest import SF_SMALL

from bazaar.plans.graph import Marketplace
from bazaar.sources import load_sources, write_sources
from bazaar.streaming import start_enrichment


def test_stream_enrichment_matches_batch(spark):
    raw_dir = tempfile.mkdtemp(prefix="bazaar-raw-")
    sink = tempfile.mkdtemp(prefix="bazaar-sink-")
    write_sources(load_sources(spark, SF_SMALL), raw_dir, files_per_table=3)
    for table in ("jobs", "payouts"):
        query = start_enrichment(spark, table, raw_dir, sink, checkpoint=tempfile.mkdtemp(prefix="bazaar-stream-"))
        query.awaitTermination(300)
        assert query.exception() is None
    batch = Marketplace.load(spark, raw_dir)
    for model in ("int_jobs_enriched", "int_payouts_enriched"):
        streamed = spark.read.parquet(os.path.join(sink, model))
        expected = batch.model(model)
        assert streamed.count() == expected.count()
        assert streamed.exceptAll(expected).count() == 0
