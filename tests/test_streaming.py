"""The stream's buckets equal those of a batch."""

from pyspark.sql import functions as F

from lumenspan.operators.recast import recast
from lumenspan.sources.spans import event_spans
from lumenspan.streaming.flow import span_flow


def test_stream_equals_batch(spark, sf, tmp_path):
    spans = recast(event_spans(spark, sf))
    path = str(tmp_path / "spans")
    spans.repartition(3).write.parquet(path)
    stream = spark.readStream.schema(spans.schema).option("maxFilesPerTrigger", 1).parquet(path)
    query = span_flow(stream, "1 day", "60 days").writeStream.format("memory").queryName("flow").outputMode("complete").start()
    query.processAllAvailable()
    query.stop()
    rounded = lambda df: sorted(map(tuple, df.select("ts", "spans", "rejected_spans", *[F.round(c, 9) for c in ("validity", "defect", "error_rate")]).collect()))
    assert rounded(spark.table("flow")) == rounded(span_flow(spans, "1 day"))
