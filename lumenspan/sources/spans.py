"""Sources of spans."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenspan.operators.recast import recast


def open_spans(spark: SparkSession, spans: Any = None, path: str | None = None) -> DataFrame:
    """A DataFrame as it is, a pandas frame, or Parquet at a file, folder or glob; data that is handed over wins over the path."""
    if spans is not None:
        return spans if isinstance(spans, DataFrame) else spark.createDataFrame(spans)
    if not path:
        raise ValueError("give spans or a path")
    return spark.read.parquet(path)


def scan(spark: SparkSession, path: str) -> DataFrame:
    """Parquet brought to the specification."""
    return open_spans(spark, path=path).transform(recast)


#: Spans as a view of the ``events`` table, with defects of every kind placed by the event's number. The expressions are
#: common to Spark and DuckDB but for ``{us}``, the microseconds of ``ts``. kafka_cluster and meta_tags are left out.
_N, _T = "event_id", "cast((event_id - event_id % 5) / 5 AS bigint)"
_KIND = "CASE event_type WHEN 'view' THEN 'input_request' WHEN 'click' THEN 'llm' WHEN 'purchase' THEN 'tool' WHEN 'signup' THEN 'kafka_produce' ELSE 'output_request' END"
_LLM = "event_type = 'click'"
EVENT_SPANS = {
    "trace_id": f"CASE WHEN {_N} % 211 = 0 THEN 'bad id!' WHEN {_N} % 997 = 5 THEN NULL ELSE concat('T', lpad(cast({_T} AS string), 8, '0')) END",
    "span_id": f"concat('S', lpad(cast(CASE WHEN {_N} % 503 = 7 THEN {_N} - 1 ELSE {_N} END AS string), 8, '0'))",
    "parent_span_id": f"CASE WHEN {_N} % 5 = 0 THEN 'root' WHEN {_N} % 401 = 3 THEN '' ELSE concat('S', lpad(cast({_N} - 1 AS string), 8, '0')) END",
    "origin_span_id": f"CASE WHEN {_N} % 4 = 0 THEN 'outside' WHEN {_N} % 409 = 2 THEN NULL ELSE 'SAbc9/+=' END",
    "agent_id": f"CASE WHEN {_N} % 307 = 11 THEN 'agent' WHEN {_N} % 613 = 2 THEN NULL ELSE concat('CI', cast({_T} % 3 AS string)) END",
    "session_id": f"CASE WHEN {_N} % 97 = 3 THEN NULL WHEN {_N} % 89 = 1 THEN 'other' ELSE concat('sess', cast({_T} % 50 AS string)) END",
    "start_time_ns": "{us} * 1000",
    "end_time_ns": f"{{us}} * 1000 + CASE WHEN {_N} % 353 = 4 THEN -1 ELSE cast(floor(coalesce(value, 0) * 1000) AS bigint) * 1000 END",
    "status_code": f"CASE WHEN {_N} % 431 = 8 THEN 'WEIRD' WHEN event_type = 'error' THEN 'STATUS_CODE_ERROR' WHEN {_N} % 7 = 1 THEN NULL ELSE 'STATUS_CODE_OK' END",
    "status_message": f"CASE WHEN event_type = 'error' AND {_N} % 3 > 0 THEN 'failed' WHEN {_N} % 499 = 9 THEN 'stray' ELSE '' END",
    "aef_kind": f"CASE WHEN {_N} % 457 = 6 THEN 'unheard' ELSE {_KIND} END",
    "span_name": f"CASE WHEN {_N} % 283 = 5 THEN '' ELSE concat(event_type, cast({_N} % 4 AS string)) END",
    "input_text": f"CASE WHEN {_N} % 223 = 1 THEN 'plain' WHEN {_N} % 11 = 0 THEN '' ELSE props END",
    "output_text": f"CASE WHEN {_N} % 13 = 0 THEN NULL ELSE concat('[', cast({_N} % 17 AS string), ']') END",
    "llm_model": f"CASE WHEN {_LLM} AND {_N} % 5 > 0 THEN 'small' ELSE '' END",
    "llm_prompt_tokens": f"CASE WHEN {_LLM} THEN cast({_N} % 900 AS string) WHEN {_N} % 337 = 3 THEN '12.5' END",
    "llm_completion_tokens": f"CASE WHEN {_LLM} THEN {_N} % 300 END",
    "llm_total_tokens": f"CASE WHEN {_LLM} AND {_N} % 6 > 0 THEN {_N} % 1200 END",
    "llm_precached_prompt_tokens": f"CASE WHEN {_LLM} THEN 0 ELSE -1 END",
    "llm_temperature": f"CASE WHEN {_LLM} THEN ({_N} % 20) / 8.0 ELSE -1.0 END",
    "llm_top_p": f"CASE WHEN {_LLM} THEN ({_N} % 5) / 4.0 - CASE WHEN {_N} % 41 = 0 THEN 2 ELSE 0 END END",
    "llm_max_tokens": f"CASE WHEN {_LLM} THEN 4096 WHEN {_N} % 251 = 0 THEN 1 ELSE -1 END",
    "llm_repetition_penalty": f"CASE WHEN {_LLM} THEN 1.25 - CASE WHEN {_N} % 37 = 0 THEN 1 ELSE 0 END END",
    "llm_profanity_check": f"CASE {_N} % 4 WHEN 0 THEN ' Yes' WHEN 1 THEN 'f' WHEN 2 THEN '0' ELSE 'maybe' END",
    "llm_stream": f"{_LLM} AND {_N} % 2 = 0",
    "http_method": f"CASE WHEN event_type IN ('view', 'error') THEN CASE {_N} % 3 WHEN 0 THEN 'GET' WHEN 1 THEN 'POST' END WHEN {_N} % 263 = 4 THEN 'TRACE' ELSE 'NONE' END",
    "http_path": f"CASE WHEN event_type IN ('view', 'error') AND {_N} % 9 > 0 THEN '/a' ELSE '' END",
    "http_status_code": f"CASE WHEN event_type IN ('view', 'error') THEN CASE WHEN {_N} % 43 = 0 THEN 'none' WHEN {_N} % 29 = 0 THEN '700' ELSE ' 200 ' END END",
    "request_headers": "CASE WHEN event_type IN ('view', 'error') THEN props ELSE '' END",
    "response_headers": f"CASE WHEN event_type IN ('view', 'error') AND {_N} % 10 > 0 THEN concat(' ', props, ' ') ELSE '' END",
    "kafka_topic": "CASE WHEN event_type = 'signup' THEN 'topic' ELSE '' END",
    "kafka_consumer_group": f"CASE WHEN {_N} % 239 = 1 THEN 'group' ELSE '' END",
    "kafka_bootstrap_servers": f"CASE WHEN event_type = 'signup' THEN CASE WHEN {_N} % 3 = 0 THEN '[]' ELSE '[\"a:1\", \"b:2\"]' END ELSE '' END",
    "meta_langgraph_step": f"{_N} % 9 - 2",
    "meta_langgraph_node": f"concat('node', cast({_N} % 3 AS string))",
    "meta_langgraph_triggers": f"CASE {_N} % 3 WHEN 0 THEN '' WHEN 1 THEN '[ \"x\" ]' ELSE '[\"x\",]' END",
    "meta_langgraph_path": "'[\"p\", \"q\"]'",
    "meta_checkpoint_ns": "cast(NULL AS string)",
    "meta_extra": f"CASE WHEN {_N} % 2 = 0 THEN '{{{{}}}}' ELSE '{{{{' END",
    "service_name": "'shop'",
    "service_version": f"CASE WHEN {_N} % 199 = 2 THEN NULL ELSE '1.0' END",
    "session_id_derived": f"{_N} % 3 = 0",
    "session_id_generated": f"CASE WHEN {_N} % 5 = 0 THEN 'true' WHEN {_N} % 149 = 1 THEN 'unsure' ELSE 'no' END",
    "nexus_distrib_ver": f"CASE {_N} % 50 WHEN 0 THEN 'dev' WHEN 1 THEN NULL ELSE concat('2.', cast({_T} % 2 AS string), '.?') END",
    "unlisted": f"{_N}",
}


def event_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw spans over ``events``: strings for numbers, missing columns, and one column that the specification lacks."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return events.withColumn("us", us).selectExpr(*[f"{e.format(us='us')} AS {name}" for name, e in EVENT_SPANS.items()])
