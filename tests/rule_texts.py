"""The 46 attributes in DuckDB's SQL, written by hand: what the trees of the specification are held against."""

_LONG, _TEXT = "BIGINT", "VARCHAR"
_B64 = "'^[A-Za-z0-9+/]+={0,2}$'"
_JSON = r"'^\s*(\{[\s\S]*\}|\[[\s\S]*\])\s*$'"
_ARRAY = r"""'^\[\s*"([^"\\]|\\.)*"(\s*,\s*"([^"\\]|\\.)*")*\s*\]$'"""


def _llm(ok: str, empty: str) -> str:
    return f"CASE WHEN aef_kind = 'llm' THEN {ok} ELSE {empty} END"


def _http(ok: str, empty: str) -> str:
    return f"CASE WHEN aef_kind IN ('input_request', 'output_request') THEN {ok} ELSE {empty} END"


def _kafka(name: str, ok: str) -> str:
    return f"CASE WHEN aef_kind IN ('kafka_produce', 'kafka_consume') THEN {ok} ELSE {name} = '' END"


def _match(name: str, pattern: str, options: str = "") -> str:
    return f"regexp_matches({name}, {pattern}{options})"


#: name: (type, empty literal or None, mandatory, rule)
COLUMNS = {
    "trace_id": (_TEXT, None, True, _match("trace_id", _B64)),
    "span_id": (_TEXT, None, True, _match("span_id", _B64)),
    "parent_span_id": (_TEXT, "'root'", True, f"{_match('parent_span_id', _B64)} OR parent_span_id = 'root'"),
    "origin_span_id": (_TEXT, "'outside'", True, f"{_match('origin_span_id', _B64)} OR origin_span_id = 'outside'"),
    "agent_id": (_TEXT, None, True, _match("agent_id", "'^C[IE][0-9]+$'")),
    "session_id": (_TEXT, None, True, _match("session_id", "'^.+$'")),
    "start_time_ns": (_LONG, None, True, "start_time_ns >= 0"),
    "end_time_ns": (_LONG, None, True, "end_time_ns >= start_time_ns"),
    "status_code": (("STATUS_CODE_UNSET", "STATUS_CODE_OK", "STATUS_CODE_ERROR", "TRASH"), "'STATUS_CODE_UNSET'", False, "status_code IN ('STATUS_CODE_UNSET', 'STATUS_CODE_OK', 'STATUS_CODE_ERROR')"),
    "status_message": (_TEXT, "''", False, "CASE WHEN status_code = 'STATUS_CODE_ERROR' THEN length(status_message) > 0 ELSE status_message = '' END"),
    "aef_kind": (
        ("llm", "start_agent", "chain", "tool", "retriever", "input_request", "output_request", "kafka_produce", "kafka_consume", "other", "guard", "TRASH"),
        None,
        True,
        "aef_kind IN ('llm', 'start_agent', 'chain', 'tool', 'retriever', 'input_request', 'output_request', 'kafka_produce', 'kafka_consume', 'other', 'guard')",
    ),
    "span_name": (_TEXT, None, False, "length(span_name) > 0"),
    "input_text": (_TEXT, "''", True, f"input_text = '' OR {_match('input_text', _JSON)}"),
    "output_text": (_TEXT, "''", True, "true"),
    "llm_model": (_TEXT, "''", False, _llm("length(llm_model) > 0", "llm_model = ''")),
    "llm_prompt_tokens": (_LONG, "-1", False, _llm("llm_prompt_tokens >= 0", "llm_prompt_tokens = -1")),
    "llm_completion_tokens": (_LONG, "-1", False, _llm("llm_completion_tokens >= 0", "llm_completion_tokens = -1")),
    "llm_total_tokens": (_LONG, "-1", False, _llm("llm_total_tokens >= 0", "llm_total_tokens = -1")),
    "llm_precached_prompt_tokens": (_LONG, "-1", False, _llm("llm_precached_prompt_tokens >= 0", "llm_precached_prompt_tokens = -1")),
    "llm_temperature": ("FLOAT", "-1.0", False, _llm("llm_temperature >= 0", "llm_temperature = -1.0")),
    "llm_top_p": ("FLOAT", "-1.0", False, _llm("llm_top_p BETWEEN 0 AND 1", "llm_top_p = -1.0")),
    "llm_max_tokens": (_LONG, "-1", False, _llm("llm_max_tokens >= 0", "llm_max_tokens = -1")),
    "llm_repetition_penalty": ("FLOAT", "-1.0", False, _llm("llm_repetition_penalty >= 1", "llm_repetition_penalty = -1.0")),
    "llm_profanity_check": ("BOOLEAN", "false", False, _llm("true", "NOT llm_profanity_check")),
    "llm_stream": ("BOOLEAN", "false", False, _llm("true", "NOT llm_stream")),
    "http_method": (("GET", "POST", "PUT", "DELETE", "PATCH", "HEAD", "OPTIONS", "NONE", "TRASH"), "'NONE'", False, _http("http_method IN ('GET', 'POST', 'PUT', 'DELETE', 'PATCH', 'HEAD', 'OPTIONS')", "http_method = 'NONE'")),
    "http_path": (_TEXT, "''", False, _http("length(http_path) > 0", "http_path = ''")),
    "http_status_code": (_LONG, "-1", False, _http("http_status_code BETWEEN 100 AND 599", "http_status_code = -1")),
    "request_headers": (_TEXT, "''", False, _http(_match("request_headers", _JSON), "request_headers = ''")),
    "response_headers": (_TEXT, "''", False, _http(_match("response_headers", _JSON), "response_headers = ''")),
    "kafka_topic": (_TEXT, "''", False, _kafka("kafka_topic", "length(kafka_topic) > 0")),
    "kafka_cluster": (_TEXT, "''", False, _kafka("kafka_cluster", "length(kafka_cluster) > 0")),
    "kafka_consumer_group": (_TEXT, "''", False, "CASE WHEN aef_kind = 'kafka_consume' THEN length(kafka_consumer_group) > 0 ELSE kafka_consumer_group = '' END"),
    "kafka_bootstrap_servers": (_TEXT, "''", False, _kafka("kafka_bootstrap_servers", _match("kafka_bootstrap_servers", _ARRAY))),
    "meta_langgraph_step": (_LONG, "-1", False, "meta_langgraph_step >= -1"),
    "meta_langgraph_node": (_TEXT, "''", False, "true"),
    "meta_langgraph_triggers": (_TEXT, "''", False, f"meta_langgraph_triggers = '' OR {_match('meta_langgraph_triggers', _ARRAY)}"),
    "meta_langgraph_path": (_TEXT, "''", False, f"meta_langgraph_path = '' OR {_match('meta_langgraph_path', _ARRAY)}"),
    "meta_checkpoint_ns": (_TEXT, "''", False, "true"),
    "meta_tags": (_TEXT, "''", False, f"meta_tags = '' OR {_match('meta_tags', _ARRAY)}"),
    "meta_extra": (_TEXT, "''", False, f"meta_extra = '' OR {_match('meta_extra', _JSON)}"),
    "service_name": (_TEXT, "''", False, "true"),
    "service_version": (_TEXT, "''", False, "true"),
    "session_id_derived": ("BOOLEAN", None, True, "NOT (session_id_derived AND session_id_generated)"),
    "session_id_generated": ("BOOLEAN", None, True, "NOT (session_id_derived AND session_id_generated)"),
    "nexus_distrib_ver": (_TEXT, None, False, _match("nexus_distrib_ver", r"'^(\d+|\?)\.(\d+|\?)\.(\d+|\?)$'")),
}
