"""The 46 attributes of a span: type, empty value and rule."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from lumenspan.functions.rules import Anything, AtLeast, AtLeastColumn, Between, Either, Equals, Matches, NotBoth, NotEmpty, OneOf, Rule, Where

# The categories of the enumerated attributes, in order.
STATUSES = ("STATUS_CODE_UNSET", "STATUS_CODE_OK", "STATUS_CODE_ERROR")
KINDS = ("llm", "start_agent", "chain", "tool", "retriever", "input_request", "output_request", "kafka_produce", "kafka_consume", "other", "guard")
METHODS = ("GET", "POST", "PUT", "DELETE", "PATCH", "HEAD", "OPTIONS")

# What stands for an absent value by type, and for one that cannot be cast.
EMPTY = {"string": "", "long": -1, "float": -1.0, "boolean": False}
TRASH = {"string": "TRASH", "long": -2, "float": -2.0}

TYPES = {"string": T.StringType(), "long": T.LongType(), "float": T.FloatType(), "boolean": T.BooleanType()}


@dataclass(frozen=True)
class Attr:
    name: str
    type: str
    mandatory: bool
    empty: object
    rule: Rule
    domain: tuple[str, ...] = ()

    @property
    def trash(self) -> object:
        return TRASH.get(self.type)


def _attr(name: str, kind: str, rule: Rule, mandatory: bool = False, empty: object = "by type", domain: tuple[str, ...] = ()) -> Attr:
    return Attr(name, kind, mandatory, EMPTY[kind] if empty == "by type" else empty, rule, domain)


def _llm(rule: Rule, kind: str) -> Rule:
    return Where("aef_kind", ("llm",), rule, Equals(EMPTY[kind]))


def _http(rule: Rule, empty: object) -> Rule:
    return Where("aef_kind", ("input_request", "output_request"), rule, Equals(empty))


def _kafka(rule: Rule) -> Rule:
    return Where("aef_kind", ("kafka_produce", "kafka_consume"), rule, Equals(""))


_BASE64, _JSON, _STRINGS = Matches("base64"), Matches("json"), Matches("json_strings")
_FLAGS = NotBoth("session_id_derived", "session_id_generated")

SPEC: tuple[Attr, ...] = (
    _attr("trace_id", "string", _BASE64, True, None),
    _attr("span_id", "string", _BASE64, True, None),
    _attr("parent_span_id", "string", Either(_BASE64, Equals("root")), True, "root"),
    _attr("origin_span_id", "string", Either(_BASE64, Equals("outside")), True, "outside"),
    _attr("agent_id", "string", Matches("element"), True, None),
    _attr("session_id", "string", Matches("one_line"), True, None),
    _attr("start_time_ns", "long", AtLeast(0), True, None),
    _attr("end_time_ns", "long", AtLeastColumn("start_time_ns"), True, None),
    _attr("status_code", "string", OneOf(STATUSES), False, "STATUS_CODE_UNSET", (*STATUSES, "TRASH")),
    _attr("status_message", "string", Where("status_code", ("STATUS_CODE_ERROR",), NotEmpty(), Equals(""))),
    _attr("aef_kind", "string", OneOf(KINDS), True, None, (*KINDS, "TRASH")),
    _attr("span_name", "string", NotEmpty(), False, None),
    _attr("input_text", "string", Either(Equals(""), _JSON), True),
    _attr("output_text", "string", Anything(), True),
    _attr("llm_model", "string", _llm(NotEmpty(), "string")),
    _attr("llm_prompt_tokens", "long", _llm(AtLeast(0), "long")),
    _attr("llm_completion_tokens", "long", _llm(AtLeast(0), "long")),
    _attr("llm_total_tokens", "long", _llm(AtLeast(0), "long")),
    _attr("llm_precached_prompt_tokens", "long", _llm(AtLeast(0), "long")),
    _attr("llm_temperature", "float", _llm(AtLeast(0), "float")),
    _attr("llm_top_p", "float", _llm(Between(0, 1), "float")),
    _attr("llm_max_tokens", "long", _llm(AtLeast(0), "long")),
    _attr("llm_repetition_penalty", "float", _llm(AtLeast(1), "float")),
    _attr("llm_profanity_check", "boolean", _llm(Anything(), "boolean")),
    _attr("llm_stream", "boolean", _llm(Anything(), "boolean")),
    _attr("http_method", "string", _http(OneOf(METHODS), "NONE"), False, "NONE", (*METHODS, "NONE", "TRASH")),
    _attr("http_path", "string", _http(NotEmpty(), "")),
    _attr("http_status_code", "long", _http(Between(100, 599), -1)),
    _attr("request_headers", "string", _http(_JSON, "")),
    _attr("response_headers", "string", _http(_JSON, "")),
    _attr("kafka_topic", "string", _kafka(NotEmpty())),
    _attr("kafka_cluster", "string", _kafka(NotEmpty())),
    _attr("kafka_consumer_group", "string", Where("aef_kind", ("kafka_consume",), NotEmpty(), Equals(""))),
    _attr("kafka_bootstrap_servers", "string", _kafka(_STRINGS)),
    _attr("meta_langgraph_step", "long", AtLeast(-1)),
    _attr("meta_langgraph_node", "string", Anything()),
    _attr("meta_langgraph_triggers", "string", Either(Equals(""), _STRINGS)),
    _attr("meta_langgraph_path", "string", Either(Equals(""), _STRINGS)),
    _attr("meta_checkpoint_ns", "string", Anything()),
    _attr("meta_tags", "string", Either(Equals(""), _STRINGS)),
    _attr("meta_extra", "string", Either(Equals(""), _JSON)),
    _attr("service_name", "string", Anything()),
    _attr("service_version", "string", Anything()),
    _attr("session_id_derived", "boolean", _FLAGS, True, None),
    _attr("session_id_generated", "boolean", _FLAGS, True, None),
    _attr("nexus_distrib_ver", "string", Matches("version"), False, None),
)

BY_NAME = {a.name: a for a in SPEC}
MANDATORY = tuple(a for a in SPEC if a.mandatory)
OPTIONAL = tuple(a for a in SPEC if not a.mandatory)
NUMERIC = tuple(a for a in SPEC if a.type in ("long", "float"))
#: Attributes whose value must not change within a trace.
INVARIANTS = ("agent_id", "session_id", "service_name", "service_version", "nexus_distrib_ver")
