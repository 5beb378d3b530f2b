"""The specification of spans, policies, verdicts, reports and the engine that ties them together."""
