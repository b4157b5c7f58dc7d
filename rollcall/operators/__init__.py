from rollcall.operators import aggregates, filters, joins, topk, windows  # noqa: F401
