"""The modules that register this package's queries."""

QUERY_MODULES = tuple(
    f"ledgerloom.llm.queries_{name}"
    for name in ("alignment", "archives", "copies", "leaks", "native", "pages", "quality", "ranking", "vectors")
)
