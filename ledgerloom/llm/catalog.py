"""All queries of this package."""

from importlib import import_module

from ledgerloom.llm.modules import QUERY_MODULES
from ledgerloom.llm.registry import REGISTRY

for _name in QUERY_MODULES:
    import_module(_name)

__all__ = ["REGISTRY"]
