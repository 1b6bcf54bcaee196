"""Domain queries. Importing a module registers its queries."""

from importlib import import_module

from .registry import REGISTRY

_MODULES = (
    "banking", "keys", "history", "changes", "loading", "security", "commerce", "tax", "health",
    "workforce", "insurance", "legal", "logistics", "factory", "realty", "telecom", "supply",
    "wholesale", "trust", "layout", "streams",
)


def load_all() -> dict:
    for name in _MODULES:
        import_module(f"{__name__}.{name}")
    return REGISTRY
