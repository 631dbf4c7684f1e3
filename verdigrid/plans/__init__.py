"""Registered queries; importing this package fills the registry."""

from importlib import import_module

_FAMILIES = (
    "projections",
    "filters",
    "aggregates",
    "ordering",
    "sets",
    "conditionals",
    "joins",
    "nested",
    "reshape",
    "keyed",
    "scans",
    "sinks",
    "layouts",
    "lookups",
    "streams",
    "logs",
    "flows",
)

for _family in _FAMILIES:
    import_module(f"{__name__}.{_family}")

from verdigrid.plans.registry import QUERIES  # noqa: E402

__all__ = ["QUERIES"]
