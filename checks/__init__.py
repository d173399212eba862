"""The library's operators run on the driver tables, each beside an independent SQL text."""

from importlib import import_module

MODULES = (
    "analytics_checks",
    "quality_checks",
    "clean_checks",
    "workbook_checks",
    "join_checks",
    "store_checks",
    "ingest_checks",
)


def load_all() -> None:
    """Import every module that registers queries."""
    for module in MODULES:
        import_module(f"checks.{module}")
