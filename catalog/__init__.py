"""Every operator as a named query over the given tables, with the SQL it must agree with."""

from importlib import import_module
from pathlib import Path


def load() -> None:
    """Import every query module; importing registers its queries."""
    for path in sorted(Path(__file__).parent.glob("queries_*.py")):
        import_module(f"catalog.{path.stem}")
