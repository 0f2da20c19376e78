"""REST APIs as Spark tables, and the queries over them."""

from .errors import EngineError, clean_errors
from .plans.engine import Engine

__all__ = ["Engine", "EngineError", "clean_errors"]
