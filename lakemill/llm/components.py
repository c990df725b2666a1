"""Connected components of a distributed edge list."""

from lakemill.operators.components import components

__all__ = ["components"]
