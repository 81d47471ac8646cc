"""Connected components: the engine's own, under the name that the operators of this subpackage use."""

from tributary.operators.cluster import connected

__all__ = ["connected"]
