"""Connected components, from the core: the same operator serves the pairwise matches here and the links of blocks there."""

from strandwise.operators.components import connected_components

__all__ = ["connected_components"]
