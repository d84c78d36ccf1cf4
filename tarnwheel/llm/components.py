"""Connected components, which live with the other operators."""

from tarnwheel.operators.components import components

__all__ = ["components"]
