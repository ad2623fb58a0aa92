"""Star-schema and data-quality jobs over a dirty, all-text catalogue extract."""

from starmill.config import Config
from starmill.plans.layers import Layers

__all__ = ["Config", "Layers"]
