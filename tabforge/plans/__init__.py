"""Driver-table mappings of the four feature programs.

Importing this package registers every query in ``registry.QUERIES`` /
``registry.ORACLE``.
"""

from . import charts, cover, credit, events, io, loans, models, passenger, trip  # noqa: F401
from .registry import ORACLE, QUERIES  # noqa: F401
