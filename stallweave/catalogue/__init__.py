"""The operators run on the sample tables, each with the SQL that must give the same rows."""

from stallweave.catalogue import control, indexing, layers, reports, sources, vectors  # noqa: F401
from stallweave.catalogue.registry import ORACLES, QUERIES  # noqa: F401
