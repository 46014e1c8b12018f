"""Imports every catalogue module so that all queries are registered."""

from meridian.plans import catalog  # noqa: F401
from meridian.plans import catalog_graph  # noqa: F401
from meridian.plans import catalog_vectors  # noqa: F401
from meridian.plans import catalog_linkpred  # noqa: F401
from meridian.plans import catalog_tables  # noqa: F401
from meridian.plans import catalog_math  # noqa: F401
from meridian.plans import catalog_community  # noqa: F401
from meridian.plans import catalog_io  # noqa: F401
