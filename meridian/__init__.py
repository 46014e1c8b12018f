"""meridian: Spark-native graph, clustering and learning analytics.

Every operator takes and returns DataFrames; Catalyst plans the work.
Sub-packages:

* ``sources``    readers, writers and the test-table derivations (fixtures)
* ``functions``  column expressions (distances, kernels, hash draws)
* ``operators``  relational steps, k-center, graph, link prediction,
                 sparse linear algebra and semi-supervised learning
* ``plans``      iteration helper and the registered query catalogue
* ``streaming``  nothing: the analytics this library covers are batch only
"""

from meridian.session import get_session, ensure_checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
