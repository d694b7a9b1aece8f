"""siteatlas: captured web pages and price payloads in, a reconciled and priced site catalog out."""

import sys

from pyspark import cloudpickle

# Ship the page-reading code with the task, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from siteatlas.spec import SiteSpec  # noqa: E402

__all__ = ["SiteSpec"]
