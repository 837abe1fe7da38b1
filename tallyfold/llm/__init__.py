"""Training-data operators.

Nothing outside this subpackage (besides the guarded import in ``__spark_entry__.py`` and
``corpus_pipeline.py``) imports it.  Functions that run on executors are shipped by value, so a
cluster does not need the package installed on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
