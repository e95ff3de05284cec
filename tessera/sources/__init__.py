from pyspark import cloudpickle

from tessera.sources import splits as _splits
from tessera.sources.splits import lines_with_place  # noqa: F401
from tessera.sources.text import (  # noqa: F401
    line_documents, pair_lines, parse_pairs, parse_points, read_lines, read_points,
)

# the reader runs in Python workers, which need no copy of this package
cloudpickle.register_pickle_by_value(_splits)
