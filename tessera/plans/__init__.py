"""Physical building blocks: the block-pair plan, centre plans, Arrow kernels.

Functions of these modules run inside Python workers. They are
registered for pickling by value, so every task carries their code and the
executors need no copy of this package (no ``--py-files`` required).
"""

from pyspark import cloudpickle

from tessera.plans import blocks as _blocks
from tessera.plans import bounds as _bounds
from tessera.plans import cells as _cells
from tessera.plans import hull as _hull
from tessera.plans import kernels as _kernels
from tessera.plans import lazy as _lazy
from tessera.plans import pairs as _pairs
from tessera.plans import shards as _shards

for _module in (_cells, _kernels, _blocks, _shards, _pairs, _hull, _lazy, _bounds):
    cloudpickle.register_pickle_by_value(_module)
