"""What a task of the sharded centre rounds holds at once: little, and no more for more points."""

import tracemalloc

import numpy as np
import pyarrow as pa

from tessera.plans import shards as S


def table(n, dim, **columns):
    v = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * dim, pa.int32()), pa.array(np.random.default_rng(n).normal(size=n * dim)))
    return pa.table({"shard": pa.array(np.zeros(n), pa.int32()), "subs": pa.array(np.ones(n), pa.int32()), "v": v, **columns})


def test_a_group_takes_little_memory():
    for dim in (1, 4, 64):
        n = S.group_rows(36_000_000, dim, 12)
        assert n == S.group_rows(216_000_000, dim, 12)
        points = table(n, dim, id=pa.array(np.arange(n)), w=pa.array(np.ones(n)), u=pa.array(np.random.default_rng(0).random(n)),
                       d0=pa.array(np.full(n, np.inf)))
        assert points.nbytes < 1 << 26
        centres = table(4, dim, cid=pa.array(range(4), pa.int32()))
        for kernel in (S._pick_kernel("seed", "euclidean"), S._sums_kernel("euclidean")):
            tracemalloc.start()
            kernel(points, centres)
            peak = tracemalloc.get_traced_memory()[1]
            tracemalloc.stop()
            assert peak < 1 << 26, (dim, peak)
