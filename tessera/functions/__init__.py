from tessera.functions.vectors import (  # noqa: F401
    distance_to_literal, euclidean, euclidean_2d, metric_distance,
    seeded_key, seeded_uniform, sq_euclidean,
)
