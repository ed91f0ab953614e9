"""tessera: a PySpark-native feature-preparation, tensor-scoring and training engine.

Everything is expressed as DataFrame plans: statistics are one aggregate pass each,
transforms are projections, splits and folds are exact distributed ranks, tensor layers
are joins + group-bys (cell form) or Arrow-batched NumPy kernels (packed form), and
training is a loop of data-parallel gradient jobs.

Main entry points::

    from tessera.plans.tabular import TabularOptions, TabularPrep      # tabular fit/transform/split
    from tessera.plans.images import prepare_image_sets                 # image folder → sets
    from tessera.operators import splits, metrics, prep, tensor, grads  # building blocks
    from tessera.plans import kernels, networks                         # layer specs, LeNet-5, MLP
    from tessera.plans.scoring import score                             # batch scoring
    from tessera.plans.training import train_network, cnn_config, mlp_config
    from tessera.plans.crossval import cv_scores, cv_grid_scores, best_cell
"""

__version__ = "0.1.0"
