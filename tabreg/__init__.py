"""tabreg: a Spark-native tabular regression pipeline.

Subpackages: ``sources`` (readers, writers, ingestion), ``functions`` (Column
math: activations, losses), ``operators`` (scalers, positions, metrics,
matrices, networks, training, run tables), ``plans`` (fixtures, end-to-end
workflows, the registered query catalogue), ``streaming`` (stream scoring).
"""

__version__ = "0.1.0"
