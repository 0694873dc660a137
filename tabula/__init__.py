"""tabula: tabular profiling, sampling, feature encoding, model fitting and
evaluation as Spark DataFrame / Spark ML jobs."""

__version__ = "0.1.0"
