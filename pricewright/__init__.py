"""pricewright: catalogue price prediction as Spark DataFrame and pyspark.ml jobs."""

__version__ = "0.1.0"
