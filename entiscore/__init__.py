"""entiscore: entity profiling and scoring as lazy Spark DataFrame operators.

Every public operator takes DataFrames and returns DataFrames (or a fitted
Spark ML model); nothing is pulled through the driver except documented,
size-bounded results (top-K lists, quantile split points, sweep tables).
"""

__version__ = "0.1.0"
