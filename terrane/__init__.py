"""terrane: property-market analytics expressed as Spark DataFrame plans.

Every public operator is a function ``f(df, ..., params) -> DataFrame``: it takes
DataFrames, returns a DataFrame, triggers no action and reads no session global.
Parameters that the reference took from the wall clock (``as_of``) or a random
state (``seed``) are explicit arguments.
"""

__all__ = ["session"]
