"""Text of a frame's plan."""

from pyspark.sql import DataFrame


def planned(df: DataFrame) -> str:
    """The physical plan before it runs."""
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df: DataFrame) -> str:
    """The physical plan after adaptive execution has run it to its end."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString()
