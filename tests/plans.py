"""Reading physical plans."""

from pyspark.sql import DataFrame


def plan(df: DataFrame) -> str:
    text = df._jdf.queryExecution().toString()
    return text[text.index("== Physical Plan"):]
