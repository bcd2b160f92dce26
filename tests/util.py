from pyspark.sql import functions as F

NO_PYTHON = ("Python", "ArrowEval", "MapInPandas", "BatchEval")


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ts(value):
    return F.lit(value).cast("timestamp_ntz")
