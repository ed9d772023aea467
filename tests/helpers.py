"""Helpers of the tests; a conftest is never imported, since each folder has its own."""


def rows(df, *columns):
    """Rows as sorted tuples, for order-free comparison."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
