"""What several test files use."""


def rows_of(df):
    rows = [tuple(row) for row in df.collect()]
    return sorted(rows, key=lambda row: [(value is not None, value) for value in row])


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
