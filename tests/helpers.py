"""Small tools shared by the tests."""


def values(df, column):
    """One column, sorted, NULLs first."""
    got = [row[column] for row in df.select(column).collect()]
    return sorted(got, key=lambda v: (v is not None, v))


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def same(df, want, *columns):
    """Whether the rows are ``want``, in any order."""
    return rows(df, *columns) == sorted(want, key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
