"""Helpers of the tests."""


def column(df, name=None):
    """The values of one column, or of the only one."""
    return [row[name or 0] for row in df.collect()]
