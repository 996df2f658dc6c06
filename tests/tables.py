"""Helpers the tests share."""


def rows(df, *order):
    """Rows as plain tuples, ordered by the given columns or by themselves."""
    out = [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return out if order else sorted(out, key=lambda t: tuple((v is None, str(v)) for v in t))
