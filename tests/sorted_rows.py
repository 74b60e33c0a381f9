"""Rows of a frame as sorted tuples."""


def rows(df, *cols):
    cols = cols or df.columns
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=lambda t: tuple((x is None, str(x)) for x in t))
