"""Names shared by the tests of this folder."""

SF_SMALL = "/root/testdata/sf0.001"


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]
