"""Helpers of the tests."""

SMALL = "/root/testdata/sf0.001"


def rows_of(frame):
    """Rows with columns in order of name, as comparable texts."""
    columns = sorted(frame.columns)
    plain = frame[columns].astype(object).where(frame[columns].notna(), None)
    return sorted(map(repr, plain.itertuples(index=False, name=None)))
