"""Shared by the tests."""

import pandas as pd

DATA = "/root/testdata/sf0.001"


def rows(frame: pd.DataFrame) -> list:
    """Rows with columns by name and values as text, floats to six places, in any order."""
    cols = sorted(frame.columns)

    def text(v):
        if isinstance(v, float):
            return "None" if v != v else repr(int(v)) if v.is_integer() else repr(round(v, 6))
        return "None" if v is None or v is pd.NA or v is pd.NaT else str(v)

    return sorted(tuple(text(v) for v in r) for r in frame[cols].astype(object).itertuples(index=False))
