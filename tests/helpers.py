from datetime import datetime


def ts(text):
    return datetime.fromisoformat(text)


def rows(df, *columns):
    """Rows as sorted tuples; NULLs sort first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def names(row, column="_errors"):
    return [failure.name for failure in row[column] or []]
