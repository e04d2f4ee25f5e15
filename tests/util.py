import datetime as dt
import decimal

AS_OF = dt.datetime(2024, 1, 1)


def norm(v):
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral() else str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    return sorted(
        (tuple(norm(r[i]) for i in order) for r in rows),
        key=lambda t: tuple((x is None, str(x)) for x in t),
    )


def rows(df, *cols):
    """Rows of ``df`` as sorted tuples of ``cols`` (all columns when none given)."""
    cols = cols or tuple(df.columns)
    return sorted(
        (tuple(r[c] for c in cols) for r in df.select(*cols).collect()),
        key=lambda t: tuple((x is None, str(x)) for x in t),
    )
