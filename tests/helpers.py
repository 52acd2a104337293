from datetime import datetime, timezone

T0, T1, T2, T3 = (datetime(2025, 3, day, 12, tzinfo=timezone.utc) for day in (1, 2, 3, 4))


def rows(df, *columns):
    """All rows as sorted tuples, instants in UTC."""

    def plain(value):
        if isinstance(value, datetime) and value.tzinfo is None:
            return value.astimezone(timezone.utc)
        return value

    picked = df.select(*columns) if columns else df
    return sorted((tuple(map(plain, row)) for row in picked.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
