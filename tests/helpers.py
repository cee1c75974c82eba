"""What several test modules share."""

import datetime as dt

START = dt.date(2020, 1, 1)


def collected(df, *order):
    return df.toPandas().sort_values(list(order) or ["symbol", "date"]).reset_index(drop=True)
