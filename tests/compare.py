"""Rows of Spark and DuckDB in one text form, without order."""

import math


def text(value) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6))
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(text, value)) + "]"
    return str(value)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted(tuple(text(row[n]) for n in names) for row in df.collect())


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(columns), sorted(tuple(text(row[k]) for k in order) for row in found.fetchall())
