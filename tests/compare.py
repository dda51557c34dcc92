"""Run registered queries beside their SQL counterpart and report differences."""

import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def by_name(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(row[i] for i in order) for row in rows)


def difference(spark, connection, query, sql, folder):
    """Empty when both sides agree, else a short description."""
    frame = query(spark, folder)
    got_names, got = by_name(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(sql)
    want_names, want = by_name([c[0] for c in result.description], result.fetchall())
    if got_names != want_names:
        return f"columns {got_names} against {want_names}"
    if got != want:
        return (f"{sum(got.values())} rows against {sum(want.values())}; "
                f"only here {list((got - want))[:2]}; only there {list((want - got))[:2]}")
    return "" if sum(got.values()) else "no rows"


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from tidegauge.session import local_session

    folder = sys.argv[1]
    spark, connection = local_session(8), connect(folder)
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        began = time.time()
        try:
            found = difference(spark, connection, query, entry.oracle_sql()[name], folder)
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:26s} {time.time() - began:6.2f}s {found or 'ok'}", flush=True)
