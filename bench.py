"""Time the registered queries and the main streaming forms; print one JSON line.

Every query runs twice in one session and the second run counts. The whole result
is computed (``noop`` sink). ``rows_per_second`` relates it to the rows read.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidegauge import catalogue, model  # noqa: E402
from tidegauge.catalogue import SECOND, Tables  # noqa: E402
from tidegauge.operators import lateness, windows  # noqa: E402
from tidegauge.session import local_session  # noqa: E402
from tidegauge.sources.basic import table_stream  # noqa: E402
from tidegauge.streaming import jobs  # noqa: E402

DOCUMENTS = {"filter_contains", "tokenize", "word_count", "rolling_word_count"}


def streams(tables: Tables):
    events = tables.table("events")

    def live():
        return model.readings(table_stream(
            tables.spark, tables.folder, events.schema, pattern="events.parquet"))

    def average():
        return windows.avg_temperature(lateness.watermark(live(), f"{5 * SECOND} milliseconds"),
                                       f"{5 * SECOND // 1000} seconds")

    return {
        "stream_avg_temp_window": average,
        "stream_fire_alerts": lambda: jobs.fire_alerts(
            live(), model.smoke_control(table_stream(
                tables.spark, tables.folder, events.schema, pattern="events.parquet"))),
        "stream_temp_change_alerts": lambda: jobs.temperature_changes(live()),
        "stream_rising_alerts": lambda: jobs.rising_alerts(live(), catalogue.HOLD, 5 * SECOND),
        "stream_late_update_counts": lambda: jobs.late_updates(
            live(), 10 * SECOND, 5 * SECOND, 5 * SECOND),
    }


def drain(stream) -> None:
    writer = stream if hasattr(stream, "start") else stream.writeStream.format("noop")
    query = (writer.outputMode("append")
             .option("checkpointLocation", tempfile.mkdtemp(prefix="run-"))
             .trigger(availableNow=True).start())
    query.awaitTermination()


def timed(action) -> float:
    began = time.perf_counter()
    action()
    return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    only = sys.argv[1:]
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    tables = Tables(spark, folder)
    counts = {name: tables.table(name).count()
              for name in ("events", "documents", "conversations")}
    seconds, rate = {}, {}
    for name in catalogue.QUERIES:
        if only and name not in only:
            continue

        def run():
            catalogue.run(name, spark, folder).write.format("noop").mode("overwrite").save()

        run()
        seconds[name] = round(timed(run), 3)
        source = ("documents" if name in DOCUMENTS else
                  "conversations" if name == "rolling_concat" else "events")
        rate[name] = round(counts[source] / seconds[name])
        print(name, seconds[name], file=sys.stderr, flush=True)
    for name, build in streams(tables).items():
        if only and name not in only:
            continue
        drain(build())
        seconds[name] = round(timed(lambda: drain(build())), 3)
        rate[name] = round(counts["events"] / seconds[name])
    print(json.dumps({
        "metric": "total warm seconds over all queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "rows_per_second": rate,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
