"""Headline timings; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

The topics are staged once, untimed. Each query is run WARMUP times, then the
median of RUNS timed runs counts. Results go to Spark's noop sink unless writing
is what the query is about.
"""

from __future__ import annotations

import contextlib
import json
import os
import statistics
import sys
import time

from pyspark.sql import functions as F

from tillflow import workload
from tillflow.operators import totals
from tillflow.operators.keyed import last_write
from tillflow.plans import pipelines
from tillflow.plans.history import compact, vacuum
from tillflow.plans.rows import audited_transactions, transactions
from tillflow.schema import HOT, TOPIC
from tillflow.session import build_session, shared_dir
from tillflow.sources import stored
from tillflow.sources.topics import text_files, topic_files
from tillflow.streaming.run import AVAILABLE_NOW, drain

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARMUP, RUNS = 2, 3
SALES = "year_country_wise_total_sales"


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def staged(spark, build):
    """The topic in as many files as there are cores, written once."""
    path = shared_dir(spark, f"bench-{build.__name__}")
    build(spark, SF_DIR).repartition(int(CPUS)).write.parquet(path)
    return path


def staged_text(spark, build):
    """The payloads alone, a line each: the yardstick's input."""
    path = shared_dir(spark, f"bench-text-{build.__name__}")
    build(spark, SF_DIR).select(F.col("value").cast("string")).repartition(int(CPUS)).write.text(path)
    return path


def plans(spark):
    crowd = topic_files(spark, staged(spark, workload.crowd_topic), streaming=False)
    crowd_text = text_files(spark, staged_text(spark, workload.crowd_topic), workload.TOPIC_NAME, streaming=False)
    order_path = staged(spark, workload.order_topic)
    orders = topic_files(spark, order_path, streaming=False)

    def yardstick_rows(crowd=crowd):
        dated = ("nationality", "tran_date", "tran_year", "tran_amount")
        noop(transactions(crowd, dated, "passthrough").select(*dated))

    def yardstick_sales(crowd=crowd):
        rows = transactions(crowd, totals.needed([SALES]), "passthrough")
        noop(totals.total(rows, SALES))

    def stream(pipeline):
        layout = pipelines.Layout(shared_dir(spark, "bench-run"))
        raw = topic_files(spark, order_path)
        drain(pipeline(raw, layout, trigger=AVAILABLE_NOW))

    def stream_totals():
        root = shared_dir(spark, "bench-totals")
        drain([pipelines.start_collection(topic_files(spark, order_path), pipelines.Layout(root), SALES,
                                          trigger=AVAILABLE_NOW)])

    done = pipelines.Layout(shared_dir(spark, "bench-done"))
    drain(pipelines.main_pipeline(topic_files(spark, order_path), done, trigger=AVAILABLE_NOW))

    folded = pipelines.Layout(shared_dir(spark, "bench-folded"))
    drain(pipelines.main_pipeline(topic_files(spark, order_path), folded, trigger=AVAILABLE_NOW))
    compact(spark, folded)
    vacuum(spark, folded)
    some_key = stored.read_hot_table(spark, folded.hot).first()["user_id"]

    return {
        # The yardstick's two, on the yardstick's input shape.
        "parse_explode_dates": yardstick_rows,
        "parse_explode_year_country_sum": yardstick_sales,
        # The same from text files, as the yardstick reads them.
        "text_parse_explode_dates": lambda: yardstick_rows(crowd_text),
        "text_parse_explode_year_country_sum": lambda: yardstick_sales(crowd_text),
        # One message per order from here on.
        "full_rows": lambda: noop(transactions(orders)),
        "audited_rows": lambda: noop(audited_transactions(orders)),
        "year_country_sales": lambda: noop(totals.total(transactions(orders, totals.needed([SALES])), SALES)),
        "all_totals": lambda: noop(totals.all_totals(transactions(orders, totals.needed()))),
        "hot_last_write": lambda: noop(last_write(transactions(orders, HOT), "user_id")),
        "tables_to_messages": lambda: noop(workload.order_topic(spark, SF_DIR)),
        "history_by_country": lambda: noop(
            stored.read_archive(spark, done.archive).where("tran_year = 1997").groupBy("nationality").agg(
                F.count(F.lit(1)).alias("n"))),
        "hot_table_read": lambda: noop(stored.read_hot_table(spark, done.hot)),
        "hot_key_read": lambda: noop(stored.read_hot_key(spark, folded.hot, some_key)),
        "stream_year_country_sales": stream_totals,
        "stream_main_pipeline": lambda: stream(pipelines.main_pipeline),
        "stream_separate_queries": lambda: stream(pipelines.separate_pipeline),
    }


def main():
    spark = build_session("bench", **{
        "spark.master": f"local[{CPUS}]",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.sql.shuffle.partitions": CPUS,
    })
    spark.sparkContext.setLogLevel("ERROR")
    only = set(sys.argv[1:])
    seconds = {}
    with contextlib.redirect_stdout(sys.stderr):
        for name, run in plans(spark).items():
            if only and name not in only:
                continue
            streaming = name.startswith("stream_")
            for _ in range(1 if streaming else WARMUP):
                run()
            times = []
            for _ in range(RUNS):
                start = time.perf_counter()
                run()
                times.append(time.perf_counter() - start)
            seconds[name] = round(statistics.median(times), 3)
    spark.stop()
    print(json.dumps({
        "metric": "sum of median wall-clock times", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
