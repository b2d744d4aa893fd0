"""How the heavy operators grow: generated orders as a log, with and without one large key.

    python tools/scale.py 100000 1000000 10000000
"""

from __future__ import annotations

import os
import sys
import tempfile
import time
from datetime import date

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.operators.joins import as_of_join  # noqa: E402
from tidemark.operators.scd import scd1, scd1_merge, scd2, scd2_merge  # noqa: E402
from tidemark.runtime import build_session  # noqa: E402
from tidemark.sources.generate import generate_orders  # noqa: E402


def main() -> None:
    spark = build_session(
        "scale",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "32",
            "spark.driver.memory": "20g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(label: str, n: int, df) -> None:
        started = time.perf_counter()
        df().write.format("noop").mode("overwrite").save()
        print(f"{n:>10d}  {label:28s} {time.perf_counter() - started:7.2f}s", flush=True)

    for n in (int(a) for a in sys.argv[1:]):
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        pool = max(500, n // 40)
        started = time.perf_counter()
        generate_orders(spark, n, today=date(2026, 5, 8), pool=pool).write.parquet(f"{folder}/orders")
        print(f"{n:>10d}  {'generate and write':28s} {time.perf_counter() - started:7.2f}s", flush=True)
        orders = spark.read.parquet(f"{folder}/orders")
        log = orders.select("consultora_id", F.col("status").alias("tier"), "pedido_id", F.col("updated_at").alias("at"))
        one = F.when(F.col("consultora_id") % 3 == 0, F.lit(0)).otherwise(F.col("consultora_id"))
        skewed = log.withColumn("consultora_id", one)
        key, track = ["consultora_id"], ["tier"]
        bar = max(1000, n // 64)

        timed("scd2", n, lambda: scd2(log, key, "at", track))
        timed("scd2, one key with a third", n, lambda: scd2(skewed, key, "at", track, rows_per_task=n))
        timed("the same, in segments", n, lambda: scd2(skewed, key, "at", track, rows_per_task=bar))
        scd2(log, key, "at", track).write.parquet(f"{folder}/dim")
        dim = spark.read.parquet(f"{folder}/dim").select("consultora_id", "__START_AT", "__END_AT", "tier")
        fact = orders.select("pedido_id", "consultora_id", "data_pedido")
        timed("as-of join", n, lambda: as_of_join(fact, dim, "consultora_id", "data_pedido"))
        timed("scd1", n, lambda: scd1(log, key, "at"))
        late = F.col("at") >= F.lit(date(2026, 4, 1)).cast("timestamp_ntz")
        state = scd1(log.filter(~late), key, "at")
        timed("scd1 merge of a month", n, lambda: scd1_merge(state, log.filter(late), key, "at"))
        scd2(log.filter(~late), key, "at", track).write.parquet(f"{folder}/before")
        before = spark.read.parquet(f"{folder}/before")
        timed("scd2 merge of a month", n, lambda: scd2_merge(before, log, log.filter(late), key, "at", track))


if __name__ == "__main__":
    main()
