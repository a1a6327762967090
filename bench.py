"""Benchmark: build every model of the graph at ``$BENCH_SF_DIR`` and time it.

1. prepare: derive the billing tables from the test tables and store them as
   Parquet (the form real billing inputs arrive in); timed separately.
2. build: the model graph over those tables, as a user runs it: the ten shared
   models (``plans.SHARED_MODELS``) and the customer-month table are written once
   to the checkpoint folder and read back, every other model is executed to a
   ``noop`` sink (full computation, no collect). The folders are deleted at the end.

Prints one JSON line: {"metric", "value" (end-to-end build seconds, first build in
a fresh JVM), "unit", "queries": {model: seconds}, "warm_value"/"warm_queries" (the
same graph built again in the same JVM), "prepare_sec", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import uuid
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from tallyspark.plans import SHARED_MODELS, ModelSet  # noqa: E402
from tallyspark.plans.sinks import delete_folder  # noqa: E402
from tallyspark.session import AS_OF_TEST, checkpoint_dir, get_session  # noqa: E402
from tallyspark.sources import derive_billing_tables, read_billing_tables  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * int(cpus))))
    spark = get_session(f"local[{cpus}]", parts, app_name="tallyspark-bench")
    work = f"{checkpoint_dir(spark).rstrip('/')}/bench-{uuid.uuid4().hex}"

    t0 = time.time()
    derived = derive_billing_tables(spark, sf_dir)
    for name, df in derived.as_dict().items():
        # stored as several files, like any real table (one file = one scan task)
        df.repartition(2 * int(cpus)).write.mode("overwrite").parquet(f"{work}/billing/{name}")
    prepare = time.time() - t0

    def build(folder: str) -> tuple[float, dict[str, float]]:
        tables = read_billing_tables(spark, f"{work}/billing")
        ms = ModelSet(tables, AS_OF_TEST, materialize=SHARED_MODELS, folder=folder)
        times: dict[str, float] = {}
        t_all = time.time()
        for name in ms.names:
            t = time.time()
            df = ms.model(name)  # shared models are written here
            if name not in SHARED_MODELS:
                df.write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t, 3)
        return time.time() - t_all, times

    # first build in a fresh JVM (includes JIT/codegen warm-up): the reported value
    total, times = build(f"{work}/models-1")
    # second build of the same graph in the same JVM: steady-state cost
    warm_total, warm_times = build(f"{work}/models-2")

    delete_folder(spark, work)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "model_graph_build_sec",
        "value": round(total, 3),
        "unit": "sec",
        "queries": times,
        "warm_value": round(warm_total, 3),
        "warm_queries": warm_times,
        "prepare_sec": round(prepare, 3),
        "sf": float(m.group(1)) if m else sf_dir,
    }))


if __name__ == "__main__":
    main()
