"""Benchmark: headline history loads at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

The stand-in sources are derived from the driver tables and stored once as
parquet (timed as ``sources``), as real source tables would be; each load then
runs from those tables and is forced with a ``noop`` write (full execution,
nothing collected).  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from histloom import catalog  # noqa: E402
from histloom.sources.fixtures import load_sources, use_sources  # noqa: E402
from histloom.sources.io import release_cuts, scratch_path, session  # noqa: E402

HEADLINE = [
    "load_account", "load_party_xref_all", "load_address_all", "load_agreement_all",
    "load_customer_agreement", "load_party_address_all", "load_customer_party_address",
    "load_party_phone_all", "load_party_email", "load_party_agreement_all", "load_party",
    "change_classify", "current_row_flag", "latest_per_key",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app="histloom-bench")
    spark.sparkContext.setLogLevel("ERROR")

    t0 = time.time()
    src = load_sources(spark, sf_dir).materialize(spark, scratch_path(spark, f"bench-{uuid.uuid4().hex}"))
    use_sources(spark, sf_dir, src)
    times = {"sources": round(time.time() - t0, 3)}

    for name in HEADLINE:
        t0 = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        release_cuts(spark)

    loads = {k: v for k, v in times.items() if k != "sources"}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "history_loads_total", "value": round(sum(loads.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
