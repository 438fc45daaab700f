"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores. Each query first runs on
the smallest tables, which starts the Python workers and compiles the plans, then is timed once on
the given ones with its whole result produced. ``resolve_bodies`` is left out: nearly all its time
goes into making landed files out of the documents.

The given tables are single files of one row group, which no reader can share out among cores. They are laid out once,
before anything is timed, in two files a core, as a landing would leave them. BENCH_AS_GIVEN=1 times them as they are.
"""

import json
import os
import pathlib
import sys
import tempfile
import time

ROOT = pathlib.Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from pyspark.sql import SparkSession  # noqa: E402

from quirefold.session import ship_package  # noqa: E402
from quirefold.suite import QUERIES  # noqa: E402

HEADLINE = (
    "doc_overview", "list_docs", "stats_report", "first_wins_dedup", "known_hash_skip", "cascade_delete", "violations",
    "clean_text", "html_to_text", "chunk_window", "chunk_recursive", "page_assembly",
    "topk_cosine", "topk_batch", "topk_cells", "embed_hashing", "search_texts", "ingest_documents",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    warm = pathlib.Path(sf).parent / "sf0.001"
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.driver.memory", "12g")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)

    def run(name: str, folder: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    given, tables = sf, sorted(p.name for p in pathlib.Path(sf).glob("*.parquet"))
    as_given = os.environ.get("BENCH_AS_GIVEN") == "1"
    if not as_given:
        sf = tempfile.mkdtemp(prefix="bench-")
        for name in tables:
            spark.read.parquet(f"{given}/{name}").repartition(2 * int(cpus)).write.parquet(f"{sf}/{name}")
    times = {}
    for name in HEADLINE:
        if warm.is_dir():
            run(name, str(warm))
        times[name] = round(run(name, sf), 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": pathlib.Path(given).name.removeprefix("sf"),
                      "tables": "as given" if as_given else f"{2 * int(cpus)} files each"}))
    spark.stop()


if __name__ == "__main__":
    main()
