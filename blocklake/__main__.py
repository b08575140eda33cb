"""Command line: the raw stage and the derived stages as batch jobs or streams, plus maintenance.

    python -m blocklake ingest  --blocks DIR --store ROOT [--format json] [--start H|latest] [--stream]
    python -m blocklake index   --store ROOT --suffix kv|fastfs|raw [--stream]
    python -m blocklake merge   --store ROOT --table NAME
    python -m blocklake purge   --store ROOT [--now-us T]
    python -m blocklake lag     --store ROOT

Streams need --checkpoint (a folder on shared storage); without --stream a single batch is run.
"""

from __future__ import annotations

import argparse
import time


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="blocklake")
    ap.add_argument("command", choices=["ingest", "index", "merge", "purge", "lag"])
    ap.add_argument("--store", required=True)
    ap.add_argument("--blocks")
    ap.add_argument("--format", default="json")
    ap.add_argument("--start", help="first block height of a new store, or latest (the default of a batch)")
    ap.add_argument("--suffix", default="kv")
    ap.add_argument("--table")
    ap.add_argument("--now-us", type=int)
    ap.add_argument("--stream", action="store_true")
    ap.add_argument("--checkpoint")
    ap.add_argument("--batch-id", type=int)
    ap.add_argument("--max-files-per-trigger", type=int)
    a = ap.parse_args(argv)

    from blocklake import schemas as S
    from blocklake.operators.reports import checkpoint_lag, stalls
    from blocklake.plans import jobs
    from blocklake.plans.store import Store
    from blocklake.session import get_spark
    from blocklake.streaming import writers

    spark = get_spark()
    store = Store(spark, a.store)
    height = int(a.start) if a.start not in (None, jobs.LATEST) else None
    batch_id = a.batch_id if a.batch_id is not None else time.time_ns()
    if a.command == "ingest":
        if a.stream:
            q = writers.start_ingest_stream(spark, a.blocks, store, a.checkpoint, a.format,
                                            max_files_per_trigger=a.max_files_per_trigger,
                                            start_height=height)
            q.awaitTermination()
        else:
            # STR-1: what has not been read yet, from where the store began.
            print(jobs.ingest_files(store, a.blocks, batch_id, a.format, a.start))
    elif a.command == "index":
        if a.stream:
            q = writers.start_standard_stream(spark, store.path("blobs"), store, a.suffix, a.checkpoint, raw=store,
                                              max_files_per_trigger=a.max_files_per_trigger,
                                              start_height=height)
            q.awaitTermination()
        else:
            print(jobs.index_pending(store, batch_id, a.suffix))
    elif a.command == "merge":
        print(store.merge(a.table))
    elif a.command == "purge":
        print(store.purge_expired(a.now_us if a.now_us is not None else int(time.time() * 1e6),
                                  S.BLOBS_TTL_SECONDS))
    elif a.command == "lag":
        # Each call records a reading; a standard whose checkpoint did not move since the last one is stalled.
        checkpoint_lag(store.meta()).show(truncate=False)
        store.record_reading(int(time.time() * 1e6))
        stalls(store.readings()).show(truncate=False)


if __name__ == "__main__":
    main()
