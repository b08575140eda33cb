"""blocklake: tagged-call logs on Spark.

Main entry points:

* `sources.blocks.read_blocks` / `flatten_blocks`  - block feed -> one row per function call
* `operators.routing.to_blobs`                     - calls -> blobs routed by suffix
* `operators.kv`, `operators.files`                - the key/value and file-upload standards
* `plans.store.Store`, `plans.jobs`                - Parquet deltas, batch jobs, compaction, expiry
* `streaming.writers`, `streaming.registry`        - Structured Streaming stages, custom standards
* `plans.lookups`                                  - the documented lookups
* `session.configure`                              - settings the semantics depend on
"""
