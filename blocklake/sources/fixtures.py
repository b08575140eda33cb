"""Views of the engine's input over the driver tables (see FIXTURES.md §2).

The driver tables carry no call logs, so each view derives engine input from a table deterministically.
Every view is a plain narrow projection (or a grouping on a small bounded key) so that its work grows
linearly with the table it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blocklake import schemas as S
from blocklake.functions import binary
from blocklake.functions.fence import fence

# Fixed fixture parameters.
EVENTS_EPOCH = "2024-01-01 00:00:00"
EVENTS_HEIGHT_BASE = 100_000_000
EVENTS_HEIGHT_STEP = 97
EVENTS_HOUR_OFFSET = 473_352  # hours from 1970-01-01 to 2024-01-01
ORDERS_PER_BLOCK = 32
BLOCKS_HEIGHT_BASE = 100_000_000
BLOCKS_EPOCH_SECONDS = 1_700_000_000
DOC_ALIGNMENT = 4096
DOCS_HEIGHT_BASE = 200_000_000
DOCS_MIME = "text/plain"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def calls_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KV-path calls (FIXTURES §2.1): one call per event, CALLS_SCHEMA."""
    eid = F.col("event_id")
    method = (
        F.when(F.col("event_type") == "error",
               F.when(eid % 4 == 0, "__fastdata_*").when(eid % 4 == 1, "__fastdata_")
               .when(eid % 4 == 2, "transfer").otherwise("__fastdata_a b"))
        .when(F.col("event_type") == "signup", "__fastdata_raw")
        .otherwise("__fastdata_kv")
    )
    # Each is read several times below, the method by the routing's filters as well: computed once a row.
    ev = fence(
        table(spark, sf_dir, "events"), _method=method, _k=F.get_json_object("props", "$.k").cast("long"),
        _hr=F.expr(f"timestampdiff(HOUR, TIMESTAMP_NTZ'{EVENTS_EPOCH}', cast(ts as timestamp_ntz))").cast("long"))
    hr, k = F.col("_hr"), F.col("_k")
    kv_text = F.concat(
        F.lit('{"graph/follow/user'), (k % 20).cast("string"), F.lit('.near":'),
        F.when(k % 5 == 0, F.lit("null")).otherwise(k.cast("string")),
        F.lit(',"'), F.col("event_type"), F.lit('":"'), k.cast("string"), F.lit('"}'),
    )
    args = F.when(eid % 50 == 0, F.lit("[1]")).when(eid % 50 == 1, F.lit("{bad")).otherwise(kv_text)
    return ev.select(
        F.concat(F.lit("rcpt"), eid.cast("string")).alias("receipt_id"),
        (eid % 3).cast("int").alias("action_index"),
        F.when(eid % 10 != 0, F.concat(F.lit("tx"), eid.cast("string"))).alias("tx_hash"),
        F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit(".near")).alias("signer_id"),
        F.concat(F.lit("user"), (F.col("user_id") % 25).cast("string"), F.lit(".near")).alias("predecessor_id"),
        F.concat(F.lit("app"), (eid % 3).cast("string"), F.lit(".near")).alias("current_account_id"),
        (F.lit(EVENTS_HEIGHT_BASE) + hr * EVENTS_HEIGHT_STEP).cast("long").alias("block_height"),
        ((hr + EVENTS_HOUR_OFFSET) * 3_600_000_000_000).cast("long").alias("block_timestamp"),
        (F.col("user_id") % 6).cast("int").alias("shard_id"),
        (eid % 100_000).cast("int").alias("receipt_index"),
        F.col("_method").alias("method_name"),
        F.encode(args, "UTF-8").alias("args"),
    )


# Faulty payloads and receipt numbers of the reject fixture, by event_id % 40.
FAULT_EVERY = 40
TOO_MANY_KEYS = "{" + ",".join(f'"k{i}":{i}' for i in range(S.MAX_NUM_KEYS + 1)) + "}"
FAULTS = {3: TOO_MANY_KEYS, 5: '{"a\\u0001b":1,"ok":2}', 7: '{"' + "x" * (S.MAX_KEY_BYTES + 1) + '":1}', 11: '{"":1}',
          13: '{"a":1} tail', 17: '{"a":1e400}'}
OVERFLOW = 9


def faulty_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The KV-path calls with every kind of fault a KV blob or key is rejected for."""
    calls = calls_from_events(spark, sf_dir)
    part = F.substring("receipt_id", 5, 20).cast("long") % FAULT_EVERY
    text = F.col("args").cast("string")
    for k, v in FAULTS.items():
        text = F.when(part == k, F.lit(v)).otherwise(text)
    index = F.when(part == OVERFLOW, F.lit(S.MAX_RECEIPT_INDEX)).otherwise(F.col("receipt_index"))
    kv = F.lit(S.CALL_PREFIX + S.KV_SUFFIX)
    return calls.withColumns({"args": F.encode(text, "UTF-8"), "receipt_index": index.cast("int"),
                              "method_name": F.when(part.isin([*FAULTS, OVERFLOW]), kv).otherwise(F.col("method_name"))})


def faulty_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upload calls of which some records are cut short, climb out of their folder, or start off alignment."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    path = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"))
    body, kind = F.encode(F.coalesce("text", F.lit("")), "UTF-8"), F.col("doc_id") % 10
    good = binary.encode_simple(path, F.lit(DOCS_MIME), body)
    rec = F.when(kind == 1, F.substring(good, F.lit(1), F.octet_length(good) - 1)).when(
        kind == 2, binary.encode_simple(F.concat(F.lit("../"), path), F.lit(DOCS_MIME), body)).when(
        kind == 3, binary.encode_partial(path, F.lit(5), F.lit(100), F.lit(DOCS_MIME), F.lit("x").cast("binary"), F.lit(1))
    ).otherwise(good)
    height = (F.lit(DOCS_HEIGHT_BASE) + F.col("doc_id")).cast("long")
    return d.select(
        F.concat(F.lit("fx"), F.col("doc_id").cast("string")).alias("receipt_id"), F.lit(0).alias("action_index"),
        F.lit(None).cast("string").alias("tx_hash"), F.col("source").alias("signer_id"),
        F.col("source").alias("predecessor_id"), F.col("lang").alias("current_account_id"), height.alias("block_height"),
        (height * 1_000_000_000).alias("block_timestamp"), F.lit(0).alias("shard_id"), F.lit(0).alias("receipt_index"),
        F.lit(S.CALL_PREFIX + S.FILES_SUFFIX).alias("method_name"), rec.alias("args"))


# JSON values as written, by event_id % 20 (the expected text is stated in the oracle alone).
VALUE_TEXTS = ["1.0", "-0", "1e16", "1E-7", "0.10", "-1.50", "123456789012345678901234567890", "18446744073709551615",
               "1e400", "[1.0, {\"b\": 2.50, \"a\": null}]", '"x\\u00e9\\/"', "true", "100000000000000000000", "5e-324", "1e15",
               "0.00001", "0.000001", "12 x", "01", "-9223372036854775808"]


def value_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KV calls whose one value is each of VALUE_TEXTS in turn, as it stands in the source text."""
    calls = calls_from_events(spark, sf_dir)
    texts = F.array(*[F.lit(f'{{"v":{t}}}') for t in VALUE_TEXTS])
    nth = (F.substring("receipt_id", 5, 20).cast("long") % len(VALUE_TEXTS)).cast("int")
    return calls.withColumns({"args": F.encode(F.get(texts, nth), "UTF-8"),
                              "method_name": F.lit(S.CALL_PREFIX + S.KV_SUFFIX)})


def blocks_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested blocks (FIXTURES §2.2, blocks of at most 32 orders so every group stays bounded).

    block = o_orderkey div 32, shard = o_custkey % 4, receipt = order (position = rank of o_orderkey in
    the shard; orders with status 'P' are non-action receipts), action = line item (position = rank of
    (l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate); returnflag 'N' = not a call).
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate",
        "l_returnflag", "l_linestatus")
    call = F.when(F.col("l_returnflag") != "N", F.struct(
        F.when(F.col("l_linestatus") == "O", "__fastdata_kv").otherwise("__fastdata_raw").alias("method_name"),
        F.base64(F.encode(F.concat(F.lit('{"part/'), F.col("l_partkey").cast("string"), F.lit('":'),
                                   F.col("l_suppkey").cast("string"), F.lit("}")), "UTF-8")).alias("args"),
    ))
    actions = li.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct(
            "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", call.alias("fc"))
        )).alias("items"))
    actions = actions.select(
        "l_orderkey", F.transform("items", lambda x: F.struct(x["fc"].alias("FunctionCall"))).alias("actions"))
    orders = o.join(actions, o.o_orderkey == actions.l_orderkey, "left")
    pred = F.concat(F.lit("cust"), F.col("o_custkey").cast("string"), F.lit(".near"))
    receipt = F.struct(
        F.when(F.col("o_orderkey") % 10 != 0, F.concat(F.lit("tx"), F.col("o_orderkey").cast("string")))
        .alias("tx_hash"),
        F.struct(
            F.concat(F.lit("r"), F.col("o_orderkey").cast("string")).alias("receipt_id"),
            pred.alias("predecessor_id"),
            F.concat(F.lit("shop"), (F.col("o_orderkey") % 5).cast("string"), F.lit(".near")).alias("receiver_id"),
            F.struct(F.when(F.col("o_orderstatus") != "P", F.struct(
                pred.alias("signer_id"),
                F.coalesce(F.col("actions"), F.array().cast(f"array<{S.ACTION.simpleString()}>")).alias("actions"),
            )).alias("Action")).alias("receipt"),
        ).alias("receipt"),
    )
    shard_rows = (
        orders.withColumn("blk", F.expr(f"o_orderkey div {ORDERS_PER_BLOCK}"))
        .withColumn("shard_id", (F.col("o_custkey") % 4).cast("int"))
        .groupBy("blk", "shard_id")
        .agg(F.array_sort(F.collect_list(F.struct("o_orderkey", receipt.alias("r")))).alias("rs"))
        .select("blk", F.struct("shard_id", F.transform("rs", lambda x: x["r"]).alias(
            "receipt_execution_outcomes")).alias("shard"))
    )
    blocks = shard_rows.groupBy("blk").agg(F.array_sort(F.collect_list("shard")).alias("shards"))
    height = (F.lit(BLOCKS_HEIGHT_BASE) + F.col("blk")).cast("long")
    return blocks.select(
        F.struct(F.struct(height.alias("height"),
                          ((F.lit(BLOCKS_EPOCH_SECONDS) + F.col("blk")) * 1_000_000_000).cast("long")
                          .alias("timestamp")).alias("header")).alias("block"),
        "shards",
    )


def calls_from_documents(spark: SparkSession, sf_dir: str, alignment: int = DOC_ALIGNMENT) -> DataFrame:
    """File-upload calls (FIXTURES §2.3), CALLS_SCHEMA with binary records in `args`.

    A document of one chunk is a Simple upload (nonce 0); a longer one is a Partial upload per
    `alignment`-byte chunk with nonce doc_id + 1. Single-chunk documents with doc_id % 20 = 0 get a
    Simple deletion one block later.
    """
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    d = d.select(
        "doc_id",
        F.concat("source", F.lit("/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
        .alias("path"),
        F.encode("text", "UTF-8").alias("bytes"),
        F.col("source").alias("pred"),
        F.concat(F.col("lang"), F.lit(".fs.near")).alias("contract"),
    ).withColumn("n", F.octet_length("bytes").cast("long"))
    d = d.withColumn("nchunks", F.greatest(F.lit(1).cast("long"), F.expr(f"(n + {alignment - 1}) div {alignment}")))
    mime = F.lit(DOCS_MIME)
    # Simple uploads and their later deletions.
    single = d.where(F.col("nchunks") == 1)
    uploads = single.select("doc_id", "path", "pred", "contract", F.lit(0).alias("c"), F.lit(0).alias("late"),
                            binary.encode_simple(F.col("path"), mime, F.col("bytes")).alias("rec"))
    deletions = single.where(F.col("doc_id") % 20 == 0).select(
        "doc_id", "path", "pred", "contract", F.lit(0).alias("c"), F.lit(1).alias("late"),
        binary.encode_simple(F.col("path"), None, None).alias("rec"))
    # Partial chunks (a bounded explode: at most full_size / alignment per document).
    multi = d.where(F.col("nchunks") > 1).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nchunks") - 1)).alias("ci"))
    off = F.col("ci") * alignment
    chunk = F.col("bytes").substr((off + 1).cast("int"), F.lit(alignment))
    partial = multi.select(
        "doc_id", "path", "pred", "contract", F.col("ci").cast("int").alias("c"), F.lit(0).alias("late"),
        binary.encode_partial(F.col("path"), off, F.col("n"), mime, chunk, F.col("doc_id") + 1).alias("rec"))
    recs = uploads.unionByName(deletions).unionByName(partial)
    height = (F.lit(DOCS_HEIGHT_BASE) + F.col("doc_id") * 2 + F.col("late")).cast("long")
    return recs.select(
        F.concat(F.lit("fs"), F.col("doc_id").cast("string"), F.lit("-"), F.col("c").cast("string"),
                 F.lit("-"), F.col("late").cast("string")).alias("receipt_id"),
        F.col("c").cast("int").alias("action_index"),
        F.when(F.col("doc_id") % 7 != 0, F.concat(F.lit("ftx"), F.col("doc_id").cast("string"))).alias("tx_hash"),
        F.col("pred").alias("signer_id"),
        F.col("pred").alias("predecessor_id"),
        F.col("contract").alias("current_account_id"),
        height.alias("block_height"),
        (height * 1_000_000_000).alias("block_timestamp"),
        (F.col("doc_id") % 4).cast("int").alias("shard_id"),
        (F.col("doc_id") % 1000).cast("int").alias("receipt_index"),
        F.lit(S.CALL_PREFIX + S.FILES_SUFFIX).alias("method_name"),
        F.col("rec").alias("args"),
    )


def page_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relative paths taken from page URLs (everything after the host), natural path-check cases."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    return p.select("page_id", F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*/(.*)$", 1)
                    .alias("relative_path"))
