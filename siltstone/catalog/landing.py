"""Sources, ingestion columns and flattening."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.catalog.inputs import (
    ACCOUNT_LEAVES,
    LOADED_AT,
    ACCOUNT_SCHEMA,
    ACCOUNTS_SQL,
    flat_accounts,
    landed_accounts,
    accounts,
    table,
)
from siltstone.operators import enrich, filters
from siltstone.plans import MalformedRecords, RawSpec, Run, load_raw
from siltstone.sources import landing, layout, tables, variants
from siltstone.sources.scratch import scratch_path


def json_landing_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = landing.read_json(spark, landed_accounts(spark, sf_dir), ACCOUNT_SCHEMA)
    return enrich.flatten(landed, ACCOUNT_LEAVES)


ORDER_SCHEMA = "key bigint, customer struct<id: bigint>, status string"


def _indented_orders(spark: SparkSession, sf_dir: str) -> str:
    """Orders as a pretty-printed JSON array, an empty record before every finished one."""
    path = scratch_path(spark, "array")
    fields = [
        F.concat(F.lit('    "key": '), F.col("o_orderkey")),
        F.concat(F.lit('    "customer": {\n      "id": '), F.col("o_custkey"), F.lit("\n    }")),
        F.concat(F.lit('    "status": "'), F.col("o_orderstatus"), F.lit('"')),
    ]
    before = F.when(F.col("o_orderstatus") == "F", "  {},\n").otherwise("")
    record = F.concat(before, F.lit("  {\n"), F.concat_ws(",\n", *fields), F.lit("\n  },"))
    table(spark, sf_dir, "orders").select(record.alias("value")).write.text(path)
    return path


def indented_array_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a pretty-printed array, empty ones among them, split by record."""
    return landing.read_indented_array(spark, _indented_orders(spark, sf_dir), ORDER_SCHEMA).select(
        "key", F.col("customer.id").alias("customer_id"), "status"
    )


def indented_array_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same file through the raw load, which counts what it wrote."""
    path = scratch_path(spark, "raw")
    spec = RawSpec(ORDER_SCHEMA, "orders", layout="indented")
    result = load_raw(spark, _indented_orders(spark, sf_dir), path, spec, Run("1", LOADED_AT))
    raw = tables.read_parquet(spark, path)
    return raw.select(
        "key", F.col("customer.id").alias("customer_id"), "status", "year", F.lit(result.records).cast("long").alias("n_loaded")
    )


NOTED_SCHEMA = "key bigint, customer struct<id: bigint>, note string, tags array<string>"


def _noted_orders(spark: SparkSession, sf_dir: str) -> str:
    """Orders as four JSON arrays: on one line and indented by turns, lists last, brackets and escapes in strings."""
    path = scratch_path(spark, "arrays")
    note = F.concat(F.lit('a } b ] "c" { \\ [ '), "o_orderstatus")
    tags = F.array("o_orderstatus", F.lit("}, {"), F.lit('\\"'))
    record = F.struct(
        F.col("o_orderkey").alias("key"), F.struct(F.col("o_custkey").alias("id")).alias("customer"),
        note.alias("note"), tags.alias("tags"),
    )
    text = F.when(F.col("o_orderkey") % 3 == 0, F.to_json(record, {"pretty": "true"})).otherwise(F.to_json(record))
    ordered = Window.partitionBy("chunk").orderBy("o_orderkey")
    before = F.when(F.lag("o_orderkey").over(ordered).isNull(), "[").otherwise(",")
    after = F.when(F.lead("o_orderkey").over(ordered).isNull(), "]").otherwise("")
    orders = table(spark, sf_dir, "orders").withColumn("chunk", F.col("o_orderkey") % 4)
    # No line breaks but those of indented records: each file is one array on a few very long lines.
    orders.select(F.concat(before, text, after).alias("value"), "chunk").write.option("lineSep", " ").partitionBy("chunk").text(path)
    return path


def array_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of arrays of mixed layout, cut by their nesting."""
    return landing.read_array(spark, _noted_orders(spark, sf_dir), NOTED_SCHEMA).select(
        "key", F.col("customer.id").alias("customer_id"), "note", F.array_join("tags", "|").alias("tags")
    )


def malformed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines of which some are cut off: left out and counted up to the limit, refused one below it."""
    landed, path = scratch_path(spark, "broken"), scratch_path(spark, "raw")
    line = F.to_json(F.struct("event_id", "event_type"))
    cut = F.when(F.col("event_type") == "error", F.substring(line, 1, 12)).otherwise(line)
    events = table(spark, sf_dir, "events")
    events.select(cut.alias("value")).write.text(landed)
    broken = events.filter("event_type = 'error'").count()
    spec = RawSpec("event_id bigint, event_type string", "events", max_malformed=broken)
    try:
        load_raw(spark, landed, path, replace(spec, max_malformed=broken - 1), Run("0", LOADED_AT))
        refused = False
    except MalformedRecords:
        refused = True
    result = load_raw(spark, landed, path, spec, Run("1", LOADED_AT))
    raw = tables.read_parquet(spark, path)
    return raw.select("event_id", "event_type", F.lit(result.malformed).alias("n_left_out"), F.lit(refused).alias("refused"))


def _drifted_orders(spark: SparkSession, sf_dir: str) -> str:
    """Orders as JSON lines whose shape changed: later ones nest their customer, and some price is a text."""
    path = scratch_path(spark, "drifted")
    orders = table(spark, sf_dir, "orders")
    early = orders.select(
        F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("customer"), F.col("o_orderstatus").alias("status")
    )
    late = orders.select(
        F.col("o_orderkey").alias("key"),
        F.struct(F.col("o_custkey").alias("id"), F.array("o_orderpriority").alias("tags")).alias("buyer"),
        F.when(F.col("o_orderstatus") == "P", F.lit("open").cast("string")).alias("note"),
    )
    early.filter("key % 2 = 0").write.json(f"{path}/early")
    late.filter("key % 2 = 1").write.json(f"{path}/late")
    return f"{path}/*"


def variant_landing_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fields of drifted files, in a layout derived from the records."""
    records = variants.read_records(spark, _drifted_orders(spark, sf_dir))
    rows = variants.typed(records)
    return rows.select(
        "key", "customer", "status", F.col("buyer.id").alias("buyer_id"),
        F.element_at("buyer.tags", 1).alias("tag"), "note",
    )


def variant_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The paths in which drifted files differ from what is declared."""
    declared = StructType.fromDDL("key string, customer bigint, status string, region string")
    return variants.drift(variants.read_records(spark, _drifted_orders(spark, sf_dir)), declared)


def sorted_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in files sorted by date, with how many of its files reach into the next one's dates."""
    path = scratch_path(spark, "sorted")
    layout.write_sorted(table(spark, sf_dir, "lineitem"), path, ["l_shipdate", "l_orderkey"], files=6)
    rows = spark.read.parquet(path)
    files = rows.groupBy(F.input_file_name().alias("file")).agg(
        F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last")
    )
    # A row per file, and as many files as were asked for.
    follows = F.lead("first").over(Window.orderBy(F.regexp_extract("file", "part-([0-9]+)", 1)))
    mixed = files.withColumn("next", follows).agg(F.count_if(F.col("last") > F.col("next")).alias("n_mixed"), F.count("*").alias("n_files"))
    late = rows.filter(F.col("l_shipdate") >= F.lit("1998-06-01").cast("timestamp_ntz"))
    return late.select("l_orderkey", "l_linenumber", "l_shipdate").crossJoin(F.broadcast(mixed))


def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders")
    orders = enrich.with_date_parts(table(spark, sf_dir, "orders"), "o_orderdate")
    tables.write_partitioned(orders, path, ["year", "month"], cluster=True)
    return tables.read_parquet(spark, path)


def bronze_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = enrich.with_ingestion(table(spark, sf_dir, "events"), "events", LOADED_AT)
    return loaded.withColumn(
        "ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp_ntz")
    )


def source_file_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    return enrich.with_source_file(customers).select(
        "c_custkey", F.substring_index("file_name", "/", -1).alias("file_name")
    )


def partition_date_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.with_date_parts(table(spark, sf_dir, "events").select("event_id", "ts"), "ts")


def flatten_structs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_accounts(spark, sf_dir)


def flatten_by_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.flatten_all(accounts(spark, sf_dir))


def partitioned_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second static write leaves nothing of the first."""
    return _two_overwrites(spark, sf_dir, "static")


def partitioned_overwrite_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second write replaces the years it has rows for and no others."""
    return _two_overwrites(spark, sf_dir, "dynamic")


def _two_overwrites(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    path = scratch_path(spark, "overwrite")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    first = enrich.with_date_parts(orders, "o_orderdate")
    finished = first.filter((F.col("o_orderstatus") == "F") & (F.col("year") >= 2000))
    tables.write_partitioned(first, path, ["year", "month"], mode, cluster=True)
    tables.write_partitioned(finished, path, ["year", "month"], mode, cluster=True)
    return tables.read_parquet(spark, path)


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.rejected_rows(flat_accounts(spark, sf_dir), ["n_name"])


QUERIES = {
    "json_landing_scan": json_landing_scan,
    "indented_array_scan": indented_array_scan,
    "indented_array_load": indented_array_load,
    "array_scan": array_scan,
    "variant_landing_scan": variant_landing_scan,
    "variant_contract": variant_contract,
    "sorted_write": sorted_write,
    "malformed_load": malformed_load,
    "parquet_scan": parquet_scan,
    "bronze_enrich": bronze_enrich,
    "source_file_column": source_file_column,
    "partition_date_columns": partition_date_columns,
    "flatten_structs": flatten_structs,
    "flatten_by_schema": flatten_by_schema,
    "partitioned_overwrite": partitioned_overwrite,
    "partitioned_overwrite_dynamic": partitioned_overwrite_dynamic,
    "rejected_rows": rejected_rows,
}

_ARRAY = """
    SELECT o_orderkey AS key, o_custkey AS customer_id, o_orderstatus AS status FROM orders
    UNION ALL
    SELECT NULL, NULL, NULL FROM orders WHERE o_orderstatus = 'F'"""
_YEAR_MONTH = "year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month"

ORACLES = {
    "json_landing_scan": ACCOUNTS_SQL,
    "indented_array_scan": _ARRAY,
    "indented_array_load": f"""
        SELECT *, 2025::INTEGER AS year, count(*) OVER () AS n_loaded FROM ({_ARRAY})""",
    "array_scan": r"""
        SELECT o_orderkey AS key, o_custkey AS customer_id, 'a } b ] "c" { \ [ ' || o_orderstatus AS note,
               o_orderstatus || '|}, {|\"' AS tags FROM orders""",
    "variant_landing_scan": """
        SELECT o_orderkey AS key, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS customer,
               CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS status,
               CASE WHEN o_orderkey % 2 = 1 THEN o_custkey END AS buyer_id,
               CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS tag,
               CASE WHEN o_orderkey % 2 = 1 AND o_orderstatus = 'P' THEN 'open' END AS note FROM orders""",
    "variant_contract": """
        WITH odd AS (SELECT * FROM orders WHERE o_orderkey % 2 = 1)
        SELECT 'buyer.id' AS path, NULL::VARCHAR AS declared_type, 'bigint' AS found_type, count(*) AS n_records FROM odd
        UNION ALL SELECT 'buyer.tags', NULL, 'array<string>', count(*) FROM odd
        UNION ALL SELECT 'note', NULL, 'string', count(*) FROM odd WHERE o_orderstatus = 'P'
        UNION ALL SELECT 'key', 'string', 'bigint', count(*) FROM orders
        UNION ALL SELECT 'region', 'string', NULL, 0""",
    "sorted_write": """
        SELECT l_orderkey, l_linenumber, l_shipdate, 0::BIGINT AS n_mixed, 6::BIGINT AS n_files
        FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-06-01'""",
    "malformed_load": """
        SELECT event_id, event_type,
               (SELECT count(*) FROM events WHERE event_type = 'error')::INTEGER AS n_left_out,
               TRUE AS refused
        FROM events WHERE event_type <> 'error'""",
    "parquet_scan": f"SELECT *, {_YEAR_MONTH} FROM orders",
    "bronze_enrich": (
        f"SELECT *, TIMESTAMP '{LOADED_AT}' AS ingestion_timestamp, "
        "'events' AS source_system FROM events"
    ),
    "source_file_column": "SELECT c_custkey, 'customer.parquet' AS file_name FROM customer",
    "partition_date_columns": (
        "SELECT event_id, ts, year(ts)::INTEGER AS year, month(ts)::INTEGER AS month FROM events"
    ),
    "flatten_structs": ACCOUNTS_SQL,
    "flatten_by_schema": f"""
        SELECT c_custkey, c_name, c_acctbal AS account_c_acctbal, c_mktsegment AS account_c_mktsegment,
               n_nationkey AS nation_n_nationkey, n_name AS nation_n_name,
               r_regionkey AS nation_region_r_regionkey, r_name AS nation_region_r_name
        FROM ({ACCOUNTS_SQL})""",
    "partitioned_overwrite": f"""
        SELECT o_orderkey, o_orderstatus, o_orderdate, {_YEAR_MONTH} FROM orders
        WHERE o_orderstatus = 'F' AND year(o_orderdate) >= 2000""",
    "partitioned_overwrite_dynamic": f"""
        WITH dated AS (
            SELECT o_orderkey, o_orderstatus, o_orderdate, {_YEAR_MONTH} FROM orders),
        finished AS (SELECT * FROM dated WHERE o_orderstatus = 'F' AND year >= 2000)
        SELECT * FROM finished
        UNION ALL
        SELECT * FROM dated WHERE (year, month) NOT IN (SELECT (year, month) FROM finished)""",
    "rejected_rows": f"SELECT * FROM ({ACCOUNTS_SQL}) WHERE n_name IS NULL",
}
