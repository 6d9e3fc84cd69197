"""CSV ingestion: tables written out as a CSV tree, then read as bronze."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.catalog import query, table
from touchline.session import scratch_dir, spread_by
from touchline.sources import csv_tree
from touchline.sources.tables import read_table, write_table


#: Keys of one CSV file.
FILE_KEYS = 500


def _tree(spark, sf_dir) -> str:
    """root/geo/nation, root/people/customer and root/people/supplier, a file for every
    `FILE_KEYS` keys, each table with its own header; some names need normalising, one is
    very long, cells hold blanks, tabs and line breaks. root/none/empty has a header only."""
    root = scratch_dir(spark, "tree")
    nation, customer, supplier = (table(spark, sf_dir, t) for t in ("nation", "customer", "supplier"))
    padded = F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))
    parts = {
        "geo/nation": nation.select(
            "n_nationkey",
            F.when(F.col("n_nationkey") % 4 == 1, F.concat("n_name", F.lit("\n,x"))).otherwise(F.col("n_name")).alias(" Full \n Name % "),
            "n_regionkey",
        ),
        "people/customer": customer.select(
            "c_custkey", padded.alias("Full Name"), "c_acctbal", F.col("c_nationkey").alias("n_nationkey"),
            F.when(F.col("c_mktsegment") == "MACHINERY", "N/A").otherwise(F.col("c_mktsegment")).alias("segment"),
        ),
        "people/supplier": supplier.select(
            F.col("s_acctbal").alias("saves"), F.concat(F.lit("\t"), "s_name", F.lit(" \t")).alias("full-name"), "s_suppkey",
            F.col("s_nationkey").alias("n_nationkey" + "%" * 70_000),
        ),
        "none/empty": nation.where("false").select("n_nationkey"),
    }
    kept = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "escape": '"'}
    keys = {"geo/nation": "n_nationkey", "people/customer": "c_custkey", "people/supplier": "s_suppkey"}
    for folder, df in parts.items():
        if folder in keys:
            part = F.floor(F.col(keys[folder]) / FILE_KEYS).alias("part")
            writer = spread_by(df.select("*", part), "part").write.partitionBy("part")
        else:
            writer = df.coalesce(1).write  # no rows
        writer.options(**kept).csv(f"{root}/{folder}")
    return root


def _files(table_name: str, key: str) -> str:
    return f"(SELECT COUNT(DISTINCT FLOOR({key} / {FILE_KEYS}.0)) FROM {table_name})"


COLUMNS = ("C_ACCTBAL", "C_CUSTKEY", "FULL_NAME", "N_NATIONKEY", "N_REGIONKEY", "S_SUPPKEY", "SAVES", "SEGMENT")
INGESTED_SQL = """SELECT 'geo' AS league, 'nation' AS team, NULL AS c_acctbal, NULL AS c_custkey,
        CASE WHEN n_nationkey % 4 = 1 THEN n_name || CHR(10) || ',x' ELSE n_name END AS full_name,
        CAST(n_nationkey AS VARCHAR) AS n_nationkey, CAST(n_regionkey AS VARCHAR) AS n_regionkey, NULL AS s_suppkey,
        NULL AS saves, NULL AS segment FROM nation
    UNION ALL SELECT 'people', 'customer', CAST(c_acctbal AS VARCHAR), CAST(c_custkey AS VARCHAR), c_name,
        CAST(c_nationkey AS VARCHAR), NULL, NULL, NULL, NULLIF(c_mktsegment, 'MACHINERY') FROM customer
    UNION ALL SELECT 'people', 'supplier', NULL, NULL, s_name, CAST(s_nationkey AS VARCHAR), NULL, CAST(s_suppkey AS VARCHAR),
        CAST(s_acctbal AS VARCHAR), NULL FROM supplier"""


@query("csv_ingest", INGESTED_SQL)
def _csv_ingest(spark, sf_dir):
    bronze = csv_tree.ingest_csv_tree(spark, _tree(spark, sf_dir), "batch-1")
    return bronze.select(
        F.col("_LEAGUE").alias("league"), F.col("_TEAM").alias("team"), *[F.col(c).alias(c.lower()) for c in COLUMNS]
    )


@query(
    "file_classify",
    f"""SELECT 'geo' AS league, 'nation' AS team, 'outfield' AS player_type, COUNT(*) AS loaded FROM nation
    UNION ALL SELECT 'people', 'supplier', 'goalkeeper', COUNT(*) FROM supplier
    UNION ALL SELECT 'people', 'customer', CASE WHEN BOOL_OR(c_mktsegment = 'BUILDING') THEN 'goalkeeper' ELSE 'outfield' END,
        COUNT(*) FROM customer""",
)
def _file_classify(spark, sf_dir):
    """Suppliers by a header, customers by a value ('BUILDING' as the position
    word), nations by neither. Counted per table: the number of files varies."""
    root = _tree(spark, sf_dir)
    records = csv_tree.stage_records(spark, root)
    headers = csv_tree.read_headers(spark, root, csv_tree.scan_csv_tree(spark, root), records=records)
    rows = csv_tree.read_csv_groups(records, headers)
    types = csv_tree.classify_files(rows, headers, "SEGMENT", ("gk", "building"))
    typed = csv_tree.add_lineage(rows, types, "batch-1")
    keeper = F.max(F.col("_PLAYER_TYPE") == "goalkeeper")
    return typed.groupBy(F.col("_LEAGUE").alias("league"), F.col("_TEAM").alias("team")).agg(
        F.when(keeper, "goalkeeper").otherwise("outfield").alias("player_type"),
        F.count(F.lit(1)).alias("loaded"),
    )


@query(
    "load_stats",
    f"""SELECT 'batch-1' AS batch, (SELECT COUNT(*) FROM customer) + (SELECT COUNT(*) FROM supplier)
        + (SELECT COUNT(*) FROM nation) AS loaded, 0::BIGINT AS with_region,
        {_files('customer', 'c_custkey')} + {_files('supplier', 's_suppkey')} + {_files('nation', 'n_nationkey')} AS processed, 1::BIGINT AS skipped
    UNION ALL SELECT 'batch-2', (SELECT COUNT(*) FROM region), (SELECT COUNT(*) FROM region), {_files('region', 'r_regionkey')}, 0""",
)
def _load_stats(spark, sf_dir):
    """Two batches into one bronze table, the second with columns the first lacks, each
    counted as it is loaded; the table is then refreshed in whole."""
    home = scratch_dir(spark, "bronze")
    trees = {"batch-1": _tree(spark, sf_dir), "batch-2": scratch_dir(spark, "tree")}
    region = table(spark, sf_dir, "region").withColumn("part", F.floor(F.col("r_regionkey") / FILE_KEYS))
    spread_by(region, "part").write.partitionBy("part").option("header", "true").csv(f"{trees['batch-2']}/geo/region")
    first = csv_tree.load_csv_tree(spark, trees["batch-1"], f"{home}/table", "batch-1")
    columns = read_table(spark, f"{home}/table").columns
    second = csv_tree.load_csv_tree(spark, trees["batch-2"], f"{home}/table", "batch-2", columns=columns)
    write_table(read_table(spark, f"{home}/table", evolved=True), f"{home}/refreshed")
    bronze = read_table(spark, f"{home}/refreshed")
    stats = spark.createDataFrame([first, second], "batch string, processed long, skipped long, loaded long")
    filled = bronze.groupBy(F.col("_BATCH_ID").alias("batch")).agg(F.count("R_NAME").alias("with_region"))
    return stats.join(filled, "batch").select("batch", "loaded", "with_region", "processed", "skipped")
