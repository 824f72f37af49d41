"""One query per operator, over the whole of the given tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regloom.functions import dates, keys
from regloom.functions.hashing import row_hash
from regloom.jurisdictions import im, layout_for, rules_for
from regloom.operators import files as file_ops
from regloom.operators import ledger as ledger_ops
from regloom.operators import metadata as meta_ops
from regloom.operators import normalize as norm
from regloom.operators import rows as row_ops
from regloom.operators import schema as schema_ops
from regloom.operators import validate
from regloom.operators.parse import explode_lines, parse_fixed_width, render_fixed_width
from regloom.plans.compiler import map_to_cdm
from regloom.plans.layout import Layout
from regloom.plans.model import lake_schema
from regloom.plans.rules import MappingRules
from regloom.plans.versions import load_rule_book, map_by_version, used_rules
from regloom.session import ADJUSTABLE, RECOMMENDED, file_system, scratch_dir
from regloom.sources import archives, inventory, readers, writers
from regloom.streaming import ingest
from regloom.workload.registry import columns, read_table, registry

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FETCHED_AT, PARSED_AT, MAPPED_AT = "2024-10-07T05:00:00", "2024-10-07T06:00:00", "2024-10-07T07:00:00"


def query(fn: Query) -> Query:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        for key in ADJUSTABLE:
            spark.conf.set(key, RECOMMENDED[key])
        return fn(spark, sf_dir.rstrip("/"))

    QUERIES[fn.__name__] = run
    return run


def rules_of(**rules: dict) -> MappingRules:
    return MappingRules.from_dict({"meta_data": {"file_name": "queries", "version": "1"}, "rules": rules})


def holder(name: str) -> dict:
    return {"cdm_field": name, "value_type": "dict", "strategy": "add"}


def copied(source: str, target: str, parent: str | None = None) -> dict:
    return {"source_field": source, "cdm_field": target, "cdm_parent": parent}


def literal(value: str, target: str, parent: str | None = None, group: str | None = None) -> dict:
    rule = {"literal_value": value, "cdm_field": target, "cdm_parent": parent, "strategy": "literal"}
    return rule | ({"pattern_group": group} if group else {})


def grouped(pattern: str, target: str, parent: str, group: str | int = 1) -> dict:
    return {"pattern": pattern, "cdm_field": target, "cdm_parent": parent, "pattern_group": group, "strategy": "regex"}


def mapped(spark: SparkSession, sf_dir: str, rules: MappingRules, model: list[str], wanted: list[str]) -> DataFrame:
    rows = registry(spark, sf_dir, wanted)
    return schema_ops.encode_json(map_to_cdm(rows, rules, model=model))


def company_metadata() -> dict[str, Column | str | None]:
    layout, rules = layout_for("us_fl"), rules_for("us_fl")
    labels = {
        **meta_ops.parse_labels(layout, "us_fl", PARSED_AT),
        **meta_ops.mapping_labels(rules, "regloom", MAPPED_AT),
    }
    stamped = meta_ops.METADATA_FIELDS
    return {
        "source_name": "cordata",
        "fetched_by": "fetcher",
        "fetched_at": FETCHED_AT,
        "periodicity": "daily",
        **{k: v for k, v in labels.items() if k in stamped},
    }


def company_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry lines parsed and mapped with the full rule set."""
    layout = layout_for("us_fl")
    lines = render_fixed_width(registry(spark, sf_dir), layout)
    return map_to_cdm(parse_fixed_width(lines, layout), rules_for("us_fl"), company_metadata())


def routed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = rules_for("us_fl")
    return validate.with_route(
        company_records(spark, sf_dir), rules.date_fields(), no_data_ok=True, formats=rules.date_formats()
    )


# --- fixed-width text ---


@query
def fw_parse(spark, sf_dir):
    """Lines written as text files, read back, sliced and hashed."""
    layout, path = layout_for("us_fl"), scratch_dir(spark, "lines")
    render_fixed_width(registry(spark, sf_dir), layout).write.text(path)
    return parse_fixed_width(spark.read.text(path), layout, decode=True)


@query
def fw_chunk(spark, sf_dir):
    """Rows numbered in order and cut into chunks of 100."""
    rows = registry(spark, sf_dir, ["COR_NUMBER", "COR_NAME"])
    return row_ops.with_chunk_index(rows, 100, ["COR_NUMBER"])


DIRTY_LAYOUT = Layout.from_dict(
    {
        "fields": [
            {"name": "head", "start": 1, "end": 12},
            {"name": "body", "start": 13, "end": 60},
            {"name": "rest", "start": 61, "end": 2**31 - 1},
        ]
    }
)


@query
def fw_dirty(spark, sf_dir):
    """Document lines with quotes, tabs, no-break blanks and non-ASCII text."""
    docs = read_table(spark, sf_dir, "documents")
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    dirty = lines.selectExpr(
        "doc_id",
        "CASE doc_id % 3 WHEN 0 THEN concat(chr(9), line) WHEN 1 THEN concat(line, chr(160)) ELSE line END AS value",
    )
    return parse_fixed_width(explode_lines(dirty, keep=["doc_id"]), DIRTY_LAYOUT, add_hash=False, keep=["doc_id"])


@query
def fw_bad_bytes(spark, sf_dir):
    """Lines with bytes that are no UTF-8, written to text files and read back."""
    path = scratch_dir(spark, "bytes")
    events = read_table(spark, sf_dir, "events").selectExpr("event_id", "CAST(concat('e', event_id, ' ', event_type) AS BINARY) AS line")
    broken = events.selectExpr("CASE WHEN event_id % 3 = 0 THEN concat(line, X'FF', CAST('é' AS BINARY)) ELSE line END AS line")
    broken.select(F.col("line").cast("string").alias("value")).write.text(path)
    return readers.read_lines(spark, path)


@query
def row_hash_registry(spark, sf_dir):
    rows = registry(spark, sf_dir)
    return rows.select("COR_NUMBER", row_hash(list(columns())).alias("hash"))


@query
def row_hash_documents(spark, sf_dir):
    """Hash over whole texts, with line breaks and both kinds of quotes."""
    docs = read_table(spark, sf_dir, "documents")
    fields = docs.selectExpr("doc_id", "concat(lang, chr(39), source) AS origin", "replace(text, 'ion', chr(39)) AS body")
    return fields.select("doc_id", row_hash(["origin", "body"]).alias("hash"))


# --- sources and sinks ---

ORDER_TEXT = ["concat('', o_orderkey) AS o_orderkey", "concat('', o_custkey) AS o_custkey", "o_orderstatus", "o_orderpriority"]


@query
def csv_scan(spark, sf_dir):
    path = scratch_dir(spark, "orders")
    writers.write_csv(read_table(spark, sf_dir, "orders").selectExpr(*ORDER_TEXT), path)
    return readers.read_source(spark, [path], "csv", recursive=True)


@query
def csv_bz2(spark, sf_dir):
    path = scratch_dir(spark, "customers")
    rows = read_table(spark, sf_dir, "customer").selectExpr("concat('', c_custkey) AS c_custkey", "c_name", "c_mktsegment")
    writers.write_csv(rows, path, compression="bzip2")
    return readers.read_source(spark, path, "csv")


@query
def csv_roundtrip(spark, sf_dir):
    """Nested values through CSV: JSON text with quotes and commas."""
    path = scratch_dir(spark, "records")
    rules = rules_of(
        company_number=copied("COR_NUMBER", "company_number"),
        name=copied("COR_NAME", "name"),
        mailing_address=holder("mailing_address"),
        line_1=copied("COR_MAIL_ADD_1", "street", "mailing_address"),
        line_2=copied("COR_MAIL_ADD_2", "unit", "mailing_address"),
    )
    wanted = ["COR_NUMBER", "COR_NAME", "COR_MAIL_ADD_1", "COR_MAIL_ADD_2"]
    records = map_to_cdm(registry(spark, sf_dir, wanted), rules, model=["company_number", "name", "mailing_address"])
    writers.write_csv(records, path, max_rows=1_000_000)
    return readers.read_source(spark, path, "csv")


def customer_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a cell that holds line breaks, quotes and commas."""
    return read_table(spark, sf_dir, "customer").selectExpr(
        "concat('', c_custkey) AS id",
        """concat(c_name, CASE c_custkey % 4 WHEN 0 THEN '\\nline' WHEN 1 THEN ', "quoted"' WHEN 2 THEN '\\r\\n"' ELSE '' END) AS note""",
        "c_mktsegment AS segment",
    )


@query
def csv_multiline(spark, sf_dir):
    """Cells with line breaks through the sink and back, as a table and as a stream."""
    path, sink, ledger = (scratch_dir(spark, p) for p in ("notes", "notes-sink", "notes-ledger"))
    rows = customer_texts(spark, sf_dir)
    writers.write_csv(rows, path)
    ingest.ingest_available(ingest.stream_rows(spark, path, "csv", rows.schema, glob="*.csv"), sink, ledger)
    read = readers.read_source(spark, path, "csv").withColumn("how", F.lit("table"))
    return read.unionByName(spark.read.parquet(sink).drop("path").withColumn("how", F.lit("stream")))


@query
def csv_blocks(spark, sf_dir):
    """One file with line breaks, quotes and separators in its cells, cut into blocks that many tasks read."""
    path = scratch_dir(spark, "one-file")
    lines = read_table(spark, sf_dir, "lineitem").selectExpr(
        "concat(l_orderkey, '-', l_linenumber) AS id",
        """concat(l_returnflag, CASE l_orderkey % 5 WHEN 0 THEN ',"' WHEN 1 THEN repeat('\\n', l_linenumber % 3 + 1) WHEN 2 THEN '"\\r\\n"' ELSE '' END,
            l_linestatus) AS note""",
        "concat('', l_suppkey) AS supplier",
    )
    writers.write_csv(lines.coalesce(1), path)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    # Some fifty blocks, whatever the size of the file.
    spark.conf.set(name, str(listed.agg(F.sum("length")).first()[0] // 50 + 1))
    try:
        read = readers.read_source(spark, path, "csv")
    finally:
        spark.conf.set(name, before)
    return read


@query
def csv_mixed_headers(spark, sf_dir):
    """Two folders whose files have their columns in another order, one of them without the last."""
    path, rows = scratch_dir(spark, "mixed"), customer_texts(spark, sf_dir)
    writers.write_csv(rows.filter("id % 2 = 0"), f"{path}/a")
    writers.write_csv(rows.filter("id % 2 = 1").select("note", "id"), f"{path}/b")
    return readers.read_source(spark, path, "csv", recursive=True)


@query
def jsonl_corrupt(spark, sf_dir):
    """JSON lines, every tenth of them cut short: records go on, the others to quarantine with text and path."""
    from pyspark.sql import types as T

    path = scratch_dir(spark, "broken")
    orders = read_table(spark, sf_dir, "orders").selectExpr("concat('O', o_orderkey) AS id", "o_orderstatus AS status", "o_orderkey")
    line = F.to_json(F.struct("id", "status"))
    broken = F.when(F.col("o_orderkey") % 10 == 3, F.left(line, F.lit(12))).otherwise(line)
    orders.select(broken.alias("value")).write.text(path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "status")])
    good, bad = readers.read_json_lines(spark, path, schema)
    sink, ledger = (scratch_dir(spark, p) for p in ("broken-sink", "broken-ledger"))
    rules = rules_of(number=copied("id", "company_number"), state=copied("status", "current_status"))
    stream = ingest.stream_rows(spark, path, "json_lines", schema, glob="*.txt")
    ingest.ingest_available(ingest.records_from_rows(stream, rules), sink, ledger)
    streamed = spark.read.parquet(sink).select(
        F.concat(F.lit("stream "), F.col(validate.ROUTE)).alias("kind"),
        F.col("company_number").alias("id"), F.col("current_status").alias("status"), F.col(readers.CORRUPT).alias("value"),
        F.col("path").isNotNull().alias("has_path"),
    )
    none = F.lit(None).cast("string")
    rows = good.select(F.lit("row").alias("kind"), "id", "status", none.alias("value"), F.lit(True).alias("has_path"))
    kept = bad.select(F.lit("quarantine").alias("kind"), none.alias("id"), none.alias("status"), "value", F.col("path").isNotNull().alias("has_path"))
    return rows.unionByName(kept).unionByName(streamed)


@query
def fw_chunk_file(spark, sf_dir):
    """Lines numbered by their place in their file and cut into chunks of 100; one file a city."""
    path = scratch_dir(spark, "cities")
    rows = registry(spark, sf_dir, ["COR_NUMBER", "COR_PRINC_CITY"])
    placed = rows.repartition("COR_PRINC_CITY").sortWithinPartitions("COR_PRINC_CITY", "COR_NUMBER")
    placed.selectExpr("COR_PRINC_CITY AS city", "concat(COR_NUMBER, chr(11), 'second line') AS value").write.partitionBy("city").text(path)
    numbered = readers.write_numbered_lines(spark, path)
    city = F.url_decode(F.regexp_extract("path", "city=([^/]*)/", 1))
    return numbered.select(city.alias("city"), "value", F.floor(F.col("row_index") / 100).cast("long").alias("chunk_index"))


@query
def csv_chunks(spark, sf_dir):
    """A sink that cuts files of 100 rows: how many rows the files hold."""
    path = scratch_dir(spark, "chunks")
    rows = read_table(spark, sf_dir, "customer").selectExpr("concat('', c_custkey) AS c_custkey", "c_name")
    # Whole runs of 100 rows go to a task, which cuts them into files of its own; the last, shorter one comes last in its task.
    chunked = row_ops.with_chunk_index(rows, 100)
    dealt = chunked.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "chunk_index").sortWithinPartitions("chunk_index")
    writers.write_csv(dealt.drop("chunk_index"), path, max_rows=100)
    read = readers.read_source(spark, path, "csv", path_column="file")
    return read.groupBy("file").agg(F.count("*").alias("rows")).groupBy("rows").agg(F.count("*").alias("files"))


@query
def csv_chunk_rows(spark, sf_dir):
    """Every row of a sink that cuts files of 100 rows, in order of the key, with the number of rows of its file."""
    path = scratch_dir(spark, "chunk-rows")
    rows = read_table(spark, sf_dir, "customer").selectExpr("concat('', c_custkey) AS c_custkey", "c_name", "c_custkey AS place")
    chunked = row_ops.with_chunk_index(rows, 100, ["place"]).drop("place")
    dealt = chunked.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "chunk_index").sortWithinPartitions("chunk_index")
    writers.write_csv(dealt.drop("chunk_index"), path, max_rows=100)
    read = readers.read_source(spark, path, "csv", path_column="file")
    sizes = read.groupBy("file").agg(F.count("*").alias("rows"))
    return read.join(sizes, "file").drop("file")


@query
def jsonl_scan(spark, sf_dir):
    path = scratch_dir(spark, "turns")
    turns = read_table(spark, sf_dir, "conversations")
    turns.write.json(path)
    return readers.read_source(spark, path, "json_lines", schema=turns.schema)


@query
def read_dispatch(spark, sf_dir):
    """The same rows through every readable format."""
    rows = read_table(spark, sf_dir, "events").selectExpr("concat('', event_id) AS event_id", "event_type", "props")
    found = None
    for fmt in ("csv", "json_lines", "parquet"):
        path = scratch_dir(spark, f"events-{fmt}")
        if fmt == "csv":
            writers.write_csv(rows, path)
        elif fmt == "json_lines":
            rows.write.json(path)
        else:
            rows.write.parquet(path)
        read = readers.read_source(spark, path, fmt, schema=rows.schema).withColumn("fmt", F.lit(fmt))
        found = read if found is None else found.unionByName(read)
    return found


@query
def zip_expand(spark, sf_dir):
    """Turns packed into zip files on disk, an archive for forty conversations, and read back: members with their lines."""
    turns = read_table(spark, sf_dir, "conversations").selectExpr("conv_id div 40 AS batch", "conv_id", "turn", "text")
    path = scratch_dir(spark, "zips")
    folder = path.removeprefix("file:")

    def pack(rows):
        import os
        import zipfile

        import pandas as pd

        name = f"{folder}/turns/batch{rows['batch'].iloc[0]}.zip"
        os.makedirs(os.path.dirname(name), exist_ok=True)
        part = f"{name}.{os.getpid()}.part"
        with zipfile.ZipFile(part, "w", zipfile.ZIP_DEFLATED) as z:
            for conv, turn, text in zip(rows["conv_id"], rows["turn"], rows["text"]):
                z.writestr(f"conv/c{conv}_t{turn}.txt", text)
        os.replace(part, name)  # a task that is run again replaces its own file
        return pd.DataFrame({"n": [len(rows)]})

    turns.groupBy("batch").applyInPandas(pack, "n long").agg(F.sum("n")).collect()
    lines = archives.expand_archives(archives.read_archives(spark, path))
    key = F.regexp_extract("key", "/(turns/.*)$", 1)
    return lines.select(F.regexp_extract("archive", "([^/]*)$", 1).alias("archive"), "member", "size", key.alias("key"), "source_name", "value")


@query
def file_inventory(spark, sf_dir):
    """Folders of an event store that hold data files, found by listing it."""
    path = scratch_dir(spark, "events")
    events = read_table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    events.write.partitionBy("event_type", "day").parquet(path)
    listed = inventory.file_inventory(spark, path, prefix="event_type=", suffixes=[".parquet"])
    # Names, sizes and times differ from run to run; what every file has of them is compared.
    return listed.filter("size > 0").select(
        "path",
        (F.col("key") == F.concat_ws("/", "path", "name")).alias("key_ok"),
        F.col("name").rlike("^part-.*[.]parquet$").alias("name_ok"),
        (F.col("timestamp") > F.lit("2020-01-01").cast("timestamp")).alias("time_ok"),
    ).distinct()


def event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as landed files: ``(key, path, name, timestamp)``."""
    return read_table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "concat('us_fl/', event_type) AS path",
        "concat('f', event_id, CASE event_id % 4 WHEN 0 THEN '_invalid.csv.bz2' WHEN 1 THEN '.csv' ELSE '.csv.bz2' END) AS name",
        "user_id",
        "CAST(ts AS TIMESTAMP) AS timestamp",
    ).withColumn("key", F.concat_ws("/", "path", "name"))


@query
def file_route(spark, sf_dir):
    return inventory.route_files(event_files(spark, sf_dir)).select("key", F.col("_route").alias("route"))


@query
def file_names(spark, sf_dir):
    """Listed files by prefix, suffix and exact names."""
    events = read_table(spark, sf_dir, "events").where("event_id % 8 < 3")
    names = events.selectExpr("CASE event_id % 8 WHEN 1 THEN concat('f', event_id, '.csv') WHEN 2 THEN concat('f', event_id, '.csv.bz2') ELSE 'nothing.csv' END AS name")
    listed = event_files(spark, sf_dir).select("key", "path", "name")
    return inventory.filter_files(listed, prefix="us_fl/c", suffixes=[".csv"], names=names)


@query
def bulk_projection(spark, sf_dir):
    at = F.lit("2024-10-08 00:00:00").cast("timestamp_ntz")
    rows = writers.bulk_projection(company_records(spark, sf_dir), extracted_at=at)
    return rows


@query
def evolve_append(spark, sf_dir):
    """Two appends to one table; the second brings new columns and lacks others."""
    import uuid

    table, path = f"evolve_{uuid.uuid4().hex}", scratch_dir(spark, "evolve")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = read_table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_nationkey AS n_nationkey", "c_mktsegment")
    schema_ops.append_evolving(nation, table, path=path)
    schema_ops.append_evolving(customer, table)
    result = spark.table(table)
    return result


# --- keys ---


@query
def rules_key(spark, sf_dir):
    rows = read_table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey",
        "n_name",
        "CASE n_nationkey % 3 WHEN 0 THEN 'json_lines' WHEN 1 THEN 'csv' ELSE 'Json' END AS fmt",
        "CASE WHEN n_nationkey % 2 = 0 THEN concat('v', n_regionkey) END AS version",
    )
    return rows.select(
        "n_nationkey",
        keys.rules_key(F.col("n_name"), F.col("fmt"), F.col("version")).alias("rules_key"),
        keys.layout_key(F.col("n_name")).alias("layout_key"),
    )


@query
def jurisdiction_check(spark, sf_dir):
    """Files whose jurisdiction is known, and those to be set aside."""
    files = read_table(spark, sf_dir, "customer").selectExpr(
        "concat('in/', c_custkey) AS path", "CASE c_nationkey % 5 WHEN 0 THEN 'us_fl' WHEN 1 THEN 'im' WHEN 2 THEN 'IM' WHEN 3 THEN '' END AS code"
    )
    return files.select("path", "code", keys.known_jurisdiction(F.col("code")).alias("known"))


@query
def target_key(spark, sf_dir):
    rows = read_table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "CAST(o_orderdate AS TIMESTAMP) AS at",
        "CASE WHEN o_orderkey % 5 <> 0 THEN concat('raw/in/', o_custkey, '.data.txt') END AS file_key",
        "CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 4 - 1 END AS part",
        "CASE WHEN o_orderstatus = 'F' THEN 'invalid' END AS suffix",
    )
    key = keys.target_key("us_fl", F.col("at"), F.col("file_key"), "csv", F.col("part"), True, F.col("suffix"))
    return rows.select("o_orderkey", key.alias("target_key"))


@query
def raw_key(spark, sf_dir):
    rows = read_table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "concat('o', o_orderkey, '.txt') AS name",
        "CASE WHEN o_orderkey % 9 <> 0 THEN unix_timestamp(CAST(o_orderdate AS TIMESTAMP)) ELSE 0 END AS epoch",
    )
    now = F.lit("2024-10-07").cast("timestamp")
    return rows.select("o_orderkey", keys.raw_key("landing", F.col("name"), F.col("epoch"), "epoch", now).alias("raw_key"))


# --- dates ---


@query
def date_norm(spark, sf_dir):
    rows = registry(spark, sf_dir, ["COR_NUMBER", "COR_FILE_DATE"])
    rule = rules_for("us_fl").rules["cor_file_date"]
    entry = dates.date_struct(F.col("COR_FILE_DATE"), rule.date_format, rule.python_date_format)
    return rows.select(
        "COR_NUMBER",
        entry.getField("value").alias("value"),
        entry.getField("format").alias("format"),
        dates.to_lenient_date(F.col("COR_FILE_DATE"), rule.python_date_format).alias("parsed"),
    )


MONTH_NAMES = "element_at(array('Jan','FEB','mar','Apr','May','Jun','Jul','Aug','Sep','oct','Nov','Dec'), month(o_orderdate))"


@query
def date_norm_named_month(spark, sf_dir):
    """``%d %b %Y`` with unpadded days, any case, and days that do not exist."""
    rows = read_table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        f"concat(CASE WHEN o_orderkey % 10 = 0 THEN 31 ELSE day(o_orderdate) END, ' ', {MONTH_NAMES}, '  ', year(o_orderdate)) AS v",
    )
    return rows.select(
        "o_orderkey",
        dates.normalise_date(F.col("v"), "%d %b %Y").alias("value"),
        dates.to_lenient_date(F.col("v"), "%d %b %Y").alias("parsed"),
    )


@query
def date_valid(spark, sf_dir):
    """Validity of JSON text in every state, both ways of treating missing data."""
    rows = registry(spark, sf_dir, ["COR_NUMBER", "COR_FILE_DATE"]).selectExpr(
        "COR_NUMBER",
        """CASE
            WHEN COR_NUMBER LIKE '%00' THEN NULL
            WHEN COR_NUMBER LIKE '%01' THEN '{}'
            WHEN COR_NUMBER LIKE '%02' THEN '{"file_date":"foo"}'
            WHEN COR_NUMBER LIKE '%03' THEN '{"file_date":{}}'
            WHEN COR_NUMBER LIKE '%04' THEN '{"file_date":{"value":"01012020"}}'
            WHEN COR_NUMBER LIKE '%05' THEN '{"file_date":{"value":"2020.02.28","python_date_format":"%Y.%m.%d"}}'
            WHEN COR_NUMBER LIKE '%06' THEN '{"file_date":{"value":"2020.02.30","python_date_format":"%Y.%m.%d"}}'
            WHEN COR_NUMBER LIKE '%07' THEN '{"file_date":{"value":"2020.02.28","python_date_format":"%Q.%m.%d"}}'
            ELSE concat('{"file_date":{"value":"', COR_FILE_DATE, '","python_date_format":"%m%d%Y"}}') END AS d""",
    )
    return rows.select(
        "COR_NUMBER",
        validate.is_date_valid(rows, "d", False, formats=["%m%d%Y"]).alias("strict"),
        validate.is_date_valid(rows, "d", True, formats=["%m%d%Y"]).alias("lax"),
    )


@query
def ts_norm(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    forms = [
        "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
        "yyyy-MM-dd'T'HH:mm:ss.SSS'+02:00'",
        "yyyy-MM-dd'T'HH:mm:ss",
        "yyyy-MM-dd'T'HH:mm:ss'Z'",
        "yyyy-MM-dd HH:mm:ss",
        "dd/MM/yyyy HH:mm",
    ]
    form = F.col("event_id") % len(forms)
    rendered = F.lit(None).cast("string")
    for i, fmt in enumerate(forms):
        rendered = F.when(form == i, F.date_format("ts", fmt)).otherwise(rendered)
    return events.select("event_id", dates.normalise_timestamp(rendered).alias("ts"))


# --- rule mapping ---


@query
def cdm_copy(spark, sf_dir):
    """The first non-empty source of a field wins, in column order."""
    rules = rules_of(
        number=copied("COR_NUMBER", "company_number"),
        princ=copied("COR_PRINC_ADD_2", "name"),
        mail=copied("COR_MAIL_ADD_1", "name"),
        city=copied("COR_MAIL_CITY", "name"),
        missing=copied("NO_SUCH_COLUMN", "company_type"),
    )
    wanted = ["COR_NUMBER", "COR_PRINC_ADD_2", "COR_MAIL_ADD_1", "COR_MAIL_CITY"]
    return mapped(spark, sf_dir, rules, ["company_number", "name", "company_type"], wanted)


@query
def cdm_empty(spark, sf_dir):
    """Empty cells create nothing, not even their parent."""
    rules = rules_of(
        number=copied("COR_NUMBER", "company_number"),
        ids=holder("company_identifiers"),
        uid=copied("COR_FEI_NUMBER", "uid", "company_identifiers"),
        attributes=holder("all_attributes"),
        origin=copied("STATE_COUNTRY", "jurisdiction_of_origin", "all_attributes"),
        unit=copied("COR_MAIL_ADD_2", "unit", "all_attributes"),
    )
    wanted = ["COR_NUMBER", "COR_FEI_NUMBER", "STATE_COUNTRY", "COR_MAIL_ADD_2"]
    return mapped(spark, sf_dir, rules, ["company_number", "company_identifiers", "all_attributes"], wanted)


@query
def cdm_literal(spark, sf_dir):
    """Literals need one non-empty cell, and beat a copy to the same field."""
    rules = rules_of(
        agent=copied("RA_NAME", "name"),
        code=literal("us_fl", "jurisdiction_code"),
        also=copied("RA_CITY", "jurisdiction_code"),
        attributes=holder("all_attributes"),
        system=literal("us_fein", "identifier_system_code", "all_attributes"),
    )
    model = ["name", "jurisdiction_code", "all_attributes"]
    return mapped(spark, sf_dir, rules, model, ["RA_NAME", "RA_CITY"])


@query
def cdm_nested(spark, sf_dir):
    """Copies into a parent; the last non-empty source of a field stays."""
    rules = rules_of(
        number=copied("COR_NUMBER", "company_number"),
        address=holder("registered_address"),
        street=copied("COR_PRINC_ADD_1", "street", "registered_address"),
        unit=copied("COR_PRINC_ADD_2", "extra", "registered_address"),
        box=copied("COR_MAIL_ADD_1", "extra", "registered_address"),
    )
    wanted = ["COR_NUMBER", "COR_PRINC_ADD_1", "COR_PRINC_ADD_2", "COR_MAIL_ADD_1"]
    return mapped(spark, sf_dir, rules, ["company_number", "registered_address"], wanted)


@query
def cdm_nested2(spark, sf_dir):
    """Two levels below a field."""
    rules = rules_of(
        number=copied("COR_NUMBER", "company_number"),
        attributes=holder("all_attributes"),
        filing={**holder("filing"), "cdm_parent": "all_attributes"},
        uid=copied("COR_FEI_NUMBER", "uid", "filing"),
        origin=copied("STATE_COUNTRY", "origin", "filing"),
    )
    wanted = ["COR_NUMBER", "COR_FEI_NUMBER", "STATE_COUNTRY"]
    return mapped(spark, sf_dir, rules, ["company_number", "all_attributes"], wanted)


@query
def cdm_regex(spark, sf_dir):
    """Groups labelled by what a pattern captures from column names."""
    rules = rules_of(
        number=copied("COR_NUMBER", "company_number"),
        officers=holder("officers"),
        name=grouped(r"PRINC(\d)_NAME", "name", "officers"),
        city=grouped(r"PRINC(\d)_CITY", "city", "officers"),
    )
    wanted = ["COR_NUMBER"] + [c for c in columns() if c.startswith("PRINC")]
    return mapped(spark, sf_dir, rules, ["company_number", "officers"], wanted)


@query
def cdm_group_literal(spark, sf_dir):
    rules = rules_of(
        number=copied("COR_NUMBER", "company_number"),
        officers=holder("officers"),
        name=grouped("(RA_)NAME$", "name", "officers", "RA_"),
        zip4=grouped("(RA_)ZIP4", "zip4", "officers", "RA_"),
        position=literal("agent", "position", "officers", "RA_"),
    )
    return mapped(spark, sf_dir, rules, ["company_number", "officers"], ["COR_NUMBER", "RA_NAME", "RA_ZIP4"])


@query
def cdm_regex_child(spark, sf_dir):
    """A nested value inside each group."""
    nested = {**holder("other_attributes"), "cdm_parent": "officers", "strategy": "find_regex_parent", "pattern_group": 1}
    kind = {**grouped(r"PRINC(\d)_NAME_TYPE", "type", "other_attributes"), "strategy": "find_regex_parent"}
    rules = rules_of(
        number=copied("COR_NUMBER", "company_number"),
        officers=holder("officers"),
        name=grouped(r"PRINC(\d)_NAME$", "name", "officers"),
        other=nested,
        kind=kind,
    )
    wanted = ["COR_NUMBER"] + [f"PRINC{n}_{part}" for n in (1, 2, 3) for part in ("NAME_TYPE", "NAME")]
    return mapped(spark, sf_dir, rules, ["company_number", "officers"], wanted)


@query
def cdm_full(spark, sf_dir):
    """All 26 columns: lines parsed, hashed, mapped with the full rule set."""
    return schema_ops.encode_json(company_records(spark, sf_dir))


def isle_of_man_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines with lists of objects, mapped with the second rule set."""
    wanted = ["COR_NUMBER", "COR_NAME", "COR_STATUS", "RA_NAME", "RA_CITY", "STATE_COUNTRY", "REPORT_YEAR_1", "PRINC2_NAME"]
    rows = registry(spark, sf_dir, wanted)
    agents = F.array(F.struct(F.col("RA_NAME").alias("Agent"), F.col("RA_CITY").alias("Address")))

    def former(name: str) -> Column:
        return F.struct(F.col(name).alias("Name"), F.col("COR_STATUS").alias("Status"))

    source = rows.select(
        F.col("COR_NUMBER").alias("Number"),
        F.col("COR_NAME").alias("Name"),
        F.concat(F.lit("3 Oct "), F.col("REPORT_YEAR_1")).alias("Date of Registration"),
        F.when(F.col("RA_NAME") != "", agents).alias("Registered Agents"),
        F.when(F.col("PRINC2_NAME") != "", F.array(former("PRINC2_NAME"), former("COR_NAME"))).alias("Previous Names"),
        F.col("STATE_COUNTRY").alias("Registry Type"),
    )
    lines = source.select(F.to_json(F.struct("*")).alias("value"))
    parsed = lines.select(F.from_json("value", im.source_schema()).alias("v")).select("v.*")
    return map_to_cdm(parsed, rules_for("im"))


@query
def cdm_isle_of_man(spark, sf_dir):
    records = schema_ops.encode_json(isle_of_man_records(spark, sf_dir))
    return records


def versioned_rules() -> dict[str, dict]:
    """Two versions of rules for either jurisdiction, by their keys."""

    def book(version: str, **rules: dict) -> dict:
        return {"meta_data": {"file_name": "mapping", "version": version}, "rules": rules}

    number, name = copied("COR_NUMBER", "company_number"), copied("COR_NAME", "name")
    fl = {"number": number, "name": name, "code": literal("us_fl", "jurisdiction_code")}
    im_rules = {"number": copied("Number", "company_number"), "name": copied("Name", "name")}
    parent = {"ids": holder("company_identifiers"), "uid": copied("COR_FEI_NUMBER", "uid", "company_identifiers")}
    newer = {
        "us_fl": book("2", **fl, status=copied("COR_STATUS", "current_status"), **parent),
        "im": book("2", **im_rules, kind=copied("Registry Type", "company_type"), code=literal("im", "jurisdiction_code")),
    }
    older = {"us_fl": book("1", **fl), "im": book("1", **im_rules)}
    folders = {"us_fl": "csv", "im": "jsonlines"}
    return {
        f"cdm_mapping_rules/{code}/{folders[code]}/{release}/cdm_mapping_{code}.json": rules
        for release, found in (("v1", older), ("v2", newer), ("latest", newer))
        for code, rules in found.items()
    }


@query
def rule_versions(spark, sf_dir):
    """Rows of both jurisdictions, each mapped with the rules of its file's version; files of an unknown version in quarantine."""
    import json

    root = scratch_dir(spark, "rule-files")
    for key, rules in versioned_rules().items():
        files, place = file_system(spark, f"{root}/{key}")
        out = files.create(place, True)
        out.write(bytearray(json.dumps(rules).encode()))
        out.close()
    book = load_rule_book(spark, root)
    rows = registry(spark, sf_dir, ["COR_NUMBER", "COR_NAME", "COR_STATUS", "COR_FEI_NUMBER", "STATE_COUNTRY"])
    number = "CAST(substring(COR_NUMBER, 2) AS BIGINT)"
    files = rows.selectExpr(
        "concat('in/', COR_NUMBER) AS path", f"CASE WHEN {number} % 3 = 0 THEN 'IM' ELSE 'us_fl' END AS jurisdiction",
        f"CASE WHEN {number} % 3 = 0 THEN 'json_lines' ELSE 'csv' END AS content_type",
        f"CASE {number} % 5 WHEN 0 THEN 'v1' WHEN 1 THEN 'v2' WHEN 2 THEN '' WHEN 3 THEN 'v9' END AS version",
    ).select("path", keys.rules_key(F.col("jurisdiction"), F.col("content_type"), F.col("version")).alias("rules_key"))
    other = f"{number} % 3 = 0"
    source = rows.selectExpr(
        "concat('in/', COR_NUMBER) AS path", *[f"CASE WHEN NOT {other} THEN {c} END AS {c}" for c in ("COR_NUMBER", "COR_NAME", "COR_STATUS", "COR_FEI_NUMBER")],
        f"CASE WHEN {other} THEN COR_NUMBER END AS Number", f"CASE WHEN {other} THEN COR_NAME END AS Name", f"CASE WHEN {other} THEN STATE_COUNTRY END AS `Registry Type`",
    )
    model = ["company_number", "name", "jurisdiction_code", "current_status", "company_type", "company_identifiers", "cdm_mapping_rules"]
    records, lost = map_by_version(source.join(files, "path"), used_rules(files, book), model=model, keep=["path"])
    none = F.lit(None).cast("string")
    quarantined = lost.select(F.lit("quarantine").alias("route"), *[(F.col("rules_key") if c == "cdm_mapping_rules" else none).alias(c) for c in model], "path")
    return records.select(F.lit("record").alias("route"), *model, "path").unionByName(quarantined)


@query
def norm_previous_names(spark, sf_dir):
    return norm.previous_name_table(isle_of_man_records(spark, sf_dir))


@query
def norm_agents(spark, sf_dir):
    """Officers given as a list, with their addresses."""
    return norm.officer_address_table(isle_of_man_records(spark, sf_dir))


# --- metadata, encoding, alignment ---


@query
def meta_stamp(spark, sf_dir):
    """Rows joined to their file's metadata; one file holds many rows."""
    rows = registry(spark, sf_dir, ["COR_NUMBER", "COR_PRINC_CITY"]).withColumn(
        "path", F.concat(F.lit("raw/"), F.col("COR_PRINC_CITY"), F.lit(".txt"))
    )
    files = read_table(spark, sf_dir, "nation").selectExpr(
        "concat('raw/', n_name, '.txt') AS path",
        "CASE WHEN n_nationkey % 3 = 0 THEN concat('s', n_nationkey) END AS source_name",
        "concat(n_name, '.zip') AS fetched_file",
        "'sftp' AS fetched_by",
        "TIMESTAMP '2024-10-07 05:00:00.5' + make_dt_interval(n_nationkey) AS fetched_at",
    )
    joined = meta_ops.join_file_metadata(rows, files)
    shown = meta_ops.render_metadata(files, "_file")
    stamped = meta_ops.stamp_metadata(joined, {**shown, "parsed_by": layout_for("us_fl").parsed_by})
    return stamped.select("COR_NUMBER", "source_name", "fetched_by", "fetched_at", "parsed_by", "cdm_mapped_by")


@query
def json_encode(spark, sf_dir):
    rows = registry(spark, sf_dir, ["COR_NUMBER", "COR_NAME", "COR_FEI_NUMBER", "COR_MAIL_CITY"])
    nested = rows.select(
        "COR_NUMBER",
        F.struct(F.col("COR_NAME").alias("name"), F.expr("nullif(COR_FEI_NUMBER, '')").alias("uid")).alias("record"),
        F.array("COR_NAME", "COR_MAIL_CITY").alias("list"),
    )
    return schema_ops.encode_json(nested)


@query
def add_missing(spark, sf_dir):
    from pyspark.sql import types as T

    rows = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    target = T.StructType(
        [T.StructField("o_orderkey", T.LongType()), T.StructField("note", T.StringType()), T.StructField("size", T.LongType())]
    )
    return schema_ops.add_missing_columns(rows, target)


@query
def meta_backfill(spark, sf_dir):
    landed = event_files(spark, sf_dir).selectExpr(
        "key AS path", "CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN concat('old', event_id) END AS source_name"
    )
    named = meta_ops.backfill(landed, "source_name").withColumnRenamed("changed", "named")
    return meta_ops.backfill(named, "periodicity", "daily").drop("changed")


# --- validation and routing ---


@query
def split_valid(spark, sf_dir):
    rules = rules_for("us_fl")
    valid, _ = validate.split_by_dates(company_records(spark, sf_dir), rules.date_fields(), computed=True, formats=rules.date_formats())
    return schema_ops.encode_json(valid)


@query
def split_invalid(spark, sf_dir):
    rules = rules_for("us_fl")
    _, invalid = validate.split_by_dates(company_records(spark, sf_dir), rules.date_fields(), computed=True, formats=rules.date_formats())
    return schema_ops.encode_json(invalid)


@query
def date_fields(spark, sf_dir):
    """The date columns each rule set declares, with the number of rows whose dates hold there and of those without one."""
    found = None
    for code, records in (("us_fl", company_records(spark, sf_dir)), ("im", isle_of_man_records(spark, sf_dir))):
        rules = rules_for(code)
        for name in rules.date_fields():
            strict, lax = (validate.is_date_valid(records, name, ok, formats=rules.date_formats()) for ok in (False, True))
            part = records.select(F.lit(code).alias("code"), F.lit(name).alias("field"), strict.alias("strict"), lax.alias("lax"))
            counted = part.groupBy("code", "field").agg(F.count_if("strict").alias("valid"), F.count_if(F.col("lax") & ~F.col("strict")).alias("without"))
            found = counted if found is None else found.unionByName(counted)
    return found


@query
def route_counts(spark, sf_dir):
    counts = validate.route_counts(routed_records(spark, sf_dir))
    valid = F.col(validate.ROUTE) == "valid"
    table = F.when(valid, keys.staging_table("us_fl")).otherwise(keys.staging_table("us_fl", valid=False))
    return counts.select(table.alias("table"), "rows")


@query
def route_write(spark, sf_dir):
    """Both routes written in one pass, then read from their folders."""
    path = scratch_dir(spark, "routes")
    writers.write_routes(routed_records(spark, sf_dir), path, "first")
    written = spark.read.parquet(f"{path}/{writers.RUN}=first")
    return written.withColumnRenamed(validate.ROUTE, "route")


@query
def load_routes(spark, sf_dir):
    """Two runs loaded into the two tables, and the first run written and loaded once more."""
    import uuid

    staged, mark, layout, rules = scratch_dir(spark, "staged"), uuid.uuid4().hex, layout_for("us_fl"), rules_for("us_fl")
    tables = [f"stg_{mark}", f"stg_{mark}_invalid"]
    places = tuple(scratch_dir(spark, "stg") for _ in tables)
    rows = registry(spark, sf_dir)
    for run, state in (("r1", "FL"), ("r2", "GA"), ("r1", "FL")):
        lines = render_fixed_width(rows.filter(F.col("COR_PRINC_STATE") == state), layout)
        records = map_to_cdm(parse_fixed_width(lines, layout), rules, company_metadata())
        routed = validate.with_route(records, rules.date_fields(), formats=rules.date_formats())
        counts = writers.write_routes(routed, staged, run)
        writers.append_routes(spark, staged, run, *tables, schema=lake_schema(), locations=places, counts=counts)
    stamps = [f.name for f in lake_schema().fields if f.dataType.typeName() == "timestamp"]
    found = None
    for table, route in zip(tables, ("valid", "invalid"), strict=True):
        part = spark.table(table).withColumn("route", F.lit(route)).withColumnRenamed(writers.RUN, "run")
        part = part.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})
        found = part if found is None else found.unionByName(part)
    return found


@query
def source_append(spark, sf_dir):
    """Parsed rows appended to a source table in two loads, the second with a column of another case and a new one."""
    import uuid

    table, layout = f"src_{uuid.uuid4().hex}", layout_for("us_fl")
    rows = registry(spark, sf_dir)
    # The second load comes twice, as after a crash; it leaves each row once.
    for i, state in enumerate(("FL", "GA", "GA")):
        lines = render_fixed_width(rows.filter(F.col("COR_PRINC_STATE") == state), layout)
        parsed = parse_fixed_width(lines, layout)
        if i:
            parsed = parsed.withColumnRenamed("COR_NAME", "cor_name").withColumn("load", F.lit("second"))
        schema_ops.append_evolving(parsed, table, path=scratch_dir(spark, "source") if not i else None, load=state)
    return spark.table(table).drop(schema_ops.LOAD)


@query
def evolve_types(spark, sf_dir):
    """A second load whose texts widen two columns of the first, and have cells that fit no number or date."""
    import uuid

    table, path = f"types_{uuid.uuid4().hex}", scratch_dir(spark, "types")
    nation = read_table(spark, sf_dir, "nation").selectExpr(
        "concat('n', n_nationkey) AS id", "CAST(n_nationkey AS INT) AS units", "CAST(n_regionkey AS BIGINT) AS share", "DATE '2024-01-01' AS day"
    )
    orders = read_table(spark, sf_dir, "orders").selectExpr(
        "concat('o', o_orderkey) AS id",
        "CASE o_orderkey % 10 WHEN 3 THEN concat(o_orderkey, ' units') WHEN 4 THEN concat('90000', lpad(o_orderkey, 8, '0')) ELSE concat('', o_orderkey) END AS units",
        "concat(o_orderkey, '.', lpad(o_custkey % 100, 2, '0')) AS share",
        "CASE WHEN o_orderkey % 7 = 2 THEN 'soon' ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS day",
    )
    schema_ops.append_evolving(nation, table, path=path, load="first")
    for _ in range(2):
        schema_ops.append_evolving(orders, table, load="second")
    none, text = F.lit(None).cast("string"), "string"
    rows = spark.table(table).select(
        F.lit("row").alias("kind"), "id", *[F.col(c).cast(text).alias(c) for c in ("units", "share", "day")],
        F.lit(",".join(t for n, t in spark.table(table).dtypes if n in ("units", "share", "day"))).alias("types"), none.alias("text"),
    )
    cells = spark.table(schema_ops.CELLS.format(table)).select(
        F.concat(F.lit("cell "), "column").alias("kind"), F.get_json_object("row", "$.id").alias("id"),
        *[none.alias(c) for c in ("units", "share", "day")], F.col("type").alias("types"), "text",
    )
    return rows.unionByName(cells)


# --- file sets and the ledger ---


def order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").selectExpr(
        "concat('o', o_orderkey, '.txt') AS name", "o_orderkey", "o_orderstatus", "CAST(o_orderdate AS TIMESTAMP) AS timestamp"
    )


@query
def files_diff(spark, sf_dir):
    source = order_files(spark, sf_dir).select("name")
    return file_ops.files_diff(source, source.join(order_files(spark, sf_dir).filter("o_orderstatus <> 'F'"), "name", "left_semi"))


@query
def files_diff_ts(spark, sf_dir):
    """New, changed, and no time on either side; some targets are listed twice."""
    source = order_files(spark, sf_dir).selectExpr(
        "name", "o_orderkey", "o_orderstatus", "CASE WHEN o_orderkey % 10 <> 7 THEN timestamp END AS timestamp"
    )
    landed = source.filter("o_orderstatus <> 'F'").selectExpr(
        "name", "CASE WHEN o_orderkey % 4 = 1 THEN timestamp - INTERVAL 1 DAY ELSE timestamp END AS timestamp"
    )
    older = source.filter("o_orderstatus = 'O'").selectExpr("name", "timestamp - INTERVAL 2 DAY AS timestamp")
    return file_ops.files_diff(source, landed.unionByName(older), compare_timestamp=True).select("name")


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entry per region: by pattern where the key is even, else by names."""
    return read_table(spark, sf_dir, "region").selectExpr(
        "concat('cfg_', lower(r_name)) AS ingest_config",
        "lower(r_name) AS jurisdiction",
        "concat('src/', r_regionkey) AS source_path",
        "concat('raw/', r_regionkey) AS target_path",
        "CASE WHEN r_regionkey % 2 = 0 THEN '0.txt' END AS file_pattern",
        "CASE WHEN r_regionkey % 2 = 1 THEN 'c1.txt,c21.txt,c301.txt' END AS file_names",
        "CASE WHEN r_regionkey < 3 THEN 'daily' END AS periodicity",
        "r_regionkey % 4 = 2 AS check_timestamp",
    )


def customer_files(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer").selectExpr(
        f"concat('{root}/', c_custkey % 5) AS path",
        "concat('c', c_custkey, '.txt') AS name",
        "c_custkey * 1000 AS timestamp",
        "c_custkey",
        "c_acctbal",
    )


@query
def manifest_scan(spark, sf_dir):
    listed = customer_files(spark, sf_dir, "src")
    return file_ops.manifest_files(manifest(spark, sf_dir), listed).select("ingest_config", "path", "name")


@query
def workload_scan(spark, sf_dir):
    listed = customer_files(spark, sf_dir, "src").drop("c_custkey", "c_acctbal")
    landed = customer_files(spark, sf_dir, "raw").filter("c_acctbal < 5000").selectExpr(
        "concat(path, '/2024/01/01') AS path", "name", "CASE WHEN c_custkey % 2 = 0 THEN timestamp ELSE timestamp + 5 END AS timestamp"
    )
    # Every file also lies under raw/10, raw/20, …, which no entry's target is, though raw/1 and raw/2 are.
    elsewhere = customer_files(spark, sf_dir, "raw").selectExpr("concat(path, '0/2024') AS path", "name", "timestamp")
    landed = landed.unionByName(elsewhere)
    return file_ops.plan_workload(manifest(spark, sf_dir), listed, landed, kind="epoch")


@query
def group_paths(spark, sf_dir):
    """Paths per task and table.  Large groups are cut into parts of about 500; shown is every path of every part."""
    events = read_table(spark, sf_dir, "events").selectExpr(
        "event_type AS object_key",
        "CASE WHEN value < 1 THEN 'stg_us_fl_invalid' ELSE 'stg_us_fl' END AS target",
        "concat('lake/', lpad(event_id, 12, '0')) AS path",
    )
    grouped_paths = file_ops.group_paths(events, max_paths=500)
    ordered = F.col("paths") == F.sort_array("paths")
    return grouped_paths.select(
        "object_key", "target", (F.size("paths") <= 1000).alias("bounded"), ordered.alias("ordered"), F.explode("paths").alias("path")
    )


@query
def size_minmax(spark, sf_dir):
    tasks = read_table(spark, sf_dir, "lineitem").selectExpr("concat('', l_orderkey * 7 % 100003) AS size")
    return file_ops.size_range(tasks)


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").selectExpr(
        "concat(event_type, '/', lpad(event_id, 12, '0')) AS object_key",
        "CASE event_id % 5 WHEN 0 THEN 'NEW' WHEN 1 THEN 'PREPARING' WHEN 2 THEN 'PROCESSING' WHEN 3 THEN 'PROCESSED' END AS status",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") AS timestamp",
        "event_id",
    )


@query
def ledger_filter(spark, sf_dir):
    """The first 99 tasks of a prefix and state, in key order."""
    return ledger_ops.ledger_filter(tasks(spark, sf_dir).drop("event_id"), "click/", "PREPARING", 99)


@query
def ledger_new(spark, sf_dir):
    return ledger_ops.new_items(tasks(spark, sf_dir)).select("object_key", "status")


@query
def ledger_transition(spark, sf_dir):
    changes = tasks(spark, sf_dir).selectExpr(
        "object_key",
        "CASE WHEN event_id % 2 = 0 THEN 'PREPARING' ELSE 'ERROR' END AS to_status",
        "CASE WHEN event_id % 3 <> 0 THEN 'NEW' END AS from_status",
        "'2024-10-07T00:00:00' AS timestamp",
    ).filter("object_key NOT LIKE 'error/%'").withColumn("seq", F.lit(1).cast("long"))
    # A third of the tasks is asked a second time, for the state the first change may have left.
    again = changes.filter("from_status IS NULL").selectExpr(
        "object_key", "'PROCESSED' AS to_status", "'PREPARING' AS from_status", "'2024-10-08T00:00:00' AS timestamp", "2L AS seq"
    )
    return ledger_ops.ledger_transition(tasks(spark, sf_dir).drop("event_id"), changes.unionByName(again))


@query
def ledger_transition_hot(spark, sf_dir):
    """A third of all changes are for one task, each guarded by a state an earlier one may have left."""
    asked = tasks(spark, sf_dir).selectExpr(
        "CASE WHEN event_id % 3 = 0 THEN 'busy' ELSE concat('t', event_id % 50) END AS object_key",
        "concat('S', event_id * 7 % 11 % 5) AS to_status",
        "CASE WHEN event_id % 101 <> 7 THEN concat('S', event_id * 5 % 13 % 5) END AS from_status",
        "concat('at', event_id) AS timestamp",
        "event_id AS seq",
    )
    ledger = asked.select("object_key").distinct().selectExpr("object_key", "'S1' AS status", "'none' AS timestamp")
    return ledger_ops.ledger_transition(ledger, asked)


@query
def ledger_upsert(spark, sf_dir):
    added = tasks(spark, sf_dir).filter("status IS NULL").selectExpr("object_key", "'NEW' AS status", "timestamp")
    more = read_table(spark, sf_dir, "nation").selectExpr("concat('nation/', n_name) AS object_key", "'NEW' AS status", "'' AS timestamp")
    return ledger_ops.ledger_upsert(tasks(spark, sf_dir).drop("event_id"), added.unionByName(more))


@query
def head_samples(spark, sf_dir):
    """Prefix samples of the orders, by key: which samples an order is part of."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    samples = row_ops.head_samples(orders, ["o_orderdate", "o_orderkey"])
    found = None
    for size, rows in samples.items():
        part = rows.select("o_orderkey", F.lit(size).cast("long").alias("sample"))
        found = part if found is None else found.unionByName(part)
    return found


@query
def sample_files(spark, sf_dir):
    """Prefix samples of the orders as CSV files: every row of every file."""
    path = scratch_dir(spark, "sample-files")
    orders = read_table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_orderdate", "o_orderpriority")
    writers.write_samples(orders, f"{path}/orders.csv", ["o_orderdate", "o_orderkey"])
    read = readers.read_source(spark, path, "csv", path_column="path")
    return read.select(F.regexp_extract("path", "([^/]*)$", 1).alias("file"), "o_orderkey", "o_orderpriority")


# --- relational tables ---


@query
def norm_company(spark, sf_dir):
    records = company_records(spark, sf_dir)
    formats = rules_for("us_fl").date_formats()
    return norm.company_table(records, formats).withColumn("retrieved_at", F.col("retrieved_at").cast("timestamp_ntz"))


@query
def norm_officer(spark, sf_dir):
    return norm.officer_table(company_records(spark, sf_dir))


@query
def norm_officer_address(spark, sf_dir):
    return norm.officer_address_table(company_records(spark, sf_dir))


@query
def norm_address(spark, sf_dir):
    records = schema_ops.encode_json(company_records(spark, sf_dir))
    found = norm.address_tables(records, ["mailing_address", "headquarters_address"])
    return found.withColumn("source", F.replace("source", F.lit("_address"), F.lit(""))).withColumnRenamed("source", "kind")


@query
def norm_identifier(spark, sf_dir):
    return norm.identifier_table(company_records(spark, sf_dir))


@query
def norm_attributes(spark, sf_dir):
    return norm.attribute_table(company_records(spark, sf_dir))


@query
def join_address(spark, sf_dir):
    rows = registry(spark, sf_dir, ["COR_NUMBER", "COR_MAIL_ADD_1", "COR_MAIL_ADD_2", "RA_ZIP5", "RA_ZIP4"])
    return rows.select(
        "COR_NUMBER",
        norm.join_street(F.col("COR_MAIL_ADD_1"), F.col("COR_MAIL_ADD_2")).alias("street_address"),
        norm.join_zip(F.col("RA_ZIP5"), F.col("RA_ZIP4")).alias("postal_code"),
    )


@query
def share_view(spark, sf_dir):
    return schema_ops.encode_json(norm.share_view(company_records(spark, sf_dir)))


# --- streaming ---


@query
def stream_ingest(spark, sf_dir):
    """Registry files arriving in two batches, each file taken once."""
    layout, rules = layout_for("us_fl"), rules_for("us_fl")
    source, sink, ledger = (scratch_dir(spark, p) for p in ("arrivals", "sink", "ledger"))
    rows = registry(spark, sf_dir)
    stamps = {k: v for k, v in company_metadata().items() if k != "source_name"}
    for state in ("FL", "GA"):
        arrived = rows.filter(F.col("COR_PRINC_STATE") == state)
        render_fixed_width(arrived, layout).write.mode("append").text(source)
        stream = ingest.stream_lines(spark, source)
        ingest.ingest_available(ingest.records_from_lines(stream, layout, rules, stamps), sink, ledger)
    out = spark.read.parquet(sink)
    # Part files are named by the writer.
    return out.drop("source_name").withColumnRenamed(validate.ROUTE, "route")


@query
def stream_redelivered(spark, sf_dir):
    """Files that come twice, in one run and in a later one, under other names: each row once, and how many were left out."""
    layout, rules = layout_for("us_fl"), rules_for("us_fl")
    source, sink, ledger = (scratch_dir(spark, p) for p in ("twice", "twice-sink", "twice-ledger"))
    rows = registry(spark, sf_dir)
    repeated = 0
    for states in (["FL", "FL"], ["FL", "GA"]):
        for state in states:
            arrived = rows.filter(F.col("COR_PRINC_STATE") == state)
            render_fixed_width(arrived, layout).write.mode("append").text(source)
        records = ingest.records_from_lines(ingest.stream_lines(spark, source), layout, rules)
        repeated += ingest.ingest_available(ingest.without_redelivered(records), sink, ledger)["repeated"]
    out = spark.read.parquet(sink).withColumnRenamed(validate.ROUTE, "route")
    return out.select("company_number", "name", "hash", "route", F.lit(repeated).cast("long").alias("left_out"))
