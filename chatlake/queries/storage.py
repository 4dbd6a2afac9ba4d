"""Queries over sources, sinks, keys and builds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake.formats import load_format
from chatlake.formats.base import Format
from chatlake.formats.registry import FLAGGED_MESSAGES, FLAT_CALLS, REPLY_MESSAGES
from chatlake.functions import text as X
from chatlake.functions.template import CHATML
from chatlake.operators import turns as R
from chatlake.plans import build
from chatlake.plans.dispatch import resolve_formats
from chatlake.queries.corpus import replies
from chatlake.queries.fixtures import table
from chatlake.session import staged_path
from chatlake.sources import jsonl, manifest, parquet
from chatlake.sources.sinks import SPLITS, write_splits


def file_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents numbered in the order of the file."""
    return parquet.scan(spark, f"{sf_dir.rstrip('/')}/documents.parquet").select("doc_id", "example_index")


def raw_json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", parquet.raw_json(turns.columns).alias("raw"))


def _written_lines(spark: SparkSession, sf_dir: str) -> str:
    path = staged_path(spark, "raw")
    turns = table(spark, sf_dir, "conversations")
    ordered = turns.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn")
    parquet.write_raw_lines(ordered, path)
    return path


def jsonl_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written as JSON lines and read back with their index."""
    lines = jsonl.scan(spark, _written_lines(spark, sf_dir))
    rows = jsonl.parse(lines, "conv_id:bigint,turn:bigint,role:string,text:string")
    return rows.select("example_index", "conv_id", "turn", "role", "text")


def _document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a line of a message dataset: whole, with a repeated key, with a list
    of blocks, with a text that looks like one, broken, or behind a blank line."""
    docs = table(spark, sf_dir, "documents")
    kind = F.col("doc_id") % 6
    text = F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("t")))
    quoted = F.expr("substr(q, 6, length(q) - 6)")
    looks = F.concat(F.lit('"[note] __end_of_value '), F.expr("substr(quoted, 2)"))
    content = (
        F.when(kind == 2, F.concat(F.lit('[{"type":"text","text":'), F.col("quoted"), F.lit("}]")))
        .when(kind == 3, looks)
        .otherwise(F.col("quoted"))
    )
    head = F.when(kind == 1, F.lit('{"id":0,"messages":[],"messages":')).otherwise(F.lit('{"id":0,"messages":'))
    line = F.concat(
        head,
        F.lit('[{"role":"user","content":'),
        content,
        F.lit('},{"role":"assistant","content":"ok"}]'),
        F.when(kind == 4, F.lit("")).when(kind == 1, F.lit(',"id":1}')).otherwise(F.lit("}")),
    )
    value = F.when(kind == 5, F.concat(F.lit("  \n"), line)).otherwise(line)
    return docs.withColumn("q", text).withColumn("quoted", quoted).select("doc_id", value.alias("value"))


def _document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staged_path(spark, "document-lines")
    lines = _document_lines(spark, sf_dir).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    lines.select("value").write.text(path)
    return jsonl.parse_format(jsonl.scan(spark, path), load_format(REPLY_MESSAGES))


def jsonl_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as message lines of every kind, broken ones and blank ones between."""
    return _document_rows(spark, sf_dir).select(
        "example_index",
        F.col("problem").isNotNull().alias("broken"),
        F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n").alias("conversation"),
    )


def jsonl_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training splits of lines some of which are broken; those count in the total. Whole texts."""
    rows = _document_rows(spark, sf_dir)
    return build.training_splits(rows, REPLY_MESSAGES).select("example_index", "split", "text")


# Values that a field of a line may have, of every JSON kind, by doc_id.
_FLAGS = ["true", "false", "null", "1", "0", '"yes"', '""', '"0"', '"false"', "[]", "[0]", "{}", "0.0", '" "', "-2.5e3", '"[]"']
_TOOLS = ["[]", '[{"name":"f"}]', '"[x]"', "5", "null", '["x"]', "{}", '"[]"']
_ELEMENTS = ["", "", "", '"text"', "5", "null", '["role"]', '"{\\"role\\":\\"user\\"}"', "{}", '{"role":"clown"}', '{"role":7}']


def _pick(values: list[str], key: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (key % len(values) + 1).cast("int"))


def _kinds_rows(spark: SparkSession, sf_dir: str, name: str) -> tuple[Format, DataFrame]:
    """Every document as a line of a layout, with fields of mixed JSON kinds."""
    docs = table(spark, sf_dir, "documents")
    doc = F.col("doc_id")
    text = F.expr("substr(q, 6, length(q) - 6)")
    quoted = docs.withColumn("q", F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("t")))).withColumn("quoted", text)
    if name == FLAT_CALLS:
        value = F.when(doc % 5 == 1, doc.cast("string")).when(doc % 5 == 2, F.concat(F.lit("["), "quoted", F.lit("]"))).otherwise(F.col("quoted"))
        field = F.when(doc % 9 != 3, F.concat(F.lit('"tools": '), _pick(_TOOLS, doc), F.lit(",")))
        line = F.concat(F.lit('{"instructions":"i",'), F.coalesce(field, F.lit("")), F.lit('"input":'), value, F.lit("}"))
    else:
        reply = F.concat(F.lit('{"role":"assistant","train_on_turn": '), _pick(_FLAGS, doc), F.lit(',"content":'), "quoted", F.lit("}"))
        more = _pick(_ELEMENTS, doc)
        listed = F.concat(F.lit("["), reply, F.when(more != "", F.concat(F.lit(","), more)).otherwise(F.lit("")), F.lit("]"))
        value = F.when(doc % 13 == 5, F.col("quoted")).when(doc % 13 == 7, F.lit("{}")).otherwise(listed)
        line = F.concat(F.lit('{"'), F.when(doc % 17 == 3, F.lit("message")).otherwise(F.lit("messages")), F.lit('":'), value, F.lit("}"))
    path = staged_path(spark, "kinds")
    quoted.select("doc_id", line.alias("value")).repartitionByRange("doc_id").sortWithinPartitions("doc_id").select("value").write.text(path)
    fmt = load_format(name)
    return fmt, jsonl.parse_format(jsonl.scan(spark, path), fmt)


def jsonl_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with flags of every JSON kind and elements that are no messages: the reason of those
    that are not valid, and the training text of flagged turns."""
    fmt, rows = _kinds_rows(spark, sf_dir, FLAGGED_MESSAGES)
    made = fmt.convert_for_training(rows).select("example_index", F.lit(None).cast("string").alias("reason"), "text")
    return made.unionByName(fmt.rejects(rows).withColumn("text", F.lit(None).cast("string")))


def jsonl_flat_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat lines whose tools and input are of every JSON kind: the reason, or the prompt."""
    fmt, rows = _kinds_rows(spark, sf_dir, FLAT_CALLS)
    made = fmt.convert_for_eval(rows).select("example_index", F.lit(None).cast("string").alias("reason"), "prompt")
    return made.unionByName(fmt.rejects(rows).withColumn("prompt", F.lit(None).cast("string")))


def line_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsonl.line_count(spark, _written_lines(spark, sf_dir))


def split_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training splits written as JSON lines in several files, and read back with each line's place
    in its split."""
    path = staged_path(spark, "splits")
    write_splits(R.split_training_rows(table(spark, sf_dir, "conversations"), replies()), path, examples_per_file=64)
    splits = []
    for split in SPLITS:
        lines = jsonl.parse(jsonl.scan(spark, f"{path}/split={split}"), "text:string")
        splits.append(lines.select(F.lit(split).alias("split"), F.col("example_index").alias("place"), "text"))
    return reduce(DataFrame.unionByName, splits)


def manifest_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per document source and language, all with the same name in folders of
    their own and as long as their number of documents, against a manifest made from the
    table: too large for languages that start with d, without those that start with f."""
    sizes = table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.count("*").alias("size"))
    path = staged_path(spark, "inventory")
    lines = sizes.withColumn("value", F.expr("repeat('x', cast(size - 1 AS int))")).select("source", "lang", "value")
    lines.repartition("source", "lang").write.partitionBy("source", "lang").text(path)
    files = manifest.inventory(spark, path, "part-*").select(
        F.regexp_replace("file", "/part-[^/]*$", "/part").alias("file"), "size"
    )
    known = sizes.filter(~F.startswith("lang", F.lit("f"))).select(
        F.format_string("source=%s/lang=%s/part", "source", "lang").alias("file"),
        (F.col("size") + F.startswith("lang", F.lit("d")).cast("int")).alias("size"),
    )
    return manifest.check(files, known).select("file", "actual_size", "expected_size", "status")


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy(F.col("source").alias("dataset_id")).agg(
        F.count("*").alias("n"), F.min("doc_id").alias("first_doc")
    )


def format_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats of the document sources: given, remembered, unknown or none."""
    sources = _sources(spark, sf_dir)
    kind = F.col("first_doc") % 4
    requests = sources.select(
        "dataset_id", F.when(kind == 0, F.lit(FLAT_CALLS)).when(kind == 1, F.lit("xml")).alias("explicit_format")
    )
    remembered = sources.filter(kind <= 2).select(
        X.short_hash(F.col("dataset_id")).alias("dataset_hash"), F.lit(REPLY_MESSAGES).alias("format")
    )
    return resolve_formats(requests, remembered).select(
        "dataset_id", "dataset_hash", "format", F.col("problem").isNull().alias("usable")
    )


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.concat_ws(":", F.col("n").cast("string"), F.col("first_doc").cast("string"))
    key = build.build_key(F.col("dataset_id"), F.lit(REPLY_MESSAGES), X.short_hash(F.lit("chatml")), digest)
    return _sources(spark, sf_dir).select("dataset_id", "first_doc", key.alias("build_key"))


def pending_builds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that still have to be built, when every second one has been."""
    requests = _requests(spark, sf_dir)
    built = requests.filter(F.col("first_doc") % 2 == 0)
    return build.pending(requests, built).select("dataset_id", "build_key")


def incremental_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents built as two formats of one dataset, then once more: the rows that the
    first run wrote, and how many requests each run built."""
    messages = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("example_index"),
        F.array(
            F.struct(F.lit("user").alias("role"), F.lit("?").alias("content"), F.lit(False).alias("train_on_turn")),
            F.struct(F.lit("assistant").alias("role"), F.coalesce("text", F.lit("")).alias("content"), (F.col("doc_id") % 2 == 0).alias("train_on_turn")),
        ).alias("messages"),
    )
    out, log = staged_path(spark, "builds"), staged_path(spark, "manifest")
    wanted = [build.Dataset("documents", name, messages, "d") for name in (FLAGGED_MESSAGES, REPLY_MESSAGES)]
    first = build.build_missing(spark, wanted, out, log).count()
    second = build.build_missing(spark, wanted, out, log).count()
    built = build.read_built(spark, out, log)
    return built.select(
        "format", "example_index", "text", "split", F.lit(first).alias("built_first"), F.lit(second).alias("built_again")
    )


def build_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dataset in two versions, known by their content: the old one is built, then both are asked
    for together with another format; the rows under each request's key."""
    docs = table(spark, sf_dir, "documents")
    versions = {}
    for name, question in (("old", "?"), ("new", "!")):
        ask = F.struct(F.lit("user").alias("role"), F.lit(question).alias("content"))
        reply = F.struct(F.lit("assistant").alias("role"), F.coalesce("text", F.lit("")).alias("content"))
        rows = docs.select(F.col("doc_id").alias("example_index"), F.array(ask, reply).alias("messages"))
        versions[name] = build.Dataset.of("documents", REPLY_MESSAGES, rows)
    out, log = staged_path(spark, "builds"), staged_path(spark, "manifest")
    build.build_missing(spark, [versions["old"]], out, log)
    flagged = build.Dataset("documents", FLAGGED_MESSAGES, versions["new"].rows, versions["new"].digest)
    second = build.build_missing(spark, [versions["new"], versions["old"], flagged, versions["new"]], out, log).count()
    asked = [(name, d.dataset_id, d.format_name, d.digest) for name, d in versions.items()]
    requests = spark.createDataFrame(asked, "version string, dataset_id string, format string, digest string")
    key = build.build_key(F.col("dataset_id"), F.col("format"), CHATML.key(), F.col("digest"))
    keys = requests.select("version", key.alias("build_key"))
    built = build.read_built(spark, out, log).join(F.broadcast(keys), "build_key", "left")
    return built.select("version", "format", "example_index", "split", "text", F.lit(second).alias("built_second"))


def content_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of the documents of each source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    return build.content_digest(docs, "source")


def short_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", X.short_hash(F.col("p_name")).alias("name_hash"))


def build_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    template = X.short_hash(F.lit("chatml"))
    dataset, model = F.col("p_name"), F.col("p_brand")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        build.data_key(dataset, template).alias("data_key"),
        build.adapter_key(model, dataset, template).alias("adapter_key"),
        build.evaluation_key(model, dataset, F.col("p_partkey").cast("string")).alias("evaluation_key"),
    )


def variant_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model names in several shapes, with and without a parameter count."""
    size = F.col("p_size").cast("string")
    base = F.replace("p_name", F.lit(" "), F.lit("-"))
    shape = F.col("p_partkey") % 4
    model = (
        F.when(shape == 0, F.concat(base, F.lit("-"), size, F.lit("b-Instruct")))
        .when(shape == 1, F.concat(base, F.lit("_-"), size, F.lit(".5B")))
        .when(shape == 2, F.concat(base, size, F.lit("M")))
        .otherwise(base)
    )
    return table(spark, sf_dir, "part").select("p_partkey", X.variant_name(model, F.lit("Home")).alias("variant"))


def percent_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", "quality", X.percent(F.col("doc_id") / 1024).alias("shown"))




QUERIES = {
    "file_index": file_index,
    "raw_json_rows": raw_json_rows,
    "jsonl_scan": jsonl_scan,
    "jsonl_messages": jsonl_messages,
    "jsonl_splits": jsonl_splits,
    "jsonl_types": jsonl_types,
    "jsonl_flat_types": jsonl_flat_types,
    "line_count": line_count,
    "split_files": split_files,
    "manifest_check": manifest_check,
    "format_resolve": format_resolve,
    "pending_builds": pending_builds,
    "incremental_build": incremental_build,
    "build_versions": build_versions,
    "content_digest": content_digest,
    "short_hash": short_hash,
    "build_keys": build_keys,
    "variant_name": variant_name,
    "percent_rates": percent_rates,
}

_SOURCES = """
WITH sources AS (
  SELECT source AS dataset_id, count(*) AS n, min(doc_id) AS first_doc FROM documents GROUP BY source)
"""

_LINES = """
WITH lines AS (
  SELECT doc_id, doc_id % 6 AS kind, doc_id % 6 = 4 AS broken,
         row_number() OVER (ORDER BY doc_id) - 1 AS example_index, count(*) OVER () AS total,
         CASE WHEN doc_id % 6 = 3 THEN '[note] __end_of_value ' ELSE '' END || coalesce(text, '') AS content
  FROM documents)
"""

ORACLE = {
    "file_index": """
        SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS example_index FROM documents""",
    "raw_json_rows": """
        SELECT conv_id, turn,
               CAST(to_json({'conv_id': conv_id, 'turn': turn, 'role': role, 'text': text}) AS VARCHAR) AS raw
        FROM conversations""",
    "jsonl_scan": """
        SELECT CAST(row_number() OVER (ORDER BY conv_id, turn) - 1 AS BIGINT) AS example_index,
               conv_id, turn, role, text
        FROM conversations""",
    "line_count": "SELECT CAST(count(*) AS BIGINT) AS lines FROM conversations",
    "jsonl_messages": _LINES
    + """SELECT CAST(example_index AS BIGINT) AS example_index, broken,
                CASE WHEN NOT broken THEN 'user: ' || content || chr(10) || 'assistant: ok' END AS conversation
         FROM lines""",
    "jsonl_splits": _LINES
    + """SELECT CAST(example_index AS BIGINT) AS example_index,
                CASE WHEN example_index * 10 < total * 8 THEN 'train'
                     WHEN example_index * 10 < total * 9 THEN 'valid' ELSE 'test' END AS split,
                '<|im_start|>user' || chr(10) || content || '<|im_end|>' || chr(10)
                || '<|im_start|>assistant' || chr(10) || 'ok<|im_end|>' || chr(10) AS text
         FROM lines WHERE NOT broken""",
    "jsonl_types": """
        WITH docs AS (
          SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS example_index, coalesce(text, '') AS text
          FROM documents),
        judged AS (
          SELECT *, CASE WHEN doc_id % 17 = 3 THEN 'Missing ''messages'' field'
                         WHEN doc_id % 13 IN (5, 7) THEN '''messages'' must be a list'
                         WHEN doc_id % 11 IN (3, 4, 5, 6, 7, 8) THEN 'Message 1 missing ''role'''
                         WHEN doc_id % 11 = 9 THEN 'Message 1 has unsupported role: clown'
                         WHEN doc_id % 11 = 10 THEN 'Message 1 has unsupported role: 7' END AS reason
          FROM docs)
        SELECT example_index, reason, CASE WHEN reason IS NULL
                 THEN '<|im_start|>assistant' || chr(10) || text || '<|im_end|>' || chr(10) END AS text
        FROM judged WHERE reason IS NOT NULL OR doc_id % 16 IN (0, 3, 5, 7, 8, 10, 13, 14, 15)""",
    "jsonl_flat_types": """
        WITH docs AS (
          SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS example_index, coalesce(text, '') AS text
          FROM documents),
        judged AS (
          SELECT *, CASE WHEN doc_id % 9 = 3 THEN 'Missing required field: ''tools'''
                         WHEN doc_id % 8 NOT IN (0, 1, 5) THEN '''tools'' must be a list'
                         WHEN doc_id % 5 IN (1, 2) THEN '''input'' must be a string' END AS reason
          FROM docs)
        SELECT example_index, reason, CASE WHEN reason IS NULL THEN
                 CASE doc_id % 8 WHEN 0 THEN '' ELSE '<|im_start|>system' || chr(10) || '# Tools' || chr(10) || chr(10) || '<tools>' || chr(10)
                   || CASE doc_id % 8 WHEN 1 THEN '[{"name":"f"}]' ELSE '["x"]' END || chr(10) || '</tools><|im_end|>' || chr(10) END
                 || '<|im_start|>system' || chr(10) || 'i<|im_end|>' || chr(10)
                 || '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) END AS prompt
        FROM judged""",
    "split_files": """
        WITH ranked AS (
          SELECT conv_id, row_number() OVER (ORDER BY conv_id) - 1 AS i, count(*) OVER () AS total
          FROM (SELECT DISTINCT conv_id FROM conversations)),
        texts AS (
          SELECT conv_id, turn, role, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '')
                   OVER (PARTITION BY conv_id ORDER BY turn) AS text
          FROM conversations),
        placed AS (
          SELECT CASE WHEN i * 10 < total * 8 THEN 'train' WHEN i * 10 < total * 9 THEN 'valid' ELSE 'test' END AS split, i, turn, text
          FROM texts JOIN ranked USING (conv_id) WHERE role = 'assistant')
        SELECT split, CAST(row_number() OVER (PARTITION BY split ORDER BY i, turn) - 1 AS BIGINT) AS place, text FROM placed""",
    "manifest_check": """
        SELECT 'source=' || source || '/lang=' || lang || '/part' AS file, CAST(count(*) AS BIGINT) AS actual_size,
               CAST(CASE WHEN lang NOT LIKE 'f%' THEN count(*) + CASE WHEN lang LIKE 'd%' THEN 1 ELSE 0 END END AS BIGINT) AS expected_size,
               CASE WHEN lang LIKE 'f%' THEN 'unexpected' WHEN lang LIKE 'd%' THEN 'wrong size' ELSE 'ok' END AS status
        FROM documents GROUP BY source, lang""",
    "format_resolve": _SOURCES
    + """SELECT dataset_id, sha256(dataset_id)[1:12] AS dataset_hash,
                CASE first_doc % 4 WHEN 0 THEN 'allenporter-fc' WHEN 1 THEN 'xml'
                                   WHEN 2 THEN 'allenporter-msg' END AS format,
                first_doc % 4 IN (0, 2) AS usable
         FROM sources""",
    "incremental_build": """
        SELECT f.format, doc_id AS example_index,
               '<|im_start|>user' || chr(10) || '?<|im_end|>' || chr(10)
               || '<|im_start|>assistant' || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS text,
               CASE WHEN doc_id * 10 < total * 8 THEN 'train' WHEN doc_id * 10 < total * 9 THEN 'valid' ELSE 'test' END AS split,
               2 AS built_first, 0 AS built_again
        FROM (SELECT *, count(*) OVER () AS total FROM documents)
        CROSS JOIN (VALUES ('acon96-v2'), ('allenporter-msg')) f(format)
        WHERE doc_id % 2 = 0 OR f.format = 'allenporter-msg'""",
    "build_versions": """
        SELECT v.version, v.format, doc_id AS example_index,
               CASE WHEN doc_id * 10 < total * 8 THEN 'train' WHEN doc_id * 10 < total * 9 THEN 'valid' ELSE 'test' END AS split,
               '<|im_start|>user' || chr(10) || v.question || '<|im_end|>' || chr(10)
               || '<|im_start|>assistant' || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS text,
               2 AS built_second
        FROM (SELECT *, count(*) OVER () AS total FROM documents)
        CROSS JOIN (VALUES ('old', 'allenporter-msg', '?'), ('new', 'allenporter-msg', '!')) v(version, format, question)""",
    "content_digest": """
        WITH hashed AS (
          SELECT source, md5(CAST(to_json({'doc_id': doc_id, 'source': source, 'lang': lang, 'text': text}) AS VARCHAR)) AS h
          FROM documents),
        sums AS (
          SELECT source, count(*) AS rows, sum(CAST('0x' || h[1:16] AS UBIGINT)::HUGEINT) % 18446744073709551616 AS a,
                 sum(CAST('0x' || h[17:32] AS UBIGINT)::HUGEINT) % 18446744073709551616 AS b
          FROM hashed GROUP BY source)
        SELECT source, rows || '-' || format('{:016x}', a::UBIGINT) || format('{:016x}', b::UBIGINT) AS digest, rows FROM sums""",
    "pending_builds": _SOURCES
    + """SELECT dataset_id,
                sha256(dataset_id)[1:12] || '_' || sha256('chatml')[1:12] || '_'
                || sha256('allenporter-msg|' || n || ':' || first_doc || '|8-9')[1:12] AS build_key
         FROM sources WHERE first_doc % 2 = 1""",
    "short_hash": "SELECT p_partkey, sha256(p_name)[1:12] AS name_hash FROM part",
    "build_keys": """
        SELECT p_partkey,
               sha256(p_name)[1:12] || '_' || sha256('chatml')[1:12] AS data_key,
               p_brand || '_' || sha256(p_name)[1:12] || '_' || sha256('chatml')[1:12] AS adapter_key,
               p_brand || '_' || sha256(p_name)[1:12] || '_' || p_partkey AS evaluation_key
        FROM part""",
    "variant_name": r"""
        WITH models AS (
          SELECT p_partkey,
                 replace(p_name, ' ', '-') || CASE p_partkey % 4
                   WHEN 0 THEN '-' || p_size || 'b-Instruct' WHEN 1 THEN '_-' || p_size || '.5B'
                   WHEN 2 THEN p_size || 'M' ELSE '' END AS model
          FROM part)
        SELECT p_partkey,
               CASE WHEN regexp_matches(model, '\d+\.?\d*[bBmM]') THEN
                 rtrim(regexp_extract(model, '^(.*?)(\d+\.?\d*[bBmM].*)$', 1), '-_') || '-Home-'
                 || regexp_extract(model, '^(.*?)(\d+\.?\d*[bBmM].*)$', 2)
               ELSE model || '-Home' END AS variant
        FROM models""",
    "percent_rates": """
        SELECT doc_id, quality, printf('%.1f', doc_id / 1024 * 100.0) || '%' AS shown FROM labels""",
}
