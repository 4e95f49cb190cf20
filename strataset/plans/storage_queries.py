"""Queries for readers, writers, dataset reports, streaming and maintenance.

Writers go to a new folder below the shared one; what was written is read back and summed up.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from strataset.operators import deltas, maintenance, report, semantic, terms as term_ops, validate
from strataset.plans import project_queries as proj, semantic_queries as sem, views
from strataset.plans.registry import query, table
from strataset.plans.term_queries import split_terms, terms
from strataset.schemas import IR_LEVELS, IR_PHASES, RAW_TERM, SEMANTIC_RECORD, TERM_SPLITS
from strataset.session import hold, qualified, scratch_path, spread
from strataset.sinks import writers
from strataset.sources import files as readers
from strataset.sources.storage import open_store
from strataset.streaming.batches import batch_files, stream_phase_batches as stream_phase_batches_job

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of a stored file and files of a batch at least here, so that there are several batches.
ROWS_PER_FILE, FILES_PER_BATCH = 10_000, 3
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
_FILE_ROWS = "file_rows AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS t, '{t}.parquet' AS file_name, count(*) AS num_rows FROM {t}" for t in TABLES
) + ")"
_COLUMNS = f"""cols AS (
  SELECT concat(table_name, '.parquet') AS file_name, column_name, data_type, ordinal_position AS pos
  FROM information_schema.columns WHERE table_name IN {TABLES}),
shapes AS (SELECT file_name, CAST(count(*) AS INTEGER) AS num_columns,
                  string_agg(column_name, ',' ORDER BY pos) AS columns FROM cols GROUP BY 1),
file_info AS (SELECT r.file_name, r.file_name AS split_name, r.num_rows, s.num_columns, s.columns
              FROM file_rows r JOIN shapes s USING (file_name)),
file_flags AS (
  SELECT true AS viewer, bool_or(num_rows > 0) AS preview,
         bool_or(regexp_matches(columns, 'term|text|content')) AS search,
         bool_or(num_columns > 1) AS filter,
         bool_or(regexp_matches(columns, 'count|id|timestamp')) AS statistics FROM file_info)"""


def write_text_files(files: DataFrame, root: str) -> None:
    """Write each (path, content) row as a file of that name below `root`."""

    root = qualified(files.sparkSession, root)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(root)
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"].to_pylist()):
                target = f"{base}/{path}"
                store.create_dir(target.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(target) as out:
                    out.write(content.encode())
            yield pa.RecordBatch.from_pydict({"files": pa.array([batch.num_rows], pa.int64())})

    files.select("path", "content").mapInArrow(write, "files long").write.format("noop").mode(
        "overwrite"
    ).save()


# ---- readers ----


@query("scan_split_dataset", f"""
    WITH {_FILE_ROWS}
    SELECT file_name AS split_name, file_name, num_rows AS rows FROM file_rows""")
def scan_split_dataset(spark, sf_dir):
    rows = readers.scan_split_dataset(spark, sf_dir, merge_schema=True)
    return rows.groupBy("split_name", "file_name").agg(F.count(F.lit(1)).alias("rows"))


_TERM_DOC = (
    "c_name AS term", "c_custkey AS count", "lower(c_mktsegment) AS category",
    "'s' AS significance", "'v' AS vibe", "'a' AS action_suggestion",
)


@query("scan_term_json", f"""
    WITH docs AS (SELECT c_custkey, {", ".join(_TERM_DOC)} FROM customer)
    SELECT concat('t', c_custkey) AS id, term, count, category, significance, vibe,
           action_suggestion, CAST(NULL AS VARCHAR) AS osi_layer,
           CASE WHEN c_custkey % 2 = 0 THEN 2 ELSE 0 END AS names,
           substr(category, 1, 1) AS character_group, CAST(NULL AS VARCHAR) AS problem
    FROM docs WHERE c_custkey % 5 <> 0
    UNION ALL
    SELECT concat('t', c_custkey), NULL, NULL, NULL, NULL, NULL, NULL, NULL, 0,
           substr(category, 1, 1), 'not a term document'
    FROM docs WHERE c_custkey % 5 = 0""")
def scan_term_json(spark, sf_dir):
    """Every fifth document is cut off and cannot be read."""
    docs = spread(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")).selectExpr(
        "c_custkey", *_TERM_DOC,
        "CASE WHEN c_custkey % 2 = 0 THEN array(c_name, c_mktsegment) ELSE NULL END "
        "AS semantic_names",
    )
    fields = [c for c in docs.columns if c in RAW_TERM.names]
    path = F.concat(
        F.lit("terms/"), F.substring("category", 1, 1), F.lit("/t"), "c_custkey", F.lit(".json")
    )
    base = scratch_path(spark, "term-docs")
    text = F.to_json(F.struct(*fields))
    text = F.when(F.col("c_custkey") % 5 == 0, F.substring(text, 1, 9)).otherwise(text)
    write_text_files(docs.select(path.alias("path"), text.alias("content")), base)
    found = readers.scan_term_json(spark, base)
    return found.select(
        "id", "term", "count", "category", "significance", "vibe", "action_suggestion",
        "osi_layer", F.coalesce(F.size("semantic_names"), F.lit(0)).alias("names"),
        "character_group", "problem",
    ).withColumn("names", F.greatest("names", F.lit(0)))


@query("scan_source_files", f"""
    WITH {views.DOC_FILES}
    SELECT file_path, sha256(content) AS content_hash FROM doc_files""")
def scan_source_files(spark, sf_dir):
    """Documents as files, each with a copy below a directory that is skipped."""
    docs = views.doc_files(spark, sf_dir).withColumnRenamed("file_path", "path")
    hidden = docs.withColumn("path", F.concat(F.lit("target/"), "path"))
    root = scratch_path(spark, "sources")
    write_text_files(docs.unionByName(hidden), root)
    found = readers.scan_source_files(spark, root)
    below = F.substring_index("file_path", f"{root.rsplit('/', 1)[-1]}/", -1)
    return found.select(below.alias("file_path"), F.sha2("content", 256).alias("content_hash"))


@query("read_footer_stats", f"WITH {_FILE_ROWS} SELECT file_name, num_rows FROM file_rows")
def read_footer_stats(spark, sf_dir):
    return readers.read_footer_stats(spark, sf_dir).select("file_name", "num_rows")


def _stored_ir(spark, sf_dir):
    path = scratch_path(spark, "ir")
    writers.write_ir_parquet(views.ir(spark, sf_dir), path)
    return path


@query("load_phase", f"""
    WITH {views.IR}
    SELECT id, construct_name, llvm_ir, optimization_level FROM ir
    WHERE phase = 'ir_generation' AND optimization_level = 'O2'""")
def load_phase(spark, sf_dir):
    rows = readers.load_phase(spark, _stored_ir(spark, sf_dir), "ir_generation", "O2")
    return rows.select("id", "construct_name", "llvm_ir", "optimization_level")


_BY_PHASE = f"""
WITH {views.CORPUS_LINES}, {sem._PHASED}
SELECT phase, count(*) AS records, count(DISTINCT file_path) AS files FROM phased GROUP BY phase"""


def _by_phase(records):
    return records.groupBy("phase").agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct("file_path").alias("files")
    )


@query("scan_phase_json", f"""
    WITH {views.CORPUS_LINES}
    SELECT file_path, line_no AS line, {sem._ELEMENT_NAME} AS element_name,
           {sem._KIND} AS element_type
    FROM corpus_lines WHERE {sem._IN_NAMES}""")
def scan_phase_json(spark, sf_dir):
    path = scratch_path(spark, "phase-json")
    writers.write_grouped_json(sem.records(spark, sf_dir), "phase", path)
    rows = readers.scan_phase_json(spark, path)
    return rows.filter("phase = 'name_resolution'").select(
        "file_path", "line", "element_name", "element_type"
    )


# ---- writers ----


@query("write_phase_parquet", _BY_PHASE)
def write_phase_parquet(spark, sf_dir):
    path = scratch_path(spark, "phases")
    writers.write_phase_parquet(sem.records(spark, sf_dir), path)
    return _by_phase(spark.read.parquet(path))


@query("write_split_parquet", f"""
    WITH {views.TERMS}
    SELECT split, count(*) AS examples, CAST(sum(count) AS BIGINT) AS occurrences,
           true AS within_limit
    FROM split_terms GROUP BY split""")
def write_split_parquet(spark, sf_dir):
    path = scratch_path(spark, "splits")
    writers.write_split_parquet(split_terms(spark, sf_dir), path)
    per_file = spark.read.parquet(path).groupBy("split", "_metadata.file_path").agg(
        F.count(F.lit(1)).alias("n"), F.sum("count").alias("occurrences")
    )
    return per_file.groupBy("split").agg(
        F.sum("n").alias("examples"),
        F.sum("occurrences").alias("occurrences"),
        (F.max("n") <= writers.SPLIT_ROWS).alias("within_limit"),
    )


@query("chunk_plan", f"""
    WITH {views.TERMS}, placed AS (
      SELECT id, split, CAST((row_number() OVER (PARTITION BY split ORDER BY character_group, id)
                              - 1) // 10000 AS INTEGER) AS chunk,
             CAST(ceil(count(*) OVER (PARTITION BY split) / 10000.0) AS INTEGER) AS chunks
      FROM split_terms)
    SELECT id, split, chunk, chunks, printf('%s-%05d-of-%05d.parquet', split, chunk, chunks)
             AS file_name
    FROM placed""")
def chunk_plan(spark, sf_dir):
    rows = split_terms(spark, sf_dir).select("id", "character_group", "split")
    return writers.chunk_plan(rows, "split", [F.col("character_group"), F.col("id")]).drop(
        "character_group"
    )


@query("export_jsonl", f"""
    WITH {views.TERMS}
    SELECT count(*) AS exported, count(*) AS stored, CAST(sum(count) AS BIGINT) AS occurrences,
           count(*) FILTER (WHERE semantic_names IS NULL) AS without_names
    FROM terms""")
def export_jsonl(spark, sf_dir):
    path = scratch_path(spark, "jsonl")
    rows = terms(spark, sf_dir)
    exported = writers.export_jsonl(rows, path)
    return spark.read.schema(rows.schema).json(path).agg(
        F.lit(exported).cast("long").alias("exported"),
        F.count(F.lit(1)).alias("stored"),
        F.sum("count").alias("occurrences"),
        F.count_if(F.col("semantic_names").isNull()).alias("without_names"),
    )


@query("write_sample_jsonl", f"""
    WITH {views.TERMS}, ranked AS (
      SELECT character_group, id, row_number() OVER (PARTITION BY character_group ORDER BY id)
               AS rank, (SELECT count(DISTINCT character_group) FROM terms) AS groups
      FROM terms)
    SELECT character_group, count(*) AS terms, min(id) AS first_id, max(id) AS last_id
    FROM ranked WHERE rank <= greatest(1000 // groups, 1) GROUP BY character_group""")
def write_sample_jsonl(spark, sf_dir):
    path = scratch_path(spark, "sample-jsonl")
    rows = terms(spark, sf_dir)
    writers.write_sample_jsonl(rows, path)
    return spark.read.schema(rows.schema).json(path).groupBy("character_group").agg(
        F.count(F.lit(1)).alias("terms"), F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
    )


@query("write_grouped_json", _BY_PHASE)
def write_grouped_json(spark, sf_dir):
    path = scratch_path(spark, "grouped-json")
    writers.write_grouped_json(sem.records(spark, sf_dir), "phase", path)
    return _by_phase(readers.scan_phase_json(spark, path))


@query("write_report_json", f"""
    WITH {views.TERMS}
    SELECT count(DISTINCT character_group) AS groups, count(*) AS terms FROM terms""")
def write_report_json(spark, sf_dir):
    path = scratch_path(spark, "report")
    totals = term_ops.group_stats(terms(spark, sf_dir)).filter("character_group IS NULL")
    writers.write_report_json(totals.select("groups", "terms"), path)
    return spark.read.schema("groups long, terms long").option("multiLine", True).json(path)


@query("write_dataset_description", f"""
    WITH {views.TERMS}
    SELECT count(*) FILTER (WHERE split = 'train') AS train,
           count(*) FILTER (WHERE split = 'validation') AS validation,
           count(*) FILTER (WHERE split = 'test') AS test, count(*) * 200 AS dataset_size
    FROM split_terms""")
def write_dataset_description(spark, sf_dir):
    path = scratch_path(spark, "description")
    document = term_ops.dataset_description(terms(spark, sf_dir), "terms")
    writers.write_report_json(document, path)
    back = spark.read.schema(document.schema).option("multiLine", True).json(path)
    return back.select(
        *[F.col("splits")[s]["num_examples"].alias(s) for s in TERM_SPLITS], "dataset_size"
    )


@query("write_project_parquet", f"WITH {proj.PROJECT_RECORDS} {proj._RECORD_SUMS}")
def write_project_parquet(spark, sf_dir):
    path = scratch_path(spark, "projects")
    writers.write_project_parquet(proj.project_records(spark, sf_dir), path)
    return proj.record_sums(spark.read.parquet(path))


@query("write_ir_parquet", f"""
    WITH {views.IR}
    SELECT phase, optimization_level, count(*) AS records,
           CAST(sum(length(llvm_ir)) AS BIGINT) AS ir_length
    FROM ir GROUP BY 1, 2""")
def write_ir_parquet(spark, sf_dir):
    rows = spark.read.parquet(_stored_ir(spark, sf_dir))
    return rows.groupBy("phase", "optimization_level").agg(
        F.count(F.lit(1)).alias("records"), F.sum(F.length("llvm_ir")).alias("ir_length")
    )


# ---- reports ----


@query("parquet_file_info", f"WITH {_FILE_ROWS}, {_COLUMNS} SELECT * FROM file_info")
def parquet_file_info(spark, sf_dir):
    info = report.parquet_file_info(spark, sf_dir).drop("file_size_bytes", "fields")
    return info.withColumn("columns", F.array_join("columns", ","))


@query("schema_consistency", f"""
    WITH {_FILE_ROWS}, {_COLUMNS},
    expected AS (SELECT * FROM cols WHERE file_name = 'benchmark.parquet')
    SELECT c.file_name, CAST(count(*) AS INTEGER) AS num_columns, count(e.pos) AS matching,
           count(*) = count(e.pos) AND count(*) = (SELECT count(*) FROM expected) AS consistent
    FROM cols c LEFT JOIN expected e
      ON c.pos = e.pos AND c.column_name = e.column_name AND c.data_type = e.data_type
    GROUP BY c.file_name""")
def schema_consistency(spark, sf_dir):
    return report.schema_consistency(report.parquet_file_info(spark, sf_dir))


@query("group_by_split", f"""
    WITH {_FILE_ROWS}
    SELECT file_name AS split_name, CAST(1 AS BIGINT) AS num_files, num_rows FROM file_rows""")
def group_by_split(spark, sf_dir):
    return report.split_report(spark, sf_dir).drop("size_bytes")


@query("assess_capabilities", f"WITH {_FILE_ROWS}, {_COLUMNS} SELECT * FROM file_flags")
def assess_capabilities(spark, sf_dir):
    return validate.assess_capabilities(report.parquet_file_info(spark, sf_dir))


@query("dataset_report", f"""
    WITH {_FILE_ROWS}, {_COLUMNS}
    SELECT (SELECT count(*) FROM file_rows) AS total_files,
           (SELECT CAST(sum(num_rows) AS BIGINT) FROM file_rows) AS total_rows,
           (SELECT count(*) FROM file_rows) AS splits, false AS schema_consistency, *
    FROM file_flags""")
def dataset_report(spark, sf_dir):
    return report.dataset_report(spark, sf_dir).drop("dataset_name", "total_size_bytes")


@query("first_file_sample", """
    WITH sample AS (
      SELECT * FROM (SELECT *, row_number() OVER () - 1 AS row FROM benchmark) WHERE row < 5)
    SELECT row, 'item_id' AS "column", CAST(item_id AS VARCHAR) AS value FROM sample
    UNION ALL SELECT row, 'text', coalesce(text, 'null') FROM sample""")
def first_file_sample(spark, sf_dir):
    sample = report.first_file_sample(spark, sf_dir)
    return sample.select("row", F.explode("record").alias("column", "value"))


@query("phase_completeness", f"""
    WITH {views.IR},
    expected AS (SELECT p.phase, l.optimization_level
                 FROM (SELECT unnest({list(IR_PHASES)}) AS phase) p,
                      (SELECT unnest({list(IR_LEVELS)}) AS optimization_level) l),
    held AS (SELECT phase, optimization_level, count(*) AS n FROM ir GROUP BY 1, 2)
    SELECT e.phase, e.optimization_level, coalesce(h.n, 0) AS num_rows, h.n IS NOT NULL AS found
    FROM expected e LEFT JOIN held h
      ON e.phase = h.phase AND e.optimization_level = h.optimization_level""")
def phase_completeness(spark, sf_dir):
    keys = ["phase", "optimization_level"]
    expected = spark.createDataFrame([(p, lv) for p in IR_PHASES for lv in IR_LEVELS], keys)
    found = readers.read_footer_stats(spark, _stored_ir(spark, sf_dir), keys)
    return validate.phase_completeness(expected, found).select(*keys, "num_rows", "found")


# ---- streaming and maintenance ----


@query("stream_phase_batches", f"""
    WITH {views.CORPUS_LINES}
    SELECT {sem._KIND} AS element_type, count(*) AS records,
           CAST(sum(length(line)) AS BIGINT) AS characters
    FROM corpus_lines WHERE {sem._NOT_BLANK} GROUP BY 1""")
def stream_phase_batches(spark, sf_dir):
    stored, out = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    sem.records(spark, sf_dir, "parsing").write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(stored)
    run = _stream_phase(spark, stored, out)
    run.awaitTermination()
    return spark.read.parquet(out).groupBy("element_type").agg(
        F.count(F.lit(1)).alias("records"), F.sum("characters").alias("characters")
    )


def _stream_phase(spark: SparkSession, stored: str, out: str):
    return stream_phase_batches_job(
        spark, stored, SEMANTIC_RECORD, batch_files(spark, stored, FILES_PER_BATCH), f"{out}-checkpoint", out,
        lambda df: df.select(
            "id", "element_type", F.char_length("source_snippet").alias("characters")
        ),
    )


@query("incremental_extract", f"""
    WITH {views.DOC_FILES}, seen AS (
      SELECT concat('docs/', lang, '/', source, '/', d.doc_id, '.rs') AS file_path,
             sha256(CASE WHEN toxic = 1 THEN concat(text, ' old') ELSE text END) AS content_hash
      FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
    SELECT f.file_path, sha256(f.content) AS content_hash
    FROM doc_files f LEFT JOIN seen s
      ON f.file_path = s.file_path AND sha256(f.content) = s.content_hash
    WHERE s.file_path IS NULL""")
def incremental_extract(spark, sf_dir):
    """Labelled documents were seen before; the toxic ones have changed since."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    seen = docs.selectExpr(
        f"{views._DOC_PATH} AS file_path",
        "sha2(CASE WHEN toxic = 1 THEN concat(text, ' old') ELSE text END, 256) AS content_hash",
    )
    changed = maintenance.incremental_extract(views.doc_files(spark, sf_dir), seen)
    return changed.select("file_path", "content_hash")


@query("dedup_records", """
    SELECT min(doc_id) AS doc_id, CAST(length(text) AS INTEGER) AS characters
    FROM documents GROUP BY text""")
def dedup_records(spark, sf_dir):
    kept = maintenance.dedup_records(
        table(spark, sf_dir, "documents").select("doc_id", "text"), ["text"], ["doc_id"]
    )
    return kept.select("doc_id", F.length("text").alias("characters"))


@query("dedup_records_by_time", """
    SELECT min(event_id) AS event_id, ts FROM events GROUP BY ts""")
def dedup_records_by_time(spark, sf_dir):
    kept = maintenance.dedup_records(table(spark, sf_dir, "events"), ["ts"], ["event_id"])
    return kept.select("event_id", "ts")


@query("completeness_check", f"""
    WITH {views.CORPUS_LINES}, {sem._PHASED}
    SELECT f.file_path, p.phase
    FROM corpus_files f, (VALUES ('parsing'), ('name_resolution'), ('type_inference')) AS p(phase)
    WHERE NOT EXISTS (SELECT 1 FROM phased r
                      WHERE r.file_path = f.file_path AND r.phase = p.phase)""")
def completeness_check(spark, sf_dir):
    phases = ["parsing", "name_resolution", "type_inference"]
    return maintenance.completeness_check(
        views.corpus_files(spark, sf_dir), phases,
        semantic.phase_records(views.corpus_lines(spark, sf_dir), phases),
    )


# Earlier texts of the documents: those of toxic ones lacked their last line, those of poor quality had
# another first line, the others of the labelled ones were the same; ids below 0 have been deleted since.
_EARLIER = """CASE WHEN toxic = 1 THEN regexp_replace(text, concat(chr(10), '[^', chr(10), ']*$'), '')
  WHEN quality = 0 THEN concat('old first line', chr(10), text) ELSE text END"""
_GONE = "concat('docs/gone/', CAST(doc_id AS STRING), '.rs')"


def _earlier_files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    kept = docs.selectExpr(f"{views._DOC_PATH} AS file_path", f"{_EARLIER} AS content")
    return kept.unionByName(docs.filter("toxic = 1").selectExpr(f"{_GONE} AS file_path", "text AS content"))


_SPLIT = "CASE WHEN a[len(a)] = '' THEN a[:len(a) - 1] ELSE a END"
_LINE_DELTA = f"""{views.DOC_FILES}, earlier AS (
      SELECT {views._DOC_PATH} AS file_path, {_EARLIER} AS content
      FROM documents JOIN labels USING (doc_id)
      UNION ALL SELECT {_GONE}, text FROM documents JOIN labels USING (doc_id) WHERE toxic = 1),
    now_lines AS (SELECT file_path, content, {_SPLIT} AS n
                  FROM (SELECT *, string_split_regex(content, '\r?\n') AS a FROM doc_files)),
    old_lines AS (SELECT file_path, content, {_SPLIT} AS o
                  FROM (SELECT *, string_split_regex(content, '\r?\n') AS a FROM earlier)),
    delta AS (
      SELECT file_path, CASE WHEN o.content IS NULL THEN 'added' WHEN w.content IS NULL THEN 'deleted'
                             ELSE 'changed' END AS change,
             CASE WHEN w.content IS NOT NULL THEN list_filter(
               generate_series(1, greatest(len(n), coalesce(len(o), 0))), lambda i:
                 n[i] IS DISTINCT FROM o[i] OR n[i + 1] IS DISTINCT FROM o[i + 1]
                 OR (i > 1 AND n[i - 1] IS DISTINCT FROM o[i - 1])) END AS lines
      FROM now_lines w FULL JOIN old_lines o USING (file_path)
      WHERE w.content IS DISTINCT FROM o.content)"""


@query("line_delta", f"""
    WITH {_LINE_DELTA}
    SELECT file_path, change, CAST(len(lines) AS INTEGER) AS lines, CAST(list_sum(lines) AS BIGINT) AS numbers FROM delta""")
def line_delta(spark, sf_dir):
    state = deltas.file_state(_earlier_files(spark, sf_dir))
    found = deltas.line_delta(views.doc_files(spark, sf_dir), state)
    total = F.when(F.size("lines") > 0, F.aggregate("lines", F.lit(0).cast("long"), lambda a, b: a + b))
    return found.select(
        "file_path", "change", F.when(F.col("lines").isNotNull(), F.size("lines")).alias("lines"), total.alias("numbers")
    )


@query("apply_line_delta", f"""
    WITH {views.DOC_LINES}, corpus_lines AS (SELECT * FROM doc_lines), {sem._PHASED}
    SELECT concat(file_path, ':', line_no, ':', phase) AS id, file_path, line_no AS line, phase, line AS source_snippet
    FROM phased WHERE phase <> 'type_inference'""")
def apply_line_delta(spark, sf_dir):
    """The records of the earlier files, stored and brought up to date: those of a whole run."""
    phases, path = ["parsing", "name_resolution"], scratch_path(spark, "kept-records")
    earlier, files = _earlier_files(spark, sf_dir), views.doc_files(spark, sf_dir)
    deltas.write_bucketed(semantic.phase_records(semantic.explode_lines(earlier, context=True), phases), path)
    delta = hold(deltas.line_delta(files, deltas.file_state(earlier)), "line-delta")
    deltas.apply_delta(spark, path, delta, deltas.delta_records(files, delta, phases))
    return spark.read.parquet(path).select("id", "file_path", "line", "phase", "source_snippet")
