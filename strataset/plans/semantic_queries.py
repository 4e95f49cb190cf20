"""Queries for the semantic extraction operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataset.functions.text import classify_element, element_name, inferred_type, variable_name
from strataset.operators import semantic
from strataset.plans import views
from strataset.plans.registry import query

# White space as RE2 spells it, and the line rules in SQL.
_WS = r"[\t-\r \x{85}\p{Z}]"
_TRIM = r"regexp_replace({x}, '^[\t-\r \x{{85}}\p{{Z}}]+|[\t-\r \x{{85}}\p{{Z}}]+$', '', 'g')"
_KIND = """CASE WHEN contains(line, 'fn ') THEN 'function' WHEN contains(line, 'struct ') THEN 'struct'
 WHEN contains(line, 'enum ') THEN 'enum' WHEN contains(line, 'impl ') THEN 'impl'
 WHEN contains(line, 'let ') THEN 'variable' WHEN contains(line, 'use ') THEN 'import'
 ELSE 'other' END"""
_TYPE = """CASE WHEN contains(line, 'String') THEN 'String' WHEN contains(line, 'i32') THEN 'i32'
 WHEN contains(line, 'bool') THEN 'bool' ELSE 'unknown' END"""


def _tail(mark: str) -> str:
    return f"substr(line, strpos(line, '{mark}') + {len(mark)})"


def _name(*rules: tuple[str, str]) -> str:
    cases = []
    for mark, end in rules:
        tail = _tail(mark)
        cut = f"substr({tail}, 1, strpos({tail}, '{end}') - 1)"
        cases.append(
            f"WHEN strpos(line, '{mark}') > 0 AND strpos({tail}, '{end}') > 0 "
            f"THEN {_TRIM.format(x=cut)}"
        )
    return "CASE " + " ".join(cases) + " ELSE NULL END"


_ELEMENT_NAME = _name(("fn ", "("), ("struct ", " "))
_VARIABLE = _name(("let ", "="), ("let ", ":"))
_IN_NAMES = "(contains(line, 'fn ') OR contains(line, 'struct ') OR contains(line, 'enum '))"
_IN_TYPES = "(contains(line, 'let ') OR contains(line, '-> '))"
_NOT_BLANK = f"{_TRIM.format(x='line')} <> ''"
_PHASED = f"""phased AS (
  SELECT file_path, line_no, line, 'parsing' AS phase, 1 AS rank FROM corpus_lines WHERE {_NOT_BLANK}
  UNION ALL SELECT file_path, line_no, line, 'name_resolution', 2 FROM corpus_lines WHERE {_IN_NAMES}
  UNION ALL SELECT file_path, line_no, line, 'type_inference', 3 FROM corpus_lines WHERE {_IN_TYPES})"""
ALL_PHASES = "parsing, name_resolution, type_inference, hover"


def records(spark, sf_dir, phases=ALL_PHASES, context=False):
    return semantic.run_phases(views.corpus_lines(spark, sf_dir, context), phases)


@query("explode_lines", f"""
    WITH {views.CORPUS_LINES}
    SELECT file_path, line_no, line FROM corpus_lines""")
def explode_lines(spark, sf_dir):
    return views.corpus_lines(spark, sf_dir)


@query("line_context", f"""
    WITH {views.CORPUS_LINES}
    SELECT file_path, line_no,
           lag(line) OVER w AS context_before, lead(line) OVER w AS context_after
    FROM corpus_lines WINDOW w AS (PARTITION BY file_path ORDER BY line_no)""")
def line_context(spark, sf_dir):
    lines = semantic.explode_lines(views.corpus_files(spark, sf_dir))
    return semantic.line_context(lines).select(
        "file_path", "line_no", "context_before", "context_after"
    )


@query("parsing_records", f"""
    WITH {views.CORPUS_LINES},
    near AS (SELECT *, lag(line) OVER w AS context_before, lead(line) OVER w AS context_after
             FROM corpus_lines WINDOW w AS (PARTITION BY file_path ORDER BY line_no))
    SELECT concat(file_path, ':', line_no, ':parsing') AS id, file_path, line_no AS line,
           CAST(1 AS BIGINT) AS "column", 'parsing' AS phase, {_KIND} AS element_type,
           {_ELEMENT_NAME} AS element_name, line AS source_snippet,
           context_before, context_after, CAST(1 AS BIGINT) AS processing_time_ms
    FROM near WHERE {_NOT_BLANK}""")
def parsing_records(spark, sf_dir):
    return semantic.parsing_records(views.corpus_lines(spark, sf_dir, context=True)).select(
        "id", "file_path", "line", "column", "phase", "element_type", "element_name",
        "source_snippet", "context_before", "context_after", "processing_time_ms",
    )


@query("classify_element", f"""
    WITH {views.CORPUS_LINES}
    SELECT {_KIND} AS element_type, count(*) AS lines FROM corpus_lines GROUP BY 1""")
def classify(spark, sf_dir):
    return (
        views.corpus_lines(spark, sf_dir)
        .groupBy(classify_element(F.col("line")).alias("element_type"))
        .agg(F.count(F.lit(1)).alias("lines"))
    )


@query("element_name", f"""
    WITH {views.CORPUS_LINES}
    SELECT file_path, line_no, {_ELEMENT_NAME} AS element_name FROM corpus_lines""")
def names(spark, sf_dir):
    return views.corpus_lines(spark, sf_dir).select(
        "file_path", "line_no", element_name(F.col("line")).alias("element_name")
    )


@query("name_resolution_records", f"""
    WITH {views.CORPUS_LINES}
    SELECT concat(file_path, ':', line_no, ':name_resolution') AS id, file_path, line_no AS line,
           {_KIND} AS element_type, {_ELEMENT_NAME} AS element_name,
           {_TRIM.format(x='line')} AS element_signature, {_KIND} AS symbol_kind,
           'public' AS visibility, line AS source_snippet, CAST(NULL AS VARCHAR) AS context_before
    FROM corpus_lines WHERE {_IN_NAMES}""")
def name_resolution_records(spark, sf_dir):
    found = semantic.name_resolution_records(views.corpus_lines(spark, sf_dir, context=True))
    return found.select(
        "id", "file_path", "line", "element_type", "element_name", "element_signature",
        F.get_json_object("symbol_data", "$.symbol_kind").alias("symbol_kind"),
        F.get_json_object("symbol_data", "$.visibility").alias("visibility"),
        "source_snippet", "context_before",
    )


@query("type_inference_records", f"""
    WITH {views.CORPUS_LINES}
    SELECT concat(file_path, ':', line_no, ':type_inference') AS id, file_path, line_no AS line,
           'variable_or_return' AS element_type, {_VARIABLE} AS element_name,
           {_TYPE} AS inferred_type, CAST(0.95 AS DOUBLE) AS confidence, line AS source_snippet
    FROM corpus_lines WHERE {_IN_TYPES}""")
def type_inference_records(spark, sf_dir):
    found = semantic.type_inference_records(views.corpus_lines(spark, sf_dir))
    return found.select(
        "id", "file_path", "line", "element_type", "element_name",
        F.get_json_object("type_data", "$.inferred_type").alias("inferred_type"),
        F.get_json_object("type_data", "$.confidence").cast("double").alias("confidence"),
        "source_snippet",
    )


@query("variable_name", f"""
    WITH {views.CORPUS_LINES}
    SELECT file_path, line_no, {_VARIABLE} AS variable_name FROM corpus_lines""")
def variables(spark, sf_dir):
    return views.corpus_lines(spark, sf_dir).select(
        "file_path", "line_no", variable_name(F.col("line")).alias("variable_name")
    )


@query("inferred_type", f"""
    WITH {views.CORPUS_LINES}
    SELECT {_TYPE} AS inferred_type, count(*) AS lines FROM corpus_lines GROUP BY 1""")
def types(spark, sf_dir):
    return (
        views.corpus_lines(spark, sf_dir)
        .groupBy(inferred_type(F.col("line")).alias("inferred_type"))
        .agg(F.count(F.lit(1)).alias("lines"))
    )


@query("phase_json", f"""
    WITH {views.CORPUS_LINES}
    SELECT file_path, line_no, 'keyword' AS token_kind,
           regexp_extract(line, '^{_WS}*([^\\t-\\r \\x{{85}}\\p{{Z}}]*)', 1) AS token_text,
           CAST(0 AS BIGINT) AS token_start, CAST(strlen(line) AS BIGINT) AS token_end,
           {_KIND} AS ast_node_type
    FROM corpus_lines WHERE {_NOT_BLANK}""")
def phase_json(spark, sf_dir):
    parsed = F.from_json(
        "syntax_data",
        "tokens ARRAY<STRUCT<kind STRING, text STRING, start BIGINT, `end` BIGINT>>, "
        "ast_node_type STRING",
    )
    return (
        records(spark, sf_dir, "parsing")
        .select("file_path", F.col("line").alias("line_no"), parsed.alias("p"))
        .select(
            "file_path", "line_no",
            F.col("p.tokens")[0]["kind"].alias("token_kind"),
            F.col("p.tokens")[0]["text"].alias("token_text"),
            F.col("p.tokens")[0]["start"].alias("token_start"),
            F.col("p.tokens")[0]["end"].alias("token_end"),
            F.col("p.ast_node_type").alias("ast_node_type"),
        )
    )


def _ordered(spark, sf_dir, mode):
    found = semantic.ordered_records(
        views.located_files(spark, sf_dir), semantic.parse_phases(ALL_PHASES), mode=mode
    )
    return found.select("phase", "file_path", "line", "processing_order")


@query("processing_order", f"""
    WITH {views.CORPUS_LINES}, {_PHASED}
    SELECT phase, file_path, line_no AS line,
           row_number() OVER (ORDER BY rank, string_split(file_path, '/'), line_no)
             AS processing_order
    FROM phased""")
def processing_order(spark, sf_dir):
    return _ordered(spark, sf_dir, "phase_first")


@query("processing_order_by_file", f"""
    WITH {views.CORPUS_LINES}, {_PHASED}
    SELECT phase, file_path, line_no AS line,
           row_number() OVER (ORDER BY string_split(file_path, '/'), rank, line_no)
             AS processing_order
    FROM phased""")
def processing_order_by_file(spark, sf_dir):
    return _ordered(spark, sf_dir, "file_first")


@query("number_records", f"""
    WITH {views.CORPUS_LINES}, {_PHASED}
    SELECT phase, file_path, line_no AS line,
           row_number() OVER (ORDER BY rank, string_split(file_path, '/'), line_no)
             AS processing_order
    FROM phased""")
def number_records(spark, sf_dir):
    """The numbers given to records that exist already, here to their keys."""
    keys = records(spark, sf_dir).select("phase", "file_path", "line")
    return semantic.processing_order(keys)


@query("run_phases", f"""
    WITH {views.CORPUS_LINES}, {_PHASED}
    SELECT phase, count(*) AS records, count(DISTINCT file_path) AS files
    FROM phased GROUP BY phase""")
def run_phases(spark, sf_dir):
    return (
        records(spark, sf_dir)
        .groupBy("phase")
        .agg(F.count(F.lit(1)).alias("records"), F.countDistinct("file_path").alias("files"))
    )
