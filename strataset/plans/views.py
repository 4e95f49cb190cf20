"""The corpus the queries run on, derived from the benchmark tables.

Each view exists twice: as a DataFrame and as a SQL common table expression of the same name.
All of them are projections or map-side combined aggregates of the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataset.operators.semantic import LocatedFiles, explode_lines
from strataset.plans.registry import table
from strataset.session import spread

# Text expressions that both dialects read alike: one source file per part.
_CODE_PATH = """
concat('src/', lower(replace(p_brand, '#', '')), '/',
       CASE p_size % 5 WHEN 0 THEN 'tests/' WHEN 1 THEN 'examples/' WHEN 2 THEN 'benches/'
                       ELSE '' END,
       'm', CAST(p_partkey AS STRING), '.rs')
"""
_CODE_TEXT = """
concat(
  concat_ws(CASE WHEN p_size % 7 = 0 THEN concat(chr(13), chr(10)) ELSE chr(10) END,
    concat('use crate::m', CAST(p_partkey % 10 AS STRING), ';'),
    '',
    concat('// ', p_name, CASE WHEN p_size % 4 = 0 THEN ' see fn x' ELSE '' END),
    CASE WHEN p_size % 3 = 0 THEN concat('struct Unit', CAST(p_partkey AS STRING), ';')
         ELSE concat('pub struct S', CAST(p_partkey AS STRING), ' {') END,
    CASE WHEN p_size % 3 = 0 THEN '   ' ELSE '    id: i32,' END,
    CASE WHEN p_size % 3 = 0 THEN NULL ELSE '}' END,
    concat('impl S', CAST(p_partkey AS STRING), ' {'),
    concat('    pub fn f', CAST(p_partkey AS STRING), '(x: i32) -> bool {'),
    concat('        let mut v', CAST(p_size AS STRING), ': String = String::new();'),
    concat('        let w = g(', CAST(p_size AS STRING), ');'),
    CASE WHEN p_size % 2 = 0 THEN '        let z: u8;' ELSE '        let q;' END,
    concat('        x > ', CAST(p_size AS STRING)),
    '    }',
    '}',
    '',
    concat('enum E', CAST(p_partkey AS STRING), ' { A, B }'),
    CASE WHEN p_size % 6 = 0 THEN 'fn broken struct Foo {'
         ELSE concat('fn g', CAST(p_partkey AS STRING), '<T>(a: T) -> i32 { 0 }') END),
  CASE WHEN p_size % 4 = 0 THEN chr(10) ELSE '' END)
"""
_CODE_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_size"]
_DOC_PATH = "concat('docs/', lang, '/', source, '/', CAST(doc_id AS STRING), '.rs')"


def code_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_path, content): a source file per part."""
    return spread(table(spark, sf_dir, "part").select(*_CODE_COLUMNS)).selectExpr(
        f"{_CODE_PATH} AS file_path", f"{_CODE_TEXT} AS content"
    )


def doc_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_path, content): a file per document."""
    return table(spark, sf_dir, "documents").selectExpr(
        f"{_DOC_PATH} AS file_path", "text AS content"
    )


def corpus_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_files(spark, sf_dir).unionByName(doc_files(spark, sf_dir))


def located_files(spark: SparkSession, sf_dir: str) -> list[LocatedFiles]:
    """The same files, to be read again where they lie."""
    return [
        LocatedFiles(
            spark, f"{sf_dir}/part.parquet", _CODE_COLUMNS, _CODE_PATH, _CODE_TEXT, narrow=True
        ),
        LocatedFiles(
            spark, f"{sf_dir}/documents.parquet", ["doc_id", "lang", "source", "text"], _DOC_PATH, "text"
        ),
    ]


def code_lines(spark: SparkSession, sf_dir: str, context: bool = False) -> DataFrame:
    return explode_lines(code_files(spark, sf_dir), context=context)


def corpus_lines(spark: SparkSession, sf_dir: str, context: bool = False) -> DataFrame:
    return explode_lines(corpus_files(spark, sf_dir), context=context)


# The line views of the SQL side. A text splits at LF or CRLF; the element after a final line
# end is no line.
CODE_FILES = f"code_files AS (SELECT {_CODE_PATH} AS file_path, {_CODE_TEXT} AS content FROM part)"
DOC_FILES = f"doc_files AS (SELECT {_DOC_PATH} AS file_path, text AS content FROM documents)"
_LINES = """{name}_lines AS (
  SELECT file_path, line_no, a[line_no] AS line
  FROM (SELECT file_path, a, unnest(generate_series(1, n)) AS line_no
        FROM (SELECT file_path, a, len(a) - CASE WHEN a[len(a)] = '' THEN 1 ELSE 0 END AS n
              FROM (SELECT file_path, string_split_regex(content, '\\r?\\n') AS a
                    FROM {name}_files))))"""
CODE_LINES = f"{CODE_FILES}, {_LINES.format(name='code')}"
DOC_LINES = f"{DOC_FILES}, {_LINES.format(name='doc')}"
CORPUS_LINES = f"""{CODE_FILES}, {DOC_FILES},
corpus_files AS (SELECT * FROM code_files UNION ALL SELECT * FROM doc_files),
{_LINES.format(name='corpus')}"""

# Terms: the words of all documents. Both dialects read these expressions alike; first_doc and
# last_doc are the lowest and highest document holding the word.
_TERM_FIELDS = (
    "id",
    "id AS term",
    "n AS count",
    "CASE WHEN id >= 'a' AND id < '{' THEN 'word' WHEN id >= '0' AND id < ':' THEN 'number' "
    "ELSE 'symbol' END AS category",
    "CASE WHEN n > 10 THEN 'high' ELSE 'low' END AS significance",
    "CASE WHEN first_doc < last_doc THEN 'shared' ELSE 'local' END AS vibe",
    "CASE WHEN n = 1 THEN 'review' ELSE 'keep' END AS action_suggestion",
    "CASE WHEN n > 100 THEN '*' ELSE NULL END AS emoji_representation",
    "CASE WHEN first_doc = last_doc THEN 'application' ELSE NULL END AS osi_layer",
    "CASE WHEN n % 2 = 0 THEN CAST(2 AS BIGINT) WHEN n % 3 = 0 THEN CAST(3 AS BIGINT) "
    "ELSE NULL END AS prime_factor",
    "(n & (n - 1)) = 0 AS is_power_of_two",
    "concat('@', CAST(first_doc AS STRING)) AS numerical_address",
    "first_doc AS first_seen_timestamp",
    "last_doc AS last_seen_timestamp",
    "substr(id, 1, 1) AS character_group",
)


def raw_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per distinct lower-cased word, with all fields of a term document."""
    found = F.expr(r"regexp_extract_all(text, r'([^ \n\t.,|]+)', 1)")
    words = table(spark, sf_dir, "documents").select("doc_id", F.explode(found).alias("word"))
    counted = words.groupBy(F.lower("word").alias("id")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("doc_id").alias("first_doc"),
        F.max("doc_id").alias("last_doc"),
    )
    return counted.selectExpr(
        *_TERM_FIELDS,
        "CASE WHEN n > 1 THEN array(concat('d', first_doc), id) ELSE NULL END AS semantic_names",
        "array(CAST(n AS DOUBLE), CAST(first_doc AS DOUBLE)) AS embedding_vectors",
        "array('v1') AS versions",
    )


TERMS = f"""words AS (
  SELECT doc_id, lower(w) AS id
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '([^ \\n\\t.,|]+)', 1)) AS w
        FROM documents)),
counted AS (
  SELECT id, count(*) AS n, min(doc_id) AS first_doc, max(doc_id) AS last_doc
  FROM words GROUP BY id),
terms AS (
  SELECT {", ".join(_TERM_FIELDS)},
         CASE WHEN n > 1 THEN [concat('d', first_doc), id] ELSE NULL END AS semantic_names FROM counted),
split_terms AS (
  SELECT *, CASE WHEN regexp_matches(character_group, '^[A-Za-z]') THEN 'train'
                 WHEN regexp_matches(character_group, '^[0-9]') THEN 'validation'
                 ELSE 'test' END AS split FROM terms)"""

# Projects: manifests and build scripts per part, packages per order, dependencies per line item,
# registry and repository snapshots per customer and supplier, commits per event.
_MANIFEST = r"""
concat_ws(chr(10),
  CASE WHEN p_size % 10 = 0
       THEN concat('[workspace]', chr(10), 'members = ["core", "m', CAST(p_partkey AS STRING), '"]')
       ELSE NULL END,
  CASE WHEN p_size % 25 = 24 THEN NULL ELSE concat('[package]', chr(10),
       'name = "crate', CAST(p_partkey AS STRING), '"') END,
  CASE WHEN p_size % 25 = 24 OR p_size % 4 = 1 THEN NULL
       ELSE concat('version = "0.', CAST(p_size AS STRING), '.1"') END,
  CASE WHEN p_size % 25 = 24 THEN NULL ELSE concat('description = "', p_name, '"', chr(10),
       'authors = ["a', CAST(p_partkey % 7 AS STRING), '", "b"]', chr(10), 'license = "MIT"') END,
  CASE WHEN p_size % 6 = 0
       THEN concat('[features]', chr(10), 'std = []', chr(10), 'default = ["std"]')
       ELSE NULL END,
  CASE WHEN p_size % 3 = 0 THEN concat('[lib]', chr(10), 'path = "src/lib.rs"')
       WHEN p_size % 3 = 1 THEN concat('[[bin]]', chr(10), 'name = "main"')
       ELSE NULL END)
"""
_CRATE = "concat('crates/', lower(replace(p_brand, '#', '')), '/c', CAST(p_partkey AS STRING))"
_SCRIPT = """
concat('fn main() {', chr(10), repeat(concat('    run();', chr(10)), p_size % 4), '}', chr(10))
"""
_REPOSITORY = """
concat(CASE WHEN o_orderkey % 5 = 0 THEN 'https://gitlab.com/org' ELSE 'https://github.com/org' END,
       CAST(o_custkey % 20 AS STRING), '/r', CAST(o_custkey % 150 AS STRING),
       CASE o_orderkey % 4 WHEN 0 THEN '.git' WHEN 1 THEN '/' WHEN 2 THEN '.git/' ELSE '' END)
"""
_PKG_FIELDS = (
    "o_orderkey AS pkg_id",
    "concat('pkg', CAST(o_custkey AS STRING)) AS name",
    "concat('0.', CAST(o_custkey % 7 AS STRING), '.', CAST(o_orderkey % 11 AS STRING)) AS version",
    f"CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE {_REPOSITORY} END AS repository",
)
_DECL_FIELDS = (
    "l_orderkey AS pkg_id",
    "l_linenumber AS dep_ord",
    "concat('part', CAST(l_partkey % 50 AS STRING)) AS dep_name",
    "CASE l_returnflag WHEN 'A' THEN 'dev' WHEN 'R' THEN 'build' ELSE 'normal' END AS kind",
    "concat('^1.', CAST(l_suppkey % 5 AS STRING)) AS version_req",
    "l_linestatus = 'O' AS optional",
    "l_tax > 0.02 AS default_features",
    "CASE WHEN l_linestatus = 'F' THEN 'registry' ELSE NULL END AS source",
)
_EDGE_FIELDS = (
    "l_orderkey AS pkg_id",
    "l_linenumber AS edge_ord",
    "l_partkey AS dep_pkg_id",
    "concat('part', CAST(l_partkey % 50 AS STRING)) AS dep_pkg_name",
    "concat('1.', CAST(l_suppkey % 5 AS STRING), '.0') AS dep_version",
)
_REGISTRY_FIELDS = (
    "concat('pkg', CAST(c_custkey AS STRING)) AS name",
    "c_custkey * 10 + c_nationkey AS downloads",
)
_REPO_FIELDS = (
    "concat('org', CAST(s_suppkey % 20 AS STRING)) AS owner",
    "concat('r', CAST(s_suppkey AS STRING)) AS repo",
    "s_suppkey * 3 AS stars",
    "s_suppkey % 17 AS forks",
    "s_nationkey AS issues",
    "concat('2024-01-', lpad(CAST(s_suppkey % 28 + 1 AS STRING), 2, '0'), 'T06:30:00Z') "
    "AS updated_at",
)
_COMMIT_FIELDS = (
    "concat('proj', CAST(user_id % 20 AS STRING)) AS project",
    "event_id AS sha",
    "CASE WHEN event_type = 'error' THEN NULL ELSE concat('u', CAST(user_id AS STRING)) END "
    "AS author",
    "ts",
)
# Fixed value: the day the age of a project is measured at.
AS_OF = "2024-02-01 00:00:00"


def manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, content): a manifest per part, some of them workspaces, some without a package."""
    return table(spark, sf_dir, "part").selectExpr(
        f"concat({_CRATE}, '/Cargo.toml') AS path", f"{_MANIFEST} AS content"
    )


def script_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, content): the larger parts have a build script, so that projects differ in it."""
    return table(spark, sf_dir, "part").filter("p_size > 20").selectExpr(
        f"concat({_CRATE}, '/build.rs') AS path", f"{_SCRIPT} AS content"
    )


def pkgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*_PKG_FIELDS)


def decl_deps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        *_DECL_FIELDS,
        "CASE WHEN l_linenumber % 2 = 0 THEN array('std') ELSE array() END AS features",
    )


def resolve_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolved dependencies: small line items are declared and not resolved, so that both occur."""
    return table(spark, sf_dir, "lineitem").filter("l_quantity > 10").selectExpr(*_EDGE_FIELDS)


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*_REGISTRY_FIELDS)


def repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(*_REPO_FIELDS)


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*_COMMIT_FIELDS)


def _cte(name: str, fields: tuple[str, ...], source: str) -> str:
    return f"{name} AS (SELECT {', '.join(fields)} FROM {source})"


PKGS = _cte("pkgs", _PKG_FIELDS, "orders")
DECL_DEPS = _cte("decl_deps", _DECL_FIELDS, "lineitem")
RESOLVE_EDGES = _cte("resolve_edges", _EDGE_FIELDS, "lineitem WHERE l_quantity > 10")
REGISTRY = _cte("registry", _REGISTRY_FIELDS, "customer")
REPOS = _cte("repos", _REPO_FIELDS, "supplier")
COMMITS = _cte("commits", _COMMIT_FIELDS, "events")
# What the manifests say, written down from the parts directly rather than parsed.
MANIFESTS = f"""manifests AS (
  SELECT {_CRATE} AS project_path, concat('c', p_partkey) AS project_dir,
         p_size % 25 <> 24 AS has_package, p_size % 10 = 0 AS has_workspace,
         CASE WHEN p_size % 25 <> 24 THEN concat('crate', p_partkey) END AS name,
         CASE WHEN p_size % 25 <> 24 AND p_size % 4 <> 1 THEN concat('0.', p_size, '.1') END
           AS version,
         CASE WHEN p_size % 25 <> 24 THEN p_name END AS description,
         CASE WHEN p_size % 25 <> 24 THEN concat('["a', p_partkey % 7, '","b"]') END AS authors,
         CASE WHEN p_size % 25 <> 24 THEN 'MIT' END AS license,
         CASE WHEN p_size % 10 = 0 THEN concat('["core","m', p_partkey, '"]') END AS members,
         CASE WHEN p_size % 6 = 0 THEN '{{"default":["std"],"std":[]}}' END AS features,
         CASE WHEN p_size % 3 = 0 THEN '{{"path":"src/lib.rs"}}' END AS targets,
         p_size > 20 AS has_build_script,
         CASE WHEN p_size > 20 THEN CAST(p_size % 4 + 2 AS BIGINT) ELSE 0 END AS script_lines
  FROM part)"""

# IR records: one per part and level, the level taken from the order key.
_IR_EXTRA = (
    "concat('ir_gen:', construct_name, ':', optimization_level) AS id",
    "concat('src/', construct_name, '.rs') AS source_file",
    "'ir_generation' AS phase",
    "CAST(level + 1 AS BIGINT) AS processing_order",
    "concat('fn ', construct_name, '() {}') AS rust_source",
    "concat('define void @', construct_name, '()') AS llvm_ir",
    "'x86_64' AS target_architecture",
    "'1.0' AS extractor_version",
)


def ir(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey", F.expr("l_orderkey % 4").alias("level"))
        .agg(
            F.max("l_quantity").cast("int").alias("ir_instruction_count"),
            F.max("l_linenumber").alias("complexity_score"),
        )
        .selectExpr(
            "concat('part', CAST(l_partkey AS STRING)) AS construct_name",
            "concat('O', CAST(level AS STRING)) AS optimization_level",
            "level", "ir_instruction_count", "complexity_score",
        )
    )
    return counted.selectExpr("*", *_IR_EXTRA).drop("level")


IR = f"""ir_counted AS (
  SELECT concat('part', l_partkey) AS construct_name, concat('O', l_orderkey % 4)
           AS optimization_level, l_orderkey % 4 AS level,
         CAST(max(l_quantity) AS INTEGER) AS ir_instruction_count,
         CAST(max(l_linenumber) AS INTEGER) AS complexity_score
  FROM lineitem GROUP BY l_partkey, l_orderkey % 4),
ir AS (SELECT construct_name, optimization_level, ir_instruction_count, complexity_score,
              {", ".join(_IR_EXTRA)} FROM ir_counted)"""

# Catalog: documents as one dataset with a config per language and a split per source.
_SPLIT = "'documents' AS dataset, lang AS config, source AS split"


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dataset, config, split) of all splits, configs and the dataset, nulls above a level."""
    docs = table(spark, sf_dir, "documents")
    splits = docs.selectExpr(
        "'documents' AS dataset", "lang AS config", "source AS split"
    ).distinct()
    return splits.rollup("dataset", "config", "split").count().filter(
        "dataset IS NOT NULL"
    ).drop("count")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(kind, dataset, config, split, ok); splits without labels have no statistics response."""
    docs = table(spark, sf_dir, "documents").drop("text")
    labelled = docs.join(table(spark, sf_dir, "labels"), "doc_id")
    viewer = docs.groupBy("lang").agg((F.count(F.lit(1)) > 120).alias("ok")).selectExpr(
        "'config-has-viewer' AS kind", "'documents' AS dataset", "lang AS config",
        "CAST(NULL AS STRING) AS split", "ok",
    )
    fields = ("'documents' AS dataset", "lang AS config", "source AS split", "ok")
    preview = docs.groupBy("lang", "source").agg((F.max("n_chars") > 2000).alias("ok"))
    stats = labelled.groupBy("lang", "source").agg((F.max("quality") == 1).alias("ok"))
    return viewer.unionByName(
        preview.selectExpr("'split-has-preview' AS kind", *fields)
    ).unionByName(stats.selectExpr("'split-has-statistics' AS kind", *fields))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dataset, config, column, dtype): the longest language has no metadata, and a language
    whose shortest document has at most four characters has no text column."""
    sizes = table(spark, sf_dir, "documents").groupBy("lang").agg(
        F.min("n_chars").alias("shortest"), F.max("n_chars").alias("longest")
    ).filter("longest < 30000")
    return sizes.selectExpr(
        "'documents' AS dataset", "lang AS config",
        "inline(array_compact(array(named_struct('column', 'n_chars', 'dtype', 'int64'), "
        "CASE WHEN shortest > 4 THEN named_struct('column', 'text', 'dtype', 'string') END)))",
    )


def cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cached split results of the splits that have labels; toxic ones failed."""
    docs = table(spark, sf_dir, "documents").drop("text")
    labelled = docs.join(table(spark, sf_dir, "labels"), "doc_id")
    return labelled.groupBy("lang", "source").agg(
        F.when(F.max("toxic") == 1, 500).otherwise(200).alias("status"),
        F.lit(True).alias("viewer"),
        (F.max("n_chars") > 2000).alias("preview"),
        (F.min("n_chars") > 100).alias("search"),
        (F.count(F.lit(1)) > 3).alias("filter"),
        (F.max("quality") == 1).alias("statistics"),
    ).selectExpr(
        "'split-is-valid' AS kind", "'documents' AS dataset", "lang AS config",
        "source AS split", "status", "viewer", "preview", "search", "filter", "statistics",
    )


CATALOG = f"""entities AS (
  SELECT DISTINCT {_SPLIT} FROM documents
  UNION ALL SELECT DISTINCT 'documents', lang, NULL FROM documents
  UNION ALL SELECT 'documents', NULL, NULL),
labelled AS (SELECT d.lang, d.source, d.n_chars, l.quality, l.toxic
             FROM documents d JOIN labels l USING (doc_id)),
responses AS (
  SELECT 'config-has-viewer' AS kind, 'documents' AS dataset, lang AS config, NULL AS split,
         count(*) > 120 AS ok FROM documents GROUP BY lang
  UNION ALL SELECT 'split-has-preview', 'documents', lang, source, max(n_chars) > 2000
            FROM documents GROUP BY lang, source
  UNION ALL SELECT 'split-has-statistics', 'documents', lang, source, max(quality) = 1
            FROM labelled GROUP BY lang, source),
feature_sizes AS (SELECT lang, min(n_chars) AS shortest, max(n_chars) AS longest
                  FROM documents GROUP BY lang HAVING max(n_chars) < 30000),
features AS (
  SELECT 'documents' AS dataset, lang AS config, 'n_chars' AS "column", 'int64' AS dtype
  FROM feature_sizes
  UNION ALL SELECT 'documents', lang, 'text', 'string' FROM feature_sizes WHERE shortest > 4),
cached AS (
  SELECT 'split-is-valid' AS kind, {_SPLIT}, CASE WHEN max(toxic) = 1 THEN 500 ELSE 200 END
           AS status, true AS viewer, max(n_chars) > 2000 AS preview, min(n_chars) > 100 AS search,
         count(*) > 3 AS filter, max(quality) = 1 AS statistics
  FROM labelled GROUP BY lang, source)"""

# Published versions and requirements on them, of many forms.
_VERSION_FIELDS = (
    "concat('part', CAST(p_partkey % 50 AS STRING)) AS name",
    "p_size % 3 AS major", "p_partkey % 7 AS minor", "p_size % 11 AS patch",
    "CASE WHEN p_partkey % 4 = 0 THEN p_size % 5 ELSE 1000 END AS pre",
    "concat(CAST(p_size % 3 AS STRING), '.', CAST(p_partkey % 7 AS STRING), '.', CAST(p_size % 11 AS STRING), "
    "CASE WHEN p_partkey % 4 = 0 THEN concat('-rc.', CAST(p_size % 5 AS STRING)) "
    "WHEN p_partkey % 9 = 0 THEN concat('+b', CAST(p_size AS STRING)) ELSE '' END) AS version",
)
_A, _B, _C = "CAST(l_suppkey % 3 AS STRING)", "CAST(l_orderkey % 7 AS STRING)", "CAST(l_linenumber AS STRING)"
_REQUIREMENT_FIELDS = (
    "l_orderkey AS pkg_id", "l_linenumber AS dep_ord",
    "concat('part', CAST(l_partkey % 50 AS STRING)) AS dep_name",
    "(l_orderkey + l_linenumber) % 10 AS form", "l_suppkey % 3 AS a", "l_orderkey % 7 AS b", "l_linenumber AS c",
    f"CASE (l_orderkey + l_linenumber) % 10 WHEN 0 THEN concat('^', {_A}, '.', {_B}, '.', {_C}) "
    f"WHEN 1 THEN concat('~', {_A}, '.', {_B}) WHEN 2 THEN concat({_A}, '.*') WHEN 3 THEN '*' "
    f"WHEN 4 THEN concat('>=', {_A}, '.', {_B}, ', <', CAST(l_suppkey % 3 + 1 AS STRING)) "
    f"WHEN 5 THEN concat('= ', {_A}, '.', {_B}, '.', {_C}) WHEN 6 THEN concat({_A}, '.', {_B}, '.', {_C}, '-rc.2') "
    f"WHEN 7 THEN concat('>', {_A}, '.', {_B}) WHEN 8 THEN concat('<=', {_A}, '.', {_B}) ELSE 'latest' END AS version_req",
)
VERSIONS = _cte("versions", _VERSION_FIELDS, "part")
REQUIREMENTS = _cte("requirements", _REQUIREMENT_FIELDS, "lineitem")

# A graph over the parts: each needs those at a half and a third of its number; some point back.
_STEPS = (
    "SELECT CAST(p_partkey AS STRING) AS package, CAST(floor(p_partkey / 2.0) AS BIGINT) AS d FROM part "
    "UNION ALL SELECT CAST(p_partkey AS STRING), CAST(floor(p_partkey / 3.0) AS BIGINT) FROM part "
    "UNION ALL SELECT CAST(CAST(floor(p_partkey / 2.0) AS BIGINT) AS STRING), p_partkey FROM part WHERE p_size = 50"
)
_GRAPH = f"SELECT package, CAST(d AS STRING) AS dependency FROM ({_STEPS}) WHERE d > 0 AND package <> '0'"
GRAPH = f"graph AS ({_GRAPH})"

# Snapshots of projects as they were taken, in turn of the events of one type.
_SNAPSHOT_FIELDS = (
    "concat('proj', CAST(user_id % 20 AS STRING)) AS project", "ts AS taken_at", "event_id AS stars",
    "CAST(floor(value) AS BIGINT) AS issues",
)


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*_VERSION_FIELDS)


def requirements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*_REQUIREMENT_FIELDS)


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, key = table(spark, sf_dir, "part"), F.col("p_partkey").cast("string")
    half, third = (F.expr(f"CAST(floor(p_partkey / {n}.0) AS BIGINT)") for n in (2, 3))
    edges = (
        part.select(key.alias("package"), half.alias("d"))
        .unionByName(part.select(key.alias("package"), third.alias("d")))
        .unionByName(part.filter("p_size = 50").select(half.cast("string").alias("package"), F.col("p_partkey").alias("d")))
    )
    return edges.filter("d > 0 AND package <> '0'").select("package", F.col("d").cast("string").alias("dependency"))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").filter("event_type = 'purchase'").selectExpr(*_SNAPSHOT_FIELDS)
