"""The queries of the operators in this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op3_simhash_near_dedup(spark, sf_dir):
    from strataset.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


ORACLES["op5_embedding_near_dedup"] = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding::DOUBLE[], lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (
  SELECT vec_id AS node, vec_id AS root FROM vectors
  UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node),
roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, coalesce(r.root, e.vec_id) AS component_id,
       e.vec_id = coalesce(r.root, e.vec_id) AS kept
FROM embeddings e LEFT JOIN counts c ON e.vec_id = c.a LEFT JOIN roots r ON e.vec_id = r.node
""".strip()


@query
def op5_embedding_near_dedup(spark, sf_dir):
    from strataset.llm.embeddings import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"),
    )


@query
def op7_sentencepiece(spark, sf_dir):
    from strataset.llm.pieces import encode

    return encode(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_ids", F.crc32("ids").alias("ids_crc32"),
        F.sha2("decoded", 256).alias("decoded_sha256"), "parity",
    )


@query
def op8_packing(spark, sf_dir):
    from strataset.llm.packing import packed_documents

    return packed_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


@query
def op9_language_id(spark, sf_dir):
    from strataset.llm import language

    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.filter(~language.held_out()))
    return language.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", language.held_out().alias("held_out"), "lang_pred", "score"
    )


@query
def op10_token_counts(spark, sf_dir):
    from strataset.llm.token_counts import section_tokens

    return section_tokens(table(spark, sf_dir, "documents"))


@query
def op1_html_extraction(spark, sf_dir):
    from strataset.llm import html

    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract(pages, html.fit(pages))


@query
def op2_sharding(spark, sf_dir):
    from strataset.llm.sharding import shards
    from strataset.llm.streams import text_bytes

    return shards(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", (text_bytes(F.col("text")) + 1).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op6_minhash_fingerprints(spark, sf_dir):
    from strataset.llm.minhash import fingerprints

    return fingerprints(table(spark, sf_dir, "documents"))


@query
def op4_suffix_dedup(spark, sf_dir):
    from strataset.llm.repeats import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op13_bpe_encoding(spark, sf_dir):
    from strataset.llm.bpe import encode

    return encode(table(spark, sf_dir, "documents")).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLES["op11_lexical_search"] = f"""
WITH words AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
postings AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM postings GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM sizes),
norms AS (SELECT doc_id, 50 + (50 * n * docs) // len AS m FROM sizes, totals),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM postings, totals GROUP BY term, docs),
asked AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN norms USING (doc_id)
  GROUP BY item_id, doc_id)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank
  FROM scores WHERE score > 0)
WHERE rank <= 50
""".strip()


@query
def op11_lexical_search(spark, sf_dir):
    from strataset.llm.lexical import search

    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _edit(cost: str, edit: str, line: str | None, state: str) -> str:
    said = f"{state}.r" if line is None else f"list_prepend({line}, {state}.r)"
    return f"{{'c': {state}.c + {cost}, 'a': '{edit}' || {state}.a, 'r': {said}}}"


def _least(options: list[str], more: str = "") -> str:
    return f"list_sort([{', '.join(options)}]{more})[1]"


def _row_options(state: int) -> str:
    """The cheapest edit of a row in one of the states 1 to 4 of `v`, what follows included."""
    keep = ({"s": 2, "u": 3}, {"u": 3}, {"a": 4}, {"u": 3})[state - 1]
    fill = 4 if state == 3 else 3
    role = "assistant" if fill == 4 else "user"
    renamed = _edit("3 + extra", "R", f"'{role}:' || text", f"v[{fill}]")
    kept = " ".join(f"WHEN '{i}' THEN [{_edit('extra', 'K', "role || ':' || text", f'v[{to}]')}]" for i, to in keep.items())
    more = f" || CASE WHEN fault IN (0, 3) THEN [{renamed}] ELSE [] END || CASE WHEN fault IN (0, 3) THEN CASE initial {kept} ELSE [] END ELSE [] END"
    return _least([_edit("4", "D", None, f"v[{state}]")], more)


_CRC_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
ORACLES["op12_conversation_repair"] = f"""
WITH RECURSIVE checks AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, k: {_CRC_STEP})) AS t),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM conversations),
kinds AS (
  SELECT k.*, xor(list_reduce([4294967295] || list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM keyed k, checks),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER w AS pos, lag(role[1:1]) OVER w || role[1:1] AS pair,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
    regexp_replace(text, '[\x20\x09-\x0D]', '', 'g') AS shown
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy)),
faults AS (
  SELECT conv_id, turn, role, text, pos, pair, role[1:1] AS initial,
    CASE WHEN shown = '' THEN 1 WHEN nth > 1 THEN 2 WHEN shown[-1:] NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault
  FROM placed),
known AS (
  SELECT c.conv_id, count(f.pos) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
    count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN faults f ON c.conv_id IS NOT DISTINCT FROM f.conv_id
  GROUP BY c.conv_id),
plans AS (
  SELECT conv_id, n + 1 AS pos, [
    {{'c': 0::BIGINT, 'a': '', 'r': []::VARCHAR[]}}, {{'c': 6, 'a': 'II', 'r': ['user:', 'assistant:']}},
    {{'c': 3, 'a': 'I', 'r': ['assistant:']}}, {{'c': 0, 'a': '', 'r': []::VARCHAR[]}}] AS v
  FROM known
  UNION ALL
  SELECT conv_id, pos, [{_least(["b[1]", _edit("3", "I", "'user:'", "f")])}, {_least(["b[2]", _edit("3", "I", "'user:'", "f")])},
    f, {_least(["b[4]", _edit("3", "I", "'user:'", "b[3]")])}]
  FROM (SELECT *, {_least(["b[3]", _edit("3", "I", "'assistant:'", "b[4]")])} AS f
    FROM (SELECT conv_id, pos, [{', '.join(_row_options(k) for k in (1, 2, 3, 4))}] AS b
      FROM (SELECT p.conv_id, f.pos, f.role, f.text, f.initial, f.fault, p.v, CASE WHEN f.fault = 3 THEN 3 ELSE 0 END AS extra
        FROM plans p JOIN faults f ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND f.pos = p.pos - 1))))
SELECT k.conv_id, gaps, blank, duplicate, truncated, illegal, v[1].c AS cost, v[1].a AS audit,
  sha256(array_to_string(v[1].r, chr(10))) AS repaired_sha256
FROM known k JOIN plans p ON k.conv_id IS NOT DISTINCT FROM p.conv_id AND p.pos = 1
""".strip()


@query
def op12_conversation_repair(spark, sf_dir):
    from strataset.llm.conversations import damage, repair

    rows = table(spark, sf_dir, "conversations")
    return repair(damage(rows), known=rows)
