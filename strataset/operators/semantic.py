"""Semantic extraction: source files to lines to one typed record per line and phase."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from strataset.functions.names import unused
from strataset.functions.numbering import dense_position, running_totals
from strataset.functions.text import (
    classify_element,
    contains_any,
    element_name,
    is_blank,
    path_order,
    phase_json,
    utrim,
    variable_name,
)
from strataset.schemas import SEMANTIC_PHASES, SEMANTIC_RECORD
from strataset.session import hold, spread
from strataset.sources import planned


@dataclass(frozen=True)
class RunInfo:
    """What a run writes into each of its records; no timestamp means now."""

    timestamp: int | None = None
    rust_version: str = "unknown"
    analyzer_version: str = "unknown"


def line_array(content: Column) -> Column:
    """Lines of a text: LF or CRLF ends a line, a final line end opens no further line."""
    return F.split(content, "\r?\n", -1)


def line_count(content: Column) -> Column:
    """Number of lines of a text, counted without splitting it."""
    ends = F.octet_length(content) - F.octet_length(F.replace(content, F.lit("\n"), F.lit("")))
    open_end = (content != "") & ~content.endswith("\n")
    return ends.cast("long") + open_end.cast("long")


def explode_lines(
    files: DataFrame, path: str = "file_path", content: str = "content", context: bool = False
) -> DataFrame:
    """Files to (file_path, line_no, line); other columns are kept, those of the names that are made
    are replaced.

    With `context`, context_before and context_after are the neighbouring raw lines, looked up in
    the file's own array, which spares the shuffle a window would need.
    """
    made = {"file_path", "line_no", "line", *(("context_before", "context_after") if context else ())}
    kept = [c for c in files.columns if c not in {path, content, *made}]
    rest = [F.col("file_path"), *[F.col(f"`{c}`") for c in kept]]
    split, raw, at = unused([*files.columns, *made], "_split", "_lines", "_pos")
    arrays = files.select(
        F.col(f"`{path}`").alias("file_path"), *rest[1:], line_array(F.col(f"`{content}`")).alias(split)
    )
    lines = F.slice(split, F.lit(1), F.size(split) - (F.element_at(split, -1) == "").cast("int"))
    # The generators get an expression, not a column: from a column the optimizer infers a filter
    # on its size, which it pushes below the split, so that every text would be split again.
    if not context:
        exploded = arrays.select(*rest, F.posexplode(lines).alias(at, "line"))
        return exploded.select(*rest, (F.col(at) + 1).cast("long").alias("line_no"), "line")
    rows = F.transform(
        raw,
        lambda line, i: F.struct(
            (i + 1).cast("long").alias("line_no"),
            line.alias("line"),
            F.get(raw, i - 1).alias("context_before"),
            F.get(raw, i + 1).alias("context_after"),
        ),
    )
    return arrays.select(*rest, lines.alias(raw)).select(*rest, F.inline(rows))


def line_context(lines: DataFrame, block: int = 50_000) -> DataFrame:
    """Add context_before and context_after to lines that are already one row each.

    A file is cut into blocks of `block` lines, so that a huge file is not one window group; the
    line on either side of a block joins it as a rim row, which is dropped after the lookup.
    line_no must run from 1 without gaps. Other columns are kept, those of the names that are made are
    replaced.
    """
    block_no, rim = unused(lines.columns, "_block", "_rim")
    lines = lines.drop("context_before", "context_after")
    n = F.col("line_no")
    own = F.floor((n - 1) / block)
    places = F.array_compact(F.array(
        F.struct(own.alias(block_no), F.lit(False).alias(rim)),
        F.when(
            (n > 1) & ((n - 1) % block == 0),
            F.struct((own - 1).alias(block_no), F.lit(True).alias(rim)),
        ),
        F.when(n % block == 0, F.struct((own + 1).alias(block_no), F.lit(True).alias(rim))),
    ))
    near = Window.partitionBy("file_path", block_no).orderBy("line_no")
    return (
        lines.select("*", F.inline(places))
        .withColumn("context_before", F.lag("line").over(near))
        .withColumn("context_after", F.lead("line").over(near))
        .filter(~F.col(rim))
        .drop(block_no, rim)
    )


# Which lines make a record in a phase. Phases not listed here are accepted and make none.
_SELECTED = {
    "parsing": lambda line: ~is_blank(line),
    "name_resolution": lambda line: contains_any(line, ["fn ", "struct ", "enum "]),
    "type_inference": lambda line: contains_any(line, ["let ", "-> "]),
}
# Nominal milliseconds per record.
_PHASE_MS = {"parsing": 1, "name_resolution": 2, "type_inference": 3}


def _phase_columns(phase: str, has_context: bool) -> dict[str, Column]:
    line, kind = F.col("line"), F.col("_kind")
    columns = {
        "element_type": kind,
        "element_name": element_name(line),
        "processing_time_ms": F.lit(_PHASE_MS[phase]).cast("long"),
    }
    if phase == "parsing":
        columns["syntax_data"] = phase_json(phase, line, kind)
        if has_context:
            columns["context_before"] = F.col("context_before")
            columns["context_after"] = F.col("context_after")
    elif phase == "name_resolution":
        columns["element_signature"] = utrim(line)
        columns["symbol_data"] = phase_json(phase, line, kind)
    else:
        columns["element_type"] = F.lit("variable_or_return")
        columns["element_name"] = variable_name(line)
        columns["type_data"] = phase_json(phase, line, kind)
    return columns


def phase_records(
    lines: DataFrame, phases: Sequence[str], run: RunInfo = RunInfo()
) -> DataFrame:
    """Records of several phases in one pass over `lines`.

    Each line is tagged with the phases it belongs to and exploded over the tags, so the source is
    scanned once however many phases are asked for, and columns nobody reads are never built.
    """
    active = [p for p in phases if p in _SELECTED]
    if not active:
        return lines.sparkSession.createDataFrame([], SEMANTIC_RECORD)
    line = F.col("line")
    if len(active) == 1:
        tagged = lines.filter(_SELECTED[active[0]](line)).withColumn("phase", F.lit(active[0]))
    else:
        tags = [F.when(_SELECTED[p](line), F.lit(p)) for p in active]
        tagged = lines.withColumn("phase", F.explode(F.array_compact(F.array(*tags))))
    return _built(tagged, active, run)


def _built(tagged: DataFrame, active: Sequence[str], run: RunInfo) -> DataFrame:
    """Records from lines that carry the phase they are taken for."""
    line = F.col("line")
    tagged = tagged.withColumn("_kind", classify_element(line))
    has_context = "context_before" in tagged.columns
    per_phase = {p: _phase_columns(p, has_context) for p in active}
    now = F.unix_timestamp(F.current_timestamp())
    shared = {
        "id": F.concat_ws(":", "file_path", "line_no", "phase"),
        "file_path": F.col("file_path"),
        "line": F.col("line_no"),
        "column": F.lit(1),
        "phase": F.col("phase"),
        "timestamp": now if run.timestamp is None else F.lit(run.timestamp),
        "rust_version": F.lit(run.rust_version),
        "analyzer_version": F.lit(run.analyzer_version),
        "source_snippet": line,
    }
    if "processing_order" in tagged.columns:
        shared["processing_order"] = F.col("processing_order")

    def value(name: str) -> Column:
        if name in shared:
            return shared[name]
        found = [(p, per_phase[p][name]) for p in active if name in per_phase[p]]
        if not found:
            return F.lit(None)
        if len(active) == 1:
            return found[0][1]
        chosen = None
        for phase, expression in found:
            here = F.col("phase") == phase
            chosen = F.when(here, expression) if chosen is None else chosen.when(here, expression)
        return chosen

    return tagged.select(*[
        value(f.name).cast(f.dataType).alias(f.name) for f in SEMANTIC_RECORD.fields
    ])


def parsing_records(lines: DataFrame, run: RunInfo = RunInfo()) -> DataFrame:
    """One record per non-blank line, with its neighbours when `lines` carries them."""
    return phase_records(lines, ["parsing"], run)


def name_resolution_records(lines: DataFrame, run: RunInfo = RunInfo()) -> DataFrame:
    """One record per line that mentions a function, struct or enum definition."""
    return phase_records(lines, ["name_resolution"], run)


def type_inference_records(lines: DataFrame, run: RunInfo = RunInfo()) -> DataFrame:
    """One record per line with a binding or a return type."""
    return phase_records(lines, ["type_inference"], run)


def parse_phases(text: str) -> list[str]:
    """Phase names from a comma-separated list; an unknown name is an error."""
    names = [part.strip() for part in text.split(",")]
    for name in names:
        if name not in SEMANTIC_PHASES:
            raise ValueError(f"Unknown phase: {name}")
    return names


def run_phases(lines: DataFrame, phases: str, run: RunInfo = RunInfo()) -> DataFrame:
    """Records of all phases named in the comma-separated list."""
    return phase_records(lines, parse_phases(phases), run)


def processing_order(
    records: DataFrame, mode: str = "phase_first", phases: Sequence[str] = SEMANTIC_PHASES
) -> DataFrame:
    """Fill processing_order with the dense sequence phase, file, line (or file, phase, line)."""
    rank = F.array_position(F.array(*[F.lit(p) for p in phases]), F.col("phase"))
    path = path_order(F.col("file_path"))
    if mode == "phase_first":
        order = [rank, path, F.col("line")]
    elif mode == "file_first":
        order = [path, rank, F.col("line")]
    else:
        raise ValueError(f"Unknown mode: {mode}")
    columns = records.columns
    numbered = dense_position(
        records.drop("processing_order"), order, name="processing_order"
    )
    return numbered.select(*columns) if "processing_order" in columns else numbered


class LocatedFiles:
    """Source files as rows of a Parquet dataset: the columns they are made of, and their path and
    content as expressions of these. `narrow` rows, much smaller than their files, are spread over tasks
    by their number before the files are made."""

    def __init__(
        self, spark: SparkSession, path: str, columns: Sequence[str], file_path: str, content: str, narrow: bool = False
    ) -> None:
        self._spark, self._path, self._columns, self._narrow = spark, path, list(columns), narrow
        self._file_path, self._content = F.expr(file_path), F.expr(content)
        self.keys = [planned.FILE, planned.ROW]

    def scan(self) -> DataFrame:
        """(file_path, content) and `keys`, which name a file."""
        rows = planned.locate(self._spark, self._path)
        if self._narrow:
            rows = spread(rows.select(*[F.col(f"`{c}`") for c in self._columns], *self.keys))
        return rows.select(self._file_path.alias("file_path"), self._content.alias("content"), *self.keys)

    def attached(self, numbers: DataFrame) -> DataFrame:
        """(file_path, content) with the columns of `numbers` (`keys` and more), read where they lie."""
        more = [c for c in numbers.columns if c not in self.keys]
        rows = planned.attach(self._spark, self._path, self._columns, numbers)
        return rows.select(self._file_path.alias("file_path"), self._content.alias("content"), *more)


class TreeFiles:
    """The source files below a directory, read in planned splits."""

    def __init__(self, spark: SparkSession, root: str, ext: str = "rs", skip: Sequence[str] = ("target",)) -> None:
        self._spark = spark
        self._listed = hold(planned.list_texts(spark, root, f"*.{ext}", skip), "listed-files")
        self.keys = ["uri"]

    def scan(self) -> DataFrame:
        return planned.planned_texts(self._spark, self._listed.withColumn("_uri", F.col("uri"))).withColumnRenamed("_uri", "uri")

    def attached(self, numbers: DataFrame) -> DataFrame:
        return planned.planned_texts(self._spark, self._listed.join(numbers, "uri"))


def ordered_records(
    files: DataFrame | LocatedFiles | TreeFiles | Sequence[LocatedFiles | TreeFiles],
    phases: Sequence[str], run: RunInfo = RunInfo(), mode: str = "phase_first",
) -> DataFrame:
    """Source files to records with their processing_order.

    Files are counted, numbered and read again: what is sorted, added up and moved is a row per file
    with its number of records per phase. A file then knows the first number of each of its phases and
    counts on from there while its lines are taken apart, so one huge file is no worse than without
    numbers. Files from planned readers get their numbers in the split that reads them: no content is
    exchanged. A frame (file_path, unique, and content) may come from anywhere; its numbers are joined
    to it by path.
    """
    active = [p for p in phases if p in _SELECTED]
    parts = list(files) if isinstance(files, Sequence) else [files]
    if not active:
        spark = files.sparkSession if isinstance(files, DataFrame) else SparkSession.active()
        return spark.createDataFrame([], SEMANTIC_RECORD)
    if mode not in ("phase_first", "file_first"):
        raise ValueError(f"Unknown mode: {mode}")
    names = [f"_n{i}" for i in range(len(active))]
    keys = [["file_path"] if isinstance(p, DataFrame) else p.keys for p in parts]
    scans = [p if isinstance(p, DataFrame) else p.scan() for p in parts]
    # A key per kind of source, null for files of the others. Lines are counted as rows, which compiled
    # code does; each task adds up its own by plain columns, which takes no sort of the lines, before a
    # row per file is moved. Held, since a sort by ranges goes through its input twice.
    counted = hold(
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [
            _line_rows(scan.select("file_path", "content", *[F.col(c).alias(f"_part_{c}") for c in key]))
            .groupBy("file_path", *[f"_part_{c}" for c in key])
            .agg(*[F.count_if(_SELECTED[p](F.col("line"))).alias(n) for n, p in zip(names, active)])
            .groupBy("file_path").agg(
                F.min(F.struct(*[F.col(f"_part_{c}").alias(c) for c in key])).alias(f"_key{i}"),
                *[F.sum(n).alias(n) for n in names],
            )
            for i, (scan, key) in enumerate(zip(scans, keys))
        ]),
        "file-counts",
    )
    placed, sums = running_totals(
        counted.filter(reduce(lambda a, b: a | b, [F.col(n) > 0 for n in names])),
        [path_order(F.col("file_path"))], names,
    )
    if mode == "phase_first":
        earlier = [sum(sums[n] for n in names[:i]) for i in range(len(names))]
        first = [F.col(f"{n}_before") + F.lit(e) for n, e in zip(names, earlier)]
    else:
        whole = reduce(lambda a, b: a + b, [F.col(f"{n}_before") for n in names])
        first = [reduce(lambda a, b: a + b, [whole, *[F.col(m) for m in names[:i]]]) for i in range(len(names))]
    firsts = [f"_first{i}" for i in range(len(active))]
    starts = hold(
        placed.select(*[f"_key{i}" for i in range(len(parts))], *[f.alias(n) for f, n in zip(first, firsts)]),
        "first-numbers",
    )
    numbered = []
    for i, part in enumerate(parts):
        own = starts.filter(F.col(f"_key{i}").isNotNull()).select(f"_key{i}.*", *firsts)
        known = part.join(own, "file_path") if isinstance(part, DataFrame) else part.attached(own)
        numbered.append(known.select("file_path", "content", *firsts))
    rows = reduce(lambda a, b: a.unionByName(b), numbered)

    # A line that is chosen for a phase counts on by the lines chosen before it, which are a list.
    chosen = [
        F.filter(F.transform("_raw", lambda line, i: F.when(_SELECTED[p](line), i)), lambda i: i.isNotNull()).alias(f"_at{k}")
        for k, p in enumerate(active)
    ]

    def lines_of(k: int) -> Column:
        return F.transform(f"_at{k}", lambda at, n: F.struct(
            at.alias("at"), F.lit(active[k]).alias("phase"), (F.col(firsts[k]) + n + 1).alias("processing_order")
        ))

    picked = F.concat(*[lines_of(k) for k in range(len(active))])
    lines = (
        _with_lines(rows).select("file_path", "_raw", *firsts, *chosen)
        .select("file_path", "_raw", F.inline(picked))
        .select(
            "file_path", (F.col("at") + 1).cast("long").alias("line_no"), F.get("_raw", "at").alias("line"),
            F.get("_raw", F.col("at") - 1).alias("context_before"), F.get("_raw", F.col("at") + 1).alias("context_after"),
            "phase", "processing_order",
        )
    )
    return _built(lines, active, run)


def _line_rows(files: DataFrame) -> DataFrame:
    """A row per line, with `line` in the place of `content`."""
    rest = [c for c in files.columns if c != "content"]
    split = files.select(*rest, line_array(F.col("content")).alias("_split"))
    return split.select(*rest, F.explode(_whole_lines()).alias("line"))


def _with_lines(files: DataFrame) -> DataFrame:
    """Add `_raw`, the lines of `content`, which is dropped."""
    rest = [c for c in files.columns if c != "content"]
    split = files.select(*rest, line_array(F.col("content")).alias("_split"))
    return split.select(*rest, _whole_lines().alias("_raw"))


def _whole_lines() -> Column:
    return F.slice("_split", F.lit(1), F.size("_split") - (F.element_at("_split", -1) == "").cast("int"))
