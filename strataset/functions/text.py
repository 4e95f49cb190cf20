"""Column functions on lines of source text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# The characters with the Unicode property White_Space.
WHITE_SPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# What a line is taken for, in order of precedence.
ELEMENT_RULES = (
    ("fn ", "function"),
    ("struct ", "struct"),
    ("enum ", "enum"),
    ("impl ", "impl"),
    ("let ", "variable"),
    ("use ", "import"),
)
# Type names looked for in a line, in order of precedence.
TYPE_NAMES = ("String", "i32", "bool")


def utrim(text: Column) -> Column:
    """Strip Unicode white space on both sides (Spark's trim strips U+0020 only)."""
    return F.trim(text, F.lit(WHITE_SPACE))


def is_blank(text: Column) -> Column:
    return F.ltrim(text, F.lit(WHITE_SPACE)) == ""


def first_word(text: Column) -> Column:
    """The text up to the first white space, leading white space skipped."""
    return F.regexp_extract(F.ltrim(text, F.lit(WHITE_SPACE)), r"(?U)^\S+", 0)


def after(text: Column, mark: str) -> Column:
    """What follows the first `mark`; null when there is none."""
    at = F.instr(text, mark)
    return F.when(at > 0, F.substring(text, at + F.lit(len(mark)), F.length(text)))


def before(text: Column, mark: str) -> Column:
    """What precedes the first `mark`; null when there is none."""
    return F.when(F.instr(text, mark) > 0, F.substring_index(text, mark, 1))


def contains_any(text: Column, marks: Sequence[str]) -> Column:
    found = F.lit(False)
    for mark in marks:
        found = found | text.contains(mark)
    return found


def first_match(text: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """The value of the first rule whose mark occurs in `text`."""
    chosen = F.lit(default)
    for mark, value in reversed(rules):
        chosen = F.when(text.contains(mark), F.lit(value)).otherwise(chosen)
    return chosen


def classify_element(line: Column, rules: Sequence[tuple[str, str]] = ELEMENT_RULES) -> Column:
    return first_match(line, rules, "other")


def element_name(line: Column) -> Column:
    """Function name up to its parenthesis, else struct name up to the next space, else null."""
    return F.coalesce(
        utrim(before(after(line, "fn "), "(")),
        utrim(before(after(line, "struct "), " ")),
    )


def variable_name(line: Column) -> Column:
    """What a binding is called: text up to `=`, else up to `:`, else null."""
    bound = after(line, "let ")
    return F.coalesce(utrim(before(bound, "=")), utrim(before(bound, ":")))


def inferred_type(line: Column) -> Column:
    return first_match(line, [(name, name) for name in TYPE_NAMES], "unknown")


def phase_json(phase: str, line: Column, kind: Column | None = None) -> Column:
    """The JSON payload that a record of `phase` carries about its line.

    `kind` is the line's element type, where it has been worked out already.
    """
    kind = classify_element(line) if kind is None else kind
    if phase == "parsing":
        token = F.struct(
            F.lit("keyword").alias("kind"),
            first_word(line).alias("text"),
            F.lit(0).alias("start"),
            F.octet_length(line).alias("end"),
        )
        return F.to_json(F.struct(
            F.array(token).alias("tokens"), kind.alias("ast_node_type")
        ))
    if phase == "name_resolution":
        place = F.struct(F.lit(1).alias("line"), F.lit(1).alias("column"))
        return F.to_json(F.struct(
            kind.alias("symbol_kind"),
            F.lit("public").alias("visibility"),
            place.alias("definition_location"),
        ))
    if phase == "type_inference":
        return F.to_json(F.struct(
            inferred_type(line).alias("inferred_type"),
            F.lit(0.95).alias("confidence"),
            F.lit("explicit").alias("inference_method"),
        ))
    raise ValueError(f"phase without payload: {phase}")


def path_order(path: Column) -> Column:
    """A key that sorts paths component by component, so that a/b comes before a-b.

    The slash becomes the lowest character, which sorts faster than an array of components.
    """
    return F.replace(path, F.lit("/"), F.lit("\u0001"))


def repo_key(url: Column, host: str = "github.com") -> Column:
    """(owner, repo) from the last two segments of a repository URL on `host`, else null."""
    parts = F.split(F.rtrim(url, F.lit("/")), "/")
    return F.when(
        url.contains(host) & (F.size(parts) >= 2),
        F.struct(
            F.element_at(parts, -2).alias("owner"),
            F.regexp_replace(F.element_at(parts, -1), r"(\.git)+$", "").alias("repo"),
        ),
    )
