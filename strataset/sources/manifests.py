"""Project manifests (TOML text) to typed columns."""

from __future__ import annotations

import json
import sys
import tomllib

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

# Executors need not have this package installed: its functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_STRINGS = (
    "name", "version", "description", "authors", "license", "repository", "homepage",
    "documentation", "keywords", "categories", "members", "features", "targets", "problem",
)
_PARSED = T.StructType(
    [T.StructField(f, T.BooleanType()) for f in ("has_package", "has_workspace")]
    + [T.StructField("member_count", T.IntegerType())]
    + [T.StructField(f, T.StringType()) for f in _STRINGS]
)
_ARROW = pa.struct(
    [(f, pa.bool_()) for f in ("has_package", "has_workspace")]
    + [("member_count", pa.int32())]
    + [(f, pa.string()) for f in _STRINGS]
)


def _text(table: dict, key: str) -> str | None:
    value = table.get(key)
    return value if isinstance(value, str) else None


def _json(value: object, kind: type) -> str | None:
    if not isinstance(value, kind):
        return None
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, default=str)


def _parse(content: str) -> dict:
    try:
        manifest = tomllib.loads(content)
    except (tomllib.TOMLDecodeError, TypeError) as error:
        return {"has_package": False, "has_workspace": False, "problem": f"not TOML: {error}"}
    package, workspace = manifest.get("package"), manifest.get("workspace")
    row = {
        "has_package": package is not None,
        "has_workspace": workspace is not None,
        "features": _json(manifest.get("features"), dict),
        "targets": _json(manifest.get("lib", manifest.get("bin")), dict),
    }
    package = package if isinstance(package, dict) else {}
    for key in ("name", "version", "description", "license", "repository", "homepage",
                "documentation"):
        row[key] = _text(package, key)
    for key in ("authors", "keywords", "categories"):
        row[key] = _json(package.get(key), list)
    if isinstance(workspace, dict):
        members = workspace.get("members")
        row["members"] = _json(members, list)
        row["member_count"] = len(members) if isinstance(members, list) else 0
    if not row["has_package"] and not row["has_workspace"]:
        row["problem"] = "no package or workspace section"
    elif not row["has_workspace"] and row["name"] is None:
        row["problem"] = "no package name"
    return row


@F.arrow_udf(_PARSED)
def _parse_manifest(content: pa.Array) -> pa.Array:
    return pa.array([_parse(text) for text in content.to_pylist()], type=_ARROW)


# A filter on the parsed fields must not be pushed below the parser, which would then run twice.
_parse_manifest = _parse_manifest.asNondeterministic()


def scan_manifests(files: DataFrame) -> DataFrame:
    """(path, content) of manifest files to project_path, project_dir and the parsed fields.

    Lists and tables stay JSON text. A manifest that cannot be used has its reason in `problem`
    instead of failing the job.
    """
    folder = F.regexp_replace("path", "/[^/]*$", "")
    return files.select(
        folder.alias("project_path"),
        F.element_at(F.split(folder, "/"), -1).alias("project_dir"),
        _parse_manifest("content").alias("_m"),
    ).select("project_path", "project_dir", "_m.*")
