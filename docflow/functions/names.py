"""Object names, links, paths, signatures and message times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docflow.schemas import ANALYSIS_FOLDER, ANNOTATION_FILE


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def present(col: Column | str) -> Column:
    """True for a value that is neither null nor empty text."""
    return F.coalesce(_c(col) != "", F.lit(False))


def document_id(bucket, key, version, event_time) -> Column:
    """Stable id of one object version; a random id would change on recompute."""
    parts = [F.coalesce(_c(c), F.lit("")) for c in (bucket, key, version, event_time)]
    return F.md5(F.concat_ws("|", *parts))


def document_link(bucket, key) -> Column:
    return F.concat(F.lit("s3://"), _c(bucket), F.lit("/"), _c(key))


def document_signature(bucket, key, version) -> Column:
    base = F.concat(F.lit("BUCKET:"), _c(bucket), F.lit("@FILE:"), _c(key))
    return F.when(present(version), F.concat(base, F.lit("@VERSION:"), _c(version))).otherwise(base)


def extension(key) -> Column:
    """From the last dot of the last path part, with the dot; empty if there is none."""
    return F.regexp_extract(_c(key), r"(\.[^./]*)$", 1)


def base_name(key) -> Column:
    """Last path part without its extension."""
    last = F.regexp_extract(_c(key), r"([^/]*)/*$", 1)
    return F.regexp_replace(last, r"\.[^.]*$", "")


def is_full_response(key) -> Column:
    return _c(key).rlike(r"(^|/)fullresponse\.json$")


def path_document_id(key) -> Column:
    return F.split_part(F.split_part(_c(key), F.lit(f"{ANALYSIS_FOLDER}/"), F.lit(1)), F.lit("/"), F.lit(1))


def path_document_name(key) -> Column:
    head = F.split_part(_c(key), F.lit(f"{ANALYSIS_FOLDER}/"), F.lit(1))
    return F.regexp_replace(head, "^[^/]*/?", "")


def page_path(object_name, page, file_name: str) -> Column:
    return F.concat(
        _c(object_name), F.lit(f"{ANALYSIS_FOLDER}/page-"), _c(page).cast("string"),
        F.lit(f"/{file_name}"),
    )


def full_response_path(object_name) -> Column:
    return F.concat(_c(object_name), F.lit(f"{ANALYSIS_FOLDER}/fullresponse.json"))


def annotation_path(document_id_, name) -> Column:
    return F.concat(_c(document_id_), F.lit("/"), _c(name), F.lit(ANNOTATION_FILE))


def message_time(timestamp) -> Column:
    """Message time text ``yyyy-MM-dd HH:mm:ss[.f] +0000 UTC`` as TIMESTAMP.

    The text stays the key: it may hold nanoseconds, which TIMESTAMP cannot.
    """
    return F.try_to_timestamp(F.regexp_replace(_c(timestamp), r" \+0000 UTC.*$", "Z"))


def caller_map(caller) -> Column:
    """A caller given as a JSON map is parsed; plain text becomes its ``arn``."""
    text = _c(caller)
    return F.when(text.startswith("{"), F.from_json(text, "MAP<STRING, STRING>")).otherwise(
        F.create_map(F.lit("arn"), text)
    )
