"""Dump-line parsing as pure Column expressions.

Everything is a built-in Spark expression, so parsing stays inside
whole-stage codegen and runs where the bytes are read.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
# File-name stamp of an hourly dump: pageviews-YYYYMMDD-HHMMSS.gz
FILE_STAMP_REGEX = r"pageviews-(\d{8}-\d{6})\.gz"
FILE_STAMP_FORMAT = "yyyyMMdd-HHmmss"
# Strict whole-path rewrite (full-history loader): groups are y, m, d, H, M, S.
PATH_REWRITE_REGEX = r"^.+pageviews-(\d{4})(\d{2})(\d{2})-(\d{2})(\d{2})(\d{2})\.gz$"
PATH_REWRITE_TEMPLATE = "$1-$2-$3 $4:$5:$6"
# Strict line grammar: project, optional .subproject, title, views, bytes.
STRICT_LINE_REGEX = r"^([^ .]+)(\.[^ ]+)? +([^ ]+) +(\d+) +(\d+)$"
UNKNOWN_TITLE = "-"
DEFAULT_PROJECTS = ("en", "en.m")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _part(s: Column, sep: str, i: int) -> Column:
    """1-based field ``i`` of ``s`` split on ``sep``; a missing field is ''.

    Same result as ``split_part(s, sep, i)``, but ``substring_index`` scans
    only up to the i-th separator and builds no array: about 3x cheaper per
    dump line (measured on 2M lines), and these run once per line of the archive.
    The appended separator makes a missing field come out as ''.
    """
    return F.substring_index(F.substring_index(F.concat(s, F.lit(sep)), sep, i), sep, -1)


def token(line, i: int) -> Column:
    """1-based token on single spaces; missing tokens are '' (D1)."""
    return _part(_c(line), " ", i)


def n_tokens(line) -> Column:
    """Number of tokens when splitting on every single space."""
    return F.size(F.split(_c(line), " ", -1))


def has_tokens(line, n: int) -> Column:
    """At least ``n`` space-separated tokens, i.e. at least ``n - 1`` spaces."""
    line = _c(line)
    return F.substring_index(line, " ", n - 1) != line


def project_part(project_token, i: int) -> Column:
    """project = part 1, subproject = part 2 of ``en.m``; missing part is '' (P2)."""
    return _part(_c(project_token), ".", i)


def url_decode_lenient(raw) -> Column:
    """Percent-decode a title, keeping '+' and each malformed escape unchanged."""
    raw = _c(raw)
    literal = F.regexp_replace(F.replace(raw, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(literal), raw)


def to_hits(s) -> Column:
    """Text count to BIGINT; NULL when not a number."""
    return _c(s).try_cast("bigint")


def is_bad_hits(h) -> Column:
    """A row whose count would fail the unsigned cast: NULL or negative."""
    h = _c(h)
    return h.isNull() | (h < 0)


def time_from_file_name(name) -> Column:
    """Hour of a dump from its name ``pageviews-YYYYMMDD-HHMMSS.gz`` (P4, D10); NULL if absent."""
    stamp = F.regexp_extract(_c(name), FILE_STAMP_REGEX, 1)
    return F.try_to_timestamp(stamp, F.lit(FILE_STAMP_FORMAT))


def time_from_path_rewrite(path) -> Column:
    """Hour of a dump by rewriting the whole path to ``y-m-d H:M:S`` then casting (P5)."""
    rewritten = F.regexp_replace(_c(path), PATH_REWRITE_REGEX, PATH_REWRITE_TEMPLATE)
    return F.try_to_timestamp(rewritten, F.lit("yyyy-MM-dd HH:mm:ss"))


def ym(ts) -> Column:
    """Month partition value ``YYYYMM`` of a timestamp."""
    ts = _c(ts)
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def lenient_columns(line="value") -> dict[str, Column]:
    """Columns of the lenient parse (P1-P3, P6) before any filter."""
    line = _c(line)
    proj_tok = token(line, 1)
    return {
        "project": project_part(proj_tok, 1),
        "subproject": project_part(proj_tok, 2),
        "raw_title": token(line, 2),
        "path": url_decode_lenient(token(line, 2)),
        "hits": to_hits(token(line, 3)),
    }


def lenient_keep(line="value") -> Column:
    """Well-formed (>= 3 tokens) and title known."""
    line = _c(line)
    return has_tokens(line, 3) & (token(line, 2) != F.lit(UNKNOWN_TITLE))


def strict_match(line="value") -> Column:
    """Whole-line match of the strict grammar (P10)."""
    return _c(line).rlike(STRICT_LINE_REGEX)


def strict_columns(line="value") -> dict[str, Column]:
    """Columns of the strict parse of a line that matches: subproject keeps its dot, title not decoded (P10).

    The grammar leaves no spaces inside the fields, so the fields of a matching
    line are cut without running the expression again.
    """
    fields = F.split(_c(line), " +")
    project = F.substring_index(fields[0], ".", 1)
    return {
        "project": project,
        "subproject": F.substr(fields[0], F.length(project) + 1),
        "path": fields[1],
        "hits": to_hits(fields[2]),
    }
