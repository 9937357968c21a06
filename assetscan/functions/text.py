"""Column-expression builders. All JVM-side: regexes and higher-order array functions,
so they stay inside whole-stage code generation and never start a Python worker."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas as S
from . import patterns as P


def rx(pattern: str) -> Column:
    """A regex as a literal Column, so Spark SQL string escaping never touches it."""
    return F.lit(pattern)


def strip_header(src: Column) -> Column:
    """Drop the notebook header line (and blank lines before it)."""
    return F.regexp_replace(src, rx(P.HEADER_RE), F.lit(""))


def header_of(src: Column) -> Column:
    """The exact header text C1 removes ('' when there is none)."""
    return F.regexp_extract(src, P.HEADER_RE, 0)


def split_chunks(body: Column) -> Column:
    """Chunks between separators, trailing empty chunks kept."""
    return F.split(body, P.SEPARATOR_RE, -1)


def separators(body: Column) -> Column:
    """The separators C2 cut on, in order (one fewer than the chunks)."""
    return F.regexp_extract_all(body, rx(P.SEPARATOR_RE), F.lit(0))


def chunk_text(chunk: Column) -> Column:
    """Chunk without its leading/trailing newlines."""
    return F.btrim(chunk, F.lit("\r\n"))


def is_blank(text: Column) -> Column:
    return text.rlike(P.BLANK_RE)


def cell_language(text: Column, default: Column | None = None) -> Column:
    """C4: 'sql' when one of the first two lines opens with the %sql magic; otherwise the
    first line's magic (md, scala, r, sh, run, pip ...), else the notebook's own language."""
    first_two = F.regexp_extract(text, P.FIRST_TWO_LINES_RE, 0)
    magic = F.lower(F.regexp_extract(text, P.FIRST_MAGIC_RE, 1))          # the pattern stays in the first line
    return (F.when(text.contains("%sql") & first_two.rlike(P.SQL_MAGIC_RE), F.lit("sql"))
            .when(magic == "", F.lit("python") if default is None else default)
            .otherwise(magic))


def cell_code(text: Column, language: Column) -> Column:
    """Runnable code of a cell. SQL: `# MAGIC ` prefixes and the %sql marker removed,
    trimmed. A magic-led cell of another language: prefixes and its first marker removed.
    Plain Python: the text as is."""
    unmagic = F.regexp_replace(text, rx(P.MAGIC_PREFIX_RE), F.lit(""))
    sql_code = F.regexp_replace(F.regexp_replace(unmagic, rx(P.SQL_MARKER_RE), F.lit("")),
                                rx(P.EDGE_SPACE_RE), F.lit(""))
    other_code = F.regexp_replace(F.regexp_replace(unmagic, rx(P.LANG_MARKER_RE), F.lit("")),
                                  rx(P.EDGE_SPACE_RE), F.lit(""))
    has_magic = F.regexp_extract(text, P.FIRST_MAGIC_RE, 1) != ""
    return (F.when(language == "sql", sql_code)
            .when(has_magic, other_code)
            .otherwise(text))


def name_parts(name: Column):
    """(namespace, table, keep) of a 2- or 3-part name. Backticks are dropped for lookup.
    `hive_metastore.db.t` looks up as (db, t); any other 3-part name is already
    qualified, so it is not kept (fix 9)."""
    clean = F.replace(name, F.lit("`"), F.lit(""))
    first, last = F.substring_index(clean, ".", 1), F.substring_index(clean, ".", -1)
    dots = F.length(clean) - F.length(F.replace(clean, F.lit("."), F.lit("")))
    legacy = (dots == 2) & (F.lower(first) == S.LEGACY_CATALOG)
    keep = (dots == 1) | legacy
    ns = F.when(dots == 1, first).when(legacy, F.substring_index(F.substring_index(clean, ".", 2), ".", -1))
    tbl = F.when(keep, last)
    return ns, tbl, keep



def mount_prefix(path: Column) -> Column:
    """The mount point of a path, '' when it is not one."""
    return F.regexp_extract(path, P.MOUNT_PREFIX_RE, 1)


def mount_prefixes(path: Column) -> Column:
    """Every folder of a mount path from its first component down, the path itself included; empty when it is none."""
    parts = F.filter(F.split(F.regexp_replace(path, rx(P.DBFS_SCHEME_RE), F.lit("")), "/"), lambda p: p != "")
    return F.when(mount_prefix(path) != "", F.transform(F.sequence(F.lit(2), F.greatest(F.size(parts), F.lit(2))), lambda n: F.concat(
        F.lit("/"), F.array_join(F.slice(parts, 1, n), "/"))))


def python_literals(code: Column) -> Column:
    """String literals of Python code (comments come out as tokens and are dropped)."""
    toks = F.regexp_extract_all(code, rx(P.PY_LITERAL_RE), F.lit(0))
    return F.filter(toks, lambda t: ~t.startswith("#"))


def literal_body(lit: Column) -> Column:
    """Text between the quotes of a literal token."""
    return F.regexp_replace(lit, rx(P.QUOTES_RE), F.lit(""))
