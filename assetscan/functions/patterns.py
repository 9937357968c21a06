"""Regular expressions of the Spark operators.

Repeated groups are possessive (`*+`): Java matches a greedy repeated group by recursion, one
frame per repetition, so a literal of a few thousand characters would overflow the stack. Apart
from that the patterns stay inside what RE2 knows too (no look-around, no back-references);
`re2` gives that form for engines without possessive quantifiers, with the same matches, since
nothing after such a group could use what it gives back.
"""
from __future__ import annotations



def re2(pattern: str) -> str:
    return pattern.replace(")*+", ")*").replace("]*+", "]*").replace(")?+", ")?")


# FIXED VALUES of the notebook format and the mount layout: header, separator, magic prefix, mounts.
# ---- cells ---------------------------------------------------------------- #
# Header line, with any blank lines before it (fix: the reference drops the first line
# even when it is blank).
HEADER_RE = r"^\s*(?:#|--|//) Databricks notebook source[^\n]*(?:\r?\n)?"
# Cell separator; `\r?` lets CRLF sources split too.
SEPARATOR_RE = r"\r?\n(?:#|--|//)\s*COMMAND\s*-+\r?\n"
# Leading / trailing newlines of a chunk (the reference strips "\n"; we strip "\r" too).
EDGE_NEWLINES_RE = r"^[\r\n]+|[\r\n]+\z"
BLANK_RE = r"^\s*\z"
FIRST_TWO_LINES_RE = r"^[^\n]*(?:\n[^\n]*)?"
FIRST_LINE_RE = r"^[^\n]*"
# A `%sql` magic that opens one of the first two lines (fix: `%sql` elsewhere is not one).
SQL_MAGIC_RE = r"(?m)^[ \t]*(?:(?:#|--|//)[ \t]*MAGIC[ \t]*)?%sql\b"
# The magic of the first line, e.g. md, scala, r, sh, run, pip, python.
FIRST_MAGIC_RE = r"^[ \t]*(?:#|--|//)[ \t]*MAGIC[ \t]*%([\w-]+)"
MAGIC_PREFIX_RE = r"(?im)^(?:#|--|//)[ \t]*MAGIC[ \t]?"
# Only the marker goes (fix: `%sql SELECT ...` on one line keeps its query).
SQL_MARKER_RE = r"(?im)^[ \t]*%sql\b[ \t]*"
LANG_MARKER_RE = r"(?m)^[ \t]*%[\w-]+[ \t]*"
EDGE_SPACE_RE = r"^\s+|\s+\z"

# ---- SQL tokens (E1) ------------------------------------------------------- #
# They cover every character: magic prefixes and space, comments, strings, names with their dots, single signs.
_PART = r"(?:`[^`\n]+`|\w+)"
SQL_TOKEN_RE = (r"(?im:^(?:#|--|//)[ \t]*MAGIC\b[ \t]?(?:[ \t]*%sql\b)?)|(?im:^[ \t]*%sql\b)|\s+|--[^\n]*|/\*[\s\S]*?\*/"
                r"|'(?:[^'\\]|\\[\s\S])*+'|\"(?:[^\"\\]|\\[\s\S])*+\""
                rf"|{_PART}(?:\s*\.\s*{_PART})*+|[\s\S]")
# A mount path as a string, and as the back-ticked part of a name.
SQL_PATH_RE = r"^['\"]((?:dbfs:)?/mnt/[^'\"]+)['\"]\z"
SQL_PATH_NAME_RE = r"^\w+\s*\.\s*`((?:dbfs:)?/mnt/[^`]+)`\z"

# ---- Python, lexical form (E3, E4, E6, E7 without a parser) ---------------- #
# Comments and string literals (with up to two prefix letters), leftmost first.
PY_LITERAL_RE = (
    r"[A-Za-z]{0,2}\"\"\"[\s\S]*?\"\"\"|[A-Za-z]{0,2}'''[\s\S]*?'''"
    r"|[A-Za-z]{0,2}\"(?:[^\"\\\n]|\\.)*+\"|[A-Za-z]{0,2}'(?:[^'\\\n]|\\.)*+'|#[^\n]*"
)
PY_TABLE_CALL_RE = r"\.table\(\s*[\"']([^\"'\\\n]*)[\"']\s*\)"
PY_SQL_CALL_DQ_RE = r"\.sql\(\s*\"([^\"\\\n]*)\"\s*\)"
PY_SQL_CALL_SQ_RE = r"\.sql\(\s*'([^'\\\n]*)'\s*\)"
PY_SQL_CALL_TDQ_RE = r"\.sql\(\s*\"\"\"([\s\S]*?)\"\"\"\s*\)"
# First argument of .table( / .sql( that does not open with a plain quote.
PY_DYNAMIC_CALL_RE = r"\.(?:table|sql)\(\s*([^\s\"')][^)\n]*)\)"
PLAIN_STRING_HEAD_RE = r"^[rRuU]?[\"']"
FSTRING_HEAD_RE = r"^(?:[fF][rR]?|[rR][fF])[\"']"
FSTRING_FIELD_RE = r"\{[^{}]*\}"
QUOTES_RE = r"^[A-Za-z]{0,2}(?:\"\"\"|'''|\"|')|(?:\"\"\"|'''|\"|')\z"

# ---- mounts (R3) ---------------------------------------------------------- #
MOUNT_PREFIX_RE = r"^(?:dbfs:)?(/mnt/[^/\"']+)"
DBFS_SCHEME_RE = r"^dbfs:"

# First path component of a dynamic mount's pattern; the one field in it; strings assigned in a cell.
MOUNT_PATTERN_RE = r"^(?:dbfs:)?(/mnt/[^/]*)"
MOUNT_FIELD_RE = r"^((?:dbfs:)?/mnt/[^/{}]*)\{(\w+)\}([^/{}]*)"
ASSIGNED_STRING_RE = r"(?m)^[ \t]*(\w+)[ \t]*=[ \t]*[\"']([^\"'\n]*)[\"']"

# ---- cheap native prefilter ahead of the Python syntax job ------------------ #
PY_PREFILTER_RE = r"mnt|\btable\b|\bsql\b"

# ---- review: candidate names in a cell (V10) ------------------------------ #
IDENT_RE = r"\w+(?:\.\w+)?"
DYNAMIC_SUFFIX_RE = r"\.(\w+)[\"']?\s*\)?\s*\z"
