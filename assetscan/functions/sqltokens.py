"""Where SQL text names tables, read by one fold over its tokens.

The text is cut into tokens that cover every character (`SQL_TOKEN_RE`), so a token's place is the length of those
before it. The fold keeps the place, the statement's first word, the word before, a stack of what each open parenthesis
returns to, and a one-letter clause:

  Q  a table of a FROM list is expected          A  after such a table: a comma expects the next
  q  the one table of INTO, TABLE, ... expected  T  after it: commas mean nothing
  U  after USING: a table, or a column list      O  in a join condition: a comma expects the next table
  F  just inside other parentheses               f  inside them, no query: FROM is an argument's word
  H  SHOW COLUMNS, before IN                     N  anything else

Found are tables (role T), other dotted words (role C: column qualifiers that follow their table when it is renamed) and
paths given as strings or in back-ticks (role P), each with its place. A name right before a parenthesis in a FROM list
is a function. A text that ends inside a parenthesis, where a table is still expected, or that has something else
there (a placeholder, IDENTIFIER(...), a missing name) is marked unread; what was found stays, but for what stands inside a
parenthesis that is never closed.

Everything is built-in functions, so it runs inside the JVM."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P

FOUND = "array<struct<role:string,text:string,at:int>>"
SKIPPED = ("table", "if", "not", "exists", "only", "lateral", "extended", "formatted", "detail", "history", "stream")
QUERY_HEADS = ("select", "with", "values", "set")
CLAUSES = ("where", "group", "having", "order", "limit", "union", "intersect", "except", "minus", "window",
           "qualify", "cluster", "distribute", "sort", "returning", "offset")
STATEMENT_HEADS = ("optimize", "vacuum", "refresh", "describe", "desc", "update")
RIGHTS = ("grant", "revoke", "deny")
PATH_WORDS = ("location", "directory", "path")


def _key(t: Column) -> Column:
    """What the fold needs to know of a token: space, sign, "'" for a string, '.' for a dotted name, or a lower-case word."""
    return (F.when(t.rlike(r"(?i)^(?:\s|--|/\*|(?:#|//)[ \t]*MAGIC|%sql)"), " ")
            .when(t.rlike(r"^['\"]"), F.when(F.length(t) > 1, "'").otherwise('"'))
            .when(t.rlike(r"^[`\w]"), F.when(t.contains("."), F.when(F.regexp_replace(t, "`[^`]*`", "x").contains("."), ".").otherwise(F.lower(t)))
                  .otherwise(F.lower(t)))
            .when(t.isin("(", ")", ",", ";"), t).otherwise("?"))


def _step(a: Column, x: Column, qualifiers: bool) -> Column:
    """The state after one token."""
    s, k, prev, verb, stack = a["s"], x["key"], a["prev"], a["verb"], a["stack"]
    pos = (a["pos"] + F.length(x["text"])).cast("int")
    expected = s.isin("Q", "q", "U")
    after = F.when(s.isin("Q", "U"), "A").when(s == "q", "T").when(s == "F", "f").otherwise(s)

    word_expected = (F.when(k.isin(*SKIPPED), s).when(k.isin(*QUERY_HEADS, *CLAUSES), "N").when(k.isin("from", "join"), "Q")
                     .when(k.isin("into", "overwrite"), "q").otherwise(after))
    from_list = F.when((prev == "distinct") | ((verb == "show") & (s != "H")), s).otherwise("Q")
    no_object = (prev == "lateral") | verb.isin("select", "with")
    word_else = (F.when(k == "from", from_list)
                 .when(k == "join", "Q")
                 .when(k == "into", "q")
                 .when((k == "overwrite") & (s == "N"), "q")
                 .when(k.isin("table", "view"), F.when(no_object, s).otherwise("q"))
                 .when(k == "using", F.when(s.isin("A", "O") | ((s == "T") & (verb == "merge")), "U").otherwise(s))
                 .when(k == "on", F.when(verb.isin(*RIGHTS), "q").when(s == "A", "O").otherwise(s))
                 .when(k.isin("like", "clone"), F.when((s == "T") & (verb == "create"), "q").otherwise(s))
                 .when(k.isin(*STATEMENT_HEADS), F.when((prev == "") | ((k == "update") & (prev == ")")), "q").otherwise(s))
                 .when((verb == "show") & k.isin("columns", "partitions", "tblproperties"), F.when(k == "columns", "H").otherwise("q"))
                 .when((k == "in") & (s == "H"), "q")
                 .when(k.isin(*QUERY_HEADS, *CLAUSES) | ((k == "when") & (verb == "merge")), "N")
                 .otherwise(s))
    state = (F.when(k == "(", F.when(s.isin("Q", "q"), "Q").otherwise("F"))
             .when(k == ")", F.when(stack == "", s).otherwise(F.right(stack, F.lit(1))))
             .when(k == ",", F.when(s.isin("A", "O", "Q"), "Q").when(s.isin("q", "U"), "N").when(s == "F", "f").otherwise(s))
             .when(k == ";", "N")
             .when(k.isin("'", '"', "?", "."), after)
             .when(expected, word_expected)
             .when(s == "F", F.when(k.isin("select", "with"), "N").otherwise("f"))
             .when(s == "f", s)
             .otherwise(word_else))
    bad = (a["bad"] | ((k == ")") & ((stack == "") | s.isin("Q", "q"))) | ((k == ";") & ((stack != "") | expected)) | (k == '"')
           | (s.isin("Q", "q") & (k.isin("?", "identifier", *CLAUSES))))
    path = F.regexp_extract(x["text"], P.SQL_PATH_RE, 1)

    def found(role: str, text: Column, at: Column) -> Column:
        return F.concat(a["found"], F.array(F.struct(F.lit(role).alias("role"), text.alias("text"), at.cast("int").alias("at"))))

    inside = F.instr(x["text"], "`")                                  # delta.`/mnt/...`: the path begins after the back-tick
    names = (F.when((k == ".") & x["text"].rlike(P.SQL_PATH_NAME_RE), found("P", F.regexp_extract(x["text"], P.SQL_PATH_NAME_RE, 1), a["pos"] + inside))
             .when((k == ".") & expected, found("T", x["text"], a["pos"]))
             .when((k == ".") & F.lit(qualifiers), found("C", x["text"], a["pos"]))
             .when((k == "'") & (s.isin("Q", "q") | prev.isin(*PATH_WORDS)) & (path != ""), found("P", path, a["pos"] + 1))
             .when((k == "(") & (prev == ".") & (s == "A") & (F.size(a["found"]) > 0) & (F.try_element_at(a["found"], F.lit(-1))["role"] == "T"),
                   F.slice(a["found"], 1, F.size(a["found"]) - 1))
             .otherwise(a["found"]))
    step = F.struct(
        state.alias("s"),
        F.when(k == "(", F.concat(stack, after)).when(k == ")", F.left(stack, F.length(stack) - 1)).when(k == ";", "").otherwise(stack).alias("stack"),
        F.when(k == ";", "").when((verb == "") & (k != "("), k).otherwise(verb).alias("verb"),
        F.when(k == ";", "").otherwise(k).alias("prev"),
        pos.alias("pos"),
        F.when((k == "(") & (stack == ""), a["pos"]).otherwise(a["open"]).alias("open"),
        names.alias("found"),
        bad.alias("bad"))
    # space and comments only move the place: nothing else is worked out for them
    return F.when(k == " ", F.struct(*[(pos if c == "pos" else a[c]).alias(c) for c in
                                       ("s", "stack", "verb", "prev", "pos", "open", "found", "bad")])).otherwise(step)


def read_sql(sql: Column, qualifiers: bool = False) -> Column:
    """struct(found, unread) of a SQL text; places are code points from 0. NULL gives nothing found."""
    tokens = F.regexp_extract_all(F.coalesce(sql, F.lit("")), F.lit(P.SQL_TOKEN_RE), F.lit(0))
    keyed = F.transform(tokens, lambda t: F.struct(t.alias("text"), _key(t).alias("key")))
    start = F.struct(F.lit("N").alias("s"), F.lit("").alias("stack"), F.lit("").alias("verb"), F.lit("").alias("prev"),
                     F.lit(0).alias("pos"), F.lit(0).alias("open"), F.array().cast(FOUND).alias("found"), F.lit(False).alias("bad"))
    return F.aggregate(keyed, start, lambda a, x: _step(a, x, qualifiers), lambda a: F.struct(
        F.when(a["stack"] == "", a["found"]).otherwise(F.filter(a["found"], lambda f: f["at"] < a["open"])).alias("found"), (a["bad"] | (a["stack"] != "") | a["s"].isin("Q", "q", "U")).alias("unread")))


def bound(value: Column, use) -> Column:
    """`use(value)` with `value` evaluated once however often `use` mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def plain_name(name: Column) -> Column:
    """A dotted name without the space around its dots."""
    return F.regexp_replace(name, r"\s*\.\s*", ".")


def table_names(read: Column) -> Column:
    """The tables among what `read_sql` found: names of two or three parts, as written, duplicates kept."""
    names = F.transform(F.filter(read["found"], lambda f: f["role"] == "T"), lambda f: plain_name(f["text"]))
    return F.filter(names, lambda n: F.size(F.split(F.regexp_replace(n, "`[^`]*`", "x"), r"\.")) <= 3)


def path_names(read: Column) -> Column:
    """The mount paths among what `read_sql` found."""
    return F.transform(F.filter(read["found"], lambda f: f["role"] == "P"), lambda f: f["text"])
