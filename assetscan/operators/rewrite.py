"""Approved edits applied to asset text, backups, stamps, restore.

Edits are grouped per asset into one row (bounded by the references of that one asset, whose text already
sits in one row).

Two rewrites:
  rewrite_literal  the reference's: every original replaced file-wide, longest first,
                   each replace reading the previous one's output.
  rewrite_places   the default (section 7.4, fixes 17 and 18): the cells of the assets with edits are read
                   again for where references stand (`reference_places`), edits are joined to the places of their cell,
                   and the disjoint places are spliced. So an edit is only made at a reference: never in a string
                   that is a value, a comment, a key or a longer name, nor twice in its own output. SQL column
                   qualifiers (`db.t.id`) follow their table.
"""
from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import sqltokens as Q
from ..functions import text as X
from ..functions.pysyntax import locate_cell
from .review import is_legal

SEP = "\u0001"
# what Apply reads of the work set
EDIT_COLS = ["manifest_id", "reference_kind", "asset_path", "cell_index", "original_reference", "final_replacement"]


def work_set(manifest: DataFrame) -> DataFrame:
    """Approved or overridden notebook rows with a non-blank final (fix 19)."""
    return manifest.filter(F.col("status").isin("approved", "overridden")
                           & (F.col("asset_type") == "notebook")
                           & F.col("final_replacement").isNotNull()
                           & (F.trim(F.col("final_replacement")) != ""))


def edit_key(cell: F.Column, text: F.Column) -> F.Column:
    return F.concat(cell.cast("string"), F.lit(SEP), text)


def edit_maps(edits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A1: per asset, the list of (cell, original, final). Returns (maps, conflicts): an original
    with several distinct finals in its cell is a conflict and is left out. In an asset's ordered list of distinct edits those
    of one original stand side by side. The lists are written once: the rewrite and the outcomes read them."""
    from ..plans.partitioning import materialize
    distinct = (edits.filter(F.col("final_replacement").isNotNull())
                .select("asset_path", F.col("cell_index").alias("c"), F.col("original_reference").alias("o"), F.col("final_replacement").alias("f")).distinct())
    lists = distinct.groupBy("asset_path").agg(F.array_sort(F.collect_list(F.struct("c", "o", "f"))).alias("all"))

    def same(i: F.Column, j: F.Column) -> F.Column:
        a, b = F.get("all", i), F.get("all", j)
        return b.isNotNull() & a["c"].eqNullSafe(b["c"]) & a["o"].eqNullSafe(b["o"])

    lone = F.filter("all", lambda e, i: ~same(i, i - 1) & ~same(i, i + 1))
    first = F.filter("all", lambda e, i: ~same(i, i - 1) & same(i, i + 1))
    lists = materialize(lists.select(
        "asset_path", F.transform(lone, lambda e: F.struct(e["c"].alias("c"), F.length(e["o"]).alias("len"), e["o"].alias("o"), e["f"].alias("f"))).alias("edit_list"),
        F.transform(first, lambda e: F.struct(e["c"].alias("cell_index"), e["o"].alias("original_reference"))).alias("conflicts")), "edit-maps")
    conflicts = lists.select("asset_path", F.explode("conflicts").alias("k")).select("asset_path", "k.cell_index", "k.original_reference")
    return lists.filter(F.size("edit_list") > 0).select("asset_path", "edit_list"), conflicts


# ---- literal rewrite (A2, A3: the reference's semantics) --------------------- #
def rewrite_literal_col(source: F.Column, edit_list: F.Column) -> F.Column:
    """Longest original first (ties by original, then final), chained `replace`."""
    ordered = F.array_sort(F.transform(edit_list, lambda e: F.struct(
        (-e["len"]).alias("neg_len"), e["o"].alias("o"), e["f"].alias("f"))))
    return F.aggregate(ordered, source, lambda acc, e: F.replace(acc, e["o"], e["f"]))


# ---- rewrite by place (section 7.4) ------------------------------------------ #
def cell_chunks(assets: DataFrame) -> DataFrame:
    """asset_path, pos, head, text, tail, cell_index, language: every chunk of every notebook in order, its line ends before
    and after `text` apart, the separator at its end; a blank chunk has no cell."""
    body = X.strip_header(F.col("source"))
    seps = F.concat(X.separators(body), F.array(F.lit("")))
    rows = assets.select("asset_path", F.lower(F.coalesce(F.col("language"), F.lit("python"))).alias("own"),
                         F.posexplode_outer(F.arrays_zip(X.split_chunks(body).alias("chunk"), seps.alias("sep"))).alias("pos", "c"))
    rows = rows.select("asset_path", "own", "pos", "c.chunk", "c.sep").withColumn("text", X.chunk_text(F.col("chunk")))
    rows = rows.withColumn("is_cell", ~X.is_blank(F.col("text")))
    before = Window.partitionBy("asset_path").orderBy("pos")
    number = (F.sum(F.col("is_cell").cast("int")).over(before) - 1).cast("int")
    head = F.regexp_extract("chunk", r"^[\r\n]*", 0)
    tail = F.substring("chunk", F.length(head) + F.length("text") + 1, F.length("chunk"))
    return rows.select("asset_path", "pos", head.alias("head"), "text", F.concat(tail, F.col("sep")).alias("tail"),
                       F.when(F.col("is_cell"), number).alias("cell_index"),
                       F.when(F.col("is_cell"), X.cell_language(F.col("text"), F.col("own"))).alias("language"))


_PLACED = "array<struct<kind:string,text:string,start:int,end:int,whole:boolean,pieces:array<struct<v:int,s:int,n:int>>>>"


def _locate_batches(batches):
    """Every row passes through; `placed` is what a Python cell to parse refers to, and where."""
    names, types = ["kind", "text", "start", "end", "whole"], [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.bool_()]
    for batch in batches:
        placed, pieces, ends, rows = [], [], [0], [0]
        texts = iter(batch["text"].filter(batch["parse"]).to_pylist())
        for parse in batch["parse"].to_pylist():
            for *place, runs in locate_cell(next(texts)) if parse else ():
                placed.append(place)
                pieces += runs
                ends.append(len(pieces))
            rows.append(len(placed))
        columns = list(zip(*placed)) or [[]] * len(types)
        runs = list(zip(*pieces)) or [[], [], []]
        runs = pa.StructArray.from_arrays([pa.array(r, pa.int32()) for r in runs], names=["v", "s", "n"])
        places = pa.StructArray.from_arrays([*(pa.array(c, t) for c, t in zip(columns, types)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs)],
                                            names=[*names, "pieces"])
        kept = [c for c in batch.schema.names if c != "parse"]
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.ListArray.from_arrays(pa.array(rows, pa.int32()), places)], names=[*kept, "placed"])


def _sql_places(found: F.Column, text: F.Column, start: F.Column) -> F.Column:
    """What an edit may name at one place of SQL text: (key, start, end). A column qualifier gives its first two
    and three parts; a bare `db.t` counts when `.*` follows."""
    plain = Q.plain_name(found["text"])

    def place(key: F.Column, wanted: F.Column) -> F.Column:
        return F.when(wanted, F.struct(key.alias("key"), start.alias("start"), (start + F.length(key)).alias("end")))

    whole = F.struct(plain.alias("key"), start.alias("start"), (start + F.length(found["text"])).alias("end"))
    path = F.struct(found["text"].alias("key"), start.alias("start"), (start + F.length(found["text"])).alias("end"))
    two, three = F.substring_index(plain, ".", 2), F.substring_index(plain, ".", 3)
    tight = plain == found["text"]
    star = F.substring(text, found["at"] + F.length(found["text"]) + 1, F.lit(2)) == ".*"
    return (F.when(found["role"] == "T", F.array(whole)).when(found["role"] == "P", F.array(path))
            .otherwise(F.array_compact(F.array(place(two, tight & ((two != plain) | star)), place(three, tight & (three != two) & ((three != plain) | star))))))


def with_places(cells: DataFrame, wanted: F.Column) -> DataFrame:
    """The rows + `places`: array of (key, start, end, how) of every place in a wanted cell's `text` that a reference named
    `key` takes; `how`: inside (of a string, or in SQL), literal (a whole string literal), expression. SQL cells are read natively, magic
    prefixes included; Python cells by the syntax job, whose `.sql` texts are read natively and carried back to the places their
    characters have in the cell. Other rows pass through the job, so nothing above it is worked out twice."""
    parse = wanted & (F.col("language") == "python") & F.col("text").rlike(P.PY_PREFILTER_RE)
    rows = cells.withColumns({"reads_sql": F.coalesce(wanted & (F.col("language") == "sql"), F.lit(False)), "parse": F.coalesce(parse, F.lit(False))})
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "parse")
    rows = rows.mapInArrow(_locate_batches, schema=f"{kept}, placed {_PLACED}")

    def all_places(found: F.Column, places_of) -> F.Column:
        return F.filter(F.flatten(F.transform(found, places_of)), lambda p: p["start"].isNotNull())

    def in_string(p: F.Column) -> F.Column:
        """What was found in a `.sql` text, placed in the cell: inside one run of its characters, or not at all."""
        def carried(f: F.Column) -> F.Column:
            end = f["at"] + F.length(f["text"])
            run = F.try_element_at(F.filter(p["pieces"], lambda r: (r["v"] <= f["at"]) & (r["v"] + r["n"] >= end)), F.lit(1))
            return _sql_places(f, p["text"], run["s"] + f["at"] - run["v"])
        return all_places(Q.read_sql(p["text"], True)["found"], carried)

    def marked(places: F.Column, how: F.Column) -> F.Column:
        return F.transform(places, lambda q: F.struct(q["key"].alias("key"), q["start"].alias("start"), q["end"].alias("end"), how.alias("how")))

    def of_node(p: F.Column) -> F.Column:
        own = F.array(F.struct(p["text"].alias("key"), p["start"].alias("start"), p["end"].alias("end")))
        how = (F.when(p["kind"].isin("dynamic_table", "dynamic_mount"), "expression")
               .when(p["whole"] & (p["kind"] != "py_sql"), "literal").otherwise("inside"))
        return marked(F.when(p["kind"] == "py_sql", in_string(p)).otherwise(own), how)

    text = F.col("text")
    sql = marked(all_places(Q.read_sql(text, True)["found"], lambda f: _sql_places(f, text, f["at"])), F.lit("inside"))
    places = F.when(F.col("reads_sql"), sql).otherwise(F.flatten(F.transform("placed", of_node)))
    return rows.select(*cells.columns, places.alias("places"))


def reference_places(chunks: DataFrame) -> DataFrame:
    """asset_path, cell_index, key, start, end, how of every place in a cell's text that a reference named `key` takes."""
    cells = with_places(chunks.filter(F.col("cell_index").isNotNull()), F.lit(True))
    return (cells.select("asset_path", "cell_index", F.explode_outer("places").alias("p")).filter(F.col("p").isNotNull())
            .select("asset_path", "cell_index", "p.key", "p.start", "p.end", "p.how"))


_CUTS = "array<struct<after:int,start:int,end:int,key:string,put:string>>"


def splices(places: F.Column, originals: F.Column, finals: F.Column) -> F.Column:
    """A cell's edits at its places, in order: array of (after, start, end, key, put), `after` being the end of the one before.
    Where places lie inside one another the outer one is edited. A literal that is replaced whole gets its final quoted;
    inside quotes, and in SQL, a final with quotes or line ends would not stay one name and is not put."""
    def put(p: F.Column) -> F.Column:
        def quoted(final: F.Column) -> F.Column:
            plain = (p["how"] != "inside") | ~final.rlike(r"[\"'\\\r\n]")
            text = F.when(p["how"] == "literal", F.concat(F.lit('"'), F.regexp_replace(final, r'(["\\])', r"\\$1"), F.lit('"'))).otherwise(final)
            return F.when(plain, F.struct(p["start"].alias("start"), (-p["end"]).alias("back"), p["key"].alias("key"), text.alias("put")))
        at = F.array_position(originals, p["key"])
        return Q.bound(F.when(at > 0, F.get(finals, (at - 1).cast("int"))), quoted)

    met = F.array_sort(F.array_distinct(F.filter(F.transform(places, put), lambda m: m.isNotNull())))
    nothing = F.struct(F.lit(0).alias("reach"), F.lit(0).alias("after"), F.lit(-1).alias("start"), F.lit(-1).alias("end"), F.array().cast(_CUTS).alias("cuts"))

    def step(a: F.Column, m: F.Column) -> F.Column:
        end = -m["back"]
        fits = (m["start"] >= a["reach"]) & ~((m["start"] == a["start"]) & (end == a["end"]))
        cut = F.struct(a["after"].alias("after"), m["start"].alias("start"), end.alias("end"), m["key"].alias("key"), m["put"].alias("put"))
        return F.struct(F.greatest(a["reach"], end).alias("reach"), F.when(fits, end).otherwise(a["after"]).alias("after"), m["start"].alias("start"),
                        end.alias("end"), F.when(fits, F.concat(a["cuts"], F.array(cut))).otherwise(a["cuts"]).alias("cuts"))

    return F.aggregate(met, nothing, step, lambda a: a["cuts"])


def rewrite_places(assets: DataFrame, maps: DataFrame) -> DataFrame:
    """asset_path, language, source -> + new_source, hit_keys. Only cells with splices change; every other
    character stays, so untouched text is byte-identical. A cell's row carries its own edits, so places and edits meet in it."""
    own = F.filter("edit_list", lambda e: e["c"] == F.col("cell_index"))
    chunks = cell_chunks(assets).join(maps, "asset_path").select(
        "asset_path", "pos", "head", "text", "tail", "cell_index", "language",
        F.transform(own, lambda e: e["o"]).alias("originals"), F.transform(own, lambda e: e["f"]).alias("finals"))
    cells = with_places(chunks, F.size("originals") > 0)
    cells = cells.withColumn("cuts", F.when(F.size("places") > 0, splices(F.col("places"), F.col("originals"), F.col("finals"))))
    # a cell's new text: before each cut what stands since the cut before it, then the rest
    parts = F.transform("cuts", lambda c: F.concat(F.substring("text", c["after"] + 1, c["start"] - c["after"]), c["put"]))
    rest = F.substring("text", F.try_element_at("cuts", F.lit(-1))["end"] + 1, F.length("text"))
    whole = F.concat(F.array_join(parts, ""), rest)
    hits = F.array_distinct(F.transform("cuts", lambda c: edit_key(F.col("cell_index"), c["key"])))
    cut = F.size("cuts") > 0
    built = (cells.select("asset_path", "pos", F.concat("head", F.when(cut, whole).otherwise(F.col("text")), "tail").alias("text"), F.when(cut, hits).alias("hits"))
             .groupBy("asset_path").agg(
                 F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda c: c["text"]), "").alias("body"),
                 F.flatten(F.collect_list("hits")).alias("hit_keys")))
    return assets.join(built, "asset_path").select(*assets.columns, F.concat(X.header_of(F.col("source")), F.col("body")).alias("new_source"), "hit_keys")


def rewrite_assets(assets: DataFrame, maps: DataFrame, method: str = "places") -> DataFrame:
    """(asset_path, language, source, new_source, hit_keys) for assets with edits."""
    from ..plans.partitioning import materialize, spread
    if method == "literal":
        j = spread(assets.select("asset_path", "language", "source"), "asset_path").join(maps, "asset_path")
        return j.select("asset_path", "language", "source",
                        rewrite_literal_col(F.col("source"), F.col("edit_list")).alias("new_source"),
                        F.filter(F.transform("edit_list", lambda e: e["o"]),
                                 lambda o: F.col("source").contains(o)).alias("hit_originals"))
    # written once: the texts are read by two branches
    texts = materialize(assets.select("asset_path", "language", "source").join(maps.select("asset_path"), "asset_path", "left_semi"), "edited")
    return rewrite_places(spread(texts, "asset_path"), maps)


# ---- backups, stamps, totals, restore (A4-A7) -------------------------------- #
def backup_path(root: str, asset_path: F.Column, stamp: str) -> F.Column:
    """A4 with fix 23: the name carries md5(path), so `a/b__c` and `a__b/c` differ."""
    safe = F.replace(F.regexp_replace(asset_path, r"^/+|/+$", ""), F.lit("/"), F.lit("__"))
    return F.concat(F.lit(root.rstrip("/") + "/"), F.md5(asset_path), F.lit("/"), safe,
                    F.lit(f"__{stamp}.py"))


def outcomes(edits: DataFrame, rewritten: DataFrame, conflicts: DataFrame, method: str = "places") -> DataFrame:
    """Per manifest row of the work set: applied | not_found | conflict (fix 16: a row
    whose original is not in its cell is not stamped applied)."""
    if method == "literal":
        hit = (rewritten.select("asset_path", F.explode_outer("hit_originals").alias("original_reference"))
               .filter(F.col("original_reference").isNotNull()).distinct().withColumn("_hit", F.lit(True)))
        c = conflicts.withColumn("_conflict", F.lit(True))
        e = (edits.join(hit, ["asset_path", "original_reference"], "left")
             .join(c, ["asset_path", "cell_index", "original_reference"], "left"))
    else:
        # explode_outer + a filter on its output: a plain explode makes Catalyst infer a
        # size(hit_keys) > 0 filter below the projection, evaluating the rewrite twice.
        hit = (rewritten.select("asset_path", F.explode_outer("hit_keys").alias("_key"))
               .filter(F.col("_key").isNotNull()).select("asset_path", "_key", F.lit(True).alias("_hit"), F.lit(None).cast("boolean").alias("_conflict")))
        clash = conflicts.select("asset_path", edit_key(F.col("cell_index"), F.col("original_reference")).alias("_key"),
                                 F.lit(None).cast("boolean").alias("_hit"), F.lit(True).alias("_conflict"))
        marks = hit.unionByName(clash).groupBy("asset_path", "_key").agg(F.max("_hit").alias("_hit"), F.max("_conflict").alias("_conflict"))
        e = (edits.withColumn("_key", edit_key(F.col("cell_index"), F.col("original_reference")))
             .join(marks, ["asset_path", "_key"], "left"))
    return e.select("manifest_id", "reference_kind", "asset_path",
                    F.when(F.col("_conflict"), F.lit("conflict"))
                    .when(F.col("_hit"), F.lit("applied")).otherwise(F.lit("not_found")).alias("outcome"))


def stamp_applied(manifest: DataFrame, outcome: DataFrame, applied_at: str, backup_root: str,
                  stamp: str) -> DataFrame:
    """A5: applied rows get status, time and backup path; the decision stays in
    `decision` (fix 27)."""
    applied = outcome.filter(F.col("outcome") == "applied").select("manifest_id", "reference_kind") \
        .withColumn("_applied", F.lit(True))
    j = manifest.join(applied, ["manifest_id", "reference_kind"], "left")
    hit = F.coalesce(F.col("_applied"), F.lit(False)) & is_legal(F.col("status"), F.lit("applied"))
    cols = []
    for c in manifest.columns:
        if c == "status":
            cols.append(F.when(hit, F.lit("applied")).otherwise(F.col(c)).alias(c))
        elif c == "applied_at":
            cols.append(F.when(hit, F.to_timestamp(F.lit(applied_at))).otherwise(F.col(c)).alias(c))
        elif c == "backup_path":
            cols.append(F.when(hit, backup_path(backup_root, F.col("asset_path"), stamp))
                        .otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


def apply_totals(outcome: DataFrame, rewritten: DataFrame) -> DataFrame:
    """One row of totals."""
    o = outcome.agg(
        F.count(F.when(F.col("outcome") == "applied", 1)).alias("references_applied"),
        F.countDistinct(F.when(F.col("outcome") == "applied", F.col("asset_path"))).alias("assets_applied"),
        F.count(F.when(F.col("outcome") == "not_found", 1)).alias("references_not_found"),
        F.count(F.when(F.col("outcome") == "conflict", 1)).alias("references_conflicting"))
    return o


def backups_of(rewritten: DataFrame, backup_root: str, stamp: str) -> DataFrame:
    """S11 rows: the original text of every asset in the work set, before any rewrite."""
    return rewritten.select("asset_path", "source", backup_path(backup_root, F.col("asset_path"), stamp)
                            .alias("backup_path"), F.lit(stamp).alias("stamp"))


def before_cut_off_round(assets: DataFrame, backups: DataFrame, manifest: DataFrame, stamp: str) -> DataFrame:
    """The assets, with the backed-up text for those that round `stamp` backed up but has no applied row of: the
    round was cut off before its commit, and its patched text must not be taken for the text before it. Assets with a
    later round stay as they are."""
    mine = backups.filter(F.col("stamp") == stamp)
    if mine.isEmpty():
        return assets
    mine = mine.join(backups.filter(F.col("stamp") > stamp).select("asset_path"), "asset_path", "left_anti")
    done = manifest.filter(F.col("status").isin("applied", "failed")).select("backup_path").distinct()
    open_ = mine.join(done, "backup_path", "left_anti").select("asset_path", F.col("source").alias("_before")).dropDuplicates(["asset_path"])
    return assets.join(open_, "asset_path", "left").select(
        *[F.coalesce("_before", "source").alias("source") if c == "source" else F.col(c) for c in assets.columns])


def restore_sources(backups: DataFrame, since: str | None = None) -> DataFrame:
    """A7, as of a round: per asset the text before the first round at or after `since`, or before its last
    round; `stamp` is that round (only stamps are aggregated, not texts). Assets without such a round are not among them."""
    if since is None:
        at = backups.groupBy("asset_path").agg(F.max("stamp").alias("stamp"))
    else:
        at = backups.filter(F.col("stamp") >= since).groupBy("asset_path").agg(F.min("stamp").alias("stamp"))
    return backups.join(at, ["asset_path", "stamp"]).select("asset_path", "source", "stamp")


def restore_manifest(manifest: DataFrame, restored: DataFrame, backups: DataFrame) -> DataFrame:
    """Applied and failed rows of the rounds that `restored` (asset_path, stamp) takes back go to their stored
    decision. A row's round is that of the backup it names; rows of earlier rounds stay."""
    rounds = backups.select("backup_path", F.col("stamp").alias("_round")).distinct()
    r = restored.select("asset_path", F.col("stamp").alias("_since")).distinct()
    j = manifest.join(rounds, "backup_path", "left").join(r, "asset_path", "left")
    back = F.coalesce(F.col("_round") >= F.col("_since"), F.lit(False)) & F.col("decision").isin("approved", "overridden") \
        & F.col("status").isin("applied", "failed") & is_legal(F.col("status"), F.col("decision"))
    nothing = {"applied_at": "timestamp", "backup_path": "string"}
    return j.select(*[
        F.when(back, F.col("decision")).otherwise(F.col(c)).alias(c) if c == "status"
        else F.when(back, F.lit(None).cast(nothing[c])).otherwise(F.col(c)).alias(c) if c in nothing
        else F.col(c) for c in manifest.columns])
