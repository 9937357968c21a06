"""Review queues, guarded status changes, candidates and context.

Each status change is a projection `when(guard, new).otherwise(old)` over the manifest:
the reference's UPDATE statements become one pass each, and many reviewer decisions are
applied at once by a join on the manifest key (no per-row UPDATE).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import patterns as P
from ..functions import text as X
from .manifest import KEY, conform, ts
from .resolve import mount_lookup, namespace_lookup, table_lookup

_LEGAL = [f"{a}>{b}" for a, b in S.LEGAL_MOVES]


def is_legal(old: F.Column, new: F.Column) -> F.Column:
    """The (old, new) status pair is one of the legal moves."""
    return F.concat_ws(">", old, new).isin(*_LEGAL)


def _blank(c: F.Column) -> F.Column:
    return c.isNull() | (F.trim(c) == "")


# ---- queues (V1-V3) --------------------------------------------------------- #
def _ordered(rows: DataFrame, *keys: str) -> DataFrame:
    """`rows` by `keys`. They are written once before: a sort by ranges reads its input twice, first for a sample, and would
    work out a scan that comes lazily twice."""
    from ..plans.partitioning import materialize
    return materialize(rows, "queue").orderBy(*keys)


def queue_high(manifest: DataFrame, min_conf: float = S.TIER_SIMPLE_MIN) -> DataFrame:
    """V1: proposed rows at or above the simple threshold, by asset and cell."""
    rows = (manifest.filter((F.col("confidence") >= min_conf) & (F.col("status") == "proposed"))
            .select("manifest_id", "asset_path", "cell_index", "original_reference",
                    "proposed_replacement", "confidence"))
    return _ordered(rows, "asset_path", "cell_index")


def queue_medium(manifest: DataFrame) -> DataFrame:
    """V2: proposed rows in [0.45, 0.85), by confidence."""
    rows = (manifest.filter((F.col("confidence") >= S.TIER_COMPLEX_MIN)
                            & (F.col("confidence") < S.TIER_SIMPLE_MIN)
                            & (F.col("status") == "proposed"))
            .select("manifest_id", "asset_path", "cell_index", "original_reference",
                    "proposed_replacement", "confidence", "reference_kind"))
    return _ordered(rows, "confidence")


def queue_low(manifest: DataFrame) -> DataFrame:
    """V3 (fix 30): every proposed row below 0.45, whatever its kind, with its reason."""
    rows = (manifest.filter((F.col("confidence") < S.TIER_COMPLEX_MIN) & (F.col("status") == "proposed"))
            .select("manifest_id", "asset_path", "cell_index", "original_reference", "reference_kind",
                    "confidence", "reason"))
    return _ordered(rows, "confidence", "asset_path", "cell_index")


# ---- batch approve (V4) ----------------------------------------------------- #
def approvable(min_conf: float = S.TIER_SIMPLE_MIN) -> F.Column:
    """The row is one that V4 approves."""
    return ((F.col("confidence") >= min_conf) & (F.col("status") == "proposed")
            & ~_blank(F.col("proposed_replacement")))


def batch_approvable(manifest: DataFrame, min_conf: float = S.TIER_SIMPLE_MIN) -> DataFrame:
    """The rows that V4 approves."""
    return manifest.filter(approvable(min_conf))


def batch_approve(manifest: DataFrame, reviewer: str, as_of: str,
                  min_conf: float = S.TIER_SIMPLE_MIN) -> DataFrame:
    """V4: final := proposed for proposed rows at or above `min_conf`; idempotent, since
    only rows still 'proposed' move. Rows without a proposal stay (fix 19)."""
    hit = approvable(min_conf)
    upd = {
        "status": F.lit("approved"),
        "final_replacement": F.col("proposed_replacement"),
        "reviewer": F.lit(reviewer),
        "reviewed_at": ts(as_of),
        "decision": F.lit("approved"),
    }
    return conform(manifest.select(*[
        F.when(hit, upd[c]).otherwise(F.col(c)).alias(c) if c in upd else F.col(c)
        for c in manifest.columns]))


# ---- decisions (V5-V7, V13) -------------------------------------------------- #
def latest_decisions(decisions: DataFrame) -> DataFrame:
    """One decision per manifest key: the latest by reviewed_at (ties: greatest values)."""
    return (decisions.groupBy(*KEY).agg(F.max(F.struct(*PAYLOAD)).alias("d"))
            .select(*KEY, F.lit(True).alias("d_given"), F.col("d.decision").alias("d_decision"),
                    F.col("d.final_replacement").alias("d_final"),
                    F.col("d.reviewer").alias("d_reviewer"),
                    F.col("d.reviewed_at").alias("d_reviewed_at")))


PAYLOAD = ["reviewed_at", "decision", "final_replacement", "reviewer"]


def superseded_decisions(decisions: DataFrame, latest: DataFrame) -> DataFrame:
    """Decisions that a later one for the same key replaces (equal rows count once)."""
    last = latest.select(*[F.col(c).alias(f"_{c}") for c in KEY], F.struct(
        "d_reviewed_at", "d_decision", "d_final", "d_reviewer").alias("_last"))
    mine = F.struct(*PAYLOAD)
    cond = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in KEY]
    return (decisions.select(*KEY, *PAYLOAD).distinct().join(last, cond)
            .filter(~mine.eqNullSafe(F.col("_last").cast("struct<reviewed_at:timestamp,decision:string,final_replacement:string,reviewer:string>")))
            .select(*KEY, *PAYLOAD))


def apply_decisions(manifest: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """V5-V7 with V13's guard. Returns (next manifest, rejected decisions).

    approved: final = the given value, or the proposal when none is given.
    overridden: final = the given value. skipped: final stays NULL.
    A decision is rejected when none is given or it is unknown, when the move is not legal
    (fix 20), when an approve or override would store a blank final (fix 19), when no
    manifest row has its key, or when a later decision for the key replaces it."""
    d = latest_decisions(decisions)
    m = manifest.alias("m")
    j = m.join(d.alias("d"), KEY, "full_outer")
    dec = F.col("d_decision")
    given = F.coalesce(F.col("d_given"), F.lit(False))
    final = (F.when(dec == "approved", F.coalesce(F.nullif(F.trim(F.col("d_final")), F.lit("")),
                                                  F.col("proposed_replacement")))
             .when(dec == "overridden", F.col("d_final")))
    reject_reason = (F.when(F.col("status").isNull(), F.lit("no manifest row with this key"))
                     .when(dec.isNull(), F.lit("no decision given"))
                     .when(~dec.isin(*S.REVIEW_DECISIONS), F.lit("unknown decision"))
                     .when(~is_legal(F.col("status"), dec), F.concat(F.lit("illegal move "), F.col("status"),
                                                                     F.lit(" -> "), dec))
                     .when(dec.isin("approved", "overridden") & _blank(final), F.lit("blank final replacement")))
    j = j.withColumn("_final", final).withColumn("_reject", F.when(given, reject_reason))
    ok = given & F.col("_reject").isNull()
    upd = {
        "status": dec,
        "final_replacement": F.col("_final"),
        "reviewer": F.col("d_reviewer"),
        "reviewed_at": F.col("d_reviewed_at"),
        "decision": dec,
    }
    nxt = conform(j.filter(F.col("status").isNotNull()).select(*[
        F.when(ok, upd[f.name]).otherwise(F.col(f.name)).alias(f.name) if f.name in upd
        else F.col(f.name) for f in S.MANIFEST.fields]))
    rejects = j.filter(F.col("_reject").isNotNull()).select(
        *KEY, F.col("status").alias("current_status"), F.col("d_decision").alias("decision"),
        F.col("d_final").alias("final_replacement"), F.col("d_reviewer").alias("reviewer"),
        F.col("_reject").alias("reject_reason"))
    old = superseded_decisions(decisions, d)
    status = manifest.select(*[F.col(c).alias(f"_{c}") for c in KEY], F.col("status").alias("current_status"))
    cond = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in KEY]
    rejects = rejects.unionByName(old.join(status, cond, "left").select(
        *KEY, "current_status", "decision", "final_replacement", "reviewer",
        F.lit("superseded by a later decision").alias("reject_reason")))
    return nxt, rejects


def status_counts(manifest: DataFrame) -> DataFrame:
    """V8."""
    return manifest.groupBy("status").agg(F.count(F.lit(1)).alias("n")).orderBy("status")


# ---- candidates (V9, V10) ---------------------------------------------------- #
def dynamic_mount_pattern(original: F.Column) -> F.Column:
    """LIKE pattern of a dynamic mount: the literal body, its own backslash, `_` and `%`
    escaped, with each {field} as '%'."""
    body = F.regexp_replace(X.literal_body(original), X.rx(r"([\\_%])"), F.lit(r"\\$1"))
    return F.regexp_replace(body, X.rx(P.FSTRING_FIELD_RE), F.lit("%"))


def dynamic_mounts(manifest: DataFrame) -> DataFrame:
    """Dynamic mount references with the LIKE pattern of their mount."""
    return manifest.filter(F.col("reference_kind") == "dynamic_mount").select(
        "manifest_id", "reference_kind", "asset_path", "cell_index", "original_reference",
        F.regexp_extract(dynamic_mount_pattern(F.col("original_reference")), P.MOUNT_PATTERN_RE, 1).alias("mount_pattern"))


def mount_pattern_matches(manifest: DataFrame, mounts: DataFrame) -> DataFrame:
    """V9, first half: (mount_pattern, candidate_mount, candidate_namespace) for each distinct
    pattern. Patterns meet mounts by an equi-join of their literal text before the first
    wildcard with the prefixes of each mount path, then LIKE. References point to their
    pattern, so nothing is repeated per reference."""
    head = F.regexp_extract(F.col("mount_pattern"), r"^((?:[^\\%_]|\\.)*+)", 1)
    pats = dynamic_mounts(manifest).select("mount_pattern").distinct() \
        .withColumn("literal_head", F.regexp_replace(head, r"\\(.)", "$1"))
    reg = (mounts.filter(F.col("mount_path").isNotNull())
           .select("mount_path", "hms_namespace",
                   F.explode(F.sequence(F.lit(1), F.length("mount_path"))).alias("_n"))
           .withColumn("literal_head", F.expr("substring(mount_path, 1, _n)")))
    return (pats.join(reg, "literal_head").filter(F.expr("mount_path LIKE mount_pattern"))
            .select("mount_pattern", F.col("mount_path").alias("candidate_mount"),
                    F.col("hms_namespace").alias("candidate_namespace")).distinct())


def assigned_strings(cells: DataFrame) -> DataFrame:
    """asset_path, cell_index, name, values: the distinct strings assigned to a name in a Python cell."""
    python = cells.filter((F.col("language") == "python") & F.col("code").rlike(P.ASSIGNED_STRING_RE)) if "language" in cells.columns else cells
    pairs = F.arrays_zip(F.regexp_extract_all("code", X.rx(P.ASSIGNED_STRING_RE), F.lit(1)).alias("name"),
                         F.regexp_extract_all("code", X.rx(P.ASSIGNED_STRING_RE), F.lit(2)).alias("value"))
    rows = (python.select("asset_path", "cell_index", F.explode_outer(pairs).alias("p")).filter(F.col("p").isNotNull()))
    return rows.groupBy("asset_path", "cell_index", F.col("p.name").alias("name")).agg(F.collect_set("p.value").alias("values"))


def last_assigned(uses: DataFrame, cells: DataFrame) -> DataFrame:
    """`uses` (asset_path, cell_index, name, ...) + values: the strings assigned to the name in its cell, else in the
    last cell before it that assigns it; null when none does. Assignments and uses of a name in a notebook are put in the
    order of its cells and the last assignment is carried on, so the work is linear in both."""
    rest = [c for c in uses.columns if c not in ("asset_path", "cell_index", "name")]
    own = F.struct(*rest) if rest else F.struct(F.lit(1).alias("_"))
    made = assigned_strings(cells).select("asset_path", "name", "cell_index", F.lit(0).alias("_use"), "values")
    used = uses.select("asset_path", "name", "cell_index", F.lit(1).alias("_use"), own.alias("_rest"))
    both = made.unionByName(used, allowMissingColumns=True)
    order = Window.partitionBy("asset_path", "name").orderBy("cell_index", "_use").rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("values", F.last("values", ignorenulls=True).over(order)).filter("_use = 1")
    return carried.select("asset_path", "cell_index", "name", *[F.col(f"_rest.{c}").alias(c) for c in rest], "values")


def candidates_mount(manifest: DataFrame, cells: DataFrame, mounts: DataFrame) -> DataFrame:
    """V9, second half: one row per reference and mount it names. Each distinct string assigned to the field
    in the mount's name, in the same cell or else in the last cell before that assigns it, names a mount (an equi-join with the
    registry); the others keep their pattern, whose candidates are `mount_pattern_matches`."""
    body = X.literal_body(F.col("original_reference"))
    refs = dynamic_mounts(manifest).withColumn("name", F.regexp_extract(body, P.MOUNT_FIELD_RE, 2))
    refs = last_assigned(refs, cells)
    named = F.transform("values", lambda v: F.regexp_extract(F.concat(
        F.regexp_extract(body, P.MOUNT_FIELD_RE, 1), v, F.regexp_extract(body, P.MOUNT_FIELD_RE, 3)), P.MOUNT_PREFIX_RE, 1))
    refs = refs.select("*", F.explode_outer(F.array_distinct(F.when(F.col("name") != "", named))).alias("named_mount"))
    reg = mounts.filter(F.col("mount_path").isNotNull()).select(
        F.col("mount_path").alias("named_mount"), F.col("mount_path").alias("candidate_mount"),
        F.col("hms_namespace").alias("candidate_namespace")).distinct()
    return refs.join(reg, "named_mount", "left").select(
        "manifest_id", "reference_kind", "asset_path", "cell_index", "original_reference", "mount_pattern",
        "named_mount", "candidate_mount", "candidate_namespace")


def candidates_table(manifest: DataFrame, cells: DataFrame, mapping: DataFrame) -> DataFrame:
    """For a dynamic table, names in its cell, and strings that the expression's variables were last assigned in a cell
    before, that are mapped namespaces (paired with the constant `.suffix` of the expression when there is one) or
    mapped tables."""
    key = ["manifest_id", "reference_kind", "asset_path", "cell_index", "original_reference", "suffix"]
    dyn = manifest.filter(F.col("reference_kind") == "dynamic_table").select(
        "manifest_id", "reference_kind", "asset_path", "cell_index", "original_reference",
        F.regexp_extract("original_reference", P.DYNAMIC_SUFFIX_RE, 1).alias("suffix"))
    code = cells.select("asset_path", "cell_index", "code")
    near = (dyn.join(code, ["asset_path", "cell_index"])
            .select(*key, F.explode_outer(F.array_distinct(F.regexp_extract_all("code", X.rx(P.IDENT_RE), F.lit(0)))).alias("token")))
    words = F.array_distinct(F.regexp_extract_all("original_reference", X.rx(r"[A-Za-z_]\w*"), F.lit(0)))
    far = last_assigned(dyn.select("*", F.explode_outer(words).alias("name")).filter(F.col("name").isNotNull()), cells)
    far = far.select(*key, F.explode_outer("values").alias("token"))
    toks = near.unionByName(far).filter(F.col("token").isNotNull()).withColumn("_tok", F.lower("token"))
    nsl = namespace_lookup(mapping).filter(F.col("ns_schema").isNotNull())
    tl = table_lookup(mapping).filter(F.col("t_target").isNotNull())
    by_ns = (toks.join(nsl, toks["_tok"] == nsl["_lk_ns"])
             .withColumn("_ns", F.col("_lk_ns")).withColumn("_tbl", F.lower("suffix"))
             .join(tl, ["_ns", "_tbl"], "left")
             .select("manifest_id", "reference_kind", "asset_path", "cell_index", "original_reference",
                     F.col("token").alias("candidate_namespace"),
                     F.coalesce(F.col("t_target"),
                                F.when(F.col("suffix") != "",
                                       F.concat_ws(".", "ns_catalog", "ns_schema", "suffix")))
                     .alias("candidate_target")))
    tl_keyed = tl.withColumn("_tok", F.concat_ws(".", "_ns", "_tbl"))
    by_table = (toks.join(tl_keyed, "_tok")
                .select("manifest_id", "reference_kind", "asset_path", "cell_index", "original_reference",
                        F.element_at(F.split("token", r"\."), 1).alias("candidate_namespace"),
                        F.col("t_target").alias("candidate_target")))
    return by_ns.unionByName(by_table).distinct()


def cell_context(manifest: DataFrame, cells: DataFrame) -> DataFrame:
    """V11 + V12: a manifest row with the code of its cell and the reason for its score."""
    return (manifest.select("manifest_id", "reference_kind", "asset_path", "cell_index", "original_reference",
                            "confidence", "reason")
            .join(cells.select("asset_path", "cell_index", "language", "code"),
                  ["asset_path", "cell_index"], "left"))
