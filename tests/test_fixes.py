"""
number), plus the SQL-name edge cases of FIXTURES.md section 6."""
import pyspark.sql.functions as F
import pytest

from assetscan import schemas as S
from assetscan.operators import manifest as M
from assetscan.operators import reconcile as RC
from assetscan.operators import review as RV
from assetscan.operators import rewrite as RW
from assetscan.operators import audit as AU
from assetscan.sources import demo as DM
from helpers import NB, SEP, assets_of, cells_of, propose, refs_of, scan_of

AS_OF = "2024-01-01 00:00:00"


def test_fix01_dbfs_subpath(spark):
    p = propose(spark, "mount_path_literal", "dbfs:/mnt/finance-raw/gl")
    assert p.proposed_replacement == "/Volumes/main/uc_migration_target/finance_raw/gl"


def test_fix02_unparsable_python_is_reported(spark):
    refs = refs_of(spark, NB + SEP + 'spark.table("a.b"\nx = (')
    assert [r.reference_kind for r in refs] == [S.KIND_UNPARSED]
    assert propose(spark, S.KIND_UNPARSED, "").confidence == S.SCORE_UNRESOLVED


def test_fix03_sql_marker_on_query_line_keeps_query(spark):
    refs = refs_of(spark, NB + SEP + "%sql SELECT * FROM risk_db.exposures")
    assert [(r.reference_kind, r.original_reference) for r in refs] == [("sql_table_ref", "risk_db.exposures")]


def test_fix04_sql_in_a_comment_is_not_a_magic(spark):
    cells = cells_of(spark, NB + SEP + "# run this like %sql later\nx = spark.table('a.b')")
    assert cells[0].language == "python"


def test_fix05_other_magics_keep_their_language(spark):
    cells = cells_of(spark, NB + SEP + '# MAGIC %scala\n# MAGIC spark.table("db.t")' + SEP + "# MAGIC %md\n# MAGIC # Title")
    assert [c.language for c in cells] == ["scala", "md"]
    refs = refs_of(spark, NB + SEP + '# MAGIC %scala\n# MAGIC spark.table("db.t")' + SEP + "# MAGIC %md\n# MAGIC table")
    assert [r.reference_kind for r in refs] == [S.KIND_UNPARSED]


def test_fix06_crlf_sources_split(spark):
    src = "# Databricks notebook source\r\n\r\n# COMMAND ----------\r\n\r\nprint(1)\r\n\r\n# COMMAND ----------\r\n\r\nprint(2)"
    assert [c.code for c in cells_of(spark, src)] == ["print(1)", "print(2)"]


def test_fix07_blank_lines_before_header(spark):
    src = "\n\n" + NB + SEP + "print(1)"
    assert [c.code for c in cells_of(spark, src)] == ["print(1)"]


def test_fix08_duplicates_grouped_with_occurrences(spark):
    rows = scan_of(spark, NB + SEP + "# MAGIC %sql\n# MAGIC SELECT * FROM risk_db.exposures a JOIN risk_db.exposures b ON a.id = b.id")
    assert len(rows) == 1 and rows[0].occurrences == 2


def test_fix09_legacy_catalog_and_qualified_names(spark):
    rows = scan_of(spark, NB + SEP + "# MAGIC %sql\n# MAGIC SELECT * FROM hive_metastore.risk_db.exposures JOIN main.s.t")
    assert [(r.original_reference, r.proposed_replacement) for r in rows] == [
        ("hive_metastore.risk_db.exposures", "main.uc_migration_target.exposures")]


def test_fix10_lookup_ignores_case(spark):
    p = propose(spark, "py_table_ref", "Risk_DB.Exposures")
    assert p.proposed_replacement == "main.uc_migration_target.exposures" and p.original_reference == "Risk_DB.Exposures"


def test_fix11_ambiguous_mapping_gives_no_proposal(spark):
    mapping = DM.demo_mapping(spark).unionByName(spark.createDataFrame(
        [("risk_db", "exposures", "main", "other", "exposures", None, None)], S.MAPPING))
    p = propose(spark, "sql_table_ref", "risk_db.exposures", mapping=mapping)
    assert p.proposed_replacement is None and p.confidence == S.SCORE_UNRESOLVED and p.reason.startswith("ambiguous")


def test_fix12_registry_row_without_namespace(spark):
    mounts = spark.createDataFrame([("/mnt/x", None, "", None)], S.MOUNTS)
    p = propose(spark, "mount_path_literal", "/mnt/x/y", mounts=mounts)
    assert p.proposed_replacement is None and p.reason == "mount has no namespace"


def test_r6_dynamic_mount_with_empty_registry(spark):
    p = propose(spark, "dynamic_mount", 'f"/mnt/{m}/x"', mounts=spark.createDataFrame([], S.MOUNTS))
    assert p.confidence == S.SCORE_UNRESOLVED


@pytest.mark.parametrize("sql,expected", [
    ("SELECT * FROM a.x, b.y WHERE 1=1", ["a.x", "b.y"]),
    ("SELECT * FROM a.x ax, b.y AS by_ JOIN c.z ON 1=1", ["a.x", "b.y", "c.z"]),
    ("SELECT '-- FROM no.pe' AS s FROM a.x -- FROM no.pe2", ["a.x"]),
    ("SELECT extract(year from o.ts), trim(x from o.c) FROM a.x o", ["a.x"]),
    ("INSERT INTO TABLE a.t SELECT * FROM b.s", ["a.t", "b.s"]),
    ("DROP TABLE IF EXISTS a.t", ["a.t"]),
    ("WITH c AS (SELECT * FROM a.x) SELECT * FROM c", ["a.x"]),
    ("MERGE INTO a.t USING b.s ON a.t.id = b.s.id WHEN MATCHED THEN DELETE", ["a.t", "b.s"]),
    ("SELECT * FROM `a`.`x`", ["`a`.`x`"]),
    ("UPDATE a.t SET x = 1", ["a.t"]),
    ("SELECT * FROM (SELECT 1 FROM a.t) s, b.t2", ["a.t", "b.t2"]),
    ("SELECT * FROM a.t TABLESAMPLE (5 PERCENT) x, b.u", ["a.t", "b.u"]),
    ("SELECT * FROM a.a JOIN a.b ON a.a.id = a.b.id, b.c WHERE 1 = 1", ["a.a", "a.b", "b.c"]),
    ("SELECT * FROM (a.a JOIN a.b USING (id))", ["a.a", "a.b"]),
    ("CREATE VIEW a.v AS SELECT * FROM b.t", ["a.v", "b.t"]),
    ("CREATE TABLE a.c LIKE b.d", ["a.c", "b.d"]),
    ("DESCRIBE EXTENDED a.t", ["a.t"]),
    ("SELECT * FROM `a-b`.`c-d`", ["`a-b`.`c-d`"]),
    ("SELECT 1 FROM a.t WHERE x IS DISTINCT FROM b.d", ["a.t"]),
    ("SELECT trim(both (lower(x)) from (c.d)) FROM a.t", ["a.t"]),
])
def test_sql_table_names_edge_cases(spark, sql, expected):
    refs = refs_of(spark, NB + SEP + "# MAGIC %sql\n# MAGIC " + sql.replace("\n", "\n# MAGIC "))
    assert sorted(r.original_reference for r in refs) == sorted(expected)


def test_non_ascii_text_before_reference(spark):
    refs = refs_of(spark, NB + SEP + '# café naïve\ndf = spark.table("sales_db.transactions")')
    assert [r.original_reference for r in refs] == ["sales_db.transactions"]


def _manifest(spark, sources, mapping=None):
    from assetscan.plans import scan as SC
    return M.proposed_rows(SC.scan_resolved(assets_of(spark, sources), mapping or DM.demo_mapping(spark),
                                            DM.demo_mounts(spark)), AS_OF)


def _apply(spark, sources, man):
    ws = RW.work_set(man)
    maps, conflicts = RW.edit_maps(ws)
    rw = RW.rewrite_assets(assets_of(spark, sources), maps)
    return {r.asset_path: r.new_source for r in rw.collect()}, RW.outcomes(ws, rw, conflicts).collect()


def test_fix16_17_18_token_rewrite(spark):
    src = (NB + SEP + "# MAGIC %sql\n# MAGIC SELECT * FROM risk_db.exposures JOIN risk_db.exposures_old"
           + SEP + 'db = "x"\nspark.table(f"{db}.gl")')
    man = RV.batch_approve(_manifest(spark, {"/nb": src}), "me", AS_OF)
    dyn = man.filter(F.col("reference_kind") == "dynamic_table").select("manifest_id").first()[0]
    decisions = spark.createDataFrame([(dyn, "dynamic_table", "overridden", '"main.s.gl"', "me", None)], S.DECISIONS)
    man, rejects = RV.apply_decisions(man, decisions)
    assert rejects.count() == 0
    patched, outcome = _apply(spark, {"/nb": src}, man)
    text = patched["/nb"]
    assert "main.uc_migration_target.exposures JOIN" in text           # exact hit
    assert "JOIN risk_db.exposures_old" in text                          # not approved, and no substring hit
    assert 'spark.table("main.s.gl")' in text                           # dynamic segment replaced
    assert {o.outcome for o in outcome} == {"applied"}


def test_fix16_unfound_original_is_not_stamped(spark):
    man = _manifest(spark, {"/nb": NB + SEP + 'spark.table(ns + ".transactions")'})
    dyn = man.select("manifest_id").first()[0]
    man, _ = RV.apply_decisions(man, spark.createDataFrame(
        [(dyn, "dynamic_table", "overridden", 'f"{ns}.x"', "me", None)], S.DECISIONS))
    _, outcome = _apply(spark, {"/nb": NB + SEP + 'spark.table(other + ".transactions")'}, man)
    assert [o.outcome for o in outcome] == ["not_found"]


def test_fix18_final_containing_original_rewritten_once(spark):
    mapping = spark.createDataFrame([("db", "t", "main", "db", "t", None, None)], S.MAPPING)
    src = NB + SEP + 'spark.table("db.t")\nspark.table("db.t")'
    man = RV.batch_approve(_manifest(spark, {"/nb": src}, mapping), "me", AS_OF)
    patched, _ = _apply(spark, {"/nb": src}, man)
    assert patched["/nb"].count("main.db.t") == 2 and "main.main" not in patched["/nb"]


def test_fix19_blank_final_rejected_and_fix20_illegal_move(spark):
    man = RV.batch_approve(_manifest(spark, {"/nb": NB + SEP + 'spark.table("risk_db.exposures")\nspark.table("x_db.y")'}),
                           "me", AS_OF)
    rows = {r.original_reference: r.manifest_id for r in man.collect()}
    dec = spark.createDataFrame([
        (rows["x_db.y"], "py_table_ref", "overridden", "   ", "me", None),
        (rows["risk_db.exposures"], "py_table_ref", "skipped", None, "me", None)], S.DECISIONS)
    nxt, rejects = RV.apply_decisions(man, dec)
    reasons = sorted(r.reject_reason for r in rejects.collect())
    assert reasons == ["blank final replacement", "illegal move approved -> skipped"]
    assert {r.status for r in nxt.collect()} == {"approved", "proposed"}


def test_v4_batch_approve_is_idempotent(spark):
    man = _manifest(spark, {"/nb": NB + SEP + 'spark.table("risk_db.exposures")'})
    once = RV.batch_approve(man, "a", AS_OF)
    twice = RV.batch_approve(once, "b", "2030-01-01 00:00:00")
    assert [(r.status, r.reviewer) for r in twice.collect()] == [("approved", "a")]


def test_fix21_rescan_keeps_reviewed_rows(spark):
    man = RV.batch_approve(_manifest(spark, {"/nb": NB + SEP + 'spark.table("risk_db.exposures")'}), "me", AS_OF)
    rescanned = _manifest(spark, {"/nb": NB + SEP + 'spark.table("risk_db.exposures")\nspark.table("x_db.y")'})
    merged = M.upsert_rescan(man, rescanned).collect()
    assert sorted((r.original_reference, r.status) for r in merged) == [
        ("risk_db.exposures", "approved"), ("x_db.y", "proposed")]
    assert M.upsert_rescan(M.empty_manifest(spark), M.empty_manifest(spark)).count() == 0


def test_fix23_backup_names_do_not_collide(spark):
    df = spark.createDataFrame([("/a/b__c",), ("/a__b/c",)], "asset_path string")
    names = [r[0] for r in df.select(RW.backup_path("/bk", F.col("asset_path"), "S")).collect()]
    assert len(set(names)) == 2


def test_fix24_unreadable_table_is_unverifiable(spark):
    pairs = spark.createDataFrame([("cat.sch.t", "base.src_t")], "target string, source string")
    src = spark.range(3).toDF("a")
    stats = RC.table_stats(spark, ["cat.sch.t", "base.src_t"], lambda n: src if n == "base.src_t" else (_ for _ in ()).throw(KeyError(n)))
    assert [r.result for r in RC.reconcile(pairs, stats).collect()] == ["unverifiable"]


def test_q4_planted_mismatches(spark):
    base = spark.range(10).toDF("a")
    cat = {"s.src_same": base, "c.x.same": base, "s.src_rows": base, "c.x.rows": base.filter("a < 5"),
           "s.src_cols": base, "c.x.cols": base.withColumnRenamed("a", "b")}
    pairs = spark.createDataFrame([("c.x.same", "s.src_same"), ("c.x.rows", "s.src_rows"), ("c.x.cols", "s.src_cols")],
                                  "target string, source string")
    res = {r.target: r.result for r in RC.reconcile(pairs, RC.table_stats(spark, list(cat), cat.__getitem__)).collect()}
    assert res == {"c.x.same": "match", "c.x.rows": "mismatch", "c.x.cols": "mismatch"}


def test_fix27_audit_is_idempotent(spark):
    man = RV.batch_approve(_manifest(spark, {"/nb": NB + SEP + 'spark.table("risk_db.exposures")'}), "me", AS_OF)
    entries = AU.decision_rows(man)
    assert AU.new_entries(entries, entries).count() == 0
    assert entries.first().run_name.startswith("decision-")


def test_fix30_low_queue_takes_every_kind(spark):
    man = _manifest(spark, {"/nb": NB + SEP + 'spark.table("x_db.y")\nspark.read.parquet("/mnt/none/a")\nspark.table(v)'})
    kinds = sorted(r.reference_kind for r in RV.queue_low(man).collect())
    assert kinds == ["dynamic_table", "mount_path_literal", "py_table_ref"]


def test_edits_stand_only_where_their_reference_was_found(spark):
    src = (NB + SEP + 'tbl = w.get("t")\nspark.table(tbl)\nspark.table(ns + ".transactions")\nrisk_db.exposures = 1\nspark.table("risk_db.exposures")'
           + SEP + "# MAGIC %sql\n# MAGIC SELECT risk_db.exposures.id FROM risk_db.exposures WHERE risk_db.exposures_old.x = 1")
    man = RV.batch_approve(_manifest(spark, {"/nb": src}), "me", AS_OF)
    ids = {r.original_reference: r.manifest_id for r in man.filter("reference_kind = 'dynamic_table'").collect()}
    decisions = spark.createDataFrame([(ids["tbl"], "dynamic_table", "overridden", '"main.a.b"', "me", None),
                                       (ids['ns + ".transactions"'], "dynamic_table", "overridden", '"main.s.$1\\\\tr"', "me", None)], S.DECISIONS)
    man, _ = RV.apply_decisions(man, decisions)
    patched, outcome = _apply(spark, {"/nb": src}, man)
    text = patched["/nb"]
    assert 'tbl = w.get("t")\nspark.table("main.a.b")\nspark.table("main.s.$1\\\\tr")\nrisk_db.exposures = 1' in text
    assert 'spark.table("main.uc_migration_target.exposures")' in text
    assert "SELECT main.uc_migration_target.exposures.id FROM main.uc_migration_target.exposures WHERE risk_db.exposures_old.x" in text
    assert {o.outcome for o in outcome} == {"applied"}


def test_every_decision_is_applied_or_reported(spark):
    import datetime as dt
    man = _manifest(spark, {"/nb": NB + SEP + 'spark.table("x_db.y")\nspark.table("x_db.z")'})
    ids = {r.original_reference: r.manifest_id for r in man.collect()}
    day = lambda n: dt.datetime(2024, 1, n)
    decisions = spark.createDataFrame([
        (ids["x_db.y"], "py_table_ref", "skipped", None, "a", day(1)), (ids["x_db.y"], "py_table_ref", "overridden", "m.s.y", "b", day(2)),
        (ids["x_db.z"], "py_table_ref", None, "m.s.z", "c", day(1)), ("no-such-id", "py_table_ref", "approved", None, "d", day(1))], S.DECISIONS)
    nxt, rejects = RV.apply_decisions(man, decisions)
    assert sorted((r.reviewer, r.reject_reason) for r in rejects.collect()) == [
        ("a", "superseded by a later decision"), ("c", "no decision given"), ("d", "no manifest row with this key")]
    assert {r.original_reference: r.status for r in nxt.collect()} == {"x_db.y": "overridden", "x_db.z": "proposed"}


def test_targets_are_unquoted_and_name_tables_only(spark):
    rows = [("i1", "applied", '"main.s.t"', "dynamic_table"), ("i2", "applied", "main.s.u", "py_table_ref"),
            ("i3", "applied", "a.b.c/d", "mount_path_literal"), ("i4", "approved", "main.s.v", "py_table_ref")]
    man = spark.createDataFrame(rows, "manifest_id string, status string, final_replacement string, reference_kind string")
    assert sorted(r.target for r in RC.reconcile_targets(man, None).collect()) == ["main.s.t", "main.s.u"]
    bad = spark.createDataFrame([("main.s.t", "mismatch")], "target string, result string")
    assert {r.manifest_id: r.status for r in RC.mark_failed(man, bad).collect()}["i1"] == "failed"


def test_dynamic_mounts_are_narrowed_by_assigned_strings(spark):
    src = {"/a": NB + SEP + 'z = "finance-raw"\nspark.read.parquet(f"/mnt/{z}/x")', "/b": NB + SEP + 'spark.read.parquet(f"/mnt/{q}/x")'}
    from assetscan.operators import cells as C
    man = _manifest(spark, src)
    cells = C.split_cells(assets_of(spark, src))
    got = {r.asset_path: (r.mount_pattern, r.candidate_mount) for r in RV.candidates_mount(man, cells, DM.demo_mounts(spark)).collect()}
    assert got == {"/a": ("/mnt/%", "/mnt/finance-raw"), "/b": ("/mnt/%", None)}
    assert RV.mount_pattern_matches(man, DM.demo_mounts(spark)).count() == DM.demo_mounts(spark).count()


def test_every_string_assigned_to_the_field_names_a_mount(spark):
    src = {"/a": NB + SEP + 'm = "finance-raw"\nm = "other"\nm = "finance-raw"\nn = "third"\nspark.read.parquet(f"/mnt/{m}/x")',
           "/b": NB + SEP + 'spark.read.parquet(f"/mnt/{q}/x")'}
    from assetscan.operators import cells as C
    mounts = spark.createDataFrame([("/mnt/finance-raw", "a"), ("/mnt/other", "b"), ("/mnt/third", "c")], "mount_path string, hms_namespace string")
    got = RV.candidates_mount(_manifest(spark, src), C.split_cells(assets_of(spark, src)), mounts).collect()
    assert sorted((r.asset_path, r.named_mount or "", r.candidate_namespace or "") for r in got) == [
        ("/a", "/mnt/finance-raw", "a"), ("/a", "/mnt/other", "b"), ("/b", "", "")]
