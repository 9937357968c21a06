"""The reference's 24 demo notebooks, scanned together, against the hand-derived rows
(FIXTURES.md section 3), with this build's fixes: exact source segments for dynamic
references (fix 16) and the dbfs: sub-path (fix 1)."""
from collections import Counter

import pytest

from assetscan.plans import scan as SC
from assetscan.sources import demo as DM

M = "main.uc_migration_target"
V = "/Volumes/main/uc_migration_target"
# name -> [(kind, original, proposal, score)]
EXPECTED = {
    "simple_01_read_table": [("py_table_ref", "sales_db.transactions", f"{M}.transactions", 0.95)],
    "simple_02_spark_table": [("py_table_ref", "finance_db.ledger", f"{M}.ledger", 0.95)],
    "simple_03_sql_magic": [("sql_table_ref", "risk_db.exposures", f"{M}.exposures", 0.95)],
    "simple_04_spark_sql": [("py_table_ref", "sales_db.customers", f"{M}.customers", 0.95)],
    "simple_05_join": [("sql_table_ref", "sales_db.orders", f"{M}.orders", 0.60),
                       ("sql_table_ref", "sales_db.customers", f"{M}.customers", 0.95)],
    "simple_06_static_mount": [("mount_path_literal", "/mnt/sales-raw/2024/transactions",
                                f"{V}/sales_raw/2024/transactions", 0.90)],
    "simple_07_gl": [("py_table_ref", "finance_db.gl_accounts", f"{M}.gl_accounts", 0.60)],
    "simple_08_campaigns": [("py_table_ref", "marketing_db.campaigns", None, 0.20)],
    "simple_09_events": [("sql_table_ref", "ops_db.events", None, 0.20)],
    "simple_10_rates": [("py_table_ref", "reference_db.currency_rates", None, 0.20)],
    "simple_11_employees": [("py_table_ref", "hr_db.employees", None, 0.20)],
    "simple_12_var": [("py_table_ref", "risk_db.var_results", f"{M}.var_results", 0.60)],
    "complex_01_fstring_mount": [("dynamic_mount", 'f"/mnt/{mnt}/daily"', None, 0.70)],
    "complex_02_concat_path": [("mount_path_literal", "/mnt/finance-raw", f"{V}/finance_raw", 0.90)],
    "complex_03_var_table": [("dynamic_table", 'f"SELECT * FROM {db}.var_results"', None, 0.30)],
    "complex_04_loop_mounts": [("dynamic_mount", 'f"/mnt/sales-raw/{sub}"', None, 0.70)],
    "complex_05_param_db": [("dynamic_table", 'f"{schema_name}.gl_accounts"', None, 0.30)],
    "complex_06_format_load": [("mount_path_literal", "/mnt/%s/exposures", None, 0.20)],
    "complex_07_dbfs_prefix": [("mount_path_literal", "dbfs:/mnt/finance-raw/gl", f"{V}/finance_raw/gl", 0.90)],
    "complex_08_widget_table": [("dynamic_table", 'f"SELECT * FROM {tbl}"', None, 0.30)],
    "verycomplex_01_env_mount": [("dynamic_mount", 'f"/mnt/{env}-raw/landing"', None, 0.70)],
    "verycomplex_02_branching_db": [("dynamic_table", 'f"{db}.gl_accounts"', None, 0.30)],
    "verycomplex_03_config_driven": [("dynamic_table", 'f"SELECT * FROM {name}"', None, 0.30)],
    "verycomplex_04_helper_indirection": [("dynamic_table", 'ns + ".transactions"', None, 0.30)],
}


@pytest.fixture(scope="module")
def golden(spark):
    assets = DM.demo_notebooks(spark).drop("tier", "hms_ref_count")
    rows = SC.scan_resolved(assets, DM.demo_mapping(spark), DM.demo_mounts(spark)).collect()
    out = {}
    for r in rows:
        out.setdefault(r.asset_path.rsplit("/", 1)[-1], []).append(
            (r.reference_kind, r.original_reference, r.proposed_replacement, round(r.confidence, 2)))
    return out, rows


def test_every_notebook_matches(golden):
    got, _ = golden
    for name, expected in EXPECTED.items():
        assert sorted(got.get(name, [])) == sorted(expected), name


def test_totals_by_score_and_tier(golden):
    _, rows = golden
    assert len(rows) == 25
    assert Counter(round(r.confidence, 2) for r in rows) == {0.95: 5, 0.90: 3, 0.70: 3, 0.60: 3, 0.30: 6, 0.20: 5}
    assert Counter(r.tier for r in rows) == {"simple": 8, "complex": 6, "very_complex": 11}


def test_simple_01_reference_is_in_cell_1(golden):
    _, rows = golden
    r = [r for r in rows if r.asset_path.endswith("simple_01_read_table")][0]
    assert r.cell_index == 1


def test_dashboards_give_dashboard_query_rows(spark):
    assets = DM.demo_dashboards(spark).drop("tier", "hms_ref_count")
    rows = SC.scan_resolved(assets, DM.demo_mapping(spark), DM.demo_mounts(spark)).collect()
    got = sorted((r.reference_kind, r.original_reference, round(r.confidence, 2)) for r in rows)
    assert got == [("dashboard_query", "finance_db.gl_accounts", 0.60),
                   ("dashboard_query", "risk_db.var_results", 0.60),
                   ("dashboard_query", "sales_db.transactions", 0.95)]


def test_expected_vs_found_flags_the_two_short_notebooks(spark):
    from assetscan.operators import manifest as M
    from assetscan.sources import io as IO
    nbs = DM.demo_notebooks(spark)
    assets = nbs.drop("tier", "hms_ref_count")
    man = M.proposed_rows(SC.scan_resolved(assets, DM.demo_mapping(spark), DM.demo_mounts(spark)),
                          "2024-01-01 00:00:00")
    inv = IO.seed_inventory(nbs, DM.demo_dashboards(spark), "2024-01-01 00:00:00")
    diff = DM.expected_vs_found(inv.filter("asset_type = 'notebook'"), man).filter("difference <> 0").collect()
    assert sorted(r.asset_path.rsplit("/", 1)[-1] for r in diff) == ["complex_04_loop_mounts",
                                                                   "verycomplex_02_branching_db"]
