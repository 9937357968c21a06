"""Properties (hypothesis): split-then-reassemble and rewrite-then-restore are identities.
Each example batch runs as one Spark job over many generated notebooks."""
from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assetscan import schemas as S
from assetscan.operators import rewrite as RW

LINE = st.text(alphabet=st.sampled_from(list("ab .()\"'=_%#\r\n\tdb.t/mnt-é{}")), max_size=30)
CELL = st.lists(LINE, max_size=4).map("\n".join)
SEPS = st.sampled_from(["\n\n# COMMAND ----------\n\n", "\n# COMMAND -----\n", "\r\n# COMMAND ---\r\n"])
NOTEBOOK = st.tuples(st.booleans(), st.lists(st.tuples(CELL, SEPS), max_size=4), CELL).map(
    lambda t: (S.NOTEBOOK_HEADER + "\n" if t[0] else "") + "".join(c + s for c, s in t[1]) + t[2])


def _frame(spark, sources):
    rows = [(f"/p/{i}", "python", s) for i, s in enumerate(sources)]
    return spark.createDataFrame(rows, "asset_path string, language string, source string")


def _maps(df, original, final):
    e = F.struct(F.lit(0).alias("c"), F.lit(len(original)).alias("len"), F.lit(original).alias("o"), F.lit(final).alias("f"))
    return df.select("asset_path", F.array(e).alias("edit_list"))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(NOTEBOOK, min_size=1, max_size=25))
def test_rewrite_with_no_matching_edit_is_identity(spark, sources):
    df = _frame(spark, sources)
    out = RW.rewrite_places(df, _maps(df, "zz.never", "x")).select("source", "new_source").collect()
    assert len(out) == len(sources)
    assert all(r.source == r.new_source for r in out)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(NOTEBOOK, min_size=1, max_size=25))
def test_rewrite_then_restore_is_identity(spark, sources):
    df = _frame(spark, sources)
    rewritten = RW.rewrite_places(df, _maps(df, "db.t", "main.db.t"))
    backups = RW.backups_of(rewritten, "/bk", "S1")
    restored = {r.asset_path: r.source for r in RW.restore_sources(backups).collect()}
    assert restored == {f"/p/{i}": s for i, s in enumerate(sources)}
