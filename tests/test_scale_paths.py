"""The paths a large cluster takes: lookups too big to broadcast (shuffle join, AQE), long texts
and many tables give the same results as the small path."""
import pytest

from pyspark.sql import functions as F

from assetscan.operators import resolve as R
from assetscan.plans import scan as SC
from assetscan.sources import demo as DM


@pytest.fixture
def no_auto_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _rows(df):
    return sorted(tuple(r) for r in df.select("manifest_id", "reference_kind", "proposed_replacement",
                                              "confidence", "reason").collect())


def test_resolution_is_the_same_without_broadcast(spark, request):
    assets = DM.demo_notebooks(spark).drop("tier", "hms_ref_count")
    refs = SC.scan_references(assets)
    small = _rows(R.resolve(refs, DM.demo_mapping(spark), DM.demo_mounts(spark)))
    request.getfixturevalue("no_auto_broadcast")
    big = R.resolve(refs, DM.demo_mapping(spark), DM.demo_mounts(spark))
    big.write.format("noop").mode("overwrite").save()
    plan = big._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert small == _rows(big)


def test_table_stats_in_small_batches(spark, monkeypatch):
    from assetscan.operators import reconcile as RC
    cat = {f"t{i}": spark.range(i + 1).toDF("a") for i in range(5)}
    cat["t5"] = spark.range(3).toDF("b")
    monkeypatch.setattr(RC, "STATS_BATCH", 2)
    monkeypatch.setattr(RC, "TABLES_BATCH", 2)
    rows = {r.table_name: (r.row_count, None if r.columns is None else list(r.columns))
            for r in RC.table_stats(spark, list(cat) + ["missing"], lambda n: cat[n]).collect()}
    assert rows == {**{f"t{i}": (i + 1, ["a"]) for i in range(5)}, "t5": (3, ["b"]), "missing": (None, None)}


def test_many_names_are_read_in_bounded_batches(spark, monkeypatch):
    from assetscan.operators import reconcile as RC
    seen, table = [], spark.range(4).toDF("a")

    def read(name):
        seen.append(name)
        return table

    sizes = []
    plain = RC._batch_stats
    monkeypatch.setattr(RC, "STATS_BATCH", 5000)
    monkeypatch.setattr(RC, "_batch_stats", lambda s, names, r: sizes.append(len(names)) or plain(s, names, r))
    scans = []
    count = RC._counted
    monkeypatch.setattr(RC, "_counted", lambda s, batch: scans.extend(n for n, _ in batch) or count(s, batch))
    names = spark.range(10000).selectExpr("concat('c.s.t_', id) as name")
    stats = RC.table_stats(spark, names, read)
    assert stats.count() == 10000 and stats.filter("row_count = 4").count() == 10000
    assert sizes == [5000, 5000] and len(set(seen)) == 10000
    assert scans == [0]                                  # one table behind all names: counted once
    assert len(stats.inputFiles()) <= 8


def test_equal_plans_are_counted_once_and_different_columns_apart(spark, monkeypatch):
    from assetscan.operators import reconcile as RC
    spark.range(7).toDF("a").createOrReplaceTempView("seven")
    scans = []
    count = RC._counted
    monkeypatch.setattr(RC, "_counted", lambda s, batch: scans.extend(n for n, _ in batch) or count(s, batch))
    catalog = {"x": "seven", "y": "seven", "z": "seven"}

    def read(name):                                      # a new DataFrame at every call, as spark.table gives
        df = spark.table(catalog[name])
        return df.withColumnRenamed("a", "b") if name == "z" else df

    rows = {r.table_name: (r.row_count, list(r.columns or [])) for r in RC.table_stats(spark, ["x", "y", "z", "none"], read).collect()}
    assert rows == {"x": (7, ["a"]), "y": (7, ["a"]), "z": (7, ["b"]), "none": (None, [])} and len(scans) == 2


def test_long_literals_and_lists_pass_through_every_stage(spark):
    from helpers import NB, SEP, assets_of
    from assetscan.operators import review as RV, rewrite as RW, manifest as M
    blob = ("x" * 50 + r"\\\n") * 2000
    names = ", ".join(f"d{i}.t{i} a{i}" for i in range(3000))
    src = (NB + SEP + f"a = '{blob}'\nb = \"{blob}\"\nc = \"\"\"{blob}\n\"\"\"\nspark.table('risk_db.exposures')"
           + SEP + f"# MAGIC %sql\n# MAGIC SELECT '{blob}' FROM risk_db.exposures, {names}" + SEP + f"x = f'{blob}'\nspark.sql('SELECT 1 FROM risk_db.exposures WHERE a = 1')")
    assets = assets_of(spark, {"/nb": src})
    for python in ("syntax", "lexical"):
        rows = SC.scan_resolved(assets, DM.demo_mapping(spark), DM.demo_mounts(spark), python=python).collect()
        assert sum(r.original_reference == "risk_db.exposures" for r in rows) == 3
        assert len(rows) == 3003
    man = RV.batch_approve(M.proposed_rows(SC.scan_resolved(assets, DM.demo_mapping(spark), DM.demo_mounts(spark)), "2024-01-01 00:00:00"), "me", "2024-01-01 00:00:00")
    maps, _ = RW.edit_maps(RW.work_set(man))
    text = RW.rewrite_assets(assets, maps).first().new_source
    assert text.count("main.uc_migration_target.exposures") == 3 and len(text) == len(src) + 3 * (len("main.uc_migration_target.exposures") - len("risk_db.exposures"))


def _reference_rows(spark):
    rows = [("notebook", "/n", i, kind, text, 1) for i, (kind, text) in enumerate([
        ("mount_path_literal", "dbfs:/mnt/a//b/c/x"), ("mount_path_literal", "/mnt/a/z"), ("mount_path_literal", "/mnt/q/z"),
        ("mount_path_literal", "/mnt//a"), ("mount_path_literal", "/mnt/a'b/c"), ("sql_table_ref", "db.t"), ("py_table_ref", "hive_metastore.`db`.t"),
        ("sql_table_ref", "a.b.c"), ("dynamic_mount", 'f"/mnt/{m}"')])]
    return spark.createDataFrame(rows, "asset_type string, asset_path string, cell_index int, reference_kind string, "
                                       "original_reference string, occurrences int")


def test_references_meet_the_mounts_without_a_sort(spark):
    """One row per reference is kept by a number, so its rows are grouped by hash; the longest folder still wins."""
    from assetscan.operators.resolve import nearest_mount

    mounts = spark.createDataFrame([("/mnt/a", "outer"), ("/mnt/a/b", "inner"), ("/mnt/a/b/c", "two"), ("/mnt/a/b/c", "names")],
                                   "mount_path string, hms_namespace string")
    refs = _reference_rows(spark)
    met = nearest_mount(refs, mounts, F.col("reference_kind") == "mount_path_literal", F.lit("-"))
    got = {r["original_reference"]: (r["_mnt"], r["m_namespace"], r["m_ambiguous"]) for r in met.collect()}
    assert got == {"dbfs:/mnt/a//b/c/x": ("/mnt/a/b/c", None, True), "/mnt/a/z": ("/mnt/a", "outer", False), "/mnt/q/z": ("/mnt/q", None, None),
                   "/mnt//a": (None, None, None), "/mnt/a'b/c": ("/mnt/a", "outer", False), "db.t": ("-", None, None),
                   "hive_metastore.`db`.t": ("-", None, None), "a.b.c": ("-", None, None), 'f"/mnt/{m}"': ("-", None, None)}
    plan = met._jdf.queryExecution().sparkPlan().toString()
    assert not [line for line in plan.splitlines() if "SortAggregate" in line and "original_reference" in line]


def test_cells_cross_to_python_as_arrow(spark):
    """No pandas table is built on the way to the syntax job and back, in the scan or in Apply; an empty batch and
    a cell nested deeper than Python recurses are read like others."""
    from assetscan.operators import extract as E
    from assetscan.operators import rewrite as RW

    deep = "x = " + " + ".join(["1"] * 700) + "\nspark.table('db.t')"
    cells = spark.createDataFrame([("notebook", "/n", 0, "python", deep), ("notebook", "/n", 1, "python", "table = 1"), ("notebook", "/n", 2, "sql", "SELECT 1")],
                                  "asset_type string, asset_path string, cell_index int, language string, code string")
    refs = E.extract_references(cells)
    assert [(r["cell_index"], r["reference_kind"], r["original_reference"]) for r in refs.collect()] == [(0, "py_table_ref", "db.t")]
    places = RW.reference_places(cells.withColumnRenamed("code", "text"))
    assert [(r["cell_index"], r["key"], r["start"]) for r in places.collect()] == [(0, "db.t", deep.index("db.t"))]
    assert "InPandas" not in refs._jdf.queryExecution().toString() + places._jdf.queryExecution().toString()


def test_reconcile_results_are_stored_for_the_audit(spark, monkeypatch):
    """targets and results are worked out once, however many steps read them."""
    import __spark_entry__ as entry
    from assetscan import schemas as S

    applied = spark.createDataFrame([("notebook", f"/n{i}", 0, "db.t", "sql_table_ref", "applied", f"c.s.t_{i}") for i in range(5)],
                                    "asset_type string, asset_path string, cell_index int, original_reference string, "
                                    "reference_kind string, status string, final_replacement string")
    applied = applied.select(*[F.col(f.name) if f.name in applied.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in S.MANIFEST.fields])
    monkeypatch.setattr(entry, "_stamped", lambda spark, sf: applied)
    one = spark.range(3)
    monkeypatch.setattr(entry.ES, "estate_catalog", lambda spark, sf: lambda name: one)
    _, results = entry._reconciled(spark, "")
    assert results.count() == 5 and results.filter("result = 'match'").count() == 5
    assert "Join" not in results._jdf.queryExecution().toString()


def _edited(spark):
    from helpers import NB, SEP, assets_of
    src = (NB + SEP + "spark.table('a.b')\nx = 'a.b'" + SEP + "# MAGIC %sql\n# MAGIC SELECT a.b.id FROM a.b JOIN a.c" + SEP + "\n\n" + SEP + "spark.table('a.c')\n\n")
    edits = [("/nb", 0, "a.b", "m.s.b"), ("/nb", 1, "a.b", "m.s.b2"), ("/nb", 1, "a.b", "m.s.b2"), ("/nb", 1, "a.c", "one"), ("/nb", 1, "a.c", "two"),
             ("/nb", 2, "a.c", "m.s.c"), ("/nb", 2, "a.c", None), ("/nb", None, "a.d", "m.s.d"), (None, 0, "a.b", "m.s.b"), ("/bad", 0, "a.b", "x"), ("/bad", 0, "a.b", "y")]
    rows = spark.createDataFrame([(f"id{i}", "sql_table_ref", *e) for i, e in enumerate(edits)],
                                 "manifest_id string, reference_kind string, asset_path string, cell_index int, original_reference string, final_replacement string")
    return src, assets_of(spark, {"/nb": src, "/other": src, "/bad": src}), rows


def test_apply_reads_each_cell_once(spark):
    """F1 (restore): cells are split, and read by the syntax job, once; edits meet places in the cell's row, so places are
    neither sorted nor joined. An original with two finals is left out, the other edits of its cell are made."""
    from assetscan.operators import rewrite as RW

    src, assets, rows = _edited(spark)
    maps, conflicts = RW.edit_maps(rows)
    assert sorted((r.asset_path, r.cell_index, r.original_reference) for r in conflicts.collect()) == [("/bad", 0, "a.b"), ("/nb", 1, "a.c")]
    assert sorted((str(r.asset_path), len(r.edit_list)) for r in maps.collect()) == [("/nb", 4), ("None", 1)]
    done = RW.rewrite_assets(assets, maps)
    got = [(r.asset_path, r.source, r.new_source, sorted(r.hit_keys)) for r in done.collect()]
    new = src.replace("table('a.b')", "table('m.s.b')").replace("SELECT a.b.id FROM a.b ", "SELECT m.s.b2.id FROM m.s.b2 ").replace("table('a.c')", "table('m.s.c')")
    assert got == [("/nb", src, new, ["0\u0001a.b", "1\u0001a.b", "2\u0001a.c"])]
    outcome = {r.manifest_id: r.outcome for r in RW.outcomes(rows, done, conflicts).collect()}
    assert outcome == {"id0": "applied", "id1": "applied", "id2": "applied", "id3": "conflict", "id4": "conflict", "id5": "applied", "id6": "applied",
                       "id7": "not_found", "id8": "not_found", "id9": "conflict", "id10": "conflict"}
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("Window ") == 1 and plan.count("Generate ") == 1


def test_splices_keep_the_outer_place(spark):
    from assetscan.operators import rewrite as RW

    places = [("b", 5, 8, "inside"), ("a", 0, 10, "expression"), ("a", 0, 10, "literal"), ("a", 12, 14, "literal"), ("q", 20, 22, "inside"), ("b", 14, 14, "inside"),
              ("b", 14, 14, "inside"), ("x", 30, 31, "inside"), ("b", 40, 43, "inside")]
    df = spark.createDataFrame([(places, ["a", "b", "q"], ["A\"", "B", "Q'"])], "p array<struct<key:string,start:int,end:int,how:string>>, o array<string>, f array<string>")
    cuts = df.select(RW.splices(F.col("p"), F.col("o"), F.col("f")).alias("c")).first().c
    assert [tuple(c) for c in cuts] == [(0, 0, 10, "a", "\"A\\\"\""), (10, 12, 14, "a", "\"A\\\"\""), (14, 14, 14, "b", "B"), (14, 40, 43, "b", "B")]


def test_manifest_layers_drop_rows_before_they_meet(spark):
    """F1 (restore): what a later layer covers, or a commit's scope leaves out, is dropped in its layer, not after the union."""
    import os
    import tempfile
    from assetscan.operators import manifest as M
    from test_rounds import rows

    root = os.path.join(tempfile.mkdtemp(prefix="assetscan-layered-"), "m")
    M.commit(rows(spark, ["/a", "/b", "/c", "/c"]).unionByName(rows(spark, ["/x"]).withColumn("asset_path", F.lit(None).cast("string"))), root)
    for status, path in (("approved", "/c"), ("skipped", "/b"), ("failed", "/c")):
        M.update(spark, root, lambda c: c.withColumn("status", F.lit(status)), lambda c: c.filter(F.col("asset_path") == path))
    _, layers = M._layers(spark, root)
    scope = spark.createDataFrame([("/c",), ("/c",), (None,)], "_path string")
    read = M._read_layers(spark, root, layers, scope)
    assert sorted((str(r.asset_path), r.status) for r in read.collect()) == [("/c", "failed"), ("/c", "failed"), ("None", "proposed")]
    assert sorted((str(r.asset_path), r.status) for r in M.read_latest(spark, root).collect()) == [
        ("/a", "proposed"), ("/b", "skipped"), ("/c", "failed"), ("/c", "failed"), ("None", "proposed")]
    plan = [line.strip(" :+-|") for line in read._jdf.queryExecution().optimizedPlan().toString().splitlines()]
    assert plan[0].startswith("Union")


def test_a_later_round_looks_up_only_the_texts_it_edits(spark, monkeypatch):
    """F1 (restore): the texts of other assets are not read for a round that does not edit them."""
    import test_rounds as TR
    from assetscan.plans import stages as ST

    wd, assets = TR.estate(spark, "later")
    ST.apply(spark, wd, assets, "s1", TR.AS_OF)
    TR.override(spark, wd, "x_db.y", "main.s.y")
    asked, plain = [], ST.IO.current_assets
    monkeypatch.setattr(ST.IO, "current_assets", lambda a, p: asked.append(([r.asset_path for r in a.collect()], {r.asset_path for r in p.collect()})) or plain(a, p))
    ST.apply(spark, wd, assets, "s2", TR.AS_OF)
    assert asked == [(["/nb"], {"/nb"})]
