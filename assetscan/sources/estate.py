"""An estate of notebooks, dashboards and lookups derived from the driver tables.

One notebook per `orders` row, so the estate grows with the data (150,000 notebooks at
sf0.1). Everything is built with `concat` over columns, so a SQL engine can repeat it:
  n = o_custkey % 30, ns = db_<n>, t = t_<o_custkey>, v = o_orderkey % 8,
  path = /estate/p<o_orderkey % 10>/nb_<o_orderkey>.
The code cell is one of the variant's forms (`FORMS`), which also state what it refers to and where.
Mapping: one row per `part`, (db_<p % 30>, t_<p>), so it grows with `part` and the names with `customer`; rows with
p % 7 = 3 have no target table yet, rows of a namespace that is no nation have no target at all. Mounts: one
per nation, n % 8 = 7 without a namespace, n % 8 = 6 with one that no mapping row knows. So
namespaces and mounts 25-29 are unknown, and tables beyond `part`, or not yet targeted, are unmapped.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..plans.partitioning import spread

AS_OF = "2024-06-01 00:00:00"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


# The forms of each variant, dealt by (k div 8). In small letters the places of references: <a> and <b> the tables ns.t and
# ns.t_1, <m> and <g> mount paths, <f> and <d> expressions built at run time, <q> a column's qualifier that follows table a.
# <A> is the name of table a where it is no reference: a value, a comment, a key, other code. SQL forms are magic cells.
# Some forms take several cells: a value is assigned in one and used in a later one.
FORMS: dict[int, list[str]] = {
    0: ['df = spark.read.table("<a>")',
        'log("<A>")\ncfg["<A>"] = spark.table("<a>")  # """ of <A>\n<A>.reload()'],
    1: ["SELECT * FROM <a> a JOIN <b> b ON a.id = b.id",
        "SELECT * FROM <a> a JOIN <b> b USING (id), <a> c WHERE a.name = '<A>'",
        "SELECT <q>.id FROM <a> VERSION AS OF 3, <b> AS x (c1, c2) -- FROM <A>",
        "SELECT * FROM <b> b JOIN <a> a ON b.id = a.id + 1 AND a.d = '2024', <b> z",
        "MERGE INTO <a> t USING <b> s ON t.id = s.id\nWHEN MATCHED THEN UPDATE SET t.x = s.x, t.y = s.y",
        "OPTIMIZE <a>;\nSHOW COLUMNS IN <b>",
        "SELECT * FROM <a> PIVOT (sum(x) FOR y IN (1, 2)), LATERAL (SELECT max(z) FROM <b>) l",
        "SELECT * FROM IDENTIFIER(:tbl) i, <a> j",
        "CREATE TABLE <a> USING delta LOCATION '<m>'",
        "INSERT INTO <a> (c1, c2) SELECT extract(year FROM d), '<A>' FROM <b> WHERE x IS DISTINCT FROM y"],
    2: ['spark.sql("SELECT id FROM <a>")',
        'spark.sql("""\nSELECT <q>.id, \'<A>\' AS n\nFROM <a>\n""")',
        'spark.sql("SELECT <q>.* FROM <a> "\n          "WHERE <q>.k = 1")'],
    3: ['df = spark.read.parquet("<m>")'],
    4: ['p = "<g>"\nspark.read.parquet(p)'],
    5: ['m = "<n>"\nspark.read.parquet(<f>)',
        f'm = "raw-other"{S.CELL_SEPARATOR}m = "<n>"{S.CELL_SEPARATOR}spark.read.parquet(<f>)'],
    6: ['db = "<s>"\nspark.table(<d>)',
        f'db = "<s>"{S.CELL_SEPARATOR}spark.table(<d>)'],
    7: ["x = 1 + 1", 'x = (5\n % 3)\nprint("<A>")'],
}
UNREAD_FORMS = {(1, 7)}                       # IDENTIFIER(...) names no table that text could tell
CONCATENATED_FORMS = {(2, 2)}                 # the lexical reading does not join adjacent literals
SLOT_KINDS = {"<m>": "mount_path_literal", "<g>": "mount_path_literal", "<f>": "dynamic_mount", "<d>": "dynamic_table"}


def form_references(v: int, i: int) -> list[tuple[str, str]]:
    """(kind, slot) of every reference of form i of variant v, by construction."""
    form, table = FORMS[v][i], "sql_table_ref" if v == 1 else "py_table_ref"
    found = [(SLOT_KINDS.get(slot, table), slot) for slot in ("<a>", "<b>", *SLOT_KINDS) for _ in range(form.count(slot))]
    return found + ([(S.KIND_UNPARSED, "")] if (v, i) in UNREAD_FORMS else [])


def slot_cell(v: int, i: int, slot: str) -> int:
    """The cell a place is in; the notebook's first one is its title."""
    form = FORMS[v][i]
    return 1 + form[:form.index(slot)].count(S.CELL_SEPARATOR) if slot else 1


def form_source(v: int, i: int) -> str:
    form = FORMS[v][i]
    return "# MAGIC %sql\n# MAGIC " + form.replace("\n", "\n# MAGIC ") if v == 1 else form


def by_form(k: F.Column, value) -> F.Column:
    """`value(v, i)` of the form that notebook k has; NULL for a key that is NULL or has no form. The literal values are one
    constant array that is indexed: a CASE over all forms makes a method too long for the JVM to compile."""
    values = F.array(*[value(v, i) for v, forms in FORMS.items() for i in range(len(forms))])
    counts = F.array(*[F.lit(len(forms)) for forms in FORMS.values()])
    firsts = F.array(*[F.lit(sum(len(FORMS[w]) for w in FORMS if w < v)) for v in FORMS])
    v = (k % 8).cast("int")
    i = F.floor(k / 8) % F.get(counts, v)
    return F.when(i >= 0, F.get(values, (F.get(firsts, v) + i).cast("int")))


def slot_values(n: F.Column, c: F.Column) -> dict[str, F.Column]:
    ns, t = F.concat(F.lit("db_"), _s(n)), F.concat(F.lit("t_"), _s(c))
    a = F.concat(ns, F.lit("."), t)
    return {"<a>": a, "<q>": a, "<A>": a, "<b>": F.concat(ns, F.lit(".t_1")), "<s>": ns, "<n>": F.concat(F.lit("raw-"), _s(n)),
            "<m>": F.concat(F.lit("/mnt/raw-"), _s(n), F.lit("/2024/"), t), "<g>": F.concat(F.lit("dbfs:/mnt/raw-"), _s(n), F.lit("/gl")),
            "<f>": F.lit('f"/mnt/{m}/daily"'), "<d>": F.concat(F.lit('f"{db}.'), t, F.lit('"'))}


def notebook_cell(k: F.Column, n: F.Column, c: F.Column) -> F.Column:
    """The one code cell of notebook k, by variant and form."""
    text = by_form(k, lambda v, i: F.lit(form_source(v, i)))
    for slot, value in slot_values(n, c).items():
        text = F.replace(text, F.lit(slot), value)
    return text


def estate_notebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """assets rows (asset_type, asset_path, name, language, source, queries). The keys are spread before the texts are
    built: a table of few row groups is read by few tasks. They are spread by path, so a join on it needs no exchange of the texts."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    path = F.concat(F.lit("/estate/p"), _s(k % 10), F.lit("/nb_"), _s(k))
    o = spread(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", path.alias("asset_path")), "asset_path")
    n = c % 30
    source = F.concat(F.lit(S.NOTEBOOK_HEADER + "\n\n# MAGIC %md\n# MAGIC ## notebook "), _s(k),
                      F.lit(S.CELL_SEPARATOR), notebook_cell(k, n, c), F.lit("\n"))
    return o.select(
        F.lit("notebook").alias("asset_type"),
        "asset_path",
        F.concat(F.lit("nb_"), _s(k)).alias("name"),
        F.lit("python").alias("language"),
        source.alias("source"),
        F.lit(None).cast("array<string>").alias("queries"))


def estate_dashboards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dashboard per supplier, two queries each (E10 input)."""
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    ns = F.concat(F.lit("db_"), _s(F.col("s_nationkey")))
    t = F.concat(F.lit("t_"), _s("s_suppkey"))
    q1 = F.concat(F.lit("SELECT channel, sum(amount) AS total FROM "), ns, F.lit("."), t,
                  F.lit(" GROUP BY channel"))
    q2 = F.concat(F.lit("SELECT d.day, count(*) FROM "), ns, F.lit(".t_"), _s(F.col("s_suppkey") % 7),
                  F.lit(" d, "), ns, F.lit(".calendar c WHERE d.day = c.day GROUP BY d.day"))
    return s.select(
        F.lit("dashboard").alias("asset_type"),
        F.concat(F.lit("/estate/dashboards/d_"), _s(F.col("s_suppkey"))).alias("asset_path"),
        F.concat(F.lit("d_"), _s(F.col("s_suppkey"))).alias("name"),
        F.lit("sql").alias("language"),
        F.lit(None).cast("string").alias("source"),
        F.array(q1, q2).alias("queries"))


def estate_assets(spark: SparkSession, sf_dir: str, dashboards: bool = False) -> DataFrame:
    nb = estate_notebooks(spark, sf_dir)
    return nb.unionByName(estate_dashboards(spark, sf_dir)) if dashboards else nb


def estate_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hms_to_uc_mapping rows: a (namespace, table) pair per part, most with a target."""
    p = read_table(spark, sf_dir, "part").select("p_partkey")
    nat = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    j = p.join(nat, (F.col("p_partkey") % 30) == F.col("n_nationkey"), "left")
    tbl = F.concat(F.lit("t_"), _s("p_partkey"))
    return j.select(
        F.concat(F.lit("db_"), _s(F.col("p_partkey") % 30)).alias("hms_namespace"),
        tbl.alias("hms_table"),
        F.concat(F.lit("cat_"), _s("n_regionkey")).alias("uc_catalog"),
        F.concat(F.lit("sch_"), _s("n_nationkey")).alias("uc_schema"),
        F.when(F.col("n_nationkey").isNotNull() & (F.col("p_partkey") % 7 != 3), tbl).alias("uc_table"),
        F.concat(F.lit("/mnt/raw-"), _s("n_nationkey")).alias("mount_path"),
        F.lit(None).cast("string").alias("notes"))


def estate_mapping_with_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapping plus a second row for every key: every fourth part points its key somewhere
    else (ambiguous), the others repeat the same target (harmless)."""
    p = read_table(spark, sf_dir, "part").select("p_partkey")
    nat = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    j = p.join(nat, (F.col("p_partkey") % 30) == F.col("n_nationkey"), "left")
    tbl = F.concat(F.lit("t_"), _s("p_partkey"))
    dup = j.select(
        F.concat(F.lit("db_"), _s(F.col("p_partkey") % 30)).alias("hms_namespace"),
        tbl.alias("hms_table"),
        F.concat(F.lit("cat_"), _s("n_regionkey")).alias("uc_catalog"),
        F.concat(F.lit("sch_"), _s("n_nationkey")).alias("uc_schema"),
        F.when(F.col("n_nationkey").isNotNull(), F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("alt_"), _s("p_partkey")))
               .otherwise(tbl)).alias("uc_table"),
        F.lit(None).cast("string").alias("mount_path"),
        F.lit("duplicate").alias("notes"))
    return estate_mapping(spark, sf_dir).unionByName(dup)


def estate_mounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mount_point_registry rows: /mnt/raw-<n> -> db_<n>, some without a known namespace; inside every third one a
    mount of its own, /mnt/raw-<n>/2024 -> db_<(n + 1) % 25>."""
    nat = read_table(spark, sf_dir, "nation").select("n_nationkey")
    n = F.col("n_nationkey")
    outer = nat.select(
        F.concat(F.lit("/mnt/raw-"), _s("n_nationkey")).alias("mount_path"),
        F.concat(F.lit("abfss://raw-"), _s("n_nationkey"), F.lit("@acct.dfs.core.windows.net/"))
        .alias("adls_target"),
        F.when(n % 8 == 7, F.lit("")).when(n % 8 == 6, F.concat(F.lit("db_"), _s(n + 100)))
        .otherwise(F.concat(F.lit("db_"), _s(n))).alias("hms_namespace"),
        F.to_timestamp(F.lit(AS_OF)).alias("discovered_at"))
    inner = nat.filter(n % 3 == 0).select(
        F.concat(F.lit("/mnt/raw-"), _s(n), F.lit("/2024")).alias("mount_path"),
        F.concat(F.lit("abfss://year-"), _s(n), F.lit("@acct.dfs.core.windows.net/")).alias("adls_target"),
        F.concat(F.lit("db_"), _s((n + 1) % 25)).alias("hms_namespace"), F.to_timestamp(F.lit(AS_OF)).alias("discovered_at"))
    return outer.unionByName(inner)


def expected_count(k: F.Column) -> F.Column:
    """References each notebook declares (the seed's hms_ref_count)."""
    return by_form(k, lambda v, i: F.lit(sum(kind != S.KIND_UNPARSED for kind, _ in form_references(v, i)))).cast("int")


def estate_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """demo_asset_inventory rows for the estate notebooks, tier by variant."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey")
    k = F.col("o_orderkey")
    v = k % 8
    tier = (F.when(v.isin(0, 1, 2, 3), S.TIER_SIMPLE).when(v.isin(4, 5), S.TIER_COMPLEX)
            .otherwise(S.TIER_VERY_COMPLEX))
    return o.select(
        F.lit("notebook").alias("asset_type"),
        F.concat(F.lit("/estate/p"), _s(k % 10), F.lit("/nb_"), _s(k)).alias("path"),
        F.concat(F.lit("nb_"), _s(k)).alias("name"),
        tier.alias("tier"),
        expected_count(k).alias("hms_ref_count"),
        F.to_timestamp(F.lit(AS_OF)).alias("seeded_at"))


REVIEWED_AT = "2024-06-02 09:00:00"
BATCH_REVIEWER = "batch@estate"


def notebook_key(asset_path: F.Column) -> F.Column:
    return F.regexp_extract(asset_path, r"nb_(\d+)$", 1).try_cast("long")


def estate_decisions(spark: SparkSession, sf_dir: str, manifest: DataFrame) -> DataFrame:
    """Reviewer decisions for the estate manifest, reviewer = the order's customer.

    By notebook k % 6: 0 approve (no value: take the proposal), 1 override with a new
    target, 2 skip, 3 override with a blank value (rejected), 4 an unknown decision
    (rejected), 5 no decision. Rows already batch-approved that get a skip or a second
    approval are illegal moves (rejected)."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    k = notebook_key(F.col("asset_path"))
    kind = F.col("reference_kind")
    t = F.concat(F.lit("t_"), _s(F.col("_k") % 40))
    new_target = (F.when(kind.isin(*S.TABLE_KINDS), F.concat(F.lit("main.reviewed."), t))
                  .when(kind == "mount_path_literal", F.concat(F.lit("/Volumes/main/reviewed/raw/"), t))
                  .otherwise(F.concat(F.lit('"main.reviewed.'), t, F.lit('"'))))
    v = F.col("_k") % 6
    m = manifest.select("manifest_id", "reference_kind", k.alias("_k"))
    j = m.join(o, F.col("_k") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    return (j.filter(v != 5).select(
        "manifest_id", "reference_kind",
        F.when(v == 0, "approved").when(v.isin(1, 3), "overridden").when(v == 2, "skipped")
        .otherwise("applied").alias("decision"),
        F.when(v == 1, new_target).when(v == 3, F.lit("  ")).alias("final_replacement"),
        F.col("c_name").alias("reviewer"),
        F.to_timestamp(F.lit(REVIEWED_AT)).alias("reviewed_at")))


SOURCE_BASE = "legacy.db"


def estate_catalog(spark: SparkSession, sf_dir: str):
    """Name -> DataFrame for reconciling the estate's targets, over whole driver tables.

    Sources `<base>.src_t_<k>` are `lineitem` (`orders` when k % 5 = 3). Targets
    `<cat>.<sch>.t_<k>` by k % 5: 0 the same `lineitem`; 1 `lineitem` without its
    returned rows (a planted count mismatch); 2 `lineitem` with `l_tax` renamed (a
    planted column mismatch); 3 `orders`; 4 missing (unreadable)."""
    import re

    li = read_table(spark, sf_dir, "lineitem")
    orders = read_table(spark, sf_dir, "orders")
    targets = [li, li.filter(F.col("l_returnflag") != "R"), li.withColumnRenamed("l_tax", "l_tax_rate"),
               orders, None]
    name_re = re.compile(r"(src_)?t_(\d+)")

    def read(name: str) -> DataFrame:
        m = name_re.fullmatch(name.split(".")[-1])
        if not m:
            raise KeyError(name)
        k = int(m.group(2)) % 5
        if m.group(1):
            return orders if k == 3 else li
        if targets[k] is None:
            raise KeyError(name)
        return targets[k]

    return read


def estate_inventory_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An inventory that lists only the notebooks of orders with status 'F' (the rest
    arrived after it was written): the input of the backfill."""
    f_orders = read_table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F") \
        .select(F.concat(F.lit("/estate/p"), _s(F.col("o_orderkey") % 10), F.lit("/nb_"),
                         _s("o_orderkey")).alias("path"))
    return estate_inventory(spark, sf_dir).join(f_orders, "path", "left_semi")


def estate_mount_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mount listing (mount_point, source) as a workspace would return it: the estate's
    /mnt/ mounts plus one non-mount volume per region (filtered out by S3)."""
    mnt = estate_mounts(spark, sf_dir).select(F.col("mount_path").alias("mount_point"),
                                              F.col("adls_target").alias("source"))
    vol = read_table(spark, sf_dir, "region").select(
        F.concat(F.lit("/Volumes/r_"), _s("r_regionkey")).alias("mount_point"),
        F.concat(F.lit("abfss://vol-"), _s("r_regionkey"), F.lit("@acct.dfs.core.windows.net/")).alias("source"))
    return mnt.unionByName(vol)


def estate_states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The estate before and after some time, by the order's state: notebooks of 'P' orders are new; of 'F' orders
    those with remainder 9 of 10 are gone and those with 8 moved to another folder; of the others, urgent ones have one more line."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    nb = estate_notebooks(spark, sf_dir).withColumn("_k", notebook_key(F.col("asset_path")))
    j = nb.join(o, F.col("_k") == F.col("o_orderkey"))
    f, rest = F.col("o_orderstatus") == "F", F.col("_k") % 10
    moved, gone = f & (rest == 8), f & (rest == 9)
    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") != "P") & ~moved
    before = j.filter(F.col("o_orderstatus") != "P").select(*nb.columns[:-1])
    after = j.filter(~gone).select(*[
        F.when(moved, F.concat(F.lit("/estate/moved/nb_"), _s("_k"))).otherwise(F.col(c)).alias(c) if c == "asset_path"
        else F.when(urgent, F.concat(F.col(c), F.lit("# reviewed\n"))).otherwise(F.col(c)).alias(c) if c == "source" else F.col(c)
        for c in nb.columns[:-1]])
    return before, after
