"""E1 as a fold over tokens: names in every clause, places, texts that cannot be read to their end; places of references in
Python cells; edits made at places only."""
import pytest
from pyspark.sql import functions as F

from assetscan import schemas as S
from assetscan.functions import sqltokens as Q
from assetscan.functions.pysyntax import locate_cell, read_cell
from assetscan.operators import rewrite as RW

READ = [
    ("SELECT * FROM a.t x JOIN b.u y USING (id), c.v", ["a.t", "b.u", "c.v"]),
    ("SELECT * FROM a.t x JOIN b.u y ON x.id = y.id + 1, c.v", ["a.t", "b.u", "c.v"]),
    ("SELECT * FROM a.t x JOIN b.u y ON x.id = CASE WHEN y.k THEN 1 ELSE 2 END, c.v", ["a.t", "b.u", "c.v"]),
    ("SELECT * FROM a.t x JOIN b.u y ON x.id = y.id AND x.d = '2024', c.v", ["a.t", "b.u", "c.v"]),
    ("SELECT * FROM a.t VERSION AS OF 3, b.u", ["a.t", "b.u"]),
    ("SELECT * FROM a.t AS x (c1, c2), b.u", ["a.t", "b.u"]),
    ("SELECT * FROM a.t PIVOT (sum(x) FOR y IN (1, 2)), b.u", ["a.t", "b.u"]),
    ("SELECT * FROM a.t, LATERAL (SELECT max(z) FROM b.u WHERE q = 1) l, c.v", ["a.t", "b.u", "c.v"]),
    ("SELECT * FROM (SELECT * FROM ((SELECT 1 FROM a.t))) x, b.u", ["a.t", "b.u"]),
    ("OPTIMIZE a.t ZORDER BY (x)", ["a.t"]),
    ("SHOW COLUMNS IN a.t", ["a.t"]),
    ("SHOW PARTITIONS a.t", ["a.t"]),
    ("SHOW TABLES IN a.b", []),
    ("SELECT * FROM a . t", ["a.t"]),
    ("SELECT * FROM db.tvf(1, 2), a.t", ["a.t"]),
    ("MERGE INTO a.t t USING b.u u ON t.id = u.id WHEN MATCHED THEN UPDATE SET x = u.x, y = 1 "
     "WHEN NOT MATCHED THEN INSERT (a, b) VALUES (u.a, u.b)", ["a.t", "b.u"]),
    ("INSERT INTO a.t (c1, c2) SELECT x, y FROM b.u", ["a.t", "b.u"]),
    ("INSERT OVERWRITE TABLE a.t PARTITION (d='x') SELECT * FROM b.u; DELETE FROM c.v WHERE id IN (SELECT id FROM d.w)", ["a.t", "b.u", "c.v", "d.w"]),
    ("CREATE OR REPLACE TABLE a.t SHALLOW CLONE b.u", ["a.t", "b.u"]),
    ("SELECT a, b FROM a.t GROUP BY a, b ORDER BY a DESC, b", ["a.t"]),
    ("SELECT * FROM (a.t JOIN b.u ON a.t.x = b.u.x), c.v", ["a.t", "b.u", "c.v"]),
    ("DESCRIBE FUNCTION a.f", []),
    ("SELECT * FROM a.t LATERAL VIEW explode(x) v AS c", ["a.t"]),
    ("SELECT 'FROM x.y', \"z\" FROM a.t WHERE c = 'it''s, q.r' -- JOIN p.q\n/* , r.s */", ["a.t"]),
    ("", []),
]
UNREAD = [
    ("SELECT * FROM IDENTIFIER(:x)", []),
    ("SELECT * FROM {db}.t JOIN a.u", ["a.u"]),
    ("SELECT * FROM a.t WHERE (x = 1", ["a.t"]),
    ("SELECT (SELECT 1 FROM a.t", []),
    ("SELECT 1 FROM", []),
    ("SELECT * FROM a.t)", ["a.t"]),
    ("SELECT * FROM WHERE x = 1", []),
    ("SELECT 'open FROM a.t", ["a.t"]),
]


def test_names_and_places_in_every_clause(spark):
    cases = [(q, n, False) for q, n in READ] + [(q, n, True) for q, n in UNREAD]
    read = Q.read_sql(F.col("q"), qualifiers=True)
    rows = (spark.createDataFrame([(i, q) for i, (q, _, _) in enumerate(cases)], "i int, q string")
            .select("i", "q", read.alias("r")).select("i", "q", "r", Q.table_names(F.col("r")).alias("n")).collect())
    for r in rows:
        assert (r.n, r.r.unread) == (cases[r.i][1], cases[r.i][2]), r.q
        assert all(r.q[f.at:f.at + len(f.text)] == f.text for f in r.r.found), r.q


def test_paths_as_locations_and_as_names(spark):
    text = "CREATE TABLE a.t USING delta LOCATION '/mnt/raw/x'; SELECT '/mnt/value' FROM delta.`dbfs:/mnt/raw/a.b/c` WHERE p = '/mnt/y'"
    r = spark.createDataFrame([(text,)], "q string").select(Q.read_sql(F.col("q")).alias("r")).select("r", Q.path_names(F.col("r")).alias("p"), Q.table_names(F.col("r")).alias("n")).first()
    assert r.p == ["/mnt/raw/x", "dbfs:/mnt/raw/a.b/c"] and r.n == ["a.t"] and not r.r.unread


def test_null_text_names_nothing(spark):
    r = spark.createDataFrame([(None,)], "q string").select(Q.read_sql(F.col("q")).alias("r")).first().r
    assert r.found == [] and r.unread is False


@pytest.mark.parametrize("code,expected", [
    ('é = "ü"; spark.table("a.t"); spark.table(\'b.u\')', ["a.t", "b.u"]),
    ('spark.sql("SELECT * FROM a.t "\n  "JOIN b.u\\nON \\"x\\"")', ['"SELECT * FROM a.t "\n  "JOIN b.u\\nON \\"x\\""']),
    ('# MAGIC %python\n# MAGIC x = spark.table("a.t")\n# MAGIC y = f"/mnt/{x}/y"', ["a.t", 'f"/mnt/{x}/y"']),
    ('spark.table("a." "t")', ['"a." "t"']),
    ('%run ./x "it\'s"\nz = (5\n % 3)\np = "/mnt/a/b"\n!ls', ["/mnt/a/b"]),
    ('# """ note\nrisk_db.exposures.reload()\nlog("db.t")\ncfg["db.t"]', []),
])
def test_places_in_python_cells(code, expected):
    assert [code[s:e] for _, _, s, e, _, _ in locate_cell(code)] == expected


def test_continuation_lines_are_not_magics():
    assert read_cell('z = (5\n % 3)\nspark.table("a.t")') == [("py_table_ref", "a.t")]
    assert read_cell("%pip install x\nif y:\n  %run z\nspark.table('a.t')") == [("py_table_ref", "a.t")]
    assert read_cell("x =") == [("unparsed_cell", "")]


def rewritten(spark, source, edits):
    """`edits`: (cell, original, final)."""
    assets = spark.createDataFrame([("/nb", "python", source)], "asset_path string, language string, source string")
    rows = spark.createDataFrame([("/nb", c, "py_table_ref", o, f) for c, o, f in edits],
                                 "asset_path string, cell_index int, reference_kind string, original_reference string, final_replacement string")
    maps, _ = RW.edit_maps(rows)
    r = RW.rewrite_assets(assets, maps).first()
    return r.new_source, sorted(r.hit_keys)


HEAD, SEP = S.NOTEBOOK_HEADER + "\n\n", S.CELL_SEPARATOR


def test_only_references_are_edited(spark):
    sql = ("# MAGIC %sql\n# MAGIC SELECT db.t.id, x.* FROM db.t -- FROM db.t\n"
           "# MAGIC JOIN db.t_old x ON db.t.id = x.id WHERE name = 'db.t' AND db.t.note <> \"db.t\"")
    py = ('# """ about db.t\nrisk = db.t.reload()\nlog("db.t")\ncfg["db.t"] = spark.table("db.t")\n'
          'spark.sql("SELECT db.t.*, \'db.t\' AS n FROM db.t "\n          "WHERE db.t.k = 1")\nx = """ db.t """')
    text, hits = rewritten(spark, HEAD + sql + SEP + py, [(0, "db.t", "m.s.t"), (1, "db.t", "m.s.t")])
    assert text == HEAD + sql.replace("db.t.id", "m.s.t.id").replace("FROM db.t --", "FROM m.s.t --").replace("db.t.note", "m.s.t.note") + SEP + (
        '# """ about db.t\nrisk = db.t.reload()\nlog("db.t")\ncfg["db.t"] = spark.table("m.s.t")\n'
        'spark.sql("SELECT m.s.t.*, \'db.t\' AS n FROM m.s.t "\n          "WHERE m.s.t.k = 1")\nx = """ db.t """')
    assert hits == ["0\u0001db.t", "1\u0001db.t"]


def test_whole_literals_nested_places_and_other_cells(spark):
    py = 'a = spark.table("db." "t")\nb = spark.table(f"/mnt/{x}/t")\np = "dbfs:/mnt/raw/gl"\nq = r\'/mnt/raw/gl\''
    text, hits = rewritten(spark, HEAD + py + SEP + 'spark.table("db.t")', [
        (0, "db.t", 'm.s."t'), (0, 'f"/mnt/{x}/t"', '"m.s.x"'), (0, "dbfs:/mnt/raw/gl", "/Volumes/m/s/gl"), (0, "/mnt/raw/gl", "/Volumes/m/s/gl"), (0, "no.where", "m.s.n")])
    assert text == HEAD + 'a = spark.table("m.s.\\"t")\nb = spark.table("m.s.x")\np = "/Volumes/m/s/gl"\nq = r\'/Volumes/m/s/gl\'' + SEP + 'spark.table("db.t")'
    assert hits == sorted("0\u0001" + o for o in ("db.t", 'f"/mnt/{x}/t"', "dbfs:/mnt/raw/gl", "/mnt/raw/gl"))


def test_locations_in_sql_are_edited_and_crlf_kept(spark):
    src = HEAD + "# MAGIC %sql\r\n# MAGIC CREATE TABLE x.y LOCATION '/mnt/raw/a'\r\n# MAGIC AS SELECT * FROM delta.`/mnt/raw/a`\r\n"
    text, _ = rewritten(spark, src, [(0, "/mnt/raw/a", "/Volumes/m/s/a")])
    assert text == src.replace("/mnt/raw/a", "/Volumes/m/s/a")
