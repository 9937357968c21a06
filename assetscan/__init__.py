"""assetscan: find, resolve, review, rewrite and check data references in code and
query text at scale, as Spark DataFrame jobs.

Layout:
  assetscan.schemas      fixed values, StructTypes, legal status moves
  assetscan.session      SparkSession builder and checkpoint-dir helper
  assetscan.functions    Column-expression builders (regexes, tokenisers), the small
                         per-cell Python syntax helper used by the extraction job
  assetscan.sources      readers and writers: asset files, control tables, estate generator
  assetscan.operators    DataFrame -> DataFrame operators (cells, extract, resolve, review,
                         rewrite, reconcile, audit, manifest)
  assetscan.plans        stage pipelines composed from operators (discover, scan, apply,
                         validate) and the size-checked lookup join
  assetscan.streaming    incremental scan of newly arriving asset files
"""

__version__ = "0.1.0"
