"""Label lists: alias lookup, strict cleaning, parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwork.catalog.base import query, table
from siftwork.functions.aliases import COUNTRY_ALIASES
from siftwork.functions.labels import (
    canonical_label,
    iso_entries,
    parse_labels,
    strict_entries,
)
from siftwork.operators.lookup import clean_column, with_name


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


ALIAS_SQL = "aliases(k, v) AS (VALUES " + ", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in COUNTRY_ALIASES.items()) + ")"
CELL = """CASE WHEN n_chars < 200 THEN NULL WHEN n_chars < 300 THEN 'unknown'
  ELSE 'en:' || lang || ', ' || upper(lang) || ' ,Unknown,,' || source || ', usa,' || lang END"""
# The nation table plays the country table: its key is the code.
ORIGIN = """CASE c_mktsegment WHEN 'BUILDING' THEN 'en:NATION_' || CAST(c_nationkey AS {text})
  WHEN 'MACHINERY' THEN ' ' || CAST(c_nationkey AS {text}) || ' ' WHEN 'FURNITURE' THEN 'USA'
  WHEN 'HOUSEHOLD' THEN 'pays-bas' ELSE 'Atlantis' END"""
ORIGINS = """CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 100 THEN 'unknown'
  ELSE {one} || ',en:france, it,' || 'NATION_' || CAST(c_nationkey AS {text}) || ',Atlantis' END"""
STRICT_SQL = f"""{ALIAS_SQL}, strict(k, v) AS (SELECT k, v FROM aliases
  UNION ALL SELECT LOWER(n_name), n_name FROM nation UNION ALL SELECT CAST(n_nationkey AS VARCHAR), n_name FROM nation)"""


def _strict_key(text: str) -> str:
    return f"REPLACE(REPLACE(TRIM(LOWER({text})), 'en:', ''), '-', ' ')"


@query(
    "e1_alias_lookup",
    f"""WITH {ALIAS_SQL} SELECT doc_id, COALESCE(a.v, UPPER(lang)) AS by_code, COALESCE(b.v, TRIM('  ' || source || ' ')) AS by_source
       FROM documents LEFT JOIN aliases a ON a.k = LOWER(TRIM(lang)) LEFT JOIN aliases b ON b.k = LOWER(TRIM(source))""",
)
def alias_lookup(spark, sf_dir):
    df = table(spark, sf_dir, "documents")
    return df.select(
        "doc_id",
        canonical_label(F.concat(F.lit(" "), F.upper("lang"))).alias("by_code"),
        canonical_label(F.concat(F.lit("  "), F.col("source"), F.lit(" "))).alias("by_source"),
    )


def _entries(spark, sf_dir) -> dict[str, str]:
    nation = table(spark, sf_dir, "nation")
    return strict_entries(iso_entries(nation, ["n_nationkey"], "n_name"))


@query(
    "e2_strict_lookup",
    f"""WITH {STRICT_SQL}, c AS (SELECT c_custkey, {ORIGIN.format(text='VARCHAR')} AS origin FROM customer)
       SELECT c_custkey, v AS country FROM c LEFT JOIN strict ON strict.k = {_strict_key('origin')}""",
)
def strict_lookup(spark, sf_dir):
    origin = F.expr(ORIGIN.format(text="STRING"))
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return with_name(df, origin, "country", _entries(spark, sf_dir)).select("c_custkey", "country")


CLEAN_SQL = f"""WITH {STRICT_SQL},
  c AS (SELECT c_custkey, {ORIGINS.format(one=ORIGIN.format(text='VARCHAR'), text='VARCHAR')} AS cell FROM customer),
  p AS (SELECT c_custkey, UNNEST(string_split(cell, ',')) AS part FROM c WHERE cell IS NOT NULL AND cell <> 'unknown'),
  j AS (SELECT c_custkey, string_agg(DISTINCT v, ',' ORDER BY v) AS joined FROM p JOIN strict
        ON strict.k = {_strict_key('part')} GROUP BY 1)
  SELECT c.c_custkey, COALESCE(joined, 'unknown') AS countries"""


@query("e3_clean_list", f"{CLEAN_SQL} FROM c LEFT JOIN j ON j.c_custkey = c.c_custkey")
def clean_cells(spark, sf_dir):
    cell = F.expr(ORIGINS.format(one=ORIGIN.format(text="STRING"), text="STRING"))
    df = table(spark, sf_dir, "customer").select("c_custkey", cell.alias("countries"))
    return clean_column(df, "countries", _entries(spark, sf_dir))


@query(
    "e4_parse_list",
    f"""WITH {ALIAS_SQL}, c AS (SELECT doc_id, {CELL} AS cell FROM documents),
       p AS (SELECT doc_id, UNNEST(string_split(cell, ',')) AS part, generate_subscripts(string_split(cell, ','), 1) AS i FROM c),
       n AS (SELECT doc_id, i, COALESCE(v, TRIM(part)) AS label FROM p LEFT JOIN aliases ON k = LOWER(TRIM(part))
             WHERE TRIM(part) <> '' AND LOWER(TRIM(part)) <> 'unknown'),
       j AS (SELECT doc_id, string_agg(label, '|' ORDER BY i) AS labels, COUNT(*) AS n FROM n GROUP BY 1)
       SELECT c.doc_id, COALESCE(labels, '') AS labels, CAST(COALESCE(n, 0) AS INTEGER) AS n
       FROM c LEFT JOIN j ON j.doc_id = c.doc_id""",
)
def parse_cells(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("doc_id", parse_labels(F.expr(CELL)).alias("parsed"))
    return df.select("doc_id", F.array_join("parsed", "|").alias("labels"), F.size("parsed").alias("n"))


@query(
    "e5_clean_column",
    f"{CLEAN_SQL}, c_mktsegment FROM c LEFT JOIN j ON j.c_custkey = c.c_custkey "
    "JOIN customer ON customer.c_custkey = c.c_custkey",
)
def clean_in_table(spark, sf_dir):
    """The cleaned list replaces its column; the rest of the table stays."""
    df = table(spark, sf_dir, "customer")
    cells = df.select("c_custkey", "c_mktsegment", F.expr(ORIGINS.format(one=ORIGIN.format(text="STRING"), text="STRING")).alias("countries"))
    return clean_column(cells, "countries", _entries(spark, sf_dir))
