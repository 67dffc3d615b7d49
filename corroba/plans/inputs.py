"""Domain tables made from the star-schema tables of a data folder.

Each is one SQL text that Spark and DuckDB both run, so queries and their SQL start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "benchmark")

_FIRST = "trim(substr('Ada   Boris Cyd   Dee   Elias Fay   Gus   Hal   ', CAST(1 + 6 * (c_custkey % 8) AS INT), 6))"
_LAST = "trim(substr('Quist  Lind   Marsh  Novak  Orr    Pike   Reyes  Stone  ', CAST(1 + 7 * (CAST(floor(c_custkey / 8) AS BIGINT) % 8) AS INT), 7))"

SQL: dict[str, str] = {
    # names in the spellings that normalisation has to undo
    "raw_names": f"""SELECT key, CASE key % 15
        WHEN 0 THEN f || ' ' || l WHEN 1 THEN upper(l) || ', ' || upper(f) || ' B.' WHEN 2 THEN 'Dr. ' || f || ' ' || l
        WHEN 3 THEN f || ' ' || l || ', Esq.' WHEN 4 THEN f || ' M. ' || l WHEN 5 THEN f || ' ' || l || ' (pilot)'
        WHEN 6 THEN 'Unknown Person ' || CAST(key AS STRING) WHEN 7 THEN 'Victim #' || CAST(key AS STRING) WHEN 8 THEN '(b)(6)'
        WHEN 9 THEN 'Mr. ' || l WHEN 10 THEN f || ' ' || f || ' ' || l WHEN 11 THEN f || '  ' || l || ' Jr.'
        WHEN 12 THEN lower(f) WHEN 13 THEN f || ' ' || l || 'e' ELSE upper(f || ' ' || l || '-' || f) END AS name
        FROM (SELECT c_custkey AS key, {_FIRST} AS f, {_LAST} AS l FROM {{customer}}) n""",
    "entities": """SELECT 'PER-' || lpad(CAST(c_custkey AS STRING), 5, '0') AS canonical_id, 'person' AS entity_type, c_name AS canonical_name,
        CASE WHEN c_custkey % 40 = 7 THEN '{{"exclude_from_analysis": true, "category": "' || lower(c_mktsegment) || '"}}' ELSE '{{"category": "' || lower(c_mktsegment) || '"}}' END AS metadata FROM {customer}
        UNION ALL SELECT 'ORG-' || lpad(CAST(s_suppkey AS STRING), 5, '0'), 'organization', s_name, '{{}}' FROM {supplier}
        UNION ALL SELECT 'LOC-' || lpad(CAST(n_nationkey AS STRING), 5, '0'), 'location', n_name, '{{}}' FROM {nation}""",
    "lines": """SELECT o.o_custkey, l.l_suppkey, l.l_orderkey, l.l_linenumber, l.l_returnflag, l.l_linestatus, l.l_quantity, CAST(CAST(o.o_orderdate AS DATE) AS STRING) AS d,
        'PER-' || lpad(CAST(o.o_custkey AS STRING), 5, '0') AS source_entity_id, 'ORG-' || lpad(CAST(l.l_suppkey AS STRING), 5, '0') AS target_entity_id, 'EFTA' || lpad(CAST(l.l_orderkey AS STRING), 8, '0') AS doc_key,
        o.o_custkey * 1000000 + l.l_suppkey * 10 + CASE l.l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS relationship_id,
        CASE l.l_returnflag WHEN 'A' THEN 'associated_with' WHEN 'N' THEN 'financial' ELSE 'communicated_with' END AS relationship_type,
        CASE WHEN l.l_linenumber % 4 = 3 THEN 'corpus' WHEN l.l_returnflag = 'R' THEN 'documents' WHEN l.l_linestatus = 'F' THEN 'registry' ELSE 'triples' END AS source_system
        FROM {lineitem} l JOIN {orders} o ON o.o_orderkey = l.l_orderkey""",
    "relationships": """SELECT relationship_id, source_entity_id, target_entity_id, relationship_type, CAST(count(*) AS DOUBLE) AS weight, min(d) AS date_start, max(d) AS date_end
        FROM ({lines}) x GROUP BY relationship_id, source_entity_id, target_entity_id, relationship_type""",
    "sources": """SELECT min(l_orderkey * 10 + l_linenumber) AS id, relationship_id, source_system, max(CASE WHEN l_linestatus = 'F' THEN relationship_type ELSE 'associated_with' END) AS source_relationship_type
        FROM ({lines}) x GROUP BY relationship_id, source_system""",
    # parts named together in an order
    "mentions": """SELECT 'EFTA' || lpad(CAST(l_orderkey AS STRING), 8, '0') AS doc_key, l_partkey AS pos, 'ITM-' || lpad(CAST(l_partkey AS STRING), 9, '0') AS canonical_id
        FROM {lineitem} GROUP BY l_orderkey, l_partkey""",
    "mentions_edges": """SELECT CAST(substr(a, 5) AS BIGINT) * 1000000000 + CAST(substr(b, 5) AS BIGINT) AS relationship_id, a AS source_entity_id, b AS target_entity_id, 'co_documented' AS relationship_type, CAST(count(*) AS DOUBLE) AS weight
        FROM (SELECT m.canonical_id AS a, n.canonical_id AS b FROM ({mentions}) m JOIN ({mentions}) n ON m.doc_key = n.doc_key AND m.canonical_id < n.canonical_id) p GROUP BY a, b""",
    "triples": """SELECT l_orderkey * 10 + l_linenumber AS seq, l_suppkey AS actor, o_custkey AS target,
        CASE (l_orderkey + l_linenumber) % 7 WHEN 0 THEN 'traveled with' WHEN 1 THEN 'recalled by phone' WHEN 2 THEN 'was paid by' WHEN 3 THEN 'represented' WHEN 4 THEN 'met with' WHEN 5 THEN 'wrote about' ELSE 'emailed' END AS action FROM ({lines}) x""",
    "raw_refs": """SELECT o_orderkey AS seq, CASE o_orderkey % 5 WHEN 0 THEN 'see efta' || lpad(CAST(o_orderkey AS STRING), 8, '0') || '.pdf' WHEN 1 THEN 'doj_ogr ' || CAST(o_orderkey AS STRING)
        WHEN 2 THEN ' file no. ' || CAST(o_orderkey AS STRING) || ' ' WHEN 3 THEN '' ELSE 'DOJ-OGR-' || CAST(o_orderkey - 3 AS STRING) || ' EFTA' || lpad(CAST(o_orderkey AS STRING), 7, '0') END AS raw FROM {orders}""",
    "log": """SELECT CASE c_custkey % 3 WHEN 0 THEN 'registry' WHEN 1 THEN 'documents' ELSE 'triples' END AS source_system, CAST(c_custkey AS STRING) AS source_entity_id, c_name AS source_entity_name,
        'PER-' || lpad(CAST(c_custkey AS STRING), 5, '0') AS canonical_id, CASE c_custkey % 4 WHEN 0 THEN 'exact' WHEN 1 THEN 'alias' WHEN 2 THEN 'fuzzy' ELSE 'new_entity' END AS match_method,
        CAST(CASE c_custkey % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.95 WHEN 2 THEN 0.9 + (c_custkey % 10) * 0.01 ELSE 1.0 END AS DOUBLE) AS match_confidence FROM {customer}""",
    # two systems' categories of each person
    "categories": """SELECT 'PER-' || lpad(CAST(c_custkey AS STRING), 5, '0') AS canonical_id, 'registry' AS source_system, CASE WHEN c_custkey % 6 = 0 THEN 'associate' ELSE lower(c_mktsegment) END AS category, 1 AS seq FROM {customer}
        UNION ALL SELECT 'PER-' || lpad(CAST(c_custkey AS STRING), 5, '0'), 'documents', CASE WHEN c_custkey % 5 = 0 THEN 'other' WHEN c_custkey % 17 = 0 THEN 'victim' ELSE lower(c_mktsegment) END, 2 FROM {customer} WHERE c_custkey % 7 <> 0""",
    "pages": "SELECT doc_id AS page, CAST(doc_id AS STRING) AS doc, text FROM {documents}",
}


def text(name: str, tables: dict[str, str]) -> str:
    """The SQL of a domain table with base tables named by ``tables``."""
    known = dict(tables)
    for part in SQL:
        if part == name:
            break
        known[part] = SQL[part].format(**known)
    return SQL[name].format(**known)


def oracle(name: str) -> str:
    return text(name, {t: t for t in BASE})


def with_tables(*names: str) -> str:
    """``WITH`` clause that defines the named domain tables for DuckDB."""
    return "WITH " + ", ".join(f"{n} AS ({oracle(n)})" for n in names) + " "


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A domain table, or a base table, of a data folder."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    if name not in SQL:
        return read(name)
    sql = text(name, {t: f"__{t}__" for t in BASE})
    used = {t: read(t) for t in BASE if f"__{t}__" in sql}
    escaped = sql.replace("{", "{{").replace("}", "}}")
    for t in used:
        escaped = escaped.replace(f"__{t}__", "{" + t + "}")
    return spark.sql(escaped, **used)
