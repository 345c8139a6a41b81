"""The taxon by gene table on the sample tables: customers by order priority."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaweave.operators import export, matrix, naming
from taxaweave.operators.ranking import number_rows
from taxaweave.plans.records import SHARE, scored_documents
from taxaweave.plans.registry import query, table

GENES = ("p1", "p2", "p3", "p4", "p5")
CELLS = """
x AS (SELECT o_custkey AS taxon, 'p' || substring(o_orderpriority, 1, 1) AS gene, o_orderkey AS accno, o_orderstatus FROM orders)
"""
WIDE = "w AS (SELECT taxon, " + ", ".join(
    f"min(accno) FILTER (WHERE gene = '{g}') AS {g}" for g in GENES
) + " FROM x GROUP BY taxon)"


def cells(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("taxon"), F.concat(F.lit("p"), F.substring("o_orderpriority", 1, 1)).alias("gene"),
        F.col("o_orderkey").alias("accno"), "o_orderstatus",
    )


@query(f"WITH {CELLS} SELECT gene, count(*)::BIGINT AS n FROM x GROUP BY gene")
def gene_counts(spark, d):
    return matrix.gene_counts(cells(spark, d))


@query(f"WITH {CELLS}, {WIDE} SELECT * FROM w")
def pivot_alignments(spark, d):
    return matrix.to_wide(cells(spark, d), GENES)


@query(f"WITH {CELLS}, {WIDE} SELECT * FROM w WHERE (p1 IS NOT NULL OR p2 IS NOT NULL) AND p3 IS NOT NULL AND p4 IS NOT NULL")
def anchor_genes(spark, d):
    wide = matrix.to_wide(cells(spark, d), GENES)
    return wide.where(matrix.present(["p1", "p2"], ["p3", "p4"]))


@query(f"WITH {CELLS}, {WIDE} SELECT * FROM w WHERE (p1 IS NOT NULL OR p2 IS NOT NULL) AND (p3 IS NOT NULL OR p4 IS NOT NULL)")
def any_anchor_gene(spark, d):
    wide = matrix.to_wide(cells(spark, d), GENES)
    return wide.where(matrix.present(["p1", "p2"], ["p3", "p4"], every_anchor=False))


@query(f"""
WITH {CELLS}, y AS (SELECT DISTINCT taxon, gene FROM x)
SELECT a.gene AS gene1, b.gene AS gene2, count(*)::BIGINT AS taxa FROM y a JOIN y b
ON a.taxon = b.taxon AND a.gene < b.gene GROUP BY a.gene, b.gene
""")
def gene_pair_shared(spark, d):
    return matrix.gene_pairs(cells(spark, d))


@query("""
WITH RECURSIVE y AS (SELECT DISTINCT conv_id AS taxon, role AS gene FROM conversations),
e AS (SELECT a.gene AS u, b.gene AS v FROM y a JOIN y b ON a.taxon = b.taxon GROUP BY a.gene, b.gene
      HAVING count(*) >= 50 OR a.gene = b.gene),
w AS (SELECT u AS node, u AS reach FROM e UNION SELECT w.node, e.v FROM w JOIN e ON w.reach = e.u),
c AS (SELECT node, min(reach) AS comp FROM w GROUP BY node),
z AS (SELECT comp FROM c GROUP BY comp ORDER BY count(*) DESC, comp LIMIT 1)
SELECT node AS gene FROM c JOIN z USING (comp)
""")
def largest_block(spark, d):
    roles = table(spark, d, "conversations").select(F.col("conv_id").alias("taxon"), F.col("role").alias("gene"))
    return matrix.largest_block(roles, 50)


@query(f"""
WITH {CELLS}, k AS (SELECT taxon, count(DISTINCT gene) AS k FROM x GROUP BY taxon)
SELECT count(*)::BIGINT AS taxa, count(*) FILTER (WHERE k = 5)::BIGINT AS complete,
       round(sum(k) / (count(*) * 5.0), 6)::DOUBLE AS gene_coverage FROM k
""")
def gene_coverage(spark, d):
    return matrix.coverage(cells(spark, d), GENES).withColumn("gene_coverage", F.round("gene_coverage", 6))


# Every document is a taxon of its language's alignment.
@query("""
WITH a AS (SELECT doc_id AS taxon, lang AS gene, replace(text, ' ', '-') AS q, doc_id % 2 = 0 AS is_lead FROM documents),
t AS (SELECT count(DISTINCT taxon) AS taxa FROM a),
g AS (SELECT gene, count(*) AS present, max(length(q)) AS aligned_length,
        sum(length(replace(q, '-', ''))) AS bases, count(*) FILTER (WHERE NOT is_lead) AS non_lead, 1 AS genes
      FROM a GROUP BY gene),
b AS (SELECT * FROM g UNION ALL SELECT NULL, sum(present), sum(aligned_length), sum(bases), sum(non_lead), count(*) FROM g)
SELECT gene, taxa::BIGINT AS taxa, present::BIGINT AS present, aligned_length::BIGINT AS aligned_length,
  bases::BIGINT AS bases, non_lead::BIGINT AS non_lead, round(present::DOUBLE / (taxa * genes), 6) AS gene_coverage,
  round(bases::DOUBLE / (taxa * aligned_length), 6) AS base_coverage, round(non_lead::DOUBLE / present, 6) AS non_lead_share
FROM b, t
""")
def alignment_statistics(spark, d):
    aligned = table(spark, d, "documents").select(
        F.col("doc_id").alias("taxon"), F.col("lang").alias("gene"), F.replace("text", F.lit(" "), F.lit("-")).alias("sequence"),
        (F.col("doc_id") % 2 == 0).alias("is_lead"),
    )
    result = matrix.alignment_statistics(aligned)
    for name in ("gene_coverage", "base_coverage", "non_lead_share"):
        result = result.withColumn(name, F.round(name, 6))
    return result


@query("SELECT lang, round(sum(length(replace(text, ' ', '')))::DOUBLE / (count(*) * max(length(text))), 6) AS base_coverage FROM documents GROUP BY lang")
def nucleotide_coverage(spark, d):
    return table(spark, d, "documents").groupBy("lang").agg(
        F.round(
            F.sum(F.length(F.replace("text", F.lit(" "), F.lit("")))).cast("double")
            / (F.count(F.lit(1)) * F.max(F.length("text"))), 6,
        ).alias("base_coverage")
    )


@query(f"""
WITH s AS (SELECT doc_id, lang, source, length(text) * (1 - {SHARE}) AS score FROM documents),
r AS (SELECT lang, first_value(doc_id) OVER (PARTITION BY lang, source ORDER BY score DESC, doc_id) <> doc_id AS non_lead FROM s)
SELECT lang, round(avg(non_lead::INT), 6) AS non_lead_share, count(*) FILTER (WHERE non_lead)::BIGINT AS non_leads
FROM r GROUP BY lang
""")
def non_lead_share(spark, d):
    from taxaweave.operators.clusters import elect_leads

    leads = elect_leads(scored_documents(spark, d), ["lang", "source"], "doc_id", F.col("score"))
    # Every group has one lead, so the counts suffice.
    return leads.groupBy("lang").agg(
        F.round((F.sum("members") - F.count(F.lit(1))) / F.sum("members"), 6).alias("non_lead_share"),
        (F.sum("members") - F.count(F.lit(1))).alias("non_leads"),
    )


@query("""
WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type)
SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS rn FROM c)
WHERE rn = 1
""")
def majority_name(spark, d):
    return naming.majority_names(table(spark, d, "events"), "user_id", "event_id", "event_type")


@query(r"""
WITH p AS (SELECT p_partkey, replace(regexp_replace(regexp_replace(regexp_replace(p_brand || ' ' || p_type || '. (' || p_name || ')',
  '\s', '_', 'g'), '\(.*\)', '', 'g'), '[-,:;''".\\/]', '_', 'g'), '__', '_') AS n FROM part)
SELECT p_partkey, n || '_' || row_number() OVER (PARTITION BY n ORDER BY p_partkey) AS species_name FROM p
""")
def running_suffix(spark, d):
    parts = table(spark, d, "part").select("p_partkey", F.concat(
        "p_brand", F.lit(" "), "p_type", F.lit(". ("), "p_name", F.lit(")")
    ).alias("species"))
    return naming.numbered_names(parts, "p_partkey").select("p_partkey", "species_name")


@query("""
SELECT lang, n_chars, n FROM (SELECT lang, n_chars, count(*)::BIGINT AS n,
  row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, n_chars) AS rn FROM documents GROUP BY lang, n_chars) WHERE rn = 1
""")
def modal_length(spark, d):
    return matrix.most_frequent(table(spark, d, "documents"), "lang", "n_chars")


@query("""
WITH l AS (SELECT lang AS gene, max(n_chars) AS len, row_number() OVER (ORDER BY lang) AS position FROM documents GROUP BY lang)
SELECT gene, position, sum(len) OVER (ORDER BY position)::BIGINT - len + 1 AS "first",
       sum(len) OVER (ORDER BY position)::BIGINT AS "last" FROM l
""")
def partition_offsets(spark, d):
    documents = table(spark, d, "documents").select(F.col("lang").alias("gene"), F.col("text").alias("sequence"))
    return matrix.partitions(documents, _languages(documents)).withColumn("position", F.col("position").cast("long"))


def _languages(documents):
    """Gene names, in order: one row per gene."""
    return [row["gene"] for row in documents.select("gene").distinct().orderBy("gene").collect()]


@query("SELECT doc_id, '>' || doc_id || chr(10) || text AS entry FROM documents")
def fasta_render(spark, d):
    return table(spark, d, "documents").select("doc_id", export.fasta(F.col("doc_id"), F.col("text")).alias("entry"))


# Texts here are lower-cased first: the two engines upper-case some letters differently.
@query("""
SELECT p_partkey, rpad(p_partkey::VARCHAR, (SELECT max(length(p_partkey::VARCHAR)) FROM part)::INT + 1, ' ')
  || upper(p_name || p_type) AS line FROM part
""")
def phylip_render(spark, d):
    parts = table(spark, d, "part").select("p_partkey", F.concat("p_name", "p_type").alias("sequence"))
    return export.phylip(parts, "p_partkey", "sequence")


@query("""
WITH p AS (SELECT p_partkey, p_name || p_type || p_brand AS s, (SELECT max(length(p_partkey::VARCHAR)) FROM part)::INT + 1 AS w FROM part),
b AS (SELECT *, unnest(range(0, ((length(s) - 1) // 10 + 1)::BIGINT)) AS block FROM p)
SELECT block, p_partkey, CASE WHEN block = 0 THEN rpad(p_partkey::VARCHAR, w, ' ') ELSE repeat(' ', w) END
  || upper(substring(s, block * 10 + 1, 10)) AS line FROM b
""")
def interleave_blocks(spark, d):
    parts = table(spark, d, "part").select("p_partkey", F.concat("p_name", "p_type", "p_brand").alias("sequence"))
    return export.interleaved(parts, "p_partkey", "sequence", 10).withColumn("block", F.col("block").cast("long"))


@query(f"""
WITH {CELLS}, y AS (SELECT taxon, gene, repeat(min(o_orderstatus), substring(gene, 2, 1)::INT) AS s FROM x GROUP BY taxon, gene),
z AS (SELECT taxon, {', '.join(f"max(s) FILTER (WHERE gene = '{g}') AS {g}" for g in GENES)} FROM y GROUP BY taxon)
SELECT taxon, {' || '.join(f"coalesce({g}, repeat('-', {g[1]}))" for g in GENES)} AS sequence FROM z
""")
def concat_gapfill(spark, d):
    status = cells(spark, d).groupBy("taxon", "gene").agg(F.min("o_orderstatus").alias("s"))
    aligned = status.select("taxon", "gene", F.repeat("s", F.substring("gene", 2, 1).cast("int")).alias("sequence"))
    return matrix.concatenate(aligned, GENES)


@query(f"""
WITH {CELLS}, n AS (SELECT taxon, gene, count(*) AS n FROM x GROUP BY taxon, gene HAVING count(*) > 4)
SELECT taxon, max(gene) AS guide FROM n GROUP BY taxon
""")
def linked_guide_gene(spark, d):
    aligned = cells(spark, d).groupBy("taxon", "gene").agg(F.count(F.lit(1)).alias("n")).where("n > 4")
    return matrix.guide_genes(aligned)


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 490000)")
def drop_rogues(spark, d):
    rogues = table(spark, d, "orders").where("o_totalprice > 490000").select(F.col("o_custkey").alias("c_custkey"))
    return matrix.without(table(spark, d, "customer").select("c_custkey", "c_name"), rogues, "c_custkey")


@query(f"""
WITH {CELLS}, k AS (SELECT taxon, count(DISTINCT gene) AS genes FROM x GROUP BY taxon),
r AS (SELECT accno FROM x WHERE gene = 'p1')
SELECT taxon, gene, accno FROM x WHERE accno NOT IN (SELECT accno FROM r)
""")
def remove_accnos(spark, d):
    table_cells = cells(spark, d).select("taxon", "gene", "accno")
    gone = table_cells.where("gene = 'p1'").select("accno")
    return matrix.without(table_cells, gone, "accno")


@query("""
SELECT a.doc_id AS only_in_first FROM documents a WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = a.doc_id)
""")
def tips_missing(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("only_in_first")).join(
        table(spark, d, "labels").select(F.col("doc_id").alias("only_in_first")), "only_in_first", "left_anti"
    )


@query("""
SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice, o_orderkey) AS rank FROM orders
""")
def group_ranks(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return number_rows(orders, ["o_totalprice", "o_orderkey"], ["o_orderstatus"], "rank").select("o_orderkey", "rank")
