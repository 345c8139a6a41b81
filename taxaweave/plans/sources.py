"""Queries that write the sample tables as files of the formats read here, and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from taxaweave.operators import clean, export, genes, profile_scan
from taxaweave.plans.alignment import BASES, HEX
from taxaweave.plans.registry import query, table
from taxaweave.session import cut_lineage, shared_folder
from taxaweave.sources import genbank, text
from taxaweave.sources.profiles import read_profiles

# Fixed value: bases up to which the written records are loaded.
LONGEST = 2_000


def _folder(spark, kind):
    return f"{shared_folder(spark)}/taxaweave-{kind}-{uuid.uuid4().hex}"


def document_records(spark, d):
    """Path of the documents as records: letters are bases, language and source the lineage."""
    letters = F.lower(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", ""))
    number = F.col("doc_id").cast("string")
    place = F.concat((F.col("doc_id") % 90).cast("string"), F.lit(".5 "), F.when(F.col("doc_id") % 2 == 0, "N").otherwise("S"),
                     F.lit(" "), (F.col("doc_id") % 180).cast("string"), F.lit(".25 "), F.when(F.col("doc_id") % 3 == 0, "W").otherwise("E"))
    record = F.concat_ws(
        "\n", F.concat(F.lit("LOCUS       D"), number), F.concat(F.lit("ACCESSION   D"), number),
        F.concat(F.lit("  ORGANISM  Genus"), F.col("lang"), F.lit(" "), F.col("source"), F.lit(" var. wild")),
        F.concat(F.lit("            Life; "), F.col("lang"), F.lit(";")), F.concat(F.lit("            "), F.col("source"), F.lit(".")),
        F.lit("FEATURES             Location/Qualifiers"),
        F.concat(F.lit('                     /specimen_voucher="V'), number, F.lit('"')),
        F.concat(F.lit('                     /lat_lon="'), place, F.lit('"')),
        F.lit("ORIGIN"), F.concat(F.lit("        1 "), letters), F.lit("//"),
    )
    path = _folder(spark, "records")
    table(spark, d, "documents").select(record).write.text(path)
    return path


_LETTERS = "upper(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g'))"


@query(f"""
SELECT 'D' || doc_id AS accno, 'Genus' || lang || ' ' || source AS species, 'Life; ' || lang || '; ' || source AS taxon_string, 'V' || doc_id AS voucher,
  (CASE WHEN doc_id % 2 = 0 THEN 1 ELSE -1 END * (doc_id % 90 + 0.5))::DOUBLE AS latitude,
  (CASE WHEN doc_id % 3 = 0 THEN -1 ELSE 1 END * (doc_id % 180 + 0.25))::DOUBLE AS longitude,
  length({_LETTERS})::BIGINT AS bases, md5({_LETTERS}) AS digest
FROM documents WHERE length({_LETTERS}) <= {LONGEST}
""")
def genbank_records(spark, d):
    """Documents written as records and read with the record parser, the longest left out."""
    found = genbank.require_unique(genbank.read_genbank(spark, document_records(spark, d), LONGEST))
    sequence = F.coalesce("sequence", F.lit(""))
    return found.select(
        "accno", "species", "taxon_string", "voucher", "latitude", "longitude",
        F.length(sequence).cast("long").alias("bases"), F.md5(sequence).alias("digest"))


@query(f"SELECT count(*)::BIGINT AS skipped FROM documents WHERE length({_LETTERS}) > {LONGEST}")
def skipped_records(spark, d):
    return genbank.skipped(spark, document_records(spark, d), LONGEST)


_GAPPED = f"CASE WHEN p_size % 5 = 0 THEN '--------' ELSE substr(translate(md5(p_name), '{HEX}', '{BASES}'), 1, 20) || '--' END"


def fasta_file(spark, d):
    """Path of the parts as FASTA, some with gaps only."""
    parts = table(spark, d, "part").select(
        F.concat_ws("_", F.lit("part"), F.col("p_partkey").cast("string")).alias("name"),
        F.when(F.col("p_size") % 5 == 0, "--------").otherwise(
            F.concat(F.substring(F.translate(F.md5("p_name"), HEX, BASES), 1, 20), F.lit("--"))).alias("sequence"))
    path = _folder(spark, "fasta")
    parts.select(export.fasta(F.col("name"), F.col("sequence"))).write.text(path)
    return path


@query(f"""
SELECT 'part_' || p_partkey AS name, {_GAPPED} AS sequence, p_size % 5 <> 0 AS kept FROM part
""")
def fasta_round_trip(spark, d):
    """Parts written as FASTA and read back; rows of gaps only are told apart."""
    found = text.read_fasta(spark, fasta_file(spark, d))
    kept, dropped = text.split_aligned(found)
    return kept.withColumn("kept", F.lit(True)).unionByName(
        found.join(dropped, "name", "left_semi").withColumn("kept", F.lit(False)))


@query("""
WITH n AS (SELECT n_name AS old, 'LAND ' || n_nationkey AS new FROM nation WHERE n_nationkey % 2 = 0)
SELECT c_custkey, coalesce(new, n_name) AS country FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN n ON n_name = old
""")
def change_list(spark, d):
    """Nations renamed by a change list that was written and read as a file."""
    nation = table(spark, d, "nation")
    lines = nation.where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("k"), F.concat_ws(
        "\t", "n_name", F.concat(F.lit("LAND "), F.col("n_nationkey").cast("string"))).alias("value"))
    head = spark.range(1).select(F.lit(-1).alias("k"), F.lit("country").alias("value"))
    path = _folder(spark, "changes")
    # A list of as many lines as there are nations, in order.
    head.unionByName(lines).orderBy("k").select("value").coalesce(1).write.text(path)
    columns, changes = text.read_changes(spark, path)
    rows = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("country"))
    return clean.change_values(rows, columns[0], changes.drop("column"))


@query("""
SELECT 'D' || doc_id AS accno, lang || ' odd?' AS line FROM documents
""")
def odd_lineage_lines(spark, d):
    """Lineage lines that are none: the report of the record parser."""
    number = F.col("doc_id").cast("string")
    record = F.concat_ws(
        "\n", F.concat(F.lit("ACCESSION   D"), number), F.lit("  ORGANISM  Genus species"), F.lit("            Life; Kingdom;"),
        F.concat(F.lit("            "), F.col("lang"), F.lit(" odd?")), F.lit("            Genus."), F.lit("ORIGIN"), F.lit("        1 acgt"), F.lit("//"))
    path = _folder(spark, "records")
    table(spark, d, "documents").select(record).write.text(path)
    return genbank.odd_lineage_lines(genbank.entries(spark, path))


# The ends of the region that is planted, as the profiles know them.
HEAD, TAIL = "ACGTTGCATTGACCGTAAGCTTCGGATCCATGACTTGCAA", "TTGGCACGATCCGTATAGGCTAACCTGAGTCAATGC"


def profile_file(spark):
    """Path of a profile file with both ends."""
    def profile(name, consensus):
        lines = ["HMMER3/f", f"NAME  {name}", f"LENG  {len(consensus)}", "ALPH  DNA", "STATS LOCAL VITERBI -8.0 0.71",
                 "HMM          A        C        G        T   ", "            m->m     m->i     m->d     i->m     i->i     d->m     d->d",
                 "  COMPO   1.38 1.38 1.38 1.38", "   1.38 1.38 1.38 1.38", "   0.006 5.7 5.7 1.46 0.26 0.0 *"]
        for i, base in enumerate(consensus, 1):
            last = i == len(consensus)
            lines += [f"  {i} " + " ".join("0.03" if base == b else "4.6" for b in "ACGT") + f" {i} {base} - - -", "   1.38 1.38 1.38 1.38",
                      "   0.003 6.0 * 1.46 0.26 0.0 *" if last else "   0.006 5.7 5.7 1.46 0.26 1.09 0.40"]
        return "\n".join(lines) + "\n//"

    path = _folder(spark, "profiles")
    spark.range(1).select(F.lit(profile("its_start_1", HEAD) + "\n" + profile("its_end_1", TAIL))).coalesce(1).write.text(path)
    return path


def planted_records(spark, d):
    """(accno, sequence): digests of the documents spelled in bases, with a region in some, turned round in every fourth."""
    number = F.col("doc_id")
    digest = lambda mark: F.translate(F.md5(F.concat(F.coalesce("text", F.lit("")), F.lit(mark))), HEX, BASES)
    head = F.when(number % 3 == 0, F.lit(HEAD)).otherwise("")
    tail = F.when(number % 3 != 1, F.lit(TAIL)).otherwise("")
    forward = F.concat(digest("a"), head, digest("b"), tail, digest("c"), F.when(number % 2 == 0, digest("d")).otherwise(""))
    turned = F.reverse(F.translate(forward, "ACGT", "TGCA"))
    return table(spark, d, "documents").select(
        F.concat(F.lit("D"), number.cast("string")).alias("accno"), F.when(number % 4 == 0, turned).otherwise(forward).alias("sequence"))


_DIGEST = "translate(md5(coalesce(text, '') || '{}'), '" + HEX + "', '" + BASES + "')"
_PLANTED = f"""
s AS (SELECT doc_id, {_DIGEST.format('a')} || CASE WHEN doc_id % 3 = 0 THEN '{HEAD}' ELSE '' END || {_DIGEST.format('b')}
    || CASE WHEN doc_id % 3 <> 1 THEN '{TAIL}' ELSE '' END || {_DIGEST.format('c')} || CASE WHEN doc_id % 2 = 0 THEN {_DIGEST.format('d')} ELSE '' END AS forward
  FROM documents)"""


@query(f"""
WITH {_PLANTED},
h AS (SELECT doc_id, 'its_start_1' AS model, 33 AS hit_start, {32 + len(HEAD)} AS hit_end FROM s WHERE doc_id % 3 = 0 UNION ALL
  SELECT doc_id, 'its_end_1', CASE WHEN doc_id % 3 = 0 THEN {65 + len(HEAD)} ELSE 65 END,
    CASE WHEN doc_id % 3 = 0 THEN {64 + len(HEAD) + len(TAIL)} ELSE {64 + len(TAIL)} END FROM s WHERE doc_id % 3 <> 1)
SELECT 'D' || doc_id AS accno, model, CAST(hit_start AS INTEGER) AS hit_start, CAST(hit_end AS INTEGER) AS hit_end, doc_id % 4 = 0 AS reverse FROM h
""")
def profile_hits(spark, d):
    """Planted ends of a region found by the profile scan, on either strand."""
    profiles = read_profiles(spark, profile_file(spark))
    return profile_scan.scan(planted_records(spark, d), profiles, 1e-7).select(
        "accno", "model", F.col("hit_start").cast("int").alias("hit_start"), F.col("hit_end").cast("int").alias("hit_end"), "reverse")


@query(f"""
WITH {_PLANTED}
SELECT 'its' AS gene, 'D' || doc_id AS accno, CASE WHEN doc_id % 3 = 0 THEN substr(forward, 33, {32 + len(HEAD) + len(TAIL)})
  ELSE substr(forward, 1, {64 + len(TAIL)}) END AS sequence FROM s WHERE doc_id % 3 <> 1
""")
def gene_slices(spark, d):
    """The planted regions cut out of their records, as the gene parser does it."""
    records = planted_records(spark, d)
    hits = cut_lineage(profile_scan.scan(records, read_profiles(spark, profile_file(spark)), 1e-7))
    turned = profile_scan.turn_records(records, hits)
    return genes.slices(genes.intervals(genes.resolve_hits(genes.name_parts(hits))), turned)
