import pytest

from taxaweave.sources import genbank, text
from taxaweave.streaming.genbank import stream_genbank

RECORDS = '''LOCUS       AB000001
ACCESSION   AB000001 XY99
  ORGANISM  Agaricus `testus` var. minor
            Eukaryota; Fungi; Basidiomycota;
            Agaricomycetes; Agaricus.
REFERENCE   1  (bases 1 to 20)
  AUTHORS   Doe,J. and
            Roe,R.
  TITLE     A title
  JOURNAL   Some J. 1
REFERENCE   2  (bases 1 to 20)
  AUTHORS   Nobody,N.
  TITLE     Ignored
FEATURES             Location/Qualifiers
                     /specimen_voucher="V 1"
                     /strain="S`1"
                     /country="Sweden: a very
                     long place"
                     /lat_lon="10.5 S 20 W"
                     /environmental_sample
ORIGIN
        1 acgtnnacgt acgtacgtac
//
LOCUS       AB000002
ACCESSION   AB000002
  ORGANISM  Boletus edulis
            Fungi; Boletales
            ??? odd line
            Boletus.
FEATURES             Location/Qualifiers
                     /host="Picea"
                     /lat_lon="0 N 0 E"
//
LOCUS       AB000003
ACCESSION   AB000003
  ORGANISM  Amanita
            Fungi.
ORIGIN
        1 acgt
//
LOCUS       AB000004
ACCESSION   AB000004
  ORGANISM  Lactarius
            Fungi.
ORIGIN
//
'''


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "records").mkdir()
    (tmp_path / "records" / "r.gb").write_text(RECORDS)
    return tmp_path


def test_genbank(spark, folder):
    rows = {r["accno"]: r for r in genbank.read_genbank(spark, str(folder / "records")).collect()}
    one, two = rows["AB000001"], rows["AB000002"]
    assert sorted(rows) == ["AB000001", "AB000002", "AB000003", "AB000004"]
    assert one["species"] == "Agaricus testus"
    assert one["taxon_string"] == "Eukaryota; Fungi; Basidiomycota; Agaricomycetes; Agaricus"
    assert one["reference"] == "Doe,J. and Roe,R. A title. Some J. 1"
    assert (one["voucher"], one["strain"], one["country"], one["host"]) == ("V 1", "S1", "Sweden: a very", None)
    assert (one["latitude"], one["longitude"], one["environmental_sample"]) == (-10.5, -20.0, True)
    assert one["sequence"] == "ACGTNNACGTACGTACGTAC" and one["proportion_N"] == pytest.approx(0.1)
    assert (two["latitude"], two["longitude"], two["sequence"], two["proportion_N"]) == (0.0, 0.0, None, None)
    assert two["taxon_string"] == "Fungi; Boletales Boletus" and two["environmental_sample"] is False
    assert rows["AB000004"]["sequence"] is None


def test_genbank_limits(spark, folder):
    path = str(folder / "records")
    assert genbank.read_genbank(spark, path, 10).count() == 3
    assert genbank.skipped_count(spark, path, 10) == 1
    odd = genbank.odd_lineage_lines(genbank.entries(spark, path)).collect()
    assert [tuple(r) for r in odd] == [("AB000002", "??? odd line")]
    records = genbank.read_genbank(spark, path)
    assert genbank.require_unique(records) is records
    with pytest.raises(ValueError):
        genbank.require_unique(records.union(records))


def test_genbank_stream_equals_batch(spark, folder):
    stream = stream_genbank(spark, str(folder / "records"))
    run = stream.writeStream.format("memory").queryName("gb_stream").trigger(availableNow=True).start()
    run.awaitTermination(60)
    got = sorted(r["accno"] for r in spark.table("gb_stream").collect())
    assert got == sorted(r["accno"] for r in genbank.read_genbank(spark, str(folder / "records")).collect())


def test_fasta(spark, tmp_path):
    (tmp_path / "a.fst").write_text(">one x\nAC-GT\nAC\n>two\n----\n--\n>three\nT>T\n")
    entries = text.read_fasta(spark, str(tmp_path / "a.fst"))
    kept, dropped = text.split_aligned(entries)
    assert {r["name"]: r["sequence"] for r in kept.collect()} == {"one x": "AC-GTAC", "three": "T>T"}
    assert [r["name"] for r in dropped.collect()] == ["two"]


def test_change_lists(spark, tmp_path):
    from taxaweave.operators import clean

    records = spark.createDataFrame(
        [("1", "a", "x"), ("2", "b", "y"), ("3", "c", None), ("4", "d", "x")], "accno string, species string, host string"
    )
    (tmp_path / "change.tsv").write_text("species\na\tb\nb\tc\nq\tz\n")
    columns, lines = text.read_changes(spark, str(tmp_path / "change.tsv"))
    assert columns == ["species"]
    changed = clean.change_values(records, "species", lines.drop("column"))
    assert {r["accno"]: r["species"] for r in changed.collect()} == {"1": "c", "2": "c", "3": "c", "4": "d"}
    unused = clean.unused_lines(lines, records, {"old": "species"})
    assert [r["old"] for r in unused.collect()] == ["q"]

    (tmp_path / "update.tsv").write_text("accno\tspecies\thost\n1\tnew\tpine\n1\tnewer\toak\n9\tn\tn\n")
    _, updates = text.read_rows(spark, str(tmp_path / "update.tsv"))
    updated = {r["accno"]: (r["species"], r["host"]) for r in clean.update_by_key(records, "accno", updates, "line").collect()}
    assert updated["1"] == ("newer", "oak") and updated["3"] == ("c", None)

    (tmp_path / "remove.tsv").write_text("species\thost\na\tx\nd\ty\n")
    columns, removals = text.read_rows(spark, str(tmp_path / "remove.tsv"))
    assert sorted(r["accno"] for r in clean.remove_matching(records, removals, columns).collect()) == ["2", "3", "4"]


def test_change_chain_respects_line_order(spark):
    from taxaweave.operators.clean import close_changes

    lines = spark.createDataFrame([(1, "b", "c"), (2, "a", "b"), (3, "c", "d")], "line int, old string, new string")
    assert {r["old"]: r["new"] for r in close_changes(lines).collect()} == {"a": "b", "b": "d", "c": "d"}
