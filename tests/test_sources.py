"""Sources read by many tasks, and faults gathered in one pass."""

import random

import pytest
from pyspark.sql import functions as F

from strandline.operators import metadata
from strandline.sources import genbank, readers
from strandline.sources.faults import find_faults


@pytest.fixture
def in_pieces(spark):
    def read(size, reader, path):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        return reader(spark, str(path))

    yield read
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_records_are_whole_wherever_a_file_is_split(spark, tmp_path, in_pieces):
    """Every size of piece from some bytes on: marks that a border cuts, records longer than a piece and one-line records."""
    draw = random.Random(5)
    records = [(f"r{i} x", "".join(draw.choices("ACGT", k=draw.choice([1, 9, 70, 400])))) for i in range(40)]
    fasta, flat, paf = tmp_path / "s.fa", tmp_path / "s.gb", tmp_path / "s.paf"
    fasta.write_text("".join(f">{h}\n{s[:60]}\n{s[60:]}\n" for h, s in records))
    flat.write_text("".join(f"LOCUS       x\nVERSION     {h}\nFEATURES             Location\n     gene            1..{len(s)}\nORIGIN\n        1 {s.lower()}\n//\n" for h, s in records))
    paf.write_text("".join(f"{h.split()[0]}\t{len(s)}\t0\t1\t+\tT\t9\t0\t1\t1\t1\t60\n" for h, s in records))
    most = 0
    for size in [61, 97, 333, 1000, 1 << 20]:
        got = in_pieces(size, readers.read_fasta, fasta)
        most = max(most, got.rdd.getNumPartitions())
        assert [(r.header, r.sequence) for r in got.orderBy("record_idx").collect()] == records
        got = in_pieces(size, genbank.read_sequences, flat).orderBy("record_idx").collect()
        assert [(r.accession, r.sequence) for r in got] == [(h.split()[0], s) for h, s in records]
        if size in (333, 1000):
            got = in_pieces(size, genbank.read_features, flat).orderBy("record_idx").collect()
            assert [(r.accession, r.end) for r in got] == [(h.split()[0], len(s)) for h, s in records]
        assert {(r.query_id, r.query_length) for r in in_pieces(size, readers.read_paf, paf).collect()} == {(h.split()[0], len(s)) for h, s in records}
    assert most > 20


def test_genbank_edges(spark, tmp_path):
    path = tmp_path / "x.gb"
    path.write_text("LOCUS       x\r\nACCESSION   Q9\r\nORIGIN\r\n        1 acgu\r\n//\r\n\r\nLOCUS       y\nORIGIN\n//\n")
    assert [(r.accession, r.sequence) for r in genbank.read_sequences(spark, str(path)).orderBy("record_idx").collect()] == [("Q9", "ACGT"), ("", "")]
    assert genbank.read_features(spark, str(path)).count() == 0
    path.write_text("")
    assert genbank.read_sequences(spark, str(path)).count() == genbank.read_features(spark, str(path)).count() == 0
    path.write_text("LOCUS       x\nno sequence\n//\n")
    for read in (genbank.read_sequences, genbank.read_features):
        with pytest.raises(Exception, match="sequence"):
            read(spark, str(path)).collect()


def test_features_are_those_of_parse_record(spark, tmp_path):
    """The rows of features are those of whole records, also where lines are odd, and the sequence is not read for them."""
    line, more = "     {:<16}{}\n".format, (" " * 21 + "{}\n").format
    odd = [
        line("CDS", "complement(join(<1..5,") + more("J00194.1:100..202,7..>90))") + more('/gene="a ""b""') + more("c  ") + more('/product="x') + more("") + more('  y=z"') + more("/gene=second"),
        line("gene", "9") + more("/gene") + more("/gene=late") + line("source", "J1:") + line("note", "order(3^4, 12)") + more('/genes="no"') + more('/translation="MA') + more('KL"'),
        line("misc", "  5..6  ") + "           xx        " + '/product=" a b\t"\n' + "      \n" + "     \n" + line("x", "") + more("8..10") + more('/product="\xa0q"'),
        "    broken\n" + line("gene", "1..2"),
        more("lost") + line("a_name_of_16_and_more", "4..5"),
        line("CDS", "1..2") + "\x0c" + line("CDS", "3"),
        "",
    ]
    heads = ["LOCUS       x\nACCESSION   Q9 z\nVERSION     V.1\n", "LOCUS       x\nVERSION\nACCESSION   Q9\n", "LOCUS       x\n"]
    texts = [h + f"FEATURES             Location/Qualifiers\n{t}ORIGIN\n        1 acgt\n" for t in odd for h in heads] + [heads[0] + "ORIGIN\n"]
    path = tmp_path / "o.gb"
    path.write_text("//\n".join(texts) + "//\n")
    want = [[(record.accession, i, f.type, f.start, f.end, len(f.parts), f.reverse, f.first("product"), f.first("gene")) for i, f in enumerate(record.features)] for record in map(genbank.parse_record, texts)]
    found = genbank.read_features(spark, str(path))
    got = [r[1:] for r in found.orderBy("record_idx", "feature_idx").collect()]
    assert [tuple(r) for r in got] == [x for record in want for x in record] and len(got) > 20
    assert [genbank.features_of(t)[1] for t in texts] == [[x[1:] for x in record] for record in want]


def test_fasta_faults_come_together(spark, tmp_path):
    path = tmp_path / "s.fa"
    path.write_text("ACGT\n>a x\nAC\n>\nGG\n>a y\nAC\n>b\nA\n")
    with pytest.raises(ValueError, match=r"before the first header: ACGT; empty FASTA header at record: 2; repeated sequence ids: a$"):
        readers.read_fasta(spark, str(path), strict=True)
    with pytest.raises(ValueError, match="header at record: 2$"):
        readers.read_fasta(spark, str(path), strict=True, unique="header")
    assert readers.read_fasta(spark, str(path)).count() == 5
    path.write_text("\n")
    with pytest.raises(ValueError, match="no FASTA records"):
        readers.read_fasta(spark, str(path), strict=True)


def test_metadata_faults_come_together(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("sample_id,age,age_range,site.of\nA,x,,p\nA,5,61+,q\n,7,young,r\nB,1,,s,t\n")
    with pytest.raises(ValueError) as wrong:
        readers.read_metadata(spark, str(path))
    for part in ("wider than the header: B", "blank sample_id: (blank)", "wrong age: A x", "unknown age range: (blank) young", "age outside its range: A 5", "repeated sample_id: A"):
        assert part in str(wrong.value)
    path.write_text("sample_id,site.of,_wide\nA,p,1\nB,,2\n")
    meta = readers.read_metadata(spark, str(path))
    assert {tuple(r) for r in meta.collect()} == {("A", "p", "1", "(missing)"), ("B", "(missing)", "2", "(missing)")}
    joined = metadata.join_metadata(spark.createDataFrame([("A",), ("C",)], "sample_id string"), meta)
    assert {(r["sample_id"], r["site.of"]) for r in joined.collect()} == {("A", "p"), ("C", "(missing)")}


def test_faults_are_bounded_and_read_once(spark, tmp_path):
    """A third of the rows share one id, and many others are wrong: the driver gets a few of them, and their number."""
    spark.range(30000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), "id")).alias("sample_id"), F.when(F.col("id") % 2 == 0, "x").otherwise("9").alias("age")).write.parquet(str(tmp_path / "t"))
    calls = spark.sparkContext.accumulator(0)

    def counted(x):
        calls.add(1)
        return x

    read = spark.read.parquet(str(tmp_path / "t")).withColumn("sample_id", F.udf(counted)("sample_id"))
    n, found = find_faults(read, *metadata.row_faults(read.columns), shown=3)
    assert n == 30000
    assert found == {"wrong age": (10001, ["hot x", "s10 x", "s100 x"]), "repeated sample_id": (1, ["hot"])}
    assert calls.value == 30000
    empty = read.limit(0)
    assert find_faults(empty, *metadata.row_faults(empty.columns)) == (0, {})
    with pytest.raises(ValueError, match="and 9996 more"):
        metadata.validated(read)
