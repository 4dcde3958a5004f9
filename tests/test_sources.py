"""Readers and writers on small files."""

import pytest
from pyspark.sql import functions as F

from loomspan.sources import readers as r
from loomspan.sources import sinks


def put(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return f"file://{path}"


def test_gff_round_trip_with_mark(spark, tmp_path):
    text = "##gff-version 3\nc1\ts\tmRNA\t1\t90\t5\t+\t.\tID=g1;est=3;k=11\nc1\ts\texon\t1\t40\t.\t+\t.\tParent=g1;x=a=b;x=c\nc1\ts\tmatch\t5\t9\t.\t.\t.\tTarget=t9 1 5\nc1\ts\tgap\t5\t9\t.\t.\t.\t\n"
    rows = r.gff(spark, put(tmp_path, "a.gff", text))
    got = rows.orderBy("row_no").collect()
    assert [x["id"] for x in got][:3] == ["g1", "g1", "t9"] and got[3]["id"].startswith("N")
    assert got[1]["attrs"] == {"Parent": "g1", "x": "a=b"} and got[0]["attrs"]["k"] == "11" and got[0]["begin"] == 1
    out = f"file://{tmp_path}/out"
    sinks.write_gff(rows.where("type = 'mRNA'"), out, "est", F.lit("7/9"))
    assert spark.read.text(out).collect()[0][0] == "c1\ts\tmRNA\t1\t90\t5\t+\t.\tID=g1;k=11;est=7/9"


def test_gene_records_rename_repeated_ids(spark, tmp_path):
    row = "c1\ts\t{}\t{}\t{}\t.\t+\t.\t{}\n"
    text = row.format("mRNA", 1, 9, "ID=g") + row.format("exon", 1, 9, "Parent=g") + row.format("mRNA", 20, 29, "ID=g") + row.format("CDS", 20, 29, "Parent=g")
    genes, parts = r.gene_records(r.gff(spark, put(tmp_path, "a.gff", text)))
    assert sorted((x["gid"], x["begin"]) for x in genes.collect()) == [("g", 1), ("g.2", 20)]
    assert sorted((x["gid"], x["begin"]) for x in parts.collect()) == [("g", 1), ("g.2", 20)]


def test_gtf(spark, tmp_path):
    got = r.gtf(spark, put(tmp_path, "a.gtf", 'c1\ts\texon\t1\t9\t.\t+\t.\tgene_id "g1"; transcript_id "t1";\n')).first()
    assert (got["gene_id"], got["transcript_id"], got["end"]) == ("g1", "t1", 9)


def test_blast_checks_columns_and_turns_targets(spark, tmp_path):
    line = "q1\tt1\t99.5\t100\t0\t0\t1\t100\t200\t101\t1e-30\t180.5\n"
    got = r.blast(spark, put(tmp_path, "a.tab", "# head\n" + line)).first()
    assert (got["tb"], got["te"], got["strand"], got["evalue"]) == (101, 200, "-", 1e-30)
    with pytest.raises(Exception, match="12 columns"):
        r.blast(spark, put(tmp_path, "b.tab", "q1\tt1\t99\n")).collect()


def test_psl_blocks(spark, tmp_path):
    line = "\t".join(map(str, [59, 9, 0, 0, 1, 823, 1, 96, "+", "q", 1000, 10, 900, "t", 5000, 100, 264, 2, "30,38,", "10,862,", "100,226,"]))
    got = r.psl(spark, put(tmp_path, "a.psl", "psLayout\n\n" + line + "\n")).orderBy("block").collect()
    assert [(x["qb"], x["qe"], x["tb"], x["te"]) for x in got] == [(11, 40, 101, 130), (863, 900, 227, 264)]


def test_lastz_and_keyed_tables(spark, tmp_path):
    got = r.lastz(spark, put(tmp_path, "a.lz", "#name1\tname2\tidPct\nq\tt\t71.9%\n")).first()
    assert got["name1"] == "q" and got["idPct"] == 71.9
    got = r.keyed_table(spark, put(tmp_path, "n.tab", "#id\tsize\na\t12\nb\tna\n"), ["id", "size"], size="long").orderBy("id").collect()
    assert [(x["id"], x["size"]) for x in got] == [("a", 12), ("b", None)]
    got = r.key_values(spark, put(tmp_path, "kv", "g1 ref est=3/9 ho=a=b\ng2 est=1\n")).orderBy("gene", "key").collect()
    assert [tuple(x) for x in got] == [("g1", "ref", "est", "3/9"), ("g1", "ref", "ho", "a=b"), ("g2", None, "est", "1")]


def test_clusters(spark, tmp_path):
    text = ">Cluster 0\n0\t100nt, >a... *\n1\t90nt, >b... at 1:90:1:90/+/99.5%\n>Cluster 1\n0\t50aa, >c... *\n"
    got = r.clusters(spark, put(tmp_path, "a.clstr", text)).orderBy("cluster", "id").collect()
    assert [(x["cluster"], x["id"], x["length"], x["is_main"], x["pct"]) for x in got] == [(0, "a", 100, True, None), (0, "b", 90, False, 99.5), (1, "c", 50, True, None)]


def test_fasta_round_trip(spark, tmp_path):
    rows = r.fasta(spark, put(tmp_path, "a.fa", ">s1 aalen=3; clen=9;\nATGAAA\nTAA\n>s2\nAC\n"))
    assert sorted((x["id"], x["seq"], x["attrs"].get("clen")) for x in rows.collect()) == [("s1", "ATGAAATAA", "9"), ("s2", "AC", None)]
    out = f"file://{tmp_path}/out"
    sinks.write_fasta(rows, out, 4)
    again = r.fasta(spark, out)
    assert sorted((x["id"], x["seq"]) for x in again.collect()) == [("s1", "ATGAAATAA"), ("s2", "AC")]


def test_fastq_pairs(spark, tmp_path):
    rows = r.fastq(spark, put(tmp_path, "a.fq", "@r1/1\nACGT\n+\nIIII\n@r1/2\nGGTT\n+\n@III\n@r2/1\nCCAA\n+\nIIII\n"))
    pairs, singles = r.pairs_of(rows)
    assert [tuple(x) for x in pairs.collect()] == [("r1", "ACGT", "GGTT")]
    assert [x["id"] for x in singles.collect()] == ["r2"]


def test_sam_bed_agp_pileup(spark, tmp_path):
    line = "r1\t16\tc1\t10\t60\t3S5M4N2M\t*\t0\t0\tAAACCCCCGG\t*\tNM:i:1\tXS:A:+\n"
    got = r.sam(spark, put(tmp_path, "a.sam", "@HD\tVN:1\n" + line)).first()
    assert got["strand"] == "+" and got["opts"] == {"NM": "1", "XS": "+"} and got["loc"] == 10
    got = r.bed(spark, put(tmp_path, "a.bed", "track x\nc1\t0\t10\t2.5\n")).first()
    assert (got["begin"], got["end"], got["value"]) == (1, 10, 2.5)
    got = r.agp(spark, put(tmp_path, "a.agp", "s1\t1\t100\t1\tW\tc1\t1\t100\t-\ns1\t101\t150\t2\tN\t50\tfragment\tyes\t\n")).orderBy("s_begin").collect()
    assert (got[0]["contig"], got[0]["orient"], got[1]["contig"], got[1]["gap"]) == ("c1", "-", None, 50)
    got = r.pileup(spark, put(tmp_path, "a.pile", "c1\t7\tA\t3\t...\tIII\t0\t*\t*\n"), ["x", "y"]).orderBy("library").collect()
    assert [(x["at"], x["library"], x["depth"]) for x in got] == [(7, "x", 3), (7, "y", 0)]


def test_ortholog_tables(spark, tmp_path):
    got = r.ortholog_hits(spark, put(tmp_path, "a.bpo", "1;q;100;s;90;1e-20;80;1:1-50:2-51.2:60-90:61-91.\n")).first()
    assert got["q_len"] == 100 and [tuple(x) for x in got["spans"]] == [(1, 50, 2, 51), (60, 90, 61, 91)]
    got = r.ortholog_groups(spark, put(tmp_path, "g.out", "ORTHO7(2 genes,2 taxa):\t a1(fly) b2(bee)\n")).orderBy("gene").collect()
    assert [tuple(x) for x in got] == [("ORTHO7", "a1", "fly"), ("ORTHO7", "b2", "bee")]


def test_config():
    text = "evidence\nest est.gff\n+ more.gff # two\nend\nevoption\nest -pct 10\nend\n"
    assert r.config(text.splitlines()) == {"evidence": {"est": ["est.gff", "more.gff"]}, "evoption": {"est": ["-pct 10"]}}


def test_table_bed_class_and_hint_writers(spark, tmp_path):
    rows = spark.createDataFrame([("c1", 1, 10, 2.0, "a"), ("c1", 20, 30, 0.0, "b")], "ref string, begin long, end long, value double, class string")
    sinks.write_bed(rows.where("begin = 1"), f"file://{tmp_path}/bed", log=True)
    assert spark.read.text(f"file://{tmp_path}/bed").first()[0] == "c1\t0\t10\t1.099"
    sinks.write_table(rows.where("begin = 1").withColumn("class", F.lit(None).cast("string")), f"file://{tmp_path}/tab")
    assert [x[0] for x in spark.read.text(f"file://{tmp_path}/tab").collect()] == ["ref\tbegin\tend\tvalue\tclass", "c1\t1\t10\t2.0\tna"]
    sinks.write_classes(rows, f"file://{tmp_path}/cls")
    assert spark.read.parquet(f"file://{tmp_path}/cls/class=a").count() == 1
    exons = spark.createDataFrame([(1, "c1", "-", 1, 1, 10), (1, "c1", "-", 2, 20, 30)], "gid long, ref string, strand string, exon_no long, begin long, end long")
    got = sorted((x["type"], x["begin"], x["end"]) for x in sinks.hint_rows(exons).collect())
    assert got == [("ass", 11, 11), ("dss", 19, 19), ("exonpart", 1, 10), ("exonpart", 20, 30), ("intronpart", 11, 19)]
