import bz2
import gzip

import pytest
from pyspark.sql import functions as F

from satellion.functions import scalars
from satellion.operators import alleles, clustering, ranking
from satellion.plans.stages import Config, Run
from satellion.sources import readers, sinks


def test_ties_and_one_per_read(spark):
    df = spark.createDataFrame([(1, 1, 0.95), (1, 2, 0.95), (1, 3, 0.91)], "item int, key int, score double")
    assert {(r.key, r.ties) for r in ranking.rank_with_ties(df, "item", "score", 0.9).collect()} == {(1, 1), (2, 1)}
    df = spark.createDataFrame([(1, 5, 0.9, 4), (1, 5, 0.9, 7)], "ref int, sid int, score double, read int")
    assert ranking.one_per_group(df, ["ref", "sid"], [F.desc("score"), F.desc("read")]).first().read == 7


def test_multi_mapped(spark):
    schema = "sid int, ref_id int, read_id int, prof_score double, flank_score double, chrom string, first_pos int, last_pos int, read_len int"
    rows = [(1, 1, 1, .9, .9, "a", 10, 20, 100), (1, 2, 2, .91, .9, "a", 50, 60, 100), (2, 3, 3, .9, .9, "a", 10, 20, 100), (2, 4, 4, .91, .9, "b", 50, 60, 100), (2, 5, 5, .95, .9, "b", 50, 60, 100)]
    assert {r.read_id for r in ranking.multi_mapped(spark.createDataFrame(rows, schema)).collect()} == {3, 4}


def test_parity_and_duplicates(spark):
    edges = spark.createDataFrame([(1, 2, 0), (2, 3, 1), (3, 4, 1), (8, 9, 1)], "a long, b long, dir int")
    assert {(r.node, r.cid, r.dir) for r in clustering.parity_components(edges).collect()} == {(1, 1, 0), (2, 1, 0), (3, 1, 1), (4, 1, 0), (8, 8, 0), (9, 8, 1)}
    pairs = spark.createDataFrame([(1, 1, 2), (1, 1, 3)], "ref_id long, a long, b long")
    assert [r.read_id for r in clustering.duplicates_to_drop(pairs).collect()] == [1]
    trs = spark.createDataFrame([(1, 1, 5, 9, "ACGTACGT"), (1, 2, 5, 9, "ACGTACGA"), (1, 3, 5, 9, "TTTTTTTT"), (1, 4, 0, 9, "ACGTACGT")], "ref_id long, read_id long, first int, last int, dna string")
    assert [(r.a, r.b) for r in clustering.duplicate_pairs(trs).collect()] == [(1, 2)]


def test_genotypes(spark):
    sup = [(1, 0, 1, 2), (2, 1, 0, 2), (3, 0, 1, 2), (3, 1, 0, 2), (4, 1, 0, 2), (4, 2, 0, 3), (5, 0, 1, 2), (5, 1, 0, 2), (5, 2, 0, 2)]
    df = spark.createDataFrame([(*r, 0.0, 1) for r in sup], "ref_id long, copies int, same_as_ref int, support long, copies_float double, representative long")
    kinds = ["homez_same", "homez_diff", "hetez_same", "hetez_diff", "hetez_multi"]
    assert {r.ref_id: [k for k in kinds if r[k]] for r in alleles.classify(df).collect()} == {i + 1: [k] for i, k in enumerate(kinds)}
    text = {r.ref_id: (r.gt, r.sp, r.cgl) for r in alleles.allele_strings(df).collect()}
    assert text[1][0] == "0/0" and text[2] == ("1/1", ".,2", ".,1") and text[3] == ("0/1", "2,2", "0,1") and text[4] == ("1/2", ".,2,3", ".,1,2")


def test_scalars(spark):
    df = spark.createDataFrame([("ACGTAC", "ACG")], "n string, m string")
    assert df.select(scalars.anchored_distance("n", "m")).first()[0] == 0
    vals = spark.createDataFrame([("ACGT",), ("AAAA",), ("",)], "s string").select(scalars.entropy("s").alias("e")).collect()
    assert [r.e for r in vals] == [2.0, 0.0, 0.0]
    line = "X7X7MIT1X7T1X7"
    ids = spark.createDataFrame([(line,)], "s string").withColumn("x", scalars.leb36_decode("s"))
    assert list(ids.first().x) == [285, 285, 670, 65, 285, 65, 285] and ids.select(scalars.leb36_encode("x")).first()[0] == line


def test_readers(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.fasta.gz").write_bytes(gzip.compress(b">r1\nACG\nT\n>r2\nGG\n"))
    (tmp_path / "a" / "y.fasta.bz2").write_bytes(bz2.compress(b">r3/1\nTCAGA\n"))
    got = {(r.head, r.dna) for r in readers.read_reads(spark, str(tmp_path / "a"), strip_key=True).collect()}
    assert got == {("r1 vs=0", "ACGT"), ("r2 vs=0", "GG"), ("r3/1", "A")}
    assert list(readers.fastq_records("@r\nAC\nGT\n+\n@@\nII\n@s\nA\n+\nI\n")) == [("r", "ACGT"), ("s", "A")]
    assert list(readers.sam_records("@HD\nq\t65\t*\t0\t0\t*\t*\t0\t0\tAC\tII\nq\t256\t*\t0\t0\t*\t*\t0\t0\tGG\tII\n")) == [("q/1", "AC")]
    (tmp_path / "t.trf").write_text("@r_20_RCYES\n3 9 3 2.0 3 90 0 40 1 2 3 4 1.9 ACG ACGACGA TT .\n")
    t = readers.mirror_reverse(readers.read_trf(spark, str(tmp_path / "t.trf"))).first()
    assert (t["head"], t["first"], t["last"], t["pattern"], t["left_flank"], t["right_flank"], t["n_a"]) == ("r", 12, 18, "CGT", "", "AA", 4)
    (tmp_path / "p.leb36").write_text("17 7 4.43 7 7 X7X7MIT1X7T1X7 Q1T1T1T1X7T1X7 1 22 8 0 CCGG|AGCC\n")
    p = readers.read_leb36(spark, str(tmp_path / "p.leb36"))
    assert p.first().n_c == 22 and sinks.leb36_lines(p).first().value == "-17 7 4.43 7 7 X7X7MIT1X7T1X7 Q1T1T1T1X7T1X7 1 22 8 0 CCGG|AGCC"


def test_stages_resume_and_errors(spark, tmp_path):
    ran = []

    def first(s, out):
        ran.append("first")
        return s.range(3)

    def second(s, out):
        ran.append("second")
        return out["first"].where("id > 0")

    run = Run(spark, str(tmp_path), [("first", first), ("second", second)])
    assert run.run()["second"].count() == 2 and run.run() and ran == ["first", "second"] and run.next_stage() == 2
    run.clear(1)
    assert run.next_stage() == 1
    with pytest.raises(ValueError):
        Config.load("PLOIDY=0")
    assert Config.load("min_support = 3 # x", "MIN_SUPPORT=4", ploidy=1) == Config(min_support=4, ploidy=1)


def test_size_band(spark):
    from satellion.plans import adapters, registry

    d = "/root/testdata/sf0.001"
    rows = [(r.ref_id, r.chrom, len(r.pattern)) for r in adapters.refs(spark, d).collect()]
    want = {(a, b) for a, c, n in rows for b, e, m in rows if c == e and a < b and 10 * abs(n - m) <= n}
    got = [tuple(r) for r in registry.queries()["j24_w10_size_band"](spark, d).collect()]
    assert len(got) == len(want) and set(got) == want


def test_flags_in_one_pass(spark):
    """One pass over scores gives what two rankings and a join give."""
    import random

    from satellion.operators import ranking

    rng = random.Random(1)
    rows = [(i, i % 7, i // 6, rng.choice([0.8, 0.91, 0.95, None]), rng.choice([0.85, 0.9, 0.97])) for i in range(300)]
    df = spark.createDataFrame(rows, "read_id long, ref_id long, sid long, a double, b double")
    rank, flank = (ranking.rank_with_ties(df.select("ref_id", "read_id", "sid", c), "sid", c, least) for c, least in (("a", 0.9), ("b", 0.9)))
    want = {(r.read_id, r.bbb) for r in ranking.mark_best(df.select("ref_id", "read_id"), rank, flank).collect()}
    got = {(r.read_id, r.bbb) for r in ranking.flag_best(df, "sid", ("a", 0.9), ("b", 0.9)).collect()}
    assert got == want and {b for _, b in got} == {0, 1}


def test_stats_outlive_the_session(spark, tmp_path):
    """Stats, errors and post-conditions of a run stand in its folder; another layout is refused."""
    from satellion.plans.stages import PostConditionError, Run, require_count

    stages = [("first", lambda s, out: s.range(3)), ("second", lambda s, out: out["first"].where("id > 0"))]
    checks = {"second": lambda s, out, made: require_count("second", out["first"].count(), made.count())}
    run = Run(spark, str(tmp_path), stages, checks)
    assert run.report() == "first: not run\nsecond: not run"
    with pytest.raises(PostConditionError):
        run.run()
    again = Run(spark, str(tmp_path), stages)
    assert again.stats["first"]["rows"] == 3 and "3 counted, 2 written" in again.stats["second"]["error"] and again.next_stage() == 1
    with pytest.raises(RuntimeError):
        again.run()
    again.clear(1)
    assert Run(spark, str(tmp_path), stages).run()["second"].count() == 2
    assert "0d 0h" in Run(spark, str(tmp_path), stages).report() and "2 rows" in Run(spark, str(tmp_path), stages).report()
    (tmp_path / "stats.json").write_text('{"version": 0, "stages": {}}')
    (tmp_path / ".stats.json.crc").unlink(missing_ok=True)
    with pytest.raises(ValueError):
        Run(spark, str(tmp_path), stages)


def test_two_vcf_tables(spark, tmp_path):
    import glob

    from satellion.sources import sinks

    rows = [("chr1", 9, "td1"), ("chr1", 100, "td2"), ("chr2", 5, "td3")]
    records = spark.createDataFrame([(c, p, i, "PASS", "RC=1", "GT:SP:CGL", "1/1:.,2:.,1") for c, p, i in rows], "chrom string, pos long, id string, filter string, info string, format string, sample string")
    flags = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "ref_id long, support_vntr int")
    sinks.write_vcfs(records, flags, str(tmp_path), {"reads": 7}, "me")
    lines = {n: [x for f in sorted(glob.glob(f"{tmp_path}/{n}/*/part-*")) for x in open(f).read().splitlines()] for n in ("all", "vntr")}
    assert lines["vntr"][1:3] == ["##reads=7", "##records=2"] and lines["vntr"][3].endswith("FORMAT\tme")
    assert [x.split("\t")[:5] for x in lines["all"][4:]] == [[c, str(p), i, ".", "."] for c, p, i in rows]
    assert [x.split("\t")[2] for x in lines["vntr"][4:]] == ["td2", "td3"]


def test_emptied_table(spark, tmp_path):
    from satellion.sources import sinks

    spark.range(5).write.parquet(f"{tmp_path}/t")
    sinks.truncate(spark, f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 0 and spark.read.parquet(f"{tmp_path}/t").columns == ["id"]


def test_detector_output_is_not_cut(spark, tmp_path):
    from satellion.sources.readers import read_trf

    n = (1 << 20) + 3
    (tmp_path / "out.dat").write_text("@r1\n" + "1 9 3 3.0 3 100 0 18 3 3 3 0 1.5 ACG ACGACGACG . .\n" * n)
    assert read_trf(spark, str(tmp_path)).count() == n
