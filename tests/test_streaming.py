from carelake.plans.load import load_table, patient_lookup
from carelake.sources.readers import read_csv_table, read_table
from carelake.streaming import stream_load
from helpers import frame, rows


def test_stream_load_is_incremental_and_matches_batch(spark, tmp_path):
    folder = tmp_path / "T_MCOaaC"
    folder.mkdir()
    header = "ETA_NUM;RSA_NUM;NIR_ANO_17;EXE_SOI_DTD;EXE_SOI_DTF\n"
    (folder / "part1.csv").write_text(header + "001;1;N1;29/02/1996;01/03/1996\n001;2;N2;20010105;NA\n")
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    ids = patient_lookup(frame(spark, "BEN_IDT_ANO BEN_NIR_PSA", [("A1", "N1")]))

    q = stream_load(spark, str(folder), "T_MCOaaC", out, ids, ckpt, 2010, 2022)
    q.awaitTermination(120)
    first = read_table(spark, out)
    batch = load_table(read_csv_table(spark, str(folder)), "T_MCOaaC", ids, 2010, 2022)
    assert rows(first, batch.columns) == rows(batch)
    assert first.count() == 2

    # a new file: only its rows are added
    (folder / "part2.csv").write_text(header + "002;7;N3;05JAN2020;\n")
    q = stream_load(spark, str(folder), "T_MCOaaC", out, ids, ckpt, 2010, 2022)
    q.awaitTermination(120)
    after = read_table(spark, out)
    assert after.count() == 3
    assert rows(after.filter("RSA_NUM = '7'").select("EXE_SOI_DTD", "NUM_ENQ")) == [("05/01/2015", "N3")]


def test_two_outputs_of_one_table(spark, tmp_path):
    """Each output has its own bookkeeping: both get all rows, a re-run adds none."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("ETA_NUM;RSA_NUM\n1;2\n1;3\n")
    for out in ("x", "y", "x"):
        q = stream_load(spark, str(tmp_path / "in"), "T_MCOaaUM", str(tmp_path / out))
        q.awaitTermination(120)
        assert q.exception() is None
        assert spark.read.parquet(str(tmp_path / out)).count() == 2
