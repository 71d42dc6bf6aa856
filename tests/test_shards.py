import pandas as pd

from carelake.plans import build_person, build_stays
from carelake.sources import from_shard_layout, read_year_shards
from helpers import rows


def test_shard_layout_with_null_typed_column(spark, tmp_path):
    # pandas writes an all-missing column of a text frame as a null-typed column
    pd.DataFrame({"ETA_NUM": ["E1"], "RSA_NUM": ["R1"], "YEAR": ["21"], "EXE_SOI_DTD": ["01/02/2021"],
                  "EXE_SOI_DTF": ["03/02/2021"], "NUM_ENQ_IDT": ["P1"]}).to_parquet(tmp_path / "YY_T_MCO21C.parquet")
    pd.DataFrame({"ETA_NUM": ["E1"], "RSA_NUM": ["R2"], "YEAR": ["22"], "EXE_SOI_DTD": ["01/02/2022"],
                  "EXE_SOI_DTF": [None], "NUM_ENQ_IDT": ["P1"]}).to_parquet(tmp_path / "YY_T_MCO22C.parquet")
    # a neighbouring table whose name starts the same must not be read as T_MCOaaC
    pd.DataFrame({"ETA_NUM": ["E9"], "SEQ_NUM": ["S9"], "YEAR": ["22"]}).to_parquet(tmp_path / "YY_T_MCO22CSTC.parquet")
    pd.DataFrame({"ETA_NUM": ["E1", "E1"], "RSA_NUM": ["R1", "R2"], "YEAR": ["21", "22"],
                  "ETA_NUM_GEO": [None, None], "UM_ORD_NUM": ["1", "1"],
                  "RUM_ORD_NUM": [None, None]}).to_parquet(tmp_path / "YY_T_MCO21UM.parquet")
    pd.DataFrame({"NUM_ENQ_IDT": ["P1"], "BEN_DTE_MAJ": ["01/01/2020"]}).to_parquet(tmp_path / "IR_BEN_R.parquet")
    pd.DataFrame({"NUM_ENQ_IDT": ["P1"], "PRS_ACT_QTE": ["2"]}).to_parquet(tmp_path / "ER_PRS_F_2022.parquet")

    c = read_year_shards(spark, str(tmp_path), "T_MCOaaC", range(2010, 2025))
    assert rows(c.select("RSA_NUM", "YEAR", "EXE_SOI_DTF")) == [("R1", "21", "03/02/2021"), ("R2", "22", None)]
    prs = read_year_shards(spark, str(tmp_path), "ER_PRS_F", range(2010, 2025))
    assert rows(prs.select("NUM_ENQ_IDT", "YEAR")) == [("P1", "2022")]

    src = from_shard_layout(spark, str(tmp_path), ["T_MCOaaC", "T_MCOaaUM", "IR_BEN_R", "T_SSRaaC"], 2010, 2024)
    assert src.get("T_SSRaaC") is None
    stays = build_stays(src, build_person(src))
    assert rows(stays.select("stay_id", "finess_geo")) == [("mco_21_E1_R1", "E1"), ("mco_22_E1_R2", "E1")]
