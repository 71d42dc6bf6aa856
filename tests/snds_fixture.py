"""A small hand-made claims delivery with the edge cases of each table build.

Patients P1-P3 are known; P9 is not.  Hospital stays: MCO E1/R1 (P1), E1/R2 (P2),
E1/R3 (P9, dropped), a control row with a null facility (no stay); ACE E2/S1 (P3);
SSR E3/H1 (P1), E3/H2 (no first weekly summary).  No HAD table (missing branch).
City care: claims K1 (P1) and K2 (P2, null flux part); K3 has no claim.
"""

from __future__ import annotations

from carelake.sources.tables import Sources
from helpers import frame


def flux(n: int, ord_: str | None = "1") -> tuple:
    return (f"01/0{n}/2022", f"02/0{n}/2022", "1", f"E{n}", ord_, "O", "1", "1", "0")


FLUX_COLS = ("FLX_DIS_DTD FLX_TRT_DTD FLX_EMT_TYP FLX_EMT_NUM FLX_EMT_ORD ORG_CLE_NUM DCT_ORD_NUM "
             "PRS_ORD_NUM REM_TYP_AFF")
K1, K2, K3 = flux(1), flux(2, None), flux(3)
KEY1 = "01/01/2022_02/01/2022_1_E1_1_O_1_1_0"
KEY2 = "01/02/2022_02/02/2022_1_E2_O_1_1_0"


def delivery(spark) -> Sources:
    t = {}
    t["IR_BEN_R"] = frame(spark, "NUM_ENQ_IDT BEN_NAI_ANN BEN_SEX_COD BEN_RES_DPT BEN_RES_COM BEN_DTE_MAJ BEN_DCD_DTE", [
        ("P1", "1950", "1", "75", "056", "01/01/2020", None),
        ("P1", "1950", "1", "75", "101", "01/06/2021", None),
        ("P2", "1960", "2", "13", "055", None, "03/03/2022"),
        ("P2", "1960", "2", "13", "001", None, None),
        ("P3", "1970", "1", "69", "123", "05/05/2019", None),
        (" ", "1980", "1", "01", "000", "01/01/2020", None),
        (None, "1990", "2", "02", "000", "01/01/2020", None),
    ])
    t["KI_CCI_R"] = frame(spark, "NUM_ENQ_IDT BEN_DCD_DTE DCD_CIM_COD", [
        ("P1", "10/10/2023", "C50"), ("P1", "01/10/2023", "C51"), ("P9", "01/01/2020", "X00")])
    t["KI_ECD_R"] = frame(spark, "NUM_ENQ_IDT ECD_CIM_COD ECD_CAU_RNG", [
        ("P1", "I10", "1"), ("P9", "J10", "2")])
    t["IR_IMB_R"] = frame(spark, "NUM_ENQ_IDT MED_MTF_COD IMB_ALD_DTD IMB_ALD_DTF UPD_DTE IMB_ETM_NAT", [
        ("P1", "C50", "01/01/2020", "31/12/2020", "01/01/2020", "41"),
        ("P1", "C50", "01/01/2021", None, "01/06/2021", "42"),
        ("P1", "C50", "01/06/2019", "01/06/2020", None, "43"),
        ("P2", "E11", "01/01/2018", "01/01/2028", "01/01/2019", "41"),
        ("P2", "E11", "01/01/2017", "01/01/2027", "01/01/2019", "40"),
        ("P9", "X00", "01/01/2018", None, None, "1"),
    ])
    t["T_MCOaaC"] = frame(spark, "ETA_NUM RSA_NUM YEAR EXE_SOI_DTD EXE_SOI_DTF NUM_ENQ_IDT", [
        ("E1", "R1", "22", "01/02/2022", "05/02/2022", "P1"),
        ("E1", "R1", "22", "01/02/2022", "05/02/2022", "P1"),
        ("E1", "R2", "22", "10/03/2022", "12/03/2022", "P2"),
        ("E1", "R3", "22", "01/04/2022", "02/04/2022", "P9"),
        (None, "R4", "22", "01/05/2022", None, "P3"),
    ])
    t["T_MCOaaUM"] = frame(spark, "ETA_NUM RSA_NUM YEAR ETA_NUM_GEO UM_ORD_NUM RUM_ORD_NUM AUT_TYP1_UM PAR_DUR_SEJ", [
        ("E1", "R1", "22", "G1", "1", None, "01", "3"),
        ("E1", "R1", "22", "G2", "2", None, "02", "1"),
        ("E1", "R1", "21", "G9", "1", None, "09", "9"),
        ("E1", "R2", "22", None, "1", "2", "03", "2"),
        ("E1", "R2", "22", None, "2", "1", "04", "0"),
        ("E1", "R3", "22", "G3", "1", None, "05", "1"),
        (None, "R4", "22", "G4", "1", None, "06", "2"),
    ])
    t["T_MCOaaCSTC"] = frame(spark, "ETA_NUM SEQ_NUM YEAR EXE_SOI_DTD EXE_SOI_DTF NUM_ENQ_IDT", [
        ("E2", "S1", "22", "07/07/2022", "07/07/2022", "P3")])
    t["T_MCOaaFBSTC"] = frame(spark, "ETA_NUM SEQ_NUM YEAR ETA_NUM_GEO", [
        ("E2", "S1", "22", None), ("E2", "S1", "22", None)])
    t["T_SSRaaC"] = frame(spark, "ETA_NUM RHA_NUM YEAR EXE_SOI_DTD EXE_SOI_DTF NUM_ENQ_IDT", [
        ("E3", "H1", "21", "01/01/2021", "31/01/2021", "P1"),
        ("E3", "H2", "21", "01/02/2021", "bad", "P2")])
    t["T_SSRaaB"] = frame(spark, "ETA_NUM RHA_NUM YEAR ETA_NUM_GEO RHS_NUM AUT_TYP_UM UM_ORD_NUM", [
        ("E3", "H1", "21", "S9", "001", "A1", "1"),
        ("E3", "H1", "21", "S9", "002", "A2", "2"),
        ("E3", "H2", "21", None, "1", "A3", "1")])
    t["T_MCOaaA"] = frame(spark, "ETA_NUM RSA_NUM YEAR CDC_ACT PHA_ACT ACV_ACT ENT_DAT_DEL NBR_EXE_ACT", [
        ("E1", "R1", "22", "AAA1", "0", "1", None, "2"),
        ("E1", "R1", "22", "AAA1", "1", "01", None, None),
        ("E1", "R1", "22", "AAA2", "0", "2", "3", "1"),
        ("E1", "R1", "22", "AAA3", "0", "x", "3", "1"),
        ("E1", "R1", "22", "AAA4", "2", "1", "3", "1"),
        ("E1", "R1", "22", "AAA5", "0", "1", "3", "4"),
        ("E1", "R3", "22", "AAA6", "0", "1", None, "1")])
    t["T_SSRaaCSARR"] = frame(spark, "ETA_NUM RHA_NUM YEAR CSARR_COD ENT_DAT_DEL_UM NBR_CSARR", [
        ("E3", "H1", "21", "CS1", "x", "2")])
    t["T_MCOaaB"] = frame(spark, "ETA_NUM RSA_NUM YEAR DGN_PAL", [
        ("E1", "R1", "22", "K35"), ("E1", "R2", "22", None)])
    t["T_MCOaaD"] = frame(spark, "ETA_NUM RSA_NUM YEAR ASS_DGN", [
        ("E1", "R1", "22", "K35"), ("E1", "R1", "22", "K35"), ("E9", "R9", "22", "Z00")])
    t["T_SSRaaD"] = frame(spark, "ETA_NUM RHA_NUM YEAR DGN_COD", [("E3", "H1", "21", "M54")])
    t["T_MCOaaFLSTC"] = frame(spark, "ETA_NUM SEQ_NUM YEAR NABM_COD ACT_NBR", [
        ("E2", "S1", "22", "7", "1"), ("E2", "S1", "22", "0007", "2"),
        ("E2", "S1", "22", "12345", "x"), ("E2", "S1", "22", "x", "1")])
    t["T_SSRaaFLSTC"] = frame(spark, "ETA_NUM SEQ_NUM YEAR NABM_COD ACT_NBR", [("E3", "H1", "21", "1", "1")])
    t["ER_PRS_F"] = frame(spark, FLUX_COLS + " NUM_ENQ_IDT EXE_SOI_DTD EXE_SOI_DTF PRS_NAT_REF PSE_SPE_COD "
                          "PSE_ACT_NAT PSP_SPE_COD PSP_ACT_NAT PRS_ACT_QTE ETB_PRE_FIN", [
        K1 + ("P1", "03/01/2022", "03/01/2022", "1111", None, "21", "12", None, "1", "F1"),
        K1 + ("P1", "03/01/2022", "03/01/2022", "1111", None, "21", "12", None, "1", "F1"),
        K2 + ("P2", "05/02/2022", None, "2222", "01", "22", None, "33", "x", "F2")])
    t["ER_PHA_F"] = frame(spark, FLUX_COLS + " PHA_PRS_C13 PHA_PRS_IDE PHA_ACT_QSN", [
        K1 + ("3400000000011", "1000001", "2"), K1 + ("3400000000011", "1000001", "1"),
        K1 + ("0", "1000002", "1"), K1 + (None, "1000003", "4"), K1 + ("0", "0", "5"),
        K3 + ("3400000000099", "1", "1")])
    t["ER_UCD_F"] = frame(spark, FLUX_COLS + " UCD_UCD_COD UCD_DLV_NBR", [
        K2 + ("0009001234", "2"), K2 + ("000", "1")])
    t["IR_PHA_R"] = frame(spark, "PHA_CIP_UCD PHA_PRS_IDE PHA_CIP_C13 PHA_ATC_CLA PHA_ATC_LIB", [
        ("9001234", None, None, "L01", "drugA"), ("9001234", None, None, "L01", "drugA2"),
        (None, "1000002", None, "N02", "para"), (None, None, "3400000000011", "C09", "ace")])
    t["T_MCOaaMED"] = frame(spark, "ETA_NUM RSA_NUM YEAR UCD_UCD_COD DELAI ADM_NBR", [
        ("E1", "R1", "22", "0009001234", None, "2"), ("E1", "R1", "22", "0009001234", "0", "3"),
        ("E1", "R1", "22", None, "1", "1")])
    t["T_MCOaaFHSTC"] = frame(spark, "ETA_NUM SEQ_NUM YEAR UCD_UCD_COD QUA", [
        ("E2", "S1", "22", "0000009001234", "1")])
    t["T_SSRaaMED"] = frame(spark, "ETA_NUM RHA_NUM YEAR UCD_UCD_COD DAT_DELAI ADM_NBR", [
        ("E3", "H1", "21", "123", "2", "1")])
    # delay column missing: this branch is left out
    t["T_MCOaaMEDATU"] = frame(spark, "ETA_NUM RSA_NUM YEAR UCD_UCD_COD ADM_NBR", [
        ("E1", "R1", "22", "0009001234", "9")])
    t["ER_TIP_F"] = frame(spark, FLUX_COLS + " TIP_PRS_TYP TIP_PRS_IDE TIP_ACT_QSN TIP_ACL_DTD TIP_ALC_DTF", [
        K1 + ("1", "L1", "1", "01/01/2022", "10/01/2022"),
        K1 + ("3", "L3", "2", "01/01/2022", "10/01/2022"),
        K1 + ("3", "L3", "2", "01/01/2022", "10/01/2022"),
        K1 + ("6", "L6", "1", "01/01/2022", "10/01/2022"),
        K1 + ("2", "L2", "1", "01/01/2022", "10/01/2022")])
    t["T_MCOaaDMIP"] = frame(spark, "ETA_NUM RSA_NUM YEAR DELAI LPP_COD NBR_POS", [
        ("E1", "R1", "22", None, "D1", "1"), ("E1", "R1", "22", None, "D1", "2"),
        ("E1", "R1", "22", "0", "D1", "1"), ("E1", "R1", "22", "3", "D2", "1"),
        ("E1", "R1", "22", "x", "D3", "1"), ("E1", "R1", "22", "1", None, "1")])
    # no delay column: this branch is left out
    t["T_MCOaaFPSTC"] = frame(spark, "ETA_NUM SEQ_NUM YEAR LPP_COD LPP_QUA", [("E2", "S1", "22", "F1", "1")])
    t["ER_BIO_F"] = frame(spark, FLUX_COLS + " BIO_PRS_IDE BIO_ACT_QSN", [
        K1 + ("0552", "1"), K1 + ("0552", "1"), K2 + ("1104", "2")])
    return Sources(t)
