"""Wire layouts: position, name and number policy of each field of the three record kinds.

Policies are explained in ``functions.numbers.by_policy``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Layout:
    tr_id: str
    fields: tuple[tuple[int, str, str], ...]  # (position, name, policy)

    @property
    def width(self) -> int:
        """Number of parts one record takes in the payload."""
        return self.fields[-1][0] + 1


def _fields(first: int, text: str, numbers: str, rows: str) -> tuple[tuple[int, str, str], ...]:
    """Number the listed names from ``first``; names in ``text`` stay strings."""
    as_text = set(text.split())
    return tuple(
        (position, name, "text" if name in as_text else numbers)
        for position, name in enumerate(rows.split(), start=first)
    )


# Field names and order of the trade record (position 0 is the stock code, the key).
TRADE = Layout(
    "H0STCNT0",
    _fields(
        1,
        text="""stck_cntg_hour prdy_vrss_sign ccld_dvsn oprc_hour oprc_vrss_prpr_sign hgpr_hour
                hgpr_vrss_prpr_sign lwpr_hour lwpr_vrss_prpr_sign bsop_date new_mkop_cls_code trht_yn
                hour_cls_code mrkt_trtm_cls_code""",
        numbers="strict",
        rows="""stck_cntg_hour stck_prpr prdy_vrss_sign prdy_vrss prdy_ctrt wghn_avrg_stck_prc
                stck_oprc stck_hgpr stck_lwpr askp1 bidp1 cntg_vol acml_vol acml_tr_pbmn
                seln_cntg_csnu shnu_cntg_csnu ntby_cntg_csnu cttr seln_cntg_smtn shnu_cntg_smtn
                ccld_dvsn shnu_rate prdy_vol_vrss_acml_vol_rate oprc_hour oprc_vrss_prpr_sign
                oprc_vrss_prpr hgpr_hour hgpr_vrss_prpr_sign hgpr_vrss_prpr lwpr_hour
                lwpr_vrss_prpr_sign lwpr_vrss_prpr bsop_date new_mkop_cls_code trht_yn askp_rsqn1
                bidp_rsqn1 total_askp_rsqn total_bidp_rsqn vol_tnrt prdy_smns_hour_acml_vol
                prdy_smns_hour_acml_vol_rate hour_cls_code mrkt_trtm_cls_code vi_stnd_prc""",
    ),
)

# Field names and order of the expected-execution record.
EXPECTED = Layout(
    "H0STANC0",
    _fields(
        0,
        text="mksc_shrn_iscd stck_cntg_hour prdy_vrss_sign",
        numbers="zero",
        rows="""mksc_shrn_iscd stck_cntg_hour stck_prpr prdy_vrss_sign prdy_vrss prdy_ctrt acml_vol
                antc_cnqn total_askp_rsqn total_bidp_rsqn hshr_stprf lshr_stprf stck_oprc stck_hgpr
                stck_lwpr""",
    ),
)

LEVELS = range(1, 11)


def _levels(name: str) -> str:
    return " ".join(f"{name}{level}" for level in LEVELS)


# Field names and order of the order-book record.
_BOOK = _fields(
    0,
    text="MKSC_SHRN_ISCD BSOP_HOUR HOUR_CLS_CODE ANTC_CNTG_VRSS_SIGN STCK_DEAL_CLS_CODE",
    numbers="zero",
    rows=f"""MKSC_SHRN_ISCD BSOP_HOUR HOUR_CLS_CODE
             {_levels("ASKP")} {_levels("BIDP")} {_levels("ASKP_RSQN")} {_levels("BIDP_RSQN")}
             TOTAL_ASKP_RSQN TOTAL_BIDP_RSQN OVTM_TOTAL_ASKP_RSQN OVTM_TOTAL_BIDP_RSQN
             ANTC_CNPR ANTC_CNQN ANTC_VOL ANTC_CNTG_VRSS ANTC_CNTG_VRSS_SIGN ANTC_CNTG_PRDY_CTRT
             ACML_VOL TOTAL_ASKP_RSQN_ICDC TOTAL_BIDP_RSQN_ICDC OVTM_TOTAL_ASKP_ICDC
             OVTM_TOTAL_BIDP_ICDC STCK_DEAL_CLS_CODE""",
)
_MAY_BE_NULL = {"ANTC_CNPR", "ANTC_CNQN", "ANTC_VOL", "ANTC_CNTG_VRSS"}
ORDER_BOOK = Layout(
    "H0STASP0",
    tuple((i, name, "null" if name in _MAY_BE_NULL else policy) for i, name, policy in _BOOK),
)

LAYOUTS = (TRADE, EXPECTED, ORDER_BOOK)

# The part of a trade message that the market report reads; all values are strings.
TRADE_MESSAGE = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "stck_prpr",
            "cntg_vol",
            "acml_vol",
            "acml_tr_pbmn",
            "cttr",
            "total_askp_rsqn",
            "total_bidp_rsqn",
        )
    ]
)

# One entry of the sector file.
SECTOR_ENTRY = T.StructType(
    [
        T.StructField("stock_code", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("sectors", T.ArrayType(T.StringType())),
    ]
)
