"""The columns that the loads read of each raw table.

A raw table may hold more columns; those are not read.  A declared column that
it lacks is an error that names it, or a NULL column where that is asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Raw tables of the two systems, with the columns read of each.
# Raw values are taken as text where a NULL column has to stand in for one.
RAW_COLUMNS: dict[str, tuple[str, ...]] = {name: tuple(columns.split()) for name, columns in {
    "Upn3_fisico": "ID_UPN3_FISICO CD_UPN3_FISICO DE_UPN3_FISICO QT_AREA_PROD DT_INATIVACAO ID_UPNIVEL2",
    "ga_saf_divi3": "ID_DIVI3 COD_DIVI1 COD_DIVI3 DSC_DIVI3 DV3_AREA_LIQ COD_EMPR",
    "Upnivel2": "ID_UPNIVEL2 DA_UPNIVEL2 DE_UPNIVEL2 ID_UPNIVEL1",
    "Upnivel1": "ID_UPNIVEL1 CD_INT_ERP ID_FILIAL",
    "unifederacao": "ID_UNIFEDERACAO CD_UF",
    "municipio": "ID_MUNICIPIO ID_UNIFEDERACAO DE_MUNICIPIO",
    "filial": "ID_FILIAL ID_MUNICIPIO NO_CNPJ ID_EMPRESA",
    "dim_regiaofazendas": "TITLE REGIAO1 REGIAO2",
    "ga_empr": "COD_EMPR COD_EMPR_PROD ABV_EMPR DSC_EMPR EMP_UF EMP_CIDAD EMP_CGC",
    "variedade": "ID_VARIEDADE CD_VARIEDADE DA_VARIEDADE DE_VARIEDADE ID_OCUPACAO FG_TRANSGENIA ID_GRPMATURACAO ID_GRPVARIEDADE",
    "Variedade_ep": "ID_VARIEDADE QT_DIAS_MATUR NO_DIA_PLAN_EMER QT_PROD_ESTIM",
    "Grpmaturacao": "ID_GRPMATURACAO QT_DIAS_MATUR",
    "Grpvariedade": "ID_GRPVARIEDADE DA_GRP_VARIEDADE DE_GRP_VARIEDADE",
    "GA_SAF_VARIEDADE": "COD_VARIE DSC_VARIE VAR_TRANSGENICO COD_CULTURA COD_GRUPO_VARIE COD_FABRICANTE",
    "GA_SAF_GRUPO_VARIE": "COD_GRUPO_VARIE DSC_GRUPO_VARIE ABV_GRUPO_VARIE",
    "upn3_plan": "ID_UPN3_PLAN ID_PERIODOSAFRA ID_UPN3_FISICO CD_UPNIVEL3 ID_VARIEDADE ID_UPNIVEL2 ID_CENARIO QT_AREA_PROD"
                 " DT_EST_PLANT DT_ESTIMADA_COLH QT_PRODUCAO_ESTIM QT_PROD_ESTIM",
    "Cenario": "ID_CENARIO CD_CENARIO DA_CENARIO",
    "periodosafra": "ID_PERIODOSAFRA ID_SAFRA CD_INT_ERP DE_PER_SAFRA ID_OCUPACAO",
    "ga_prp_divi4": "ID_DIVI4 COD_SAFRA COD_VARIE ID_DIVI3 COD_CULTURA COD_EMPR COD_SIMULACAO DV4_AREA DV4_DT_PLANTIO DV4_DT_COLH"
                    " DV4_PROD_EST SAF_ANO_SAFRA",
    "ga_prp_simula": "SAF_ANO_SAFRA COD_SIMULACAO SIM_ATIVA",
    "tb_banco_dados": "ID_DOMAIN DESC_BANCO_DADOS",
}.items()}
# Read by the site analysis only.
OPTIONAL = {"ga_empr": {"COD_EMPR_PROD"}}


class RawColumnsMissing(ValueError):
    """A raw table lacks columns that the loads read."""

    def __init__(self, table: str, columns: list[str], found: list[str]):
        self.table, self.columns = table, columns
        super().__init__(f"raw table {table} lacks {', '.join(columns)}; it has {', '.join(found)}")


def declared(df: DataFrame, table: str, missing: str = "error") -> DataFrame:
    """The declared columns of a raw table; a table that isn't declared as it is.

    Names are matched as Spark does, whatever their case, and come out as
    declared.  ``missing``: ``"error"`` (:class:`RawColumnsMissing`) or
    ``"null"``, which stands a text column of NULLs in for each.
    """
    if missing not in ("error", "null"):
        raise ValueError(f"missing must be 'error' or 'null', not {missing!r}")
    name = next((n for n in RAW_COLUMNS if n.lower() == table.lower()), None)
    if name is None:
        return df
    found = {c.lower(): c for c in df.columns}
    lacking = [c for c in RAW_COLUMNS[name] if c.lower() not in found]
    if missing == "error":
        lacking = [c for c in lacking if c not in OPTIONAL.get(name, ())]
        if lacking:
            raise RawColumnsMissing(table, lacking, df.columns)
    columns = []
    for c in RAW_COLUMNS[name]:
        if c.lower() in found:
            columns.append(F.col(f"`{found[c.lower()]}`").alias(c))
        elif missing == "null":
            columns.append(F.lit(None).cast("string").alias(c))
    return df.select(*columns)
