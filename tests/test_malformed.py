"""Text raw columns with malformed values: NULL by default, an error when strict."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from dimforge.config import Settings
from dimforge.plans import field, planning, site, variety

STRICT = Settings(strict_casts=True)

# staging function, raw columns, the columns that are typed and so may be malformed
STAGINGS = [
    (field.stage_current, "ID_UPN3_FISICO CD_UPN3_FISICO DE_UPN3_FISICO QT_AREA_PROD DT_INATIVACAO ID_UPNIVEL2",
     "ID_UPN3_FISICO QT_AREA_PROD DT_INATIVACAO ID_UPNIVEL2"),
    (field.stage_legacy, "ID_DIVI3 COD_DIVI1 COD_DIVI3 DSC_DIVI3 DV3_AREA_LIQ COD_EMPR", "ID_DIVI3 DV3_AREA_LIQ COD_EMPR"),
    (site.stage_sites, "ID_UPNIVEL2 DA_UPNIVEL2 DE_UPNIVEL2 ID_UPNIVEL1", "ID_UPNIVEL2 ID_UPNIVEL1"),
    (site.stage_units, "ID_UPNIVEL1 CD_INT_ERP ID_FILIAL", "ID_UPNIVEL1 ID_FILIAL"),
    (site.stage_states, "ID_UNIFEDERACAO CD_UF", "ID_UNIFEDERACAO"),
    (site.stage_cities, "ID_MUNICIPIO ID_UNIFEDERACAO DE_MUNICIPIO", "ID_MUNICIPIO ID_UNIFEDERACAO"),
    (site.stage_branches, "ID_FILIAL ID_MUNICIPIO NO_CNPJ ID_EMPRESA", "ID_FILIAL ID_MUNICIPIO"),
    (variety.stage_varieties, "ID_VARIEDADE CD_VARIEDADE DA_VARIEDADE DE_VARIEDADE ID_OCUPACAO FG_TRANSGENIA "
     "ID_GRPMATURACAO ID_GRPVARIEDADE", "ID_VARIEDADE ID_GRPMATURACAO ID_GRPVARIEDADE"),
    (variety.stage_variety_details, "ID_VARIEDADE QT_DIAS_MATUR NO_DIA_PLAN_EMER QT_PROD_ESTIM",
     "ID_VARIEDADE QT_DIAS_MATUR NO_DIA_PLAN_EMER QT_PROD_ESTIM"),
    (variety.stage_maturity_groups, "ID_GRPMATURACAO QT_DIAS_MATUR", "ID_GRPMATURACAO QT_DIAS_MATUR"),
    (variety.stage_variety_groups, "ID_GRPVARIEDADE DA_GRP_VARIEDADE DE_GRP_VARIEDADE", "ID_GRPVARIEDADE"),
    (variety.stage_legacy_varieties, "COD_VARIE DSC_VARIE VAR_TRANSGENICO COD_CULTURA COD_GRUPO_VARIE COD_FABRICANTE",
     "COD_VARIE VAR_TRANSGENICO COD_GRUPO_VARIE"),
    (variety.stage_legacy_groups, "COD_GRUPO_VARIE DSC_GRUPO_VARIE ABV_GRUPO_VARIE", "COD_GRUPO_VARIE"),
    (planning.stage_plan, "ID_UPN3_PLAN ID_PERIODOSAFRA ID_UPN3_FISICO CD_UPNIVEL3 ID_VARIEDADE ID_UPNIVEL2 ID_CENARIO "
     "QT_AREA_PROD DT_EST_PLANT DT_ESTIMADA_COLH QT_PRODUCAO_ESTIM QT_PROD_ESTIM",
     "ID_UPN3_PLAN ID_PERIODOSAFRA ID_UPN3_FISICO ID_VARIEDADE ID_UPNIVEL2 ID_CENARIO QT_AREA_PROD DT_EST_PLANT "
     "DT_ESTIMADA_COLH QT_PRODUCAO_ESTIM QT_PROD_ESTIM"),
    (planning.stage_periods, "ID_PERIODOSAFRA ID_SAFRA CD_INT_ERP DE_PER_SAFRA ID_OCUPACAO", "ID_PERIODOSAFRA ID_OCUPACAO"),
    (planning.stage_divisions, "ID_DIVI4 COD_SAFRA COD_VARIE ID_DIVI3 COD_CULTURA COD_EMPR COD_SIMULACAO DV4_AREA "
     "DV4_DT_PLANTIO DV4_DT_COLH DV4_PROD_EST SAF_ANO_SAFRA",
     "ID_DIVI4 COD_VARIE ID_DIVI3 COD_EMPR COD_SIMULACAO DV4_AREA DV4_DT_PLANTIO DV4_DT_COLH DV4_PROD_EST SAF_ANO_SAFRA"),
    (planning.stage_simulations, "SAF_ANO_SAFRA COD_SIMULACAO SIM_ATIVA", "SIM_ATIVA"),
]


@pytest.mark.parametrize("staging,columns,typed", STAGINGS, ids=[s[0].__name__ for s in STAGINGS])
def test_malformed_text_is_null_by_default_and_an_error_when_strict(spark, staging, columns, typed):
    names, bad = columns.split(), set(typed.split())
    prefix = {"COD_DIVI1": "P1"}
    raw = spark.range(1).select(*[F.lit("n/a" if n in bad else prefix.get(n, "7")).alias(n) for n in names])
    assert staging(raw).count() == (0 if staging is planning.stage_simulations else 1)
    with pytest.raises(PySparkException):
        staging(raw, STRICT).collect()


def test_areas_are_summed_exactly(spark):
    raw = spark.range(10).select(*[F.lit("1").alias(n) for n in planning.PLAN_GRAIN], F.lit("0.1").alias("QT_AREA_PROD"))
    assert str(planning.stage_plan(raw).first()["QT_AREA_PROD"]) == "1.000000"


def test_redacted_tax_ids_reach_the_build(spark):
    raw = spark.createDataFrame([("1", "2", "12345678000199", "3")], "ID_FILIAL string, ID_MUNICIPIO string, NO_CNPJ string, ID_EMPRESA string")
    assert site.stage_branches(raw).first()["CNPJ"] == "12.345.678/0001-99"
    assert site.stage_branches(raw, Settings(redact_tax_ids=True)).first()["CNPJ"] == "12.***.***/0001-99"
