"""Target schemas of the conformed tables.

Column order is the contract: origins are aligned to it by position, and
the first origin's names are the published names.  Types are declared here
instead of being left to union widening, so both origins are cast to one
type (decimal(18,2) and decimal(18,6) areas widen to decimal(22,6); a date
and a NULL timestamp widen to timestamp; codes that are text in one system
and numbers in the other are text).
"""

from __future__ import annotations

import re

from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_SIMPLE = {"bigint": LongType(), "int": IntegerType(), "string": StringType(),
           "date": DateType(), "timestamp": TimestampType()}


def _type(name: str) -> DataType:
    m = re.fullmatch(r"decimal\((\d+),(\d+)\)", name)
    return DecimalType(int(m.group(1)), int(m.group(2))) if m else _SIMPLE[name]


def parse_schema(spec: str) -> StructType:
    # spec: "NAME type, NAME type, ..." (decimal written without blanks)
    fields = []
    for part in re.split(r",\s*(?![^()]*\))", spec):
        name, dtype = part.strip().split(" ", 1)
        fields.append(StructField(name, _type(dtype.strip()), True))
    return StructType(fields)


# The published column names and their order.
FIELD = parse_schema(
    "ID_DOMAIN bigint, ID_ORIGEM_DB int, ID_LAV_FISICA string, ORIGEM_DB string,"
    " COD_LAVOURA string, DESC_LAVOURA string, AREA_FISICA decimal(22,6),"
    " DATA_INATIVACAO timestamp, ID_SEDE string"
)

SITE = parse_schema(
    "ID_DOMAIN bigint, ID_ORIGEM_DB int, ID_SEDE string, ORIGEM_DB string, COD_SEDE string,"
    " DESC_SEDE string, UF string, REGIAO string, REGIONAL string, CIDADE string,"
    " CNPJ string, ID_FAZENDA string"
)

SITE_ANALYSIS = StructType(SITE.fields + [StructField("ID_FAZENDA_PROD", StringType(), True)])

VARIETY = parse_schema(
    "ID_DOMAIN bigint, ID_ORIGEM_DB int, ID_VARIEDADE string, ORIGEM_DB string,"
    " COD_VARIEDADE string, TIPO_VARIEDADE string, DESC_COMPLETA_VARIEDADE string,"
    " ID_CULTURA string, TRANSGENIA string, CICLO_VARIEDADE int,"
    " DIAS_PARA_EMERGERGENCIA int, DESC_GRUPO_VARIEDADE string,"
    " DESC_COMPLETA_GRUPO_VARIEDADE string, PRODUTIVIDADE_PADRAO decimal(12,2),"
    " FORNECEDOR string, PRODUTIVIDADE_HISTORICA_MEDIA int, ESPACAMENTO_SEMENTES int"
)

PLANNING = parse_schema(
    "ID_DOMAIN bigint, ID_ORIGEM_DB int, ID_PLANEJAMENTO_AGRICOLA string, ORIGEM_DB string,"
    " ID_LAV_LOGICA string, ID_LAV_FISICA string, COD_LAVOURA string, ID_SAFRA string,"
    " ANO_AGRICOLA string, SAFRINHA string, ID_VARIEDADE string, COD_VARIEDADE string,"
    " CICLO_VARIEDADE int, ID_CULTURA string, COD_CULTURA string, CULTURA string,"
    " FATOR_CONVERSAO decimal(18,6), ID_SEDE string, COD_SEDE string, UF string,"
    " REGIAO string, REGIONAL string, ID_FAZENDA string, SIGLA_FAZENDA string,"
    " COD_SIMULACAO string, AREA_PLANEJADA decimal(18,6), DATA_PLANTIO_PLAN date,"
    " DATA_COLHEITA_PLAN date, PRODUCAO_KG_PLANEJADA decimal(18,6),"
    " PRODUTIVIDADE_PLANEJADA decimal(18,6)"
)

# The origin registry (one row per source system) and the two origin ids.
REGISTRY = parse_schema("ID_DOMAIN int, DESC_BANCO_DADOS string")
CURRENT = 2000
LEGACY = 1000
