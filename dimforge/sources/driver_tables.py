"""Stand-in raw tables made from the TPC-H-like test tables.

The conformed builds expect the raw tables of two operational systems.  The
test data has none of them, so each raw table here is a projection of one
test table into the raw schema: renames, text formatting of dates and codes,
and typed NULLs.  A stand-in never joins, groups or de-duplicates; the builds
do all of that themselves and would give the right result on any data of
these schemas.

As in the source systems, numbers may be text and text may be malformed
(``n/a``), keys may be NULL, and lookups hold exact copies of rows (maturity
groups, periods) and several rows a key (regions).

The season, crop and farm tables are conformed tables the planning fact
reads but no build here produces.  Their stand-ins (one row per nation,
region or supplier and origin) hold their keys in the conformed format,
origin followed by the local id, as a published table would.

Mapping (origin 2000 = current system, origin 1000 = legacy system):

  Upn3_fisico      orders      field per order, site = customer
  ga_saf_divi3     part        field per part, division code = part type
  Upnivel2         customer    site per customer, unit = nation
  Upnivel1/filial/municipio    nation
  unifederacao     region      state per region
  dim_regiaofazendas region    farm code = two-digit region key
  ga_empr          supplier    company per supplier, farm code = two-digit nation key
  variedade/Variedade_ep/GA_SAF_VARIEDADE   part
  Grpmaturacao/Grpvariedade/GA_SAF_GRUPO_VARIE   nation
  upn3_plan, ga_prp_divi4   lineitem
  periodosafra     supplier;  Cenario  nation;  ga_prp_simula  orders
  season, crop     nation (one row per nation and origin)
  farm             region (current) and supplier (legacy)
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge import schemas

C, L = schemas.CURRENT, schemas.LEGACY


def _s(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


class DriverTables:
    """Lazy parquet reads of the test tables in ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- field -----------------------------------------------------------
    def field_raw(self) -> dict[str, DataFrame]:
        orders, part = self.table("orders"), self.table("part")
        return {
            "Upn3_fisico": orders.select(
                _s("o_orderkey").alias("ID_UPN3_FISICO"),
                F.col("o_orderstatus").alias("CD_UPN3_FISICO"),
                F.col("o_orderpriority").alias("DE_UPN3_FISICO"),
                F.when(F.col("o_orderkey") % 101 == 0, F.lit("n/a"))
                .otherwise(_s(F.col("o_totalprice").cast("decimal(18,2)"))).alias("QT_AREA_PROD"),
                F.date_format("o_orderdate", "dd/MM/yyyy").alias("DT_INATIVACAO"),
                F.col("o_custkey").alias("ID_UPNIVEL2"),
            ),
            "ga_saf_divi3": part.select(
                F.col("p_partkey").alias("ID_DIVI3"),
                F.col("p_type").alias("COD_DIVI1"),
                F.col("p_brand").alias("COD_DIVI3"),
                F.col("p_name").alias("DSC_DIVI3"),
                F.col("p_retailprice").alias("DV3_AREA_LIQ"),
                F.col("p_size").alias("COD_EMPR"),
            ),
        }

    # -- site ------------------------------------------------------------
    def site_raw(self) -> dict[str, DataFrame]:
        customer, nation = self.table("customer"), self.table("nation")
        region, supplier = self.table("region"), self.table("supplier")
        bal = F.col("s_acctbal")
        return {
            "Upnivel2": customer.select(
                F.col("c_custkey").alias("ID_UPNIVEL2"),
                F.col("c_mktsegment").alias("DA_UPNIVEL2"),
                F.col("c_name").alias("DE_UPNIVEL2"),
                F.when(F.col("c_custkey") % 17 != 0, F.col("c_nationkey")).alias("ID_UPNIVEL1"),
            ),
            "Upnivel1": nation.select(
                F.col("n_nationkey").alias("ID_UPNIVEL1"),
                F.lpad(_s("n_nationkey"), 2, "0").alias("CD_INT_ERP"),
                F.col("n_nationkey").alias("ID_FILIAL"),
            ),
            "filial": nation.select(
                F.col("n_nationkey").alias("ID_FILIAL"),
                F.col("n_nationkey").alias("ID_MUNICIPIO"),
                F.col("n_name").alias("NO_CNPJ"),
                F.col("n_regionkey").alias("ID_EMPRESA"),
            ),
            "municipio": nation.select(
                F.col("n_nationkey").alias("ID_MUNICIPIO"),
                F.col("n_regionkey").alias("ID_UNIFEDERACAO"),
                F.col("n_name").alias("DE_MUNICIPIO"),
            ),
            "unifederacao": region.select(
                F.col("r_regionkey").alias("ID_UNIFEDERACAO"),
                F.col("r_name").alias("CD_UF"),
            ),
            "dim_regiaofazendas": region.select(
                F.lpad(_s("r_regionkey"), 2, "0").alias("TITLE"),
                F.col("r_name").alias("REGIAO1"),
                _s("r_regionkey").alias("REGIAO2"),
            ).unionByName(region.where("r_regionkey = 1").select(
                F.lit("01").alias("TITLE"), F.lit("SEGUNDA").alias("REGIAO1"), F.lit("1B").alias("REGIAO2"))),
            "ga_empr": supplier.select(
                F.col("s_suppkey").alias("COD_EMPR"),
                F.col("s_nationkey").alias("COD_EMPR_PROD"),
                F.concat(F.when(bal < 0, F.lit("XX")).otherwise(F.lit("FZ")),
                         F.lpad(_s(F.col("s_nationkey") % 5), 2, "0"),
                         F.when(bal >= 6000, F.lit("III")).when(bal >= 3000, F.lit("II"))
                         .otherwise(F.lit(""))).alias("ABV_EMPR"),
                F.col("s_name").alias("DSC_EMPR"),
                _s("s_nationkey").alias("EMP_UF"),
                F.col("s_name").alias("EMP_CIDAD"),
                F.concat(F.lit(" "), _s("s_suppkey"), F.lit(" ")).alias("EMP_CGC"),
            ),
        }

    # -- variety ---------------------------------------------------------
    def variety_raw(self) -> dict[str, DataFrame]:
        part, nation = self.table("part"), self.table("nation")
        ptype = F.col("p_type")
        return {
            "variedade": part.select(
                F.col("p_partkey").alias("ID_VARIEDADE"),
                F.col("p_partkey").alias("CD_VARIEDADE"),
                ptype.alias("DA_VARIEDADE"),
                F.col("p_name").alias("DE_VARIEDADE"),
                F.col("p_size").alias("ID_OCUPACAO"),
                F.substring(ptype, 1, 1).alias("FG_TRANSGENIA"),
                F.col("p_size").alias("ID_GRPMATURACAO"),
                F.col("p_size").alias("ID_GRPVARIEDADE"),
            ),
            "Variedade_ep": part.select(
                F.col("p_partkey").alias("ID_VARIEDADE"),
                F.when(F.col("p_partkey") % 97 == 0, F.lit("n/a")).otherwise(_s(F.col("p_size") - 10)).alias("QT_DIAS_MATUR"),
                F.col("p_size").alias("NO_DIA_PLAN_EMER"),
                F.col("p_retailprice").alias("QT_PROD_ESTIM"),
            ),
            "Grpmaturacao": nation.unionAll(nation).select(
                F.col("n_nationkey").alias("ID_GRPMATURACAO"),
                (F.col("n_regionkey") * 30).alias("QT_DIAS_MATUR"),
            ),
            "Grpvariedade": nation.select(
                F.col("n_nationkey").alias("ID_GRPVARIEDADE"),
                F.col("n_name").alias("DA_GRP_VARIEDADE"),
                F.col("n_name").alias("DE_GRP_VARIEDADE"),
            ),
            "GA_SAF_VARIEDADE": part.select(
                F.col("p_partkey").alias("COD_VARIE"),
                F.col("p_name").alias("DSC_VARIE"),
                F.when(ptype == "SMALL", F.lit(1)).when(ptype == "PROMO", F.lit(0)).alias("VAR_TRANSGENICO"),
                ptype.alias("COD_CULTURA"),
                F.col("p_size").alias("COD_GRUPO_VARIE"),
                F.col("p_brand").alias("COD_FABRICANTE"),
            ),
            "GA_SAF_GRUPO_VARIE": nation.select(
                F.col("n_nationkey").alias("COD_GRUPO_VARIE"),
                F.col("n_name").alias("DSC_GRUPO_VARIE"),
                _s("n_regionkey").alias("ABV_GRUPO_VARIE"),
            ),
        }

    # -- planning --------------------------------------------------------
    def planning_raw(self) -> dict[str, DataFrame]:
        lineitem, orders = self.table("lineitem"), self.table("orders")
        supplier, nation = self.table("supplier"), self.table("nation")
        ship = F.col("l_shipdate")
        stamp = F.date_format(ship, "yyyyMMddHHmmss")
        return {
            "upn3_plan": lineitem.select(
                F.col("l_orderkey").alias("ID_UPN3_PLAN"),
                F.col("l_suppkey").alias("ID_PERIODOSAFRA"),
                F.col("l_orderkey").alias("ID_UPN3_FISICO"),
                F.col("l_linestatus").alias("CD_UPNIVEL3"),
                F.col("l_partkey").alias("ID_VARIEDADE"),
                F.col("l_suppkey").alias("ID_UPNIVEL2"),
                F.col("l_linenumber").alias("ID_CENARIO"),
                F.col("l_quantity").alias("QT_AREA_PROD"),
                ship.alias("DT_EST_PLANT"),
                ship.alias("DT_ESTIMADA_COLH"),
                F.col("l_extendedprice").alias("QT_PRODUCAO_ESTIM"),
                F.col("l_discount").alias("QT_PROD_ESTIM"),
            ),
            "Cenario": nation.select(
                F.col("n_nationkey").alias("ID_CENARIO"),
                F.col("n_name").alias("CD_CENARIO"),
                F.when(F.col("n_regionkey") == 0, F.lit("REAL")).otherwise(F.lit("PLAN")).alias("DA_CENARIO"),
            ),
            "periodosafra": supplier.unionAll(supplier).select(
                F.when(F.col("s_suppkey") % 19 != 0, F.col("s_suppkey")).alias("ID_PERIODOSAFRA"),
                F.col("s_nationkey").alias("ID_SAFRA"),
                F.when(F.col("s_acctbal") < 0, F.lit("2")).alias("CD_INT_ERP"),
                F.when(F.col("s_nationkey") % 3 == 0, F.concat("s_name", F.lit("-2 safra"))).otherwise(F.col("s_name"))
                .alias("DE_PER_SAFRA"),
                F.col("s_nationkey").alias("ID_OCUPACAO"),
            ),
            "ga_prp_divi4": lineitem.select(
                F.col("l_orderkey").alias("ID_DIVI4"),
                F.concat(F.date_format(ship, "yyyy/MM"),
                         F.when(F.col("l_returnflag") == "R", F.lit("-2")).otherwise(F.lit(""))).alias("COD_SAFRA"),
                F.when(F.col("l_linenumber") != 7, F.col("l_partkey")).alias("COD_VARIE"),
                F.col("l_partkey").alias("ID_DIVI3"),
                F.col("l_linenumber").alias("COD_CULTURA"),
                F.col("l_suppkey").alias("COD_EMPR"),
                F.col("l_linenumber").alias("COD_SIMULACAO"),
                F.col("l_quantity").alias("DV4_AREA"),
                stamp.alias("DV4_DT_PLANTIO"),
                stamp.alias("DV4_DT_COLH"),
                F.col("l_extendedprice").alias("DV4_PROD_EST"),
                F.year(ship).alias("SAF_ANO_SAFRA"),
            ),
            "ga_prp_simula": orders.select(
                F.year("o_orderdate").alias("SAF_ANO_SAFRA"),
                F.substring("o_orderpriority", 1, 1).cast("int").alias("COD_SIMULACAO"),
                F.when(F.col("o_orderstatus") == "F", F.lit("3"))
                .when(F.col("o_orderstatus") == "O", F.lit("04")).otherwise(F.lit("A")).alias("SIM_ATIVA"),
            ),
        }

    def season(self) -> DataFrame:
        n = self.table("nation")
        year = F.col("n_nationkey") + 1995
        parts = []
        for digit in ("1", "2"):
            parts.append(n.select(F.concat(F.lit(str(C)), _s("n_nationkey"), F.lit(digit)).alias("ID_SAFRA"),
                                  F.lit(C).alias("ID_ORIGEM_DB"), F.col("n_name").alias("ANO_AGRICOLA"),
                                  F.concat(_s("n_regionkey"), F.lit(digit)).alias("SAFRINHA")))
            parts.append(n.select(F.concat(F.lit(str(L)), _s(year), F.lit(digit)).alias("ID_SAFRA"),
                                  F.lit(L).alias("ID_ORIGEM_DB"), _s(year).alias("ANO_AGRICOLA"),
                                  F.concat(_s("n_regionkey"), F.lit(digit)).alias("SAFRINHA")))
        return reduce(DataFrame.unionByName, parts)

    def crop(self) -> DataFrame:
        n = self.table("nation")
        parts = [n.select(F.col("n_nationkey").alias("ID_DOMAIN"), F.lit(o).alias("ID_ORIGEM_DB"),
                          F.concat(F.lit(str(o)), _s("n_nationkey")).alias("ID_CULTURA"),
                          _s("n_nationkey").alias("COD_CULTURA"), F.col("n_name").alias("CULTURA"),
                          (F.col("n_regionkey") + 1).cast("decimal(18,6)").alias("FATOR_CONVERSAO"))
                 for o in (C, L)]
        return parts[0].unionByName(parts[1])

    def farm(self) -> DataFrame:
        r, s = self.table("region"), self.table("supplier")
        cur = r.select(F.concat(F.lit(str(C)), _s("r_regionkey")).alias("ID_FAZENDA"),
                       F.substring("r_name", 1, 2).alias("SIGLA_FAZENDA"))
        leg = s.select(F.concat(F.lit(str(L)), _s("s_suppkey")).alias("ID_FAZENDA"),
                       F.substring("s_name", 10, 2).alias("SIGLA_FAZENDA"))
        return cur.unionByName(leg)
