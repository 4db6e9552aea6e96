"""The built-in region list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Region ids and names.
REGIONS = (
    (10000054, "ARIDIA"), (10000069, "BLACK RISE"), (10000038, "THE BLEAK LANDS"), (10000055, "BRANCH"),
    (10000007, "CACHE"), (10000014, "CATCH"), (10000033, "THE CITADEL"), (10000051, "CLOUD RING"),
    (10000053, "COBALT EDGE"), (10000012, "CURSE"), (10000035, "DEKLEIN"), (10000060, "DELVE"),
    (10000001, "DERELIK"), (10000005, "DETROID"), (10000036, "DEVOID"), (10000043, "DOMAIN"),
    (10000064, "ESSENCE"), (10000039, "ESOTERIA"), (10000027, "ETHERIUM REACH"), (10000037, "EVERYSHORE"),
    (10000046, "FADE"), (10000056, "FEYTHABOLIS"), (10000002, "THE FORGE"), (10000058, "FOUNTAIN"),
    (10000029, "GEMINATE"), (10000067, "GENESIS"), (10000011, "GREAT WILDLANDS"), (10000030, "HEIMATAR"),
    (10000025, "IMMENSEA"), (10000031, "IMPASS"), (10000009, "INSMOTHER"), (10000052, "KADOR"),
    (10000034, "THE KALEVALA EXPANSE"), (10000049, "KHANID"), (10000065, "KOR-AZOR"), (10000016, "LONETREK"),
    (10000013, "MALPAIS"), (10000042, "METROPOLIS"), (10000028, "MOLDEN HEATH"), (10000040, "OASA"),
    (10000062, "OMIST"), (10000021, "OUTER PASSAGE"), (10000057, "OUTER RING"), (10000059, "PARAGON SOUL"),
    (10000063, "PERIOD BASIS"), (10000066, "PERRIGEN FALLS"), (10000048, "PLACID"), (10000047, "PROVIDENCE"),
    (10000023, "PURE BLIND"), (10000050, "QUERIOUS"), (10000008, "SCALDING PASS"), (10000032, "SINQ LAISON"),
    (10000044, "SOLITUDE"), (10000018, "THE SPIRE"), (10000022, "STAIN"), (10000041, "SYNDICATE"),
    (10000020, "TASH-MURKON"), (10000045, "TENAL"), (10000061, "TENERIFIS"), (10000010, "TRIBUTE"),
    (10000003, "VALE OF THE SILENT"), (10000015, "VENAL"), (10000068, "VERGE VENDOR"), (10000006, "WICKED CREEK"),
)


def region_literals(spark: SparkSession) -> DataFrame:
    """(region, name_region), 64 rows, as literals in the plan."""
    rows = F.array(*[F.struct(F.lit(i).cast("bigint").alias("region"), F.lit(n).alias("name_region")) for i, n in REGIONS])
    return spark.range(1).select(F.inline(rows))
