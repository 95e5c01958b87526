"""Track code lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Slug -> three-letter code, by state.
TRACK_CODES = {
    # Victoria
    "flemington": "FLM",
    "caulfield": "CAU",
    "caulfield-heath": "CAH",
    "moonee-valley": "MVM",
    "sandown": "SAN",
    "ballarat": "BAL",
    "bendigo": "BEN",
    "geelong": "GEE",
    "cranbourne": "CRN",
    "pakenham": "PAK",
    "mornington": "MOR",
    "sale": "SAL",
    "echuca": "ECH",
    "seymour": "SEY",
    "hamilton": "HAM",
    "warrnambool": "WBL",
    "horsham": "HOR",
    "wodonga": "WOD",
    "stawell": "STW",
    "swan-hill": "SWH",
    "yarra-valley": "YVL",
    "kilmore": "KIL",
    "bairnsdale": "BAI",
    "wangaratta": "WAN",
    "ararat": "ARA",
    "terang": "TER",
    "stony-creek": "STC",
    "kyneton": "KYN",
    "corowa": "COR",
    "towong": "TOW",
    "colac": "COL",
    # New South Wales
    "randwick": "RAN",
    "randwick-kensington": "RNK",
    "rosehill": "ROS",
    "warwick-farm": "WFM",
    "kembla-grange": "KEM",
    "newcastle": "NEW",
    "gosford": "GOS",
    "hawkesbury": "HAW",
    "wyong": "WYO",
    "albury": "ALB",
    "wagga": "WAG",
    "dubbo": "DUB",
    "orange": "ORA",
    "bathurst": "BAT",
    "goulburn": "GOU",
    "canberra": "CAN",
    "scone": "SCO",
    "tamworth": "TAM",
    "taree": "TAR",
    "grafton": "GRF",
    "coffs-harbour": "COF",
    "port-macquarie": "PMA",
    "ballina": "BNA",
    "moree": "MOE",
    "gunnedah": "GUN",
    "armidale": "ARM",
    "sapphire-coast": "SAP",
    "nowra": "NOW",
    "queanbeyan": "QBN",
    "cowra": "COW",
    "muswellbrook": "MUS",
    "warren": "WRN",
    # Queensland
    "eagle-farm": "EGF",
    "doomben": "DOO",
    "gold-coast": "GCO",
    "sunshine-coast": "SNC",
    "ipswich": "IPS",
    "toowoomba": "TOO",
    "rockhampton": "ROC",
    "townsville": "TVL",
    "cairns": "CAI",
    "mackay": "MAC",
    "dalby": "DAL",
    "warwick": "WAK",
    "kilcoy": "KLC",
    "beaudesert": "BDS",
    "gatton": "GAT",
    "bundaberg": "BUN",
    "thangool": "THA",
    "innisfail": "INN",
    # South Australia
    "morphettville": "MPV",
    "morphettville-parks": "MRP",
    "balaklava": "BLK",
    "mount-gambier": "MGR",
    "murray-bridge": "MBR",
    "naracoorte": "NAR",
    "strathalbyn": "STR",
    "oakbank": "OAK",
    "port-lincoln": "PLN",
    # Western Australia
    "ascot": "ASC",
    "belmont": "BEL",
    "pinjarra": "PIN",
    "pinjarra-scarpside": "PNS",
    "bunbury": "BUR",
    "geraldton": "GER",
    "albany": "ALN",
    "york": "YRK",
    "esperance": "ESP",
    "pingrup": "PGP",
    # Tasmania
    "launceston": "LAU",
    "hobart": "HOB",
    # Northern Territory
    "darwin": "DAR",
}


def tracks_table(spark: SparkSession) -> DataFrame:
    """The lookup as a dimension: one row per slug."""
    return spark.createDataFrame(list(TRACK_CODES.items()), "slug string, code string")


def with_mapped_code(df: DataFrame, tracks: DataFrame, track: str = "track") -> DataFrame:
    """``df`` plus ``mapped_code``: the code of the lower-cased track, NULL if there is none.

    The lookup holds one short row per race course, so it is broadcast; it does not grow
    with the data.
    """
    lookup = tracks.select(F.col("slug").alias("_slug"), F.col("code").alias("mapped_code"))
    joined = df.join(F.broadcast(lookup), F.lower(F.col(track)) == F.col("_slug"), "left")
    return joined.drop("_slug")
