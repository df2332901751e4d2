"""Record layouts: harvested, canonical and nested values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HARVESTED_COLUMNS = (
    "object_ID title object_name classification department date date_begin date_end medium material technique dimensions "
    "culture country region city period dynasty reign artist_name artist_role artist_nationality artist_date_begin artist_date_end "
    "artist_display_bio artist_information artist_titles subjects inscriptions description image_url cho_uri"
).split()
CANONICAL_COLUMNS = (
    "object_ID title object_name date_begin date_end date_begin_bce date_end_bce materials techniques dimensions_json culture location "
    "period dynasty reign artist_name artist_role artist_nationality artist_date_begin artist_date_end subjects description inscriptions image_url"
).split()

HARVESTED = T.StructType([T.StructField(c, T.StringType(), c != "object_ID") for c in HARVESTED_COLUMNS])
DATE = "struct<date_begin:int,date_end:int,date_begin_bce:boolean,date_end_bce:boolean,circa:boolean,notes:string,qualifier:string>"
DIMENSIONS = "struct<parts:array<struct<part:string,measurements:array<struct<attribute:string,value:double,note:string>>>>>"
ARTIST = "array<struct<artist_name:string,artist_role:string,artist_nationality:string,artist_date_begin:string,artist_date_end:string>>"


def conform(df: DataFrame, columns: list[str] | tuple[str, ...] = tuple(HARVESTED_COLUMNS), kind: str = "string") -> DataFrame:
    """df with exactly these columns; missing ones are null, header blanks are trimmed, others are dropped."""
    names = {c.strip(): c for c in df.columns}
    return df.select([F.col(f"`{names[c]}`").cast(kind).alias(c) if c in names else F.lit(None).cast(kind).alias(c) for c in columns])
