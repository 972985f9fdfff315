"""Geographic centroid per zip-code prefix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions import zip_key


def centroid(
    geo: DataFrame,
    key: str = "geolocation_zip_code_prefix",
    lat: str = "geolocation_lat",
    lng: str = "geolocation_lng",
) -> DataFrame:
    """Mean latitude and longitude per normalised zip prefix.

    Output: ``(key, latitude, longitude)`` with ``key`` as ``zip_key`` text, one
    row per prefix (a NULL prefix forms its own group). NULL coordinates are
    skipped by ``avg``; an all-NULL group gives NULL.

    Partial aggregation runs map-side, so each map task ships one row per prefix
    it saw, however hot a prefix is. The output is bounded by the number of
    distinct prefixes; joins against it are left to AQE, which broadcasts it only
    once its measured size is under the threshold.
    """
    return geo.groupBy(zip_key(key).alias(key)).agg(
        F.avg(lat).alias("latitude"),
        F.avg(lng).alias("longitude"),
    )
