"""Buildings as they arrive: a stream over a folder of wireframes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gablework.functions.naming import building_stem
from gablework.sources.geojson import FEATURES


def watch(spark: SparkSession, folder: str, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Calls handle with the raw features (building, seq, f) of each batch of new files, each file once."""
    files = spark.readStream.format("text").option("wholetext", "true").option("pathGlobFilter", "*.geojson").load(folder)
    rows = files.select(building_stem(F.input_file_name()).alias("building"), F.posexplode(F.from_json("value", FEATURES)["features"]).alias("seq", "f"))
    return rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
