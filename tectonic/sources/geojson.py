"""GeoJSON FeatureCollection sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..schemas import GEOJSON


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Multi-line GeoJSON file(s) -> one row per feature ``(province_id, province_name,
    geometry_json)``, with an explicit schema so the geometry stays raw JSON text."""
    doc = spark.read.schema(GEOJSON).option("multiLine", True).json(path)
    return explode_features(doc)


def features_from_text(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """Same as :func:`read_features` for documents already held in a string column."""
    doc = docs.select(F.from_json(text_col, GEOJSON).alias("d")).select("d.*")
    return explode_features(doc)


def explode_features(doc: DataFrame) -> DataFrame:
    """One row per non-null feature.

    ``explode_outer`` + a filter on the generated column: a plain ``explode`` makes Catalyst
    infer ``size(features) > 0`` and push it below the JSON parsing, which then runs twice.
    """
    return (doc.select(F.explode_outer("features").alias("feature"))
            .where(F.col("feature").isNotNull())
            .select(F.col("feature.properties.GID_1").alias("province_id"),
                    F.col("feature.properties.NAME_1").alias("province_name"),
                    F.col("feature.geometry").alias("geometry_json")))


# --- large documents: features cut out of byte ranges ------------------------------------

_RANGE = ("_block", "_file", "_start")  # some successive records of one split of the scan
_RANGE_BITS = 14
_STRINGS = r'(?:[^"{]*+"[^"]*+")*+[^"{]*+'  # text up to the next brace outside strings


def split_features(spark: SparkSession, path: str) -> DataFrame:
    """:func:`read_features` for FeatureCollections of any size: one file is read, cut and parsed by
    as many tasks as it has splits.

    The scan ends a record at every ``}``, which Spark can do from the middle of a file. For each
    record the quotes and opening braces are counted, for both cases of it starting inside a string
    or not; sums over ranges of successive records (one narrow row each) tell every range whether it
    starts inside a string and at which depth, and which object it continues. Objects at depth two under
    the root's ``features`` are put together from their records and parsed one by one. Ranges hold at most
    2 ** _RANGE_BITS records however large the splits are; texts move by range once and by object once.

    The folder may hold many files, and a file several documents after one another. The root must be
    an object, its key ``features`` written without escapes. An empty file, a document without features and
    ``null`` features give no rows; two equal features give two. Blanks between the tokens of a geometry
    may differ from the file's. A feature that is no valid JSON
    gives nulls and leaves the others as they are; braces or quotes that do not balance spoil the rest of
    their file.
    """
    pieces = _pieces(spark, path).withColumn("_quotes_before", F.coalesce(F.sum("_quotes").over(_before()), F.lit(0)))
    states = _range_states(pieces)
    started = _object_starts(pieces, states)
    last = started.where("_starts").groupBy(*_RANGE).agg(
        F.max("_at").alias("_at"),
        F.max_by("_in_features", F.when(F.col("_in_features").isNotNull(), F.col("_at"))).alias("_in_features"))
    earlier = Window.partitionBy("_file").orderBy("_start", "_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = states.select(*_RANGE).join(last, list(_RANGE), "left").select(
        *_RANGE, F.last("_at", True).over(earlier).alias("_open"),
        F.last("_in_features", True).over(earlier).alias("_open_in_features"))
    so_far = Window.partitionBy(*_RANGE).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    object_id = F.last(F.when(F.col("_starts"), F.col("_at")), True).over(so_far)
    in_features = F.last(F.when(F.col("_starts"), F.col("_in_features")), True).over(so_far)
    owned = started.withColumns({"_own": object_id, "_own_in_features": in_features}).join(carried, list(_RANGE)).select(
        "_start", "_at", "_text", "_starts", "_depth",
        F.coalesce("_own", "_open").alias("_object"), F.coalesce("_own_in_features", "_open_in_features").alias("_taken"))
    texts = owned.where("_taken and (_starts or _depth >= 2)").groupBy("_object").agg(
        F.sort_array(F.collect_list(F.struct("_start", "_at", "_text"))).alias("_parts"))
    feature = GEOJSON["features"].dataType.elementType
    text = F.concat(F.array_join("_parts._text", "}"), F.lit("}"))
    return explode_features(texts.select(F.array(F.from_json(text, feature)).alias("features")))


def _masked(text: str) -> Column:
    """The text with escaped characters blotted out."""
    return F.when(F.contains(text, F.lit("\\")), F.regexp_replace(text, r"(?s)\\.", "__")).otherwise(F.col(text))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The texts before each closing brace with the parity of their quotes (escaped ones don't count) and
    the braces they open, if they start outside a string or inside one."""
    read = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"), F.col("value").alias("_text"))
    masked = read.withColumn("_masked", _masked("_text"))
    quotes = F.length("_masked") - F.length(F.replace("_masked", F.lit('"')))

    def opened(start):  # what is left without strings and other text are the braces
        left = F.regexp_replace("_masked", rf'{start}"[^"]*+"?+|[^"{{]++', "")
        return F.when(F.contains("_masked", F.lit("{")), F.length(left)).otherwise(0)

    return masked.select(F.shiftright("_at", _RANGE_BITS).alias("_block"), "_file", "_start", "_at", "_text",
                         (quotes % 2).cast("long").alias("_quotes"),
                         opened("").alias("_opens_out"), opened(r'^[^"]*+"?+|').alias("_opens_in"))


def _net(inside: Column) -> Column:
    """The change of depth a record and its brace make, by whether it starts inside a string."""
    return F.when(inside, F.col("_opens_in") - F.col("_quotes")).otherwise(F.col("_opens_out") - 1 + F.col("_quotes"))


def _before():
    return Window.partitionBy(*_RANGE).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)


def _range_states(pieces: DataFrame) -> DataFrame:
    """Whether each range starts inside a string, and at which depth."""
    odd = F.col("_quotes_before") % 2 == 1
    ranges = pieces.groupBy(*_RANGE).agg(
        F.sum("_quotes").alias("_quotes"), F.sum(_net(odd)).alias("_net0"), F.sum(_net(~odd)).alias("_net1"))
    earlier = Window.partitionBy("_file").orderBy("_start", "_block").rowsBetween(Window.unboundedPreceding, -1)
    inside = ranges.withColumn("_inside", F.coalesce(F.sum("_quotes").over(earlier), F.lit(0)) % 2)
    net = F.when(F.col("_inside") == 1, F.col("_net1")).otherwise(F.col("_net0"))
    return inside.select(*_RANGE, F.col("_inside").alias("_range_inside"),
                         F.coalesce(F.sum(net).over(earlier), F.lit(0)).alias("_range_depth"))


def _object_starts(pieces: DataFrame, states: DataFrame) -> DataFrame:
    """Records with the depth they start at (``_depth``), whether an object of depth two opens in them
    (``_starts``; its text begins at that brace), and whether that object lies in the array ``features``
    (``_in_features``; null where no key stands between it and the object before)."""
    placed = pieces.join(states, list(_RANGE)).withColumn(
        "_in", (F.col("_quotes_before") + F.col("_range_inside")) % 2 == 1).withColumns({
            "_depth": F.col("_range_depth") + F.coalesce(F.sum(_net(F.col("_in"))).over(_before()), F.lit(0)),
            "_opens": F.when(F.col("_in"), F.col("_opens_in")).otherwise(F.col("_opens_out"))})
    starts = (F.col("_depth") <= 1) & (F.col("_depth") + F.col("_opens") >= 2)
    masked = placed.withColumn("_starts", starts).withColumn("_masked", F.when(F.col("_starts"), _masked("_text")))
    lead = (F.when(F.col("_in"), F.regexp_extract("_masked", rf'^([^"]*+"{_STRINGS})\{{', 1))
            .when(F.col("_depth") == 1, F.regexp_extract("_masked", rf"^({_STRINGS})\{{", 1))
            .otherwise(F.regexp_extract("_masked", rf"^([^{{]*+\{{{_STRINGS})\{{", 1)))
    led = masked.withColumn("_lead", F.when(F.col("_starts"), lead))
    key = F.regexp_like("_lead", F.lit(r'"features"\s*:\s*\[\s*(null\s*,\s*)*$'))
    keyed = F.regexp_replace("_lead", r'"[^"]*"', "").contains(":") | (F.col("_depth") < 1)
    return led.select(*_RANGE, "_at", "_depth", "_starts",
                      F.when(F.col("_starts") & keyed, key).alias("_in_features"),
                      F.when(F.col("_starts"), F.expr("substring(_text, length(_lead) + 1)"))
                      .otherwise(F.col("_text")).alias("_text"))
