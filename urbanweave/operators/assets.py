"""The facade and sign catalogue: roles from names, browse folders, validation, photo slots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from urbanweave.functions import constants as K
from urbanweave.functions import tags


def has_any(text: Column, words) -> Column:
    return reduce(lambda p, q: p | q, [text.contains(w) for w in words])


def base_name(path: Column) -> Column:
    return F.lower(F.element_at(F.split(path, "/"), -1))


def low_rise_role(file: Column) -> Column:
    """shop, residential or null from a texture's file name; the first rule that holds wins."""
    name = base_name(file)
    return (
        F.when(has_any(name, K.LOW_RISE_SKIP_WORDS), None)
        .when(has_any(name, ["apartment", "house"]), "residential")
        .when(name.contains("dock"), None)
        .when(name.contains("shutter") | has_any(name, K.LOW_RISE_SHOP_WORDS), "shop")
        .when(has_any(name, K.LOW_RISE_HOME_WORDS), "residential")
    )


def sheet_role(file: Column) -> Column:
    """office, industrial, full or null for files that have no low-rise role."""
    name = base_name(file)
    return (
        F.when(low_rise_role(file).isNotNull() | has_any(name, K.SHEET_SKIP_WORDS), None)
        .when(name.contains("office"), "office")
        .when(has_any(name, K.SHEET_INDUSTRIAL_WORDS), "industrial")
        .when(name.startswith("building_") | name.contains("derelict"), "full")
    )


def free_license(short_name: Column) -> Column:
    """Licence kept for a photo (CC0, or CC BY without share-alike); null when it is not free enough."""
    text = F.lower(F.coalesce(short_name, F.lit("")))
    public = text.contains("cc0") | text.contains("public domain") | text.isin(*K.PUBLIC_DOMAIN_LICENSES)
    attribution = text.startswith("cc by") & ~text.contains("sa")
    named = F.coalesce(F.nullif(F.trim(short_name), F.lit("")), F.lit("CC-BY"))
    return F.when(public, "CC0").when(attribution, named)


def strip_html(text: Column) -> Column:
    """Text without markup, white space collapsed."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"<[^>]+>", " ")
    return F.trim(F.regexp_replace(plain, r"(?U)\s+", " "))


def browse_folder(
    asset_id: Column, notes: Column, bucket: Column, role: Column, part: Column, band: Column
) -> Column:
    """Folder an asset is filed under for picking."""
    aid, said = F.lower(F.coalesce(asset_id, F.lit(""))), F.lower(F.coalesce(notes, F.lit("")))
    blob = F.concat(aid, F.lit(" "), said)
    role = F.coalesce(role, F.lit(""))
    bucket, part, band = (F.coalesce(c, F.lit("")) for c in (bucket, part, band))
    sheets = (
        F.when(role == "office", "facades/sheets/office")
        .when(role == "industrial", "facades/sheets/industrial").otherwise("facades/sheets/residential")
    )
    signs = (
        F.when(role == "vertical", "signage/vertical").when(role == "overlay", "signage/overlay")
        .otherwise("signage/horizontal")
    )
    details = (
        F.when((role == "window") | blob.contains("window"), "details/windows")
        .when((role == "door") | has_any(blob, ["door", "garage"]), "details/doors").otherwise("details/overlays")
    )
    return (
        F.when(part == "roof", F.when(has_any(blob, K.ROOF_METAL_WORDS), "roofs/metal").otherwise("roofs/tile"))
        .when(
            blob.contains("shutter"),
            F.when((role == "overlay") & (bucket == "signage"), "signage/overlay").otherwise("details/shutters"),
        )
        .when((bucket == "signage") | role.isin("vertical", "horizontal"), signs)
        .when(has_any(blob, K.BALCONY_WORDS), "details/balconies")
        .when(aid.contains("plaster") & (bucket == "low_rise"), "facades/tileable/cladding")
        .when((bucket == "details") | (part == "decal"), details)
        .when(
            bucket == "low_rise",
            F.when(role == "shop", "facades/sheets/shopfront").otherwise("facades/sheets/residential"),
        )
        .when(bucket == "sheets", sheets)
        .when(has_any(blob, K.METAL_WALL_WORDS), "facades/tileable/metal")
        .when(has_any(blob, K.CLADDING_WORDS), "facades/tileable/cladding")
        .when(band.isin("tower", "high") | has_any(said, K.GLASS_WORDS), "facades/tileable/highrise")
        .otherwise("facades/tileable/midrise")
    )


def with_folder(assets: DataFrame) -> DataFrame:
    columns = [F.col(c) for c in ("id", "notes", "bucket", "role", "part", "suggested_band")]
    return assets.withColumn("folder", browse_folder(*columns))


def violations(assets: DataFrame) -> DataFrame:
    """Rows that break a catalogue rule: ``(id, problem)``, one row per broken rule (duplicates once per id)."""
    bucket, part, band, role = (F.col(c) for c in ("bucket", "part", "suggested_band", "role"))
    allowed = F.create_map(*[
        x for b, roles in K.ASSET_ROLES.items() for x in (F.lit(b), F.array(*[F.lit(r) for r in roles]).cast("array<string>"))
    ])
    needs_role = F.size(F.coalesce(allowed[bucket], F.array().cast("array<string>"))) > 0
    good_role = F.when(needs_role, F.coalesce(F.array_contains(allowed[bucket], role), F.lit(False))).otherwise(role.isNull())
    text = F.upper(F.regexp_replace(F.coalesce("license", F.lit("")), "_", " "))
    good_license = text.startswith("CC0") | text.startswith("CC BY") | text.startswith("CC-BY")
    problems = F.array_compact(F.array(
        F.when(~tags.one_of(bucket, K.ASSET_BUCKETS), "bad bucket"),
        F.when(~tags.one_of(part, K.ASSET_PARTS), "bad part"),
        F.when(part.isin("facade", "decal") & band.isNotNull() & ~band.isin(*K.ASSET_BANDS), "facade missing band"),
        F.when(tags.one_of(bucket, K.ASSET_BUCKETS) & ~good_role, "bad role"),
        F.when(~good_license, "non-CC"),
    ))
    broken = assets.select("id", F.explode(problems).alias("problem"))
    twice = assets.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")
    return broken.unionByName(twice.select("id", F.lit("duplicate id").alias("problem")))


def uv_mode(path: Column) -> Column:
    text = F.regexp_replace(path, r"\\", "/")
    sheet = text.contains("/facades/sheets/") | text.contains("/facades/tileable/highrise")
    return F.when(sheet, "unique_sheet").otherwise("tile")


def catalogue_counts(assets: DataFrame) -> DataFrame:
    """Listed and present assets per browse folder; an asset is present when its file has over 1000 bytes."""
    present = F.coalesce(F.col("bytes") > K.MIN_ASSET_BYTES, F.lit(False))
    return with_folder(assets).groupBy("folder").agg(F.count("*").alias("listed"), F.count_if(present).alias("present"))


def _folder_table(spark: SparkSession, pools: dict[str, list[str]]) -> DataFrame:
    rows = [(pool, i, folder) for pool, folders in pools.items() for i, folder in enumerate(folders)]
    return spark.createDataFrame(rows, "pool string, folder_no int, folder string")


def pooled_photos(photos: DataFrame) -> DataFrame:
    """Photos of every pool in pick order: ``(pool, n, path)`` with ``n`` from zero.

    ``photos`` is ``(folder, name, path)``; a path listed by several folders counts for the first one only.
    """
    pools = {**K.BAND_FOLDERS, "shops": K.LOW_SHOP_FOLDERS, "homes": K.LOW_HOME_FOLDERS, "roofs": K.ROOF_FOLDERS}
    folders = F.broadcast(_folder_table(photos.sparkSession, pools))  # one row per fixed folder of a pool
    kept = photos.where(F.lower(F.regexp_extract("name", r"\.([^.]+)$", 1)).isin(*K.PHOTO_SUFFIXES))
    rows = kept.join(folders, "folder").groupBy("pool", "path").agg(
        F.min(F.struct("folder_no", F.lower("name").alias("name"))).alias("at")
    )
    order = Window.partitionBy("pool").orderBy("at.folder_no", "at.name", "path")
    return rows.select("pool", (F.row_number().over(order) - 1).alias("n"), "path")


def bind_low_slots(photos: DataFrame) -> DataFrame:
    """Photo of every low-rise facade variant: shops fill the first half, homes the rest, each pool in turn.

    Without shop photos homes take all slots; without home photos shops do. ``(slot, path, uv_mode)``.
    """
    pools = pooled_photos(photos).where(F.col("pool").isin("shops", "homes"))
    sizes = pools.groupBy("pool").agg(F.count("*").alias("size"))
    n_low, n_shop = K.FACADE_VARIANTS["low"], K.LOW_SHOP_VARIANTS
    counts = {r["pool"]: r["size"] for r in sizes.collect()}  # two numbers
    shops, homes = counts.get("shops", 0), counts.get("homes", 0)
    slots = []
    if shops:
        slots += [(i, "shops", i % shops) for i in range(n_shop)]
    rest, size = ("homes", homes) if homes else ("shops", shops)
    if size:
        slots += [(len(slots) + i, rest, i % size) for i in range(n_low - len(slots))]
    table = photos.sparkSession.createDataFrame(slots, "slot int, pool string, n int")
    return pools.join(F.broadcast(table), ["pool", "n"]).select("slot", "path", uv_mode(F.col("path")).alias("uv_mode"))


def bind_band_photos(photos: DataFrame) -> DataFrame:
    """Photos of the bands above low in pick order with their texture mode."""
    upper = pooled_photos(photos).where(F.col("pool").isin("mid", "high", "tower"))
    return upper.select(F.col("pool").alias("band"), "n", "path", uv_mode(F.col("path")).alias("uv_mode"))


def searched_photos(rows: DataFrame) -> DataFrame:
    """Photos kept from a search listing, in order ``pos``: big enough, freely licensed, each title once.

    Portraits (and anything a sign search found) become signs, others facade sheets.
    """
    title = F.upper("title")
    fit = rows.withColumn("free", free_license(F.col("license"))).where(
        F.col("free").isNotNull() & (F.col("width") >= K.PHOTO_MIN_SIDE_PX) & (F.col("height") >= K.PHOTO_MIN_SIDE_PX)
        & ~has_any(title, K.SKIPPED_TITLE_WORDS)
    )
    names = [c for c in fit.columns if c != "title"]
    first = fit.groupBy("title").agg(F.min_by(F.struct(*names), "pos").alias("r")).select("title", "r.*")
    portrait = F.col("height") >= F.col("width") * K.PORTRAIT_RATIO
    sign = F.col("query").contains("sign") | portrait
    token = F.regexp_replace(F.regexp_replace("title", "File:", ""), r"[^a-zA-Z0-9]+", "_")
    return first.select(
        F.concat(F.lit("wiki_"), F.regexp_replace(token, r"^_+|_+$", "")).alias("id"), "title",
        F.when(sign, "signage").otherwise("sheets").alias("bucket"),
        F.when(sign, F.when(portrait, "vertical").otherwise("horizontal")).otherwise("full").alias("role"),
        F.when(sign, "decal").otherwise("facade").alias("part"),
        F.when(F.col("free") == "CC0", "CC0-1.0").otherwise(F.col("free")).alias("license"),
    )


def photos_by_band(photos: DataFrame) -> DataFrame:
    """Cached photos ``(stem, path)`` of every band in the band's fixed order: ``(band, n, path)``."""
    rows = [(band, i, stem) for band, stems in K.PHOTO_BANDS.items() for i, stem in enumerate(stems)]
    wanted = photos.sparkSession.createDataFrame(rows, "band string, i int, stem string")
    last = photos.groupBy("stem").agg(F.max("path").alias("path"))
    order = Window.partitionBy("band").orderBy("i")  # at most as many rows as the fixed list
    found = last.join(F.broadcast(wanted), "stem")
    return found.select("band", (F.row_number().over(order) - 1).alias("n"), "path")
