"""Layered look-ups: the most precise layer that gives exactly one answer wins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import base_name, district_stem, is_block_code, last_token, parcel_address, search_name


def district_layers(ref: DataFrame) -> DataFrame:
    """(sigungu_code, layer, key, code) of active districts where a key names exactly one code: full local name (1), last word
    (2), stem (3)."""
    active = ref.where("is_active")
    city = active.where(F.col("level") == "시군구").groupBy("sigungu_code").agg(F.max("name").alias("_city"))
    emd = active.where(F.col("level") == "읍면동").join(city, "sigungu_code", "left")
    inside = F.coalesce(F.col("name").startswith(F.col("_city")), F.lit(False))
    local = F.when(inside, F.trim(F.expr("substring(name, length(_city) + 1)"))).otherwise(F.col("name"))
    layers = F.array(*[F.struct(F.lit(i).alias("layer"), k.alias("key")) for i, k in ((1, local), (2, last_token(local)), (3, district_stem(local)))])
    keyed = emd.select("sigungu_code", "code", F.explode(layers).alias("l")).select("sigungu_code", "l.layer", "l.key", "code")
    return keyed.groupBy("sigungu_code", "layer", "key").agg(F.min("code").alias("code"), F.max("code").alias("_most")).where("code = _most").drop("_most")


def resolve_districts(rows: DataFrame, ref: DataFrame, code: str = "sigungu_code", name: str = "dong", parents: DataFrame | None = None) -> DataFrame:
    """Rows with ``legal_code``: the district's code by the first layer that is unique, else null; never drops a row.

    ``parents`` (code, parent) has merged city districts with the parent under which the reference files them; it is tried second. The
    distinct (code, name) pairs are resolved once and joined back.
    """
    layers = district_layers(ref)
    text = F.trim(F.coalesce(F.col(name), F.lit("")))
    asked = rows.select(F.col(code).alias("_c"), F.col(name).alias("_n"), text.alias("_t")).distinct().where("_t <> ''")
    keys = F.array(*[F.struct(F.lit(i).alias("layer"), k.alias("key")) for i, k in ((1, F.col("_t")), (2, last_token(F.col("_t"))), (3, district_stem(F.col("_t"))))])
    tried = asked.withColumn("_try", F.array(F.col("_c")))
    if parents is not None:
        tried = asked.join(parents.select(F.col("code").alias("_c"), F.col("parent").alias("_parent")), "_c", "left").withColumn("_try", F.array_compact(F.array("_c", "_parent")))
    tried = tried.select("_c", "_n", F.posexplode("_try").alias("_turn", "sigungu_code"), keys.alias("_k")).select("_c", "_n", "_turn", "sigungu_code", F.explode("_k").alias("k")).select("_c", "_n", "_turn", "sigungu_code", "k.layer", "k.key")
    best = tried.join(layers, ["sigungu_code", "layer", "key"]).groupBy("_c", "_n").agg(F.min_by("code", F.struct("_turn", "layer")).alias("legal_code"))
    same = rows[code].eqNullSafe(best["_c"]) & rows[name].eqNullSafe(best["_n"])
    return rows.join(best, same, "left").drop("_c", "_n")


def borrow_index(placed: DataFrame, name: str, code: str, order: str, normalise: bool = True) -> DataFrame:
    """(base, sgg) -> coordinates of the first placed row by ``order``."""
    rows = placed.where("lat IS NOT NULL AND lon IS NOT NULL").withColumn("base", base_name(F.col(name), normalise)).where("base <> ''")
    return rows.groupBy("base", F.substring(F.col(code).cast("string"), 1, 5).alias("sgg")).agg(F.min_by(F.struct("lat", "lon"), order).alias("p")).select("base", "sgg", "p.lat", "p.lon")


def cache_lookup(asked: DataFrame, cache: DataFrame) -> DataFrame:
    """Queries (method, query) with their cached place and ``state``: hit, miss (looked up before in vain) or unknown."""
    c = cache.select("method", "query", "status", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
    state = F.when(F.col("status").isNull(), "unknown").when(F.col("status") == "ok", "hit").otherwise("miss")
    hit = F.col("status") == "ok"
    return asked.join(c, ["method", "query"], "left").select(*asked.columns, F.when(hit, F.col("_lat")).alias("lat"), F.when(hit, F.col("_lon")).alias("lon"), state.alias("state"))


def centroids(placed: DataFrame) -> DataFrame:
    """Mean place by (sgg, stem) and by sgg alone (stem null), in one pass."""
    keyed = placed.where("lat IS NOT NULL AND lon IS NOT NULL").select(F.substring(F.col("region_code"), 1, 5).alias("sgg"), district_stem(F.col("dong")).alias("stem"), "lat", "lon")
    grouped = keyed.groupingSets([["sgg", "stem"], ["sgg"]], "sgg", "stem").agg(F.grouping("stem").alias("whole"), F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))
    return grouped.select("sgg", F.when(F.col("whole") == 0, F.col("stem")).alias("stem"), "lat", "lon")


def _tier(lookup: DataFrame, method: str, as_: str) -> DataFrame:
    """Places of one method by query."""
    hits = lookup.where((F.col("method") == method) & (F.col("status") == "ok"))
    return hits.groupBy("query").agg(F.min(F.struct("lat", "lon")).alias(as_)).withColumnRenamed("query", f"_q_{as_}")


def cascade(rows: DataFrame, lookup: DataFrame, queries: list[tuple[str, str, str]], borrow: DataFrame | None = None, borrow_after: int = 1) -> DataFrame:
    """Rows with lat, lon and geocode_precision by the first tier that has a place. ``queries`` lists (method, query column,
    precision); ``borrow`` (base, sgg, lat, lon; rows have base and sgg) comes after the first ``borrow_after`` of them."""
    out, tiers = rows, []
    for i, (method, query, precision) in enumerate(queries):
        if borrow is not None and i == borrow_after:
            out = out.join(borrow.select("base", "sgg", F.struct("lat", "lon").alias("_borrow")), ["base", "sgg"], "left")
            tiers.append(("_borrow", "borrow"))
        name = f"_t{i}"
        tier = _tier(lookup, method, name)
        out = out.join(tier, out[query] == tier[f"_q_{name}"], "left").drop(f"_q_{name}")
        tiers.append((name, precision))
    place = F.coalesce(*[F.col(t) for t, _ in tiers])
    precision = F.coalesce(*[F.when(F.col(t).isNotNull(), F.lit(p)) for t, p in tiers], F.lit("none"))
    return out.withColumns({"lat": place["lat"], "lon": place["lon"], "geocode_precision": precision}).drop(*[t for t, _ in tiers])


def with_centroids(rows: DataFrame) -> DataFrame:
    """Rows without a place get the mean place of their district's stem, else of their city."""
    c = centroids(rows)
    stems = c.where("stem IS NOT NULL").select("sgg", "stem", F.struct("lat", "lon").alias("_d"))
    cities = c.where("stem IS NULL").select("sgg", F.struct("lat", "lon").alias("_s"))
    keyed = rows.withColumns({"_g": F.substring(F.col("region_code"), 1, 5), "_e": district_stem(F.col("dong"))})
    out = keyed.join(stems.withColumnsRenamed({"sgg": "_g", "stem": "_e"}), ["_g", "_e"], "left").join(cities.withColumnRenamed("sgg", "_g"), "_g", "left")
    spare = F.coalesce("_d", "_s")
    empty = F.col("lat").isNull()
    fresh = {"lat": F.coalesce("lat", spare["lat"]), "lon": F.coalesce("lon", spare["lon"]), "geocode_precision": F.when(empty & spare.isNotNull(), "centroid").otherwise(F.col("geocode_precision"))}
    return out.withColumns(fresh).select(*rows.columns)


def geocode_labels(rows: DataFrame, ref: DataFrame, lookup: DataFrame, borrow: DataFrame, normalise: bool = True) -> DataFrame:
    """Labels (region_code, dong, jibun, complex_name): parcel, borrowed, keyword, then centroids."""
    named = _addresses(rows, ref, "region_code", "dong", "jibun", "complex_name", normalise)
    placed = cascade(named.withColumns({"base": base_name(F.col("complex_name"), normalise), "sgg": F.col("_sgg")}), lookup, [("parcel", "_parcel", "parcel"), ("keyword", "_keyword", "keyword")], borrow)
    return with_centroids(placed.select(*rows.columns, "lat", "lon", "geocode_precision"))


def geocode_comps(rows: DataFrame, ref: DataFrame, lookup: DataFrame, normalise: bool = True) -> DataFrame:
    """Sales (sggCd, umdNm, jibun, aptNm): parcel, then keyword; distinct keys are resolved once and joined back."""
    keys = ["sggCd", "umdNm", "jibun", "aptNm"]
    distinct = rows.select(*keys).distinct()
    named = _addresses(distinct, ref, "sggCd", "umdNm", "jibun", "aptNm", normalise)
    placed = cascade(named, lookup, [("parcel", "_parcel", "parcel"), ("keyword", "_keyword", "keyword")]).select(*[F.col(k).alias(f"_k_{k}") for k in keys], "lat", "lon", "geocode_precision")
    same = rows[keys[0]].eqNullSafe(placed[f"_k_{keys[0]}"])
    for k in keys[1:]:
        same = same & rows[k].eqNullSafe(placed[f"_k_{k}"])
    return rows.join(placed, same, "left").drop(*[f"_k_{k}" for k in keys])


def geocode_schools(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    """Schools (name, sido, road_address): road, then keyword."""
    asked = rows.withColumns({"_road": F.trim("road_address"), "_keyword": F.trim(F.concat_ws(" ", "sido", "name"))})
    return cascade(asked, lookup, [("road", "_road", "road"), ("keyword", "_keyword", "keyword")]).select(*rows.columns, "lat", "lon", "geocode_precision")


def _addresses(rows: DataFrame, ref: DataFrame, code: str, dong: str, lot: str, name: str, normalise: bool) -> DataFrame:
    """Rows with the parcel address (null for a block) and the keyword query."""
    sgg = rows.withColumn("_sgg", F.substring(F.col(code).cast("string"), 1, 5))
    found = resolve_districts(sgg, ref, "_sgg", dong)
    active = ref.where("is_active")
    full = active.select(F.col("code").alias("legal_code"), F.col("name").alias("_full")).dropDuplicates(["legal_code"])
    city = active.where(F.col("level") == "시군구").groupBy(F.col("sigungu_code").alias("_sgg")).agg(F.max("name").alias("_city"))
    out = found.join(full, "legal_code", "left").join(city, "_sgg", "left")
    parcel = F.when(~is_block_code(F.col(lot)) & F.col("_full").isNotNull(), parcel_address(F.col("_full"), F.col(lot)))
    return out.withColumns({"_parcel": parcel, "_keyword": F.trim(F.concat_ws(" ", "_city", search_name(F.col(name), normalise)))})
