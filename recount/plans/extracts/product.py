"""Product-service extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions import pg
from ...operators.rank import first_per_key
from ...operators.surrogate import surrogate_id
from ...sources.catalog import Catalog

# Fixed value: the English name of the parent taxon whose children are brands.
BRANDS_TAXON_NAME = "Brands"
VARIANT_ASSET = "Spree::Variant"


def offline_product_barcode(cat: Catalog) -> DataFrame:
    """D24 ``offline_product_barcode``: one row per barcode array element; all-digit barcodes
    become bigint, anything else (letters, null element, out of range) -1.

    ``explode`` drops null and empty arrays exactly as the legacy lateral unnest does. The
    legacy pattern reaches the database as ``^d+$`` (an escape string eats the backslash), so
    every barcode there is -1; the row count is the same, and the intent (digits) is built."""
    cp = cat["spree_custom_products"].select("id", F.explode("barcodes").alias("b"))
    return cp.select(
        F.col("id").alias("offline_product_id"),
        pg.digits_or("b", -1, "bigint").alias("barcode"),
        F.lit(1).alias("order"),
    )


def product_image(cat: Catalog) -> DataFrame:
    """D25 ``product_image``: assets attached to variants."""
    return cat["spree_assets"].filter(F.col("viewable_type") == VARIANT_ASSET)


def product_taxon(cat: Catalog) -> DataFrame:
    """D26 ``product_taxon``: distinct (product, taxon) pairs."""
    return cat["spree_products_taxons"].select("product_id", "taxon_id").distinct()


def _pivot_locale(df: DataFrame, key: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Conditional-max pivot: ``MAX(CASE WHEN locale = l THEN c END)`` per ``key`` (A4)."""
    return df.groupBy(key).agg(
        *[F.max(F.when(F.col("locale") == loc, F.col(c))).alias(out) for out, (loc, c) in fields.items()]
    )


def promotion(cat: Catalog) -> DataFrame:
    """D27 ``promotion``: promotions with at least one named translation, en/ar pivoted, one
    per English name (lowest id; a missing English name counts as '').

    Translations are pivoted per promotion before meeting the promotions, which the legacy
    ``GROUP BY sp.id`` allows because ``sp.id`` is the promotion key."""
    spt = cat["spree_promotion_translations"].filter(F.col("name").isNotNull())
    names = _pivot_locale(
        spt,
        "spree_promotion_id",
        {
            "en_name": ("en", "name"),
            "en_desc": ("en", "description"),
            "ar_name": ("ar", "name"),
            "ar_desc": ("ar", "description"),
        },
    )
    sp = cat["spree_promotions"]
    j = sp.join(names, sp["id"] == names["spree_promotion_id"])
    rows = j.select(
        "id",
        F.coalesce(F.col("en_name"), F.lit("")).alias("name_en"),
        F.col("en_desc").alias("description_en"),
        F.coalesce(F.col("ar_name"), F.lit("")).alias("name_ar"),
        F.col("ar_desc").alias("description_ar"),
        pg.slug("en_name").alias("code"),
        "expires_at",
        "starts_at",
        F.coalesce(F.col("usage_limit"), F.lit(0)).alias("usage_limit"),
        "match_policy",
        "created_at",
        "updated_at",
        "per_code_usage_limit",
        "apply_automatically",
        "deleted_at",
        F.lit(True).alias("is_visible"),
    )
    return first_per_key(rows, ["name_en"], [pg.asc("id")])


def brand(cat: Catalog, with_ids: bool = True) -> DataFrame:
    """D28 ``brand``: children of the taxon named 'Brands', en/ar pivoted, with a short code.

    The legacy surrogate id (``ROW_NUMBER() OVER ()``, no order) also enters the code; ours
    numbers brands by taxon id."""
    st = cat["spree_taxons"]
    stt = cat["spree_taxon_translations"]
    parents = (
        stt.filter((F.col("locale") == "en") & (F.col("name") == BRANDS_TAXON_NAME))
        .select(F.col("spree_taxon_id").alias("pid"))
        .join(st.select(F.col("id").alias("tid")), F.col("pid") == F.col("tid"), "left_semi")
    )
    children = st.join(parents, st["parent_id"] == parents["pid"], "left_semi").select("id", "created_at", "updated_at")
    # Only the brands' own translations are pivoted, not every taxon's.
    brand_names = stt.join(children.select(F.col("id").alias("cid")), F.col("spree_taxon_id") == F.col("cid"), "left_semi")
    names = _pivot_locale(brand_names, "spree_taxon_id", {"name_en_raw": ("en", "name"), "name_ar_raw": ("ar", "name")})
    rt = children.join(names, children["id"] == names["spree_taxon_id"], "left").select(
        F.col("id").alias("temp_taxon_id"), "name_en_raw", "name_ar_raw", "created_at", "updated_at"
    )
    cols = ["name_en", "code", "created_at", "updated_at", "temp_taxon_id", "name_ar"]
    if with_ids:
        rt = surrogate_id(rt, ["temp_taxon_id"])
        code = F.coalesce(pg.brand_code("name_en_raw", "id"), F.lit(""))
    else:
        code = F.lit(None).cast("string")
    out = rt.select(
        *(["id"] if with_ids else []),
        F.coalesce(F.col("name_en_raw"), F.lit("")).alias("name_en"),
        code.alias("code"),
        "created_at",
        "updated_at",
        "temp_taxon_id",
        F.coalesce(F.col("name_ar_raw"), F.lit("")).alias("name_ar"),
    )
    return out if with_ids else out.select(*cols)


def supplier(cat: Catalog) -> DataFrame:
    """D29 ``supplier``: per product the max English and Arabic manufacturer, then one row per
    Arabic value (null is one group); name = max English without a trailing ``-digits``.

    Both levels are plain aggregations with map-side partial aggregation, so a hot Arabic
    value (or the null group) is combined in every map task before the shuffle."""
    spt = cat["spree_product_translations"].filter(F.col("manufacturer").isNotNull())
    per_product = spt.groupBy("spree_product_id").agg(
        F.max(F.when(F.col("locale") == "en", F.col("manufacturer"))).alias("supplier_name"),
        F.max(F.when(F.col("locale") == "ar", F.col("manufacturer"))).alias("code"),
        F.max("created_at").alias("created_at"),
        F.max("updated_at").alias("updated_at"),
        F.max("deleted_at").alias("deleted_at"),
    )
    per_code = per_product.groupBy("code").agg(
        F.max(F.coalesce(F.col("supplier_name"), F.lit(""))).alias("name_raw"),
        F.max("created_at").alias("created_at"),
        F.max("updated_at").alias("updated_at"),
        F.max("deleted_at").alias("deleted_at"),
    )
    return per_code.select(
        pg.strip_trailing_number("name_raw").alias("name"),
        pg.left(F.coalesce(F.col("code"), F.lit("")), 10).alias("code"),
        "created_at",
        "updated_at",
        "deleted_at",
    )


def shopping_list_products(cat: Catalog) -> DataFrame:
    """D30 ``shopping_list_products``: distinct (wishlist, product) of wished variants; a
    variant with no product row gives product null, which is one group.

    Wished rows are first reduced to distinct (wishlist, variant) map-side, then joined."""
    swp = cat["spree_wished_products"].select("wishlist_id", "variant_id").distinct()
    sv = cat["spree_variants"].select(F.col("id").alias("sv_id"), "product_id")
    j = swp.join(sv, F.col("sv_id") == F.col("variant_id"), "left")
    return j.select(F.col("wishlist_id").alias("shopping_list_id"), "product_id").distinct()
