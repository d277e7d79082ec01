"""User-service extracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ...functions import pg
from ...operators.joins import left_join_fanout, prefixed
from ...operators.rank import first_per_key
from ...sources.catalog import Catalog
from .auth import login_type

# Payment method class -> payment option code (anything else '').
PAYMENT_OPTION_CODES = {
    "Spree::PaymentMethod::StoreCredit": "e-wlt",
    "Spree::Gateway::PayFort": "credit",
    "Spree::Gateway::CheckoutCom": "credit",
    "Spree::Gateway::Tamara": "tamara",
    "Spree::Gateway::BogusSimple": "bogus-simple",
    "Spree::PaymentMethod::Check": "cod",
    "Spree::Gateway::CheckoutCom::ApplePay": "a-pay",
    "Spree::Gateway::LoyaltyPoint": "loy-pts",
    "Spree::Gateway::PayFort::ApplePay": "a-pay",
}

# Markers in a supermarket's payment options document and the delivery
# option each one stands for.
HOME_DELIVERY, STORE_PICK_UP = "home_delivery", "store_pick_up"
HOME_OPTION, PICK_UP_OPTION = "1", "2"


def city(cat: Catalog) -> DataFrame:
    """D11 ``city``: distinct English state names of the states that have supermarkets.

    Only ``state_id`` of a supermarket reaches the output, so supermarkets are cut to their
    distinct state ids (aggregated map-side) before joining the state tables."""
    states_used = cat["danube_supermarkets"].select(F.col("state_id").alias("ds_state_id")).distinct()
    ss = cat["spree_states"].alias("ss")
    sst = cat["spree_state_translations"].filter(F.col("locale") == "en").alias("sst")
    j = states_used.join(ss, F.col("ss.id") == F.col("ds_state_id")).join(
        sst, F.col("sst.spree_state_id") == F.col("ss.id")
    )
    return j.select(
        F.lower(F.col("sst.name")).alias("name"),
        F.col("ss.country_id").alias("country_id"),
        F.col("ss.created_at").alias("created_at"),
        F.col("ss.updated_at").alias("updated_at"),
        F.lit(True).alias("is_visible"),
        F.col("ds_state_id").alias("state_id"),
    ).distinct()


def payment_option(cat: Catalog) -> DataFrame:
    """D12 ``payment_option``: payment methods that have an English name."""
    spm = cat["spree_payment_methods"].alias("spm")
    spmt = cat["spree_payment_method_translations"].filter(F.col("locale") == "en").alias("spmt")
    j = spm.join(spmt, F.col("spmt.spree_payment_method_id") == F.col("spm.id"))
    return j.select(
        F.col("spm.id").alias("id"),
        F.col("spmt.name").alias("name"),
        F.col("spm.created_at").alias("created_at"),
        F.col("spm.updated_at").alias("updated_at"),
        F.col("spm.deleted_at").alias("deleted_at"),
        pg.value_map("spm.type", PAYMENT_OPTION_CODES, "").alias("code"),
    )


def time_slot(cat: Catalog) -> DataFrame:
    """D13 ``time_slot``: enabled slots, one row per (slot, method, weekday) group.

    The legacy GROUP BY also lists the slot's times and flag, which depend on the slot id
    alone, so schedules are first reduced to distinct (slot, method, weekday) and only then
    joined to the slots. The slot id is not output, so equal rows can repeat."""
    groups = cat["danube_time_slots_schedules"].select(
        "time_slot_id", "spree_shipping_method_id", "day_of_week"
    ).distinct()
    dts = cat["danube_time_slots"].filter(F.col("enabled")).alias("dts")
    j = groups.join(dts, F.col("dts.id") == F.col("time_slot_id"))
    return j.select(
        F.col("spree_shipping_method_id").alias("delivery_option_id"),
        pg.weekday_name("day_of_week", "").alias("day_of_week"),
        F.col("dts.start_time").cast("string").alias("start_time"),
        F.col("dts.end_time").cast("string").alias("end_time"),
        F.col("dts.enabled").alias("enabled"),
        F.lit(1).alias("country_id"),
    )


def delivery_option(cat: Catalog) -> DataFrame:
    """D14 ``delivery_option``: every shipping method, with its English name if any."""
    ssm = cat["spree_shipping_methods"].alias("ssm")
    ssmt = cat["spree_shipping_method_translations"].filter(F.col("locale") == "en").alias("ssmt")
    j = ssm.join(ssmt, F.col("ssmt.spree_shipping_method_id") == F.col("ssm.id"), "left")
    return j.select(
        F.col("ssm.id").alias("id"),
        F.col("ssmt.name").alias("name"),
        F.col("ssm.created_at").alias("created_at"),
        F.col("ssm.updated_at").alias("updated_at"),
        F.col("ssm.deleted_at").alias("deleted_at"),
    )


def default_address(cat: Catalog) -> DataFrame:
    """One default address per user (the lowest user-address id), with its address row
    (address ids are the addresses' primary key).

    Columns: ``da_user_id, da_city, da_latitude, da_longitude, da_country_id``."""
    ua = cat["spree_user_addresses"].filter(F.col("default") == F.lit(True))
    first = first_per_key(ua, ["user_id"], [pg.asc("id")]).select("user_id", "address_id")
    a = cat["spree_addresses"].select("id", "city", "latitude", "longitude", "country_id")
    j = first.join(a, a["id"] == first["address_id"], "left")
    return j.select(
        F.col("user_id").alias("da_user_id"),
        F.col("city").alias("da_city"),
        F.col("latitude").alias("da_latitude"),
        F.col("longitude").alias("da_longitude"),
        F.col("country_id").alias("da_country_id"),
    )


def _country_id(c: str) -> Column:
    # ``CASE WHEN country_id = '0' THEN '1' ELSE country_id END`` keeping the column's type.
    return F.when(F.col(c) == 0, F.lit(1)).otherwise(F.col(c))


def _names() -> list[Column]:
    """``LEFT(COALESCE(name, ''), 40)`` for the first and last name."""
    return [
        pg.left(F.coalesce(F.col("first_name"), F.lit("")), 40).alias("first_name"),
        pg.left(F.coalesce(F.col("last_name"), F.lit("")), 40).alias("last_name"),
    ]


def user(cat: Catalog) -> DataFrame:
    """D15 ``user``: one row per user with its default address and latest social login.

    Latest = ``updated_at DESC`` with nulls first (PostgreSQL), then the lowest login id; the
    default address is the lowest user-address id. Both lists are cut to one row per user
    before the joins, so a user with millions of logins is reduced map-side, and all three
    joins share the user-id partitioning."""
    u = cat["spree_users"]
    sua = first_per_key(
        cat["spree_user_authentications"], ["user_id"], [pg.desc("updated_at"), pg.asc("id")]
    ).select(F.col("user_id").alias("sua_user_id"), F.col("provider").alias("sua_provider"),
             F.col("uid").alias("sua_uid"))
    da = default_address(cat)
    j = u.join(da, u["id"] == da["da_user_id"], "left").join(sua, u["id"] == sua["sua_user_id"], "left")
    return j.select(
        "id",
        pg.flag("deleted_at").alias("is_deleted"),
        "created_at",
        "updated_at",
        *_names(),
        "email",
        F.lit("others").alias("gender"),
        pg.country_code("mobile_number_country_code").alias("country_code"),
        pg.normalize_phone("mobile_phone_number", "mobile_number_country_code").alias("mobile_number"),
        F.col("dob").cast("string").alias("dob"),
        F.coalesce(F.col("referral_code"), F.lit("")).alias("referral_code"),
        F.when(F.col("locale") == "en", F.lit(1)).otherwise(F.lit(2)).alias("language_id"),
        F.col("da_city").alias("city"),
        F.col("da_latitude").alias("latitude"),
        F.col("da_longitude").alias("longitude"),
        _country_id("da_country_id").alias("country_id"),
        F.lit(True).alias("receive_marketing_promotions"),
        login_type("sua_provider").alias("login_type"),
        F.col("sua_uid").alias("social_id"),
        F.lit(0).alias("balance"),
        "blacklisted_at",
        "blacklisted_reason",
    )


def names_by_locale(translations: DataFrame, key: str, default: str | None = None) -> DataFrame:
    """``(key, name)``: the distinct values of ``COALESCE(en.name, ar.name, default)`` that a left join
    with the English and another with the Arabic translations of a key would give (J7), from one
    pass: an English name; an Arabic one where there is no English translation, or one without
    a name. Usually one row a key."""
    t = translations.filter(F.col("locale").isin("en", "ar") & F.col(key).isNotNull())
    names = t.groupBy(F.col(key).alias("key"), "name").agg(
        F.max(F.col("locale") == "en").alias("en"), F.max(F.col("locale") == "ar").alias("ar")
    )
    of_key = Window.partitionBy("key")
    missing = F.col("name").isNull()
    flagged = names.select(
        "key", "name", "en", "ar",
        F.max("en").over(of_key).alias("any_en"),
        F.max(F.col("en") & missing).over(of_key).alias("nameless_en"),
        F.max("ar").over(of_key).alias("any_ar"),
    )
    arabic = F.col("ar") & (~F.col("any_en") | F.col("nameless_en"))
    found = flagged.filter((F.col("en") & ~missing) | arabic | (F.col("en") & missing & ~F.col("any_ar")))
    if default is None:
        return found.select("key", "name")
    return found.select("key", F.coalesce("name", F.lit(default)).alias("name")).distinct()


def user_address(cat: Catalog, state_key: str = "id") -> DataFrame:
    """D16 ``address``: user addresses with district and city names (English, else Arabic).

    The legacy query joins the state translations on the translation's own ``id`` (the city
    extract uses ``spree_state_id``, which is likely what was meant); ``state_key`` keeps the
    line as written by default and selects the other key with ``"spree_state_id"``."""
    sua = cat["spree_user_addresses"].alias("sua")
    sa = cat["spree_addresses"].filter(F.col("city").isNotNull()).alias("sa")
    scon = cat["spree_countries"].alias("scon")
    # One row per name of a district or state. Rows of one address differ in these only, so that
    # unequal rows are what the legacy DISTINCT leaves (user addresses, addresses, countries and
    # districts are joined by their primary keys).
    sdist = cat["spree_districts"].select("id")
    sdt = names_by_locale(cat["spree_district_translations"], "spree_district_id")
    sdt = sdt.join(sdist, F.col("key") == sdist["id"], "left_semi").alias("sdt")
    sst = names_by_locale(cat["spree_state_translations"], state_key, default="").alias("sst")
    # ``WHERE sa.id IS NOT NULL AND city IS NOT NULL`` turns the address join inner.
    j = (
        sua.join(sa, F.col("sua.address_id") == F.col("sa.id"), "inner")
        .join(scon, F.col("sa.country_id") == F.col("scon.id"), "left")
        .join(sdt, F.col("sdt.key") == F.col("sa.district_id"), "left")
        .join(sst, F.col("sst.key") == F.col("sa.state_id"), "left")
    )
    a1, a2 = F.col("sa.address1"), F.col("sa.address2")
    formatted = (
        F.when(a1.isNotNull() & a2.isNotNull(), pg.concat(a1, " ", a2, ", "))
        .when(a1.isNotNull(), pg.concat(a1, " "))
        .when(a2.isNotNull(), pg.concat(a2, ", "))
        .otherwise(F.lit(""))
    )
    rows = j.select(
        F.col("sua.id").alias("id"),
        formatted.alias("formatted_address"),
        F.coalesce(F.col("sst.name"), F.lit("")).alias("city"),
        F.coalesce(F.col("scon.name"), F.lit("Saudi Arabia")).alias("country"),
        pg.only_digits_or_null("sa.zipcode", "bigint").alias("postal_code"),
        F.col("sua.created_at").alias("created_at"),
        F.col("sua.updated_at").alias("updated_at"),
        F.col("sdt.name").alias("district"),
        F.coalesce(F.col("sa.latitude"), F.lit(0)).alias("latitude"),
        F.coalesce(F.col("sa.longitude"), F.lit(0)).alias("longitude"),
        F.coalesce(F.col("sua.default"), F.lit(False)).alias("is_default"),
        F.col("sua.user_id").alias("user_id"),
        F.col("sa.driver_meta_data").isNotNull().alias("has_meta"),
        # ``->> 'verified'`` and ``->> 'notes'`` from one parse of the document.
        F.json_tuple(F.col("sa.driver_meta_data"), "verified", "notes").alias("meta_verified", "meta_notes"),
    )
    verified = F.coalesce(F.when(F.col("has_meta"), F.col("meta_verified")).otherwise(F.lit("false")), F.lit("false"))
    return rows.select(
        "id", "formatted_address", "city", "country", "postal_code", "created_at", "updated_at", "district",
        "latitude", "longitude", "is_default", "user_id",
        F.lit("other").alias("type"),
        verified.alias("is_verified"),
        F.lit("").alias("title"),
        F.col("meta_notes").alias("comments"),
    )


def checkout_cards(cat: Catalog) -> DataFrame:
    """D17 ``checkout_cards``: cards with an owner and a gateway customer profile."""
    a = cat["spree_credit_cards"].filter(
        F.col("user_id").isNotNull() & F.col("gateway_customer_profile_id").isNotNull()
    )
    return a.select(
        "id",
        "user_id",
        F.coalesce(F.col("name"), F.lit("")).alias("name_on_card"),
        F.coalesce(F.col("cc_type"), F.lit("")).alias("scheme"),
        pg.value_map("cc_type", {"MADA": "mada"}, "").alias("scheme_local"),
        F.coalesce(F.col("gateway_payment_profile_id"), F.lit("")).alias("instrument_id"),
        "last_digits",
        "month",
        "year",
        "updated_at",
        "created_at",
        F.lit("CREDIT").alias("card_type"),
    )


def _section(text: Column, marker: str, other: str) -> Column:
    """The part of the document after the last ``marker:`` and before the next ``other:``,
    newlines removed and the first quoted number unquoted."""
    after = F.regexp_replace(text, f"(?s)^.*{marker}:(.*)$", "$1")
    cut = pg.regexp_replace_first(after, f"{other}:.*$", "")
    flat = F.replace(cut, F.lit("\n"), F.lit(""))
    return _unquote_first(flat)


def _unquote_first(c: Column) -> Column:
    # REGEXP_REPLACE(c, '''(\d+)''', '\1'): strip the quotes of the first quoted number.
    return F.regexp_replace(c, r"(?s)^(.*?)'(\d+)'(.*)$", "$1$2$3")


def supermarket_payment(cat: Catalog) -> DataFrame:
    """D18 ``super_market_payment``: one row per payment id listed under each delivery marker.

    The legacy UNION ALL scans supermarkets twice; here one scan emits both sections. The
    legacy text passes ``'\\1'`` through a non-raw string, which sends character 1 instead of
    a back-reference and so finds no ids; this builds the evident intent (ids after the
    marker)."""
    ds = cat["danube_supermarkets"].select("id", F.col("payment_options").cast("string").alias("t"))
    t = F.col("t")
    sections = F.array(
        F.when(t.contains(HOME_DELIVERY), F.struct(F.lit(HOME_OPTION).alias("opt"),
                                                   _section(t, HOME_DELIVERY, STORE_PICK_UP).alias("sec"))),
        F.when(t.contains(STORE_PICK_UP), F.struct(F.lit(PICK_UP_OPTION).alias("opt"),
                                                   _section(t, STORE_PICK_UP, HOME_DELIVERY).alias("sec"))),
    )
    per_section = ds.select("id", F.explode(sections).alias("s")).filter(F.col("s").isNotNull())
    ids = per_section.select(
        "id", F.col("s.opt").alias("opt"), F.explode(F.regexp_extract_all("s.sec", F.lit(r"(\d+)"), 1)).alias("pid")
    )
    return ids.select(
        F.col("id").alias("super_market_id"),
        F.col("pid").try_cast("int").alias("payment_id"),
        F.col("opt").alias("delivery_option_id"),
    )


def supermarket_delivery_types_all(cat: Catalog) -> DataFrame:
    """Regular stores -> 1, express stores -> 2, both for ``regular_and_express``: the two
    legacy branches as one scan emitting up to two rows per store (UNION ALL)."""
    ds = cat["danube_supermarkets"]
    typ = F.col("supermarket_type")
    kinds = F.array(
        F.when(pg.in_list(typ, ["regular", "regular_and_express"]), F.lit(1)),
        F.when(pg.in_list(typ, ["express", "regular_and_express"]), F.lit(2)),
    )
    return ds.select(F.col("id").alias("supermarket_id"), F.explode(kinds).alias("delivery_type_id")).filter(
        F.col("delivery_type_id").isNotNull()
    )


def supermarket_delivery_type(cat: Catalog) -> DataFrame:
    """D19 ``supermarket_delivery_type``: the pairs above, distinct (UNION)."""
    return supermarket_delivery_types_all(cat).distinct()


def supermarket_delivery_option(cat: Catalog) -> DataFrame:
    """D21 ``supermarket_delivery_option``: pick-up -> 2, home delivery -> 1; distinct."""
    ds = cat["danube_supermarkets"]
    t = F.col("payment_options").cast("string")
    opts = F.array(
        F.when(t.contains(STORE_PICK_UP), F.lit(2)),
        F.when(t.contains(HOME_DELIVERY), F.lit(1)),
    )
    return (
        ds.select(F.col("id").alias("supermarket_id"), F.explode(opts).alias("delivery_option_id"))
        .filter(F.col("delivery_option_id").isNotNull())
        .distinct()
    )


def employee(cat: Catalog) -> DataFrame:
    """D22 ``employee`` (user database): users with a role not named 'user', first role by
    name (then role id), with the default address.

    Roles are cut to one per user before meeting the users, so the joins do not fan out."""
    sr = cat["spree_roles"].filter(F.col("name") != "user").select(F.col("id").alias("sr_id"), F.col("name").alias("role_name"))
    sru = cat["spree_roles_users"].join(sr, F.col("role_id") == F.col("sr_id"))
    role = first_per_key(sru, ["user_id"], [pg.asc("role_name"), pg.asc("role_id")]).select(
        F.col("user_id").alias("r_user_id"), "role_id", "role_name"
    )
    u = cat["spree_users"]
    da = default_address(cat)
    j = u.join(role, u["id"] == role["r_user_id"]).join(da, u["id"] == da["da_user_id"], "left")
    active = F.when(F.col("deleted_at").isNotNull(), F.lit(False)).otherwise(F.lit(True))
    return j.select(
        "id",
        "role_id",
        "email",
        "created_at",
        "updated_at",
        pg.flag("deleted_at").alias("is_deleted"),
        *_names(),
        pg.normalize_phone("mobile_phone_number", "mobile_number_country_code").alias("mobile_number"),
        "dob",
        pg.country_code("mobile_number_country_code").alias("country_code"),
        _country_id("da_country_id").alias("country_id"),
        F.lit("others").alias("gender"),
        F.lit("admin").alias("user_type"),
        F.lit("available").alias("availability"),
        "role_name",
        active.alias("active"),
        active.alias("status"),
        F.col("da_city").alias("city"),
        F.lit(1).cast("bigint").alias("rn"),
    )


def delivery_capacity(cat: Catalog) -> DataFrame:
    """D23 ``delivery_capacity``: each schedule once per supermarket of its zone (fans out;
    a schedule whose zone has no supermarket stays once with supermarket 0)."""
    dtss = prefixed(
        cat["danube_time_slots_schedules"], "dtss",
        ["id", "time_slot_id", "spree_shipping_method_id", "day_of_week", "zone_id", "delivery_capacity", "enabled",
         "created_at", "updated_at"],
    )
    dts = prefixed(cat["danube_time_slots"], "dts", ["id", "start_time", "end_time"])
    ds = prefixed(cat["danube_supermarkets"], "ds", ["id", "zone_id"])
    base = dtss.join(dts, F.col("dts_id") == F.col("dtss_time_slot_id"), "left").select(
        "dtss_zone_id",
        F.col("dtss_id").alias("id"),
        F.col("dts_start_time").cast("string").alias("start_time"),
        F.col("dts_end_time").cast("string").alias("end_time"),
        pg.weekday_name("dtss_day_of_week", "sunday").alias("day_of_week"),
        F.col("dtss_spree_shipping_method_id").alias("delivery_option_id"),
        F.coalesce(F.col("dtss_delivery_capacity"), F.lit(0)).alias("capacity"),
        F.col("dtss_enabled").alias("is_enabled"),
        F.col("dtss_created_at").alias("created_at"),
        F.col("dtss_updated_at").alias("updated_at"),
    )
    # A schedule's values are worked out once, and not for each of its supermarkets.
    j = left_join_fanout(base, ds, ["dtss_zone_id"], ["ds_zone_id"], both_hot=True)
    return j.select(
        "id", "start_time", "end_time", "day_of_week", "delivery_option_id",
        F.coalesce(F.col("ds_id"), F.lit(0)).alias("supermarket_id"),
        "capacity",
        pg.typed_null("bigint").alias("time_slot_id"),
        "is_enabled", "created_at", "updated_at",
    )
