"""The four migration suites: 65 specs (3 auth, 18 order, 17 user, 27 product).

Labels are data and are kept as written in the legacy checks, including the ones that do not
name the table the extract reads (``spree_payment_methods`` for payments,
``spree_addresses`` for cities, ``danube_time_slot_schedules``, ``cashbacks`` vs the
``cashback`` table). Destination tables whose names are reserved words are read
schema-qualified (``public.user``, ``public.order``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.counts import left_join_count, row_count
from ..sources.catalog import Catalog
from .extracts import auth, order, product, user
from .spec import Const, Extract, ReconSpec, Scan, Side

AUTH, ORDER, USER, PRODUCT = "auth", "order", "user", "product"


def _x(rows: Callable[[Catalog], DataFrame], count: Callable[[Catalog], DataFrame] | None = None) -> Extract:
    return Extract(rows, count)


def _d1_count(cat: Catalog) -> DataFrame:
    # users LEFT JOIN authentications, counted per user without building the fan-out.
    return left_join_count(cat["spree_users"], cat["spree_user_authentications"], ["id"], ["user_id"])


def _d7_count(cat: Catalog) -> DataFrame:
    # Payments with their order (a key lookup), then once per shipment of that order.
    sp = cat["spree_payments"].select("order_id")
    so = cat["spree_orders"].select(F.col("id").alias("so_id"))
    base = sp.join(so, F.col("so_id") == F.col("order_id"), "left")
    return left_join_count(base, cat["spree_shipments"], ["so_id"], ["order_id"])


def _d6_count(cat: Catalog) -> DataFrame:
    lines = order.live_lines(cat).select(F.col("sli.variant_id").alias("variant_id"))
    return left_join_count(lines, cat["spree_variants"], ["variant_id"], ["id"])


def _d9_count(cat: Catalog) -> DataFrame:
    # Order ends per address times rows per address: no wide row is built.
    return left_join_count(order.address_ends(cat), order.places(cat), ["address_id"], ["place_id"])


def _d23_count(cat: Catalog) -> DataFrame:
    # Schedules once per supermarket of their zone; the slot join is a key lookup.
    return left_join_count(cat["danube_time_slots_schedules"], cat["danube_supermarkets"], ["zone_id"], ["zone_id"])


# Rank-1 extracts keep exactly one row per distinct partition key (left joins never remove
# a key), so their count is a distinct count: one aggregation, combined map-side, no joins
# and no window.


def _distinct_count(df: DataFrame, *keys: str) -> DataFrame:
    return row_count(df.select(*keys).distinct())


def _d2_count(cat: Catalog) -> DataFrame:
    return _distinct_count(cat["spree_user_clients"], "user_id")


def _d4_count(cat: Catalog) -> DataFrame:
    return _distinct_count(cat["spree_fulfilments"].filter(F.col("cancel_reason").isNotNull()), "cancel_reason")


def _d8_count(cat: Catalog) -> DataFrame:
    return _distinct_count(order.live_orders(cat), "id")


def _d15_count(cat: Catalog) -> DataFrame:
    return _distinct_count(cat["spree_users"], "id")


def _d22_count(cat: Catalog) -> DataFrame:
    sr = cat["spree_roles"].filter(F.col("name") != "user").select(F.col("id").alias("sr_id"))
    holders = cat["spree_roles_users"].join(sr, F.col("role_id") == F.col("sr_id"), "left_semi").select(
        F.col("user_id").alias("h_id")
    )
    u = cat["spree_users"]
    return _distinct_count(u.join(holders, u["id"] == holders["h_id"], "left_semi"), "id")


def _specs(suite: str, rows: list[tuple[str, Side, str, Side]]) -> list[ReconSpec]:
    return [ReconSpec(suite, i + 1, src_label, dst_label, src, dst) for i, (src_label, src, dst_label, dst) in enumerate(rows)]


def _t(source_table: str, dest_table: str, dest_name: str | None = None) -> tuple[str, Side, str, Side]:
    return (source_table, Scan(source_table), dest_table, Scan(dest_name or dest_table))


def auth_suite(as_of: Column | None = None) -> list[ReconSpec]:
    return _specs(AUTH, [
        ("spree_users", _x(lambda c: auth.auth_user(c, as_of), _d1_count), "user", Scan("public.user")),
        ("spree_user_clients", _x(auth.device_token, _d2_count), "device_token", Scan("device_token")),
        ("spree_users", _x(lambda c: auth.auth_employee(c, as_of)), "employee", Scan("employee")),
    ])


def order_suite(as_of: Column | None = None) -> list[ReconSpec]:
    return _specs(ORDER, [
        ("spree_fulfilments", _x(lambda c: order.cancellation_reason(c, with_ids=False), _d4_count),
         "order_cancellation_reason",
         Scan("order_cancellation_reason")),
        ("spree_orders", Scan("spree_orders", "state != 'cart'"), "order", Scan("public.order")),
        ("spree_line_items", _x(lambda c: order.order_product(c, as_of), _d6_count), "order_product", Scan("order_product")),
        ("spree_payment_methods", _x(lambda c: order.order_payment(c, with_ids=False), _d7_count), "order_payment",
         Scan("order_payment")),
        ("spree_shipments", _x(order.order_shipment, _d8_count), "order_shipment", Scan("order_shipment")),
        ("spree_orders/spree_addresses", _x(order.order_address, _d9_count), "order_address", Scan("order_address")),
        _t("spree_cashbacks", "cashbacks", "cashback"),
        _t("spree_adjustments", "order_adjustment"),
        _t("spree_invoice_logs", "order_invoice_logs"),
        _t("spree_invoices", "order_invoices"),
        ("spree_refunds", _x(order.payment_refund), "order_payment_refund", Scan("order_payment_refund")),
        _t("spree_orders_promotions", "order_promotions"),
        _t("spree_store_credits", "store_credit"),
        _t("spree_store_credit_categories", "store_credit_category"),
        _t("spree_store_credit_events", "store_credit_transaction"),
        _t("spree_store_credit_types", "store_credit_type"),
        _t("spree_store_credit_update_reasons", "store_credit_update_reason"),
        _t("spree_user_gift_cards", "user_gift_cards"),
    ])


def user_suite() -> list[ReconSpec]:
    return _specs(USER, [
        ("spree_addresses", _x(user.city), "city", Scan("city")),
        ("spree_payment_methods", _x(user.payment_option), "payment_option", Scan("payment_option")),
        ("danube_time_slot_schedules", _x(user.time_slot), "time_slot", Scan("time_slot")),
        ("spree_shipping_methods", _x(user.delivery_option), "delivery_option", Scan("delivery_option")),
        _t("spree_countries", "country"),
        ("spree_users", _x(user.user, _d15_count), "user", Scan("public.user")),
        ("spree_user_addresses", _x(user.user_address), "address", Scan("address")),
        ("spree_credit_cards", _x(user.checkout_cards), "checkout_cards", Scan("checkout_cards")),
        _t("danube_supermarkets", "super_market"),
        ("danube_supermarkets", _x(user.supermarket_payment), "super_market_payment", Scan("super_market_payment")),
        ("danube_supermarkets", _x(user.supermarket_delivery_type), "supermarket_delivery_type",
         Scan("supermarket_delivery_type")),
        ("NA", Const(2), "delivery_type", Scan("delivery_type")),
        ("danube_supermarkets", _x(user.supermarket_delivery_option), "supermarket_delivery_option",
         Scan("supermarket_delivery_option")),
        _t("spree_feedback_reviews", "feedback"),
        _t("spree_loyalty_members", "loyalty_member"),
        ("spree_users", _x(user.employee, _d22_count), "employee", Scan("employee")),
        ("danube_time_slots_schedules", _x(user.delivery_capacity, _d23_count), "delivery_capacity",
         Scan("delivery_capacity")),
    ])


def product_suite() -> list[ReconSpec]:
    return _specs(PRODUCT, [
        _t("spree_bin_categories", "bin_category"),
        _t("spree_kitchen_recipes", "recipe"),
        ("spree_custom_products", _x(product.offline_product_barcode), "offline_product_barcode",
         Scan("offline_product_barcode")),
        _t("spree_product_inventory_modifiers", "inventory_modifiers"),
        _t("spree_custom_products", "offline_product"),
        _t("spree_bundle_products", "bundle_products"),
        _t("spree_kitchen_cuisines", "cuisine"),
        _t("spree_kitchen_ingredients", "ingredient"),
        _t("spree_ingredient_products", "ingredient_product"),
        _t("spree_nutritional_facts", "nutritional_facts"),
        _t("spree_option_types", "option_type"),
        _t("spree_option_values", "option_value"),
        _t("spree_products", "product"),
        _t("spree_product_barcodes", "product_barcode"),
        ("spree_assets", Scan("spree_assets", f"viewable_type = '{product.VARIANT_ASSET}'"), "product_image",
         Scan("product_image")),
        ("spree_products_taxons", _x(product.product_taxon), "product_taxon", Scan("product_taxon")),
        ("spree_promotions", _x(product.promotion), "promotion", Scan("promotion")),
        _t("spree_product_price_versions", "product_price_versions"),
        _t("spree_taxons", "taxon"),
        _t("spree_tenants_taxons", "taxon_country"),
        _t("spree_taxon_groups", "taxon_group"),
        _t("spree_taxon_group_memberships", "taxon_group_membership"),
        _t("spree_taxonomies", "taxonomies"),
        ("spree_taxons", _x(lambda c: product.brand(c, with_ids=False)), "brand", Scan("brand")),
        ("spree_product_translations", _x(product.supplier), "supplier", Scan("supplier")),
        _t("spree_wishlists", "shopping_list"),
        ("spree_wished_products", _x(product.shopping_list_products), "shopping_list_products",
         Scan("shopping_list_products")),
    ])


def all_suites(as_of: Column | None = None) -> dict[str, list[ReconSpec]]:
    return {
        AUTH: auth_suite(as_of),
        ORDER: order_suite(as_of),
        USER: user_suite(),
        PRODUCT: product_suite(),
    }
