"""Order-service extracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions import pg
from ...operators.joins import left_join_fanout, prefixed
from ...operators.rank import first_per_key
from ...operators.surrogate import surrogate_id
from ...sources.catalog import Catalog
from ._common import now

# Legacy order state -> shipment status.
SHIPMENT_STATUS = {
    "delivery": "delivered",
    "picking_and_staging_in_progress": "pending",
    "payment": "pending",
    "complete": "completed",
    "confirm": "pending",
    "canceled": "customer_cancelled",
}

# Legacy refund status -> refund status (anything else '').
REFUND_STATUS = {"uncertain": "pending", "failed": "failed", "success": "approved"}


def live_orders(cat: Catalog) -> DataFrame:
    """D5 ``order``: orders past the cart stage; a null state is not ``!= 'cart'`` and drops."""
    return cat["spree_orders"].filter(F.col("state") != "cart")


def cancellation_reason(cat: Catalog, with_ids: bool = True) -> DataFrame:
    """D4 ``order_cancellation_reason``: the latest fulfilment per distinct reason.

    Latest = ``created_at DESC`` with PostgreSQL's nulls-first, ties broken by fulfilment id.
    The legacy surrogate id is ``ROW_NUMBER() OVER ()`` (no order); ours numbers reasons in
    reason order, computed without funnelling rows through one task."""
    f = cat["spree_fulfilments"].filter(F.col("cancel_reason").isNotNull())
    latest = first_per_key(f, ["cancel_reason"], [pg.desc("created_at"), pg.asc("id")])
    rows = latest.select(
        F.col("cancel_reason").alias("reason_en"),
        F.lit("").alias("reason_ar"),
        F.lit(True).alias("visible"),
        "created_at",
        "updated_at",
    )
    if not with_ids:
        return rows
    return surrogate_id(rows, ["reason_en"]).select(
        "id", "reason_en", "reason_ar", "visible", "created_at", "updated_at"
    )


def _weighted(inc: Column, default_count: Column, max_per_order: Column) -> Column:
    return (inc > 0) & (default_count > 0) & (max_per_order > 0)


def live_lines(cat: Catalog) -> DataFrame:
    """Line items (``sli``) with their non-cart order (``so``)."""
    sli = cat["spree_line_items"].alias("sli")
    so = live_orders(cat).select("id", "state", "replace_product").alias("so")
    return sli.join(so, F.col("so.id") == F.col("sli.order_id"), "inner")


def order_product(cat: Catalog, as_of: Column | None = None) -> DataFrame:
    """D6 ``order_product``: line items of non-cart orders with the weighted-item rules.

    The ``WHERE so.state != 'cart'`` on the right side of the legacy LEFT JOIN makes it an
    inner join; variants stay a left join (a line without a variant is kept)."""
    sv = cat["spree_variants"].alias("sv")
    # Lines of carts go before the variants are looked up.
    sli = cat["spree_line_items"].alias("sli")
    j = live_lines(cat).join(sv, F.col("sv.id") == F.col("sli.variant_id"), "left")
    inc, req, qty, price = (F.col(c) for c in ("sv.weight_increment", "sli.requested_quantity", "sli.quantity", "sli.price"))
    t_inc, t_req = dict(sv.dtypes)["weight_increment"], dict(sli.dtypes)["requested_quantity"]
    weighted = _weighted(inc, F.col("sv.default_weight_count"), F.col("sv.max_weight_per_order"))
    quantity = F.when(
        weighted,
        F.when((req < inc) & (req > 0), pg.divide(inc, req, t_inc, t_req)).otherwise(pg.divide(req, inc, t_req, t_inc)),
    ).otherwise(req)
    on_sale = F.col("sli.on_sale")
    pref = F.col("so.replace_product").cast("string")
    return j.select(
        F.col("sli.id").alias("id"),
        F.col("sli.variant_id").alias("product_variant_id"),
        F.coalesce(quantity, F.lit(0)).alias("quantity"),
        F.when(weighted, qty).alias("picked_weight"),
        F.coalesce(F.when(weighted, F.lit(1)).otherwise(qty), F.lit(0)).alias("picked_quantity"),
        price.alias("price"),
        F.col("sli.created_at").alias("created_at"),
        F.col("sli.replaced").alias("replaced"),
        F.col("so.state").alias("state"),
        F.coalesce(F.col("sli.updated_at"), now(as_of)).alias("updated_at"),
        F.when(on_sale == F.lit(False), price).otherwise(F.lit(0)).alias("action_price"),
        F.when(on_sale == F.lit(True), price).otherwise(F.lit(0)).alias("sale_price"),
        F.lit(0).alias("picker_id"),
        F.col("sv.product_id").alias("product_id"),
        F.col("sli.order_id").alias("order_shipment_id"),
        pg.value_map(pref, {"true": "replace-with-similar-product", "false": "cancel"}).alias("replacement_pref"),
        F.lit(1).alias("category_id"),
        F.lit("").alias("status"),
    )


def order_payment(cat: Catalog, with_ids: bool = True) -> DataFrame:
    """D7 ``order_payment``: payments, with their order's currency, once per shipment of the
    order (fans out; a payment without shipments stays once).

    Shipments join on the *order's* id, so a payment whose order is missing gets none."""
    sp = prefixed(
        cat["spree_payments"], "sp",
        ["id", "order_id", "response_code", "amount", "state", "payment_method_id", "source_id", "source_type"],
    )
    so = prefixed(cat["spree_orders"], "so", ["id", "currency"])
    ss = prefixed(cat["spree_shipments"], "ss", ["id", "order_id"])
    base = sp.join(so, F.col("so_id") == F.col("sp_order_id"), "left")
    j = left_join_fanout(base, ss, ["so_id"], ["ss_order_id"])
    rows = j.select(
        F.col("sp_order_id").alias("order_id"),
        F.col("sp_response_code").alias("transaction_id"),
        F.col("sp_amount").alias("amount"),
        F.coalesce(F.col("so_currency"), F.lit("")).alias("currency"),
        F.col("sp_state").alias("status"),
        F.col("sp_payment_method_id").alias("payment_option_id"),
        F.col("sp_source_id").alias("source_id"),
        F.col("ss_id").alias("shipment_id"),
        pg.substring("sp_source_type", 8).alias("source_type"),
        F.col("sp_id").alias("_payment_id"),
    )
    cols = ["order_id", "transaction_id", "amount", "currency", "status", "payment_option_id", "source_id",
            "shipment_id", "source_type"]
    if not with_ids:
        return rows.select(*cols)
    return surrogate_id(rows, ["order_id", "shipment_id", "_payment_id"]).select("id", *cols)


def order_shipment(cat: Catalog) -> DataFrame:
    """D8 ``order_shipment``: one row per non-cart order with slot, schedule, lift date and
    express fee.

    The legacy query joins every slot, lift assignment and express-fee adjustment of an order
    and keeps an arbitrary row of that product. The product of independent per-order lists
    has, as its first row under a lexicographic order, the first of each list; so each list is
    cut to its first row per order *before* the joins (first slot by start, schedule, end;
    earliest delivery date; smallest fee). Nothing fans out and no order's lists meet in
    one task. Schedule ids are the schedules' primary key (a duplicate id would repeat the
    order's row; the suite's count path, distinct order ids, does not depend on it)."""
    so = live_orders(cat).alias("so")
    first_slot = first_per_key(
        cat["danube_slot_to_orders"],
        ["order_id"],
        [pg.asc("start_time"), pg.asc("time_slots_schedule_id"), pg.asc("end_time")],
    )
    dtss = cat["danube_time_slots_schedules"].select(
        F.col("id").alias("sched_id"), "day_of_week", "spree_shipping_method_id"
    )
    # The schedule joins the one slot of each order (narrow rows) before the orders do, so
    # every join with the orders is on the order id and the orders are shuffled once.
    slot = first_slot.join(dtss, F.col("sched_id") == F.col("time_slots_schedule_id"), "left").alias("dsto")
    lift = first_per_key(cat["spree_lift_assignments"], ["order_id"], [pg.asc("delivery_date")]).alias("sla")
    fee = first_per_key(
        cat["spree_adjustments"].filter(F.col("label") == "Express Fee"), ["order_id"], [pg.asc("amount")]
    ).alias("sa")
    j = (
        so.join(slot, F.col("dsto.order_id") == F.col("so.id"), "left")
        .join(lift, F.col("sla.order_id") == F.col("so.id"), "left")
        .join(fee, F.col("sa.order_id") == F.col("so.id"), "left")
    )
    return j.select(
        F.col("so.id").alias("id"),
        F.col("so.id").alias("order_id"),
        pg.value_map("so.state", SHIPMENT_STATUS).alias("order_status"),
        F.col("so.created_at").alias("created_at"),
        F.col("so.updated_at").alias("updated_at"),
        (F.col("so.total") * pg.divide("so.vat_percentage", F.lit(100), dict(so.dtypes)["vat_percentage"], "int"))
        .cast("double").alias("tax_total"),
        F.col("so.total").alias("total"),
        F.col("dsto.start_time").cast("string").alias("start_time"),
        F.col("dsto.end_time").cast("string").alias("end_time"),
        pg.weekday_name("dsto.day_of_week", "sunday").alias("day_of_week"),
        F.col("dsto.spree_shipping_method_id").alias("delivery_option_id"),
        F.col("so.order_type").alias("order_type"),
        F.col("so.supermarket_id").alias("supermarket_id"),
        F.col("sla.delivery_date").alias("delivery_date"),
        F.col("sa.amount").alias("delivery_charges"),
        F.lit(False).alias("is_delivery_on_hold"),
        F.col("so.created_at").alias("processing_start_at"),
        F.lit(1).cast("bigint").alias("row_num"),
    )


def address_ends(cat: Catalog) -> DataFrame:
    """Each non-cart order twice: with its bill address and with its ship address."""
    return live_orders(cat).select(
        "id", "special_instructions", "created_at", "updated_at",
        F.explode(
            F.array(
                F.struct(F.col("bill_address_id").alias("address_id"), F.lit("true").alias("is_bill_address")),
                F.struct(F.col("ship_address_id").alias("address_id"), F.lit("false").alias("is_bill_address")),
            )
        ).alias("end"),
    ).select("*", "end.address_id", "end.is_bill_address").drop("end")


def places(cat: Catalog) -> DataFrame:
    """Addresses with the names of their country and district, at the grain of the address (and
    of its district's English translations)."""
    sa = cat["spree_addresses"].alias("sa")
    con = cat["spree_countries"].alias("con")
    dist = cat["spree_districts"].alias("dist")
    sdt = cat["spree_district_translations"].filter(F.col("locale") == "en").alias("sdt")
    area = dist.join(sdt, F.col("sdt.spree_district_id") == F.col("dist.id"), "left").select(
        F.col("dist.id").alias("area_id"), F.col("sdt.name").alias("district")
    )
    return (
        sa.join(con, F.col("con.id") == F.col("sa.country_id"), "left")
        .join(area, F.col("area_id") == F.col("sa.district_id"), "left")
        .select(
            F.col("sa.id").alias("place_id"),
            F.col("sa.city").alias("city"),
            F.col("con.name").alias("country"),
            "district",
            F.col("sa.address1").alias("address1"),
            F.col("sa.address2").alias("address2"),
            F.col("sa.latitude").alias("latitude"),
            F.col("sa.longitude").alias("longitude"),
            F.col("sa.zipcode").alias("zipcode"),
        )
    )


def order_address(cat: Catalog) -> DataFrame:
    """D9 ``order_address``: the bill and the ship address of every non-cart order.

    The legacy UNION ALL of two near-identical branches reads orders once here. Country and
    district are joined to the addresses, at their grain, so the doubled orders go through a
    single join."""
    so = address_ends(cat).alias("so")
    place = places(cat)
    j = so.join(place, F.col("place_id") == F.col("so.address_id"), "left")
    return j.select(
        F.col("so.id").alias("order_id"),
        F.col("so.address_id").alias("address_id"),
        F.col("so.is_bill_address").alias("is_bill_address"),
        F.coalesce(F.col("city"), F.lit("")).alias("city"),
        F.coalesce(F.col("country"), F.lit("")).alias("country"),
        F.col("district"),
        F.lit("other").alias("type"),
        pg.concat(F.col("address1"), " ", F.col("address2")).alias("formatted_address"),
        F.coalesce(F.col("latitude"), F.lit(0.0)).alias("latitude"),
        F.coalesce(F.col("longitude"), F.lit(0.0)).alias("longitude"),
        pg.digits_or_null("zipcode", "int").alias("postal_code"),
        F.col("so.special_instructions").alias("delivery_instruction"),
        F.col("so.created_at").alias("created_at"),
        F.col("so.updated_at").alias("updated_at"),
    )


def payment_refund(cat: Catalog) -> DataFrame:
    """D10 ``order_payment_refund``: refunds of existing payments."""
    sr = cat["spree_refunds"].filter(F.col("payment_id").isNotNull()).alias("sr")
    sp = cat["spree_payments"].select("id", "order_id", "response_code").alias("sp")
    j = sr.join(sp, F.col("sp.id") == F.col("sr.payment_id"), "inner")
    return j.select(
        F.col("sr.id").alias("id"),
        F.col("sp.order_id").alias("order_id"),
        F.coalesce(F.col("sr.transaction_id"), F.col("sp.response_code")).alias("transaction_id"),
        F.col("sr.created_at").alias("created_at"),
        F.col("sr.updated_at").alias("updated_at"),
        F.col("sr.amount").alias("amount"),
        pg.value_map("sr.status", REFUND_STATUS, "").alias("status"),
        F.lit("SAR").alias("currency"),
        F.lit("").alias("type"),
    )
