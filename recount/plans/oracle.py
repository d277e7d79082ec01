"""Expected results of the extracts, as DuckDB SQL written from the rules in words.

Structure: facts are prepared in named steps (WITH), lookups are value tables, lists are cut with
QUALIFY, translations are pivoted with filtered aggregates, and two-branch rules read their table
once. Lookup values are spelled out here, independently of the library's own maps.
"""

from __future__ import annotations

# Fixed values, spelled out a second time on purpose: a wrong map in the library must not pass.
WEEKDAY = "(VALUES (0, 'sunday'), (1, 'monday'), (2, 'tuesday'), (3, 'wednesday'), (4, 'thursday'), (5, 'friday'), (6, 'saturday')) AS weekday(no, label)"
REFUND = "(VALUES ('uncertain', 'pending'), ('failed', 'failed'), ('success', 'approved')) AS refund(raw, label)"
ORDER_STATE = (
    "(VALUES ('delivery', 'delivered'), ('picking_and_staging_in_progress', 'pending'), ('payment', 'pending'), "
    "('complete', 'completed'), ('confirm', 'pending'), ('canceled', 'customer_cancelled')) AS state(raw, label)"
)
OPTION_CODE = """(VALUES
    ('Spree::PaymentMethod::StoreCredit', 'e-wlt'),
    ('Spree::Gateway::PayFort', 'credit'),
    ('Spree::Gateway::CheckoutCom', 'credit'),
    ('Spree::Gateway::Tamara', 'tamara'),
    ('Spree::Gateway::BogusSimple', 'bogus-simple'),
    ('Spree::PaymentMethod::Check', 'cod'),
    ('Spree::Gateway::CheckoutCom::ApplePay', 'a-pay'),
    ('Spree::Gateway::LoyaltyPoint', 'loy-pts'),
    ('Spree::Gateway::PayFort::ApplePay', 'a-pay')) AS option_code(class, label)"""

# A phone number without its country prefix: how many leading characters to drop. Without a
# prefix the number is lost, and the country code is the bare sign.
PHONES = """
phones AS (
  SELECT id AS person, concat('+', dial) AS country_code,
         substr(ifnull(substr(number, 1 + CASE WHEN starts_with(number, '+' || dial) THEN 1 + length(dial)
                                               WHEN starts_with(number, dial) THEN length(dial)
                                               WHEN dial IS NOT NULL THEN 0 END), ''), 1, 16) AS mobile_number
  FROM (SELECT id, mobile_phone_number AS number, mobile_number_country_code AS dial FROM spree_users)
)"""

# The default address of a person, at the grain of the link table.
HOMES = """
homes AS (
  SELECT link.user_id AS person, link.id AS link, city, latitude, longitude,
         if(country_id = 0, 1, country_id) AS country_id
  FROM spree_user_addresses AS link LEFT JOIN spree_addresses AS place ON place.id = link.address_id
  WHERE link.is_default
)"""

SQL: dict[str, str] = {
    "orders_not_cart": "FROM spree_orders WHERE state <> 'cart'",
    "enabled_slots": "FROM danube_time_slots_schedules WHERE enabled",
    "assets_variant": "FROM spree_assets WHERE viewable_type = 'Spree::Variant'",
}


def auth_users(as_of: str) -> str:
    return f"""
WITH logins AS (
  SELECT user_id AS person, if(provider = 'google_oauth2', 'google', provider) AS login_type, uid
  FROM spree_user_authentications
),
with_login AS (
  SELECT person, login_type, uid AS social_id FROM logins WHERE person IN (SELECT id FROM spree_users)
  UNION ALL BY NAME
  SELECT id AS person FROM spree_users WHERE id IS NULL OR id NOT IN (SELECT person FROM logins WHERE person IS NOT NULL)
)
SELECT person AS user_id, encrypted_password AS password, password_salt, email, created_at, updated_at,
       (deleted_at IS NOT NULL) AS is_deleted, {as_of} AS password_updated_at, FALSE AS is_email_verified,
       is_phone_verified AS mobile_verified, login_type, social_id, ifnull(spree_api_key, '') AS spree_api_key,
       (blacklisted_at IS NOT NULL) AS blacklisted
FROM with_login JOIN spree_users ON spree_users.id IS NOT DISTINCT FROM person"""


def auth_employees(as_of: str) -> str:
    return f"""
WITH staff AS (SELECT id FROM spree_roles WHERE name <> 'user' AND id <> 2)
SELECT id, id AS "user", encrypted_password AS password, password_salt, email, created_at, updated_at,
       (deleted_at IS NOT NULL) AS is_deleted, {as_of} AS password_updated_at
FROM spree_users
WHERE id IN (SELECT user_id FROM spree_roles_users SEMI JOIN staff ON staff.id = role_id)"""


SQL["device_tokens"] = """
SELECT user_id, uuid AS device_id, platform AS device_type, created_at, updated_at, push_notification_token AS token, 'customer' AS user_type
FROM spree_user_clients
QUALIFY 1 = row_number() OVER (PARTITION BY user_id ORDER BY uuid NULLS LAST, platform NULLS LAST, created_at NULLS LAST,
                               updated_at NULLS LAST, push_notification_token NULLS LAST)"""

SQL["cancel_reasons"] = """
WITH newest AS (
  SELECT cancel_reason, created_at, updated_at FROM spree_fulfilments WHERE cancel_reason IS NOT NULL
  QUALIFY 1 = row_number() OVER (PARTITION BY cancel_reason ORDER BY created_at DESC NULLS FIRST, id)
)
SELECT (SELECT count(*) FROM newest AS earlier WHERE earlier.cancel_reason <= newest.cancel_reason) AS id,
       cancel_reason AS reason_en, '' AS reason_ar, TRUE AS visible, created_at, updated_at
FROM newest"""


def order_products(as_of: str) -> str:
    return f"""
WITH kinds AS (
  SELECT id AS variant, product_id, weight_increment AS step,
         ifnull(least(weight_increment, default_weight_count, max_weight_per_order) > 0
                AND weight_increment IS NOT NULL AND default_weight_count IS NOT NULL AND max_weight_per_order IS NOT NULL, FALSE) AS by_weight
  FROM spree_variants
),
live AS (SELECT id AS live_order, state, replace_product FROM spree_orders WHERE state <> 'cart'),
lines AS (
  SELECT line.*, live.state AS order_state, live.replace_product, kinds.product_id, kinds.step, ifnull(kinds.by_weight, FALSE) AS by_weight
  FROM live JOIN spree_line_items AS line ON line.order_id = live_order LEFT JOIN kinds ON kinds.variant = line.variant_id
)
SELECT id, variant_id AS product_variant_id,
       ifnull(CASE WHEN NOT by_weight THEN requested_quantity
                   WHEN requested_quantity > 0 AND requested_quantity < step THEN step / requested_quantity
                   ELSE requested_quantity / step END, 0) AS quantity,
       if(by_weight, quantity, NULL) AS picked_weight, if(by_weight, 1, ifnull(quantity, 0)) AS picked_quantity,
       price, created_at, replaced, order_state AS state, ifnull(updated_at, {as_of}) AS updated_at,
       if(on_sale IS FALSE, price, 0) AS action_price, if(on_sale IS TRUE, price, 0) AS sale_price, 0 AS picker_id, product_id,
       order_id AS order_shipment_id,
       if(replace_product IS NULL, NULL, if(replace_product, 'replace-with-similar-product', 'cancel')) AS replacement_pref,
       1 AS category_id, '' AS status
FROM lines"""


def _payments(number: str) -> str:
    return f"""
WITH parcels AS (SELECT order_id AS parcel_order, list(id) AS ids FROM spree_shipments GROUP BY order_id),
paid AS (
  SELECT pay.*, spree_orders.currency AS order_currency, unnest(ifnull(parcels.ids, [NULL])) AS shipment
  FROM spree_payments AS pay LEFT JOIN spree_orders ON spree_orders.id = pay.order_id LEFT JOIN parcels ON parcel_order = spree_orders.id
)
SELECT {number}order_id, response_code AS transaction_id, amount, ifnull(order_currency, '') AS currency, state AS status,
       payment_method_id AS payment_option_id, source_id, shipment AS shipment_id, source_type[8:] AS source_type
FROM paid"""


SQL["order_payments"] = _payments("")
SQL["payment_surrogate"] = _payments(
    "row_number() OVER (ORDER BY order_id NULLS LAST, shipment NULLS LAST, id NULLS LAST) AS id, "
)

SQL["order_shipments"] = f"""
WITH slots AS (
  SELECT order_id, start_time, end_time, time_slots_schedule_id AS schedule FROM danube_slot_to_orders
  QUALIFY 1 = row_number() OVER (PARTITION BY order_id ORDER BY start_time NULLS LAST, time_slots_schedule_id NULLS LAST, end_time NULLS LAST)
),
days AS (
  SELECT plan.id AS schedule, ifnull(weekday.label, 'sunday') AS day_of_week, spree_shipping_method_id
  FROM danube_time_slots_schedules AS plan LEFT JOIN {WEEKDAY} ON weekday.no = plan.day_of_week
),
lifts AS (SELECT order_id, min(delivery_date) AS delivery_date FROM spree_lift_assignments GROUP BY order_id),
fees AS (SELECT order_id, min(amount) AS delivery_charges FROM spree_adjustments WHERE label = 'Express Fee' GROUP BY order_id)
SELECT o.id, o.id AS order_id, state.label AS order_status, o.created_at, o.updated_at,
       CAST(o.vat_percentage / 100 * o.total AS DOUBLE) AS tax_total, o.total, CAST(slots.start_time AS VARCHAR) AS start_time,
       CAST(slots.end_time AS VARCHAR) AS end_time, ifnull(days.day_of_week, 'sunday') AS day_of_week,
       days.spree_shipping_method_id AS delivery_option_id, o.order_type, o.supermarket_id, lifts.delivery_date, fees.delivery_charges,
       FALSE AS is_delivery_on_hold, o.created_at AS processing_start_at, 1 AS row_num
FROM (FROM spree_orders WHERE state <> 'cart') AS o
LEFT JOIN {ORDER_STATE} ON state.raw = o.state
LEFT JOIN slots ON slots.order_id = o.id LEFT JOIN days USING (schedule)
LEFT JOIN lifts ON lifts.order_id = o.id LEFT JOIN fees ON fees.order_id = o.id"""

SQL["order_addresses"] = """
WITH areas AS (
  SELECT d.id AS area, t.name AS district
  FROM spree_districts AS d LEFT JOIN (FROM spree_district_translations WHERE locale = 'en') AS t ON t.spree_district_id = d.id
),
places AS (
  SELECT a.id AS place, ifnull(a.city, '') AS city, ifnull(c.name, '') AS country, areas.district,
         concat_ws('', a.address1, ' ', a.address2) AS formatted_address, ifnull(a.latitude, 0) AS latitude, ifnull(a.longitude, 0) AS longitude,
         if(regexp_full_match(a.zipcode, '[0-9]+'), TRY_CAST(a.zipcode AS INTEGER), NULL) AS postal_code
  FROM spree_addresses AS a LEFT JOIN spree_countries AS c ON c.id = a.country_id LEFT JOIN areas ON areas.area = a.district_id
),
ends AS (
  SELECT id AS order_id, unnest([bill_address_id, ship_address_id]) AS address_id, unnest(['true', 'false']) AS is_bill_address,
         special_instructions, created_at, updated_at
  FROM spree_orders WHERE state <> 'cart'
)
SELECT order_id, address_id, is_bill_address, ifnull(city, '') AS city, ifnull(country, '') AS country, district, 'other' AS type,
       ifnull(formatted_address, ' ') AS formatted_address, ifnull(latitude, 0) AS latitude, ifnull(longitude, 0) AS longitude,
       postal_code, special_instructions AS delivery_instruction, created_at, updated_at
FROM ends LEFT JOIN places ON place = address_id"""

SQL["payment_refunds"] = f"""
SELECT back.id, paid.order_id, ifnull(back.transaction_id, paid.response_code) AS transaction_id, back.created_at, back.updated_at,
       back.amount, ifnull(refund.label, '') AS status, 'SAR' AS currency, '' AS type
FROM spree_payments AS paid, spree_refunds AS back LEFT JOIN {REFUND} ON refund.raw = back.status
WHERE paid.id = back.payment_id"""

SQL["cities"] = """
WITH named AS (SELECT spree_state_id AS state, lower(name) AS name FROM spree_state_translations WHERE locale = 'en')
SELECT name, country_id, created_at, updated_at, TRUE AS is_visible, id AS state_id
FROM spree_states JOIN named ON named.state = spree_states.id
WHERE id IN (SELECT state_id FROM danube_supermarkets)
GROUP BY ALL"""

SQL["payment_options"] = f"""
WITH english AS (SELECT spree_payment_method_id AS method, name FROM spree_payment_method_translations WHERE locale = 'en')
SELECT m.id, english.name, m.created_at, m.updated_at, m.deleted_at, ifnull(option_code.label, '') AS code
FROM spree_payment_methods AS m JOIN english ON english.method = m.id LEFT JOIN {OPTION_CODE} ON option_code.class = m.type"""

SQL["time_slots"] = f"""
WITH open_slots AS (SELECT id AS slot, start_time, end_time FROM danube_time_slots WHERE enabled),
plans AS (SELECT DISTINCT time_slot_id AS slot, spree_shipping_method_id AS method, day_of_week AS no FROM danube_time_slots_schedules),
offers AS (SELECT DISTINCT slot, method, no, start_time, end_time FROM plans JOIN open_slots USING (slot))
SELECT method AS delivery_option_id, ifnull(weekday.label, '') AS day_of_week, CAST(start_time AS VARCHAR) AS start_time,
       CAST(end_time AS VARCHAR) AS end_time, TRUE AS enabled, 1 AS country_id
FROM offers LEFT JOIN {WEEKDAY} USING (no)"""

SQL["delivery_options"] = """
WITH english AS (SELECT spree_shipping_method_id AS id, name FROM spree_shipping_method_translations WHERE locale = 'en')
SELECT id, name, created_at, updated_at, deleted_at
FROM english RIGHT JOIN (SELECT id, created_at, updated_at, deleted_at FROM spree_shipping_methods) AS methods USING (id)"""

SQL["users"] = f"""
WITH {PHONES.strip()}, {HOMES.strip()},
first_home AS (FROM homes QUALIFY 1 = row_number() OVER (PARTITION BY person ORDER BY link NULLS LAST)),
last_login AS (
  SELECT user_id AS person, if(provider = 'google_oauth2', 'google', provider) AS login_type, uid AS social_id
  FROM spree_user_authentications
  QUALIFY 1 = row_number() OVER (PARTITION BY user_id ORDER BY updated_at DESC NULLS FIRST, id NULLS LAST)
)
SELECT p.id, (p.deleted_at IS NOT NULL) AS is_deleted, p.created_at, p.updated_at, substr(ifnull(p.first_name, ''), 1, 40) AS first_name,
       substr(ifnull(p.last_name, ''), 1, 40) AS last_name, p.email, 'others' AS gender, phones.country_code, phones.mobile_number,
       CAST(p.dob AS VARCHAR) AS dob, ifnull(p.referral_code, '') AS referral_code, 2 - CAST(p.locale IS NOT DISTINCT FROM 'en' AS INTEGER) AS language_id,
       first_home.city, first_home.latitude, first_home.longitude, first_home.country_id, TRUE AS receive_marketing_promotions,
       last_login.login_type, last_login.social_id, 0 AS balance, p.blacklisted_at, p.blacklisted_reason
FROM spree_users AS p JOIN phones ON phones.person = p.id
LEFT JOIN first_home ON first_home.person = p.id LEFT JOIN last_login ON last_login.person = p.id"""

SQL["user_addresses"] = """
WITH state_names AS (
  SELECT id AS state_id, min(name) FILTER (locale = 'en') AS en, min(name) FILTER (locale = 'ar') AS ar FROM spree_state_translations GROUP BY id
),
area_names AS (
  SELECT spree_district_id AS district_id, min(name) FILTER (locale = 'en') AS en, min(name) FILTER (locale = 'ar') AS ar
  FROM spree_district_translations SEMI JOIN spree_districts ON spree_districts.id = spree_district_id GROUP BY spree_district_id
),
places AS (
  SELECT a.id AS place, coalesce(concat(CASE WHEN address2 IS NULL THEN address1 || ' ' END, CASE WHEN address1 IS NULL THEN address2 || ', ' END,
                                        address1 || ' ' || address2 || ', '), '') AS formatted_address,
         coalesce(s.en, s.ar, '') AS city, ifnull(c.name, 'Saudi Arabia') AS country,
         TRY_CAST(array_to_string(regexp_extract_all(zipcode, '[0-9]+'), '') AS BIGINT) AS postal_code, coalesce(t.en, t.ar) AS district,
         ifnull(latitude, 0) AS latitude, ifnull(longitude, 0) AS longitude,
         ifnull(driver_meta_data ->> '$.verified', 'false') AS is_verified, driver_meta_data ->> '$.notes' AS comments
  FROM spree_addresses AS a LEFT JOIN spree_countries AS c ON c.id = a.country_id
  LEFT JOIN state_names AS s USING (state_id) LEFT JOIN area_names AS t USING (district_id)
  WHERE a.city IS NOT NULL
)
SELECT link.id, formatted_address, city, country, postal_code, link.created_at, link.updated_at, district, latitude, longitude,
       ifnull(link.is_default, FALSE) AS is_default, link.user_id, 'other' AS type, is_verified, '' AS title, comments
FROM spree_user_addresses AS link JOIN places ON place = link.address_id
GROUP BY ALL"""

SQL["checkout_cards"] = """
SELECT id, user_id, ifnull(name, '') AS name_on_card, ifnull(cc_type, '') AS scheme, ['', 'mada'][1 + CAST(ifnull(cc_type = 'MADA', FALSE) AS INTEGER)] AS scheme_local,
       ifnull(gateway_payment_profile_id, '') AS instrument_id, last_digits, month, year, updated_at, created_at, 'CREDIT' AS card_type
FROM spree_credit_cards
WHERE NOT (gateway_customer_profile_id IS NULL OR user_id IS NULL)"""

# A section runs from its marker's last place to the other marker, or to the end.
SQL["payment_ids"] = """
WITH sections AS (
  SELECT id, option, split_part(string_split(payment_options, marker || ':')[-1], other || ':', 1) AS body
  FROM danube_supermarkets, (VALUES ('1', 'home_delivery', 'store_pick_up'), ('2', 'store_pick_up', 'home_delivery')) AS kinds(option, marker, other)
  WHERE contains(payment_options, marker)
)
SELECT id AS super_market_id, TRY_CAST(unnest(regexp_extract_all(replace(body, chr(10), ''), '[0-9]+')) AS INTEGER) AS payment_id, option AS delivery_option_id
FROM sections"""

SQL["delivery_type_all"] = """
SELECT id AS supermarket_id, kind AS delivery_type_id
FROM danube_supermarkets JOIN (VALUES ('regular', 1), ('regular_and_express', 1), ('regular_and_express', 2), ('express', 2)) AS kinds(name, kind)
  ON kinds.name = supermarket_type"""

SQL["delivery_type"] = f"SELECT DISTINCT supermarket_id, delivery_type_id FROM ({SQL['delivery_type_all']}) AS every"

SQL["delivery_option"] = """
SELECT DISTINCT id AS supermarket_id, option AS delivery_option_id
FROM danube_supermarkets JOIN (VALUES ('home_delivery', 1), ('store_pick_up', 2)) AS kinds(marker, option) ON contains(payment_options, marker)"""

SQL["employees"] = f"""
WITH {PHONES.strip()}, {HOMES.strip()},
jobs AS (
  SELECT held.user_id AS person, held.role_id, role.name AS role_name
  FROM spree_roles_users AS held JOIN spree_roles AS role ON role.id = held.role_id
  WHERE role.name <> 'user'
  QUALIFY 1 = row_number() OVER (PARTITION BY held.user_id ORDER BY role.name, held.role_id)
),
first_home AS (FROM homes QUALIFY 1 = row_number() OVER (PARTITION BY person ORDER BY link NULLS LAST))
SELECT p.id, jobs.role_id, p.email, p.created_at, p.updated_at, (p.deleted_at IS NOT NULL) AS is_deleted,
       substr(ifnull(p.first_name, ''), 1, 40) AS first_name, substr(ifnull(p.last_name, ''), 1, 40) AS last_name, phones.mobile_number, p.dob,
       phones.country_code, first_home.country_id, 'others' AS gender, 'admin' AS user_type, 'available' AS availability, jobs.role_name,
       (p.deleted_at IS NULL) AS active, (p.deleted_at IS NULL) AS status, first_home.city, 1 AS rn
FROM jobs JOIN spree_users AS p ON p.id = jobs.person JOIN phones ON phones.person = p.id LEFT JOIN first_home ON first_home.person = p.id"""

SQL["delivery_capacity"] = f"""
WITH stores AS (SELECT zone_id, list(id) AS ids FROM danube_supermarkets GROUP BY zone_id)
SELECT plan.id, CAST(slot.start_time AS VARCHAR) AS start_time, CAST(slot.end_time AS VARCHAR) AS end_time,
       ifnull(weekday.label, 'sunday') AS day_of_week, plan.spree_shipping_method_id AS delivery_option_id,
       unnest(ifnull(list_transform(stores.ids, lambda s: ifnull(s, 0)), [0])) AS supermarket_id, ifnull(plan.delivery_capacity, 0) AS capacity,
       CAST(NULL AS BIGINT) AS time_slot_id, plan.enabled AS is_enabled, plan.created_at, plan.updated_at
FROM danube_time_slots_schedules AS plan LEFT JOIN danube_time_slots AS slot ON slot.id = plan.time_slot_id
LEFT JOIN stores ON stores.zone_id = plan.zone_id LEFT JOIN {WEEKDAY} ON weekday.no = plan.day_of_week"""

SQL["normalize_phone"] = f"""
WITH {PHONES.strip()}
SELECT id, mobile_phone_number, mobile_number_country_code, country_code, mobile_number FROM spree_users JOIN phones ON person = id"""

SQL["postal_codes"] = """
SELECT id, zipcode, TRY_CAST(if(regexp_full_match(zipcode, '[0-9]+'), zipcode, NULL) AS INTEGER) AS postal_code_int,
       TRY_CAST(array_to_string(regexp_extract_all(zipcode, '[0-9]+'), '') AS BIGINT) AS postal_code_digits
FROM spree_addresses"""

SQL["barcodes"] = """
WITH codes AS (SELECT id, unnest(barcodes) AS code FROM spree_custom_products)
SELECT id AS offline_product_id, ifnull(TRY_CAST(regexp_extract(code, '^[0-9]+$') AS BIGINT), -1) AS barcode, 1 AS "order" FROM codes"""

SQL["product_taxon"] = "SELECT product_id, taxon_id FROM spree_products_taxons GROUP BY ALL"

SQL["promotions"] = """
WITH words AS (
  SELECT spree_promotion_id AS id, max(name) FILTER (locale = 'en') AS title_en, max(description) FILTER (locale = 'en') AS description_en,
         max(name) FILTER (locale = 'ar') AS title_ar, max(description) FILTER (locale = 'ar') AS description_ar
  FROM spree_promotion_translations WHERE name IS NOT NULL GROUP BY spree_promotion_id
)
SELECT id, ifnull(title_en, '') AS name_en, description_en, ifnull(title_ar, '') AS name_ar, description_ar,
       upper(array_to_string(regexp_extract_all(replace(title_en, ' ', '_'), '[a-zA-Z0-9_]+'), '')) AS code,
       expires_at, starts_at, ifnull(usage_limit, 0) AS usage_limit, match_policy, created_at, updated_at, per_code_usage_limit, apply_automatically,
       deleted_at, TRUE AS is_visible
FROM words JOIN spree_promotions USING (id)
QUALIFY id = min(id) OVER (PARTITION BY ifnull(title_en, ''))"""

SQL["brands"] = """
WITH roots AS (SELECT spree_taxon_id AS root FROM spree_taxon_translations WHERE locale = 'en' AND name = 'Brands' AND spree_taxon_id IN (SELECT id FROM spree_taxons)),
words AS (
  SELECT spree_taxon_id AS taxon, max(name) FILTER (locale = 'en') AS en, max(name) FILTER (locale = 'ar') AS ar
  FROM spree_taxon_translations GROUP BY spree_taxon_id
),
found AS (
  SELECT row_number() OVER (ORDER BY t.id) AS no, t.id AS taxon, t.created_at, t.updated_at
  FROM spree_taxons AS t SEMI JOIN roots ON roots.root = t.parent_id
),
short AS (
  SELECT taxon, en, ar, replace(en, ' ', '') AS solid FROM words
),
letters AS (
  -- the second letter: the one in second place, or, if that is none, what stands third, a blank for a sign
  SELECT taxon, en, ar, regexp_extract(solid, '[a-zA-Z0-9]') AS one,
         CASE WHEN regexp_full_match(solid[2], '[a-zA-Z0-9]') THEN solid[2] WHEN regexp_full_match(solid[3], '[a-zA-Z0-9]') THEN solid[3]
              WHEN length(solid) > 2 THEN ' ' ELSE '' END AS two
  FROM short
)
SELECT no AS id, ifnull(en, '') AS name_en,
       ifnull(upper(if(length(en) < 5, array_to_string(regexp_extract_all(replace(en, ' ', '_'), '[a-zA-Z0-9_]+'), ''),
                       one || two) || '_' || no), '') AS code,
       created_at, updated_at, taxon AS temp_taxon_id, ifnull(ar, '') AS name_ar
FROM found LEFT JOIN letters USING (taxon)"""

SQL["suppliers"] = """
WITH makers AS (
  SELECT ifnull(max(manufacturer) FILTER (locale = 'en'), '') AS maker, max(manufacturer) FILTER (locale = 'ar') AS tag,
         max(created_at) AS created_at, max(updated_at) AS updated_at, max(deleted_at) AS deleted_at
  FROM spree_product_translations WHERE manufacturer IS NOT NULL GROUP BY spree_product_id
)
SELECT regexp_replace(max(maker), '-[0-9]+$', '') AS name, substr(ifnull(any_value(tag), ''), 1, 10) AS code, max(created_at) AS created_at,
       max(updated_at) AS updated_at, max(deleted_at) AS deleted_at
FROM makers GROUP BY tag"""

SQL["shopping_list_products"] = """
WITH goods AS (SELECT id AS variant_id, product_id FROM spree_variants)
SELECT DISTINCT wishlist_id AS shopping_list_id, product_id FROM spree_wished_products LEFT JOIN goods USING (variant_id)"""


def expected(as_of: str) -> dict[str, str]:
    """All of them; ``as_of``: the SQL of the moment that stands for now."""
    return SQL | {"auth_users": auth_users(as_of), "auth_employees": auth_employees(as_of), "order_products": order_products(as_of)}
