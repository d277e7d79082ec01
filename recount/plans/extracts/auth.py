"""Auth-service extracts (D1-D3): the rows that should exist in the auth database."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions import pg
from ...operators.joins import left_join_fanout, prefixed
from ...operators.rank import first_per_key
from ...sources.catalog import Catalog
from ._common import now


def auth_user(cat: Catalog, as_of: Column | None = None) -> DataFrame:
    """D1 ``user``: every legacy user joined to each of its social logins (fans out)."""
    u = prefixed(
        cat["spree_users"],
        "u",
        ["id", "encrypted_password", "password_salt", "email", "created_at", "updated_at", "deleted_at",
         "is_phone_verified", "spree_api_key", "blacklisted_at"],
    )
    sua = prefixed(cat["spree_user_authentications"], "sua", ["user_id", "provider", "uid"])
    j = left_join_fanout(u, sua, ["u_id"], ["sua_user_id"])
    return j.select(
        F.col("u_id").alias("user_id"),
        F.col("u_encrypted_password").alias("password"),
        F.col("u_password_salt").alias("password_salt"),
        F.col("u_email").alias("email"),
        F.col("u_created_at").alias("created_at"),
        F.col("u_updated_at").alias("updated_at"),
        pg.flag("u_deleted_at").alias("is_deleted"),
        now(as_of).alias("password_updated_at"),
        F.lit(False).alias("is_email_verified"),
        F.col("u_is_phone_verified").alias("mobile_verified"),
        login_type("sua_provider").alias("login_type"),
        F.col("sua_uid").alias("social_id"),
        F.coalesce(F.col("u_spree_api_key"), F.lit("")).alias("spree_api_key"),
        pg.flag("u_blacklisted_at").alias("blacklisted"),
    )


def login_type(provider: str) -> Column:
    return pg.value_map(provider, {"google_oauth2": "google"}, F.col(provider))


def device_token(cat: Catalog) -> DataFrame:
    """D2 ``device_token``: one client per user (null user is one group).

    The legacy order inside a user is all ties; we keep the smallest device id, then the
    rest of the row, so the choice is total and repeatable."""
    uc = cat["spree_user_clients"].select(
        "user_id",
        F.col("uuid").alias("device_id"),
        F.col("platform").alias("device_type"),
        "created_at",
        "updated_at",
        F.col("push_notification_token").alias("token"),
    )
    order = [pg.asc(c) for c in ("device_id", "device_type", "created_at", "updated_at", "token")]
    return first_per_key(uc, ["user_id"], order).withColumn("user_type", F.lit("customer"))


def employee_roles(cat: Catalog) -> DataFrame:
    """Role assignments whose role is not the plain customer role (id 2, name 'user')."""
    sr = cat["spree_roles"].filter((F.col("id") != 2) & (F.col("name") != "user")).select(F.col("id").alias("rid"))
    return cat["spree_roles_users"].join(sr, F.col("role_id") == F.col("rid"), "left_semi")


def auth_employee(cat: Catalog, as_of: Column | None = None) -> DataFrame:
    """D3 ``employee``: distinct users holding a staff role.

    ``SELECT DISTINCT u.* ... JOIN roles`` keeps each user once whatever its number of
    roles; with ``id`` the user key that is a semi-join, which neither fans out nor needs a
    distinct over every column."""
    u = cat["spree_users"]
    holders = employee_roles(cat).select(F.col("user_id").alias("ruid"))
    staff = u.join(holders, u["id"] == holders["ruid"], "left_semi")
    return staff.select(
        "id",
        F.col("id").alias("user"),
        F.col("encrypted_password").alias("password"),
        "password_salt",
        "email",
        "created_at",
        "updated_at",
        pg.flag("deleted_at").alias("is_deleted"),
        now(as_of).alias("password_updated_at"),
    )
