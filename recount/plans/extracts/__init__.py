"""The 30 legacy extracts (D1-D30): each returns the rows that should have been migrated."""

from . import auth, order, product, user

__all__ = ["auth", "order", "product", "user"]
