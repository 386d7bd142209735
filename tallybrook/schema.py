"""The six shop tables, declared once.

Decoding, typing, default filling, integrity checks and changelog layout all
derive from ``TABLES``; nothing is inferred from data.
"""

from __future__ import annotations

from dataclasses import dataclass
from types import MappingProxyType


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    not_null: bool = False
    # Value the source gives a column left out of an insert ("now" = insert time).
    default: object = None
    # Value a NULL takes in the default-filled form of the changelog.
    fill: object = None
    max_length: int | None = None
    domain: tuple[str, ...] = ()
    # SQL condition that valid values meet.
    check: str | None = None


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    cascade: bool = False


@dataclass(frozen=True)
class TableSpec:
    name: str
    key: str
    columns: tuple[Column, ...]
    unique: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)

    @property
    def changelog_schema(self) -> str:
        return ", ".join([f"{c.name} {c.type}" for c in self.columns] + [META_SCHEMA])


# _version orders the changes of a key, _seq orders changes inside one message.
META_SCHEMA = "_version BIGINT, _seq INT, _is_deleted INT"
META_COLUMNS = ("_version", "_seq", "_is_deleted")

SNAPSHOT_VERSION = 1

# Table and column names, limits, defaults and value sets of the shop.
# Keys are BIGINT, not INT: tables of this size outgrow 2^31 rows.
KEY = "BIGINT"
MONEY = "DECIMAL(10,2)"

ORDER_STATUSES = ("pending", "confirmed", "shipped", "delivered", "cancelled")
PAYMENT_METHODS = ("credit_card", "debit_card", "paypal", "transfer")
PAYMENT_STATUSES = ("pending", "completed", "failed", "refunded")

CATEGORIES = TableSpec(
    name="categories",
    key="category_id",
    columns=(
        Column("category_id", KEY, not_null=True),
        Column("name", "STRING", not_null=True, max_length=100),
        Column("description", "STRING", fill=""),
        Column("created_at", "TIMESTAMP", not_null=True, default="now"),
    ),
    unique=("name",),
)

CUSTOMERS = TableSpec(
    name="customers",
    key="customer_id",
    columns=(
        Column("customer_id", KEY, not_null=True),
        Column("email", "STRING", not_null=True, max_length=255),
        Column("first_name", "STRING", not_null=True, max_length=100),
        Column("last_name", "STRING", not_null=True, max_length=100),
        Column("phone", "STRING", fill="", max_length=20),
        Column("city", "STRING", fill="", max_length=100),
        Column("country", "STRING", default="Mexico", fill="", max_length=100),
        Column("created_at", "TIMESTAMP", not_null=True, default="now"),
        Column("updated_at", "TIMESTAMP", not_null=True, default="now"),
    ),
    unique=("email",),
)

PRODUCTS = TableSpec(
    name="products",
    key="product_id",
    columns=(
        Column("product_id", KEY, not_null=True),
        Column("category_id", KEY, not_null=True),
        Column("name", "STRING", not_null=True, max_length=255),
        Column("sku", "STRING", not_null=True, max_length=100),
        Column("price", MONEY, not_null=True, check="price >= 0"),
        Column("stock", "INT", not_null=True, default=0, check="stock >= 0"),
        Column("is_active", "BOOLEAN", not_null=True, default=True),
        Column("created_at", "TIMESTAMP", not_null=True, default="now"),
        Column("updated_at", "TIMESTAMP", not_null=True, default="now"),
    ),
    unique=("sku",),
    foreign_keys=(ForeignKey("category_id", "categories"),),
)

ORDERS = TableSpec(
    name="orders",
    key="order_id",
    columns=(
        Column("order_id", KEY, not_null=True),
        Column("customer_id", KEY, not_null=True),
        Column("status", "STRING", not_null=True, default="pending", max_length=30, domain=ORDER_STATUSES),
        Column("total_amount", MONEY, fill=0),
        Column("city", "STRING", fill="", max_length=100),
        Column("created_at", "TIMESTAMP", not_null=True, default="now"),
        Column("updated_at", "TIMESTAMP", not_null=True, default="now"),
    ),
    foreign_keys=(ForeignKey("customer_id", "customers"),),
)

ORDER_ITEMS = TableSpec(
    name="order_items",
    key="item_id",
    columns=(
        Column("item_id", KEY, not_null=True),
        Column("order_id", KEY, not_null=True),
        Column("product_id", KEY, not_null=True),
        Column("quantity", "INT", not_null=True, check="quantity > 0"),
        Column("unit_price", MONEY, not_null=True, check="unit_price >= 0"),
    ),
    foreign_keys=(ForeignKey("order_id", "orders", cascade=True), ForeignKey("product_id", "products")),
)

PAYMENTS = TableSpec(
    name="payments",
    key="payment_id",
    columns=(
        Column("payment_id", KEY, not_null=True),
        Column("order_id", KEY, not_null=True),
        Column("amount", MONEY, not_null=True),
        Column("method", "STRING", not_null=True, max_length=30, domain=PAYMENT_METHODS),
        Column("status", "STRING", not_null=True, default="pending", max_length=30, domain=PAYMENT_STATUSES),
        Column("transaction_ref", "STRING", fill="", max_length=255),
        Column("processed_at", "TIMESTAMP", not_null=True, default="now"),
    ),
    unique=("transaction_ref",),
    foreign_keys=(ForeignKey("order_id", "orders"),),
)

TABLES = MappingProxyType(
    {t.name: t for t in (CATEGORIES, CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS, PAYMENTS)}
)
