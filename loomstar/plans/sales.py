"""Three JSON sources (products, carts, users) to a sales star."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from loomstar.functions import clean
from loomstar.operators import project, reshape
from loomstar.operators.lookup import combine, push_key_through
from loomstar.plans import star

# Fixed values.
PRODUCT = {
    "productId": "product_id",
    "title": "product_name",
    "description": "description",
    "category": "category",
    "image": "image",
    "rate": "rating",
}
USER = {
    "userId": "user_id",
    "firstname": "first_name",
    "lastname": "last_name",
    "email": "email",
    "username": "username",
    "password": "password",
    "phone": "phone",
    "street": "street",
    "number": "number",
    "zipcode": "zipcode",
    "geolocation_lat": "latitude",
    "geolocation_long": "longitude",
}
PRIVATE = ["email", "username", "password", "phone"]


def stage_products(products: DataFrame) -> DataFrame:
    return reshape.flatten_struct(products, "rating")


def stage_carts(carts: DataFrame) -> DataFrame:
    """One row per cart line, with the sale day and its month and year; a cart without products stays."""
    lines = reshape.explode_structs(carts, "products").withColumn("date", clean.to_day("date"))
    return lines.withColumn("month", clean.month_of("date")).withColumn("year", clean.year_of("date"))


def stage_users(users: DataFrame, sep: str = "_") -> DataFrame:
    flat = reshape.flatten_struct(reshape.flatten_struct(users, "address", sep), "name", sep)
    return flat.withColumns({c: clean.capitalize(c) for c in ("firstname", "lastname")})


def combine_staging(products: DataFrame, carts: DataFrame, users: DataFrame) -> DataFrame:
    """Cart lines with their product and user; lines without either are left out."""
    return combine(carts, products, users, "productId", "userId")


def user_dim_source(staging: DataFrame, private: list[str] | None = None) -> DataFrame:
    masked = project.mask_columns(staging, PRIVATE if private is None else private)
    return masked.withColumn("street", clean.title_case("street"))


def build(
    staging: DataFrame,
    order: list[Column | str],
    private: list[str] | None = None,
    existing: Mapping[str, DataFrame] | None = None,
    hashed: bool = False,
) -> star.Star:
    """All tables of the star, each built when asked for. ``existing`` has the tables of earlier loads: their keys stay.

    ``hashed`` asks for string keys of products, users and cities by hash: staging then gets them by expression. Dates are
    few, and the fact's rows may repeat, so these two keep integers.
    """
    known = existing or {}

    def space(table: str) -> str | None:
        return table if hashed else None

    def keyed(t: star.Star) -> DataFrame:
        dates = (t["dim_date"], "date_key", {"date": "sale_date"})
        if hashed:
            users = ("dim_user", "user_key", ["userId", "firstname", "lastname"])
            return star.load_keys(star.hashed_keys(staging, [("dim_product", "product_key", ["productId", "title"]), users]), [dates])
        products = (t["dim_product"], "product_key", {"productId": "product_id", "title": "product_name"})
        users = (t["_users"], "user_key", {"userId": "user_id", "firstname": "first_name", "lastname": "last_name"})
        return star.load_keys(staging, [products, users, dates])

    def users(t: star.Star) -> DataFrame:
        members = t["_users"]
        if "dim_user" in known:
            members = members.join(known["dim_user"].select("user_key", "city_key"), "user_key", "left")
        return push_key_through(members, staging, t["dim_city"], "city_key", {"user_id": "userId"}, {"city": "city"}, ["city_key"])

    return star.Star(
        stg_combo_table=keyed,
        dim_product=lambda t: star.build_dim(staging, PRODUCT, ["product_id", "product_name"], "product_key", order, known.get("dim_product"), space("dim_product")),
        dim_city=lambda t: star.build_dim(staging, ["city"], ["city"], "city_key", (), known.get("dim_city"), space("dim_city")),
        _users=lambda t: star.build_dim(
            user_dim_source(staging, private), USER, ["user_id", "first_name", "last_name"], "user_key", order, known.get("dim_user"), space("dim_user")
        ),
        dim_user=users,
        dim_date=lambda t: star.date_dim(staging, "date", existing=known.get("dim_date")),
        sale_fact_table=lambda t: sale_fact(t["stg_combo_table"], "sale_key", known.get("sale_fact_table")),
    )


def sale_fact(keyed: DataFrame, serial: str | None = None, existing: DataFrame | None = None) -> DataFrame:
    """Every cart line, with its total."""
    measures = {
        "sale_id": F.col("id"),
        "price": F.col("price"),
        "quantity": F.col("quantity"),
        "total_sale": F.col("price") * F.col("quantity"),
        "stock": F.col("count"),
    }
    return star.build_fact(keyed, measures, ["product_key", "user_key", "date_key"], serial=serial, existing=existing)
