"""Source and target schemas, and the projection that makes rows fit them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

# Column names and types of the sources and the targets.

REVIEW_EXTRACT = """
    product_id string, product_name string, category string, about_product string, img_link string,
    product_link string, rating string, rating_count string, discounted_price string, actual_price string,
    discount_percentage string, user_id string, user_name string, review_id string, review_title string,
    modified_date date
"""

MOVIE_TYPES = {
    "Poster_Link": "string",
    "Series_Title": "string",
    "Released_Year": "bigint",
    "Certificate": "string",
    "Runtime": "string",
    "Genre": "string",
    "IMDB_Rating": "double",
    "Overview": "string",
    "Meta_score": "double",
    "Director": "string",
    "No_of_Votes": "bigint",
    "Gross": "bigint",
}

PRODUCT_DOCUMENT = """
    id bigint, title string, price double, description string, category string, image string,
    rating struct<rate: double, count: bigint>
"""

CART_DOCUMENT = """
    id bigint, userId bigint, date string, products array<struct<productId: bigint, quantity: bigint>>, __v bigint
"""

USER_DOCUMENT = """
    id bigint, email string, username string, password string, phone string, __v bigint,
    name struct<firstname: string, lastname: string>,
    address struct<city: string, street: string, number: bigint, zipcode: string,
                   geolocation: struct<lat: string, long: string>>
"""

TARGETS = {
    "reviews": {
        "dim_product": """product_key bigint, product_id string, product_name string, category string,
            about_product string, img_link string, product_link string, rating string, rating_count string""",
        "dim_user": "user_key bigint, user_id string, user_name string",
        "dim_review": "review_key bigint, review_id string, review_content string, user_key bigint, product_key bigint",
        "product_user_join": "product_key bigint, user_key bigint",
        "fact_price": """price_key bigint, `actual_price (PLN)` double, `discounted_price (PLN)` double,
            discount_percentage string, product_key bigint""",
    },
    "daily_reviews": {
        "dim_product": """product_key string, product_id string, product_name string, category string,
            about_product string, img_link string, product_link string, rating string, rating_count string,
            created_date date, last_updated_date date""",
        "dim_user": "user_key string, user_id string, user_name string, created_date date, last_updated_date date",
        "dim_review": """review_key string, review_id string, review_content string, user_key string,
            product_key string, created_date date, last_updated_date date""",
        "fact_price": """price_key string, actual_price double, discounted_price double, discount_percentage string,
            product_key string, created_date date""",
        "etl_audit_log": """table_name string, staging_count bigint, insert_count bigint, update_count bigint,
            status string, load_time decimal(38,9), log_date date""",
    },
    "movies": {
        "dim_director": "director_key bigint, Director string",
        "dim_movie": """movie_key bigint, Series_Title string, Released_Year bigint, Runtime string, Overview string,
            Meta_score double, IMDB_Rating double, Certificate string, Poster_Link string, director_key bigint""",
        "dim_actor": "actor_key bigint, Actor_Name string",
        "dim_genre": "genre_key bigint, Genre string",
        "director_actor": "director_key bigint, actor_key bigint",
        "actor_movie": "actor_key bigint, movie_key bigint",
        "genre_movie": "genre_key bigint, movie_key bigint",
        "fact_gross": """gross_key bigint, Gross bigint, No_of_Votes bigint, movie_key bigint, actor_key bigint,
            director_key bigint""",
    },
    "sales": {
        "dim_product": """product_key bigint, product_id bigint, product_name string, description string,
            category string, image string, rating double""",
        "dim_city": "city_key bigint, city string",
        "dim_user": """user_key bigint, user_id bigint, first_name string, last_name string, email string,
            username string, password string, phone string, street string, number bigint, zipcode string,
            latitude string, longitude string, city_key bigint""",
        "dim_date": "date_key bigint, sale_date date, month int, year int",
        "sale_fact_table": """sale_key bigint, sale_id bigint, product_key bigint, user_key bigint, date_key bigint,
            price double, quantity bigint, total_sale double, stock bigint""",
    },
}


def target(star: str, table: str) -> StructType:
    return StructType.fromDDL(TARGETS[star][table])


def fit(df: DataFrame, schema: StructType | str, defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """Project rows to a target schema: by name, cast, missing columns from ``defaults`` or null.

    A column of ``df`` that the target does not have is an error, not silently lost. So is a missing first column, the
    target's own key, unless ``defaults`` has it.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    unknown = [c for c in df.columns if c not in schema.names]
    if unknown:
        raise ValueError(f"not in the target: {', '.join(unknown)}")
    defaults = defaults or {}
    own = schema.names[0]
    if own not in df.columns and own not in defaults:
        raise ValueError(f"no values for the key {own}")

    def value(field) -> Column:
        c = F.col(f"`{field.name}`") if field.name in df.columns else defaults.get(field.name, F.lit(None))
        return c.cast(field.dataType).alias(field.name)

    return df.select(*[value(f) for f in schema.fields])


def add_null_columns(df: DataFrame, **types: str) -> DataFrame:
    """Empty columns to be filled later, as ALTER TABLE ADD COLUMN does."""
    return df.withColumns({name: F.lit(None).cast(kind) for name, kind in types.items()})
