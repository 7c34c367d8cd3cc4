"""Movies: genres and actors unpacked, with bridges and a snowflaked director."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from loomstar.functions.keys import hash_key
from loomstar.operators.lookup import bridge, bridge_through, push_key
from loomstar.plans import star
from loomstar.sources.schemas import MOVIE_TYPES

# Fixed values.
MOVIE = ["Series_Title", "Released_Year", "Runtime", "Overview", "Meta_score", "IMDB_Rating", "Certificate", "Poster_Link"]


def stage_movies(movies: DataFrame) -> DataFrame:
    return star.stage_movies(movies, MOVIE_TYPES)


def build(staging: DataFrame, existing: Mapping[str, DataFrame] | None = None, hashed: bool = False) -> star.Star:
    """All tables of the star, each built when asked for. ``existing`` has the tables of earlier loads: their keys stay.

    ``hashed`` asks for string keys by hash: staging then gets its keys by expression, without a join. The fact's grain is
    movie by actor, so summing ``Gross`` over it counts a movie once per actor.
    """
    known, title = existing or {}, {"Series_Title": "Series_Title", "Released_Year": "Released_Year"}

    def named(column: str, key: str, table: str) -> DataFrame:
        return star.build_dim(staging, [column], [column], key, (), known.get(table), table if hashed else None)

    def keyed(t: star.Star) -> DataFrame:
        if hashed:
            return star.hashed_keys(staging, [("dim_movie", "movie_key", list(title)), ("dim_actor", "actor_key", ["Actor_Name"]), ("dim_director", "director_key", ["Director"])])
        dims = [(t["_movies"], "movie_key", title), (t["dim_actor"], "actor_key", {"Actor_Name": "Actor_Name"}), (t["dim_director"], "director_key", {"Director": "Director"})]
        return star.load_keys(staging, dims)

    def fact(t: star.Star) -> DataFrame:
        if hashed:
            rows = gross_fact(t["stg_movies"])
            return rows.select(hash_key("fact_gross", *rows.columns).alias("gross_key"), "*")
        return gross_fact(t["stg_movies"], "gross_key", known.get("fact_gross"))

    def movies(t: star.Star) -> DataFrame:
        members = t["_movies"]
        if "dim_movie" in known:
            members = members.join(known["dim_movie"].select("movie_key", "director_key"), "movie_key", "left")
        return push_key(members, t["stg_movies"], "director_key", ["movie_key"], ["director_key"])

    return star.Star(
        stg_movies=keyed,
        dim_director=lambda t: named("Director", "director_key", "dim_director"),
        dim_actor=lambda t: named("Actor_Name", "actor_key", "dim_actor"),
        dim_genre=lambda t: named("Genre", "genre_key", "dim_genre"),
        _movies=lambda t: star.build_dim(staging, MOVIE, list(title), "movie_key", (), known.get("dim_movie"), "dim_movie" if hashed else None),
        dim_movie=movies,
        director_actor=lambda t: bridge(t["stg_movies"], "director_key", "actor_key"),
        actor_movie=lambda t: bridge(t["stg_movies"], "actor_key", "movie_key"),
        genre_movie=lambda t: bridge_through(t["stg_movies"], [(t["dim_genre"], "genre_key", ["Genre"])], "movie_key"),
        fact_gross=fact,
    )


def gross_fact(keyed: DataFrame, serial: str | None = None, existing: DataFrame | None = None) -> DataFrame:
    measures = {"Gross": F.col("Gross"), "No_of_Votes": F.col("No_of_Votes")}
    return star.build_fact(keyed, measures, ["movie_key", "actor_key", "director_key"], "distinct", (), serial, existing)
