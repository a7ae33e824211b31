"""The books - ratings - users star."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelab.functions.cleaning import last_per_key
from ratelab.operators.joins import HotKeys, hot_keys, size_hint, skew_join


def join_books(
    ratings: DataFrame,
    books: DataFrame,
    dedup: bool = True,
    book_order: Sequence[str] = (),
    hot: HotKeys | None = None,
    hint: str | None = None,
) -> DataFrame:
    """Ratings with their book; ratings of unknown books are left out.

    With ``dedup`` the last book of an isbn by ``book_order`` is used, else
    duplicates multiply the ratings. ``hint`` is Spark's join hint for the books.
    """
    if dedup:
        books = last_per_key(books, ["isbn"], book_order)
        books = books.drop(*book_order)
    return skew_join(ratings, books, ["isbn"], hot=hot, hint=hint)


def star(
    books: DataFrame,
    users: DataFrame,
    ratings: DataFrame,
    dedup: bool = True,
    book_order: Sequence[str] = (),
    user_order: Sequence[str] = (),
    hot: tuple[HotKeys, HotKeys] | None = None,
) -> DataFrame:
    """Ratings with book and user columns; both joins are inner.

    ``hot`` are the isbns and the users with very many ratings, when the caller
    knows them from narrower tables; otherwise one pass over the ratings looks.
    Books and users are counted: only few of them may be broadcast.
    """
    book_hint, user_hint = size_hint(books.count()), size_hint(users.count())
    hot_books, hot_users = hot or hot_keys(ratings, ["isbn"], ["user_id"])
    if dedup:
        users = last_per_key(users, ["user_id"], user_order).drop(*user_order)
    # A user is a few short columns, a book is wide: books come last and are never shuffled with the ratings.
    met = skew_join(ratings, users, ["user_id"], hot=hot_users, hint=user_hint)
    of_user = [F.col(f"`{c}`") for c in users.columns if c != "user_id"]
    rest = [F.col(f"`{c}`") for c in ratings.columns if c not in ("user_id", "isbn")]
    of_book = [F.col(f"`{c}`") for c in books.columns if c not in ("isbn", *(book_order if dedup else ()))]
    rated = join_books(met, books, dedup, book_order, hot_books, book_hint)
    return rated.select("user_id", "isbn", *rest, *of_book, *of_user)
