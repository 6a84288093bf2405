"""Ratings, titles and retail reports.

Dimension tables (titles, departments) are joined by key; Spark picks a
broadcast join from their measured size under AQE. Only literal lists
(weekday names) are broadcast explicitly, since their size is known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from strata.functions.strings import java_split, literal_regex
from strata.operators.aggregates import count_by, mean_by, rank_values, ratio_by, top_n
from strata.sources.frames import create_df

# Weekday ids and names of the reference's literal table.
WEEKDAYS = [(1, "Sunday"), (2, "Monday"), (3, "Tuesday"), (4, "Wednesday"),
            (5, "Thursday"), (6, "Friday"), (7, "Saturday")]


def mean_rating_by_title(ratings: DataFrame, titles: DataFrame, item: str = "item_id",
                         rating: str = "rating", title: str = "title", method: str = "fold",
                         bad: str = "skip", name: str = "mean_rating") -> DataFrame:
    """Mean rating per item with its title (B5). The item id stays in the
    output, so equal titles do not collapse."""
    means = mean_by(ratings, item, rating, method=method, bad=bad, name=name)
    return means.join(titles.select(item, title), item, "inner").select(item, title, name)


def ratings_per_item(ratings: DataFrame, item: str = "item_id", name: str = "n") -> DataFrame:
    """Ratings per item, most rated first."""
    return count_by(ratings, item, name).orderBy(F.col(name).desc(), F.col(item))


def most_rated(ratings: DataFrame, titles: DataFrame, n: int, item: str = "item_id",
               rating: str = "rating", title: str = "title",
               name: str = "rating_count") -> DataFrame:
    """The ``n`` most rated titles (B5b): count(rating) per item, joined to
    titles, top n with the item id as tie-break."""
    counts = count_by(ratings, item, name, column=rating)
    joined = counts.join(titles.select(item, title), item, "inner").select(item, title, name)
    return top_n(joined, [F.col(name).desc()], n, tiebreak=[item])


def genres_of(titles: DataFrame, genre_col: str, separator: str = "|",
              item: str = "item_id") -> DataFrame:
    """(item, genres array) split on ``separator`` with JVM split rules."""
    return titles.select(item, java_split(F.col(genre_col), literal_regex(separator)).alias("genres"))


def genre_ranking(titles: DataFrame, genre_col: str, separator: str = "|",
                  name: str = "genre", count_name: str = "n") -> DataFrame:
    """How many titles carry each genre, most common first (A3)."""
    return rank_values(genres_of(titles, genre_col, separator), "genres", name, count_name)


def tag_counts(tags: DataFrame, item: str = "item_id", name: str = "tag_count") -> DataFrame:
    return count_by(tags, item, name)


def tag_counts_by_title(tags: DataFrame, titles: DataFrame, item: str = "item_id",
                        title: str = "title", name: str = "tag_count") -> DataFrame:
    """Tags per title (the side result of B6)."""
    return tag_counts(tags, item, name).join(titles.select(item, title), item, "inner") \
        .select(item, title, name)


def tags_exceed_genres(tags: DataFrame, titles: DataFrame, genre_col: str,
                       separator: str = "|", item: str = "item_id",
                       title: str = "title") -> DataFrame:
    """Titles with more tags than genres (B6): tag count ⋈ (genre count, title)
    and the column-to-column filter, in one join."""
    genre_counts = titles.select(item, title, F.size(java_split(
        F.col(genre_col), literal_regex(separator))).alias("_genres"))
    return (tag_counts(tags, item, "_tags")
            .join(genre_counts, item, "inner")
            .where(F.col("_tags") > F.col("_genres"))
            .select(item, title))


def hourly_counts(events: DataFrame, ts: str, id_col: str, hour: str = "hour",
                  name: str = "n") -> DataFrame:
    """count(id) per hour of day, by hour (B7, first report)."""
    return (events.select(F.hour(ts).alias(hour), F.col(id_col))
            .groupBy(hour).agg(F.count(id_col).alias(name)).orderBy(hour))


def weekday_table(spark: SparkSession) -> DataFrame:
    """The reference's literal weekday list, 1 = Sunday."""
    return create_df(spark, WEEKDAYS, [("day_id", IntegerType(), True),
                                       ("day_name", StringType(), True)])


def weekday_counts(spark: SparkSession, orders: DataFrame, day_col: str, id_col: str,
                   name: str = "order_count") -> DataFrame:
    """count(id) per weekday name (B7, second report): an inner join with the
    seven-row literal list, broadcast since its size is fixed. Days outside
    1..7 find no name and drop, as in the reference."""
    days = F.broadcast(weekday_table(spark))
    return (orders.select(F.col(day_col).alias("_day"), F.col(id_col))
            .join(days, F.col("_day") == F.col("day_id"), "inner")
            .groupBy("day_name").agg(F.count(id_col).alias(name))
            .orderBy(F.col(name), F.col("day_name")))


def group_ratio(members: DataFrame, groups: DataFrame, member_key: str, member_group: str,
                group_key: str, group_name: str, share: bool = False) -> DataFrame:
    """Per group: count of member ids and count / sum of ids (B8, "procent");
    with ``share=True`` also the group's share of all members."""
    joined = members.select(member_key, member_group).join(
        groups.select(group_key, group_name), F.col(member_group) == F.col(group_key), "inner")
    out = ratio_by(joined.select(group_name, member_key), group_name, member_key,
                   count_name="count", ratio_name="procent",
                   share_name="share" if share else None)
    return out.orderBy("count", group_name)
