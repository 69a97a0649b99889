"""Catalogue of seasons, episodes and scene ids.

Each episode row carries its ordered scene ids: an episode's scenes are cut
from one page, so the list is bounded by that page. Seasons are *not*
collected into one row each (a season list grows with the data); instead
every episode gets its rank inside its season and every season its rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodframe.operators import sequence


def catalogue(scenes: DataFrame, season: str = "season", episode: str = "episode", title: str = "title",
              scene_id: str = "scene_id", order: str = "scene_idx") -> DataFrame:
    """One row per episode: season, episode, title, ordered scene ids,
    ``episode_rank`` inside the season (by episode number, an integer sort)
    and ``season_rank``."""
    eps = scenes.groupBy(season, episode).agg(
        F.min(title).alias(title),
        F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(scene_id).alias("id")))).alias("__s"))
    eps = eps.withColumn("scene_ids", F.transform("__s", lambda x: x["id"])).drop("__s") \
             .withColumn("n_scenes", F.size("scene_ids"))
    eps = sequence.dense_index(eps, [season], [episode], index_col="episode_rank", count_col="n_episodes",
                               base=1, long_groups=True)
    seasons = scenes.select(season).distinct()
    seasons = sequence.dense_index(seasons, [], [season], index_col="season_rank", count_col=None, base=1, long_groups=True)
    # one row per season: bounded by the season domain, joined on its key
    return eps.join(seasons, season)


def titles_by_season(members: DataFrame, season: str = "season", title: str = "title", tie: str | None = None) -> DataFrame:
    """E18 as rows: ``(season, rank, title)`` sorted by title inside the
    season (from sorted ranges: a season with many titles is spread out)."""
    order = [title] + ([tie] if tie else [])
    return sequence.dense_index(members.select(season, *order), [season], order, index_col="rank",
                                count_col=None, base=1, long_groups=True)
