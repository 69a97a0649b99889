"""Column expressions for ids, names, paths and rating fields.

All are native Spark expressions: they stay inside whole-stage codegen and
push down with the rest of the plan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodframe.functions.text import utrim

# --- fixed values -----------------------------------------------------------
# Season lengths (episodes per season) used for the finale control.
SEASON_LENGTHS = {1: 24, 2: 22, 3: 22, 4: 25, 5: 24, 6: 22}
# Rating scale of the labels.
RATING_MIN, RATING_MAX = 1, 5
# ---------------------------------------------------------------------------


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# B1 --------------------------------------------------------------------------
def season_categories(members: DataFrame, title_col: str = "title") -> DataFrame:
    """Keep category titles that mention ``Season`` (case-sensitive), strip the
    ``Category:`` prefix and take the first digit run as the season number."""
    t = F.col(title_col)
    digits = F.regexp_extract(t, r"(\d+)", 1)
    return (
        members.filter(t.contains("Season"))
        .withColumn("category", F.replace(t, F.lit("Category:"), F.lit("")))
        .withColumn("season", F.when(digits != "", digits.cast("int")))
    )


# B2 --------------------------------------------------------------------------
def episode_id_from_scene(scene_id: str | Column) -> Column:
    """``S_EE_n`` -> ``S_EE``."""
    return F.substring_index(_c(scene_id), "_", 2)


# B3 --------------------------------------------------------------------------
def scene_id_build(season: str | Column, episode: str | Column, n: str | Column) -> Column:
    """``{season}_{episode:02d}_{n}``; ``n`` counts from 1."""
    return F.format_string("%d_%02d_%d", _c(season), _c(episode), _c(n))


def episode_id_build(season: str | Column, episode: str | Column) -> Column:
    return F.format_string("%d_%02d", _c(season), _c(episode))


# B4 --------------------------------------------------------------------------
def episode_title(source: str | Column, stem: str | Column) -> Column:
    """Title from the document's ``source`` text, else from the file stem."""
    from_source = F.nullif(utrim(F.replace(F.coalesce(_c(source), F.lit("")),
                                           F.lit(" transcript"), F.lit(""))), F.lit(""))
    tail = F.regexp_extract(_c(stem), r"(?is)^ep_\d+_(.+)", 1)
    from_stem = utrim(F.translate(F.replace(tail, F.lit("_transcript"), F.lit("")), "_", " "))
    return F.coalesce(from_source,
                      F.when(_c(stem).rlike(r"(?is)^ep_\d+_.+"), from_stem),
                      _c(stem))


# B5 --------------------------------------------------------------------------
def season_from_folder(folder: str | Column) -> Column:
    """Season number from a ``Season N Transcripts`` folder name (prefix match,
    any case); NULL for folders that do not match (they are skipped)."""
    s = F.regexp_extract(_c(folder), r"(?i)^Season (\d+) Transcripts", 1)
    return F.when(s != "", s.cast("int"))


def episode_from_stem(stem: str | Column) -> Column:
    """Episode number from ``ep_<n>_`` anywhere in the stem, else 0."""
    s = F.regexp_extract(_c(stem), r"(?i)ep_(\d+)_", 1)
    return F.when(s != "", s.cast("int")).otherwise(F.lit(0))


def path_parts(path: str | Column) -> tuple[Column, Column]:
    """(parent folder name, file stem) of a path as ``_metadata.file_path`` gives
    it, that is URL-encoded (a plus sign stands for itself there)."""
    p = F.url_decode(F.replace(_c(path), F.lit("+"), F.lit("%2B")))
    # cut first: a pattern that ends in $ is tried from every place of a long path
    folder = F.regexp_extract(F.substring_index(p, "/", -2), r"([^/]+)/[^/]+$", 1)
    stem = F.regexp_extract(F.substring_index(p, "/", -1), r"([^/]+?)(\.[^./]*)?$", 1)
    return folder, stem


# B6 --------------------------------------------------------------------------
def valid_ratings(funny: str | Column = "funny", sad: str | Column = "sad") -> Column:
    """Both ratings inside 1..5 (NULL counts as invalid)."""
    return F.coalesce(_c(funny).between(RATING_MIN, RATING_MAX)
                      & _c(sad).between(RATING_MIN, RATING_MAX), F.lit(False))


# B7 --------------------------------------------------------------------------
def cast_label_types(df: DataFrame, int_cols=("funny", "sad"), float_cols=("position",)) -> DataFrame:
    """Text -> int ratings and double position; bad text becomes NULL."""
    from moodframe.functions.parse import parse_int
    out = df
    for c in int_cols:
        if c in df.columns:
            # int("4.0") fails in Python too: parse as an integer only
            out = out.withColumn(c, parse_int(F.col(c)))
    for c in float_cols:
        if c in df.columns:
            out = out.withColumn(c, F.expr(f"try_cast(trim(`{c}`) AS DOUBLE)"))
    return out


# B8 --------------------------------------------------------------------------
def source_rating(source: str | Column, label: str | Column, predicted: str | Column,
                  label_source: str = "labels") -> Column:
    """The human rating for the label source, the model's for any other."""
    return F.when(_c(source) == label_source, _c(label)).otherwise(_c(predicted))


# B9 --------------------------------------------------------------------------
def season_episode_code(code: str | Column) -> Column:
    """``S1.E10`` -> ``1_10`` (no padding)."""
    return F.regexp_replace(_c(code), r"S(\d+)\.E(\d+)", "$1_$2")


def pad_episode_id(code: str | Column) -> Column:
    """``1_1`` -> ``1_01`` so histogram ids join with scene-derived ids."""
    parts = F.split(_c(code), "_")
    return F.format_string("%d_%02d", F.try_element_at(parts, F.lit(1)).cast("int"),
                           F.try_element_at(parts, F.lit(2)).cast("int"))


# B10 -------------------------------------------------------------------------
def episode_controls(df: DataFrame, episode_col: str = "episode_id",
                     season_lengths: Mapping[int, int] | None = None) -> DataFrame:
    """Add ``season``, ``is_premiere`` and ``is_finale`` (0/1 ints) from an
    ``S_EE`` id. The length table is a literal map: no join, no broadcast."""
    lengths = season_lengths if season_lengths is not None else SEASON_LENGTHS
    parts = F.split(F.col(episode_col), "_")
    season = F.try_element_at(parts, F.lit(1)).cast("int")
    ep = F.try_element_at(parts, F.lit(2)).cast("int")
    kv = []
    for k, v in sorted(lengths.items()):
        kv += [F.lit(int(k)), F.lit(int(v))]
    length = F.try_element_at(F.create_map(*kv), season) if kv else F.lit(None).cast("int")
    return (df.withColumn("season", season)
              .withColumn("is_premiere", F.coalesce(ep == 1, F.lit(False)).cast("int"))
              .withColumn("is_finale", F.coalesce(ep == length, F.lit(False)).cast("int")))


# B11 -------------------------------------------------------------------------
LABELED_COLUMNS = ["episode_id", "scene_id", "funny", "sad", "text", "prev_scene_text", "position"]


def project_labeled(df: DataFrame) -> DataFrame:
    return df.select(*LABELED_COLUMNS)


# B12 -------------------------------------------------------------------------
def split_errors(df: DataFrame, error_col: str = "error") -> tuple[DataFrame, DataFrame]:
    """(good rows, failed rows) by a nullable error column."""
    return df.filter(F.col(error_col).isNull()), df.filter(F.col(error_col).isNotNull())


# B14 -------------------------------------------------------------------------
def to_class(rating: str | Column) -> Column:
    """Rating 1..5 -> class 0..4."""
    return _c(rating) - 1


def to_rating(cls: str | Column) -> Column:
    """Class 0..4 -> rating 1..5."""
    return _c(cls) + 1


# B15 -------------------------------------------------------------------------
def model_name(backbone: str | Column, optimizer: str | Column, dropout: str | Column,
               encoding: str | Column) -> Column:
    """Run key: backbone with ``-`` and ``/`` as ``_``, optimizer,
    with/without_dropout, encoding, ``results``."""
    drop = F.when(_c(dropout), F.lit("with_dropout")).otherwise(F.lit("without_dropout"))
    return F.concat_ws("_", F.translate(_c(backbone), "-/", "__"), _c(optimizer), drop,
                       _c(encoding), F.lit("results"))


MODEL_NAME_PATTERN = r"^(.*)_([A-Za-z]+)_(with|without)_dropout_(cls|mean_pooling)_results$"


def parse_model_name(name: str | Column) -> list[Column]:
    """Inverse of :func:`model_name` (backbone keeps its ``_`` form)."""
    n = _c(name)
    return [
        F.regexp_extract(n, MODEL_NAME_PATTERN, 1).alias("backbone"),
        F.regexp_extract(n, MODEL_NAME_PATTERN, 2).alias("optimizer"),
        (F.regexp_extract(n, MODEL_NAME_PATTERN, 3) == "with").alias("dropout"),
        F.regexp_extract(n, MODEL_NAME_PATTERN, 4).alias("encoding"),
    ]
