"""What folder names, file stems and platform fields say.  Digits are ASCII; a name that doesn't match gives null unless stated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name formats and origins, which other tools that read the same files rely on.
FOLDER_FORMAT = "^[a-zA-Z0-9-]+_[a-zA-Z0-9-]+_([0-9]{1,3})_[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}-[0-9]{2}-[0-9]{2}$"
IMAGE_FORMAT = "^[a-zA-Z0-9-]+_[a-zA-Z0-9-]+_[0-9]{1,3}_[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}-[0-9]{2}-[0-9]{2}[.][a-zA-Z]+$"
IMAGE_EXTENSIONS = ("jpg", "jpeg", "png")
ORIGINS = ("adf", "awf", "hpwren", "random")
ALIASES = {"sdis-77": "platform", "sdis-07": "platform", "force-06": "platform", "marguerite-282": "platform", "pyro": "platform", "ardeche": "platform", "axis": "awf", "2023": "awf"}
UNKNOWN_AZIMUTH = 999
STAMP = "yyyy-MM-dd'T'HH-mm-ss"
STEM_TIME = "([0-9]{4}[-_][0-9]{2}[-_][0-9]{2}T[0-9]{2}[-_][0-9]{2}[-_][0-9]{2})"
STEM_PREFIXES = ("platform_", "pyro_")
# End of the fixed values.


def camera(folder: Column) -> Column:
    """All before the first `_YYYY` that no letter follows; the whole name if there is none."""
    return F.when(folder.rlike("_[0-9]{4}[^a-zA-Z]"), F.regexp_extract(folder, "(?s)^(.*?)_[0-9]{4}[^a-zA-Z]", 1)).otherwise(folder)


def site(camera_: Column) -> Column:
    """A camera's name without its azimuth."""
    return F.when(camera_.rlike("^.+_[0-9]+$"), F.regexp_extract(camera_, "^(.+)_([0-9]+)$", 1)).otherwise(camera_)


def azimuth(camera_: Column) -> Column:
    return F.regexp_extract(camera_, "^(.+)_([0-9]+)$", 2).try_cast("int")


def stamp(folder: Column) -> Column:
    """The time at the end of a folder name, as text; texts order as times do."""
    return F.nullif(F.regexp_extract(folder, "_([0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}-[0-9]{2}-[0-9]{2})$", 1), F.lit(""))


def moment(stem: Column) -> Column:
    """The first whole time in a stem, with - or _ between its parts, whatever numbers before it look like a date; a bare date or an invalid time gives null."""
    return F.try_to_timestamp(F.translate(F.regexp_extract(stem, STEM_TIME, 1), "_", "-"), F.lit(STAMP))


def origin(stem: Column, platform: str = "platform") -> Column:
    """The data set a stem comes from, by its first word; `platform` is the word of the camera platform itself."""
    word = F.substring_index(F.lower(stem), "_", 1)
    aliases = F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])
    return F.when(word == platform, F.lit("platform")).when(word.isin(*ORIGINS), word).otherwise(F.coalesce(aliases[word], F.lit("unknown")))


def camera_details(stem: Column, prefixes: tuple[str, ...] = STEM_PREFIXES) -> Column:
    """struct(name, azimuth, number) of a platform stem: `name-azimuth` or `name_number` before the time; null without either."""
    rest = stem
    for p in prefixes:
        rest = F.replace(rest, F.lit(p), F.lit(""))
    station = F.substr(rest, F.lit(1), F.greatest(F.length(rest) - 20, F.lit(0)))
    by_azimuth = station.contains("-")
    name = F.when(by_azimuth, F.regexp_extract(station, "^(.*)-[^-]*$", 1)).otherwise(F.regexp_extract(station, "^(.*)_[^_]*$", 1))
    number = F.regexp_extract(station, "([^_-]*)$", 1).try_cast("int")
    found = F.struct(name.alias("name"), F.when(by_azimuth, number).alias("azimuth"), F.when(~by_azimuth, number).alias("number"))
    return F.when(moment(stem).isNotNull() & number.isNotNull(), found)


def details(stem: Column, platform: str = "platform") -> Column:
    """struct(origin, moment, camera): camera details only where the origin is the platform."""
    o = origin(stem, platform)
    return F.struct(o.alias("origin"), moment(stem).alias("moment"), F.when(o == "platform", camera_details(stem)).alias("camera"))


def file_stamp(api_time: Column) -> Column:
    """2025-05-30T10:02:55.98 -> 2025-05-30T10-02-55"""
    return F.substring_index(F.replace(api_time, F.lit(":"), F.lit("-")), ".", 1)


def detection_paths(organization: Column, camera_: Column, sequence_id: Column, sequence_azimuth: Column, started_at: Column, created_at: Column, detection_azimuth: Column, prefix: str = "platform") -> Column:
    """struct(image, label, detection): where a detection's files go."""
    folder = F.concat(organization, F.lit("/"), file_stamp(started_at), F.lit("_"), camera_, F.lit("-"), sequence_azimuth.cast("int").cast("string"), F.lit("_sequence-"), sequence_id.cast("string"))
    stem = F.concat(F.lit(f"{prefix}_"), organization, F.lit("_"), camera_, F.lit("-"), detection_azimuth.cast("int").cast("string"), F.lit("_"), file_stamp(created_at))
    path = lambda kind, ext: F.concat(folder, F.lit(f"/{kind}/"), stem, F.lit(ext))
    return F.struct(path("images", ".jpg").alias("image"), path("labels_predictions", ".txt").alias("label"), path("detections", ".jpg").alias("detection"))


def pair_id(site_: Column, a: Column, b: Column) -> Column:
    return F.concat_ws("|", site_, a.cast("string"), b.cast("string"))


def month_name(month: Column) -> Column:
    """January to December; other numbers give null."""
    names = "January February March April May June July August September October November December".split()
    return F.when(month.between(1, 12), F.try_element_at(F.array(*map(F.lit, names)), month.cast("int")))


def is_background(label_bytes: Column) -> Column:
    """A label file that exists and is empty."""
    return F.coalesce(label_bytes == 0, F.lit(False))


def seeded(seed: int, *key: Column) -> Column:
    """The order that stands for a seeded shuffle: md5 of seed and key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in key]))


def days(first: Column, end: Column) -> Column:
    """The days from first to the one before end."""
    return F.when(first < end, F.sequence(first, F.date_sub(end, 1))).otherwise(F.array().cast("array<date>"))
