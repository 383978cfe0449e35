"""Names: output names and the capture sequence that a picture belongs to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from boxlake.functions.geometry import C, col

# Class lists, name patterns and generic folders of the three collections.
VISDRONE_VEHICLES = [4, 5, 6, 9, 10]
DRONEVEHICLE_NAMES = ["bus", "car", "feright", "feright car", "feright_car", "truck", "truvk", "van"]
UAVDT_SEQUENCES = [
    r"^(DJI_\d+ \([^)]*\))_n\d+$",
    r"^(DJI_\d+\([^)]*\))_n\d+$",
    r"^(DJI_\d+)_n\d+$",
    r"^(DJI-\d+-\d+p)\d+$",
    r"^(det_ucystr__)\d+$",
    r"^(pavilion_\d+_)\d+$",
    r"^(dji_\d+_\d+m)\d+_\d+$",
    r"^(dji\d+)\d+_\d+$",
    r"^(djibridge\d*)_?\d+.*$",
    r"^(lim_?\d*)\D*\d+$",
    r"^(dhi_\d{4})\d+_\d+$",
    r"^(traina?)\d+$",
]
DATED_FLIGHT = r"^(DJI_20\d{8})_\d+"
GENERIC_FOLDERS = ["a", "b", "image", "madala", "modala", "modela_1", "valimg"]
REMOVABLE_FOLDERS = ["a", "b", "image", "images", "jpeg", "jpg", "madala", "modala", "modela_1"]


def strip(x: C) -> Column:
    """Without white space of any kind at the ends; trim() knows blanks only."""
    return F.regexp_replace(col(x), r"^\s+|\s+$", "")


def normalize_group(x: C) -> Column:
    """A name in lower case with runs of odd characters as one underscore; "unknown" if nothing is left."""
    out = F.regexp_replace(F.replace(F.lower(strip(x)), F.lit(" "), F.lit("")), r"\(1\)$", "")
    out = F.regexp_replace(F.regexp_replace(out, r"[^a-z0-9()_-]+", "_"), r"^_+|_+$", "")
    return F.coalesce(F.nullif(out, F.lit("")), F.lit("unknown"))


def visdrone_group(name: C) -> Column:
    return F.concat(F.lit("visdrone:"), normalize_group(F.substring_index(col(name), "_", 1)))


def uavdt_group(stem: C) -> Column:
    """The first pattern that fits gives the sequence; names without one are sequences of their own."""
    stem = col(stem)
    found = F.coalesce(*(F.when(stem.rlike("(?i)" + p), F.regexp_extract(stem, "(?i)" + p, 1)) for p in UAVDT_SEQUENCES))
    group = normalize_group(found)
    group = F.when(group.rlike("^(lim|dji)_"), F.substring_index(group, "_", 1)).otherwise(group)
    return F.when(found.isNotNull(), F.concat(F.lit("uavdt:"), group)).otherwise(F.concat(F.lit("uavdt:singleton:"), normalize_group(stem)))


def dronevehicle_group(folder: C, filename: C, path: C, raw_split: C) -> Column:
    """struct(sequence_group, force_train): by dated flight, folder or the last telling folder of the original path."""
    text = lambda x: F.coalesce(strip(x), F.lit(""))
    flight = F.regexp_extract(F.regexp_replace(text(filename), "^/+", ""), "(?i)" + DATED_FLIGHT, 1)
    place = normalize_group(text(folder))
    parts = F.filter(F.split(text(path), r"[\\/]+"), lambda p: (p != "") & (p != "."))
    parts = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))
    telling = F.filter(F.transform(parts, normalize_group), lambda p: ~p.isin(REMOVABLE_FOLDERS))
    last = F.try_element_at(telling, F.lit(-1))
    name = lambda kind, x: F.concat(F.lit(f"dronevehicle:{kind}:"), x)
    unresolved = F.when(col(raw_split) == "train", "dronevehicle:unresolved-train-metadata").otherwise("dronevehicle:unresolved-validation-metadata")
    known = F.when(flight != "", name("flight", normalize_group(flight))).when(~place.isin([*GENERIC_FOLDERS, "unknown"]), name("capture", place)).when(last.isNotNull(), name("capture", last))
    return F.struct(F.coalesce(known, unresolved).alias("sequence_group"), (known.isNull() & (col(raw_split) == "train")).alias("force_train"))


def source_name(file_name: C) -> Column:
    return F.substring_index(col(file_name), "_", 1)


def resolution_key(width: C, height: C) -> Column:
    return F.concat(col(width).cast("string"), F.lit("x"), col(height).cast("string"))


def output_name(source: C, raw_split: C, file_name: C) -> Column:
    return F.concat_ws("_", col(source), col(raw_split), col(file_name))
