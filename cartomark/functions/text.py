"""Text normalisation, file-name parts and similarity columns."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Binary size suffixes, 1024 apart (fixed values).
SIZE_SUFFIXES = ("B", "KB", "MB", "GB", "TB", "PB", "EB", "ZB", "YB")


def strip_nonword(text: Column) -> Column:
    """Drop everything that is not a word character (Unicode)."""
    return F.regexp_replace(text, r"(?U)\W+", "")


def to_words(text: Column) -> Column:
    """Lower-case, with every run of non-word characters and each underscore a space."""
    return F.lower(F.replace(F.regexp_replace(text, r"(?U)\W+", " "), F.lit("_"), F.lit(" ")))


def to_spaced(text: Column) -> Column:
    """Lower-case, with every run of non-word characters a space; underscores stay."""
    return F.lower(F.regexp_replace(text, r"(?U)\W+", " "))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_extension(name: Column) -> Column:
    """Last extension with its dot; empty for none or a leading-dot name."""
    return F.regexp_extract(name, r"[^./](\.[^./]*)$", 1)


def file_stem(path: Column) -> Column:
    """Base name without directory and extension."""
    name = file_name(path)
    return F.substring(name, F.lit(1), F.length(name) - F.length(file_extension(name)))


def raster_label(name: Column, sep: str = "_") -> Column:
    """Label in a raster's name: the tokens between the first and the last."""
    tokens = F.split(name, sep)
    return F.array_join(F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 2, F.lit(0))), " ")


def raster_kind(name: Column, ext: str = ".tif", sep: str = "_") -> Column:
    """Feature kind in a raster's name: the last token up to the extension."""
    return F.split_part(F.element_at(F.split(name, sep), -1), F.lit(ext), F.lit(1))


def path_id(directory: Column, root: Column) -> Column:
    """First folder under ``root``; null when there is none."""
    below = F.when(
        F.startswith(directory, root), F.substring(directory, F.length(root) + 1, F.length(directory))
    )
    return F.nullif(F.regexp_extract(below, r"^[/\\]*([^/\\]+)", 1), F.lit(""))


def example_pattern(example: Column) -> Column:
    """Regular expression for strings shaped like an example.

    Runs of digits, letters and blanks become counted classes; any other
    character stands for itself.
    """
    runs = F.regexp_extract_all(
        example, F.lit(r"(\p{N}+|\p{L}+|\s+|[^\p{N}\p{L}\s])"), F.lit(1)
    )

    def to_class(run: Column) -> Column:
        count = F.concat(F.lit("{"), F.length(run).cast("string"), F.lit("}"))
        return (
            F.when(run.rlike(r"^\p{N}"), F.concat(F.lit(r"\d"), count))
            .when(run.rlike(r"^\p{L}"), F.concat(F.lit(r"\w"), count))
            .when(run.rlike(r"^\s"), F.concat(F.lit(r"\s"), count))
            .when(run.isin("^", "]", "\\"), F.concat(F.lit("[\\"), run, F.lit("]")))
            .otherwise(F.concat(F.lit("["), run, F.lit("]")))
        )

    return F.array_join(F.transform(runs, to_class), "")


def drop_sheet_prefix(text: Column) -> Column:
    """Text after the last ``word-number number`` prefix of a raster label."""
    return F.element_at(F.split(text, r"(?U)\w{1,99}[-]\d{1,99}\s{1,99}\d{1,99}\s{1,99}"), -1)


def abbreviation_or_id(
    abbreviation: Column, legend_id: Column, cog_id: Column, system: Column, version: Column
) -> Column:
    """An item's abbreviation, or its id past the ``cog_system_version_`` prefix.

    The id's first remaining token is dropped and the rest joined by blanks.
    """
    prefix = F.concat(cog_id, F.lit("_"), system, F.lit("_"), version, F.lit("_"))
    tokens = F.split(F.replace(legend_id, prefix, F.lit("")), "_")
    rest = F.array_join(F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0))), " ")
    return F.when(F.length(abbreviation) == 0, rest).otherwise(abbreviation)


def split_trimmed(text: Column, sep: str = ",") -> Column:
    """Array of the trimmed parts of a separated list."""
    return F.transform(F.split(text, sep), lambda part: F.trim(part))


def readable_size(size: Column, decimals: int = 3) -> Column:
    """Bytes as a number with a binary suffix, such as ``1.234MB``."""

    def shown(power: int, suffix: str) -> Column:
        # Ties go to the even digit, as in printf.
        value = F.bround(size.cast("double") / F.lit(1024.0**power), decimals)
        return F.format_string(f"%.{decimals}f{suffix}", value)

    out = F.when(size < 1024, shown(0, SIZE_SUFFIXES[0]))
    for power, suffix in enumerate(SIZE_SUFFIXES[1:], start=1):
        out = out.when(size < F.lit(1024.0 ** (power + 1)), shown(power, suffix))
    return out.otherwise(shown(len(SIZE_SUFFIXES), SIZE_SUFFIXES[-1]))


def tokens(text: Column) -> Column:
    """Lower-case words of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\b\w\w+\b"), F.lit(0))


def _ratio_udf():
    # Built inside a function so that it travels to executors by value.
    def ratios(a: pd.Series, b: pd.Series) -> pd.Series:
        matcher = SequenceMatcher(None)
        out = []
        seen = None
        for left, right in zip(a, b):
            if left is None or right is None:
                out.append(None)
                continue
            if right != seen:
                matcher.set_seq2(right)
                seen = right
            matcher.set_seq1(left)
            out.append(matcher.ratio())
        return pd.Series(out, dtype="float64")

    return F.pandas_udf(ratios, DoubleType())


def sequence_ratio(a: Column, b: Column) -> Column:
    """Matching-block ratio of two strings (order matters, as in difflib)."""
    return _ratio_udf()(a, b)


def levenshtein_ratio(a: Column, b: Column) -> Column:
    """``1 - distance / longer length``; 1 for two empty strings."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer > 0, F.lit(1.0) - F.levenshtein(a, b) / longer).otherwise(F.lit(1.0))
