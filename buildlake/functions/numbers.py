"""Number, hash and bit expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: axes from which a repository's build configuration is picked
CONFIG_AXES: dict[str, tuple[str, ...]] = {
    "optimization": ("O1", "O2", "Ox", "Od"),
    "build_mode": ("Debug", "Release"),
    "library": ("x86", "x64"),
    "toolset": ("v142", "v141", "v140"),
}


def from_hex(text: Column) -> Column:
    """Value of hexadecimal digits, with or without ``0x``; null if there are others."""
    digits = F.regexp_replace(text, "^0[xX]", "")
    return F.when(digits.rlike("^[0-9A-Fa-f]+$"), F.conv(digits, 16, 10).cast("long"))


def to_hex(value: Column, width: Column) -> Column:
    """Lower-case digits with zeros up to ``width``; longer values keep all digits."""
    digits = F.lower(F.hex(value))
    return F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))


def hex_plus(address: Column, length: Column) -> Column:
    """The address ``length`` further, as wide as it was."""
    return to_hex(from_hex(address) + length, F.length(address))


def whole_kb(n_bytes: Column) -> Column:
    return F.floor(n_bytes / 1024).cast("long")


def kb(n_bytes: Column) -> Column:
    return n_bytes / 1024


def at_least_zero(value: Column) -> Column:
    return F.greatest(value, F.lit(0))


def _digit(url: Column, place: int) -> Column:
    digits = F.regexp_replace(F.md5(url), "[^0-9]", "")
    # an address with fewer than four digits in its hash counts as 1, 1, 1, 1
    return F.when(F.length(digits) < 4, F.lit(1)).otherwise(F.substring(digits, place, 1).cast("int"))


def picked(url: Column, place: int, choices: Sequence[str]) -> Column:
    """One of ``choices``, decided by a decimal digit of the address's hash: always the same one."""
    return F.element_at(F.array(*map(F.lit, choices)), _digit(url, place) % len(choices) + 1)


def picked_config(url: Column) -> dict[str, Column]:
    """Optimisation, mode, library and toolset for an address."""
    return {name: picked(url, k, choices) for k, (name, choices) in enumerate(CONFIG_AXES.items(), 1)}


def identifier(url: Column, *parts: Column) -> Column:
    """``md5(url)_part_part...``; a null or empty part counts as ``unknown``."""
    return F.concat_ws("_", F.md5(url), *[F.coalesce(F.nullif(p, F.lit("")), F.lit("unknown")) for p in parts])
