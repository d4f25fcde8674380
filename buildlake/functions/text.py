"""String expressions; every function takes and returns Columns and stays in generated code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: file-name keywords of each build system
BUILD_KEYWORDS = {"autoconf": "configure", "cmake": "cmakelists.txt", "make": "makefile", "sln": ".sln"}

# fixed values: compiler switches and the option names they set
OPTIMIZATION = (("O2", "MaxSpeed"), ("O1", "MinSpace"), ("Ox", "Full"))
FAVOR = (("Ot", "Speed"), ("Os", "Size"))
INLINE = (("ob1", "OnlyExplicitInline"), ("ob2", "AnySuitable"), ("obd", "Default"))


def web_url(url: Column) -> Column:
    """A repository's web address from its service address: every ``repos/`` and ``api.`` goes."""
    return F.replace(F.replace(url, F.lit("repos/"), F.lit("")), F.lit("api."), F.lit(""))


def service_url(url: Column) -> Column:
    """The inverse: ``api.`` behind the first ``//``, ``/repos`` behind the first ``.com``."""
    return F.regexp_replace(F.regexp_replace(url, r"^(.*?//)", "$1api."), r"^(.*?\.com)", "$1/repos")


def tail(text: Column, n: int) -> Column:
    return F.right(text, F.lit(n))


def head(text: Column, n: int) -> Column:
    return F.left(text, F.lit(n))


def single_spaced(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def stripped(text: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def one_line(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(" "))


def printable(text: Column) -> Column:
    """Printable ASCII and white space only."""
    return F.regexp_replace(text, r"[^\x09-\x0d\x20-\x7e]", "")


def base_name(path: Column) -> Column:
    """Last element of a path with either separator."""
    return F.element_at(F.split(F.translate(path, "\\", "/"), "/"), -1)


def ratio_of_percent(text: Column) -> Column:
    """``'12.5%'`` as 0.125; null if it is no number."""
    return F.replace(text, F.lit("%"), F.lit("")).try_cast("double") / 100


def unqualified(name: Column) -> Column:
    """A function's name without its namespaces."""
    return F.element_at(F.split(name, "::"), -1)


def digest_of_path(path: Column) -> Column:
    """(file, md5) of a path that ends in `` (MD5: h)`` or `` (0x3: h)``; empty digest without one."""
    pattern = r"^(.*?) \((?:MD5|0x3): (\w+)\)"
    has = path.rlike(pattern)
    return F.struct(F.when(has, F.regexp_extract(path, pattern, 1)).otherwise(path).alias("file"), F.regexp_extract(path, pattern, 2).alias("digest"))


def build_systems(files: Column) -> Column:
    """Sorted build systems, joined by ``/``, whose keyword is in some file name; ``others`` without any."""

    def named(keyword: str) -> Column:
        return F.exists(files, lambda f: F.lower(F.trim(f)).contains(keyword))

    joined = F.concat_ws("/", *[F.when(named(keyword), F.lit(system)) for system, keyword in BUILD_KEYWORDS.items()])
    return F.when(joined == "", F.lit("others")).otherwise(joined)


def _first_of(table: Sequence[tuple[str, str]], flag: Column, default: str) -> Column:
    out = F.lit(default)
    for key, name in reversed(table):
        out = F.when(flag.contains(key), F.lit(name)).otherwise(out)
    return out


def optimization_name(flag: Column, default: str = "Disabled") -> Column:
    return _first_of(OPTIMIZATION, flag, default)


def favor_name(flag: Column) -> Column:
    return _first_of(FAVOR, flag, "")


def inline_name(flag: Column) -> Column:
    return _first_of(INLINE, F.lower(flag), "")


def label_of_path(path: Column) -> Column:
    """``debug`` or ``release``, then each of x86 and x64 that the path names."""
    low = F.lower(path)
    return F.concat_ws("_", F.when(low.contains("debug"), "debug").otherwise("release"), F.when(low.contains("x86"), "x86"), F.when(low.contains("x64"), "x64"))


def windows_command(build_mode: Column, library: Column, toolset: Column, solution: Column) -> Column:
    """The build command of a solution, its parts chosen by the parameters."""
    platform = F.when(library.isin("x86", "x64"), F.concat(F.lit("/property:Platform="), library)).when(library == "Mixed Platforms", "/property:Platform='Mixed Platforms'").when(library == "Any CPU", "/p:Platform=Any CPU")
    return F.concat_ws(
        " ",
        F.lit("msbuild"),
        F.when(build_mode.isin("Release", "Debug"), F.concat(F.lit("/property:Configuration="), build_mode)),
        platform,
        F.when(toolset.isin("v140", "v141"), "/p:WindowsTargetPlatformVersion= "),
        F.concat(F.lit("'"), solution, F.lit("'")),
    )


def unix_command(build_system: Column, folder: Column) -> Column:
    make = F.lit("make -j4")
    steps = (
        F.when(build_system.contains("bootstrap"), F.concat(F.lit("./bootstrap && bash ./configure && "), make))
        .when(build_system.contains("configure"), F.concat(F.lit("bash ./configure && "), make))
        .when(build_system.contains("cmake"), F.concat(F.lit("cmake -Bbuild ./ && cd build && "), make))
        .when(build_system.contains("make"), make)
    )
    return F.coalesce(F.concat(F.lit("cd "), folder, F.lit(" && "), steps), F.lit(""))


def set_lines(settings: Column) -> Column:
    """A map of settings as ``set(KEY VALUE)`` lines, in the order of the keys."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(settings)), lambda e: F.concat(F.lit("set("), e["key"], F.lit(" "), e["value"], F.lit(")"))), "\n")


def version_parts(version: Column) -> Column:
    """Numbers of a version, ``-`` like ``.``; null for a part that is no number."""
    return F.transform(F.split(F.replace(version, F.lit("-"), F.lit(".")), r"\."), lambda p: p.try_cast("int"))


def version_key(version: Column) -> Column:
    """A text that sorts as the version's parts do: a part that is no number before all others, a shorter version before its extensions."""
    # a part is an int: ten digits at most
    return F.array_join(F.transform(version_parts(version), lambda p: F.coalesce(F.concat(F.lit("1"), F.lpad(p.cast("string"), 10, "0")), F.lit("0"))), "")


def version_at_most(version: Column, limit: Column) -> Column:
    """Whether a version is not newer, part by part; a shorter one that agrees so far is older."""
    return version_parts(version) <= version_parts(limit)


def version_matches(version: Column, wanted: Column) -> Column:
    """Whether one version is the other or a prefix of it."""
    a, b = (F.replace(v, F.lit("-"), F.lit(".")) for v in (version, wanted))
    return a.contains(b) | b.contains(a)


def first_match(text: Column, patterns: Mapping[str, str], default: str) -> Column:
    """Name of the first pattern that a text matches."""
    out = F.lit(default)
    for name, pattern in reversed(patterns.items()):
        out = F.when(text.rlike(pattern), F.lit(name)).otherwise(out)
    return out
