"""Project files (XML) and solution files (text) as tables: getters by XPath and patterns, setters by rewriting.

A project file is a row with an ``xml`` column; one row a configuration comes
out of the getters. Getters of single values are XPath expressions, each of
which parses the text; ``values_of`` takes any number of values in one parse.
Setters change one text per row with standard XML parsing, batch by batch.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from buildlake.functions import text

# fixed value: the namespace of project files
NAMESPACE = "http://schemas.microsoft.com/developer/msbuild/2003"
ANY = "All Configurations"
_CONDITION = r"'\$\(Configuration\)\|\$\(Platform\)'=='([^|']+)\|([^']+)'"


def _path(*names: str) -> str:
    return "/".join(f'*[local-name()="{n}"]' for n in names)


def condition_of(value: Column) -> Column:
    """(configuration, platform) of a condition attribute."""
    return F.struct(F.regexp_extract(value, _CONDITION, 1).alias("configuration"), F.regexp_extract(value, _CONDITION, 2).alias("platform"))


def configurations(projects: DataFrame, xml: str = "xml", platform: str = ANY, configuration: str = ANY) -> DataFrame:
    """One row for each declared (configuration, platform), each once; ``ANY`` matches all."""
    item = 'string(//*[local-name()="ItemGroup" and @Label="ProjectConfigurations"]/*[local-name()="ProjectConfiguration"]'
    names = F.xpath(F.col(xml), F.lit(item.removeprefix("string(") + "/@Include"))
    pairs = projects.withColumn("pair", F.explode(F.array_distinct(names)))
    out = pairs.withColumns({"configuration": F.split_part("pair", F.lit("|"), F.lit(1)), "platform": F.split_part("pair", F.lit("|"), F.lit(2))}).drop("pair")
    return out.where((F.lit(platform) == ANY) | (F.col("platform") == platform)).where((F.lit(configuration) == ANY) | (F.col("configuration") == configuration))


def source_files(xml: Column) -> Column:
    return F.xpath(xml, F.lit('//*[local-name()="ClCompile"]/@Include'))


def include_files(xml: Column) -> Column:
    return F.xpath(xml, F.lit('//*[local-name()="ClInclude"]/@Include'))


def property_value(xml: Column, item: str, label: str | None = "Configuration") -> Column:
    """Text of the first ``item`` in a property group with a label; empty without one."""
    label_test = f'@Label="{label}"' if label else "not(@Label)"
    return F.xpath_string(xml, F.lit(f'//*[local-name()="PropertyGroup" and {label_test}]/{_path(item)}'))


def definition_value(xml: Column, group: str, item: str, configuration: str | None = None, platform: str | None = None) -> Column:
    """Text of ``item`` in an item definition group, of a configuration or of the first one; empty without one."""
    where = f"[contains(@Condition, \"=='{configuration}|{platform}'\")]" if configuration else ""
    return F.xpath_string(xml, F.lit(f'(//*[local-name()="ItemDefinitionGroup"]{where}/{_path(group, item)})[1]'))


def value_list(value: Column) -> Column:
    """Elements of a ``;`` list; none for an empty text."""
    return F.filter(F.split(value, ";"), lambda x: x != "")


Place = tuple[str, ...]
"""Where a value stands: ("PropertyGroup", item, label or None), ("ItemDefinitionGroup", group, item) or ("Include", item)."""

_DESCRIBED: dict[str, Place] = {
    "sources": ("Include", "ClCompile"),
    "includes": ("Include", "ClInclude"),
    "configuration_type": ("PropertyGroup", "ConfigurationType", "Configuration"),
    "toolset": ("PropertyGroup", "PlatformToolset", "Configuration"),
    "whole_program": ("PropertyGroup", "WholeProgramOptimization", "Configuration"),
    "output_directory": ("PropertyGroup", "OutDir", None),
    "optimization": ("ItemDefinitionGroup", "ClCompile", "Optimization"),
    "lib_file": ("ItemDefinitionGroup", "Lib", "OutputFile"),
    "output_file": ("ItemDefinitionGroup", "Link", "OutputFile"),
    "pdb_file": ("ItemDefinitionGroup", "Link", "ProgramDatabaseFile"),
    "link_dependencies": ("ItemDefinitionGroup", "Link", "AdditionalDependencies"),
    "include_directories": ("ItemDefinitionGroup", "ClCompile", "AdditionalIncludeDirectories"),
}


def _found(root: ET.Element, places: dict[Place, list[int]], row: list) -> None:
    """Fills ``row`` with the first value of each place in the order of the document, and with the lists of Include."""
    stack = [(root, "", None, "")]
    while stack:
        e, parent, label, above = stack.pop()
        name = e.tag.rpartition("}")[2] if isinstance(e.tag, str) else ""
        for key in (("PropertyGroup", name, label),) * (parent == "PropertyGroup") + (("ItemDefinitionGroup", parent, name),) * (above == "ItemDefinitionGroup"):
            for i in places.get(key, ()):
                if row[i] == "":
                    row[i] = e
        if "Include" in e.attrib:
            for i in places.get(("Include", name), ()):
                row[i].append(e.attrib["Include"])
        stack += [(child, name, e.attrib.get("Label"), parent) for child in reversed(e)]
    row[:] = ["".join(v.itertext()) if isinstance(v, ET.Element) else v for v in row]


def values_of(xml: Column, wanted: dict[str, Place]) -> Column:
    """A struct of the values at ``wanted`` places, as the single getters give them, from one parse; null for null, an error for what isn't XML."""
    lists = [place[0] == "Include" for place in wanted.values()]
    places: dict[Place, list[int]] = {}
    for i, place in enumerate(wanted.values()):
        places.setdefault(place, []).append(i)
    kinds = T.StructType([T.StructField(n, T.ArrayType(T.StringType()) if many else T.StringType()) for n, many in zip(wanted, lists, strict=True)])

    @F.pandas_udf(kinds)
    def over(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for documents in batches:
            out = []
            for document in documents:
                row: list = [None] * len(lists)
                if document is not None:
                    row = [[] if many else "" for many in lists]
                    _found(ET.fromstring(document), places, row)
                out.append(row)
            yield pd.DataFrame(out, columns=list(wanted), dtype=object)

    return over(xml)


def described_projects(projects: DataFrame, xml: str = "xml", more: dict[str, Place] | None = None) -> DataFrame:
    """One row a project: files, type, toolset, optimisation, outputs, dependencies and ``more`` values, in one parse."""
    wanted = _DESCRIBED | (more or {})
    v = lambda name: F.col(f"__values.{name}")
    linked = F.when(v("configuration_type") == "StaticLibrary", v("lib_file")).otherwise(v("output_file"))
    listed = {name: value_list(v(name)) for name in ("link_dependencies", "include_directories")}
    columns = {name: v(name) for name in wanted if name != "lib_file"} | {"output_file": linked} | listed
    return projects.withColumn("__values", values_of(F.col(xml), wanted)).withColumns(columns).drop("__values")


Change = Callable[[ET.Element, str | None], None]


def _rewriter(changes: Sequence[Change]) -> Callable[[Column, Column], Column]:
    """A function of (document, array of values) that makes all changes, in their order, in one parse; null for what isn't XML."""

    @F.pandas_udf(T.StringType())
    def over(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        ET.register_namespace("", NAMESPACE)
        for documents, values in batches:
            out = []
            for document, row in zip(documents, values, strict=True):
                try:
                    root = ET.fromstring(document)
                except (ET.ParseError, TypeError):
                    out.append(None)
                    continue
                for change, value in zip(changes, row, strict=True):
                    change(root, value)
                out.append(ET.tostring(root, encoding="unicode"))
            yield pd.Series(out, dtype=object)

    return over


def _edited(change: Change) -> Callable[[Column, Column], Column]:
    rewrite = _rewriter([change])
    return lambda xml, value: rewrite(xml, F.array(value))


def _q(name: str) -> str:
    return f"{{{NAMESPACE}}}{name}"


def _put(parent: ET.Element, name: str, value: str | None) -> None:
    """Set a child's text, made if missing; None removes it."""
    child = parent.find(_q(name))
    if value is None:
        if child is not None:
            parent.remove(child)
        return
    if child is None:
        child = ET.SubElement(parent, _q(name))
    child.text = value


def _definition(group: str, item: str) -> Change:
    def change(root: ET.Element, value: str) -> None:
        for parent in root.findall(f"./{_q('ItemDefinitionGroup')}/{_q(group)}"):
            _put(parent, item, value)

    return change


def _property(item: str, label: str | None = "Configuration") -> Change:
    def change(root: ET.Element, value: str) -> None:
        for parent in root.findall(f"./{_q('PropertyGroup')}"):
            if parent.get("Label") == label:
                _put(parent, item, value)

    return change


def _optimize(root: ET.Element, flag: str) -> None:
    name = next((n for key, n in text.OPTIMIZATION if key in (flag or "")), "")
    _definition("ClCompile", "Optimization")(root, name)
    if name:
        _definition("ClCompile", "BasicRuntimeChecks")(root, "Default")
    if name == "Full":
        _property("WholeProgramOptimization")(root, "true")


CHANGES: dict[str, Change] = {
    "toolset": _property("PlatformToolset"),
    "whole_program": _property("WholeProgramOptimization"),
    "output_directory": _property("OutDir", None),
    "incremental_link": _property("LinkIncremental", None),
    "optimization": _optimize,
    "favor": _definition("ClCompile", "FavorSizeOrSpeed"),
    "inline": _definition("ClCompile", "InlineFunctionExpansion"),
    "intrinsics": _definition("ClCompile", "IntrinsicFunctions"),
    "output_file": _definition("Link", "OutputFile"),
    "pdb_file": _definition("Link", "ProgramDatabaseFile"),
    "include_directories": _definition("ClCompile", "AdditionalIncludeDirectories"),
}

set_toolset = _edited(CHANGES["toolset"])
set_whole_program = _edited(CHANGES["whole_program"])
set_output_directory = _edited(CHANGES["output_directory"])
set_incremental_link = _edited(CHANGES["incremental_link"])
set_optimization = _edited(CHANGES["optimization"])
set_favor = _edited(CHANGES["favor"])
set_inline = _edited(CHANGES["inline"])
set_intrinsics = _edited(CHANGES["intrinsics"])
set_output_file = _edited(CHANGES["output_file"])
set_pdb_file = _edited(CHANGES["pdb_file"])
set_include_directories = _edited(CHANGES["include_directories"])


def edited(xml: Column, edits: Sequence[tuple[str, Column]]) -> Column:
    """``xml`` after a script of edits (name in ``CHANGES``, value), as the setters in turn would leave it, parsed and written once."""
    return _rewriter([CHANGES[name] for name, _ in edits])(xml, F.array(*[value.cast("string") for _, value in edits]))


_PROJECT = r'^Project\("\{([^}]+)\}"\)[\s=]+"([^"]+)",\s"(.+proj)", "(\{[^}]+\})"'
_DEPENDENCY = r"^\s*(\{[A-Za-z0-9-]+\})\s*=\s*\{[A-Za-z0-9-]+\}"


def solution_rows(solutions: DataFrame, key: str, content: str) -> DataFrame:
    """Lines of solution files with the project, section and global block that each is in."""
    lines = solutions.select(key, F.posexplode(F.split(content, "\r?\n")).alias("pos", "line"))
    w = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    line = F.col("line")
    section = F.when(line.rlike(r"^\s*(Project|Global)Section"), F.regexp_extract(line, r"Section\((\w+)\)", 1)).when(line.rlike(r"^\s*End(Project|Global)Section"), "")
    project = F.when(line.rlike(_PROJECT), F.regexp_extract(line, _PROJECT, 4)).when(line.rlike("^EndProject\\s*$"), "")
    whole = F.when(line.rlike("^Global\\s*$"), True).when(line.rlike("^EndGlobal\\s*$"), False)
    return lines.withColumns({"section": F.last(section, ignorenulls=True).over(w), "project": F.last(project, ignorenulls=True).over(w), "in_global": F.coalesce(F.last(whole, ignorenulls=True).over(w), F.lit(False))})


def solution_projects(rows: DataFrame, key: str) -> DataFrame:
    line = F.col("line")
    part = lambda i: F.regexp_extract(line, _PROJECT, i)
    return rows.where(line.rlike(_PROJECT)).select(key, "pos", part(1).alias("type"), part(2).alias("name"), part(3).alias("path"), part(4).alias("id"))


def solution_dependencies(rows: DataFrame, key: str) -> DataFrame:
    """(key, name, depends_on) by the projects' names."""
    named = solution_projects(rows, key).select(key, "id", "name")
    edges = rows.where((F.col("section") == "ProjectDependencies") & F.col("line").rlike(_DEPENDENCY)).select(key, F.col("project").alias("id"), F.regexp_extract("line", _DEPENDENCY, 1).alias("on"))
    return edges.join(named, [key, "id"]).join(named.toDF(key, "on", "depends_on"), [key, "on"]).select(key, "name", "depends_on")


def with_configuration(solutions: DataFrame, key: str, content: str, mode: str, platform: str) -> DataFrame:
    """Solutions in which the first declared configuration is replaced by ``mode|platform``, unless that is declared."""
    rows = solution_rows(solutions, key, content).where((F.col("section") == "SolutionConfigurationPlatforms") & ~F.col("line").rlike(r"^\s*GlobalSection"))
    names = rows.select(key, "pos", text.stripped(F.split_part("line", F.lit("="), F.lit(1))).alias("name")).where("name <> ''")
    target = f"{mode}|{platform}"
    chosen = names.groupBy(key).agg(F.min_by("name", "pos").alias("__first"), F.max(F.col("name") == target).alias("__there"))
    joined = solutions.join(chosen, key, "left")
    changed = F.when(F.col("__first").isNotNull() & ~F.col("__there"), F.replace(F.col(content), F.col("__first"), F.lit(target))).otherwise(F.col(content))
    return joined.withColumn(content, changed).drop("__first", "__there")


def rendered_solution(projects: DataFrame, dependencies: DataFrame, key: str) -> DataFrame:
    """Solution texts from their projects (key, pos, type, name, path, id) and dependencies (key, id, on)."""
    wanted = dependencies.groupBy(key, "id").agg(F.array_sort(F.collect_list("on")).alias("on"))
    rows = projects.join(wanted, [key, "id"], "left")
    section = F.concat(F.lit("\tProjectSection(ProjectDependencies) = postProject\r\n"), F.array_join(F.transform("on", lambda d: F.concat(F.lit("\t\t"), d, F.lit(" = "), d, F.lit("\r\n"))), ""), F.lit("\tEndProjectSection\r\n"))
    block = F.concat(F.format_string('Project("{%s}") = "%s", "%s", "%s"\r\n', "type", "name", "path", "id"), F.coalesce(section, F.lit("")), F.lit("EndProject\r\n"))
    body = rows.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", block.alias("b")))), lambda r: r["b"]), "").alias("body"))
    return body.select(key, F.concat(F.col("body"), F.lit("Global\r\nEndGlobal\r\n")).alias("content"))


def strip_bom(content: str) -> str:
    return re.sub("^﻿", "", content)
