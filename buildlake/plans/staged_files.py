"""Queries whose inputs are built from the tables first: dumps, project and solution files, binaries, build documents, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from buildlake.farm import Farm
from buildlake.functions import numbers
from buildlake.operators import corpus, debuginfo, projects, source_text
from buildlake.operators.numbering import as_it_lies
from buildlake.plans.registry import Registry
from buildlake.sources import addresses, files, roles
from buildlake.sources.staging import staged, work_folder
from buildlake.streaming import jobs

REGISTRY = query = Registry()


def _dump_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A debug dump for each supplier: a header for each of its parts' orders, a line for each item.

    Numbers move once, into ranges of (dump, order): where the lines are written, they are scanned too.
    """
    items = roles.load(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("long").alias("q"))
    items = items.repartitionByRange("l_suppkey", "l_orderkey").distinct()
    number = F.col("l_linenumber") + F.when(F.col("l_partkey") % 5 == 0, 20_000_000).otherwise(0)  # hidden lines
    told = lambda text, none="null": F.coalesce(text.cast("string"), F.lit(none))
    address, length = numbers.to_hex(F.col("l_orderkey") * 64, F.lit(8)), F.lower(F.hex("q"))
    row = F.concat(F.lit("line "), told(number), F.lit(" at ["), told(address, "    null"), F.lit("], len = 0x"), told(length), F.lit(" c:\\src\\f"), told(F.col("l_partkey") % 7), F.lit(".c (MD5: AB)"))
    inside = ["l_linenumber", "l_partkey", "q"]
    nth = F.row_number().over(Window.partitionBy("l_suppkey", "l_orderkey").orderBy(*inside))  # an order's items at one supplier
    head = F.concat(F.lit("** f"), "l_orderkey")
    lines = items.select("l_suppkey", "l_orderkey", nth.alias("nth"), row.alias("row"), head.alias("head"))
    both = F.when(F.col("nth") == 1, F.array("head", "row")).otherwise(F.array("row"))
    lines = lines.select("l_suppkey", "l_orderkey", "nth", F.posexplode(both).alias("behind", "line"))
    placed = as_it_lies(lines.sortWithinPartitions("l_suppkey", "l_orderkey", "nth", "behind").select("l_suppkey", "line"))
    return placed.select(F.col("l_suppkey").alias("dump"), F.col("__at").alias("pos"), "line", "__range", "__at")


@query(
    """WITH i AS (SELECT DISTINCT l_suppkey AS dump, l_orderkey, l_linenumber, l_partkey, l_quantity::BIGINT AS q FROM lineitem)
    SELECT dump, 'f' || l_orderkey AS function, lower(printf('%08x', l_orderkey * 64)) AS rva_start,
    lower(printf('%08x', l_orderkey * 64 + arg_max(q, (l_linenumber, l_partkey, q)))) AS rva_end,
    CASE WHEN sum(q) = 0 THEN 0 ELSE coalesce(sum(q) FILTER (WHERE l_partkey % 5 = 0), 0) / sum(q) END::DOUBLE AS debug_ratio FROM i
    GROUP BY dump, l_orderkey"""
)
def debug_dump_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = debuginfo.dump_rows(_dump_lines(spark, sf_dir))
    return debuginfo.segments(rows).select("dump", "function", "rva_start", "rva_end", "debug_ratio")


@query(
    """SELECT DISTINCT l_suppkey AS dump, 'f' || l_orderkey AS function, l_linenumber::BIGINT + CASE WHEN l_partkey % 5 = 0 THEN 20000000 ELSE 0 END AS line_number, lower(printf('%08x', l_orderkey * 64)) AS rva, l_quantity::BIGINT AS length,
    'c:\\src\\f' || l_partkey % 7 || '.c' AS source_file, 'AB' AS digest FROM lineitem"""
)
def debug_dump_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debuginfo.dump_rows(_dump_lines(spark, sf_dir)).select("dump", "function", "line_number", "rva", "length", "source_file", "digest").distinct()


def _project_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = lambda mode, platform: f'<ProjectConfiguration Include="{mode}|{platform}"><Configuration>{mode}</Configuration><Platform>{platform}</Platform></ProjectConfiguration>'
    xml = F.concat(
        F.lit(f'<Project xmlns="{projects.NAMESPACE}"><ItemGroup Label="ProjectConfigurations">{config("Debug", "Win32")}{config("Release", "x64")}</ItemGroup>'),
        F.lit('<PropertyGroup Label="Configuration"><ConfigurationType>Application</ConfigurationType><PlatformToolset>v14'),
        (F.col("p_size") % 3).cast("string"),
        F.lit("</PlatformToolset></PropertyGroup>"),
        F.lit("<ItemDefinitionGroup Condition=\"'$(Configuration)|$(Platform)'=='Debug|Win32'\"><ClCompile><Optimization>Disabled</Optimization></ClCompile><Link><AdditionalDependencies>a.lib;b.lib</AdditionalDependencies></Link></ItemDefinitionGroup>"),
        F.lit('<ItemGroup><ClCompile Include="'),
        F.concat(F.lit("part"), "p_partkey", F.lit('.cpp"/><ClInclude Include="part'), "p_partkey", F.lit('.h"/></ItemGroup></Project>')),
    )
    # few bytes of input, much work for each: one file's rows are dealt to all cores
    parts = roles.load(spark, sf_dir, "part").select("p_partkey", "p_size").repartition(4 * spark.sparkContext.defaultParallelism)
    return parts.select("p_partkey", "p_size", xml.alias("xml"))


@query("SELECT p_partkey, 'v14' || p_size % 3 AS toolset, 'part' || p_partkey || '.cpp' AS source, 'part' || p_partkey || '.h' AS include, 'Disabled' AS optimization, 'a.lib,b.lib' AS link FROM part")
def xml_project_getters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = projects.described_projects(_project_files(spark, sf_dir))
    return found.select("p_partkey", "toolset", F.col("sources")[0].alias("source"), F.col("includes")[0].alias("include"), "optimization", F.array_join("link_dependencies", ",").alias("link"))


@query("SELECT p_partkey, c.configuration, c.platform FROM part, (VALUES ('Debug', 'Win32'), ('Release', 'x64')) c(configuration, platform)")
def xml_project_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projects.configurations(_project_files(spark, sf_dir)).select("p_partkey", "configuration", "platform")


@query("SELECT p_partkey, 'v' || 140 + p_size % 4 AS toolset, CASE p_size % 3 WHEN 0 THEN 'Full' WHEN 1 THEN 'MinSpace' ELSE '' END AS optimization, CASE WHEN p_size % 3 = 0 THEN 'true' ELSE '' END AS whole_program FROM part")
def xml_project_setters(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _project_files(spark, sf_dir)
    flag = F.element_at(F.array(*map(F.lit, ("/Ox", "/O1", "/Od"))), (F.col("p_size") % 3 + 1).cast("int"))
    changed = table.withColumn("xml", projects.edited(F.col("xml"), [("toolset", F.concat(F.lit("v"), 140 + F.col("p_size") % 4)), ("optimization", flag)]))
    return projects.described_projects(changed).select("p_partkey", "toolset", "optimization", "whole_program")


@query(
    """SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'true' ELSE 'false' END AS whole_program, 'out' || p_size AS output_directory, CASE WHEN p_size % 3 = 0 THEN 'Speed' ELSE 'Size' END AS favor,
    'Inline' || p_size % 4 AS inline_expansion, CASE WHEN p_size % 5 = 0 THEN 'true' ELSE 'false' END AS intrinsics, 'o' || p_partkey || '.exe' AS output_file, 'o' || p_partkey || '.pdb' AS pdb_file,
    'x' || p_size || ',y' AS include_directories, CASE WHEN p_size % 7 = 0 THEN 'true' ELSE 'false' END AS incremental FROM part"""
)
def xml_project_all_setters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of the other setters writes, all in one pass, read back."""
    size = F.col("p_size")
    truth = lambda n: F.when(size % n == 0, "true").otherwise("false")
    script = [
        ("whole_program", truth(2)),
        ("output_directory", F.concat(F.lit("out"), size)),
        ("favor", F.when(size % 3 == 0, "Speed").otherwise("Size")),
        ("inline", F.concat(F.lit("Inline"), size % 4)),
        ("intrinsics", truth(5)),
        ("output_file", F.concat(F.lit("o"), "p_partkey", F.lit(".exe"))),
        ("pdb_file", F.concat(F.lit("o"), "p_partkey", F.lit(".pdb"))),
        ("include_directories", F.concat(F.lit("x"), size, F.lit(";y"))),
        ("incremental_link", truth(7)),
    ]
    plain = F.replace(F.col("xml"), F.lit("</Project>"), F.lit("<PropertyGroup/></Project>"))
    compiled = {"favor": "FavorSizeOrSpeed", "inline_expansion": "InlineFunctionExpansion", "intrinsics": "IntrinsicFunctions"}
    more = {name: ("ItemDefinitionGroup", "ClCompile", item) for name, item in compiled.items()} | {"incremental": ("PropertyGroup", "LinkIncremental", None)}
    found = projects.described_projects(_project_files(spark, sf_dir).withColumn("xml", projects.edited(plain, script)), more=more)
    return found.withColumn("include_directories", F.array_join("include_directories", ",")).select("p_partkey", "whole_program", "output_directory", "favor", "inline_expansion", "intrinsics", "output_file", "pdb_file", "include_directories", "incremental")


@query(
    """SELECT n_regionkey AS solution, n.n_name AS name, m.n_name AS depends_on FROM nation n JOIN nation m USING (n_regionkey)
    WHERE m.n_nationkey = (SELECT max(x.n_nationkey) FROM nation x WHERE x.n_regionkey = n.n_regionkey AND x.n_nationkey < n.n_nationkey)"""
)
def solution_dependencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = roles.load(spark, sf_dir, "nation")
    name_id = lambda c: F.concat(F.lit("{ID-"), c, F.lit("}"))
    before = F.lag("n_nationkey").over(Window.partitionBy("n_regionkey").orderBy("n_nationkey"))
    rows = nation.select(F.col("n_regionkey").alias("solution"), F.col("n_nationkey").alias("pos"), F.lit("T").alias("type"), F.col("n_name").alias("name"), F.concat("n_name", F.lit(".vcxproj")).alias("path"), name_id(F.col("n_nationkey")).alias("id"), name_id(before).alias("on"))
    text = projects.rendered_solution(rows.drop("on"), rows.where("on is not null").select("solution", "id", "on"), "solution")
    return projects.solution_dependencies(projects.solution_rows(text, "solution", "content"), "solution")


@query("SELECT p_partkey, CASE WHEN p_size % 4 IN (2, 3) THEN (p_size % 4)::INT END AS elf_type FROM part WHERE p_size % 5 <> 0 AND p_size % 4 IN (2, 3)")
def elf_magic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.lpad(F.hex(F.col("p_size") % 4), 2, "0")
    magic = F.when(F.col("p_size") % 5 == 0, "00000000").otherwise(files.ELF_MAGIC)
    swapped = F.col("p_partkey") % 2 == 0
    head = F.concat(magic, F.when(swapped, "010201").otherwise("010101"), F.repeat(F.lit("00"), F.lit(9)), F.when(swapped, F.concat(F.lit("00"), kind)).otherwise(F.concat(kind, F.lit("00"))))
    return files.elf_binaries(roles.load(spark, sf_dir, "part").select("p_partkey", F.unhex(head).alias("content"))).select("p_partkey", "elf_type")


def _build() -> dict[str, F.Column]:
    """What all documents say about their builds, by order."""
    return {"Platform": F.lit(None).cast("string"), "Build_mode": F.lit("Debug"), "Toolset_version": F.lit("v142"), "Optimization": F.lit("O2"), "Pushed_at": F.lit("02/03/2020, 04:05:06"), "URL": F.concat(F.lit("https://forge.com/"), "l_orderkey")}


def _build_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A build document for each order: a binary for each line number, a function for each part; every fifth has none."""
    items = roles.load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("int").alias("q"))
    items = items.repartition("l_orderkey").distinct()  # numbers move once; all that is nested into an order is built where they are
    line = F.struct(F.col("q").alias("line_number"), F.lit("00000010").alias("rva"), F.col("q").alias("length"), F.lit("x;").alias("source_code"), F.lit("a.c").alias("source_file"))
    segment = F.struct(F.lit("00000010").alias("rva_start"), F.lit("00000020").alias("rva_end"), F.lit("0%").alias("debug_ratio"))
    function = F.struct(F.concat(F.lit("f"), "l_partkey").alias("function_name"), F.lit("12.5%").alias("intersect_ratio"), F.lit("a.c").alias("source_file"), F.array(segment).alias("function_info"), F.array(line).alias("lines"))
    binaries = items.groupBy("l_orderkey", "l_linenumber").agg(F.array_sort(F.collect_list(function)).alias("functions"))
    functions = F.when(F.col("l_linenumber") % 5 == 0, F.filter("functions", lambda f: F.lit(False))).otherwise(F.col("functions"))
    binary = F.struct(F.concat(F.lit("d:\\out\\b"), "l_linenumber", F.lit(".exe")).alias("file"), functions.alias("functions"))
    docs = binaries.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(binary)).alias("Binary_info_list"))
    return docs.withColumns(_build())


_DATASET = """WITH s AS (SELECT l_orderkey, l_linenumber, (1024 * max(l_quantity) + l_orderkey % 1000)::BIGINT AS n_bytes FROM lineitem GROUP BY l_orderkey, l_linenumber),
z AS (SELECT * FROM s WHERE n_bytes / 1024.0 BETWEEN 5 AND 40),
b AS (SELECT * FROM z WHERE l_orderkey IN (SELECT l_orderkey FROM z GROUP BY l_orderkey HAVING count(*) >= 2)),
f AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_quantity::INT AS q, n_bytes FROM lineitem JOIN b USING (l_orderkey, l_linenumber) WHERE l_linenumber % 5 <> 0)"""


@query(f"{_DATASET} SELECT (SELECT count(*) FROM b WHERE l_linenumber % 5 <> 0) AS binaries, (SELECT count(*) FROM b WHERE l_linenumber % 5 = 0) AS dropped, (SELECT count(*) FROM f) AS functions, (SELECT count(*) FROM f) AS lines, (SELECT sum(q)::BIGINT FROM f) AS total, 0.125::DOUBLE AS ratio")
def dataset_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _dataset(spark, sf_dir)
    one = lambda t, n: t.agg(F.count(F.lit(1)).alias(n))
    counts = one(tables["binaries"], "binaries").crossJoin(one(tables["dropped"], "dropped")).crossJoin(tables["functions"].agg(F.count(F.lit(1)).alias("functions"), F.max("intersect_ratio").alias("ratio")))
    return counts.crossJoin(tables["lines"].agg(F.count(F.lit(1)).alias("lines"), F.sum("line_number").alias("total")))  # one row each


_DATASET_ROWS = _DATASET + """,
k AS (SELECT l_orderkey, l_linenumber, md5('https://forge.com/' || l_orderkey) || '_unknown_Debug_v142_O2' AS identifier, 'b' || l_linenumber || '.exe' AS file_name, n_bytes FROM b WHERE l_linenumber % 5 <> 0),
binaries AS (SELECT row_number() OVER (ORDER BY identifier, file_name) AS id, *, md5(identifier || '_' || file_name) AS h FROM k),
functions AS (SELECT row_number() OVER (ORDER BY id, 'f' || l_partkey, q) AS id, id AS binary_id, 'f' || l_partkey AS name, q FROM f JOIN binaries USING (l_orderkey, l_linenumber))"""


def _dataset(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    quantity = roles.load(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("q"))
    file = F.concat(F.lit("b"), "l_linenumber", F.lit(".exe"))
    listed = corpus.identified(quantity.withColumns(_build())).select("identifier", file.alias("file_name"), (1024 * F.col("q") + F.col("l_orderkey") % 1000).cast("long").alias("n_bytes"))
    return Farm(spark).documents(_build_documents(spark, sf_dir)).sizes(least_kb=5, most_kb=40).folders_of(2).run(listed)


@query(f"{_DATASET_ROWS} SELECT id, identifier, file_name, left(h, 2) || '/' || substr(h, 3) AS path, n_bytes // 1024 AS size, 'unknown' AS platform, TIMESTAMP '2020-02-03 04:05:06' AS pushed_at FROM binaries")
def dataset_binary_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dataset(spark, sf_dir)["binaries"].select("id", "identifier", "file_name", "path", "size", "platform", F.col("pushed_at").cast("timestamp_ntz").alias("pushed_at"))


@query(f"{_DATASET_ROWS} SELECT id, binary_id, name, 'a.c' AS source_file, 0.125::DOUBLE AS intersect_ratio, '00000010-00000020' AS rvas FROM functions")
def dataset_function_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dataset(spark, sf_dir)["functions"].drop("lines")


@query(f"{_DATASET_ROWS} SELECT id, id AS function_id, q AS line_number, '00000010' AS rva, q AS length, 'x;' AS source_code FROM functions")
def dataset_line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dataset(spark, sf_dir)["lines"]


@query(f"{_DATASET_ROWS} SELECT binary_id AS id, string_agg(name || ':' || q, ',' ORDER BY name, q) AS functions FROM functions GROUP BY binary_id")
def dataset_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dataset's tables nested into documents again."""
    tables = _dataset(spark, sf_dir)
    nested = corpus.build_documents(tables["binaries"].select("id"), tables["functions"].drop("lines"), tables["lines"])
    rendered = F.transform("functions", lambda f: F.concat_ws(":", f["name"], F.array_join(F.transform(f["lines"], lambda r: r["line_number"].cast("string")), "+")))
    return nested.select("id", F.array_join(rendered, ",").alias("functions"))


_SOURCE = """#include <a.h>
/* adds
   {name} */
static int
add_{key}(int a, int b)
{{
  // sum of {nation}
  puts("// {name}");
  return a + b;
}}"""


@query(
    """SELECT s_suppkey, 'add_' || s_suppkey AS name, '/* adds' || chr(10) || '   ' || s_name || ' */' AS top_comments, '  // sum of ' || s_nationkey AS body_comments, 'static int' || chr(10) || 'add_' || s_suppkey || '(int a, int b)' AS prototype,
    concat_ws(chr(10), '/* adds', '   ' || s_name || ' */', 'static int', 'add_' || s_suppkey || '(int a, int b)', '{', '  // sum of ' || s_nationkey, '  puts("// ' || s_name || '");', '  return a + b;', '}') AS definition FROM supplier"""
)
def comments_prototypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.lit(_SOURCE.replace("{{", "{").replace("}}", "}"))
    for field, column in (("{name}", "s_name"), ("{key}", "s_suppkey"), ("{nation}", "s_nationkey")):
        body = F.replace(body, F.lit(field), F.col(column).cast("string"))
    functions = roles.load(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("add_"), "s_suppkey").alias("name"), body.alias("body"))
    return source_text.described_functions(functions).drop("body")


@query(
    """SELECT p_partkey, 'int add_' || s_suppkey AS ctag_definitions, '/* ' || s_name || ' */' AS top_comments, 'add_' || s_suppkey || '(int a)' AS prototype, s_address AS source_codes
    FROM part LEFT JOIN (SELECT *, s_nationkey::VARCHAR AS s_address FROM supplier) ON s_suppkey = p_partkey % 120 AND s_suppkey % 3 = p_size % 3"""
)
def tagged_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Debug functions with what the tags of their source file say; names differ in case and namespace."""
    parts, suppliers = roles.load(spark, sf_dir, "part"), roles.load(spark, sf_dir, "supplier")
    wanted = F.concat(F.when(F.col("p_partkey") % 2 == 0, "Ns::ADD_").otherwise("Add_"), F.col("p_partkey") % 120)
    functions = parts.select("p_partkey", wanted.alias("function"), F.concat(F.lit("c:\\f"), F.col("p_size") % 3, F.lit(".c (MD5: AB)")).alias("source_file"))
    key = F.col("s_suppkey").cast("string")
    said = {"ctag_definitions": F.concat(F.lit("int add_"), key), "top_comments": F.concat(F.lit("/* "), "s_name", F.lit(" */")), "body_comments": F.lit(""), "source_codes_ctags": F.lit(""), "prototype": F.concat(F.lit("add_"), key, F.lit("(int a)")), "source_codes": F.col("s_nationkey").cast("string")}
    tags = suppliers.select(F.concat(F.lit("c:\\f"), F.col("s_suppkey") % 3, F.lit(".c")).alias("source_file"), F.concat(F.lit("add_"), key).alias("name"), F.col("s_suppkey").alias("at"), *[v.alias(k) for k, v in said.items()])
    return debuginfo.with_tag_fields(functions, tags).select("p_partkey", "ctag_definitions", "top_comments", "prototype", "source_codes")


@query("SELECT doc_id, substr(hex(encode(text)), 21, 10) AS first_slice, substr(hex(encode(text)), 37, 24) AS last_slice, substr(hex(encode(text)), 21, 40) AS span FROM documents")
def function_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices and span of bytes of every document, in hex: a byte may be part of a character."""
    cut = _cut_bytes(roles.load(spark, sf_dir, "documents"))
    return cut.select(F.col("file_name").alias("doc_id"), F.hex(F.col("slices")[0]).alias("first_slice"), F.hex(F.col("slices")[1]).alias("last_slice"), F.hex("span").alias("span"))


def _cut_bytes(docs: DataFrame) -> DataFrame:
    images = docs.select(F.col("doc_id").alias("file_name"), F.encode("text", "utf-8").alias("content"))
    segments = F.array(*[F.struct(F.lit(s).alias("start"), F.lit(e).alias("end")) for s, e in ((10, 15), (18, 30))])
    return corpus.function_bytes(docs.select(F.col("doc_id").alias("file_name"), F.lit("f").alias("name"), segments.alias("segments")), images)


def _executables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A portable executable for each document: its text in two sections that are neighbours in memory and stored the other way round."""
    docs = roles.load(spark, sf_dir, "documents").select("doc_id", F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("body"))
    n = F.octet_length("body")
    half = F.floor(n / 2).cast("int")

    def little(value: F.Column, width: int) -> F.Column:
        digits = F.lpad(F.hex(value), 2 * width, "0")
        return F.concat(*[F.substring(digits, 2 * k + 1, 2) for k in reversed(range(width))])

    number = lambda v, width=4: little(F.lit(v) if isinstance(v, int) else v, width)
    section = lambda size, at, place: F.concat(F.lit("00" * 8), number(size), number(at), number(size), number(place), F.lit("00" * 16))
    # the header's offset at 0x3C, the header at 0x40 with 96 optional bytes, two sections of 40 bytes: 0x108 in all
    head = F.concat(
        F.lit("4D5A" + "00" * 58), number(0x40), F.lit("50450000" + "0000"), number(2, 2), F.lit("00" * 12), number(96, 2), F.lit("00" * 2 + "00" * 56),
        number(n + 0x1000), number(0x108), F.lit("00" * 32), section(half, 0x1000, n - half + 0x108), section(n - half, half + 0x1000, 0x108),
    )
    body = lambda at, size: F.substring(F.col("body"), at + 1, size)
    return docs.select(F.col("doc_id").alias("file_name"), F.concat(F.unhex(head), body(half, n - half), body(F.lit(0), half)).alias("content"), half.alias("half"), n.alias("n"))


@query(
    """SELECT doc_id, substr(hex(b), 21, 40) AS first_slice, substr(hex(b), 2 * greatest(n // 2 - 5, 0) + 1, 2 * (least(n // 2 + 5, n) - greatest(n // 2 - 5, 0))) AS across, '4D5A' || repeat('00', 6) AS head
    FROM (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents)"""
)
def mapped_function_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of functions by address: in one section, across two, and in the headers."""
    images = staged(_executables(spark, sf_dir), "executables")
    middle = F.col("half") + 0x1000
    ranges = [(F.lit(0x100A), F.lit(0x101E)), (F.greatest(middle - 5, F.lit(0x1000)), F.least(middle + 5, F.col("n") + 0x1000)), (F.lit(0), F.lit(8))]
    functions = images.select("file_name", F.lit("f").alias("name"), F.array(*[F.struct(a.alias("start"), b.alias("end")) for a, b in ranges]).alias("segments"))
    found = addresses.mapped_bytes(functions, images.select("file_name", "content"))
    return found.select(F.col("file_name").alias("doc_id"), *[F.hex(F.col("slices")[i]).alias(c) for i, c in enumerate(("first_slice", "across", "head"))])


@query("SELECT doc_id, substr(hex(encode(text)), 21, 40) AS span, n_chars FROM documents")
def function_bytes_hex(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = roles.load(spark, sf_dir, "documents")
    return _cut_bytes(docs).select(F.col("file_name").alias("doc_id"), F.hex("span").alias("span")).join(docs.select("doc_id", "n_chars"), "doc_id")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = roles.load(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).format("parquet").option("pathGlobFilter", "events.parquet").option("recursiveFileLookup", True).load(sf_dir)


@query(
    """SELECT make_timestamp((e // 300 * 300 + 300 * (s + 1)) * 1000000) AS until, event_type, count(*) AS n FROM (SELECT event_type, floor(epoch(ts))::BIGINT AS e FROM events), range(12) t(s) GROUP BY ALL"""
)
def streamed_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the last hour, every five minutes and by type: panes counted as a stream, hours from sums of panes."""
    return jobs.last_counts(_panes(spark, sf_dir), "event_type", 3600).withColumn("until", F.col("until").cast("timestamp_ntz"))


def _panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = jobs.pane_counts(_event_stream(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp")), "ts", "event_type")
    folder = work_folder(spark, "panes")
    table = jobs.VersionedTable(spark, f"{folder}/table", counted.schema, ["pane"])
    jobs.run_available(counted, f"{folder}/checkpoint", table.upsert(["pane", "event_type"]), "update")
    return table.before()


@query(
    """WITH p AS (SELECT event_type, floor(epoch(ts))::BIGINT // 300 * 300 AS pane, count(*) AS n FROM events GROUP BY ALL), m AS (SELECT (max(pane) + 300) // 86400 * 86400 AS mark FROM p)
    SELECT event_type, sum(n) FILTER (WHERE pane >= mark - 86400) AS last_day, sum(n) FILTER (WHERE pane >= mark - 30 * 86400) AS last_month FROM p, m WHERE pane < mark AND pane >= mark - 30 * 86400 GROUP BY event_type"""
)
def streamed_last_day_and_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same panes summed over a day and over thirty days, at the last midnight."""
    panes = staged(_panes(spark, sf_dir), "panes")
    midnight = panes.agg((F.floor((F.max(F.unix_seconds("pane")) + 300) / 86400) * 86400).cast("long").alias("mark"))
    at_midnight = lambda days, name: jobs.last_counts(panes, "event_type", days * 86400).join(midnight, F.unix_seconds("until") == F.col("mark")).select("event_type", F.col("n").alias(name))
    return at_midnight(1, "last_day").join(at_midnight(30, "last_month"), "event_type")


@query("SELECT user_id, min(event_id) AS event_id, count(*) AS events FROM events GROUP BY user_id")
def streamed_scrape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that are JSON arrays of records: exploded, and the first record of each key kept, as a stream into a table."""
    events = roles.load(spark, sf_dir, "events")
    folder = work_folder(spark, "scrape")
    batches = events.groupBy(F.floor(F.col("event_id") / 10).alias("batch")).agg(F.to_json(F.collect_list(F.struct("user_id", "event_id"))).alias("value"))
    batches.select("value").write.text(f"{folder}/inbox")
    rows = jobs.decoded_batches(spark.readStream.text(f"{folder}/inbox"), "value", "struct<user_id: long, event_id: long>")
    table = jobs.VersionedTable(spark, f"{folder}/table", rows.schema, ["user_id"])
    jobs.run_available(rows, f"{folder}/checkpoint", table.insert_new(["user_id"], ["event_id"]))
    return table.before().join(events.groupBy("user_id").agg(F.count(F.lit(1)).alias("events")), "user_id")


@query("SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1")
def streamed_hourly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream, counted by hour; each batch's updated hours replace the former ones."""
    folder = work_folder(spark, "hours")
    counted = jobs.hourly_counts(_event_stream(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp")), "ts")
    table = jobs.VersionedTable(spark, f"{folder}/table", counted.schema)
    jobs.run_available(counted, f"{folder}/checkpoint", table.upsert(["hour"]), "update")
    return table.before().withColumn("hour", F.col("hour").cast("timestamp_ntz"))


@query(
    """SELECT user_id AS _id, arg_max(event_type, event_id) AS event_type, arg_max(floor(value)::BIGINT, event_id) AS value FROM events GROUP BY user_id"""
)
def streamed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events merged batch by batch into a table of one row a user."""
    events = roles.load(spark, sf_dir, "events")
    rows = _event_stream(spark, sf_dir).select(F.col("user_id").alias("_id"), "event_id", "event_type", F.floor("value").cast("long").alias("value"))
    folder = work_folder(spark, "upsert")
    table = jobs.VersionedTable(spark, f"{folder}/table", rows.drop("event_id").schema)
    table.write(events.select(F.col("user_id").alias("_id"), F.lit(None).cast("string").alias("event_type"), F.lit(None).cast("long").alias("value")).distinct(), 0)
    merge = table.merge_updates("_id", ["event_id"])
    jobs.run_available(rows, f"{folder}/checkpoint", lambda batch, k: merge(batch, k + 1))
    return table.before()
