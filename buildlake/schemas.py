"""Fixed schemas of the control tables, the dataset tables, documents and messages."""

from __future__ import annotations

from pyspark.sql import types as T

# fixed values: task states
INIT, PROCESSING, FAILED, SUCCESS, TIMEOUT, BLACKLIST, OUTDATED, EXCLUDED, COMMAND_FAILED = 0, 1, 2, 3, 4, 5, 6, 7, 10
FAILURES = (FAILED, COMMAND_FAILED)

# fixed values: seconds
TASK_TTL = WORKER_TTL = 600
HOUR, DAY, MONTH = 3600, 86400, 30 * 86400

# fixed values: what is built
BUILD_SYSTEMS = ("make", "cmake", "autoconf", "bootstrap", "sln")
LANGUAGES = ("c", "c++", "c#")


_TYPES = {"int": T.IntegerType(), "long": T.LongType(), "string": T.StringType(), "boolean": T.BooleanType(), "double": T.DoubleType(), "binary": T.BinaryType(), "timestamp_ntz": T.TimestampNTZType()}


def _struct(spec: str) -> T.StructType:
    """``name type, ...`` of plain types; needs no session, so workers can import it."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in map(str.split, spec.split(","))])


PROJECTS = _struct(
    "_id int, url string, owner_id int, name string, description string, language string, created_at timestamp_ntz, fork_from int, "
    "deleted boolean, updated_at timestamp_ntz, forked_commit_id int, branch string, priority int, size int, build_system string"
)
OPTIONS = _struct("_id int, platform string, language string, compiler_name string, compiler_flag string, build_system string, build_command string, library string, enable boolean")
STATUSES = _struct(
    "_id int, priority int, clone_status int, clone_msg string, build_status int, build_msg string, build_opt_id int, repo_id int, mod_timestamp long, build_time int, commit_hexsha string"
)
CONTROL_BINARIES = _struct("_id int, file_name string, description string, build_date timestamp_ntz, disasmed boolean, status_id int")

BINARIES = _struct("id long, file_name string, path string, platform string, build_mode string, toolset_version string, github_url string, optimization string, pushed_at timestamp_ntz, size long")
FUNCTIONS = _struct("id long, name string, source_file string, intersect_ratio double, rvas string, binary_id long")
LINES = _struct("id long, line_number int, rva string, length int, source_code string, function_id long")

SEGMENT = "struct<rva_start: string, rva_end: string, debug_ratio: string>"
LINE = "struct<line_number: int, rva: string, length: int, source_code: string, source_file: string>"
FUNCTION = f"struct<function_name: string, intersect_ratio: string, source_file: string, function_info: array<{SEGMENT}>, lines: array<{LINE}>, ctag_definitions: string, top_comments: string, body_comments: string, prototype: string, source_codes: string, source_codes_ctags: string>"
BUILD_DOCUMENT = f"Platform string, Build_mode string, Toolset_version string, URL string, Optimization string, Pushed_at string, Commit string, Binary_info_list array<struct<file: string, functions: array<{FUNCTION}>>>"

TASK_MESSAGE = _struct("name string, url string, task_id long, opt_id int, output_dir string, repo_id long, updated_at string, build_system string, msg_time double, mod_timestamp long")
CLONE_MESSAGE = _struct("url string, opt_id int, status int, msg string, task_id long")
BUILD_MESSAGE = _struct("url string, opt_id int, status int, msg string, task_id long, build_time int, commit_hexsha string")
BINARY_MESSAGE = _struct("task_id long, file_name string")
PING = _struct("ping int, uuid string, task int, msg string")
CHUNK = _struct("name string, seq int, content binary, worker_id int, repo_tag string")
CRAWLED = _struct("name string, url string, language string, owner_id int, description string, created_at string, updated_at string, size int, build_system string, branch string")

# fixed values: keys of a seed repository, besides an id
SEED_KEYS = ("branch", "build_system", "created_at", "description", "language", "name", "owner_id", "size", "updated_at", "url")
