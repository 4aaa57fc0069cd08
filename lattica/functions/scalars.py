"""Scalar functions of run sheets, parameters and reports, as column expressions.

Truth here is that of a dynamic language: null, false, 0, the empty string and
the empty array are all false. `truthy` and what builds on it keep to that.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def truthy(c: Column, dtype: str = "string") -> Column:
    """Whether a value counts as true; dtype is its Spark type's simple name."""
    if dtype == "boolean":
        return F.coalesce(c, F.lit(False))
    if dtype.startswith(("array", "map")):
        return F.coalesce(F.size(c) > 0, F.lit(False))
    if dtype in ("string", "binary"):
        return F.coalesce(F.length(c) > 0, F.lit(False))
    return F.coalesce(c != 0, F.lit(False))


def or_else(c: Column, default: Column, dtype: str = "string") -> Column:
    """c if it is truthy, else the default; not the same as coalesce."""
    return F.when(truthy(c, dtype), c).otherwise(default)


def flag(name: str, c: Column, dtype: str = "string", zero_is_value: bool = False) -> Column:
    """A command-line fragment, empty if c isn't truthy; zero_is_value lets 0 through."""
    on = c.isNotNull() if zero_is_value and dtype not in ("string", "boolean") else truthy(c, dtype)
    return F.when(on, F.concat(F.lit(f"--{name}="), c.cast("string"))).otherwise("")


def to_boolean(c: Column) -> Column:
    """Text to boolean: true, y or 1 in any case."""
    return F.lower(F.trim(c)).isin("true", "y", "1")


def last_segment(c: Column, sep: str = ":") -> Column:
    return F.split_part(c, F.lit(sep), F.lit(-1))


def tokens(c: Column, sep: str = ",") -> Column:
    """Split without empty tokens; sep is one character."""
    return F.filter(F.split(c, "[" + ("\\" if sep in "\\]^-" else "") + sep + "]"), lambda t: t != "")


def suffixes(c: Column) -> Column:
    """The last two extensions of a path's name, as one string; a leading dot starts no extension."""
    name = F.regexp_replace(F.regexp_extract(c, r"([^/]*)/*$", 1), r"^\.+", "")
    return F.regexp_extract(name, r"((?:[.][^./]+){0,2})$", 1)


def base_name(c: Column) -> Column:
    """The name without its last extension."""
    return F.regexp_replace(c, r"[.][^.]*$", "")


def pad_right(c: Column, n: Column) -> Column:
    """Padded to n, never cut."""
    return F.rpad(c, F.greatest(F.length(c), n.cast("int")), F.lit(" "))


def publish_path(process: Column) -> Column:
    """The folder of a process: its last segment up to the first underscore, in lower case."""
    return F.lower(F.get(tokens(last_segment(process), "_"), F.lit(0)))


def version_string(version: Column, commit: Column) -> Column:
    """v-prefixed version, and -g with seven characters of the commit if there is one."""
    v = F.when(truthy(version), F.concat(F.when(F.substring(version, 1, 1) != "v", "v").otherwise(""), version)).otherwise("")
    return F.concat(v, F.when(truthy(commit), F.concat(F.lit("-g"), F.substring(commit, 1, 7))).otherwise(""))


def without_hook(command: Column) -> Column:
    """A command line without its first --hook_url option."""
    return F.regexp_replace(command, r"^(.*?) +--hook_url +[^ ]+", "$1")


def redact(key: Column, value: Column) -> Column:
    return F.when(key == "hook_url", F.lit("_hidden_")).otherwise(value)


def day_unit(duration: Column) -> Column:
    """The first d that ends a word, written out."""
    return F.regexp_replace(duration, r"^(.*?)d(?!\S)", "$1day")


def amount(text: Column, kind: str) -> Column:
    """Bytes of a memory quantity (B, KB, ... PB), or seconds of a duration (s, m, h, d); null if it isn't one."""
    n = F.expr("try_cast(null as double)")
    value = F.regexp_extract(text, r"^\s*([0-9]+(?:[.][0-9]+)?)\s*[.]?\s*([A-Za-z]+)\s*$", 1)
    unit = F.lower(F.regexp_extract(text, r"^\s*([0-9]+(?:[.][0-9]+)?)\s*[.]?\s*([A-Za-z]+)\s*$", 2))
    if kind == "memory":
        units = {u: 1024**i for i, u in enumerate(("b", "kb", "mb", "gb", "tb", "pb"))}
    else:
        units = {"s": 1, "sec": 1, "second": 1, "seconds": 1, "m": 60, "min": 60, "minute": 60, "minutes": 60, "h": 3600, "hour": 3600, "hours": 3600, "d": 86400, "day": 86400, "days": 86400}
    for u, factor in units.items():
        n = F.when(unit == u, value.try_cast("double") * factor).otherwise(n)
    return n.cast("long")


def capped(value: Column, cap: Column) -> Column:
    """The smaller of the two; the value itself if the cap is missing or invalid."""
    return F.coalesce(F.least(value, cap), value)


def scaled(base: Column, attempt: Column) -> Column:
    """A resource request that grows with each attempt."""
    return base * attempt


# Exit codes after which a task is tried again.
RETRY_CODES = (143, 137, 104, 134, 139)


def on_exit(code: Column) -> Column:
    return F.when(code.isin(*RETRY_CODES), "retry").otherwise("finish")


def wrapped(text: Column, width: int) -> Column:
    """array<string> of lines: words join a line while line and word together have at most `width` characters; a space follows each word."""
    start = F.struct(F.lit("").alias("line"), F.expr("cast(array() as array<string>)").alias("lines"))

    def step(acc: Column, w: Column) -> Column:
        fits = F.length(acc["line"]) + F.length(w) <= width
        return F.struct(
            F.when(fits, F.concat(acc["line"], w, F.lit(" "))).otherwise(F.concat(w, F.lit(" "))).alias("line"),
            F.when(fits, acc["lines"]).otherwise(F.concat(acc["lines"], F.array(acc["line"]))).alias("lines"),
        )

    return F.when(F.length(text) <= width, F.array(text)).otherwise(F.aggregate(F.split(text, " "), start, step, lambda a: F.concat(a["lines"], F.array(a["line"]))))


def chunked_base64(c: Column) -> Column:
    """Base64 in lines of 76 characters, parted by line feeds."""
    return F.regexp_replace(F.base64(c), "\r\n", "\n")


def substituted(template: Column, values: dict[str, Column]) -> Column:
    """A template with ${name} replaced."""
    for name, value in values.items():
        template = F.replace(template, F.lit("${" + name + "}"), F.coalesce(value, F.lit("")))
    return template


# Terminal colours.
COLOURS = {
    "reset": "\033[0m", "bold": "\033[1m", "dim": "\033[2m", "underlined": "\033[4m", "blink": "\033[5m", "reverse": "\033[7m", "hidden": "\033[8m",
    "black": "\033[0;30m", "red": "\033[0;31m", "green": "\033[0;32m", "yellow": "\033[0;33m", "blue": "\033[0;34m", "purple": "\033[0;35m", "cyan": "\033[0;36m", "white": "\033[0;37m",
    "bblack": "\033[1;30m", "bred": "\033[1;31m", "bgreen": "\033[1;32m", "byellow": "\033[1;33m", "bblue": "\033[1;34m", "bpurple": "\033[1;35m", "bcyan": "\033[1;36m", "bwhite": "\033[1;37m",
    "ublack": "\033[4;30m", "ured": "\033[4;31m", "ugreen": "\033[4;32m", "uyellow": "\033[4;33m", "ublue": "\033[4;34m", "upurple": "\033[4;35m", "ucyan": "\033[4;36m", "uwhite": "\033[4;37m",
    "iblack": "\033[0;90m", "ired": "\033[0;91m", "igreen": "\033[0;92m", "iyellow": "\033[0;93m", "iblue": "\033[0;94m", "ipurple": "\033[0;95m", "icyan": "\033[0;96m", "iwhite": "\033[0;97m",
    "biblack": "\033[1;90m", "bired": "\033[1;91m", "bigreen": "\033[1;92m", "biyellow": "\033[1;93m", "biblue": "\033[1;94m", "bipurple": "\033[1;95m", "bicyan": "\033[1;96m", "biwhite": "\033[1;97m",
}


def colour(name: Column, monochrome: Column) -> Column:
    """The escape sequence of a colour, blank if monochrome or unknown."""
    table = F.create_map(*[F.lit(x) for pair in COLOURS.items() for x in pair])
    return F.when(monochrome, "").otherwise(F.coalesce(F.try_element_at(table, name), F.lit("")))


def units_of(transform: Column) -> Column:
    """Coordinates are in microns if a transform comes with them, else in pixels."""
    return F.when(truthy(transform), "microns").otherwise("pixels")


def attached(size: Column, limit: Column, inclusive: bool = False) -> Column:
    """Whether a report is small enough to be attached; the two mailers differ on equality."""
    return size <= limit if inclusive else size < limit


def file_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd_HH-mm-ss")


def medium_stamp(ts: Column) -> Column:
    """The medium localised form, always in English."""
    return F.date_format(ts, "MMM d, yyyy, h:mm:ss a")
